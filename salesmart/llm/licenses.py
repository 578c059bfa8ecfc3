"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

A paragraph is a line.  A sparse logistic regression over its word one- and
two-grams gives each licence family a score against the class of unknown texts;
every family likelier than unknown must then share enough word pairs with one of
its templates, so a line with two notices has two families.
Training (on the texts of ``license_texts``) yields some hundred weights; the
scan itself is built-in expressions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .license_texts import OTHER, TEMPLATES
from .quality_rules import STOP_WORDS
from .text import ascii_lower, lines, packed, unpacked

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing: digits, letters and all beyond ASCII
LEAST_SHARED = 3  # word pairs a paragraph has in common with a template, or all of the shorter one
LEAST_SHARE = 0.7  # of the shorter one's word pairs
LEAST_SHUFFLED = 8  # words of a template whose shuffled half no longer is a notice
UNKNOWN = "unknown"
STOP = {w for words in STOP_WORDS.values() for w in words.split()}


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def grams(words: list[str]) -> set[str]:
    """Words that are no stop words, and pairs of neighbours."""
    return set(words) - STOP | {f"{a} {b}" for a, b in zip(words, words[1:])}


@dataclass(frozen=True)
class Model:
    """Weights of the grams for each family against unknown; ``heat`` divides scores before the softmax."""
    families: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    heat: float

    def odds(self, words: list[str]) -> np.ndarray:
        """Of each family against unknown."""
        z = np.array(self.bias)
        for g in sorted(grams(words)):
            if g in self.weights:
                z = z + self.weights[g]
        return np.exp(z / self.heat)

    def probabilities(self, words: list[str]) -> np.ndarray:
        """Shares of the families when a paragraph has only one."""
        e = self.odds(words)
        return e / (1 + e.sum())


def _examples(rng: np.random.Generator, times: int) -> tuple[list[list[str]], list[int]]:
    """Variants of every text: words lost, words around it, and for unknown also shuffled templates."""
    families = sorted(TEMPLATES)
    other = [tokens(t) for t in OTHER.strip().split("\n")]
    loose = [w for t in other for w in t]
    texts, labels = [], []

    def varied(words: list[str]) -> list[str]:
        kept = [w for w in words if rng.random() > 0.05] or words
        around = [list(rng.choice(loose, rng.integers(0, 6))) for _ in range(2)]
        return around[0] + kept + around[1]

    for k, family in enumerate(families):
        for template in TEMPLATES[family]:
            words = tokens(template)
            texts += [words, *(varied(words) for _ in range(times))]
            labels += [k] * (times + 1)
            if len(words) >= LEAST_SHUFFLED:
                texts.append(list(rng.permutation(words)[: len(words) // 2 + 1]))
                labels.append(len(families))
    for words in other:
        texts += [words, *(varied(words) for _ in range(times))]
        labels += [len(families)] * (times + 1)
    return texts, labels


@lru_cache(maxsize=1)
def train(times: int = 8, sparsity: float = 2e-4, steps: int = 250, seed: int = 5) -> Model:
    """Accelerated proximal gradient on the cross-entropy with an L1 penalty.

    The unknown class is the reference: its scores are zero, so a paragraph
    without a gram of positive weight cannot be anything else.  ``heat`` is
    chosen on variants not trained on, to make probabilities calibrated.
    """
    rng = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    texts, labels = _examples(rng, times)
    vocabulary = {g: i for i, g in enumerate(sorted({g for t in texts for g in grams(t)}))}

    def matrix(rows: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(rows), len(vocabulary)), np.float32)
        for i, t in enumerate(rows):
            x[i, [vocabulary[g] for g in grams(t) if g in vocabulary]] = 1
        return x

    x = matrix(texts)
    target = np.eye(len(families) + 1, dtype=np.float32)[labels][:, :-1]
    w, b = np.zeros((x.shape[1], len(families)), np.float32), np.full(len(families), -3.0, np.float32)
    ahead_w, ahead_b, t = w, b, 1.0
    direction = np.ones(x.shape[1], np.float32)
    for _ in range(30):  # the largest curvature, by power iteration
        direction = x.T @ (x @ (direction / np.linalg.norm(direction)))
    rate = 2 * len(x) / float(np.linalg.norm(direction) + len(x))
    for _ in range(steps):
        e = np.exp(np.clip(x @ ahead_w + ahead_b, -30, 30))
        error = e / (1 + e.sum(axis=1, keepdims=True)) - target
        new_w = ahead_w - rate * (x.T @ error) / len(x)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * sparsity, 0)
        new_b = np.minimum(ahead_b - rate * error.mean(axis=0), -2.0)  # nothing known: unknown
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_b = new_w + (t - 1) / u * (new_w - w), new_b + (t - 1) / u * (new_b - b)
        w, b, t = new_w, new_b, u
    # A second notice in a paragraph is no evidence against the first: words of other families never count against one.
    of = [{g for t in TEMPLATES[f] for g in grams(tokens(t))} for f in families]
    for g, i in vocabulary.items():
        foreign = [k for k in range(len(families)) if g not in of[k]]
        if len(foreign) < len(families):
            w[i, foreign] = np.maximum(w[i, foreign], 0)
    fresh, truth = _examples(np.random.default_rng(seed + 1), 3)
    z = matrix(fresh) @ w + b

    def loss(heat: float) -> float:
        e = np.exp(np.clip(z / heat, -30, 30))
        p = np.concatenate([e, np.ones((len(e), 1))], axis=1) / (1 + e.sum(axis=1, keepdims=True))
        return float(-np.log(np.maximum(p[np.arange(len(p)), truth], 1e-12)).mean())

    heat = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss)
    used = np.flatnonzero(np.abs(w).max(axis=1) > 1e-3)
    names = list(vocabulary)
    return Model(families, [round(float(v), 6) for v in b], {names[i]: [round(float(v), 6) for v in w[i]] for i in used}, heat)


def _pairs(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def shared(family: str, words: list[str]) -> set[str]:
    """The word pairs in common with the matching templates of the family; none if no template matches."""
    own, found = set(_pairs(words)), set()
    for template in TEMPLATES.get(family, []):
        theirs = set(_pairs(tokens(template)))
        n = len(own & theirs)
        if n >= max(1, min(LEAST_SHARED, len(own), len(theirs))) and n >= LEAST_SHARE * min(len(own), len(theirs)):
            found |= own & theirs
    return found


def confirmed(family: str, words: list[str]) -> bool:
    """Whether the word pairs match a template of the family; the plain form of the native check."""
    return bool(shared(family, words))


def families_of(model: Model, words: list[str]) -> list[str]:
    """The families of a paragraph, likeliest first; the plain form of ``judged``."""
    e = model.odds(words)
    likely = sorted((k for k in range(len(e)) if e[k] >= 1 and confirmed(model.families[k], words)), key=lambda k: (-e[k], k))
    every = {k: {p for t in TEMPLATES[model.families[k]] for p in _pairs(tokens(t))} for k in likely}
    own = [k for k in likely if shared(model.families[k], words) - set().union(*(every[g] for g in likely if g != k))]
    return [model.families[k] for k in own or likely[:1]]


def _sql(value) -> str:
    """A constant as SQL text; Catalyst folds it into one literal."""
    if isinstance(value, dict):
        return "map(" + ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in value.items()) + ")"
    if isinstance(value, list):
        return "array(" + ", ".join(map(_sql, value)) + ")"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else f"{float(value)!r}D"


def _once(value: Column, then) -> Column:
    """``then`` of a value that is evaluated once, however often ``then`` refers to it.

    A filter above would else be pushed down with every reference spelled out.
    """
    return F.transform(F.array(value), then)[0]


def judged(line: Column, model: Model) -> Column:
    """``family, probability`` of each family of a lower-cased line, likeliest first; null or empty without one.

    Every family is judged on its own against unknown and confirmed by its
    templates, so a line may have several.  A family whose shared word pairs all
    belong to the templates of the others says nothing of its own (GPL words in
    an AGPL notice) and is left out; if all are such, the likeliest stays.
    """
    positive = [g for g, w in model.weights.items() if max(w) > 0]
    # A gram of positive weight brings its words along, so lines without its less common word are unknown for sure.
    marks = sorted({max(g.split(" "), key=lambda w: (w not in STOP, len(w))) for g in positive})
    weights, families = F.expr(_sql(model.weights)), F.expr(_sql(model.families))
    templates = F.expr(_sql({f: [_pairs(tokens(t)) for t in TEMPLATES[f]] for f in model.families}))

    def pairs(words: Column) -> Column:
        n = F.size(words)
        return F.when(n > 1, F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.concat_ws(" ", words[i], words[i + 1])))
        ).otherwise(F.array().cast("array<string>"))

    def odds(words: Column, pairs_: Column) -> Column:
        hits = F.array_sort(F.filter(F.array_union(words, pairs_), lambda g: g.isin(*sorted(model.weights))))
        z = F.aggregate(hits, F.expr(_sql(model.bias)), lambda z, g: F.zip_with(z, F.element_at(weights, g), lambda a, b: a + b))
        return F.transform(z, lambda v: F.exp(v / model.heat))

    def fits(template: Column, pairs_: Column) -> Column:
        return _once(F.size(F.array_intersect(pairs_, template)), lambda n: (n >= F.greatest(F.lit(1), F.least(F.lit(LEAST_SHARED), F.size(pairs_), F.size(template))))
                     & (n >= LEAST_SHARE * F.least(F.size(pairs_), F.size(template))))

    def likely(e: Column, pairs_: Column) -> Column:
        """``at`` (order of the sort), family, probability and shared pairs of the confirmed families."""
        ranked = F.array_sort(F.filter(F.zip_with(e, families, lambda v, f: F.struct((-v).alias("at"), f.alias("family"))), lambda c: c["at"] <= -1))
        with_pairs = F.transform(ranked, lambda c: F.struct(
            c["at"].alias("at"), c["family"].alias("family"), (1 / (1 + 1 / -c["at"])).alias("probability"),
            F.array_intersect(pairs_, F.flatten(F.filter(F.element_at(templates, c["family"]), lambda t: fits(t, pairs_)))).alias("pairs")))
        return F.filter(with_pairs, lambda c: F.size(c["pairs"]) > 0)

    def apart(found: Column) -> Column:
        own = F.filter(found, lambda c: F.size(F.array_except(c["pairs"], F.flatten(F.flatten(F.transform(
            F.filter(found, lambda g: g["family"] != c["family"]), lambda g: F.element_at(templates, g["family"])))))) > 0)
        kept = _once(own, lambda o: F.when(F.size(o) > 0, o).otherwise(F.slice(found, 1, 1)))
        return F.transform(kept, lambda c: F.struct(c["family"].alias("family"), c["probability"].alias("probability")))

    def sure(e: Column, pairs_: Column) -> Column:
        # Nested conditions: templates are looked at for likely paragraphs only.
        return F.when(F.array_max(e) >= 1, _once(likely(e, pairs_), apart))

    def marked(words: Column) -> Column:
        return F.when(F.exists(words, lambda w: w.isin(*marks)),
                      _once(pairs(words), lambda p: _once(odds(words, p), lambda e: sure(e, p))))

    return _once(F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0)), marked)


def scan_paragraphs(docs: DataFrame, text: Column, **keys: Column) -> DataFrame:
    """A row for each family of each paragraph: ``keys``, ``at`` (line number from 0), ``family``, ``probability``."""
    line = docs.select(*[v.alias(k) for k, v in keys.items()], F.posexplode(lines(ascii_lower(text))).alias("at", "line"))
    found = line.select(*keys, "at", F.explode(judged(F.col("line"), train())).alias("j"))
    return found.select(*keys, "at", "j.family", "j.probability")


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_paragraphs``, ``n_licensed``, ``families``, ``family`` and ``probability``.

    ``n_licensed`` counts the paragraphs with a confirmed family, of which each
    may have several.  ``families`` are all of them, sorted and comma-joined;
    ``family`` and ``probability`` (against unknown) belong to the surest of them
    (``unknown`` and null without one).  A null or empty text is one empty paragraph.  Null ids
    and rows with the same id are told apart by their texts; repeated rows get
    equal results.  Input columns named like a result are replaced.

    Scale: lines are exploded and filtered within the scan; only confirmed
    paragraphs, without their texts, are shuffled and joined back.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.col(f"`{doc_id}`").cast("string")
    found = scan_paragraphs(docs, body, k=key, of=F.xxhash64(body))
    by_doc = found.groupBy("k", "of").agg(F.collect_set(F.struct("at", "family", "probability")).alias("found"))
    rows = packed(docs, id=key, h=F.xxhash64(body), n=F.size(lines(body)).cast("long"))
    both = rows.join(by_doc, rows.id.eqNullSafe(by_doc.k) & (rows.h == by_doc.of), "left")
    surest = F.array_max(F.transform("found", lambda f: F.struct(f["probability"].alias("p"), (-f["at"]).alias("at"), f["family"].alias("family"))))
    both = both.withColumn("surest", surest)
    return unpacked(both, docs.columns, n_paragraphs=F.col("n"), n_licensed=F.coalesce(F.when(F.col("found").isNotNull(), F.size(F.array_distinct(F.transform("found", lambda f: f["at"])))), F.lit(0)).cast("long"),
                    families=F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["family"]))), ","), F.lit("")),
                    family=F.coalesce("surest.family", F.lit(UNKNOWN)), probability=F.col("surest.p"))
