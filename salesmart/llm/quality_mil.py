"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded, gated attention
weights say how much each one counts, and the weighted sum of the encodings is
scored.  Only documents have labels; the attention is learned from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bytescan import INK, LOWER, buffers, parts, spans, word_hashes

PASSAGE = 48  # words
MAX_TRAIN = 4_000  # labelled documents that are fitted on
_BINS = 32
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "#*$%&", "|<>", "\"'()[]{}", "\n"]
N_FEATURES = len(_CLASSES) + 1 + 6 + _BINS


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)  # the last class: letters beyond ASCII and all else
    for k, chars in enumerate(_CLASSES):
        table[[ord(c) for c in chars]] = k
    table[[32, 9, 11, 12, 13]] = -1
    return table


_CLASS = _class_table()


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the number of passages before each text.

    A text without words is one passage of zeros.
    """
    data, offsets = buffers(texts)
    starts, ends, first = spans(data, offsets, INK)
    per_text = np.diff(first)
    n_pass = np.maximum(1, -(-per_text // PASSAGE))
    before = np.concatenate([[0], np.cumsum(n_pass)])
    nth = np.arange(len(starts)) - np.repeat(first[:-1], per_text)
    of_word = np.repeat(before[:-1], per_text) + nth // PASSAGE
    total = int(before[-1])
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(starts):
        return out, before
    size = ends - starts
    words = np.bincount(of_word, minlength=total).astype(np.float64)
    some = np.maximum(words, 1)
    # Bytes: the class shares of a passage, as counts per letter.  A byte belongs to the last word begun before it.
    step = 1 << 22
    new_text = np.zeros(len(data) + 1, bool)
    new_text[offsets] = True
    counts = np.zeros(total * (len(_CLASSES) + 1))
    pairs = np.zeros(total * _BINS)
    for lo in range(0, len(data), step):
        part = data[lo: lo + step + 1]
        owner = np.searchsorted(starts, np.arange(lo, min(lo + step, len(data))), "right") - 1 if len(starts) < len(part) // 64 else \
            np.cumsum(np.bincount(starts[np.searchsorted(starts, lo): np.searchsorted(starts, lo + step)] - lo, minlength=min(step, len(data) - lo))) \
            + np.searchsorted(starts, lo) - 1
        body = part[: len(owner)]
        kind = _CLASS[body]
        good = (kind >= 0) & (owner >= 0)
        passage = of_word[np.maximum(owner, 0)]
        counts += np.bincount(passage[good] * (len(_CLASSES) + 1) + kind[good], minlength=len(counts))
        low = LOWER[part].astype(np.int64)
        bins = (low[:-1] * 31 + low[1:] * 17) % _BINS
        good = good[: len(bins)] & ~new_text[lo + 1: lo + 1 + len(bins)]  # a pair lies in one text
        pairs += np.bincount(passage[: len(bins)][good] * _BINS + bins[good], minlength=len(pairs))
    counts = counts.reshape(total, -1)
    letters = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    h = word_hashes(data, starts, ends)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    order = np.lexsort((h, of_word))
    fresh = np.ones(len(h))
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
    alone = ((size == 1) & (_CLASS[data[starts]] >= 3)).astype(np.float64)
    mean = lambda v: np.bincount(of_word, weights=v, minlength=total) / some
    extra = np.stack([mean(size.astype(np.float64)) / 10, mean((size > 15).astype(np.float64)), mean(same), mean(alone),
                      np.bincount(of_word[order], weights=fresh, minlength=total) / some, np.minimum(words, PASSAGE) / PASSAGE], axis=1)
    pairs = pairs.reshape(total, -1)
    out[:] = np.concatenate([np.sqrt(counts / letters), extra, np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))], axis=1)
    return out, before


@dataclass
class Model:
    """Encoder, gated attention and scorer; ``mean`` and ``scale`` standardise the features."""
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, before: np.ndarray) -> np.ndarray:
        return _forward(self.weights, (features - self.mean) / self.scale, before)["p"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, before: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    a = (t * g) @ w["a"]
    starts, n = before[:-1], np.diff(before)
    a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), n))
    a = a / np.repeat(np.add.reduceat(a, starts), n)
    z = np.add.reduceat(h * a[:, None], starts, axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -30, 30)))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": p}


def fit(features: np.ndarray, before: np.ndarray, labels: np.ndarray, epochs: int = 60, batch: int = 128, hidden: int = 16,
        gate: int = 8, rate: float = 0.01, decay: float = 1e-4, enough: float = 0.0005, seed: int = 3) -> Model:
    """Adam on the cross-entropy of documents; the two classes weigh the same.

    Ends after ``epochs``, or when an epoch's mean loss is below ``enough``.
    """
    rng = np.random.default_rng(seed)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = ((features - mean) / scale).astype(np.float32)
    shape = {"E": (x.shape[1], hidden), "e": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "a": (gate,), "c": (hidden,), "b": ()}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32) if len(s) else np.zeros(s, np.float32) for k, s in shape.items()}
    w["e"] *= 0
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    share = max(labels.mean(), 1e-3), max(1 - labels.mean(), 1e-3)
    weight = np.where(labels == 1, 0.5 / share[0], 0.5 / share[1])
    step = 0
    for _ in range(epochs):
        loss = 0.0
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), batch):
            docs = order[lo: lo + batch]
            n = before[docs + 1] - before[docs]
            begin = np.concatenate([[0], np.cumsum(n)])
            rows = np.repeat(before[docs] - begin[:-1], n) + np.arange(begin[-1])
            xb = x[rows]
            f = _forward(w, xb, begin)
            right = np.where(labels[docs] == 1, f["p"], 1 - f["p"])
            loss -= float((weight[docs] * np.log(np.maximum(right, 1e-9))).sum())
            dz = (f["p"] - labels[docs]) * weight[docs] / len(docs)
            grad = {"c": f["z"].T @ dz, "b": dz.sum()}
            dzr = np.repeat(dz[:, None] * w["c"], n, axis=0)
            da = (f["h"] * dzr).sum(axis=1)
            da = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, begin[:-1]), n))
            tg = f["t"] * f["g"]
            grad["a"] = tg.T @ da
            dt = da[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
            dg = da[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
            grad["V"], grad["U"] = f["h"].T @ dt, f["h"].T @ dg
            dh = (dzr * f["a"][:, None] + dt @ w["V"].T + dg @ w["U"].T) * (1 - f["h"] ** 2)
            grad["E"], grad["e"] = xb.T @ dh, dh.sum(axis=0)
            step += 1
            for k in w:
                d = grad[k] + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        if loss / len(labels) < enough:
            break
    return Model(mean, scale, w)


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          most: int = MAX_TRAIN) -> Model:
    """Fits on at most ``most`` labelled documents, the first in the order of a hash of the id.

    Held-out ids, null labels and null ids are left out; an id with several
    labels counts once, with its largest.  Without both labels every document
    scores the share of label 1 (0.5 without any).
    """
    known = labels.where(~held_out(doc_id) & F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
    known = known.groupBy(F.col(f"`{doc_id}`").cast("long").alias("k")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
    picked = known.orderBy(F.xxhash64("k"), "k").limit(most)
    body = F.col(f"`{text}`")
    # At most ``most`` rows of 16 bytes are broadcast.
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("k"), body.cast("binary").alias("text")).join(F.broadcast(picked), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                features, before = encode(part.column("text"))
                blobs = [features[a:b].tobytes() for a, b in zip(before[:-1], before[1:])]
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("y"), pa.array(blobs, pa.binary())], names=["k", "y", "x"])

    # Repeated rows of an id are one document.
    bags = rows.mapInArrow(run, "k long, y int, x binary").groupBy("k").agg(F.max("y").alias("y"), F.max("x").alias("x")).toPandas().sort_values("k")
    y = bags["y"].to_numpy().astype(np.float64)
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        logit = np.log(np.clip(share, 0.01, 0.99) / (1 - np.clip(share, 0.01, 0.99)))
        none = {"E": np.zeros((N_FEATURES, 1)), "e": np.zeros(1), "V": np.zeros((1, 1)), "U": np.zeros((1, 1)), "a": np.zeros(1), "c": np.zeros(1), "b": logit}
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), none)
    bags_x = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in bags["x"]]
    before = np.concatenate([[0], np.cumsum([len(b) for b in bags_x])])
    return fit(np.concatenate(bags_x), before, y)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                   most: int = MAX_TRAIN) -> DataFrame:
    """One row ``id, of, score`` for each row of ``docs``; ``of`` is a hash of the text.

    Only the text is an input of the score.  Null and empty texts are bags of one
    empty passage and get a score like others; repeated rows get equal scores.
    Only the named columns are read, so other columns cannot clash.

    Scale: training sees a bounded sample; scoring is one pass over the texts
    without a shuffle, with the weights (some kilobytes) in the task.
    """
    model = train(docs, labels, doc_id, text, label, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                score = model.score(*encode(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("of"), pa.array(score, pa.float64())], names=["id", "of", "score"])

    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(body).alias("of"), body.cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, of long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, bound: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that score below ``bound``."""
    model = train(docs, labels, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text):
                yield part.filter(pa.array(model.score(*encode(part.column(text))) >= bound))

    return docs.mapInArrow(run, docs.schema)
