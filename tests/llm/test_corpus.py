"""Importance resampling, collocations and WARC archives on hard rows, against plain Python."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from salesmart.llm import bytescan, collocations, importance, warc
from salesmart.session import staging_dir

from .common import collected, empty, lower, nasty, prose

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# stretches of texts ------------------------------------------------------------------


def test_a_long_word_has_the_hash_of_its_chunks(monkeypatch):
    data = np.frombuffer(("Word " + "aBc" * 500 + " x " + "é" * 300).encode(), np.uint8)
    starts, ends, _ = bytescan.spans(data, np.array([0, len(data)]), bytescan.LETTERS)
    whole = bytescan.word_hashes(data, starts, ends)
    monkeypatch.setattr(bytescan, "_CHUNK", 64)
    monkeypatch.setattr(bytescan, "_TABLES", [])
    assert (bytescan.word_hashes(data, starts, ends) == whole).all()
    assert max(map(len, bytescan._TABLES)) == 65  # tables do not grow with a word


@pytest.mark.parametrize("most", [1, 7, 64, 5000])
@pytest.mark.parametrize("overlap", [0, 1, 2])
def test_stretches_lose_no_word_and_no_run(most, overlap):
    r = random.Random(most)
    texts = [None, "", "  ", "word", "x" * 200] + ["".join(r.choice("ab é.") for _ in range(r.randint(0, 300))) for _ in range(20)]
    batch = pa.record_batch({"text": pa.array([None if t is None else t.encode() for t in texts], pa.binary())})
    runs = [[] for _ in texts]
    for data, offsets, rows, old in bytescan.stretches(batch, "text", bytescan.LETTERS, overlap, most):
        for k, row in enumerate(rows.tolist()):
            words = TOKEN.findall(bytes(data[offsets[k]: offsets[k + 1]]).decode())
            runs[row] += [tuple(words[i - overlap: i + 1]) for i in range(max(overlap, int(old[k])), len(words))]
    for t, got in zip(texts, runs):
        words = TOKEN.findall(t or "")
        assert got == [tuple(words[i - overlap: i + 1]) for i in range(overlap, len(words))]


# importance resampling ---------------------------------------------------------------


def _features(text, most=2):
    words = TOKEN.findall(lower(text or ""))
    return [" ".join(words[i: i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def _crcs(texts, most=2):
    found = [[] for _ in texts]
    batch = pa.record_batch({"text": pa.array([None if t is None else t.encode() for t in texts], pa.binary())})
    for rows, crcs, _ in importance.feature_crcs(batch, "text", most):
        for i, c in zip(rows.tolist(), crcs.tolist()):
            found[i].append(c)
    return [sorted(f) for f in found]


@pytest.mark.parametrize("most", [1, 2, 4])
def test_prefix_crcs_are_those_of_the_runs(most):
    r = random.Random(3)
    texts = [None, "", " . ", "Word", "y" * 3000 + " q " + "Z" * 70_000 + " end"]
    texts += ["".join(r.choice("ab cÜ.Z9\n日 ") for _ in range(r.randint(0, 400))) for _ in range(50)]
    assert _crcs(texts, most) == [sorted(zlib.crc32(f.encode()) for f in _features(t, most)) for t in texts]


def test_crcs_do_not_depend_on_the_cuts(monkeypatch):
    text = prose(4000, 5)
    whole = _crcs([text, "one two"])
    cut = bytescan.stretches
    monkeypatch.setattr(importance, "stretches", lambda batch, column, admits, overlap: cut(batch, column, admits, overlap, 100))
    assert _crcs([text, "one two"]) == whole


def _importance(rows, targets, buckets=10_000, percent=25):
    """Plain Python: one tuple a row, rank None where not drawn."""
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in _features(t))
    s, t = count(x for _, x in rows), count(targets)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for i, text in rows:
        found = _features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(TOKEN.findall(lower(text or ""))), len(found), weight, score, None])
    fit = sorted((o for o in out if o[1] >= 20), key=lambda o: (-o[4], o[0] is None, o[0] or 0, o[2]))
    for k, o in enumerate(fit[: percent * len(fit) // 100], 1):
        o[5] = k
    return Counter(map(tuple, out))


def test_importance_against_plain_python(spark):
    docs = nasty(spark)
    more = [(100 + i, prose(20 + i % 40, i)) for i in range(60)] + [(100, prose(20, 0))]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    targets = [prose(300, 900), None, "", "river Stone"]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = importance.importance(docs, target).select("id", "n_words", "n_features", "weight", "score", "rank")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert collected(got) == _importance(rows, targets)
    half = importance.importance(docs.repartition(5), target, percent=50, buckets=97).select("id", "n_words", "n_features", "weight", "score", "rank")
    assert collected(half) == _importance(rows, targets, 97, 50)
    drawn = importance.resample(docs, target)
    assert drawn.columns == docs.columns
    ranked = importance.importance(docs, target).where("rank IS NOT NULL")
    chosen = {(r.id, r.of) for r in ranked.collect()}
    assert drawn.select("doc_id").distinct().count() == len({i for i, _ in chosen}) and drawn.count() >= len(chosen)


def test_importance_of_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.importance(empty(spark), none).count() == 0
    assert importance.resample(empty(spark), none).count() == 0
    assert collected(importance.importance(nasty(spark), none).select("id", "n_words", "n_features", "weight", "score", "rank")) == _importance(
        [(r.doc_id, r.text) for r in nasty(spark).collect()], [])


# collocations ------------------------------------------------------------------------


def _collocations(rows, most, least, covered, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                f[lang].update(tuple(words[i: i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in good.items():
            score, cut = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = lambda q: len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))  # noqa: E731, B023
            if not any(100 * b >= covered * a and inside(q) for q, b in good.items()):
                found.append((score, a, " ".join(p), counts[p[:cut]], counts[p[cut:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k, p, a, l, r, n[lang], s) for k, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return Counter(out)


def _spoken(seed):
    r = random.Random(seed)
    words = ["New", "york", "city", "über", "of", "the", "hot", "dog", "a", "日本", "x1"]
    return "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ? "]) for _ in range(120))


@pytest.mark.parametrize(("most", "least", "shards", "top"), [(3, 4, 4, 2000), (4, 6, 8, 20), (2, 5, 1, 7), (3, 10, 3, 50)])
def test_collocations_against_plain_counts(spark, most, least, shards, top):
    rows = [(["en", "fr", None, "und"][k % 4], _spoken(k)) for k in range(60)] + [("en", None), (None, ""), ("de", " . "), ("en", "new york new york new york " * 50)]
    rows += [("xx", "never twice"), ("en", _spoken(1)), ("en", _spoken(1))]
    docs = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "lang string, text string, phrase string, n int").repartition(7)
    got = collocations.collocations(docs, most=most, least=least, shards=shards, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collected(got) == _collocations(rows, most, least, 50, top)


def test_collocations_do_not_depend_on_the_cuts(spark, monkeypatch):
    docs = spark.createDataFrame([("en", _spoken(3) * 30), ("en", "y" * 5000 + " new york " * 40)], "lang string, text string")
    want = _collocations([tuple(r) for r in docs.collect()], 3, 4, 50, 2000)
    texts = pa.record_batch({"text": pa.array([r.text.encode() for r in docs.collect()], pa.binary())})
    whole = [collocations._hashes(s, np.zeros(2, np.uint64))[s.runs(3)].tolist() for s in collocations._stretches(texts, 2)]
    monkeypatch.setattr(collocations, "_STRETCH", 64)
    cut = [collocations._hashes(s, np.zeros(2, np.uint64))[s.runs(3)].tolist() for s in collocations._stretches(texts, 2)]
    assert len(cut) > 10 and sorted(sum(cut, [])) == sorted(sum(whole, []))
    assert collected(collocations.collocations(docs, least=4)) == want


def test_collocations_of_hard_rows(spark):
    docs = nasty(spark).withColumnRenamed("source", "lang")
    assert collected(collocations.collocations(docs, least=3)) == _collocations([(r.lang, r.text) for r in docs.collect()], 3, 3, 50, 2000)
    assert collocations.collocations(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        collocations.phrase_counts(docs, shards=9)


def test_support_is_lowered_enough_for_the_worst_deal(spark):
    """Ten finds dealt as evenly as can be over the shards still reach the support of one."""
    for shards in range(1, collocations.MAX_SHARDS + 1):
        assert max(len(range(k, 10, shards)) for k in range(shards)) >= -(-10 // shards)


# WARC --------------------------------------------------------------------------------


def _pages():
    long, other = "<p>same payload</p>" * 80, "é<b>\0</b>" * 200
    rows = [(k, f"http://h{k % 7}.example/{k}", f"<html>{prose(60 + k % 50, k)}</html>" * 3) for k in range(1, 120)]
    return rows + [(200, "http://a/\r\nX: y", long), (201, None, long), (None, "http://n/", long), (202, "http://b b/", long), (202, "http://b b/", long),
                   (203, "", other), (204, "u", other + "!"), (205, "u", None), (206, "u", ""), (207, "u", "short"), (208, "u", "short"),
                   (None, "u", "z" * 2000), (None, None, "z" * 2000), (-5, "u", "x" * 999), (-4, "u", "x" * 999), (-3, "u", "y" * 1000), (-2, "u", "y" * 1000),
                   (300, "big", "0123456789" * 300_000)]


def _archived(rows, least=1000):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        top = last.get(html or "") if len(body) >= least else None
        again = top is not None and i != top
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return Counter(out)


def test_archives_of_hard_pages(spark):
    rows = _pages()
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, same string").repartition(3)
    folder = staging_dir(spark, "warc-test")
    got = warc.archived(pages, folder=folder, file_bytes=40_000)
    assert collected(got.drop("url")) == _archived(rows)
    urls = {(r.page_id, r.url) for r in got.where("page_id < 3 OR page_id = 200").collect()}
    assert {(1, "http://h1.example/1"), (200, "http://a/%0D%0AX:%20y")} <= urls
    assert warc.archived(pages.limit(0)).count() == 0


def test_any_zstd_reader_that_is_given_the_dictionary_reads_the_files(spark):
    rows = _pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = staging_dir(spark, "warc-files")
    warc.write_warc(pages.coalesce(1), folder, file_bytes=1 << 30)
    body = bytes(spark.read.format("binaryFile").load(folder).where("length > 0").first().content)
    assert int.from_bytes(body[:4], "little") == 0x184D2A5D
    size = int.from_bytes(body[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(body[8: 8 + size]))
    # Each record is one frame: they open one by one, at any frame's start.
    rest, texts = body[8 + size:], []
    while rest:
        if rest[:4] == (0x184D2A50).to_bytes(4, "little"):
            rest = rest[8 + int.from_bytes(rest[4:8], "little"):]
            continue
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        texts.append(frame.decompress(rest))
        rest = frame.unused_data
    assert len(texts) == len(rows) and all(t.startswith(b"WARC/1.1\r\n") and t.endswith(b"\r\n\r\n") for t in texts)
    small = sum(len(t) for t in texts if len(t) < 10_000)
    plain = sum(len(zstandard.ZstdCompressor().compress(t)) for t in texts if len(t) < 10_000)
    packed = sum(len(zstandard.ZstdCompressor(dict_data=dictionary).compress(t)) for t in texts if len(t) < 10_000)
    assert packed < plain < small  # what the dictionary is for


def test_a_payload_that_was_changed_is_noticed():
    payload = b"<html>payload</html>"
    made = warc.record(7, "http://x/", payload, len(payload), hashlib.sha1(payload).hexdigest(), "2000-01-01T00:00:00Z")
    read = lambda b: list(warc.records(io.BufferedReader(io.BytesIO(b))))
    (fields, size, digest), = read(made)
    assert (fields["warc-type"], size, base64.b32decode(digest).hex()) == ("response", len(payload), hashlib.sha1(payload).hexdigest())
    with pytest.raises(ValueError, match="digest"):
        read(made.replace(b"<html>p", b"<html>q"))
    with pytest.raises(ValueError, match="short"):
        read(made[: -10])


def test_without_samples_there_is_no_dictionary(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", "")], "page_id long, url string, html string")
    folder = staging_dir(spark, "warc-plain")
    got = warc.archived(pages, folder=folder)
    assert collected(got.drop("url")) == _archived([(1, "u", None), (2, "u", "")])
    bodies = [bytes(r.content) for r in spark.read.format("binaryFile").load(folder).where("length > 0").collect()]
    assert bodies and all(b[:4] == b"\x28\xb5\x2f\xfd" for b in bodies)
