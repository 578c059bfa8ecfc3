"""SimHash, decontamination, mixing, classifier, token ids and chat on hard rows, against plain Python."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from salesmart.llm import chat_format, mixing, quality_mil, simhash, simple8b, token_ids
from salesmart.llm.decontaminate import contamination, decontaminate, n_covered
from salesmart.llm.queries import vocabulary
from salesmart.session import staging_dir

from .common import WORD, collected, empty, lower, nasty, prose

# SimHash ------------------------------------------------------------------------


def _fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps, bits):
    roots = {f: f for f in fps}

    def find(f):
        while roots[f] != f:
            f = roots[f]
        return f

    for a in roots:
        for b in roots:
            if (a ^ b).bit_count() <= bits:
                roots[find(a)] = find(b)
    return {f: find(f) for f in roots}


def test_simhash_against_all_pairs(spark):
    docs = nasty(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [_fingerprint(t) for _, t in rows]
    root = _components(fps, 2)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((str(i), f"{f:016x}", str(least.get(root[f]))) for (i, _), f in zip(rows, fps))
    got = simhash.near_duplicates(docs).select("id", "fingerprint", "component_id")
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got.collect()) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_no_link_is_lost(spark, bits):
    r = random.Random(bits)
    fps = set()
    for _ in range(40):
        f = r.getrandbits(64)
        for _ in range(12):  # chains: each a few bits from the one before
            fps.add(f)
            for _ in range(r.randint(1, 4)):
                f ^= 1 << r.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = {(a, b) for k, a in enumerate(fps) for b in fps[k + 1:] if (a ^ b).bit_count() <= bits}
    edges = simhash.links(df, bits)
    got = {tuple(sorted(v % 2**64 for v in row)) for row in edges.collect()}
    assert got == want
    roots = {r.node % 2**64: r.root % 2**64 for r in simhash.components(edges).collect()}
    plain = _components(fps, bits)
    assert all((roots.get(a, a) == roots.get(b, b)) == (plain[a] == plain[b]) for a in fps for b in fps)


def test_the_exploded_keys_are_not_broadcast(spark):
    fps = spark.createDataFrame([(n << 8,) for n in range(50)], "fp long")
    plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()  # a table far below the broadcast threshold
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_one_of_each_group_stays(spark):
    docs = nasty(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = simhash.near_duplicates(docs).select("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint"))).distinct().count()
    assert kept.count() == groups
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 9, 13}
    assert simhash.keep_one(empty(spark)).count() == 0


def test_a_long_text_in_parts_has_the_same_fingerprint(monkeypatch):
    text = prose(3000, 9)
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_BLOCK", 100)
    assert simhash.fingerprint(text.encode()) == whole == _fingerprint(text)
    r = random.Random(3)
    texts = ["".join(r.choice(["a", "B", "longer", " ", "\n", "\t ", "é", "w" * 90]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    monkeypatch.setattr(simhash, "_PIECE", 7)  # joins up to 28 bytes
    for t in [*texts, " " * 50, "x" * 50, text[:2000]]:
        assert simhash.fingerprint(t.encode()) == _fingerprint(t)
        assert simhash.fingerprint(t.encode(), 1) == simhash.fingerprint(pa.py_buffer(t.encode()), 1)


def _peak(f, *args) -> int:
    tracemalloc.start()
    try:
        f(*args)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_long_text_is_bounded():
    text = (prose(3000, 9) + " ").encode() * 500
    assert len(text) > 8 << 20
    assert _peak(simhash.fingerprint, text) < 96 << 20
    word = b"x" * (24 << 20)
    assert _peak(simhash.fingerprint, b"a b " + word + b" c d") < 3.2 * len(word)


# decontamination ------------------------------------------------------------------

TOKEN = __import__("re").compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _contaminated(rows, items, size=10):
    windows = {}
    for i, t in items:
        words = TOKEN.findall(lower(t or ""))
        m = min(size, len(words))
        for k in range(len(words) - m + 1 if m else 0):
            windows.setdefault(tuple(words[k: k + m]), set()).add(str(i))
    out = []
    for i, t in rows:
        words, hit, found = TOKEN.findall(lower(t or "")), set(), set()
        for m in {len(w) for w in windows}:
            for k in range(len(words) - m + 1):
                if (w := tuple(words[k: k + m])) in windows:
                    hit |= set(range(k, k + m))
                    found |= windows[w] - {"None"}
        out.append((str(i), len(words), len(hit), ",".join(sorted(found))))
    return sorted(out)


def test_contamination_against_all_windows(spark):
    passage = prose(40, 77)
    items = [(1, passage), (2, passage[3:]), (10, "short Item"), (11, "word"), (12, None), (13, ""), (None, "null id item"), (14, "  ...  "),
             (15, "the the the the the the the the the the the the"), (3, prose(30_000, 1)[500:900])]
    docs = nasty(spark)
    more = [(50, "Before. " + passage + " after " + passage.upper()), (51, "a SHORT, item!"), (51, "a SHORT, item!"), (52, passage[:60]),
            (53, "the " * 25), (54, "x the " + " ".join(passage.split()[5:20])), (55, "null id item")]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, hash int")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = contamination(docs, bench).select("id", "n_words", n_covered().alias("n"), F.array_join("items", ",").alias("items")).collect()
    want = _contaminated(rows, items)
    assert sorted((str(r.id), r.n_words, r.n, r["items"]) for r in got) == want
    clean = decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(i for i, _, n, _ in want if not n)


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(empty(spark), none).count() == 0
    assert decontaminate(nasty(spark), none).count() == nasty(spark).count()
    assert contamination(empty(spark), spark.createDataFrame([(1, prose(20, 3))], "item_id long, text string")).count() == 0


# mixing ----------------------------------------------------------------------------


def test_targets_stop_at_three_times_the_size():
    assert mixing.capped_targets({"a": 10, "b": 1000}, {"a": 1, "b": 1}, 3, 1010) == {"a": 30.0, "b": 980.0}
    assert mixing.capped_targets({"a": 0}, {"a": 1}, 3, 0) == {"a": 0.0}


def test_flow_is_cheapest():
    # The shared pattern must serve b, though a could take it first.
    flow = mixing.cheapest_flow({("a",): 100, ("a", "b"): 100}, {"a": 100, "b": 100}, 3)
    assert flow[("a",)]["a"] == pytest.approx(100) and flow[("a", "b")]["b"] == pytest.approx(100)
    again = mixing.cheapest_flow({("a",): 100, ("a", "b"): 50}, {"a": 60, "b": 150}, 3)
    assert again[("a", "b")] == {"a": pytest.approx(0), "b": pytest.approx(150)} and again[("a",)]["a"] == pytest.approx(60)
    # Repetition is spread: nobody is used a third time while another was used once.
    even = mixing.cheapest_flow({("a",): 10, ("a", "b"): 10}, {"a": 40, "b": 0}, 3)
    assert sorted(sum(f.values()) for f in even.values()) == [pytest.approx(20), pytest.approx(20)]


def _mixed(spark, docs):
    taken, routes = mixing.mix(docs, F.size(F.split("text", " ")), F.array("source"), mixing.ranked_weights)
    return taken, routes


def test_mix_meets_targets_and_repeats_itself(spark):
    r = random.Random(4)
    rows = [(i, "w " * r.randint(1, 60) + "w", r.choice(["a", "a", "a", "b", "c", None])) for i in range(4000)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, source string")
    taken, routes = _mixed(spark, docs)
    got = taken.select("row.doc_id", "row.source", "size", "copies").collect()
    assert len(got) == 4005 and all(0 <= g.copies <= 3 for g in got)
    targets = {r.source: r.target for r in routes.collect()}
    words = sum(g["size"] for g in got)
    assert sum(targets.values()) == pytest.approx(words)
    for source, target in targets.items():
        assert abs(sum(g["size"] * g.copies for g in got if g.source == source) - target) <= 120
    again, _ = _mixed(spark, docs.repartition(7))
    assert collected(again.select("row.doc_id", "size", "copies")) == collected(taken.select("row.doc_id", "size", "copies"))


def test_mix_of_hard_rows(spark):
    docs = nasty(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert max(collected(out.select("doc_id", "text")).values()) <= 3 * max(collected(docs.select("doc_id", "text")).values())
    assert mixing.mixed_documents(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert mixing.mixed_documents(nothing).count() == 0


def test_overlapping_sources(spark):
    rows = [(i, ["a"], 10) for i in range(300)] + [(300 + i, ["a", "b"], 10) for i in range(100)] + [(500, [], 10), (501, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, belongs array<string>, size int")
    taken, routes = mixing.mix(docs, F.col("size"), F.col("belongs"), lambda s: {"a": 1.0, "b": 1.0})
    sent = {(tuple(r.pattern), r.source): r.words for r in routes.collect()}
    assert sent[(("sa", "sb"), "b")] == pytest.approx(2000) and sent[(("sa",), "a")] + sent[(("sa", "sb"), "a")] == pytest.approx(2000)
    copies = {r.doc_id: r.copies for r in taken.select("row.doc_id", "copies").collect()}
    assert all(copies[i] == 2 for i in range(300, 400)) and copies[500] == copies[501] == 0


# classifier ------------------------------------------------------------------------


def test_attention_finds_the_bad_passage():
    r = random.Random(8)
    texts, labels = [], []
    for i in range(300):
        good = [prose(48, 1000 + 7 * i + k) for k in range(r.randint(1, 5))]
        if i % 3 == 0:
            good[r.randrange(len(good))] = " ".join(f"{w}###" for w in prose(48, i).split())
        texts.append("\n".join(good))
        labels.append(float(i % 3 != 0))
    x, before = quality_mil.encode(pa.array(texts[:200]))
    model = quality_mil.fit(x, before, np.array(labels[:200]))
    score = model.score(*quality_mil.encode(pa.array(texts[200:])))
    assert ((score >= 0.3) == (np.array(labels[200:]) == 1)).mean() > 0.97


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    x, before, y = r.normal(size=(9, quality_mil.N_FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    a = quality_mil.fit(x, before, y, epochs=60, batch=3, enough=0.0)
    assert np.round(a.score(x, before)).tolist() == [1, 0, 1]


def test_encoding_does_not_depend_on_the_batch():
    texts = [None, "", prose(500, 1), "a b", " ", "x" * 50_000, prose(100, 2)]
    whole, before = quality_mil.encode(pa.array(texts))
    assert np.diff(before).tolist() == [1, 1, 11, 1, 1, 1, 3]
    for i, t in enumerate(texts):
        alone, _ = quality_mil.encode(pa.array([t], pa.string()))
        assert np.allclose(whole[before[i]: before[i + 1]], alone, atol=1e-6)


def test_scores_of_hard_rows(spark):
    docs = nasty(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 17)] + [(None, 1, 0), (5, None, 0), (5, 1, 0)], "doc_id long, quality int, text int")
    got = quality_mil.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.id == 8}) == 1
    assert quality_mil.keep_good(docs, labels, 0.0).columns == docs.columns
    assert quality_mil.keep_good(docs, labels, 0.0).count() == docs.count()
    none = labels.limit(0)
    assert {round(r.score, 6) for r in quality_mil.quality_scores(docs, none).collect()} == {0.5}
    assert quality_mil.quality_scores(empty(spark), none).count() == 0


def test_held_out_labels_are_not_learned(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, prose(60, i)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    assert {round(r.score, 6) for r in quality_mil.quality_scores(docs, labels).collect()} == {0.5}


# token ids ---------------------------------------------------------------------------


@pytest.mark.parametrize("top", [1, 2, 255, 50_257, 2**31, 2**60, 2**64])
def test_simple8b_round_trip(top):
    r = np.random.default_rng(5)
    for n in (0, 1, 59, 4096, 4097, 9000):
        values = r.integers(0, top, n, dtype=np.uint64, endpoint=False)
        ids, docs, lengths = simple8b.read_file(simple8b.file_bytes(values, [3, None], [n, 0]))
        assert (ids == values).all() and docs == [3, None] and lengths.tolist() == [n, 0]


def test_simple8b_packs():
    assert len(simple8b.encode_blocks(np.zeros(1024, np.uint64))[0]) < 160
    mixed = np.array([1, 2**63, 0, 7, 2**60, 5] * 100, np.uint64)
    assert (simple8b.decode_blocks(simple8b.encode_blocks(mixed)[0], np.array([0])) == mixed).all()
    with pytest.raises(ValueError):
        simple8b.read_file(b"S8BIDS01 broken")


def _same_ids(encode, texts):
    ids, lengths = encode(pa.array([None, *texts, ""]))
    want = encode.whole(texts)
    return ids.astype("<u4").tobytes() == b"".join(want) and lengths.tolist() == [0, *[len(w) // 4 for w in want], 0]


def test_piecewise_ids_are_the_library_s():
    r = random.Random(6)
    bits = ["a", "foo", "Bar", " ", "  ", "\n", "\n\n", "\t", " ", "é", "!", "'s", "1", "\0", "<|endoftext|>", "　", "\x1c", "\x85", "日本", " x", "\r\n"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(5000)]
    encode = token_ids.Encoder(vocabulary())
    assert encode.by_piece
    assert _same_ids(encode, texts)


def test_the_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_BYTES", 20_000)
    encode = token_ids.Encoder(vocabulary())
    for lo in range(0, 600, 60):
        assert _same_ids(encode, [prose(30, i) for i in range(lo, lo + 60)])
    held = encode.pieces.nbytes + encode.flat.nbytes + encode.size.nbytes
    assert 0 < held <= 40_000  # what one call may add comes on top


def test_token_files_of_hard_rows(spark):
    docs = nasty(spark)
    folder = staging_dir(spark, "ids")
    files = token_ids.write_token_files(docs, vocabulary(), folder, file_ids=5000)
    got = token_ids.read_token_files(spark, folder).collect()
    whole = token_ids.Encoder(vocabulary()).whole
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in docs.collect())
    start = 0
    want = []
    for (known, i), text in rows:
        ids = whole([text])[0] + np.array([2], "<u4").tobytes()
        want.append((i if known else None, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    assert files.count() > 1 and files.agg(F.sum("n_ids")).first()[0] == start
    assert token_ids.token_ids(empty(spark), vocabulary()).count() == 0


# chat --------------------------------------------------------------------------------


def test_marks_and_escapes_round_trip():
    r = random.Random(2)
    for _ in range(300):
        roles, texts = (["".join(r.choice("\\<>/\né日a:") for _ in range(r.randint(0, 9))) for _ in range(5)] for _ in range(2))
        made, start, end = chat_format.assemble(pa.array(roles), pa.array(texts))
        for i in range(5):
            data = made[i].as_py()
            assert chat_format.parse_turn(data) == (roles[i].encode(), texts[i].encode())
            assert chat_format.unescaped(data[start[i]: end[i]]) == texts[i].encode()
            assert data.count(b"</turn>\n") == 1 + data[: -len(chat_format.CLOSE)].count(b"</turn>\n")
            assert b"</turn>" not in data[start[i]: end[i]]


def test_blocks_do_not_change_turns(monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("\\\\\\<>\né日a") for _ in range(r.randint(0, 40))) for _ in range(400)]
    whole = chat_format.assemble(pa.array(["r<"] * 400), pa.array(texts))
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(chat_format, "_BLOCK", size)
        made, start, end = chat_format.assemble(pa.array(["r<"] * 400), pa.array(texts))
        assert made == whole[0] and (start == whole[1]).all() and (end == whole[2]).all()
        for data, t in zip(made.to_pylist(), texts):
            assert chat_format.parse_turn(data) == (b"r<", t.encode()) and chat_format._chars(data) == len(data.decode())


def test_memory_of_a_long_turn_is_bounded():
    text = "a line <of> text\n" * (1 << 20)
    roles, texts = pa.array(["assistant"]), pa.array([text])
    assert _peak(chat_format.assemble, roles, texts) < 2.5 * 18 * (1 << 20) + (32 << 20)
    data = chat_format.assemble(roles, texts)[0][0].as_py()
    assert _peak(lambda: sum(map(len, chat_format._unescaped(memoryview(data))))) < 16 << 20


def test_chat_of_hard_rows(spark):
    import hashlib

    long = "x<\\" * 40_000
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "a"), (1, 2, "assistant", "</turn>\n<turn:user>\n"), (2, 0, "assistant", long),
            (2, 0, "assistant", long), (None, 0, "assistant", "n"), (None, None, "user", ""), (3, 5, "a>\nb", "\\"), (4, 1, "assistant", "日本")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    got = {r.conv: r for r in chat_format.formatted_digests(turns).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: [(v is not None, v if v is not None else 0) if k < 1 else (v is not None, v or "") for k, v in enumerate(x[1:])])
        told = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        learned = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        esc = lambda s: "".join("\\" + c if c in "\\<>" else c for c in s or "")
        formatted = "".join(f"<turn:{esc(x[2])}>\n{esc(x[3])}</turn>\n" for x in mine)
        assert r.n_turns == len(mine) and r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted))
    assert chat_format.formatted_digests(turns.limit(0)).count() == 0


