"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]
SCHEMA = "doc_id long, text string, source string, row string, id int, h int, of int, n_words int, kept string, score int, fingerprint string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    words = ["the", "of", "And", "river", "Stone", "über", "élan", "window", "in", "to", "paper", "9th", "day", "niño", "tree."]
    return " ".join(r.choice(words) + (r.choice("abcdefgh") * r.randint(0, 2)) for _ in range(n))


def nasty(spark):
    """Null, empty, blank, very long, repeated and shared texts; null and repeated ids; clashing names."""
    shared = "A line that Many documents share\n"
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, prose(30_000, 1)), (5, shared + prose(80, 2)), (6, shared.upper() + prose(90, 3)),
        (7, prose(80, 2)), (8, prose(80, 2)), (8, prose(80, 2)), (9, prose(60, 4)), (9, prose(60, 5)), (None, shared + prose(70, 6)),
        (None, None), (10, "one two"), (11, "word"), (12, "\n\n" + shared + shared + "\n"), (13, "x" * 100_000), (14, "日本語 テキスト\n" * 3),
        (15, "A\x00b ### $$$ | <b>\r\n" * 40), (16, prose(500, 7) + "\n" + shared)]
    return spark.createDataFrame([(i, t, ["a", "b", None, "c"][k % 4], "r", 1, 2, 3, 4, "k", 5, "f") for k, (i, t) in enumerate(texts)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con
