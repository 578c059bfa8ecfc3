"""The numbered queries ``opN_<name>`` and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import configure
from .chat_format import formatted_digests
from .collocations import collocations
from .decontaminate import contamination, n_covered
from .importance import importance
from .licenses import license_scan
from .line_dedup import dedup_lines
from .mixing import mix, ranked_weights
from .quality_mil import held_out, quality_scores
from .quality_rules import STOP_WORDS, quality_rules
from .simhash import near_duplicates
from .text import n_words
from .token_ids import token_ids
from .url_reputation import Rule, judge_urls
from .warc import archived


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    taken, routes = mix(sized, F.col("size"), F.array("source"), ranked_weights)
    # One source per document here: each pattern has one route.
    taken = taken.join(F.broadcast(routes.select("pattern", "source_size", "target")), "pattern")
    return taken.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(_table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary()).withColumnRenamed("id", "doc_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


URL_RULES = [Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
             Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A page's outcome is the quality label of the document whose number stands in its url.
    outcomes = _table(spark, sf_dir, "labels", "doc_id", "quality").select(F.col("doc_id").alias("page"), F.col("quality").alias("good"))
    judged = judge_urls(_table(spark, sf_dir, "pages", "page_id", "url"), outcomes, URL_RULES, by_path=True)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return formatted_digests(turns.unionByName(added)).withColumnRenamed("conv", "conv_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = contamination(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.withColumn("n_hit", n_covered()).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_paragraphs", "n_licensed", "families", "family", "probability")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents", "lang", "text"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_STOP_SQL = ", ".join(f"'{w}'" for w in sorted({w for s in STOP_WORDS.values() for w in s.split()}))

SQL = {
    "op9_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
x AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win FROM v),
s AS (SELECT DISTINCT len(win) AS m FROM x),
e AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, s WHERE len(w) >= m),
h AS (SELECT e.doc_id, e.i, e.m, x.item_id FROM e JOIN x ON list_slice(e.w, e.i, e.i + e.m - 1) = x.win),
n AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id""",
    # A feature's CRC-32 goes bit by bit, least significant first, over the hexadecimal digits of its bytes.
    "op11_importance": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
fd AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
fb AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
u AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
c AS (SELECT f, xor(list_reduce(list_transform(range(0, 4 * length(x)), lambda k: (strpos('0123456789ABCDEF', substr(x, 2 * (k // 8) + 2 - (k % 8) // 4, 1)) - 1) >> (k % 4) & 1),
  lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)), 4294967295), 4294967295) % 10000 AS bucket FROM u),
s AS (SELECT bucket, count(*) AS n FROM fd JOIN c USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM fb JOIN c USING (f) GROUP BY bucket),
z AS (SELECT (SELECT coalesce(sum(n), 0)::BIGINT FROM s) AS s, (SELECT coalesce(sum(n), 0)::BIGINT FROM t) AS t),
g AS (SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (z.s + 10000))::DOUBLE / ((s.n + 1) * (z.t + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t ON t.bucket = s.bucket, z),
m AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM fd JOIN c USING (f) JOIN g USING (bucket) GROUP BY r),
v AS (SELECT d.r, d.doc_id, len(d.w) AS n_words, coalesce(m.n, 0)::BIGINT AS n_features,
  CASE WHEN m.n IS NULL THEN 0 ELSE (m.total - ((m.total % m.n) + m.n) % m.n) // m.n END::BIGINT AS weight,
  ('0x' || left(sha256('7:' || doc_id), 8))::BIGINT AS h FROM d LEFT JOIN m ON m.r = d.r),
o AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM v),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM o WHERE n_words >= 20)
SELECT o.doc_id, o.n_features, o.weight, o.score, CASE WHEN k.rank <= 25 * k.n // 100 THEN k.rank END AS rank FROM o LEFT JOIN k ON k.r = o.r""",
    "op12_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k),
f AS (SELECT lang, phrase, k, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT f.*, x.cut, array_to_string(list_slice(string_split(phrase, ' '), 1, x.cut), ' ') AS lp,
  array_to_string(list_slice(string_split(phrase, ' '), x.cut + 1, k), ' ') AS rp FROM f, (VALUES (1), (2)) x(cut) WHERE x.cut < k),
s AS (SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.lp JOIN f r ON r.lang = c.lang AND r.phrase = c.rp),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM s) WHERE nth = 1),
i AS (SELECT lang, a, unnest([array_to_string(list_slice(string_split(phrase, ' '), 1, 2), ' '),
  array_to_string(list_slice(string_split(phrase, ' '), 2, 3), ' ')]) AS phrase FROM f WHERE k = 3),
x AS (SELECT lang, phrase, max(a) AS around FROM i GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN x ON x.lang = b.lang AND x.phrase = b.phrase WHERE x.around IS NULL OR 100 * x.around < 50 * b.a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, t.n, o.score FROM o JOIN t ON t.lang = o.lang WHERE o.rank <= 2000""",
    "op13_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
k AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN octet_length(body) >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM k""",
    "op5_url_reputation": r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
l AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
q AS (SELECT host, l.good, CASE WHEN regexp_matches(host, '(^|\.)(ac|co|com|edu|gov|net|org)\.[a-z][a-z]$')
  THEN regexp_extract(host, '(?:^|\.)((?:ac|co|com|edu|gov|net|org)\.[a-z][a-z])$', 1) ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix
  FROM p LEFT JOIN l ON l.doc_id = TRY_CAST(regexp_extract(p.path, '^/[a-z]+/([0-9]+)', 1) AS BIGINT)),
d AS (SELECT *, left(host, greatest(length(host) - length(suffix) - 1, 0)) AS rest FROM q),
h AS (SELECT host, suffix, CASE WHEN rest <> '' THEN regexp_extract(rest, '([^.]*)$', 1) || '.' || suffix ELSE host END AS domain,
  count(good) AS n, coalesce(sum(good), 0) AS g FROM d GROUP BY ALL),
dm AS (SELECT domain, suffix, sum(n) AS n, sum(g) AS g FROM h GROUP BY ALL),
sf AS (SELECT suffix, sum(n) AS n, sum(g) AS g FROM dm GROUP BY ALL),
ht AS (SELECT sum(n) AS n, sum(g) AS g, sum(g)::DOUBLE / nullif(sum(n), 0) AS m FROM h),
hs AS (SELECT any_value(t.n) AS n, any_value(t.m) AS m, count(*) AS k, sum(x.n * x.n) AS nn, sum(x.n * pow(x.g::DOUBLE / x.n - t.m, 2)) AS s
  FROM h x, ht t WHERE x.n > 0),
hr AS (SELECT CASE WHEN m * (1 - m) * (n - nn::DOUBLE / n - (k - 1)) > 0
  THEN (s - m * (1 - m) * (k - 1)) / (m * (1 - m) * (n - nn::DOUBLE / n - (k - 1))) ELSE 0 END AS rho FROM hs),
hk AS (SELECT CASE WHEN rho > 0 THEN least(1000.0, greatest(2.0, 1 / rho - 1)) ELSE 1000.0 END AS k FROM hr),
dmt AS (SELECT sum(n) AS n, sum(g) AS g, sum(g)::DOUBLE / nullif(sum(n), 0) AS m FROM dm),
dms AS (SELECT any_value(t.n) AS n, any_value(t.m) AS m, count(*) AS k, sum(x.n * x.n) AS nn, sum(x.n * pow(x.g::DOUBLE / x.n - t.m, 2)) AS s
  FROM dm x, dmt t WHERE x.n > 0),
dmr AS (SELECT CASE WHEN m * (1 - m) * (n - nn::DOUBLE / n - (k - 1)) > 0
  THEN (s - m * (1 - m) * (k - 1)) / (m * (1 - m) * (n - nn::DOUBLE / n - (k - 1))) ELSE 0 END AS rho FROM dms),
dmk AS (SELECT CASE WHEN rho > 0 THEN least(1000.0, greatest(2.0, 1 / rho - 1)) ELSE 1000.0 END AS k FROM dmr),
sft AS (SELECT sum(n) AS n, sum(g) AS g, sum(g)::DOUBLE / nullif(sum(n), 0) AS m FROM sf),
sfs AS (SELECT any_value(t.n) AS n, any_value(t.m) AS m, count(*) AS k, sum(x.n * x.n) AS nn, sum(x.n * pow(x.g::DOUBLE / x.n - t.m, 2)) AS s
  FROM sf x, sft t WHERE x.n > 0),
sfr AS (SELECT CASE WHEN m * (1 - m) * (n - nn::DOUBLE / n - (k - 1)) > 0
  THEN (s - m * (1 - m) * (k - 1)) / (m * (1 - m) * (n - nn::DOUBLE / n - (k - 1))) ELSE 0 END AS rho FROM sfs),
sfk AS (SELECT CASE WHEN rho > 0 THEN least(1000.0, greatest(2.0, 1 / rho - 1)) ELSE 1000.0 END AS k FROM sfr),
ms AS (SELECT suffix, (g + sfk.k * coalesce(sft.m, 0.5)) / (n + sfk.k) AS m FROM (SELECT * FROM sf) x, sfk, (SELECT m FROM sft) sft),
md AS (SELECT x.domain, x.suffix, (x.g + dmk.k * ms.m) / (x.n + dmk.k) AS m FROM dm x JOIN ms ON ms.suffix = x.suffix, dmk),
ab AS (SELECT h.host, hk.k * md.m + h.g AS a, hk.k * (1 - md.m) + h.n - h.g AS b FROM h JOIN md ON md.domain = h.domain AND md.suffix = h.suffix, hk),
v AS (SELECT host, CASE WHEN a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) < 0.6 THEN 'block' ELSE 'allow' END AS verdict FROM ab),
r(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
  row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS nth
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT f.page_id, f.host, f.path, f.rule, coalesce(f.verdict, v.verdict) AS verdict FROM f JOIN v ON v.host = f.host WHERE nth = 1""",
    "op6_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w),
h AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win FROM g),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM h) WHERE n > 1),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
i AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS k FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
  coalesce(list_sum([length(x) for x in words]), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (length(text) - length(replace(text, '!', '')))::BIGINT AS n_bangs,
  coalesce(i.n - i.k, 0)::BIGINT AS n_dup_lines, coalesce(i.n, 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
  len([x for x in words if lower(x) IN ({_STOP_SQL})])::BIGINT AS n_stop
  FROM w LEFT JOIN i ON i.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 12.0 * n_words
  AND n_symbols::DOUBLE / n_words <= 0.1 AND n_bangs::DOUBLE / n_words <= 0.2 AND n_stop::DOUBLE / n_words >= 0.05
  AND coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0) <= 0.5, true) AND n_repeat_words::DOUBLE / n_words <= 0.5 AS kept
FROM b""",
    "op7_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, '<turn:' || regexp_replace(role, '([\\<>])', '\\\1', 'g') || '>' || chr(10)
  || regexp_replace(text, '([\\<>])', '\\\1', 'g') || '</turn>' || chr(10) AS made FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(made))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op8_line_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, coalesce(k.doc_id > s.keeper, false) AS gone FROM k LEFT JOIN s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_quality_mil": op2_quality_mil,
    "op3_token_ids": op3_token_ids,
    "op4_simhash": op4_simhash,
    "op5_url_reputation": op5_url_reputation,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_license_scan": op10_license_scan,
    "op11_importance": op11_importance,
    "op12_collocations": op12_collocations,
    "op13_warc": op13_warc,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
