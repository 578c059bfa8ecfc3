"""Line dedup, quality rules, licences and URL reputation on hard rows, against plain Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesmart.llm import licenses
from salesmart.llm.line_dedup import dedup_lines
from salesmart.llm.quality_rules import THRESHOLDS, quality_rules
from salesmart.llm.url_reputation import MAX_RULES, Rule, judge_urls

from .common import WORD, collected, empty, lower, nasty

SPACES = " \t\n\x0b\x0c\r"


def _deduped(rows, min_docs=2):
    keys = {}
    top = 2**63 - 1
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(SPACES))
            if len(k) >= 10:
                keys.setdefault(k, set()).add(top if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(ids := keys.get(lower(x.strip(SPACES)), ())) >= min_docs and (top if i is None else i) > min(ids) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(spark, min_docs):
    docs = nasty(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = dedup_lines(docs, min_docs=min_docs)
    assert sorted(collected(got.select("doc_id", "n_lines", "n_dropped", "kept_text")).elements(), key=str) == sorted(_deduped(rows, min_docs), key=str)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped", "kept_text"]
    assert dedup_lines(empty(spark)).count() == 0


def _repeat(words):
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i: i + 3]), []).append(i)
    return len({p + k for places in at.values() if len(places) > 1 for p in places for k in range(3)})


def test_quality_rules(spark):
    docs = nasty(spark).withColumn("text", F.when(F.col("doc_id") == 10, F.repeat(F.lit("a b c d\n"), 40)).otherwise(F.col("text")))
    got = quality_rules(docs).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == docs.count()
    for r in got:
        words = WORD.findall(r.text or "")
        inked = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in r.text or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(inked) - len(set(inked)), _repeat(words))
        assert r.base_failed == (len(words) < 50 or 100 * _repeat(words) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert any(r.n_repeat_words == 160 and r.base_failed for r in got) and any(r.kept for r in got)
    assert quality_rules(empty(spark)).count() == 0
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_each_threshold_decides(spark):
    text = "the of and " + " ".join(f"word{i}" for i in range(50))
    bad = {"mean_word_chars": "abcdefghijklmnopq" + text.replace(" ", " abcdefghijklmnopqrstuv"), "symbols_per_word": text + " ###### ######",
           "bangs_per_word": text.replace(" ", "! "), "stop_word_share": text.replace("the of and ", "")}
    rows = spark.createDataFrame([(0, text), *((k + 1, t) for k, t in enumerate(bad.values()))], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality_rules(rows).collect()} == {0: True, 1: False, 2: False, 3: False, 4: False}
    assert quality_rules(rows, table=[t for t in THRESHOLDS if t[0] == "n_words"]).where("kept").count() == 5


def test_licenses(spark):
    notices = [(100 + k, f"{t.upper() if k % 2 else t}\nplain words of a story", f) for k, (f, t) in
               enumerate((f, t) for f in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[f])]
    notices.append((200, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "mit"))
    docs = nasty(spark).unionByName(spark.createDataFrame([(i, t) for i, t, _ in notices], "doc_id long, text string"), allowMissingColumns=True)
    got = licenses.license_scan(docs).select("doc_id", "text", "n_paragraphs", "n_licensed", "families", "family", "probability").collect()
    model = licenses.train()
    assert len(got) == docs.count()
    for r in got:
        want = []
        for line in (r.text or "").split("\n"):
            words = licenses.tokens(line)
            p = model.probabilities(words)
            family = model.families[p.argmax()]
            if p.max() >= 0.5 and licenses.confirmed(family, words):
                want.append(family)
        assert (r.n_paragraphs, r.n_licensed, r.families) == (len((r.text or "").split("\n")), len(want), ",".join(sorted(set(want))))
        assert (r.family == "unknown") == (not want) and (r.probability is None) == (not want)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].family for i, _, f in notices[:-1]] == [f for _, _, f in notices[:-1]]
    assert by_id[200].families == "cc-by-nc,mit" and by_id[200].n_licensed == 3
    assert licenses.license_scan(empty(spark)).count() == 0


def test_license_words_without_a_grant_stay_unknown(spark):
    lines = ["The driver showed her license at the border and went on.", "He wrote under the name of the general.", "Version 2.0 of the plan was shown."]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.family for r in licenses.license_scan(docs).collect()} == {"unknown"}


def test_license_scan_is_native(spark):
    plan = licenses.license_scan(nasty(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


RULES = [Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1")]
PAGES = "page_id long, url string, host string, page string, verdict string"


def test_url_rules_and_hosts(spark):
    urls = {1: "https://A.Example.ORG/es/x?q#f", 2: "http://example.org/en/12", 3: "http://notexample.org/es/", 4: "http://example.org", 5: None,
            6: "no scheme", 7: "http://x.co.uk?q=http://other.org/a", 8: "https://h.com/p#f", 9: "://"}
    pages = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in urls.items()], PAGES)
    none = spark.createDataFrame([], "page long, good int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, none, RULES).collect()}
    assert got == {1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
                   3: ("notexample.org", "/es/", "org/", "allow"), 4: ("example.org", "", None, got[4][3]), 5: ("", "", None, got[5][3]),
                   6: ("", "", None, got[6][3]), 7: ("x.co.uk", "", None, got[7][3]), 8: ("h.com", "/p", None, got[8][3]), 9: ("", "", None, got[9][3])}
    assert judge_urls(spark.createDataFrame([], PAGES), none, RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, none, [Rule("allow", f"h{i}") for i in range(MAX_RULES + 1)])


def test_bad_hosts_are_blocked_and_new_hosts_follow_their_domain(spark):
    pages, outcomes = [], []
    for i in range(900):
        host = f"{'bad' if i % 3 == 0 else 'good'}{i % 5}.{'farm' if i % 3 == 0 else 'site'}.com"
        pages.append((i, f"http://{host}/p", "h", "p", "v"))
        outcomes.append((i, 0 if i % 3 == 0 else 1))
    pages += [(1000, "http://new.farm.com/", "", "", ""), (1001, "http://new.site.com/", "", "", ""), (1001, "http://new.site.com/", "", "", "")]
    outcomes += [(0, 1), (None, 0), (5, None)]
    got = judge_urls(spark.createDataFrame(pages, PAGES), spark.createDataFrame(outcomes, "page long, good int"), []).collect()
    assert len(got) == 903
    assert all(r.verdict == ("block" if "farm" in r.host else "allow") for r in got)


def test_outcomes_by_the_number_in_the_path(spark):
    pages = [(i, f"http://{'bad' if i % 2 else 'good'}.com/en/{i + 1000}" + ["", "?q=1", "#top", ".html", "/"][i % 5], "h", "p", "v") for i in range(400)]
    pages += [(1000, "http://bad.com/en/99999999999999999999", "", "", ""), (1001, "http://bad.com/1001", "", "", ""), (1002, None, "", "", "")]
    outcomes = [(i + 1000, 1 - i % 2) for i in range(400)] + [(i, i % 2) for i in range(400)]  # by page id it is the other way round
    table = spark.createDataFrame(pages, PAGES), spark.createDataFrame(outcomes, "page long, good int")
    got = judge_urls(*table, [], by_path=True).collect()
    assert len(got) == 403 and all(r.verdict == ("block" if r.host == "bad.com" else "allow") for r in got)
    assert all(r.verdict == ("block" if r.host == "good.com" else "allow") for r in judge_urls(*table, []).collect() if r.page_id < 1000)
