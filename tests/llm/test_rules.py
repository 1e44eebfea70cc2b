"""Decision lists: statistics against plain counting, learning on made-up rows, query results."""

import re
from collections import Counter

import numpy as np
from airq.llm import decision_list as dl
from airq.llm.queries import QUERIES
from hypothesis import given
from hypothesis import strategies as st


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


@given(st.lists(st.sampled_from(["a", "b", "c", "#x", "é|", "\n", "\n\n", "\t", " ", "\x0b"]), max_size=60).map(" ".join))
def test_counts_as_plain(text):
    assert dl.counts_of(text)[:5] == plain_counts(text)


def test_many_distinct_words_stay_exact():
    words = [f"w{i}" for i in range(30_000)]
    text = " ".join(words + words[100:110] + ["end"])
    assert dl.counts_of(text)[:5] == plain_counts(text)
    assert dl.counts_of(text)[4] == 20


def test_learned_rules_find_what_makes_rows_bad():
    rng = np.random.default_rng(1)
    data = {"x": rng.random(2000), "y": rng.random(2000), "noise": rng.random(2000)}
    bad = (data["x"] > 0.9) | ((data["y"] < 0.2) & (data["x"] < 0.5))
    rules = dl.learn_rules(data, bad)
    hit = np.zeros(2000, dtype=bool)
    for rule in rules:
        hit[dl.covered(rule, data, np.arange(2000))] = True
    assert (hit == bad).mean() > 0.97
    assert dl.learn_rules(data, np.zeros(2000, dtype=bool)) == []
    assert dl.learn_rules({k: v[:0] for k, v in data.items()}, bad[:0]) == []


def test_pruning_drops_a_condition_that_only_fits_the_growing_rows():
    data = {"x": np.array([0.0, 1, 2, 3, 4, 5, 6, 7]), "y": np.array([0.0, 1, 0, 1, 0, 1, 0, 1])}
    bad = data["x"] > 3
    rule = (dl.Condition("x", True, 3.0), dl.Condition("y", True, 0.5))
    assert dl.prune(rule, data, bad, np.arange(8)) == rule[:1]


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_quality_rules"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, lines, repeats = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert r.kept == (not r.base_failed and r.failed_rule is None)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(r.kept, quality[r.doc_id]) for r in rows if r.doc_id in quality and not r.base_failed]
    assert all(kept for kept, q in judged if q == 1)
    assert np.mean([not kept for kept, q in judged if q == 0]) > 0.8


def test_edges(spark):
    rows = [(None, "a b c", 1), (1, None, 1), (2, "", 1), (3, "x\n" * 100_000, 1), (3, "x\n" * 100_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    rules = dl.fit_rules(df, spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    got = dl.apply_rules(dl.text_statistics(df), rules).collect()
    assert len(got) == len(rows) and rules == []
    assert {(r.doc_id, r.n_words, r.base_failed, r.kept) for r in got} == {
        (None, 3, True, False), (1, 0, True, False), (2, 0, True, False), (3, 100_000, True, False),
    }
    assert dl.apply_rules(dl.text_statistics(df.limit(0)), rules).collect() == []


def plain_shares(text):
    """The learned rules' features from the text alone."""
    n, chars, symbols, copies, repeats = plain_counts(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    return {
        "symbols_per_word": symbols / max(n, 1),
        "marks_per_word": (text.count("!") + text.count("?")) / max(n, 1),
        "upper_share": len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text)) / max(chars, 1),
        "repeat_share": repeats / max(n, 1),
        "distinct_share": len(set(words)) / max(n, 1),
        "duplicate_line_share": copies / max(lines, 1),
        "word_length": chars / max(n, 1),
        "words": float(n),
    }


def test_kept_is_the_list_evaluated_in_python(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rules = dl.fit_rules(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules
    got = dl.apply_rules(dl.text_statistics(docs), rules).select("doc_id", "base_failed", "failed_rule", "kept").collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got:
        share = plain_shares(texts[r.doc_id])
        hit = [rule for rule in rules if all((share[c.feature] > c.threshold) == c.above for c in rule)]
        assert r.failed_rule == (" and ".join(map(str, hit[0])) if hit else None)
        assert r.kept == (not r.base_failed and not hit)
    assert any(r.failed_rule for r in got) and any(r.kept for r in got)
