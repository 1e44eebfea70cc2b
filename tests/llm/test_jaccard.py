"""The n-gram join against all pairs, with every way through it."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airq.llm import jaccard_join as jj
from airq.llm.graph import connected_components
from airq.llm.queries import QUERIES
from airq.llm.shingles import shingle_hashes


def by_hand(rows, percent=75):
    """``{row: (n, component)}`` from sets of word tuples, all pairs compared."""
    sets, link = [], list(range(len(rows)))

    def root(i):
        while link[i] != i:
            i = link[i]
        return i

    for _, text in rows:
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = folded.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
        words = [w for w in words if w]
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= percent * len(sets[i] | sets[j]):
            link[root(j)] = root(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((k, len(s), least.get(root(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, groups, size):
    """Groups of texts that are edited again and again, so that their likeness is spread around the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(4, 80))]
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                base = text
            rows.append((rng.randrange(10**9), " ".join(text)))
    return rows


WAYS = [
    jj.Settings(),
    jj.Settings(block=2, hot_documents=2, hot_factor=0, broadcast_ids=0),
    jj.Settings(block=3, hot_documents=1, hot_factor=0),
]


@pytest.mark.parametrize("settings", WAYS, ids=["default", "small blocks and salts, no broadcast", "single salts"])
def test_same_as_all_pairs(spark, settings):
    rows = corpus(1, 12, 14)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in jj.jaccard_components(df, settings=settings).collect()), key=str)
    assert got == by_hand(rows)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (7, long), (8, long + " more"),
        (None, "one two"), (None, None), (9, "a b c d e"), (9, "a b c d e"), (10, "A\tb\nc d e"), (11, "ÉA b"), (12, "éa b"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, n int")
    got = sorted((tuple(r) for r in jj.jaccard_components(df).collect()), key=str)
    assert got == by_hand(rows)
    left = jj.one_of_each(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 1, 2, 3, 4, 6, 7, 9, 11, 12]
    assert jj.jaccard_components(df.limit(0)).collect() == []


def test_query_finds_the_same_as_an_index_of_all_ngrams(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op5_jaccard_join"](spark, folder).collect()), key=str)
    assert got == by_hand(rows)


def test_runs_are_read_alike_in_batches_of_any_size(spark):
    rows = [(1, 0, 5, 9, 0), (2, 0, 1, 9, 1), (2, 0, 3, 9, 2), (2, 0, 8, 9, 0), (2, 0, 9, 9, 0), (3, 2, 4, 9, 0), (4, 0, 6, 9, 0), (4, 0, 7, 9, 0), (5, 0, 1, 9, 0)]
    df = spark.createDataFrame(rows, "gram long, salt int, doc long, n int, at int").coalesce(1)
    expected = [(2, 1, 1, True), (2, 3, 1, True), (2, 8, 1, True), (2, 9, 1, True), (3, 4, 4, True), (4, 7, 6, False)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "2", "3", "100"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = jj.shared_members(df).select("gram", "doc", "pivot", "many").collect()
            assert sorted(map(tuple, got)) == expected, size
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_filters_never_reject_a_link():
    rng = random.Random(4)
    settings = jj.Settings()
    texts = [t for _, t in corpus(7, 30, 6)]
    sets = [np.unique(shingle_hashes([t.encode()], 5)[0]) for t in texts]
    for i, j in rng.sample(list(combinations(range(len(texts)), 2)), 2000):
        a, b = sets[i], sets[j]
        common = len(np.intersect1d(a, b))
        if 100 * common >= 75 * (len(a) + len(b) - common):
            x, y = (np.frombuffer(jj.parity_sketch(s), dtype=np.uint64)[None] for s in (a, b))
            words = min(x.shape[1], y.shape[1])
            apart = np.bitwise_count(jj.fold(x, words) ^ jj.fold(y, words)).sum()
            assert common >= settings.overlap(len(a) + len(b))
            assert apart <= len(a) + len(b) - 2 * settings.overlap(len(a) + len(b))
            assert set(a[: settings.prefix(len(a))].tolist()) & set(b[: settings.prefix(len(b))].tolist())


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(df.limit(0)).collect() == []


def test_compare_all_meets_neighbouring_sketch_sizes():
    texts = [" ".join(f"w{i}" for i in range(k)) for k in (30, 36, 37, 38, 40)]
    sets = [shingle_hashes([t.encode()], 5)[0] for t in texts]
    group = pa.table(
        {
            "n": pa.array([len(s) for s in sets], pa.int32()), "at": pa.array([0] * 5, pa.int32()), "part": pa.array(range(5), pa.int64()),
            "mine": pa.array([0] * 5, pa.int32()), "i": pa.array([0] * 5, pa.int32()), "j": pa.array([0] * 5, pa.int32()),
            "sketch": [jj.parity_sketch(s) for s in sets],
        }
    )
    a, b = jj.compare_all(group, jj.Settings())
    found = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    expected = {(i, j) for i, j in combinations(range(5), 2) if 100 * len(sets[i]) >= 75 * len(sets[j])}
    assert expected <= found


@pytest.mark.parametrize("settings", WAYS, ids=["default", "small blocks and salts, no broadcast", "single salts"])
def test_repeated_ids_with_several_texts(spark, settings):
    base = [f"w{i}" for i in range(30)]
    near = " ".join([*base[:-1], "other"])
    rows = [(3, " ".join(base)), (7, " ".join(base)), (7, near.replace("w", "v")), (5, near.replace("w", "v") + " x"), (2, "q r s t u v w")]
    rows += [(2, near), (9, "a b c d e f"), (9, "a b c d e f"), (9, None), (8, "A b c d e f"), (7, "q r s t u v w"), (None, near)]
    # ids of one text after another, each linked to another document
    rows += [(i % 5, t) for i, (_, t) in enumerate(corpus(3, 6, 6))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in jj.jaccard_components(df, settings=settings).collect()), key=str)
    assert got == by_hand(rows)


@pytest.mark.parametrize("broadcast_ids", [1_000_000, 0])
def test_one_row_of_each_group_stays(spark, broadcast_ids):
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(9, "a b c d e"), (9, "A b c d e"), (9, "a b c d e"), (10, "a b c d e"), (9, None), (9, None)]
    rows += [(4, base), (4, base + " x"), (5, base + " x"), (4, "q r s t u v"), (3, "q r s t u v"), (3, "other words of this id here")]
    rows += [(None, "one two"), (None, "One two"), (None, base), (None, None), (None, ""), (2, "one two")]
    df = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, extra map<string,int>").repartition(3)
    left = jj.one_of_each(df, settings=jj.Settings(broadcast_ids=broadcast_ids))
    assert left.columns == df.columns
    got = sorted((r.doc_id or 0, (r.text or "").lower()) for r in left.collect())
    one = [t for k, t in got if k == 4]
    assert one in ([base], [base + " x"])
    assert [r for r in got if r[0] != 4] == sorted(
        [(9, "a b c d e"), (9, ""), (9, ""), (3, "q r s t u v"), (3, "other words of this id here")]
        + [(0, "one two"), (0, base), (0, ""), (0, ""), (2, "one two")]
    )


def test_very_large_sets_do_not_overflow(spark):
    rows = [(22_000_000, 0, 22_000_000, 0, True), (2_000_000_000, 0, 1_900_000_000, 5, True), (2_000_000_000, 0, 22_000_000, 0, False)]
    df = spark.createDataFrame(rows, "n int, at int, m int, mat int, want boolean")
    found = df.select("want", jj.plausible(F.col("n"), F.col("at"), F.col("m"), F.col("mat"), jj.Settings()).alias("got")).collect()
    assert all(r.want == r.got for r in found)


def test_extra_columns_of_any_name(spark):
    """Names that the operator uses itself, with repeated ids and ids that are null."""
    names = ["_n", "_digest", "_key", "_row", "_id", "_text", "_set", "digest", "n", "part", "component_id", "__n"]
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "x y"), (None, "x y"), (None, "x y"), (4, None), (4, "")]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    df = spark.createDataFrame([(*r, *["v"] * len(names)) for r in rows], schema)
    left = jj.one_of_each(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "x y"), (1, "a b c d e f"), (3, "x y"), (4, ""), (4, "")]
    assert jj.one_of_each(df.where("false")).collect() == []
