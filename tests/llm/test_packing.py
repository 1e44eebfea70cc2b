"""Buckets against all choices of boundaries, batches by their definition, and the whole pipeline."""

from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from airq.llm import packing
from airq.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def padding(lengths, counts, boundaries):
    return sum(n * (min(b for b in boundaries if b >= x) - x) for x, n in zip(lengths, counts))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_boundaries_are_the_best(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[x] for x in lengths]
    found = packing.best_boundaries(np.array(lengths), np.array(counts), buckets)
    assert len(found) <= buckets and found[-1] == lengths[-1]
    least = min(padding(lengths, counts, [*c, lengths[-1]]) for c in combinations(lengths[:-1], min(buckets, len(lengths)) - 1))
    assert padding(lengths, counts, found) == least


def check(rows, n_rows, budget):
    assert len(rows) == n_rows
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == n_rows
    sizes = {}
    for r in rows:
        assert r.n_tokens <= r.padded
        sizes.setdefault(r.bucket, {}).setdefault(r.batch, []).append(r)
    for batches in sizes.values():
        full = max(1, budget // max(1, next(iter(batches.values()))[0].padded))
        assert sorted(batches) == list(range(len(batches)))
        for k, batch in batches.items():
            assert sorted(r.slot for r in batch) == list(range(len(batch)))
            assert len(batch) == full or k == max(batches)


@pytest.mark.parametrize("part_rows", [3, 4096])
def test_batches(spark, part_rows):
    rows = [(i, int(n)) for i, n in enumerate(np.random.default_rng(1).integers(0, 300, 200))] + [(None, None), (5, 100), (5, 100), (6, 90_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, words long, bucket string")
    got = packing.pack(df, df["words"], buckets=4, budget=1000, part_rows=part_rows).collect()
    check(got, len(rows), 1000)
    assert packing.pack(df.limit(0), F.col("words")).collect() == []


def test_boundaries_of_many_and_long_lengths():
    rng = np.random.default_rng(4)
    for n, buckets in ((300, 4), (200, 16)):
        lengths = np.unique(rng.integers(1000, 2_000_000, n))
        counts = rng.integers(1, 10**7, len(lengths))
        up, before, mass = lengths.astype(object), np.cumsum([0, *counts]).astype(object), np.cumsum([0, *(lengths * counts)]).astype(object)
        cost = [0] + [None] * len(lengths)
        for _ in range(buckets):
            cost = [0] + [min(cost[i] + up[j - 1] * (before[j] - before[i]) - (mass[j] - mass[i]) for i in range(j) if cost[i] is not None) for j in range(1, len(up) + 1)]
        found = packing.best_boundaries(lengths, counts, buckets)
        assert len(found) == buckets and padding(lengths.tolist(), counts.tolist(), found) == cost[-1]
    many = np.arange(1, 100_001)
    assert len(packing.best_boundaries(many, many[::-1], 16)) == 16


def test_word_count(spark):
    texts = [None, "", " \t", "a", " a\x0bb\r\nc ", "é f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(packing.word_count(F.col("t")))
    assert [r[0] for r in df.collect()] == [0, 0, 0, 1, 3, 1]


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = QUERIES["op6_packing"](spark, folder).collect()
    check(rows, docs.count(), 16_384)
    assert {r.doc_id: r.n_tokens for r in rows} == {r.doc_id: len((r.text or "").split()) for r in docs.collect()}


def test_pipeline(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "language id", "n-gram jaccard join", "packing"]
    now, kept = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder).cache()
        assert now.columns == docs.columns
        kept.append({r.doc_id for r in now.select("doc_id").collect()})
    good, known, single = kept
    everything = {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(quality.get(i) != 0 for i in good) and all(quality.get(i) != 1 for i in everything - good)
    assert known == good and single < known
    again = QUERIES["op5_jaccard_join"](spark, folder).where("doc_id <> component_id").select("doc_id").collect()
    assert known - single == {r.doc_id for r in again if r.doc_id in known and r.doc_id not in single}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == single
    check(rows, len(single), 16_384)


def test_a_bucket_is_padded_to_its_longest_document(spark):
    lengths = [1025, 1030, 5001, 5003, 70_001, 3]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, words long")
    for buckets in (1, 2, 3, 16):
        rows = packing.pack(df, df["words"], buckets=buckets, budget=10_006).collect()
        longest = {b: max(r.n_tokens for r in rows if r.bucket == b) for b in {r.bucket for r in rows}}
        assert all(r.padded == longest[r.bucket] for r in rows)
    assert [r.batch for r in rows if r.n_tokens in (5001, 5003)] == [0, 0]


def test_pipeline_edges(spark, tmp_path):
    """Extra columns with the stages' own names, null ids and texts, repeated rows; then no rows at all."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit("v") for c in ("_n", "_digest", "_key", "_row", "n_tokens", "score")})
    odd = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(docs.limit(2)).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    for name, rows in (("some", docs.unionByName(odd)), ("none", docs.where("false"))):
        path = f"{tmp_path}/{name}"
        rows.write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{path}/labels.parquet")
        now = spark.read.parquet(f"{path}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, path)
            assert now.columns == docs.columns
        found = corpus_pipeline.run(spark, path).collect()
        assert (len(found) > 0) == (name == "some")


def test_no_batch_has_two_groups(spark):
    rows = [(i, int(n), ("de", "en", None)[i % 3]) for i, n in enumerate(np.random.default_rng(2).integers(0, 300, 200))]
    df = spark.createDataFrame(rows, "doc_id long, words long, lang string")
    got = packing.pack(df, df["words"], buckets=4, budget=1000, part_rows=7, group_column="lang").collect()
    check(got, len(rows), 1000)
    assert {(r.doc_id, r.n_tokens, r.lang) for r in got} == set(rows)
    assert len({r.bucket for r in got}) == len({(r.bucket, r.lang) for r in got}) > 4
    assert packing.pack(df.limit(0), F.col("words"), group_column="lang").collect() == []


def test_batches_of_the_pipeline_go_by_the_predicted_language(spark, tmp_path):
    """Labels that are wrong or missing do not reach the batches: the language stage replaces them."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 40
    spoiled = docs.withColumn("lang", F.when(odd == 6, F.lit("de")).when(odd == 10, F.lit(None)).otherwise(F.col("lang")))
    spoiled.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    given = {r.doc_id: r.lang for r in spoiled.select("doc_id", "lang").collect()}
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert any(given[r.doc_id] != true[r.doc_id] for r in rows)
    assert np.mean([r.lang == true[r.doc_id] for r in rows]) > 0.99
    assert len({r.bucket for r in rows}) == len({(r.bucket, r.lang) for r in rows})
