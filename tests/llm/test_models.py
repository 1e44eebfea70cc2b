"""Language id and quality classifier: held-out accuracy, and defined results at the edges."""

import zlib

import numpy as np
import pytest
from airq.llm import language, quality_model
from airq.llm.queries import QUERIES

EDGES = [(None, "some text", "x"), (1, None, "x"), (2, "", "x"), (3, "12 !!", "x"), (3, "12 !!", "x"), (4, "the end " * 300_000, "x")]


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op2_language"](spark, sf).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, sf):
    model = language.fit_language(spark.read.parquet(f"{sf}/documents.parquet"))
    df = spark.createDataFrame(EDGES, "doc_id long, text string, score string")
    got = language.identify_language(df, model).collect()
    assert len(got) == len(EDGES)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[None].held_out and by[4].lang_pred == "en"
    assert language.keep_known(df, model).columns == df.columns
    assert {r.doc_id for r in language.keep_known(df, model).collect()} <= {None, 4}
    empty = language.fit_language(df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in language.identify_language(df, empty).collect()} == {"und"}
    assert language.identify_language(df.limit(0), model).collect() == []


def test_blocks_do_not_change_a_prediction(spark):
    text = "ein satz mit worten " * 80_000
    model = language.train(["ein satz mit worten"] * 4 + ["the words of it"] * 4, ["de"] * 4 + ["en"] * 4, np.zeros(1 << 15), 8)
    a, _ = model.logits([text])
    b, _ = model.logits([text[: len(text) // 80_000 * 10]])
    assert np.allclose(a, b, atol=1e-3)


def test_elastic_net_leaves_few_weights():
    names = ["de", "en"] * 20
    model = language.train([f"wort{n} text {n}" for n in names], names, np.zeros(1 << 15), 40)
    assert 0 < (model.weights != 0).mean() < 0.01
    assert model.temperature > 0


def test_quality_on_held_out_rows(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op10_quality"](spark, sf).join(labels, "doc_id", "left").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_quality_edges(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    df = spark.createDataFrame(EDGES, "doc_id long, text string, score string")
    got = quality_model.score_quality(df, model).collect()
    assert len(got) == len(EDGES)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score
    assert quality_model.keep_good(df, model).columns == df.columns
    nothing = quality_model.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_model.score_quality(df, nothing).collect()} == {0.5}
    assert quality_model.score_quality(df.limit(0), model).collect() == []


def test_scores_in_slices_equal_scores_one_by_one():
    model = quality_model.train(["good words here"] * 20 + ["BAD!! BAD!! BAD!!"] * 20, np.array([1] * 20 + [0] * 20))
    texts = ["good words", "", "BAD!!", "x " * 40, "good BAD!! words"]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])
    assert model.scores(["good words here"])[0] > 0.5 > model.scores(["BAD!! BAD!!"])[0]


@pytest.mark.parametrize("learned", [("de", "en", "es"), ("de", "fr"), ("es",)], ids=" ".join)
def test_texts_of_an_unlearned_language_go(spark, sf, learned):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) >= 500")
    model = language.fit_language(docs.where(docs.lang.isin(*learned)))
    stay = {r.doc_id for r in language.keep_known(docs, model).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert np.mean([r.doc_id in stay for r in rows if r.lang in learned]) > 0.97
    assert np.mean([r.doc_id in stay for r in rows if r.lang not in learned]) < 0.05


def test_texts_of_two_learned_languages_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) between 500 and 3000")
    model = language.fit_language(docs)
    some = {k: [r.text for r in docs.where(docs.lang == k).orderBy("doc_id").limit(20).collect()] for k in ("de", "fr")}
    assert model.covers([f"{a}\n{b}" for a, b in zip(some["de"], some["fr"])]).all()


def test_without_a_learned_language_all_rows_stay(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string, score string")
    empty = language.fit_language(df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert language.keep_known(df, empty).count() == len(EDGES)


def test_a_key_in_a_short_text_does_not_reject_it():
    names = ["de", "en"] * 20
    model = language.train(["ein satz mit worten", "the words of it"] * 20, names, np.zeros(1 << 15), 40)
    key = "token = 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"
    assert model.covers([f"the words of it {key[8:]}", "xyzzy qwrtp kjhgf zxcvb"]).tolist() == [True, False]


def test_rows_that_stay_have_the_predicted_language(spark):
    names = ["de", "en"] * 20
    model = language.train(["ein satz mit worten", "the words of it"] * 20, names, np.zeros(1 << 15), 40)
    rows = [(1, "en", "ein satz mit worten"), (2, None, "the words of it"), (3, "de", "12 !!"), (4, "de", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in language.keep_known(df, model).collect()) == [(1, "de", rows[0][2]), (2, "en", rows[1][2])]
    assert language.keep_known(df.where("doc_id > 2"), model).collect() == []
