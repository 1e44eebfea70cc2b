"""Registered queries of the text operators: each on its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from airq.llm import (
    bin_slack,
    byte_bpe,
    conversation,
    decision_list,
    fingerprint,
    html_text,
    jaccard_join,
    language,
    packing,
    quality_model,
    token_count,
    url_filter,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify_language(docs, language.fit_language(docs))


@query("op10_quality")
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_model.score_quality(docs, quality_model.fit_quality(docs, table(spark, folder, "labels")))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest_documents(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query("op8_token_count")
def op8_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


URL_RULES = [
    ("net", "/", url_filter.BLOCK),
    ("example.net", "/en/", url_filter.ALLOW),
    ("example.com", "/de/", url_filter.BLOCK),
    ("org", "/fr/", url_filter.ALLOW),
]

URL_SQL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM cut
), ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/'
    END AS rule FROM parts
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op9_url_filter", URL_SQL)
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"), URL_RULES)


@query("op4_html_text")
def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rules = decision_list.fit_rules(docs, table(spark, folder, "labels"))
    return decision_list.apply_rules(decision_list.text_statistics(docs), rules)


@query("op1_fingerprint")
def op1_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, folder, "documents"))


@query("op6_packing")
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, packing.word_count(docs["text"]))


@query("op13_best_fit")
def op13_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return bin_slack.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """A row per vector and component. A shift added to all numbers (the contract's million) cancels in every column."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit_whitening(rows, components=16, scale=64.0)
    found = whitening.whiten(rows, model)
    if model is None or not model.explained:
        found, explained, n, error = found.where(F.lit(False)), [0.0], 0, 0.0
    else:
        explained, n, error = model.explained, model.n, model.identity_error
    each = found.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit(explained), F.col("_at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The faults that ``op11_conversation`` repairs, dealt by a checksum of id and turn; ``present`` is false for dropped rows."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id",
        "turn",
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    cut = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, F.lit(2)).otherwise(F.lit(1))))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        cut.otherwise(F.col("text")).alias("text"),
        (F.col("fault") != 0).alias("present"),
        copies.alias("copy"),
    )


@query("op11_conversation")
def op11_conversation(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(table(spark, folder, "conversations"))
    return conversation.audit_conversations(rows, present=F.col("present"))
