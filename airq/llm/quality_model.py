"""Quality classifier: supervised subword embeddings.

Hashed vectors of words, character n-grams and word-repeat patterns are averaged per document (each family
on its own, then over the families), a softmax layer gives the class. Vectors and layer are learned by
stochastic gradient descent in numpy on a bounded, balanced sample of labelled rows. As everything after
the lookup is linear, a learned vector enters a score only through its two logits; scoring looks these up
and never holds more than one slice of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import blocks, byte_slices, code_points, mixed, remainder_of_id, sample_by_class, segment_sums, span_hashes, texts_of

# Rows taken of each label, at most (on average over hashes of the ids).
SAMPLE_PER_CLASS = 2000
FAMILIES = 3
REPEAT_REACH = 16


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    size: int = 8
    rows_seen: int = 24_000
    rate: float = 0.5
    batch: int = 16
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    """``logits[bucket]`` is the learned vector times the output layer; ``bias`` that layer's bias."""

    bits: int
    logits: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 for each text; an empty text has the score of the bias alone."""
        parts, rows = blocks(texts)
        margin = (self.logits[:, 1] - self.logits[:, 0]).astype(np.float32)
        total = np.full(len(texts), float(self.bias[1] - self.bias[0]))
        for family in features(parts, self.bits):
            sums = sum(np.bincount(rows, segment_sums(margin[ids], starts), len(texts)) for ids, starts in family)
            counts = sum(np.bincount(rows, np.diff(np.append(starts, len(ids))), len(texts)) for ids, starts in family)
            total += sums / np.maximum(counts, 1) / FAMILIES
        return 1.0 / (1.0 + np.exp(-total))


def features(texts: list[str], bits: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per family, arrays of the bucket of every occurrence, text after text, and where each text starts."""
    chars, starts = code_points([f" {t} " for t in texts])
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    shift = np.uint64(64 - bits)
    # words: runs of characters that are not white space
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space))) != 0)
    first, last = edge[0::2], edge[1::2]
    words = span_hashes(chars, first, last)
    word_starts = np.searchsorted(first, starts)
    # repeat patterns: how many words back the same word stands, with the pattern of the word before
    back = np.zeros(len(words), dtype=np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(word_starts, len(words))))
    for reach in range(min(REPEAT_REACH, len(words) - 1), 0, -1):
        same = (words[reach:] == words[:-reach]) & (owner[reach:] == owner[:-reach])
        back[reach:][same] = reach
    pattern = back * np.uint64(64)
    pattern[1:] += np.where(owner[1:] == owner[:-1], back[:-1], np.uint64(0))
    # character n-grams within a word and its edges
    plain = np.where(space, np.uint32(0), chars).astype(np.uint32)
    two = plain[:-1] * np.uint32(0x01000193) + plain[1:]
    three = two[:-1] * np.uint32(0x01000193) + plain[2:] + np.uint32(3)
    at_two = np.flatnonzero((plain[:-1] != 0) | (plain[1:] != 0))
    at_three = np.flatnonzero(plain[1:-1] != 0)
    return [
        [((mixed(words) >> shift).astype(np.int32), word_starts)],
        [((mixed(pattern + np.uint64(1 << 40)) >> shift).astype(np.int32), word_starts)],
        [
            (_bucket(two[at_two], bits), np.searchsorted(at_two, starts)),
            (_bucket(three[at_three], bits), np.searchsorted(at_three, starts)),
        ],
    ]


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return (h >> np.uint32(32 - bits)).astype(np.int32)


def weights_of(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compressed rows: for each text its buckets and their shares of the averaged document vector."""
    parts, rows = blocks(texts)
    keys, shares = [], []
    for family in features(parts, bits):
        row = [np.repeat(rows, np.diff(np.append(starts, len(ids)))) for ids, starts in family]
        total = sum(np.bincount(r, minlength=len(texts)) for r in row)
        for r, (ids, _) in zip(row, family):
            keys.append(r << bits | ids)
            shares.append(1.0 / total[r] / FAMILIES)
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    share = np.bincount(where, np.concatenate(shares)).astype(np.float32)
    starts = np.searchsorted(key >> bits, np.arange(len(texts) + 1))
    return (key & ((1 << bits) - 1)).astype(np.int32), share, starts


def train(texts: list[str], labels: np.ndarray, settings: Settings = Settings()) -> QualityModel:
    """Stochastic gradient descent on the softmax loss, both labels of equal weight.

    Without rows of both labels every score is 0.5.
    """
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (1 << settings.bits, settings.size)).astype(np.float32) / settings.size
    layer = np.zeros((settings.size, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    if len(np.unique(labels)) < 2:
        return QualityModel(settings.bits, vectors @ layer, bias)
    rows = [weights_of(texts[i : i + 50], settings.bits) for i in range(0, len(texts), 50)]
    each = [(ids[a:b], share[a:b]) for ids, share, at in rows for a, b in zip(at[:-1], at[1:])]
    per_class = np.bincount(labels, minlength=2)
    weight = (len(labels) / 2 / per_class).astype(np.float32)
    epochs = -(-settings.rows_seen // len(texts))
    steps, step = epochs * -(-len(texts) // settings.batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), settings.batch):
            rate = settings.rate * (1 - step / steps)
            step += 1
            chosen = order[at : at + settings.batch]
            counts = np.array([len(each[i][0]) for i in chosen])
            if not counts.sum():
                continue
            ids = np.concatenate([each[i][0] for i in chosen])
            share = np.concatenate([each[i][1] for i in chosen])
            starts = np.cumsum(counts) - counts
            means = segment_sums(vectors[ids] * share[:, None], starts).astype(np.float32)
            scores = means @ layer + bias
            p = np.exp(scores - scores.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            p *= weight[labels[chosen]][:, None]
            towards = p @ layer.T
            layer -= rate / len(chosen) * (means.T @ p)
            bias -= rate / 10 / len(chosen) * p.sum(0)
            np.add.at(vectors, ids, -rate * share[:, None] * np.repeat(towards, counts, axis=0))
    return QualityModel(settings.bits, (vectors @ layer).astype(np.float32), bias)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
    settings: Settings = Settings(),
) -> QualityModel:
    """Learn from labelled rows whose id is not held out (crc32 of the id as text, modulo 3, is 1).

    Training uses at most about ``per_class`` rows of each label (so their ids may be broadcast), whole texts; rows with a null label, id or
    text are left out, of repeated ids in ``labels`` one distinct label each counts.
    """
    marked = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (remainder_of_id("_id", 3) != 1))
        .distinct()
    )
    chosen = sample_by_class(marked, "_id", "_label", per_class)
    texts = docs.select(F.col(id_column).alias("_doc"), F.col(text_column).alias("_text")).where(F.col("_text").isNotNull())
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "_text", "_label").toArrow()
    order = pc.sort_indices(rows, [("_id", "ascending"), ("_label", "ascending"), ("_text", "ascending")])
    rows = rows.take(order)
    return train(rows["_text"].to_pylist(), rows["_label"].to_numpy().astype(np.int64), settings)


def score_quality(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (null and empty texts too), ``predicted``.

    A null id counts as held out. Repeated rows give repeated results; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                found = shipped.value.scores(texts_of(part, "_text"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["_id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    scored = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        run, f"_id {kind}, score double"
    )
    return scored.select(
        F.col("_id").alias(id_column),
        F.coalesce(remainder_of_id("_id", 3) == 1, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: QualityModel, text_column: str = "text", at_least: float = 0.5) -> DataFrame:
    """Rows whose text scores ``at_least`` that much, with all their columns."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, place):
                yield part.filter(pa.array(shipped.value.scores(texts_of(part, place)) >= at_least))

    return docs.mapInArrow(run, docs.schema)
