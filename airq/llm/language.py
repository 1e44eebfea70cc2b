"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters counts as a space, and the n-grams are pairs and triples of
letters within a word and its edges, hashed to a fixed number of buckets. Document frequencies are counted
by Spark over all texts that may be learned from. The weights are trained with follow-the-regularised-leader
under an elastic-net penalty on a bounded, balanced sample; a temperature fitted on rows kept out of that
training turns the scores into calibrated probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import blocks, byte_slices, code_points, remainder_of_id, sample_by_class, segment_sums, texts_of

# Rows taken of each language, at most (on average over hashes of the ids).
SAMPLE_PER_LANGUAGE = 1000
UNDETERMINED = "und"
# A tf-idf value is the share of an n-gram in its text times its idf times this.
SCALE = 64.0
# An n-gram is known if it occurs in that share of a language's sampled rows (in one of them at least).
KNOWN_SHARE = 0.005
# The unknown share that a text may always have, and how far it may exceed what its language's own rows have.
ALLOWED_FLOOR, ALLOWED_FACTOR = 0.02, 1.5
# Words with a digit (keys, numbers, codes) are of no language.
CODE = re.compile(r"(?<!\w)[^\W\d]*+\d\w*+")


@dataclass(frozen=True)
class Settings:
    bits: int = 15
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    rows_seen: int = 16_000
    batch: int = 16
    calibration_share: float = 0.2
    seed: int = 11


@dataclass(frozen=True)
class LanguageModel:
    """``weights[bucket]`` already holds the idf; ``languages`` are sorted.

    ``allowed[bucket]`` is the share of unknown n-grams that goes with a known one, -1 for an unknown one.
    """

    languages: list[str]
    bits: int
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    allowed: np.ndarray

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores per text and language before calibration, and whether the text has a letter."""
        parts, rows = blocks(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        for ids, starts in grams(parts, self.bits):
            np.add.at(sums, rows, segment_sums(self.weights[ids], starts))
            np.add.at(counts, rows, np.diff(np.append(starts, len(ids))))
        return sums * (SCALE / np.maximum(counts, 1))[:, None] + self.bias, counts > 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability; ``und`` with 0 where a text has no letter."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        logits, known = self.logits(texts)
        p = softmax(logits / self.temperature)
        best = p.argmax(1)
        names = [self.languages[i] if k else UNDETERMINED for i, k in zip(best, known)]
        return names, np.where(known, p[np.arange(len(texts)), best], 0.0)

    def covers(self, texts: list[str]) -> np.ndarray:
        """Whether the n-grams of each text are those of learned languages; True for all if none was learned.

        A text may have as many unknown n-grams as the languages of its known ones allow, and two standard
        deviations more, so that a short text is not rejected by one odd word; words with a digit do not count. Scores are not used: they
        compare the learned languages with each other and say nothing of any other.
        """
        if not self.languages:
            return np.ones(len(texts), dtype=bool)
        parts, rows = blocks([CODE.sub(" ", t) for t in texts])
        known = self.allowed >= 0
        table = np.stack([known, np.where(known, self.allowed, 0.0)], axis=1)
        sums, counts = np.zeros((len(texts), 2)), np.zeros(len(texts))
        for ids, starts in grams(parts, self.bits):
            np.add.at(sums, rows, segment_sums(table[ids], starts))
            np.add.at(counts, rows, np.diff(np.append(starts, len(ids))))
        expected = sums[:, 1] / np.maximum(sums[:, 0], 1) * counts
        return (counts > 0) & (counts - sums[:, 0] <= expected + 2 * np.sqrt(expected))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


_LETTER: list[np.ndarray] = []


def letters(chars: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter (table for the basic plane, lookup of the others one by one)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(1 << 16)), dtype=bool, count=1 << 16))
    low = chars < (1 << 16)
    out = _LETTER[0][np.where(low, chars, 0)]
    if not low.all():
        values, where = np.unique(chars[~low], return_inverse=True)
        out[~low] = np.array([chr(v).isalpha() for v in values])[where]
    return out


def grams(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all letter pairs and triples, text after text, and where each text starts in them."""
    chars, starts = code_points([" " + t.lower() for t in texts])
    plain = np.append(np.where(letters(chars), chars, 0), [0]).astype(np.uint32)
    two = plain[:-1] * np.uint32(0x01000193) + plain[1:]
    three = two[:-1] * np.uint32(0x01000193) + plain[2:] + np.uint32(3)
    at_two = np.flatnonzero((plain[:-1] != 0) | (plain[1:] != 0))
    at_three = np.flatnonzero(plain[1:-1] != 0)
    return [
        (_bucket(two[at_two], bits), np.searchsorted(at_two, starts)),
        (_bucket(three[at_three], bits), np.searchsorted(at_three, starts)),
    ]


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x7FEB352D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x846CA68B)
    return (h >> np.uint32(32 - bits)).astype(np.int32)


def counted(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compressed rows: distinct buckets of each text with their shares of the text's n-grams."""
    parts, rows = blocks(texts)
    found = grams(parts, bits)
    row = np.concatenate([np.repeat(rows, np.diff(np.append(starts, len(ids)))) for ids, starts in found])
    ids = np.concatenate([ids for ids, _ in found])
    key, n = np.unique(row.astype(np.int64) << bits | ids, return_counts=True)
    total = np.bincount(row, minlength=len(texts))
    starts = np.searchsorted(key >> bits, np.arange(len(texts) + 1))
    return (key & ((1 << bits) - 1)).astype(np.int32), (n / total[key >> bits]).astype(np.float32), starts


# Texts whose buckets are marked in one table at a time, a byte for each text and bucket.
TABLE_ROWS = 512


def document_frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """In how many of the texts (one string column) each bucket occurs, and the number of texts.

    Every task sends one row per bucket at most, so the shuffle grows with the number of tasks only and
    what is collected has a fixed size.
    """
    buckets = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(buckets, dtype=np.int64), 0
        for batch in batches:
            for part in byte_slices(batch, 0, rows=TABLE_ROWS):
                parts, rows = blocks(texts_of(part, 0))
                seen = np.zeros((part.num_rows, buckets), dtype=bool)
                for ids, starts in grams(parts, bits):
                    seen[np.repeat(rows, np.diff(np.append(starts, len(ids)))), ids] = True
                total += seen.sum(0)
                n += part.num_rows
        used = np.append(np.flatnonzero(total), [buckets])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.append(total[used[:-1]], [n]))], ["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets + 1, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out[:buckets], int(out[buckets])


def train(
    texts: list[str], names: list[str], frequencies: np.ndarray, n_texts: int, settings: Settings = Settings()
) -> LanguageModel:
    """Follow the regularised leader, per coordinate, on the softmax loss; then fit the temperature."""
    languages = sorted(set(names))
    labels = np.array([languages.index(n) for n in names], dtype=np.int64)
    buckets, k = 1 << settings.bits, len(languages)
    idf = np.log((1.0 + n_texts) / (1.0 + frequencies)) + 1.0
    z, n = np.zeros((buckets, k)), np.zeros((buckets, k))
    bias = np.zeros(k)
    if not texts:
        return LanguageModel([], settings.bits, z, bias, 1.0, np.full(buckets, -1.0, dtype=np.float32))
    rng = np.random.default_rng(settings.seed)
    aside = rng.random(len(texts)) < settings.calibration_share
    learn = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(texts))
    each = []
    for at in range(0, len(texts), 50):
        ids, share, starts = counted(texts[at : at + 50], settings.bits)
        value = (share * idf[ids] * SCALE).astype(np.float32)
        each += [(ids[a:b], value[a:b]) for a, b in zip(starts[:-1], starts[1:])]

    def current(ids: np.ndarray) -> np.ndarray:
        pull = np.sign(z[ids]) * settings.l1 - z[ids]
        scale = (settings.beta + np.sqrt(n[ids])) / settings.alpha + settings.l2
        return np.where(np.abs(z[ids]) > settings.l1, pull / scale, 0.0)

    for _ in range(-(-settings.rows_seen // len(learn))):
        order = rng.permutation(learn)
        for at in range(0, len(order), settings.batch):
            chosen = order[at : at + settings.batch]
            counts = np.array([len(each[i][0]) for i in chosen])
            if not counts.sum():
                continue
            ids, where = np.unique(np.concatenate([each[i][0] for i in chosen]), return_inverse=True)
            value = np.concatenate([each[i][1] for i in chosen])
            w = current(ids)
            p = softmax(segment_sums(w[where] * value[:, None], np.cumsum(counts) - counts) + bias)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            per_row = np.repeat(p, counts, axis=0) * (value / len(chosen))[:, None]
            g = np.stack([np.bincount(where, per_row[:, c], len(ids)) for c in range(k)], axis=1)
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / settings.alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
            bias -= 0.05 * p.mean(0)
    weights = current(np.arange(buckets)) * idf[:, None]
    allowed = allowed_unknown(each, idf, labels, k)
    model = LanguageModel(languages, settings.bits, weights.astype(np.float32), bias, 1.0, allowed)
    held = np.flatnonzero(aside) if aside.any() else learn
    logits, known = model.logits([texts[i] for i in held])
    temperature = calibrate(logits[known], labels[held][known])
    return LanguageModel(languages, settings.bits, model.weights, bias, temperature, allowed)


def allowed_unknown(each: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Per bucket, the share of unknown n-grams its language's texts may have; -1 where no language knows it.

    A language's limit comes from its own rows, each compared with all rows but itself, so it does not depend on
    the number of languages and is wide for one with few rows. A bucket counts for the language with most of it.
    """
    rows_with = np.zeros((len(idf), k))
    for (ids, _), c in zip(each, labels):
        rows_with[ids, c] += 1
    n_rows = np.bincount(labels, minlength=k)
    level = np.maximum(1, np.ceil(KNOWN_SHARE * n_rows))
    unknown = np.zeros(len(each))
    for row, ((ids, value), c) in enumerate(zip(each, labels)):
        others = rows_with[ids]
        others[:, c] -= 1
        odd = ~(others >= level).any(1)
        unknown[row] = (value[odd] / (idf[ids[odd]] * SCALE)).sum()
    long = np.array([len(ids) >= 50 for ids, _ in each])
    limits = np.zeros(k)
    for c in range(k):
        own = (labels == c) & long if ((labels == c) & long).any() else labels == c
        limits[c] = max(ALLOWED_FLOOR, ALLOWED_FACTOR * np.quantile(unknown[own], 0.99))
    home = (rows_with / n_rows).argmax(1)
    return np.where((rows_with >= level).any(1), limits[home], -1.0).astype(np.float32)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search of its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = np.log(0.2), np.log(20.0), (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    settings: Settings = Settings(),
) -> LanguageModel:
    """Learn from rows with text, language and id whose crc32 of the id as text, modulo 4, is not 2.

    Document frequencies come from all these rows, weights from about ``per_language`` whole texts of each
    language at most. Without any such row every text is ``und``.
    """
    usable = docs.select(
        F.col(id_column).alias("_id"), F.col(text_column).alias("_text"), F.col(label_column).alias("_lang")
    ).where(
        F.col("_id").isNotNull() & F.col("_text").isNotNull() & F.col("_lang").isNotNull() & (remainder_of_id("_id", 4) != 2)
    )
    frequencies, n_texts = document_frequencies(usable.select("_text"), settings.bits)
    rows = sample_by_class(usable, "_id", "_lang", per_language).toArrow()
    rows = rows.take(pc.sort_indices(rows, [("_id", "ascending"), ("_lang", "ascending"), ("_text", "ascending")]))
    return train(rows["_text"].to_pylist(), rows["_lang"].to_pylist(), frequencies, n_texts, settings)


def identify_language(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``.

    A null text or one without letters is ``und`` with score 0; a null id counts as held out. Repeated rows
    give repeated results; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                names, score = shipped.value.predict(texts_of(part, "_text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score)], ["_id", "lang_pred", "score"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        run, f"_id {kind}, lang_pred string, score double"
    )
    return found.select(
        F.col("_id").alias(id_column),
        F.coalesce(remainder_of_id("_id", 4) == 2, F.lit(True)).alias("held_out"),
        "lang_pred",
        "score",
    )


def keep_known(docs: DataFrame, model: LanguageModel, text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """Rows whose text consists of learned languages, one or several of them, with all their columns.

    Texts without letters and those of other languages go (see ``LanguageModel.covers``). The rows that stay carry
    the predicted language as ``label_column``, if there is such a column: what follows goes by the text and not by
    its source's label, which may be null or wrong. If no language was learned all rows stay as they are.
    """
    if not model.languages:
        return docs
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)
    label = docs.columns.index(label_column) if label_column in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, place):
                part = part.filter(pa.array(shipped.value.covers(texts_of(part, place))))
                if label is not None and part.num_rows:
                    names, _ = shipped.value.predict(texts_of(part, place))
                    part = part.set_column(label, part.schema.field(label), pa.array(names, part.schema.field(label).type))
                yield part

    return docs.mapInArrow(run, docs.schema)
