"""Similarity join of documents by the Jaccard likeness of their word n-grams, down to linked components.

Rare-first prefix filtering: n-grams have one global order by how many documents hold them (a fixed-size
table of counts over all documents, then the hash). Two sets that are alike enough share an n-gram among the
first ``n - ceil(t * n) + 1`` of each, so only these prefix n-grams are joined.

1. Equal sets become one node (least id), counted apart.
2. Prefix n-grams are shuffled and sorted once; a task streams over the runs of equal n-grams. The first
   document of a run is its pivot, and (document, pivot) are the first candidates: as many as rows, not
   pairs. N-grams far over the mean count are salted, their pivots then meet in a second step.
3. Length and positional filters, then a suffix filter: the parities of the n-grams in hashed bins; where
   two differ in more bins than the sizes allow differing n-grams, the sets cannot be alike. What is left is
   verified once per pair on the full sets.
4. Linked documents get components. Pairs of one component need no further test; runs that still hold
   several are compared in full, in blocks of bounded size, with the same filters and verification.

All steps are exact: two linked documents share a run at their first common prefix n-gram, where no filter
rejects them, so they are tested there unless they already have one component.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from airq.llm.common import byte_slices
from airq.llm.graph import connected_components
from airq.llm.shingles import shingle_hashes
from airq.session import materialise

LEVEL_BITS = 20
SLICES = 64


@dataclass(frozen=True)
class Settings:
    """``percent``: the least 100 * intersection / union. The rest bounds work per task, not results."""

    width: int = 5
    percent: int = 75
    # An n-gram is salted if about that many documents hold it and it is far over the mean count.
    hot_documents: int = 20_000
    hot_factor: int = 8
    # Rows of one side of a full comparison.
    block: int = 512
    # So many ids at most are broadcast to pick documents from a scan; more are joined with a shuffle.
    broadcast_ids: int = 1_000_000

    def prefix(self, n):
        """Number of n-grams that are joined, of a set of ``n``."""
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, total):
        """Least intersection of two sets whose sizes sum up to ``total``."""
        return -(-self.percent * total // (100 + self.percent))


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.schema.get_field_index("_text")).cast(pa.binary()).to_pylist()]


def ordered_keys(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Distinct n-grams as keys whose numeric order is rare first: level, then 56 bits of the hash."""
    level = levels[hashes >> np.uint64(64 - LEVEL_BITS)].astype(np.uint64)
    return np.unique(level << np.uint64(56) | hashes >> np.uint64(8))


def count_levels(docs: DataFrame, width: int) -> tuple[np.ndarray, float]:
    """Per hash bin, eight times the binary logarithm of the number of (document, n-gram) in it; the mean number.

    A task sends its bins as ``SLICES`` rows; each slice is summed up as a stream. What is collected and
    broadcast later has ``2 ** LEVEL_BITS`` entries at every size of the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(1 << LEVEL_BITS, dtype=np.uint32)
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                each = [np.unique(h) for h in shingle_hashes(texts_of(part), width)]
                found = np.concatenate(each) >> np.uint64(64 - LEVEL_BITS)
                bins += np.bincount(found.astype(np.int64), minlength=len(bins)).astype(np.uint32)
        parts = [bins[i::SLICES].tobytes() for i in range(SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts)], ["slice", "bins"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                bins = np.frombuffer(raw.as_buffer(), dtype=np.uint32)
                sums[i] = sums[i] + bins if i in sums else bins.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["slice", "bins"]
        )

    counted = docs.select("_text").mapInArrow(count, "slice int, bins binary")
    rows = counted.repartitionById(SLICES, "slice").mapInArrow(add, "slice int, bins binary").toArrow()
    total = np.zeros(1 << LEVEL_BITS, dtype=np.int64)
    for i, raw in zip(rows["slice"].to_pylist(), rows["bins"].to_pylist()):
        total[i::SLICES] = np.frombuffer(raw, dtype=np.int64)
    return np.minimum(255, np.log2(total + 1.0) * 6).astype(np.uint8), float(total.mean())


def set_digests(docs: DataFrame, width: int) -> DataFrame:
    """``(_id, n, digest)`` for each row; equal sets have equal digests of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column(0), *digests_of(texts_of(part), width)], ["_id", "n", "digest"])

    return docs.mapInArrow(run, f"_id {_kind(docs)}, n long, digest binary")


def digests_of(texts: list[bytes], width: int) -> tuple[pa.Array, pa.Array]:
    sets = [np.unique(h) for h in shingle_hashes(texts, width)]
    digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
    return pa.array(list(map(len, sets)), pa.int64()), pa.array(digests, pa.binary())


def plain_key() -> Column:
    return F.concat(F.lit("="), F.col("_id").cast("string"))


def text_key() -> Column:
    """A key for rows of one id and one set only."""
    return F.concat(F.lit("#"), F.hex("digest"), plain_key())


def keyed_texts(docs: DataFrame, mixed: DataFrame, settings: Settings) -> DataFrame:
    """``(_id, _text)`` with keys as ids: of the text for the ids in ``mixed(_id)``, plain ones for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                digests = digests_of(texts_of(part), settings.width)[1]
                yield pa.RecordBatch.from_arrays([*part.columns, digests], ["_id", "_text", "digest"])

    told = pick(docs, mixed, settings).select("_id", "_text").mapInArrow(run, f"_id {_kind(docs)}, _text string, digest binary")
    others = without(docs, mixed, settings).select(plain_key().alias("_id"), "_text")
    return others.unionByName(told.select(text_key().alias("_id"), "_text"))


def _kind(docs: DataFrame) -> str:
    return docs.schema["_id"].dataType.simpleString()


def prefix_postings(docs: DataFrame, levels, mean: float, settings: Settings) -> DataFrame:
    """``(gram, salt, doc, n, at)``: the prefix n-grams of each row with the set's size and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        hot = max(settings.hot_documents, settings.hot_factor * mean)
        salts = np.maximum(1, np.exp2(np.arange(256) / 6) / hot).astype(np.int64)
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                sets = [ordered_keys(h, table) for h in shingle_hashes(texts_of(part), settings.width)]
                sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                taken = np.where(sizes > 0, settings.prefix(sizes), 0)
                row = np.repeat(np.arange(len(sets)), taken)
                grams = np.concatenate([s[:k] for s, k in zip(sets, taken)])
                at = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
                spread = salts[(grams >> np.uint64(56)).astype(np.int64)]
                where = np.array([zlib.crc32(str(i).encode()) for i in part.column(0).to_pylist()], dtype=np.int64)
                salt = np.where(spread > 1, 1 + where[row] % spread, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.view(np.int64)),
                        pa.array(salt.astype(np.int32)),
                        part.column(0).take(pa.array(row)),
                        pa.array(sizes[row].astype(np.int32)),
                        pa.array(at.astype(np.int32)),
                    ],
                    ["gram", "salt", "doc", "n", "at"],
                )

    return docs.mapInArrow(run, f"gram long, salt int, doc {_kind(docs)}, n int, at int")


def shared_members(postings: DataFrame) -> DataFrame:
    """Rows of n-grams that several documents share, each with the first document of its run (the pivot).

    Of a run of two only the second row is sent (``many`` is false), of a longer one all rows, of a salted
    n-gram all rows of all runs. Runs are read as a stream: a task holds one batch and the first rows of a run.
    """
    kind = dict(postings.dtypes)["doc"]
    names = ["gram", "salt", "doc", "n", "at", "pivot", "pivot_n", "pivot_at", "many"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last run, as long as they are fewer than three
        head = None  # the first row of the last run, once rows of it were sent
        for batch in _then_none(b for b in batches if b.num_rows):
            tables = [t for t in (head, held, batch and pa.Table.from_batches([batch])) if t is not None]
            if not tables:
                return
            rows = pa.concat_tables(tables)
            gram, salt = rows["gram"].to_numpy(), rows["salt"].to_numpy()
            new = np.ones(len(gram), dtype=bool)
            new[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(gram)))
            run_of = np.cumsum(new) - 1
            many = (sizes > 2) | (salt[starts] > 0)
            if head is not None:
                many[0] = True
            send = many[run_of] | (~new & (sizes == 2)[run_of])
            if head is not None:
                send[0] = False  # this row was sent with its run's first rows
            last = int(starts[-1])
            short = batch is not None and not many[-1]
            if short:
                send[last:] = False
            at = np.flatnonzero(send)
            if len(at):
                pivots = rows.select(["doc", "n", "at"]).take(pa.array(starts[run_of[at]]))
                columns = [*rows.take(pa.array(at)).columns, *pivots.columns, pa.chunked_array([pa.array(many[run_of[at]])])]
                yield pa.table(columns, names=names).combine_chunks().to_batches()[0]
            if batch is None:
                return
            held = rows.slice(last).combine_chunks() if short else None
            head = None if short else rows.slice(last, 1).combine_chunks()

    return (
        postings.repartition("gram", "salt")
        .sortWithinPartitions("gram", "salt", "doc")
        .mapInArrow(
            run, f"gram long, salt int, doc {kind}, n int, at int, pivot {kind}, pivot_n int, pivot_at int, many boolean"
        )
    )


def _then_none(items):
    yield from items
    yield None


def plausible(n, at, other_n, other_at, settings: Settings):
    """Length and positional filter as a column: may two sets whose first common n-gram this is be alike enough?

    Taken for every common n-gram: a pair that fails at a later one is still met at its first.
    """
    n, at, other_n, other_at = (c.cast("long") for c in (n, at, other_n, other_at))
    lengths = F.least(n, other_n) * 100 >= F.greatest(n, other_n) * settings.percent
    total = n + other_n
    needed = F.ceil(total * settings.percent / F.lit(100.0 + settings.percent) - F.lit(1e-9))
    return lengths & (F.least(n - at, other_n - other_at) >= needed)


def pivot_candidates(members: DataFrame, settings: Settings) -> DataFrame:
    """Distinct ``(a, b)`` of a document and the pivot of a run, and of pivots of one salted n-gram."""
    met = members.where(F.col("doc") != F.col("pivot")).select("doc", "n", "at", "pivot", "pivot_n", "pivot_at")
    heads = members.where("salt > 0").select("gram", "pivot", "pivot_n", "pivot_at").distinct()
    least = heads.groupBy("gram").agg(F.min(F.struct("pivot", "pivot_n", "pivot_at")).alias("head"))
    across = heads.join(least, "gram").where(F.col("pivot") != F.col("head.pivot"))
    across = across.select(
        F.col("pivot").alias("doc"), F.col("pivot_n").alias("n"), F.col("pivot_at").alias("at"),
        F.col("head.pivot").alias("pivot"), F.col("head.pivot_n").alias("pivot_n"), F.col("head.pivot_at").alias("pivot_at"),
    )
    return (
        met.unionByName(across)
        .where(plausible(F.col("n"), F.col("at"), F.col("pivot_n"), F.col("pivot_at"), settings))
        .select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b"))
        .distinct()
    )


def pick(docs: DataFrame, ids: DataFrame, settings: Settings) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids(_id)``; a checked number of ids is broadcast."""
    few = ids.count() <= settings.broadcast_ids
    return docs.join(F.broadcast(ids) if few else ids, "_id", "left_semi")


def without(docs: DataFrame, ids: DataFrame, settings: Settings) -> DataFrame:
    few = ids.count() <= settings.broadcast_ids
    return docs.join(F.broadcast(ids) if few else ids, "_id", "left_anti")


def bins_of(n: int) -> int:
    """Number of parity bins for a set of ``n``: a power of two, four times the size, at most 2**16."""
    return min(1 << 16, max(64, 1 << (4 * n - 1).bit_length()))


def parity_sketch(hashes: np.ndarray) -> bytes:
    """Parity of the number of distinct n-grams in each bin, one bit a bin."""
    distinct = np.unique(hashes >> np.uint64(8))
    bins = bins_of(len(distinct))
    counts = np.bincount((distinct & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def fold(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) with fewer bins: halves laid over each other."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def sketches_of(docs: DataFrame, width: int) -> DataFrame:
    """``(_id, size, sketch)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                hashes = shingle_hashes(texts_of(part), width)
                made = pa.array([parity_sketch(h) for h in hashes], pa.binary())
                sizes = pa.array([len(np.unique(h)) for h in hashes], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, made], ["_id", "size", "sketch"])

    return docs.mapInArrow(run, f"_id {_kind(docs)}, size int, sketch binary")


def suffix_filter(pairs: DataFrame, sketches: DataFrame, settings: Settings) -> DataFrame:
    """Those ``(a, b)`` whose parity sketches leave room for the needed overlap."""
    side = lambda s: sketches.select(F.col("_id").alias(s), F.col("size").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}"))
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b"))):
                x, y = np.frombuffer(x, dtype=np.uint64)[None], np.frombuffer(y, dtype=np.uint64)[None]
                words = min(x.shape[1], y.shape[1])
                apart = int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum())
                keep.append(apart <= n + m - 2 * settings.overlap(n + m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, f"a {kind}, b {kind}")


def verify(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Those ``(a, b)`` that link, by the full sets of their texts."""
    kind = dict(pairs.dtypes)["a"]

    def side(s: str) -> DataFrame:
        texts = pick(docs, pairs.select(F.col(s).alias("_id")).distinct(), settings)
        return texts.select(F.col("_id").alias(s), F.col("_text").alias(f"t_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(*(batch.column(c).to_pylist() for c in ("t_a", "t_b"))):
                x, y = map(np.unique, shingle_hashes([(s or "").encode(), (t or "").encode()], settings.width))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= settings.percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def rest_candidates(members: DataFrame, labels: DataFrame, sketches: DataFrame, settings: Settings) -> DataFrame:
    """Distinct pairs of different components that share a prefix n-gram and pass all filters."""
    several = members.where("many").select("gram", "doc", "n", "at")
    few = labels.count() <= settings.broadcast_ids
    tagged = several.join(F.broadcast(labels) if few else labels, F.col("doc") == F.col("node"), "left")
    tagged = tagged.select("gram", "doc", "n", "at", F.coalesce("component", "doc").alias("part"))
    mixed_runs = (
        tagged.groupBy("gram")
        .agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("rows"))
        .where("p <> q and rows > 2")
        .select("gram", F.ceil(F.col("rows") / settings.block).cast("int").alias("blocks"))
    )
    rows = tagged.join(mixed_runs, "gram").withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "gram", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "doc", "n", "at", "part"
    )
    kind = dict(members.dtypes)["doc"]

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["gram", "i", "j"]):
            found = np.unique(np.concatenate(compare_all(group, settings)))
            if len(found):
                yield group.take(pa.array(found)).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["gram", "i", "j"]):
            a, b = compare_all(group, settings)
            docs = group["doc"].combine_chunks()
            yield pa.RecordBatch.from_arrays([docs.take(pa.array(a)), docs.take(pa.array(b))], ["x", "y"])

    def by_run(df: DataFrame) -> DataFrame:
        return df.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j")

    # sketches go only with rows that have a partner by length and place
    alive = by_run(rows).mapInArrow(partners, rows.schema)
    alive = alive.join(sketches.select(F.col("_id").alias("doc"), "sketch"), "doc")
    found = by_run(alive).mapInArrow(run, f"x {kind}, y {kind}")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys; a run has two blocks of rows at most."""
    held = None
    for batch in _then_none(b for b in batches if b.num_rows):
        if batch is None:
            if held is not None:
                yield held
            return
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        change = np.zeros(len(table) - 1, dtype=bool)
        for k in keys:
            column = table[k].to_numpy()
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield table.slice(start, end - start)
        held = table.slice(cuts[-1])


def compare_all(group: pa.Table, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs in a run (of two blocks: across them) that pass every filter.

    Pairs of one component are passed over. The positional filter is that of ``plausible``. Without a column ``sketch`` the suffix filter is left out. Sizes of
    a pair differ by less than a third, so sets with as many bins or twice as many meet.
    """
    n, at = group["n"].to_numpy().astype(np.int64), group["at"].to_numpy().astype(np.int64)
    part = pc.dictionary_encode(group["part"].combine_chunks()).indices.to_numpy()
    mine = group["mine"].to_numpy()
    across = group["i"][0].as_py() != group["j"][0].as_py()
    with_sketch = "sketch" in group.column_names
    raw = [np.frombuffer(s, dtype=np.uint64) for s in group["sketch"].to_pylist()] if with_sketch else []
    words = np.array([len(r) for r in raw]) if with_sketch else np.ones(len(n), dtype=np.int64)
    left, right = [], []
    for w in np.unique(words):
        rows = np.flatnonzero(words == w)
        near = np.flatnonzero((words == w) | (words == 2 * w))
        if with_sketch:
            stack = np.concatenate([fold(raw[i][None], w) for i in near])
            own = np.searchsorted(near, rows)
        step = max(1, 2_000_000 // (len(near) * int(w)))
        for k in range(0, len(rows), step):
            x = rows[k : k + step, None]
            total = n[x] + n[near]
            need = settings.overlap(total)
            fits = (part[x] != part[near]) & (np.minimum(n[x], n[near]) * 100 >= np.maximum(n[x], n[near]) * settings.percent)
            fits &= np.minimum(n[x] - at[x], n[near] - at[near]) >= need
            fits &= (words[near] != w) | (near > x)
            if across:
                fits &= mine[x] != mine[near]
            i, j = np.nonzero(fits)
            if with_sketch:
                apart = np.bitwise_count(stack[own[k + i]] ^ stack[j]).sum(1, dtype=np.int64)
                ok = apart <= total[i, j] - 2 * need[i, j]
                i, j = i[ok], j[ok]
            left.append(rows[k + i])
            right.append(near[j])
    return np.concatenate(left), np.concatenate(right)


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (least id reachable by links).

    Words are runs of other characters than ASCII white space, A-Z folded to a-z. A text with fewer words
    than ``width`` has its whole sequence as the only n-gram. Null texts and texts without words have no
    n-gram and stay alone, as do rows with a null id (their component is null). Rows of one text have one
    component, whatever their ids; other columns are not read.
    """
    docs = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    placed, _ = row_components(docs, settings)
    return placed.select(F.col("_id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def row_components(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """``(_id, n, digest, part, component_id)`` of each row of ``docs(_id, _text)``, and the ids of several rows with words.

    ``part`` is the linked group, ``component_id`` its least id; two groups have one ``component_id`` if texts
    that do not link share it. Ids are the nodes as long as each has one set; otherwise texts of the ids with
    several get keys of their own, and the documents are read once more for that.
    """
    spark = docs.sparkSession
    named = docs.where(F.col("_id").isNotNull())
    digests = materialise(set_digests(docs, settings.width))
    again = materialise(digests.where("n > 0").groupBy("_id").count().where("count > 1").select("_id"))
    rows, mixed = digests.withColumn("key", F.col("_id")), None
    if not again.isEmpty():
        sets = pick(digests.where("n > 0"), again, settings).groupBy("_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
        mixed = materialise(sets.where("a <> b").select("_id"))
        mixed = None if mixed.isEmpty() else mixed
    if mixed is not None:
        told = digests.join(mixed.withColumn("mixed", F.lit(True)), "_id", "left")
        rows = told.withColumn("key", F.when(F.col("mixed"), text_key()).otherwise(plain_key())).drop("mixed")
        named = keyed_texts(named, mixed, settings)
    filled = rows.where((F.col("n") > 0) & F.col("key").isNotNull())
    nodes = filled.groupBy("digest", "n").agg(F.min("key").alias("node"))
    copies = materialise(
        filled.join(nodes, ["digest", "n"]).where(F.col("key") != F.col("node")).select(F.col("key").alias("_id")).distinct()
    )
    single = without(named, copies, settings)
    table, mean = count_levels(named, settings.width)
    levels = spark.sparkContext.broadcast(table)
    members = materialise(shared_members(prefix_postings(single, levels, mean, settings)))
    shared = members.select(F.explode(F.array("doc", "pivot")).alias("_id")).distinct()
    sketches = materialise(sketches_of(pick(single, shared, settings), settings.width))
    first = materialise(suffix_filter(pivot_candidates(members, settings), sketches, settings))
    links = materialise(verify(first, named, settings))
    rest = rest_candidates(members, connected_components(links), sketches, settings)
    rest = materialise(rest.join(first, ["a", "b"], "left_anti"))
    links = links.unionByName(verify(rest, named, settings))
    parts = connected_components(links)
    placed = rows.join(nodes, ["digest", "n"], "left").join(parts, "node", "left")
    placed = placed.select(
        "_id", "n", "digest", F.when(F.col("_id").isNotNull(), F.coalesce("component", "node", "key")).alias("part")
    )
    if mixed is None:
        return placed.withColumn("component_id", F.col("part")), again
    placed = materialise(placed)
    least = placed.where("part is not null").groupBy("part").agg(F.min("_id").alias("component_id"))
    return placed.join(least, "part", "left").select("_id", "n", "digest", "part", "component_id"), again


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Rows of ``docs`` that stay when each linked group keeps one row, of its least id, with all their columns.

    Rows without words stay. Of repeated rows of the kept id one stays: of several texts the one with the least
    digest, of several rows of it the least. Rows without an id are in no group; of those with equal sets one
    stays, the least. Only rows of ids that several rows with words have are shuffled for that.
    """
    pair = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    found, again = row_components(pair, settings)
    found = materialise(found)
    away = materialise(found.where("_id <> component_id").select("_id").distinct())
    few = away.count() <= settings.broadcast_ids
    rest = docs
    n_again = again.count()
    if n_again:
        some = F.broadcast(again) if n_again <= settings.broadcast_ids else again
        rest = docs.join(some, docs[id_column].eqNullSafe(some["_id"]), "left_anti")
    left = rest.join(F.broadcast(away) if few else away, rest[id_column] == away["_id"], "left_anti")
    if not n_again:
        return left
    kept = found.join(some, found["_id"].eqNullSafe(some["_id"]), "left_semi").where("n > 0")
    sets = kept.where("_id = component_id").groupBy("_id", "part").agg(F.min("digest").alias("digest"))
    sets = sets.select("_id", "digest").unionByName(kept.where("_id is null").select("_id", "digest").distinct())
    size, digest = free_name("_n", docs), free_name("_digest", docs)
    repeated = with_sets(docs.join(some, docs[id_column].eqNullSafe(some["_id"]), "left_semi"), text_column, size, digest, settings)
    worded = repeated.where(F.col(size) > 0)
    worded = worded.join(sets, worded[id_column].eqNullSafe(sets["_id"]) & (worded[digest] == sets["digest"]), "left_semi")
    order = [text_column, *(f.name for f in docs.schema if "map<" not in f.dataType.simpleString() and f.name != text_column)]
    least = F.min_by(F.struct(*docs.columns), F.struct(*order))
    single = worded.groupBy(worded[id_column].alias("_key"), worded[digest].alias("_set")).agg(least.alias("_row")).select("_row.*")
    return left.unionByName(repeated.where(F.col(size) == 0).select(*docs.columns)).unionByName(single)


def free_name(name: str, df: DataFrame) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_sets(docs: DataFrame, text_column: str, size: str, digest: str, settings: Settings) -> DataFrame:
    """``docs`` with the size and digest of each text's set as columns of these names."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, place):
                texts = [t or b"" for t in part.column(place).cast(pa.binary()).to_pylist()]
                found = digests_of(texts, settings.width)
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, size, digest])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(size, LongType()), StructField(digest, BinaryType())]))
