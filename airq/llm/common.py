"""What the text operators share: walking Arrow batches in bounded slices, column checks, training samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text that one step of a Python task holds decoded at a time (a longer text is a step of its own).
SLICE_BYTES = 2_000_000
# White space that separates words.
WORD_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes together, of at most ``rows`` rows if given."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, "right")))
        end = min(end, start + rows) if rows else end
        yield batch.slice(start, end - start)
        start = end


def map_slices(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that applies ``work`` to bounded slices of every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, column, limit):
                yield work(part)

    return run


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a slice; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum ``values`` (first axis) between consecutive ``starts``; empty segments give zero."""
    ends = np.append(starts[1:], len(values))
    out = np.zeros((len(starts), *values.shape[1:]), dtype=np.float64)
    full = ends > starts
    if full.any():
        out[full] = np.add.reduceat(values, starts[full], axis=0, dtype=np.float64)
    return out


def remainder_of_id(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def sample_by_class(df: DataFrame, id_column: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label value, chosen by a hash of the id.

    Counting the labels reads two columns; whole texts are read only for chosen rows. The share that is
    taken follows from the counts, so what reaches the driver does not grow with the table.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] is not None}
    grain = 1 << 40
    spot = F.pmod(F.xxhash64(F.lit("training sample"), F.col(id_column)), F.lit(grain))
    chosen = F.lit(False)
    for value, n in counts.items():
        share = min(1.0, per_class / n)
        chosen = chosen | ((F.col(label) == F.lit(value)) & (spot < F.lit(int(share * grain))))
    return df.where(chosen)


def blocks(texts: list[str], limit: int = 1_000_000) -> tuple[list[str], np.ndarray]:
    """Texts cut into blocks of at most ``limit`` characters, with the row each block belongs to.

    A cut falls behind the last space of the block, so that only words longer than a block are split.
    """
    if not any(len(t) > limit for t in texts):
        return texts, np.arange(len(texts))
    out, rows = [], []
    for row, text in enumerate(texts):
        start = 0
        while True:
            end = start + limit
            if end >= len(text):
                out.append(text[start:])
                rows.append(row)
                break
            space = text.rfind(" ", start, end)
            end = space + 1 if space >= start else end
            out.append(text[start:end])
            rows.append(row)
            start = end
    return out, np.array(rows)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of all texts as one array, and where each text starts in it."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return chars, np.cumsum(lengths) - lengths


BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and ``BASE ** -i`` modulo 2**64 for ``i`` below ``n`` at least (kept for the process)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _POWERS[:] = [_geometric(BASE, size), _geometric(pow(BASE, -1, 1 << 64), size)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _geometric(base: int, size: int) -> np.ndarray:
    out = np.ones(size, dtype=np.uint64)
    done, step = 1, base & MASK
    while done < size:
        out[done : 2 * done] = out[:done] * np.uint64(step)
        step = step * step & MASK
        done *= 2
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits of the result depend on all bits of ``h``."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of ``symbols[start:end]`` for many spans at once, from prefix sums."""
    up, down = powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])
