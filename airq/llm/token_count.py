"""Token counts by heap-and-linked-list byte-pair merging; no token ids are emitted.

A word's bytes form a linked list of symbols, a heap holds the ranks of adjacent pairs. The lowest pair is
popped and merged again and again; the count is the number of symbols minus the number of merges.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import byte_slices, texts_of

# Fixed value: the pattern with which byte-level pre-tokenizers of this kind split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Distinct words whose counts one Python worker keeps, and the longest of them.
KEPT_WORDS = 1_000_000
KEPT_LENGTH = 48


# A pair is looked up as ``left << SHIFT | right`` and gives ``rank << SHIFT | merged``.
SHIFT = 20
LOW = (1 << SHIFT) - 1


def merge_by_heap(symbols: list[int], pair: Callable[[int], int | None]) -> list[int]:
    """Merge the lowest-ranked adjacent pair (leftmost of equal ones) until none is left.

    ``pair`` gives the rank and the merged symbol of two neighbours, or None; see ``SHIFT``.
    """
    n = len(symbols)
    sym = list(symbols)
    heap = []
    for i in range(n - 1):
        found = pair(sym[i] << SHIFT | sym[i + 1])
        if found is not None:
            heap.append((found >> SHIFT) * n + i)
    if not heap:
        return sym
    heapq.heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        j = after[i]
        if sym[i] < 0 or j >= n:
            continue
        found = pair(sym[i] << SHIFT | sym[j])
        if found is None or found >> SHIFT != rank:
            continue  # one of the two has changed since this entry was pushed
        merged = sym[i] = found & LOW
        sym[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = pair(merged << SHIFT | sym[k])
            if found is not None:
                heapq.heappush(heap, (found >> SHIFT) * n + i)
        h = before[i]
        if h >= 0:
            found = pair(sym[h] << SHIFT | merged)
            if found is not None:
                heapq.heappush(heap, (found >> SHIFT) * n + h)
    return [s for s in sym if s >= 0]


@dataclass(frozen=True)
class MergeTable:
    """Initial symbol of each byte, the packed pairs, and the special strings."""

    name: str
    first: list[int]
    pairs: dict[int, int]
    specials: list[str]


def printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_merges(path: str) -> MergeTable:
    """The merge table of a byte-level BPE tokenizer file (JSON)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    step = spec["pre_tokenizer"]
    added = spec["added_tokens"]
    odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if spec["normalizer"] or step["type"] != "ByteLevel" or step["add_prefix_space"] or not step["use_regex"] or odd:
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    vocabulary = spec["model"]["vocab"]
    pairs = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs[vocabulary[left] << SHIFT | vocabulary[right]] = rank << SHIFT | vocabulary[left + right]
    specials = sorted((t["content"] for t in added), key=len, reverse=True)
    return MergeTable(path, [vocabulary[c] for c in printable_bytes()], pairs, specials)


class WordCounts(dict):
    """Token count of each word met so far, computed when it is first asked for."""

    def __init__(self, table: MergeTable):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> int:
        first = self.table.first
        n = len(merge_by_heap([first[b] for b in word.encode()], self.table.pairs.get))
        if len(word) <= KEPT_LENGTH:
            self[word] = n
        return n


class TokenCounter:
    """Counts the tokens of texts; words repeat, so their counts are kept up to a fixed number."""

    def __init__(self, table: MergeTable):
        self.words = WordCounts(table)
        self.split = regex.compile(SPLIT).findall
        self.special = regex.compile("|".join(map(regex.escape, table.specials))) if table.specials else None

    def count(self, text: str) -> int:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        if self.special is None or not self.special.search(text):
            return sum(map(self.words.__getitem__, self.split(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.words.__getitem__, self.split(p))) for p in parts)


# One counter per worker process and tokenizer file; workers outlive tasks.
_COUNTERS: dict[str, TokenCounter] = {}


def counter_of(table: MergeTable) -> TokenCounter:
    if table.name not in _COUNTERS:
        _COUNTERS[table.name] = TokenCounter(table)
    return _COUNTERS[table.name]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Special strings of the tokenizer inside a text count as one token each. Null and empty texts have no
    tokens. The merge table is read on the driver and shipped, so executors need no tokenizer file.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_merges(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shipped.value)
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                texts = texts_of(part, "_text")
                sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
                counts = pa.array([counter.count(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, counts], ["_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    counted = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        run, f"_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.select(
        F.col("_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
