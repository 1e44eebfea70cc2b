"""Byte-level BPE encoding and decoding in padded numpy matrices.

The distinct words of a slice of texts are grouped by length. In a group every row is a word, every column
a symbol; each round every row merges its leftmost pair of lowest rank, found in a hashed pair table, and
rows that have no such pair leave the matrix. A word too long for a row is a matrix of its own, whose rows are
its parts in order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import byte_slices, texts_of

NONE = np.int32(2**31 - 1)
# Symbols of a row. A wider word takes several rows, of which the one with its leftmost pair of lowest rank merges in a round.
WIDEST = 128
# Cells of a matrix; more words of a length are merged in several.
CELLS = 1 << 20
# Distinct words whose ids one Python worker keeps, and the longest of them.
KEPT_WORDS = 250_000
KEPT_LENGTH = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTable:
    """Open addressing over ``left << 32 | right``; the value is the merged token, whose id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        key, value = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[free]  # of several keys for one slot the last stays
            placed = self.keys[slot] == key
            self.values[slot[placed]] = value[placed]
            key, value, slot = key[~placed], value[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find_one(self, left: int, right: int) -> int:
        key = left << 32 | right
        h = key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        slot = ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) >> 64 - self.bits
        while (seen := self.keys.item(slot)) != -1:
            if seen == key:
                return self.values.item(slot)
            slot = slot + 1 & (1 << self.bits) - 1
        return int(NONE)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the two do not merge (or ``right`` is padding)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(key.shape, NONE, dtype=np.int32)
        open_at = np.flatnonzero(right >= 0)
        key = key[open_at]
        slot = self._slot(key)
        while len(open_at):
            seen = self.keys[slot]
            hit = seen == key
            out[open_at[hit]] = self.values[slot[hit]]
            on = ~hit & (seen != -1)
            open_at, key, slot = open_at[on], key[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out


class Codec:
    """Encodes words to token ids and ids back to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.table = PairTable(ranks)
        self.split = regex.compile(pattern).findall
        self.words: dict[str, tuple[int, ...]] = {}

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(words)
        groups: dict[int, list[int]] = {}
        raw = [w.encode() for w in words]
        for i, b in enumerate(raw):
            if b in self.ranks:
                out[i] = (self.ranks[b],)
            elif len(b) > WIDEST:
                out[i] = self._merge_wide(b)
            else:
                groups.setdefault(-(-len(b) // 4) * 4, []).append(i)
        for width, members in groups.items():
            rows = max(1, CELLS // width)
            for at in range(0, len(members), rows):
                part = members[at : at + rows]
                for ids, i in zip(self._merge([raw[i] for i in part], width), part):
                    out[i] = ids
        return out

    def _merge(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        lengths = np.array([len(w) for w in words])
        held = np.arange(width) < lengths[:, None]
        symbols = np.full((len(words), width), -1, dtype=np.int32)
        symbols[held] = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        out: list[tuple[int, ...]] = [()] * len(words)
        row = np.arange(len(words))
        pairs = self.table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(words), width - 1)
        while len(row):
            column = pairs.argmin(1)
            best = pairs[np.arange(len(row)), column]
            ended = best == NONE
            if ended.any():
                for r, n, s in zip(row[ended].tolist(), lengths[ended].tolist(), symbols[ended].tolist()):
                    out[r] = tuple(s[:n])
                on = ~ended
                row, column, best, lengths = row[on], column[on], best[on], lengths[on]
                symbols, pairs = symbols[on], pairs[on]
                if not len(row):
                    break
            at = np.arange(len(row))
            symbols[at, column] = best
            # close the gap behind the merged symbol
            place = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, place + (place > column[:, None]), 1)
            place = np.arange(pairs.shape[1] - 1)
            pairs = np.take_along_axis(pairs, place + (place >= column[:, None]), 1)
            lengths = lengths - 1
            if not pairs.shape[1]:
                for r, s in zip(row.tolist(), symbols[:, 0].tolist()):
                    out[r] = (s,)
                break
            inside = np.flatnonzero(column < pairs.shape[1])
            pairs[inside, column[inside]] = self.table.find(best[inside], symbols[inside, column[inside] + 1])
            inside = np.flatnonzero(column > 0)
            pairs[inside, column[inside] - 1] = self.table.find(symbols[inside, column[inside] - 1], best[inside])
        return out

    def _merge_wide(self, word: bytes) -> tuple[int, ...]:
        """A word of several rows. A pair stands where its left symbol does; its right one may begin the next row."""
        find = self.table.find_one
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)]
        rows = -(-len(ids) // WIDEST)
        symbols = np.full((rows, WIDEST), -1, dtype=np.int32)
        symbols.ravel()[: len(ids)] = ids
        pairs = np.full((rows, WIDEST), NONE, dtype=np.int32)
        pairs.ravel()[: len(ids) - 1] = self.table.find(ids[:-1], ids[1:])
        lengths = (symbols >= 0).sum(1).tolist()
        after, ahead = [*range(1, rows), -1], [*range(-1, rows - 1)]
        lowest = pairs.min(1)

        def remove(row: int, column: int, of_pair: int) -> None:
            """Close the gap at a symbol and at a pair of a row."""
            n = lengths[row]
            symbols[row, column : n - 1] = symbols[row, column + 1 : n]
            pairs[row, of_pair : n - 1] = pairs[row, of_pair + 1 : n]
            symbols[row, n - 1], pairs[row, n - 1] = -1, NONE
            lengths[row] = n - 1

        while (best := lowest.item(row := int(lowest.argmin()))) != NONE:
            column = int(pairs[row].argmin())
            symbols[row, column] = best
            if column + 1 < lengths[row]:
                remove(row, column + 1, column + 1)
            else:
                follower = after[row]
                remove(follower, 0, 0)
                lowest[follower] = pairs[follower].min()
                if not lengths[follower]:
                    after[row] = after[follower]
                    if after[row] >= 0:
                        ahead[after[row]] = row
            if column + 1 < lengths[row]:
                pairs[row, column] = find(best, symbols.item(row, column + 1))
            else:
                pairs[row, column] = find(best, symbols.item(after[row], 0)) if after[row] >= 0 else NONE
            if column:
                pairs[row, column - 1] = find(symbols.item(row, column - 1), best)
            elif ahead[row] >= 0:
                last = lengths[ahead[row]] - 1
                pairs[ahead[row], last] = find(symbols.item(ahead[row], last), best)
                lowest[ahead[row]] = pairs[ahead[row]].min()
            lowest[row] = pairs[row].min()
        return tuple(symbols[symbols >= 0].tolist())

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text; words met for the first time are merged together."""
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        parts = [self.split(t) for t in texts]
        new = list(set().union(*parts).difference(self.words))
        fresh = dict(zip(new, self.encode_words(new)))
        self.words.update(fresh)
        ids = [list(chain.from_iterable(map(self.words.__getitem__, p))) for p in parts]
        for word in new:
            if len(word) > KEPT_LENGTH:
                del self.words[word]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


# One codec per worker process and vocabulary; workers outlive tasks.
_CODECS: dict[tuple[str, str], Codec] = {}


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``ids`` (array of token ids), ``decoded`` (bytes of the ids).

    Null and empty texts have no ids. The ranks are read on the driver and shipped.
    """
    schema = pa.schema([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def columns(codec: Codec, texts: list[str]) -> list[pa.Array]:
        ids = codec.encode(texts)
        return [pa.array(ids, schema.field(0).type), pa.array([codec.decode(i) for i in ids], pa.binary())]

    return _through_codec(docs, ranks_path, pattern, id_column, text_column, columns, "ids array<int>, decoded binary")


def digest_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """As ``encode_documents``, with digests in place of the arrays, taken where the ids are made.

    ``ids_sha256`` is over the decimal ids joined by commas, ``decoded_sha256`` over the decoded bytes.
    """

    def columns(codec: Codec, texts: list[str]) -> list[pa.Array]:
        names = _decimal(len(codec.tokens))
        counts, of_ids, of_bytes = [], [], []
        for ids in codec.encode(texts):
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

    return _through_codec(
        docs, ranks_path, pattern, id_column, text_column, columns, "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


_DECIMAL: list[str] = []


def _decimal(n: int) -> list[str]:
    _DECIMAL.extend(map(str, range(len(_DECIMAL), n)))
    return _DECIMAL


def _through_codec(docs, ranks_path, pattern, id_column, text_column, columns, kinds: str) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    names = ["_id", *(k.split()[0] for k in kinds.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (ranks_path, pattern)
        if key not in _CODECS:
            _CODECS[key] = Codec(shipped.value, pattern)
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column(0), *columns(_CODECS[key], texts_of(part, "_text"))], names)

    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        run, f"_id {kind}, {kinds}"
    )
    return found.select(F.col("_id").alias(id_column), *names[1:])
