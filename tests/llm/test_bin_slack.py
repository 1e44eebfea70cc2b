import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from airq.llm import bin_slack
from airq.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    own = Tokenizer.from_file(PATH)
    return [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


def assert_packed(rows, capacity):
    """Gapless sequences, none over the capacity; returns their number."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_fullest_is_the_best_of_all_combinations():
    dice = random.Random(3)
    for _ in range(200):
        capacity = dice.randint(5, 40)
        pool = [dice.randint(1, capacity) for _ in range(dice.randint(1, 9))]
        counts = {n: pool.count(n) for n in pool}
        lengths = sorted(counts, reverse=True)
        found = bin_slack.fullest(lengths, counts, capacity)
        others = sorted(pool, reverse=True)[1:]
        sums = {lengths[0] + sum(c) for k in range(len(others) + 1) for c in itertools.combinations(others, k)}
        assert sum(n * k for n, k in found) == max(s for s in sums if s <= capacity)
        assert all(k <= counts[n] for n, k in found) and dict(found)[lengths[0]] >= 1


def test_solve_places_everything_near_the_bound():
    dice = np.random.default_rng(5)
    for size, top in ((1, 9), (300, 2048), (20_000, 2048), (20_000, 3)):
        lengths = np.clip(dice.lognormal(5, 1.3, size).astype(int), 1, top)
        counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        patterns = bin_slack.solve(counts, 2048)
        used = {}
        for p in patterns:
            assert sum(n * k for n, k in p.parts) <= 2048
            for n, k in p.parts:
                used[n] = used.get(n, 0) + p.repeats * k
        assert used == counts
        bound = -(-int(lengths.sum()) // 2048)
        assert sum(p.repeats for p in patterns) <= bound + 1
    # lengths over half the capacity cannot share
    assert sum(p.repeats for p in bin_slack.solve({1100: 50, 1500: 7}, 2048)) == 57
    assert bin_slack.solve({}, 2048) == []
    with pytest.raises(ValueError):
        bin_slack.solve({2049: 1}, 2048)


def test_encoder_agrees_with_the_library():
    encode = bin_slack.Encoder(*bin_slack.read_vocabulary(PATH), open(PATH, encoding="utf-8").read())
    odd = [chr(c) for c in (*range(0x20), 0x85, 0xA0, 0x180E, 0x200B, 0x2028, 0x3000, 0x660, 0xFEFF, 0x1F600, 0x10FFFF)]
    texts = ["", " ", "a\n\n b's I'LL don't", "x<|endoftext|> y", "\t" * 900 + "z", "ä" * 5000, *(f"a{c}b {c}{c} 1{c}" for c in odd)]
    assert [encode(t).tolist() for t in texts] == ids_of(texts)


def test_query_against_the_library(spark, folder):
    rows = QUERIES["op13_best_fit"](spark, folder).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, {})[r.piece] = r
    assert pieces.keys() == docs.keys() and len(rows) == sum(map(len, pieces.values()))
    for (doc, own), ids in zip(sorted(pieces.items()), ids_of([docs[d] for d in sorted(docs)])):
        ids = ids + [0]
        at = 0
        for k in range(len(own)):
            r = own[k]
            assert (r.start, k == 0 or r.length == 2048, r.length <= 2048) == (at, True, True)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids) and (len(own) == 1) == (len(ids) <= 2048)
    total = sum(r.length for r in rows)
    assert assert_packed(rows, 2048) <= -(-total // 2048) + 1


def test_edges(spark):
    long = "one two three. " * 1500
    rows = [(None, "a b"), (None, None), (1, ""), (2, long), (2, long), (3, " \n"), (4, "x" * 3000), (5, "a b")] + [(9, "same text")] * 3000
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, _row int").repartition(5)
    got = bin_slack.pack_documents(docs, PATH).collect()
    want = sum(len(i) + 1 for i in ids_of([r[1] or "" for r in rows]))
    assert sum(r.length for r in got) == want
    assert assert_packed(got, 2048) <= -(-want // 2048) + 1
    assert sorted(r.doc_id for r in got if r.doc_id in (1, 3, 4, 5)) == [1, 3, 4, 5]
    assert sum(r.doc_id is None for r in got) == 2
    twice = [r for r in got if r.doc_id == 2]
    assert len({(r.piece, r.start, r.length) for r in twice}) * 2 == len(twice)
    empty = bin_slack.pack_documents(docs.where("false"), PATH)
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and empty.count() == 0


def test_other_pieces_keep_their_columns(spark):
    df = spark.createDataFrame([(i % 7 + 1, f"r{i}", [i]) for i in range(400)], "size int, name string, extra array<long>")
    got = bin_slack.pack_pieces(df, capacity=10, length="size", part_rows=5).collect()
    assert sorted(r.name for r in got) == sorted(f"r{i}" for i in range(400))
    assert all(r.extra == [int(r.name[1:])] for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r["size"]))
    assert all(sum(s for _, s in b) <= 10 for b in bins.values())
    assert len(bins) == -(-sum(r["size"] for r in got) // 10)


def test_ids_come_along(spark):
    docs = spark.createDataFrame([(1, "hello world " * 40), (2, None)], "doc_id long, text string")
    got = sorted(bin_slack.token_pieces(docs, PATH, capacity=50, with_ids=True).collect())
    joined = [i for r in got if r.doc_id == 1 for i in r.ids]
    assert joined == ids_of(["hello world " * 40])[0] + [0]
    assert [r.length for r in got] == [len(r.ids) for r in got]
