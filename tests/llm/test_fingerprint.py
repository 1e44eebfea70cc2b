"""Fingerprints against a plain version that reads all rows in order."""

import hashlib
import random

import pytest
from airq.llm import fingerprint as fp
from airq.llm.queries import QUERIES
from pyspark.sql import functions as F


def by_hand(rows):
    """Edited text and next text of each row, in descending order of ids (null last, equal ids by text)."""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (key, own) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        out.append((key, len(own), hashlib.sha256(edited.encode()).hexdigest(), *map(fp.fingerprint, (own.encode(), edited.encode(), after.encode()))))
    return sorted(out, key=str)


def rows_of(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def test_query_as_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op1_fingerprint"](spark, folder)
    assert rows_of(found) == by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert found.where("near_edited < 0 or near_edited > 1 or near_next < 0 or near_next > 1").count() == 0
    mean = found.agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert mean[0] > 0.4 and mean[1] < 0.05


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_edges(spark, ranges):
    rows = [(5, "five words of a text"), (5, "five words of a text"), (5, "another"), (None, "no id"), (None, None), (3, None), (2, ""), (9, "é" * 5001), (1, "z")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    assert rows_of(fp.fingerprint_documents(df, ranges=ranges)) == by_hand(rows)


def test_one_row_and_no_row(spark):
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    (row,) = fp.fingerprint_documents(df).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert fp.fingerprint_documents(df.limit(0)).collect() == []


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abcdef gh\n", k=n)) for n in (0, 1, 6, 7, 8, 63, 64, 65, 500, 4097)]
    whole = [fp.fingerprint(t) for t in texts]
    monkeypatch.setattr(fp, "PIECE", 64)
    monkeypatch.setattr(fp, "PIECE_BITS", 6)
    assert [fp.fingerprint(t) for t in texts] == whole


def test_likeness(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(800))
    other = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(800))
    cut = text[:2000] + "inserted words" + text[2000:]
    pairs = [(text, text), (text, cut), (text, other), ("", ""), ("", text), (text, text[: len(text) // 4])]
    df = spark.createDataFrame([(fp.fingerprint(a.encode()), fp.fingerprint(b.encode())) for a, b in pairs], "a string, b string")
    same, inserted, apart, both_empty, one_empty, quarter = [r[0] for r in df.select(fp.likeness(F.col("a"), F.col("b"))).collect()]
    assert same == both_empty == 1 and one_empty == 0
    assert inserted > 0.85 and apart < 0.1 and 0.1 < quarter < 0.5


WORD = (1 << 64) - 1


def plain_mix(h):
    """The spreading of 64-bit values with Python's whole numbers."""
    for _ in range(2):
        h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & WORD
    return h ^ (h >> 32)


def plain_fingerprint(text):
    """Byte by byte: a hash of the last seven bytes marks the chunks' ends, a hash of each chunk is its character."""
    back = pow(fp.BASE, -1, 1 << 64)
    rolled = []
    for i in range(len(text)):
        h = 0
        for k in range(min(7, i + 1)):
            h += (text[i - k] + 1) * pow(back, k, 1 << 64)
        rolled.append(plain_mix(h & WORD) >> 32)
    bits = 1
    while sum(r < 1 << (32 - bits) for r in rolled) >= 64:
        bits += 1
    out = [str(bits)]
    for level in range(bits, bits + 5):
        signature, h, size = "", 0, 0
        for i, b in enumerate(text):
            h, size = (h + (b + 1) * pow(fp.BASE, size, 1 << 64)) & WORD, size + 1
            if rolled[i] < 1 << (32 - level) or i == len(text) - 1:
                signature += chr(0x4E00 + plain_mix((h + size) & WORD) % 4096)
                h, size = 0, 0
        out.append(signature)
    return ":".join(out)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (bits_a, *x), (bits_b, *y) = a.split(":"), b.split(":")
    common = {int(bits_a) + i: s for i, s in enumerate(x)}.keys() & {int(bits_b) + i for i in range(len(y))}
    if not common or not x[0] or not y[0]:
        return 0.0
    level = min(common)
    s, t = x[level - int(bits_a)], y[level - int(bits_b)]
    return 1 - plain_distance(s, t) / max(len(s), len(t), 1)


def test_against_byte_loops(spark):
    dice = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    texts = ["", "a", "ab" * 3, "x" * 200, "äöü " * 40] + [" ".join(dice.choices(words, k=n)) for n in (5, 20, 80, 300, 900)]
    texts += [t[: len(t) // 2] + "changed" + t[len(t) // 2 :] for t in texts] + [texts[-1] + " " + texts[-2]]
    prints = [fp.fingerprint(t.encode()) for t in texts]
    assert prints == [plain_fingerprint(t.encode()) for t in texts]
    assert len({p.split(":")[0] for p in prints}) > 2
    pairs = [(a, b) for a in prints for b in prints]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = {(r.a, r.b): r.near for r in df.select("a", "b", fp.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    for a, b in pairs:
        assert got[a, b] == pytest.approx(plain_likeness(a, b))
