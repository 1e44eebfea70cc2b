import numpy as np
import pyarrow as pa
from airq.llm.common import blocks, byte_slices, code_points, powers, segment_sums, span_hashes


def test_slices_cover_all_rows_and_long_texts_stand_alone():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * 3, None, "b" * 50, "", "c" * 3, "d" * 3]})
    parts = [p.column(0).to_pylist() for p in byte_slices(batch, "t", 8)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert ["b" * 50, ""] in parts or ["b" * 50] in parts
    assert list(byte_slices(batch.slice(0, 0), "t")) == []


def test_blocks_cut_behind_spaces_and_lose_nothing():
    texts = ["", "ab cd ef gh", "x" * 25, "short"]
    parts, rows = blocks(texts, 6)
    assert ["".join(p for p, r in zip(parts, rows) if r == i) for i in range(4)] == texts
    assert parts[1] == "ab cd "
    assert all(len(p) <= 6 for p in parts)


def test_span_hashes_depend_on_content_only():
    chars, starts = code_points(["abc xabc", "abc", ""])
    assert starts.tolist() == [0, 8, 11]
    h = span_hashes(chars, np.array([0, 5, 8, 4]), np.array([3, 8, 11, 7]))
    assert h[0] == h[1] == h[2] != h[3]


def test_powers_are_inverse():
    up, down = powers(100_000)
    assert (up * down == 1).all()


def test_segment_sums_with_empty_segments():
    assert segment_sums(np.arange(5.0), np.array([0, 0, 3, 5])).tolist() == [0, 3, 7, 0]


def test_slices_of_a_number_of_rows():
    batch = pa.RecordBatch.from_pydict({"t": ["a"] * 10 + ["b" * 9] + [None] * 4})
    parts = [p.column(0).to_pylist() for p in byte_slices(batch, "t", 8, rows=3)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert max(map(len, parts)) == 3 and ["b" * 9] == [p for p in parts if p[0] == "b" * 9][0][:1]
