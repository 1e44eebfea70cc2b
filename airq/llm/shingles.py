"""Sets of word n-grams of many texts at once, as sorted 64-bit keys."""

from __future__ import annotations

import numpy as np

from airq.llm.common import mixed, span_hashes

# A-Z to a-z, all white space that separates words to one value.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the folded words, text after text, and where each text starts in them."""
    data = _FOLD[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    space = data == 32
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space))) != 0)
    first, last = edge[0::2], edge[1::2]
    return span_hashes(data, first, last), np.searchsorted(first, np.cumsum(sizes) - sizes)


def shingle_hashes(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Hashes of all ``width``-word windows of each text, in order and with repeats.

    A text with fewer words has one hash of its whole sequence, a text without words none.
    """
    words, starts = word_hashes(texts)
    ends = np.append(starts[1:], len(words))
    factor = np.uint64(0xA0761D6478BD642F)
    windows = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for k in range(width):
        windows = windows * factor + words[k : k + len(windows)]
    windows = mixed(windows)
    out = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a >= width:
            out.append(windows[a : b - width + 1])
        elif b > a:
            short = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    short = short * factor + w
            out.append(mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(windows[:0])
    return out
