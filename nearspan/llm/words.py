"""Words of many texts at once, as one Arrow array, without an object for every word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

GAP = ord(" ")


def split(texts: Sequence[bytes], table: bytes) -> tuple[pa.Array, np.ndarray]:
    """The longest runs of bytes that ``table`` (256 bytes) does not make a blank, made by it, and their number in each text.

    A blank has to stay a blank: texts are joined by one, so that no word crosses them.
    """
    joined = np.frombuffer(b" ".join(texts).translate(table), np.uint8)
    inside = np.zeros(len(joined) + 2, bool)
    np.not_equal(joined, GAP, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, offsets = edges[::2], np.zeros(len(edges) // 2 + 1, np.int32)
    np.cumsum(edges[1::2] - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[inside[1:-1]])])
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


def blocks(raws: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """The texts in their order, in lists of at least ``size`` bytes (the last one may have fewer)."""
    held, n = [], 0
    for raw in raws:
        held.append(raw)
        n += len(raw)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held
