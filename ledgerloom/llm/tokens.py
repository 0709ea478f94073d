"""Words of a block of texts as Arrow arrays, split byte by byte.

A class of ASCII characters decides where words end; all other characters are word characters, so
bytes and code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(characters: str) -> np.ndarray:
    """A table that tells the bytes of these ASCII characters."""
    table = np.zeros(256, bool)
    table[list(characters.encode("ascii"))] = True
    return table


class Words(NamedTuple):
    words: pa.Array  # lower-cased in A-Z, of all texts in order
    bounds: np.ndarray  # words bounds[i] to bounds[i + 1] are those of text i
    starts: np.ndarray  # the byte at which each word starts in ``data``
    data: np.ndarray  # the bytes of all texts, one after the other


def split(texts: pa.Array, gaps: np.ndarray) -> Words:
    """The words of a string array without nulls: maximal runs of bytes outside ``gaps``."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~gaps[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    kept = _LOWER[data[inside]]
    ends = np.append(np.flatnonzero(first[inside]), len(kept)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(ends), pa.py_buffer(kept))
    return Words(words, np.searchsorted(starts, offsets), starts, data)


def blocks(batches, text: int, least_bytes: int) -> Iterator[pa.Table]:
    """Arrow batches joined into tables of about ``least_bytes`` of text, whole texts each."""
    held, size = [], 0
    for batch in batches:
        at = 0
        lengths = np.asarray(pc.binary_length(batch.column(text)).fill_null(0))
        reached = np.cumsum(lengths)
        while at < batch.num_rows:
            before = reached[at - 1] if at else 0
            end = min(int(np.searchsorted(reached, before + least_bytes - size)) + 1, batch.num_rows)
            held.append(batch.slice(at, end - at))
            size += int(reached[end - 1] - before)
            at = end
            if size >= least_bytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
