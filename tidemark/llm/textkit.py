"""Words of many texts at once, as numpy arrays over their joined UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1_000_000
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a list of texts: data holds the bytes, start and end the places of words, hashes their 64-bit hashes, and
    words begin[i] to begin[i + 1] belong to text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    blank = BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return Words(data, start, end, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(size.sum()) - np.repeat(first, size)
    values = _BYTE[data[~blank]] * _PLACE[place & 4095] + place.astype(np.uint64)
    values = mix(values)
    hashes = mix(np.add.reduceat(values, first) + size.astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in texts])
    begin = np.concatenate([[0], np.searchsorted(start, stops)])
    return Words(data, start, end, hashes, begin)


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about SLICE_BYTES, so that what is made of them stays small as well."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def text_slices(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches of at most about SLICE_BYTES, with their texts as bytes; null texts are empty. Only a part's texts are
    copied at once."""
    for batch in batches:
        column = batch.column(name).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            held = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, held + SLICE_BYTES, "right")))
            yield batch.slice(begin, end - begin), [x or b"" for x in column.slice(begin, end - begin).to_pylist()]
            begin = end
