"""Words of whole texts, one Arrow batch at a time.

A word is a run of anything but space and the control characters 09-0D. A batch is cut into
slices of bounded size; in a slice every word is a code into the slice's distinct words, so the
Python work of an operator is done once per distinct word and the rest is numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 6 << 20
SPACES = " \t\n\x0b\x0c\r"


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of text, one text at least.

    What Arrow no longer needs goes back to the system after each slice: a worker serves one stage after the other.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)
                pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """``codes[starts[i]:starts[i + 1]]`` are the words of text i, as places in ``distinct``."""

    codes: np.ndarray
    starts: np.ndarray
    distinct: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum over its words of a whole number given for each distinct word."""
        total = np.concatenate([[0], np.cumsum(np.asarray(values, np.int64)[self.codes])])
        return np.diff(total.astype(np.int64)[self.starts])

    def strings(self) -> list[str]:
        """The distinct words; one join and one split, since no word holds a line end."""
        return joined_lines(self.distinct).split("\n") if len(self.distinct) else []

    @property
    def rows(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)


def split_words(texts: pa.Array) -> Words:
    """Words of each text; a null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values, offsets = lists.flatten(), lists.offsets.to_numpy()
    offsets = offsets.astype(np.int64) - int(offsets[0])
    full = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # a text that begins or ends with white space gives empty strings there
        before = np.concatenate([[0], np.cumsum(full)])
        values, offsets = values.filter(pa.array(full)), before[offsets]
    coded = values.dictionary_encode()
    return Words(
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary
    )


def raw_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts one after the other, and where each begins. Null: empty."""
    texts = pc.fill_null(texts, "")
    starts = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[starts[0] : starts[-1]]
    return data, starts - starts[0]


def from_raw(data: bytes, starts: np.ndarray) -> pa.Array:
    """Texts from their bytes and starts."""
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))


def joined_lines(strings: pa.Array) -> str:
    """The strings with a line end between two."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings)
    return pc.binary_join(whole, "\n")[0].as_py()


def word_hashes(distinct: Iterable[str], seed: int = 0) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in distinct), dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def window_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of ``size`` neighbouring word hashes."""
    count = len(word) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        total = mix(total + word[k : k + count])
    return total
