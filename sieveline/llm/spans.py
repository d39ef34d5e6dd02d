"""Where the words of whole texts are, and their hashes, for any class of word bytes.

Works on Arrow buffers: no Python string is made. Hashes have 64 bits and are made of slices of
bounded size, so that a very long text needs 16 bytes per word besides itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sieveline.llm.words import BASE, BASE_INVERSE, mixed, powers

SLICE_BYTES = 1 << 20

SAME = np.arange(256, dtype=np.uint8)
# A-Z only.
LOWER = SAME.copy()
LOWER[65:91] += 32

# Other bytes than space and ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

# ASCII digits and letters, and all bytes of other characters.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def runs_of_rows(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with at most ``limit`` bytes of text; a longer text is a run by itself."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the offsets of each text; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte after it, and the offsets of each text's words.

    A word is a maximal run of ``member`` bytes within one text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = member[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes after ``fold``."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        part = data[base : ends[stop - 1]]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((fold[part].astype(np.uint64) + np.uint64(1)) * powers("base", BASE, len(part)), out=sums[1:])
        a, b = starts[at:stop] - base, ends[at:stop] - base
        value = (sums[b] - sums[a]) * powers("inverse", BASE_INVERSE, len(part))[a]
        out[at:stop] = mixed(value + (b - a).astype(np.uint64) * BASE)
        at = stop
    return out


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of all the spans, one after another."""
    lengths = ends - starts
    out = np.empty(int(lengths.sum()), np.uint8)
    done = at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        n = lengths[at:stop]
        size = int(n.sum())
        shift = np.repeat(starts[at:stop] - (np.cumsum(n) - n), n)
        out[done : done + size] = data[np.arange(size) + shift]
        done += size
        at = stop
    return out
