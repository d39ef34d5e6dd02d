"""Word and n-gram hashes of whole texts, computed on Arrow buffers without making Python strings.

Words are runs of bytes other than space and ASCII white space, with A-Z lower-cased. Hashes
have 64 bits. Texts are read in slices, so the memory used does not grow with a text's length
beyond 8 bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
# Texts handled together: words of one such chunk are held at a time.
CHUNK_BYTES = 8 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
GRAM_BASE = 0xD1342543DE82EF95

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``, kept per worker."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        factors = np.full(max(n, SLICE_BYTES), base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[name] = np.multiply.accumulate(factors)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly: a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_slice(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts between ``bounds`` and the number of words of each."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    word = ~SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * powers("base", BASE, len(data)), dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    value = (sums[ends] - before) * powers("inverse", BASE_INVERSE, len(data))[starts]
    hashes = mixed(value + (ends - starts + 1).astype(np.uint64) * BASE)
    return hashes, np.diff(np.searchsorted(starts, bounds))


def slices_of_long_text(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text in slices that end at white space; only a longer word makes a longer slice."""
    at = 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        if end < len(data):
            spaces = np.flatnonzero(SPACE[data[at:end]])
            while not len(spaces) and end < len(data):
                more = np.flatnonzero(SPACE[data[end : end + SLICE_BYTES]])[:1]
                if len(more):
                    spaces = more + (end - at)
                else:
                    end = min(end + SLICE_BYTES, len(data))
            if len(spaces):
                end = at + int(spaces[-1]) + 1
        yield data[at:end]
        at = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, one after another, and the offsets of each text's words."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    hashes, counts, i = [], [np.zeros(1, np.int64)], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        text = data[offsets[i] : offsets[j]]
        if len(text) > SLICE_BYTES:
            parts = [hashed_slice(s, np.array([0, len(s)]))[0] for s in slices_of_long_text(text)]
            hashes += parts
            counts.append(np.array([sum(map(len, parts))], np.int64))
        else:
            found, n = hashed_slice(text, offsets[i : j + 1] - offsets[i])
            hashes.append(found)
            counts.append(n)
        i = j
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.cumsum(np.concatenate(counts))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place; the last ``n - 1`` places have none."""
    size = max(0, len(words) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += words[k : k + size] * np.uint64(pow(GRAM_BASE, k, 1 << 64))
    return mixed(total + np.uint64(n * int(BASE) % (1 << 64)))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of a text's ``n``-word shingles; with fewer words, of the whole sequence."""
    return grams(words, min(n, len(words))) if len(words) else np.zeros(0, np.uint64)


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``CHUNK_BYTES`` of text; a longer text is a run by itself."""
    lengths = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(batch):
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def texts_of_words(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows with the word hashes of each row's text."""
    for batch in batches:
        for run in chunks(batch, text):
            hashes, offsets = word_hashes(run.column(text))
            yield run, [hashes[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
