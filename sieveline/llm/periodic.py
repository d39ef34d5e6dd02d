"""Periodic run detection in texts by string synchronising sets of words.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical) that is at
least four periods long and that no neighbouring word extends. For each dyadic scale ``t`` a
synchronising set is selected: a position is in it if the hash of the ``t`` words from there, or of
those ``t`` further, is the least among all positions up to ``t`` further. Whether a position is
chosen depends on the ``2t`` words from there only, so equal contexts are chosen alike, and every
``t`` neighbouring positions hold a chosen one. In a run with a period from ``t`` to ``2t``, the
position one period on is therefore the next one with the same context: neighbours among equal
contexts propose all such periods, and each proposal is extended to the run's ends.

Words that lie in runs of a smaller period (at most ``t/4``) would be chosen over and over; those
highly periodic regions are known from the smaller scales and are left out of a scale's choice.
Periods of 1 to 3 words, for which every position would be chosen, come from a direct comparison
of neighbouring words.

All texts of a bounded piece of a partition are worked on together, parted by symbols that occur once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sieveline.llm.spans import NOT_SPACE, SAME, buffers, gathered, runs_of_rows, span_hashes, word_spans
from sieveline.llm.words import mixed

# Texts worked on together have about this many bytes; a longer text is a piece by itself.
PIECE_BYTES = 4 << 20
# A run has at least so many periods, and so many words.
PERIODS = 4
LEAST_WORDS = 6
# Periods up to this one are found by comparing neighbouring words.
SMALL = 3

LEFT, RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def ahead(values: np.ndarray, n: int) -> np.ndarray:
    """The values ``n`` further on; the last one goes on for ever."""
    return np.concatenate([values[n:], np.full(min(n, len(values)), values[-1])])


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def small_periods(symbols: np.ndarray) -> Runs:
    """Starts, ends and periods of the runs with a period of at most ``SMALL``."""
    found: list[Runs] = []
    for q in range(1, SMALL + 1):
        a, b = stretches(symbols[:-q] == symbols[q:])
        long = b - a >= (PERIODS - 1) * q
        a, b = a[long], b[long] + q
        # A smaller period of such a run divides q: up to 3, that is 1.
        alike = np.zeros(len(a), bool) if q == 1 else symbols[a] == symbols[a + 1]
        if q == 3:
            alike &= symbols[a + 1] == symbols[a + 2]
        found.append((a[~alike], b[~alike], np.full(int((~alike).sum()), q)))
    return tuple(np.concatenate(x) for x in zip(*found))


def highly_periodic(size: int, t: int, runs: Runs) -> np.ndarray:
    """The positions from which ``t`` words lie in a run of period ``t/4`` at most."""
    starts, ends, periods = runs
    inside = (4 * periods <= t) & (ends - starts >= t)
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts[inside], 1)
    np.add.at(change, ends[inside] - t + 1, -1)
    return np.cumsum(change[:-1]) > 0


def synchronising_set(names: np.ndarray, t: int, left_out: np.ndarray) -> np.ndarray:
    """The chosen positions; ``names`` are hashes of the ``t`` words from each position."""
    names = np.where(left_out, NEVER, names)
    least, width = names, 1
    while width < t:
        least, width = np.minimum(least, ahead(least, width)), 2 * width
    further = ahead(names, t)
    least = np.minimum(least, further)
    return np.flatnonzero(((least == names) | (least == further)) & (least != NEVER))


def proposals(chosen: np.ndarray, contexts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, period): places of equal contexts one period from the next, chained while they overlap."""
    order = np.argsort(contexts, kind="stable")
    place, same = chosen[order], contexts[order]
    gap = place[1:] - place[:-1]
    near = (same[1:] == same[:-1]) & (gap >= t) & (gap < 2 * t)
    place, period = place[:-1][near], gap[near]
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    if not len(place):
        return place, place, period
    # From each place, 2t + period words have the period: two such stretches that overlap in a period are one.
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(period) != 0) | (np.diff(place) > 2 * t)]))
    return place[heads], place[np.concatenate([heads[1:], [len(place)]]) - 1], period[heads]


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on (or before them), by hashes of 1, 2, 4, ... words."""
    total, size = np.zeros(len(a), np.int64), len(levels[0])
    for k in range(len(levels) - 1, -1, -1):
        step, open_ = 1 << k, np.arange(len(a))
        while len(open_):
            x, y = (a[open_] + total[open_], b[open_] + total[open_]) if forward else (a[open_] - total[open_] - step, b[open_] - total[open_] - step)
            fits = (np.minimum(x, y) >= 0) & (np.maximum(x, y) + step <= size)
            open_, x, y = open_[fits], x[fits], y[fits]
            agree = levels[k][x] == levels[k][y]
            open_ = open_[agree]
            total[open_] += step
    return total


def runs_of_texts(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` are hashes of the words of all texts, those of text ``i`` between ``offsets[i]`` and
    ``offsets[i + 1]``.
    """
    sizes = np.diff(offsets)
    texts = np.flatnonzero(sizes >= PERIODS)
    found: list[tuple[np.ndarray, ...]] = []
    t, levels, base = 1, [], np.zeros(0, np.int64)
    while len(texts):
        if not levels:
            # Each text is followed by a symbol of its own.
            lengths = sizes[texts] + 1
            base = np.cumsum(lengths) - lengths
            symbols = np.empty(int(lengths.sum()), np.uint64)
            keep = np.repeat(sizes >= PERIODS, sizes)
            ends = base + lengths - 1
            inner = np.ones(len(symbols), bool)
            inner[ends] = False
            symbols[inner] = words[offsets[0] : offsets[-1]][keep]
            symbols[ends] = mixed(texts.astype(np.uint64) * LEFT + RIGHT)
            levels = [symbols]
            a, b, q = small_periods(symbols)
            known = [(a, b, q)]
        else:
            names = levels[-1]
            levels.append(mixed(names * LEFT + ahead(names, t // 2) * RIGHT))
            if t > SMALL:
                runs = tuple(np.concatenate(x) for x in zip(*known))
                chosen = synchronising_set(levels[-1], t, highly_periodic(len(names), t, runs))
                contexts = mixed(levels[-1][chosen] * LEFT + levels[-1][np.minimum(chosen + t, len(names) - 1)] * RIGHT)
                first, last, q = proposals(chosen, contexts, t)
                a = first - common(levels, first, first + q, False)
                b = last + q + common(levels, last, last + q, True)
                long = b - a >= PERIODS * q
                a, b, q = np.unique(np.stack([a[long], b[long], q[long]]), axis=1)
                known.append((a, b, q))
            else:
                a = b = q = np.zeros(0, np.int64)
        at = np.searchsorted(base, a, "right") - 1
        found.append((texts[at], a - base[at], b - a, q))
        t *= 2
        # A period of t words needs four times as many: shorter texts are done.
        stay = sizes[texts] >= PERIODS * t
        if stay.sum() < 0.7 * len(stay):
            lengths = sizes[texts] + 1
            places = np.repeat(stay, lengths)
            levels = [x[places] for x in levels]
            moved = np.cumsum(np.where(stay, lengths, 0)) - np.where(stay, lengths, 0)
            kept = []
            for a, b, q in known:
                at = np.searchsorted(base, a, "right") - 1
                on = stay[at]
                by = (moved[at] - base[at])[on]
                kept.append((a[on] + by, b[on] + by, q[on]))
            texts, base, known = texts[stay], moved[stay], kept
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    text, start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start, text))
    order = order[length[order] >= LEAST_WORDS]
    return text[order], start[order], length[order], period[order]


def periodic_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", n_words: str = "n_words") -> DataFrame:
    """The rows with three more columns: the runs of the text, the text without repetitions, its words.

    Words are runs of other characters than space and ASCII white space, compared as they are (by
    64-bit hashes), and numbered from 0. ``runs`` is an array of (start, length, period), by start
    and period: all stretches of at least 6 words and 4 smallest periods that no neighbour extends.
    ``collapsed`` joins by one space the words that no run holds after its first period.
    A null, empty or blank text has no words, no runs and an empty collapsed text; so have no runs
    texts of up to 5 words. Repeated rows each have their result; an empty table gives no rows.
    Columns named like the results are replaced. Nothing is shuffled: one pass, in pieces of
    4 MB of text (a longer text is one piece, with some 150 bytes per word at a time).
    """
    source = "__text"
    others = [c for c in docs.columns if c not in (runs, collapsed, n_words)]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias(source))
    found = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    schema = docs.select(*[F.col(f"`{c}`") for c in others]).schema
    schema = T.StructType([*schema, T.StructField(n_words, T.LongType()), T.StructField(runs, found), T.StructField(collapsed, T.StringType())])

    def detect(batches):
        for batch in batches:
            for piece in runs_of_rows(batch, source, PIECE_BYTES):
                data, offsets = buffers(piece.column(source))
                starts, ends, at = word_spans(data, offsets, NOT_SPACE)
                found = runs_of_texts(span_hashes(data, starts, ends, SAME), at)
                columns = [piece.column(c) for c in others]
                columns += [pa.array(np.diff(at), pa.int64()), run_lists(found, len(piece)), without(found, data, starts, ends, at)]
                yield pa.RecordBatch.from_arrays(columns, [*others, n_words, runs, collapsed])

    return rows.mapInArrow(detect, schema)


def run_lists(found: tuple[np.ndarray, ...], size: int) -> pa.ListArray:
    text, start, length, period = found
    bounds = np.searchsorted(text, np.arange(size + 1))
    values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def without(found: tuple[np.ndarray, ...], data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> pa.Array:
    """The words that no run holds after its first period, joined by one space."""
    text, start, length, period = found
    change = np.zeros(len(starts) + 1, np.int32)
    np.add.at(change, at[text] + start + period, 1)
    np.add.at(change, at[text] + start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    counts = np.concatenate([[0], np.cumsum(kept)])[at]
    starts, ends = starts[kept], ends[kept]
    # With the byte behind each word, which becomes a space, but for the last word of each text.
    spaced = ends + 1
    final = counts[1:][np.diff(counts) > 0] - 1
    spaced[final] = ends[final]
    out = gathered(data, starts, spaced)
    bounds = np.concatenate([[0], np.cumsum(spaced - starts)])
    behind = np.ones(len(starts), bool)
    behind[final] = False
    out[bounds[1:][behind] - 1] = 32
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(bounds[counts].tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())
