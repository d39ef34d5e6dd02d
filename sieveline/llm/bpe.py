"""Byte-level BPE by merge replay over the words of the corpus.

The distinct words (matches of the tokenizer's pattern) of all texts are counted, and each of those
that occur more than once is encoded once: the words of a piece stand in one sequence of symbols
with an inverted index from token pair to the places where the pair stands, and the merges are
applied in rank order, all over the piece, touching only the places of their pairs and the
neighbours. Merges of ranks next to one another, none of which makes a pair that another one of them
merges, form a band and are applied together. The encodings of the most frequent words, up to a fixed size, are sent to the
executors; texts are then encoded by looking their words up. Words outside of that table, such as
all that occur once, are encoded by the same replay over the texts at hand: the rarer a word, the
fewer the tasks that meet it.
"""

from __future__ import annotations

import base64
import gc
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from heapq import heappop, heappush
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from sieveline.llm.spans import runs_of_rows
from sieveline.sizing import staged

# Texts handled together have about this many bytes; a longer text is a piece by itself.
PIECE_BYTES = 2 << 20
# Words are replayed together up to this many bytes; a longer word is a piece by itself.
REPLAY_BYTES = 1 << 20
# The table of encodings that every executor gets, and the table of known units of a task.
SHARED_BYTES = 16 << 20
KNOWN_UNITS = 400_000
# What an entry of the shared table takes besides its word and its ids.
ENTRY_BYTES = 8

# No rank.
NONE = np.int32((1 << 31) - 1)

# Places before which a text may be cut; spaces of which some are none.
CUT, ODD_SPACE = regex.compile(r" (?=\S)"), re.compile(r" (?:\s|\Z)")
# ASCII signs, none of which begins a contraction.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def read_ranks(path: str) -> bytes:
    """The rank file as it is: a token in base 64 and its rank per line. A few hundred kB."""
    return Path(path).read_bytes()


class Merges:
    """The ranks of the tokens and, for each pair of tokens that is a token, its rank."""

    def __init__(self, rank_file: bytes):
        self.ranks = self.ranks_of(rank_file)
        single = [self.ranks.get(bytes([b])) for b in range(256)]
        if None in single:
            raise ValueError("a byte-level vocabulary has a token for every byte")
        self.single = np.array(single, np.int32)
        self.bits = max(self.ranks.values()).bit_length()
        pairs = sorted(
            (self.ranks[token[:i]] << self.bits | self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        )
        # One more pair, that none is equal to, so that a search always ends at one.
        self.keys = np.array([*[key for key, _ in pairs], np.iinfo(np.int64).max], np.int64)
        self.made = np.array([*[rank for _, rank in pairs], NONE], np.int32)
        self.of_bytes = self.rank_of(np.repeat(self.single, 256), np.tile(self.single, 256)).reshape(256, 256)
        self.starts = self.bands()
        self.band = (np.searchsorted(self.starts, np.arange(self.starts[-1]), "right") - 1).astype(
            np.uint16 if len(self.starts) < 1 << 16 else np.int32
        )

    @staticmethod
    def ranks_of(rank_file: bytes) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}

    def bands(self) -> np.ndarray:
        """The first rank of each band, and the rank after all: no band holds a token and a part of it."""
        top = max(self.ranks.values()) + 1
        nearest = np.full(top, -1)  # of the lower ranks, the highest that may not be in the same band
        keys, made = self.keys[:-1], self.made[:-1]
        for part in (keys >> self.bits, keys & (1 << self.bits) - 1):
            np.maximum.at(nearest, np.maximum(part, made), np.minimum(part, made))
        starts = [0]
        for rank, other in enumerate(nearest.tolist()):
            if other >= starts[-1]:
                starts.append(rank)
        return np.array([*starts, top])

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes. A pair with a negative symbol has a negative key, and no rank."""
        keys = left.astype(np.int64) << self.bits | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.made[at], NONE)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """The tokens of all words, one word after another, and where each word's end: all merges in
        rank order, from the left within a rank.

        As in any vocabulary that merges have made, a token is encoded as itself by its own merges.
        """
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        size = (int(ends[-1]) if words else -1) + 2
        inside = np.ones(size, bool)
        inside[ends] = inside[-1] = False
        data = np.zeros(size, np.uint8)
        data[inside] = np.frombuffer(b"".join(words), np.uint8)
        symbols = np.where(inside, self.single[data], np.int32(-1))
        after = np.arange(1, size + 1, dtype=np.int32)
        after[-1] = size - 1
        before = np.arange(-1, size - 1, dtype=np.int32)
        # Of the pair that begins at each place.
        ranks = np.full(size, NONE, np.int32)
        ranks[:-1] = np.where(inside[:-1] & inside[1:], self.of_bytes[data[:-1], data[1:]], NONE)
        places: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def found(new: np.ndarray):
            bands = self.band[ranks[new]]
            order = np.argsort(bands, kind="stable")
            new, bands = new[order], bands[order]
            cuts = [0, *(np.flatnonzero(bands[1:] != bands[:-1]) + 1).tolist(), len(new)]
            for start, end in pairwise(cuts if len(new) else []):
                band = int(bands[start])
                if band not in places:
                    places[band] = []
                    heappush(waiting, band)
                places[band].append(new[start:end])

        found(np.flatnonzero(ranks != NONE).astype(np.int32))
        while waiting:
            band = heappop(waiting)
            first, last = self.starts[band], self.starts[band + 1]
            here = np.sort(np.concatenate(places.pop(band)))
            here = here[np.concatenate([[True], here[1:] != here[:-1]])]
            touched = []
            while True:
                here = here[(ranks[here] >= first) & (ranks[here] < last)]
                if not len(here):
                    break
                now = self.free(here, ranks[here], after[here])
                i, here = here[now], here[~now]
                j = after[i]
                k = after[j]
                symbols[i], symbols[j], ranks[j] = ranks[i], -2, NONE
                after[i], before[k] = k, i
                new = np.concatenate([i, before[i]])
                ranks[new] = self.rank_of(symbols[new], symbols[after[new]])
                touched.append(new)
            if touched:
                new = np.concatenate(touched)
                found(new[ranks[new] != NONE])
        left = symbols >= 0
        return symbols[left], np.cumsum(left)[ends].tolist()

    @staticmethod
    def free(here: np.ndarray, ranks: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which of the places of a band's pairs can be merged now: those that overlap none of a lower
        rank; of places of one rank that overlap one another, every second from the left."""
        joined = here[1:] == after[:-1]
        if not joined.any():
            return np.ones(len(here), bool)
        heads = np.concatenate([[True], ~joined | (ranks[1:] != ranks[:-1])])
        run = np.cumsum(heads) - 1
        waits = np.zeros(run[-1] + 1, bool)
        waits[run[:-1][joined & (ranks[1:] < ranks[:-1])]] = True
        waits[run[1:][joined & (ranks[1:] > ranks[:-1])]] = True
        return ((np.arange(len(here)) - np.flatnonzero(heads)[run]) % 2 == 0) & ~waits[run]

    def replayed(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of each word."""
        ids, ends = self.merged(words)
        return [ids[start:end].tolist() for start, end in pairwise([0, *ends])]

    def encoded(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each word with its ids as 32-bit integers. A word that is a token is that token."""
        rest: list[str] = []
        texts: list[bytes] = []
        size = 0
        for word in words:
            text = word.encode()
            if text in self.ranks:
                yield word, self.ranks[text].to_bytes(4, "little")
                continue
            rest.append(word)
            texts.append(text)
            size += len(text)
            if size >= REPLAY_BYTES:
                yield from zip(rest, self.packed(texts))
                rest, texts, size = [], [], 0
        yield from zip(rest, self.packed(texts))

    def packed(self, words: list[bytes]) -> list[bytes]:
        ids, ends = self.merged(words)
        data = ids.astype("<i4").tobytes()
        return [data[4 * start : 4 * end] for start, end in pairwise([0, *ends])]


@contextmanager
def no_search_for_cycles():
    """Millions of small lists of strings hold no cycles; looking for some takes half of the time."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


_merges: dict[bytes, Merges] = {}


def merges_of(rank_file: Broadcast) -> Merges:
    """The merges of a rank file, made once per worker."""
    if rank_file.value not in _merges:
        _merges.clear()
        _merges[rank_file.value] = Merges(rank_file.value)
    return _merges[rank_file.value]


def units_of(text: str) -> list[str]:
    """A text in units that begin at spaces; the second and later ones lack that first space.

    The pattern cuts before every space that another character than white space follows, and each
    unit by itself as within the text.
    """
    return text.split(" ") if ODD_SPACE.search(text) is None else CUT.split(text)


def words_of(units: Iterable[str], find, signs: str = "") -> Iterator[tuple[str, list[str]]]:
    """Each unit that follows a space with its words. Letters and then ``signs`` are two words."""
    plain = []
    for unit in units:
        stem = unit.rstrip(signs) if signs else unit
        if len(stem) < len(unit) and stem.isalpha():
            yield unit, [" " + stem, unit[len(stem) :]]
        elif " " in unit:
            yield unit, find(" " + unit)
        else:
            plain.append(unit)
    # Every unit in one text: a word with a space at its start begins the next unit.
    words: list[str] = []
    at = -1
    for word in find("".join([" " + unit for unit in plain])):
        if word[0] == " ":
            if at >= 0:
                yield plain[at], words
            at, words = at + 1, [word]
        else:
            words.append(word)
    if at >= 0:
        yield plain[at], words


def parted(units: Iterable[str], letters: bool) -> tuple[list[str], list[str]]:
    """Units of letters only, and the others. The pattern must take letters after a space as one word
    (``letters``); else all are others."""
    return ([u for u in units if u.isalpha()], [u for u in units if not u.isalpha()]) if letters else ([], list(units))


def takes_letters(pattern: str) -> bool:
    return r"| ?\p{L}+|" in pattern


def taken_signs(pattern: str) -> str:
    """Signs of which the pattern takes any run after letters as one word; none if it may not."""
    return SIGNS if r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|" in pattern else ""


def word_counts(docs: DataFrame, text: str, pattern: str) -> DataFrame:
    """(word, n): the words of all texts and how often they occur; counted first within each task."""

    def count(batches):
        with no_search_for_cycles():
            yield from counted(batches)

    def counted(batches):
        find = regex.compile(pattern).findall
        units: Counter = Counter()
        leading: Counter = Counter()

        def flushed():
            alone, others = parted(units, takes_letters(pattern))
            words = Counter({" " + unit: units[unit] for unit in alone})
            words.update(leading)
            for unit, found in words_of(others, find, taken_signs(pattern)):
                n = units[unit]
                for word in found:
                    words[word] += n
            units.clear()
            leading.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for piece in runs_of_rows(batch, "text", PIECE_BYTES):
                for value in piece.column("text").to_pylist():
                    head, *rest = units_of(value or "")
                    leading.update(find(head))
                    units.update(rest)
                if len(units) + len(leading) > KNOWN_UNITS:
                    yield flushed()
        yield flushed()

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encodings(words: DataFrame, rank_file: Broadcast) -> DataFrame:
    """(word, n, ids): the words with their ids as 32-bit integers, each partition replayed in pieces."""

    def encode(batches):
        with no_search_for_cycles():
            yield from encoded(batches)

    def encoded(batches):
        merges = merges_of(rank_file)
        for batch in batches:
            count = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()))
            words, ids = zip(*merges.encoded(count)) if count else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([count[w] for w in words], pa.int64()), pa.array(ids, pa.binary())],
                ["word", "n", "ids"],
            )

    return words.mapInArrow(encode, "word string, n long, ids binary")


def most_frequent(encoded: DataFrame, limit: int) -> dict[str, bytes]:
    """The ids of the most frequent words: as many classes of frequency as fit in ``limit`` bytes."""
    rows = encoded.withColumns(
        {"__class": F.floor(F.log2("n") * 8).cast("int"), "__bytes": F.octet_length("word") + F.octet_length("ids") + ENTRY_BYTES}
    )
    least, room = None, limit
    for r in rows.groupBy("__class").agg(F.sum("__bytes").alias("b")).orderBy(F.desc("__class")).collect():
        room -= r.b
        if room < 0:
            break
        least = r["__class"]
    if least is None:
        return {}
    # As columns: half a million rows would take several times the table's memory on the driver.
    found = rows.filter(F.col("__class") >= least).select("word", "ids").toArrow()
    return dict(zip(found["word"].to_pylist(), found["ids"].to_pylist()))


def encode(
    docs: DataFrame, rank_path: str, pattern: str, text: str = "text", ids: str = "ids", shared_bytes: int = SHARED_BYTES
) -> DataFrame:
    """The rows with one more column ``ids``, an array of the ids of the whole text.

    ``rank_path`` is a file of ranks on the driver, ``pattern`` splits the texts; special tokens are
    text like any other. Null and empty texts have no ids. Repeated rows each have theirs; an empty
    table gives no rows. A column named like the result is replaced. Two passes over the texts,
    which are not shuffled; the distinct words of every task are. ``shared_bytes`` bounds the table
    of encodings that goes through the driver to every executor; whatever its size, words that are
    not in it are encoded in place, with the same result. A text, and a word, is held whole.
    """
    session = docs.sparkSession
    rank_file = session.sparkContext.broadcast(read_ranks(rank_path))
    words = word_counts(docs, text, pattern).filter("n > 1")
    encoded = staged(encodings(words, rank_file), "bpe-words")
    table = session.sparkContext.broadcast(most_frequent(encoded, shared_bytes))
    source = "__text"
    others = [c for c in docs.columns if c != ids]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias(source))
    fields = docs.select(*[F.col(f"`{c}`") for c in others]).schema
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def encode_texts(batches):
        with no_search_for_cycles():
            yield from encoded_texts(batches)

    def encoded_texts(batches):
        merges, shared = merges_of(rank_file), table.value
        find = regex.compile(pattern).findall
        letters, signs = takes_letters(pattern), taken_signs(pattern)
        known: dict[str, bytes] = {}
        ids_of = dict(shared)
        for batch in batches:
            for piece in runs_of_rows(batch, source, PIECE_BYTES):
                if len(known) > KNOWN_UNITS:
                    known, ids_of = {}, dict(shared)
                heads, tails = [], []
                for value in piece.column(source).to_pylist():
                    head, *tail = units_of(value or "")
                    heads.append(find(head))  # no space stands before a first unit
                    tails.append(tail)
                alone, mixed = parted(set().union(*tails).difference(known), letters)
                single = [" " + unit for unit in alone]
                split = dict(words_of(mixed, find, signs))
                words = set().union(single, *split.values(), *heads)
                ids_of.update(merges.encoded(words.difference(ids_of)))
                known.update(zip(alone, map(ids_of.__getitem__, single)))
                known.update((unit, b"".join(map(ids_of.__getitem__, found))) for unit, found in split.items())
                found = [b"".join((*map(ids_of.__getitem__, head), *map(known.__getitem__, tail))) for head, tail in zip(heads, tails)]
                bounds = np.concatenate([[0], np.cumsum([len(b) // 4 for b in found])])
                values = pa.Array.from_buffers(pa.int32(), int(bounds[-1]), [None, pa.py_buffer(b"".join(found))])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in others], lists], [*others, ids])

    return rows.mapInArrow(encode_texts, schema)


def decode(rows: DataFrame, rank_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows with one more column ``decoded``, the bytes that the array ``ids`` stands for.

    Column operations only: every id is looked up in a literal list of the tokens' hexadecimal
    digits. A null array is taken as none; a null or an id without a token raises. A column named like
    the result is replaced.
    """
    ranks = Merges.ranks_of(read_ranks(rank_path))
    digits = ["-"] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        digits[rank] = token.hex()
    tokens = F.split(F.lit(" ".join(digits)), " ")
    given = F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>"))
    joined = F.array_join(F.transform(given, lambda i: F.get(tokens, i)), "", "-")
    return rows.withColumn(decoded, F.coalesce(F.unhex(joined), F.raise_error(F.lit("an id without a token")).cast("binary")))
