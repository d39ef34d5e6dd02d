"""Encodings against a public library's, and round trips."""

import hashlib
import random

import public_tokenizers as public
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from conftest import SF
from rows import clashing, empty_docs, odd_docs
from sieveline.llm import bpe, queries

RANKS = public.path("byte_bpe_50k.tiktoken")
MULTI = public.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    ranks = bpe.Merges(bpe.read_ranks(path)).ranks
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=400):
    """Runs of white space of all kinds, contractions, digits, signs, scripts, words of one letter many times."""
    r = random.Random(11)
    pieces = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "　", "'s", "'LL", "'", "don't",
              "a", "aaaa", "12", "½", "٣", "一二三", "ça", "é", "🙂", "👩‍👩‍👧", "<|endoftext|>", "_", "--", "\x00", "﻿", "Straße", "word"]
    for _ in range(n):
        yield "".join(r.choice(pieces) for _ in range(r.randint(0, 40)))
    yield "a" * 20_000
    yield "ab" * 5_001 + " " * 5_000 + "x"
    yield " " * 3_000


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_every_token_is_made_by_its_own_merges(path):
    merges = bpe.Merges(bpe.read_ranks(path))
    tokens = list(merges.ranks)
    assert merges.replayed(tokens) == [[merges.ranks[t]] for t in tokens]


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_no_band_holds_a_token_and_a_part_of_it(path):
    merges = bpe.Merges(bpe.read_ranks(path))
    band, ranks = merges.band, merges.ranks
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            if token[:i] in ranks and token[i:] in ranks:
                assert band[rank] not in (band[ranks[token[:i]]], band[ranks[token[i:]]])


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_replayed_like_the_library(path):
    r = random.Random(5)
    tokens = [t for t in (t.decode(errors="ignore") for t in bpe.Merges(bpe.read_ranks(path)).ranks) if t.isalpha()]
    words = ["".join(r.choice(tokens) for _ in range(r.randint(1, 12))) for _ in range(3_000)]
    words += ["".join(r.choice("ab") for _ in range(r.randint(1, 300))) for _ in range(300)] + ["a" * n for n in (1, 2, 3, 4_001)]
    wanted = library(path)
    assert bpe.Merges(bpe.read_ranks(path)).replayed([w.encode() for w in words]) == [wanted._encode_single_piece(w) for w in words]


def test_steps_of_the_replay_do_not_grow_with_the_words(monkeypatch):
    merges = bpe.Merges(bpe.read_ranks(RANKS))
    steps, rank_of = [], bpe.Merges.rank_of
    monkeypatch.setattr(bpe.Merges, "rank_of", lambda *args: steps.append(1) or rank_of(*args))
    words = [t.encode() for t in ("strangelyunhappiest", "aaaaaaa", "thenwhreonwhingin", "geschwindigkeiten")]
    once, n = merges.replayed(words), len(steps)
    assert merges.replayed(words * 500) == once * 500 and len(steps) == 2 * n


def test_letters_and_signs_are_words_as_by_the_pattern():
    r, find = random.Random(7), regex.compile(public.PATTERN).findall
    pieces = [*bpe.SIGNS, "a", "é", "中", "ª", "ʰ", "1", "½", "'", "'s", "'ll", "\n", "\x00", "\u0301", "🙂", "\u2019"]
    units = {"".join(r.choice(pieces) for _ in range(r.randint(1, 5))) for _ in range(5_000)} | {"ab" + s for s in bpe.SIGNS}
    units = {u for u in units if not u[0].isspace()}
    calls = []
    got = dict(bpe.words_of(units, lambda text: calls.append(text) or find(text), bpe.taken_signs(public.PATTERN)))
    assert got == {u: find(" " + u) for u in units}
    assert not any(" ab" in text for text in calls)


def test_no_text_comes_back_from_the_tasks(spark, monkeypatch):
    seen, encode = [], bpe.encode
    monkeypatch.setattr(bpe, "encode", lambda *args, **named: seen.append(encode(*args, **named)) or seen[0])
    queries.QUERIES["op12_byte_bpe"](spark, SF)
    assert [kind for _, kind in seen[0].dtypes] == ["bigint", "array<int>"]


@pytest.mark.parametrize("shared_bytes", [bpe.SHARED_BYTES, 200, 0])
def test_like_the_library(spark, shared_bytes):
    texts = [*odd_texts(), *odd_texts(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = bpe.decode(bpe.encode(docs, RANKS, public.PATTERN, shared_bytes=shared_bytes), RANKS).collect()
    wanted = library(RANKS)
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == wanted.encode_ordinary(r.text), repr(r.text)
        assert bytes(r.decoded).decode() == r.text


def test_another_vocabulary(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts(60))], "doc_id long, text string")
    wanted = library(MULTI)
    assert all(r.ids == wanted.encode_ordinary(r.text) for r in bpe.encode(docs, MULTI, public.PATTERN).collect())


def test_pieces_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REPLAY_BYTES", 7)
    merges = bpe.Merges(bpe.read_ranks(RANKS))
    words = ["strangely", " unhappiest", "xqzzx", "aaaaaaa", "1234567"]
    wanted = library(RANKS)
    assert [list(memoryview(ids).cast("i")) for _, ids in sorted(merges.encoded(words))] == [
        wanted.encode_ordinary(w) for w in sorted(words)
    ]


def test_only_the_frequent_words_are_shared(spark):
    docs = spark.createDataFrame([("rare1 often often often seldom seldom",)], "text string")
    counts = {r.word: r.n for r in bpe.word_counts(docs, "text", public.PATTERN).collect()}
    assert counts == {"rare": 1, "1": 1, " often": 3, " seldom": 2}
    ranks = spark.sparkContext.broadcast(bpe.read_ranks(RANKS))
    encoded = bpe.encodings(bpe.word_counts(docs, "text", public.PATTERN).filter("n > 1"), ranks)
    assert set(bpe.most_frequent(encoded, 1 << 10)) == {" often", " seldom"}
    assert bpe.most_frequent(encoded, 10) == {}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = bpe.decode(bpe.encode(docs, RANKS, public.PATTERN), RANKS)
    assert got.columns == [*docs.columns, "ids", "decoded"]
    wanted = library(RANKS)
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == wanted.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")


def test_clashing_names_empty_tables_and_null_ids(spark):
    docs = clashing(spark).withColumns({"ids": F.lit("x"), "word": F.lit("x"), "decoded": F.lit("x")})
    assert bpe.decode(bpe.encode(docs, RANKS, public.PATTERN), RANKS).filter("text = 'tiny'").first().decoded == b"tiny"
    assert bpe.encode(empty_docs(spark), RANKS, public.PATTERN).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first().decoded == b""
    for wrong in ([60_000], [-1], [0, None]):
        with pytest.raises(Exception, match="an id without a token"):
            bpe.decode(spark.createDataFrame([(1, wrong)], "doc_id long, ids array<int>"), RANKS).collect()


def test_vocabulary_without_all_bytes():
    with pytest.raises(ValueError):
        bpe.Merges(b"YQ== 0\n")


def test_query_against_the_library(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    wanted = library(RANKS)
    got = queries.QUERIES["op12_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = wanted.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
