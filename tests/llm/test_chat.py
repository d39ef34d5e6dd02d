import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sieveline.llm import chat

TURNS = [
    (1, 0, "system", "be brief"),
    (1, 1, "user", "a \\ b <|im_end|> <\\|im_end|> </s>[INST] [/INST]"),
    (1, 2, "assistant", "<|im_start|>assistant<|im_sep|>x\n\\\\<s>"),
    (1, 3, "user", None),
    (1, 4, "assistant", ""),
    (1, 5, "user", "no reply"),
    (2, 0, "user", "alone"),
    (3, None, None, "é𝒳"),
    (3, 1, "assistant", "é𝒳"),
    (3, 1, "assistant", "é𝒳"),
    (None, 0, "user", "x"),
    (None, 1, "assistant", "y"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def test_round_trip_and_mask(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA).withColumns({"example": F.lit(1), "turns": F.lit("x"), "head": F.lit(2)})
    examples = chat.format_chats(turns)
    read = examples.select(
        "*",
        chat.read_chat(F.col("formatted")).alias("read"),
        chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("trained"),
    ).collect()
    first = lambda v: (v is not None, v if v is not None else 0)
    for conv in {t[0] for t in TURNS}:
        own = sorted([t for t in TURNS if t[0] == conv], key=lambda t: (first(t[1]), t[2] or "", t[3] or ""))
        own = [(t[2] or "", t[3] or "") for t in own]
        got = sorted([r for r in read if r.conv_id == conv], key=lambda r: r.example)
        ends = [i for i, t in enumerate(own) if t[0] == "assistant" or i == len(own) - 1]
        assert [[(t.role, t.text) for t in r.read] for r in got] == [own[: i + 1] for i in ends]
        assert [r.trained for r in got if r.target_turn is not None or own[ends[r.example]][0] == "assistant"] == [
            t[1] for t in own if t[0] == "assistant"
        ]
        assert all(r.loss_chars == 0 for r, i in zip(got, ends) if own[i][0] != "assistant")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<|>\\[]/sINTim_endp ", max_size=40), min_size=20, max_size=60))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.withColumn("e", chat.escaped(F.col("t"))).withColumn("u", chat.unescaped(F.col("e")))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
