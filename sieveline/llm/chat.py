"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, then the
turn itself, whose text alone is trained on. Turns after the last assistant turn make one more
example without a target, so that no turn is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BEGIN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Strings that a template or a tokenizer may treat as control; inside texts they are escaped.
CONTROL = [BEGIN, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
ESCAPE = "\\"


def escaped(text: Column) -> Column:
    """Doubles backslashes and puts one behind the first character of every control string."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESCAPE + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    """Undoes :func:`escaped`: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per example: ``conv_id, example, target_turn, formatted, loss_start, loss_chars``.

    The loss mask covers ``loss_chars`` code points of ``formatted`` from ``loss_start`` (0-based):
    the escaped text of the target. Null texts and roles count as empty. Rows are ordered by turn
    (null first), then role, then text; rows without a conversation id form one conversation. An
    example without a target has a null ``target_turn`` and an empty mask. The examples of a
    conversation together are as long as the square of its turns, which the method asks for; one
    conversation is built in one task. Other columns are not read.
    """
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), value(role).alias("role"), value(text).alias("text"))
    rows = rows.withColumns(
        {
            "head": F.concat(F.lit(BEGIN), escaped(F.col("role")), F.lit(SEP)),
            "body": escaped(F.col("text")),
        }
    )
    chats = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "head", "body"))).alias("turns")
    )
    targets = F.expr(
        "filter(transform(turns, (t, i) -> if(t.role = 'assistant' or i = size(turns) - 1, i, -1)), i -> i >= 0)"
    )
    examples = chats.select("conv_id", "turns", F.posexplode(targets).alias("example", "last"))
    target = F.col("turns")[F.col("last")]
    trained = target["role"] == "assistant"
    # Array elements past the target are left out; the target's own text ends the example.
    before = F.expr(f"concat_ws('', transform(slice(turns, 1, last), t -> concat(t.head, t.body, '{END}')))")
    return examples.select(
        "conv_id",
        "example",
        F.when(trained, target["turn"]).alias("target_turn"),
        F.concat(before, target["head"], target["body"], F.lit(END)).alias("formatted"),
        F.when(trained, F.length(before) + F.length(target["head"])).otherwise(0).cast("long").alias("loss_start"),
        F.when(trained, F.length(target["body"])).otherwise(0).cast("long").alias("loss_chars"),
    )


def read_chat(formatted: Column) -> Column:
    """array(struct(role, text)) of a formatted example."""
    parts = F.filter(F.split(formatted, r"\Q" + BEGIN + r"\E"), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescaped(F.substring_index(p, SEP, 1)).alias("role"),
            unescaped(F.substring_index(F.substring_index(p, SEP, -1), END, 1)).alias("text"),
        ),
    )


def trained_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(F.substring(formatted, loss_start.cast("int") + 1, loss_chars.cast("int")))
