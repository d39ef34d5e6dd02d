import random

import pytest

from sieveline.llm import line_dedup
from rows import clashing, empty_docs, odd_rows, sentence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def size(line):
    return len(line.replace("\x0b", " ").replace("\x0c", " ").split())


def brute(rows, least):
    """Texts after removal: a line goes if a run of at least ``least`` words that holds it occurs earlier."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    docs, seen = {}, set()
    for r in order:
        if r[1] is not None and (r[0], r[1]) not in docs:
            lines = r[1].split("\n")
            docs[r[0], r[1]] = ([i for i, x in enumerate(lines) if size(x)], lines)
    gone = {k: set() for k in docs}
    for key, (at, lines) in docs.items():
        for s in range(len(at)):
            for e in range(s, len(at)):
                run = tuple(lines[i] for i in at[s : e + 1])
                if sum(map(size, run)) < least:
                    continue
                if run in seen:
                    gone[key].update(at[s : e + 1])
                else:
                    seen.add(run)
        # Lines without words between two that go.
        for before, after in zip(at[:-1], at[1:]):
            if before in gone[key] and after in gone[key]:
                gone[key].update(range(before, after))
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        dropped = gone.get((r[0], r[1]), ())
        text = None if r[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in dropped)
        out.append((r[0], text, len(dropped)))
    return sorted(out, key=str)


def found(df, least):
    rows = line_dedup.dedup_lines(df, min_words=least).select("doc_id", "text", "removed_lines").collect()
    return sorted([tuple(r) for r in rows], key=str)


def test_against_brute_force(spark):
    assert found(clashing(spark), 50) == brute(odd_rows(), 50)


@pytest.mark.parametrize("least", [1, 12])
def test_runs_of_lines(spark, least):
    rng = random.Random(least)
    pool = [sentence(rng.randrange(1, 5), i * 10) for i in range(25)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 30))), None, None, None) for i in range(40)]
    rows += [(100 + i, rows[i][1], None, None, None) for i in range(5)]
    rows += [(200, "\n".join(["same line here"] * 20), None, None, None)]
    assert found(spark.createDataFrame(rows, SCHEMA), least) == brute(rows, least)


def test_a_long_repeated_document(spark):
    text = "\n".join(f"line {i} of many" for i in range(3000))
    rows = [(1, text, None, None, None), (2, "first of its own\n" + text + "\nlast of its own", None, None, None)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    assert got[0].text == text and got[1].text == "first of its own\nlast of its own"
    assert (got[1].removed_lines, got[1].removed_runs) == (3000, 1)


def test_empty(spark):
    assert line_dedup.dedup_lines(empty_docs(spark)).count() == 0
