"""Repeated runs of lines against comparing every run with all earlier ones."""

import random

import pytest

from motorlake.llm import line_runs

SCHEMA = "doc_id long, text string, row string, gone string, lines string"


def brute(rows, min_words):
    """Rows in the order of ids (null last), then as given."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    seen, out = set(), {}
    for n in order:
        text = rows[n][1]
        if text is None:
            out[n] = (0, 0, None)
            continue
        lines = text.split("\n")
        gone = set()
        for s in range(len(lines)):
            words = 0
            for e in range(s, len(lines)):
                words += len(lines[e].encode().split())
                if tuple(lines[s : e + 1]) not in seen:
                    break
                if words >= min_words:
                    gone.update(range(s, e + 1))
            for e in range(s, len(lines)):
                seen.add(tuple(lines[s : e + 1]))
        out[n] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def check(spark, rows, min_words):
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).coalesce(1)
    got = line_runs.remove_repeats(docs, min_words=min_words).collect()
    want = brute(rows, min_words)
    key = lambda r: tuple(map(repr, r))
    assert sorted(((r.row.doc_id, r.lines, r.removed, r.text) for r in got), key=key) == sorted(
        ((rows[n][0], *w) for n, w in want.items()), key=key)
    assert all(r.row.gone == "clash" for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    lines = ["", "a", "b c", "d e f", "same", "one two three four five"][: 3 + seed]
    rows = [(rng.choice([None, *range(30)]), "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9))))
            for _ in range(40)]
    check(spark, rows, 6)


def test_cases(spark):
    passage = "\n".join(f"line {i} of a passage that is long enough" for i in range(9))
    rows = [
        (5, f"intro five\n{passage}\nend five"), (2, f"other\n{passage}"), (9, passage), (9, passage), (None, passage),
        (1, None), (3, ""), (4, "\n\n\n"), (6, "short\nlines"), (7, "short\nlines"), (8, "r r r r r\n" * 40),
        (10, f"{passage}\n{passage}"), (11, "x " * 50_000), (12, "x " * 50_000),
    ]
    check(spark, rows, 25)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert line_runs.remove_repeats(docs).collect() == []


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a\nb", "", "", ""), (2, "a\nb", "", "", "")], SCHEMA)
    plan = line_runs.remove_repeats(docs, min_words=1)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
