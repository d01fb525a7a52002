"""Mixing against exact fractions."""

from collections import Counter
from fractions import Fraction

import pytest

from motorlake.llm import mixing

SCHEMA = "doc_id long, text string, source string, copies string, row string"


def target_brute(sizes):
    """Shares by weight, none above three times its source: shared again until it holds."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        room = total - sum(3 * sizes[s] for s in capped)
        weights = sum(weight[s] for s in open_) or 1
        target = {s: Fraction(3 * sizes[s]) if s in capped else Fraction(room * weight[s], weights) for s in order}
        above = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


CASES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 1000, "é": 5, "Z": 300, None: 40},
    {"a": 0, "b": 7},
    {"one": 12},
    {f"s{i}": (i * i) % 17 for i in range(30)},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = target_brute(sizes)
    assert got.keys() == want.keys()
    for source, value in want.items():
        assert got[source] == pytest.approx(float(value), abs=1e-9)


def documents(spark):
    rows = [(i, "w " * (i % 40), f"s{i % 4}" if i % 9 else None, "clash", "x") for i in range(2000)]
    rows += [(5, "again and again", "s1", "c", None), (5, "again and again", "s1", "c", None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_copies_follow_the_rate_and_do_not_change(spark):
    docs = documents(spark)
    first, second = (mixing.copies(d).collect() for d in (docs, docs.repartition(7)))
    key = lambda r: (str(r.doc_id), r.size, r.copies, r.target)
    assert sorted(map(key, first)) == sorted(map(key, second))
    taken, target = Counter(), {}
    for r in first:
        assert int(r.rate) <= r.copies <= min(3, int(r.rate) + 1)
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    for source, goal in target.items():
        assert abs(taken[source] - goal) < 0.1 * goal
    twins = [r.copies for r in first if r.doc_id == 5]
    assert len(set(twins)) == 1


def test_mix_emits_rows_as_often(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.copies(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want


def test_mixing_nothing(spark):
    docs = documents(spark).limit(0)
    assert mixing.copies(docs).collect() == [] and mixing.mix(docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a", "", ""), (2, " ", None, "", "")], SCHEMA)
    assert [(r.size, r.target) for r in mixing.copies(blank).collect()] == [(0, 0.0), (0, 0.0)]
