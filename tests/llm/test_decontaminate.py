"""Benchmark search against all windows compared one by one."""

import random
from collections import Counter

import numpy as np
import pytest

from motorlake.llm import decontaminate as D

DOCS = "doc_id long, text string, m string, item_id string"
ITEMS = "item_id long, text string, extra string"
RNG = random.Random(3)
VOCABULARY = [f"word{i}" for i in range(300)]


def prose(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


BIG = prose(60)
SMALL = prose(25)
EDITED = BIG[:2] + ["edited"] + BIG[3:]
ROWS = [
    (1, " ".join(prose(300) + BIG + prose(200))),
    (2, "Intro, " + " ".join(BIG).upper().replace(" ", ", ") + "."),
    (3, " ".join(prose(50) + EDITED + prose(50) + SMALL)),
    (4, " ".join(prose(900))),
    (5, " ".join(BIG[:30] + prose(30))),
    (6, None), (7, ""), (8, " ".join(BIG[:55])), (None, " ".join(SMALL)), (9, "tiny item here"), (9, "a tiny, ITEM here"),
    (10, " ".join(prose(40_000) + BIG)),
]
BENCH = [(11, " ".join(BIG)), (12, " ".join(SMALL)), (13, "tiny item"), (14, ""), (15, None), (16, " ".join(prose(30))),
         (17, " ".join(SMALL))]


def brute(text, item, threshold=0.8):
    words, goal = D.words_of(text or ""), D.words_of(item or "")
    if not goal or not words:
        return None
    size, length = min(len(goal), len(words)), min(5, len(goal))
    if size < length:
        return None
    bag, best = Counter(D.shingles(goal, length)), (0, 0)
    for start in range(len(words) - size + 1):
        if bag.keys() & (window := Counter(D.shingles(words[start : start + size], length))).keys():
            best = max(best, (D.similarity(window, bag), -start))
    return (round(best[0], 9), -best[1]) if best[0] >= threshold else None


@pytest.mark.parametrize("chars", [1 << 20, 200])
def test_matches(spark, chars):
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in ROWS], DOCS)
    bench = spark.createDataFrame([(*r, "") for r in BENCH], ITEMS)
    got = sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.start) for r in
                  D.matches(docs, bench, chars=chars).collect()), key=str)
    want = sorted(((d, i, *found) for d, t in ROWS for i, item in BENCH if (found := brute(t, item))), key=str)
    assert got == want and {(1, 11), (2, 11), (3, 11), (8, 11), (10, 11), (3, 17)} <= {g[:2] for g in got}
    clean = D.clean(docs, bench, chars=chars)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7]


@pytest.mark.parametrize("bits, docs_chars", [(1 << 16, 3000), (1 << 26, 9000)])
def test_blocks_dealt_to_many_tasks_and_a_crowded_filter(spark, monkeypatch, bits, docs_chars):
    """Items share a beginning that half of the documents hold too, and texts are repeated."""
    monkeypatch.setattr(D, "FILTER_BITS", bits)
    monkeypatch.setattr(D, "DOC_CHARS", docs_chars)
    common = "which of the following statements is true about"
    items = [(i, f"{common} " + " ".join(prose(12 + i % 5))) for i in range(12)] + [(None, f"{common} no id at all")]
    rows = [(i, " ".join(prose(30) + common.split() + prose(40))) for i in range(20)]
    rows += [(100 + i, " ".join(prose(9)) + f" {items[i % 13][1]} " + (common + " ") * 10) for i in range(16)] + rows[-1:] * 3
    bench = spark.createDataFrame([(*r, "") for r in items], ITEMS)
    docs = spark.createDataFrame([(*r, "", "") for r in rows], DOCS)
    got = sorted((str((r.doc_id, r.item_id, round(r.similarity, 9), r.start)) for r in
                  D.matches(docs, bench, chars=2500).collect()))
    want = [str((d, i, *found)) for d, t in rows for i, item in items if (found := brute(t, item))]
    assert got == sorted(want) and len(want) >= 16
    held = {d for d, t in rows if d >= 100}
    assert held == {r.doc_id for r in D.matches(docs, bench).collect()}
    assert sorted(r.doc_id for r in D.clean(docs, bench, chars=2500).collect()) == sorted(d for d, _ in rows if d not in held)


def test_the_filter_lets_all_shingles_of_items_pass(spark):
    bench = spark.createDataFrame([(*r, "") for r in BENCH], ITEMS)
    index = D.Benchmark(bench, 700)
    assert index.lengths == [2, 5] and index.items.select("block").distinct().count() > 2
    hashes = D.WordHashes()
    for _, text in BENCH:
        words = D.words_of(text or "")
        for code in D.codes_of(hashes.of(words), min(5, len(words))).tolist() if words else []:
            for place in (code % D.FILTER_BITS, (code >> 32) % D.FILTER_BITS):
                assert index.filter[place // 8] >> (place % 8) & 1
    assert np.unpackbits(index.filter).sum() <= 2 * index.codes.count()


def test_no_rows(spark):
    docs = spark.createDataFrame([(*r, "", "") for r in ROWS], DOCS)
    bench = spark.createDataFrame([(*r, "") for r in BENCH], ITEMS)
    assert D.matches(docs.limit(0), bench).collect() == []
    assert D.matches(docs, bench.limit(0)).collect() == []
    assert D.clean(docs, bench.limit(0)).count() == len(ROWS)


def test_blocks_hold_every_print_within_the_radius():
    for _ in range(500):
        a = RNG.getrandbits(64)
        b = a ^ sum(1 << i for i in RNG.sample(range(64), D.RADIUS))
        pairs = zip(a.to_bytes(8, "big"), b.to_bytes(8, "big"))
        assert any(y in D.near_values(x, D.RADIUS // D.BLOCKS) for x, y in pairs)
