"""Exact dedup, SimHash groups and the components below them, against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from motorlake.llm import exact_dedup, graph, simhash
from motorlake.llm.common import numbered

SCHEMA = "doc_id long, text string, source string, fp string, row_id long"


def docs_of(spark, texts):
    """Rows with columns whose names the operators use themselves."""
    rows = [(i, t, f"s{n % 2}", "clash", -n) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def exact_brute(texts):
    groups = {}
    for n, (i, t) in enumerate(texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t or ""), []).append((-len(t or ""), i is None, i or 0, n))
    return {n: (min(g), len(g)) for g in groups.values() for *_, n in g}


TEXTS = [
    (4, "a b c"), (2, "ab  c"), (9, "a\tb\nc"), (3, "abc"), (None, "abc \x0b"), (7, None), (8, ""), (6, " \r\n"),
    (5, "x"), (5, "x"), (5, "x "), (11, "é" * 40_000), (10, "é " * 40_000), (None, "only"), (None, "only"), (12, "X"),
]


@pytest.mark.parametrize("shards", [1, 3])
def test_exact_dedup(spark, shards):
    rows = exact_dedup.digested(docs_of(spark, TEXTS).coalesce(1))
    order = [r.row_id for r in rows.orderBy("row_id").collect()]
    history, arrivals = exact_dedup.batches(rows)
    index, number = exact_dedup.build_index(history, shards)
    assert number == shards
    stay = exact_dedup.winners(index, shards, arrivals)
    best = {r.text_sha256: r for r in stay.collect()}
    found = {r.row_id: r for r in exact_dedup.deduplicate(history, arrivals).collect()}
    assert len(found) == len(TEXTS) and len(best) == len(set(r.text_sha256 for r in found.values()))
    for n, ((_, no_id, keep, first), size) in exact_brute(TEXTS).items():
        got = found[order[n]]
        assert (got.keep_id, got.group_size) == (None if no_id else keep, size)
        assert got.kept == (n == first)


def test_exact_dedup_of_nothing(spark):
    rows = exact_dedup.digested(docs_of(spark, TEXTS).limit(0))
    assert exact_dedup.deduplicate(*exact_dedup.batches(rows)).collect() == []


LARGE = [
    (2**53 + 1, "one text"), (2**53 + 2, "one text "), (None, "one  text "), (2**53 + 7, "other"), (2**53 + 8, "another"),
    (None, "alone"), (2**62 + 3, "third"), (2**62 + 1, "thi rd"), (2**62 + 5, "third"), (-(2**60) - 1, "third"),
]


@pytest.mark.parametrize("first", [0, 3, len(LARGE)])
def test_large_ids_beside_nulls(spark, first):
    """Whatever is history and what arrives, an empty history included."""
    rows = exact_dedup.digested(docs_of(spark, LARGE).coalesce(1))
    order = [r.row_id for r in rows.orderBy("row_id").collect()]
    cut = order[first] if first < len(order) else order[-1] + 1
    found = exact_dedup.deduplicate(rows.filter(F.col("row_id") < cut), rows.filter(F.col("row_id") >= cut))
    got = {r.row_id: r for r in found.collect()}
    for n, ((_, no_id, keep, stays), size) in exact_brute(LARGE).items():
        row = got[order[n]]
        assert (row.doc_id, row.keep_id, row.group_size) == (LARGE[n][0], None if no_id else keep, size)
        assert row.kept == (n == stays)


def test_shards_follow_the_larger_side():
    n = exact_dedup.SHARD_KEYS
    assert exact_dedup.shards_for(0, 0) == 1
    assert exact_dedup.shards_for(0, 10 * n) == exact_dedup.shards_for(10 * n, 3) == 11


@pytest.mark.parametrize("size, shards", [(1, 50), (2, 500), (3, 500), (10, 500), (100, 250), (1000, 200), (50_000, 200)])
def test_every_shard_gets_a_minimal_hash(size, shards):
    for seed in range(shards):
        words = np.random.default_rng([size, seed]).integers(0, 2**64, (size, 4), dtype=np.uint64)
        slots = exact_dedup.slots_of(words, exact_dedup.build_levels(words))
        assert (np.bincount(slots, minlength=size) == 1).all() and len(slots) == size


def test_keys_that_differ_in_one_bit_part():
    base = np.random.default_rng(8).integers(0, 2**64, 4, dtype=np.uint64)
    words = np.tile(base, (257, 1))
    for bit in range(256):
        words[bit, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    slots = exact_dedup.slots_of(words, exact_dedup.build_levels(words))
    assert sorted(slots) == list(range(257))


def test_a_level_without_a_lone_key():
    """Two keys that meet on the first level: it has no bit, and the next one parts them."""
    for seed in range(3000):
        words = np.random.default_rng(seed).integers(0, 2**64, (2, 4), dtype=np.uint64)
        levels = exact_dedup.build_levels(words)
        if len(levels) > 1:
            assert not any(levels[0])
            assert sorted(exact_dedup.slots_of(words, levels)) == [0, 1]
            return
    raise AssertionError("no such pair")


def test_hash_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, (5000, 4), dtype=np.int64).view(np.uint64)
    levels = exact_dedup.build_levels(words)
    assert sorted(exact_dedup.slots_of(words, levels)) == list(range(5000))
    others = rng.integers(0, 2**63, (5000, 4), dtype=np.int64).view(np.uint64)
    slots = exact_dedup.slots_of(others, levels)
    held = words[np.argsort(exact_dedup.slots_of(words, levels))]
    assert not (held[slots[slots >= 0]] == others[slots >= 0]).all(axis=1).any()


# ---------------------------------------------------------------- SimHash

def print_brute(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    parts = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t", "One", "É é A b", "a b c d", "a b c d e f g h i j", "x " * 70_000, "a b " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == print_brute(text)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = [m % 2**64 for m in simhash.masks(radius)]
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(3000):
        flips = sum(1 << i for i in rng.sample(range(64), radius))
        assert any(flips & m == 0 for m in masks)


def near_prints(rng, centres, each):
    out = []
    for _ in range(centres):
        base = rng.getrandbits(64)
        for _ in range(each):
            base ^= sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5)))
            out.append(base)
    return out


def component_brute(prints, radius):
    left, out = set(prints), {}
    while left:
        front, seen = [left.pop()], set()
        while front:
            one = front.pop()
            seen.add(one)
            near = {p for p in left if (p ^ one).bit_count() <= radius}
            left -= near
            front.extend(near)
        for p in seen:
            out[p] = frozenset(seen)
    return out


@pytest.mark.parametrize("block", [4, 2048])
def test_links_lose_no_component(spark, block):
    """Also when buckets are dealt into blocks."""
    prints = sorted(set(near_prints(random.Random(5), 30, 12)))
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fp long")
    roots = {r.node % 2**64: r.root for r in graph.components(simhash.links(frame, 4, block)).collect()}
    brute = component_brute(prints, 4)
    for p in prints:
        others = frozenset(q for q in prints if q in roots and roots[q] == roots.get(p)) or frozenset([p])
        assert others == brute[p]


def test_classes_and_keep_one(spark):
    body = [f"w{i}" for i in range(400)]
    near = body[:]
    near[200] = "changed"
    texts = [(5, " ".join(body)), (3, " ".join(near)), (9, " ".join(body).upper()), (1, "other words that stand alone"),
             (7, None), (8, ""), (None, ""), (3, " ".join(near)), (None, "without id"), (None, "without id")]
    docs = docs_of(spark, texts)
    got = simhash.classes(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = [(r.doc_id, r.component_id) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(
        [(5, 3), (3, 3), (9, 3), (1, 1), (7, 7), (8, 7), (None, 7), (3, 3), (None, None), (None, None)], key=str
    )
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == [
        (1, "other words that stand alone"), (3, " ".join(near)), (7, None)]
    assert kept.filter("doc_id is null").count() == 1
    assert kept.filter("fp = 'clash'").count() == 4


def test_simhash_of_nothing(spark):
    docs = docs_of(spark, TEXTS).limit(0)
    assert simhash.classes(docs).collect() == [] and simhash.keep_one(docs).collect() == []


def test_components_of_chain_star_and_pairs(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame(chain + star + [(1, 2), (2, 1), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(200, 260)}, 7: 7, 1: 1, 2: 1}


def test_numbering_has_no_gap(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    got = numbered(rows, ["k"], "numbers").collect()
    assert sorted((r.position, r.k) for r in got) == [(i, i) for i in range(1000)]
