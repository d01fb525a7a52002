"""The burst trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from motorlake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, head string, s int, d int"


def turn_key(row):
    role, text = row[2] or "", row[3] or ""
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
    return row[1] is not None, row[1] or 0, digest


def brute(rows, group=5, heads=9):
    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=turn_key):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        rest = int(abs(c) % group) * (1 if c >= 0 else -1)
        convs[c] = tuple(own.get(c - rest, [])[:h] + own[c][h:])
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, kept = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        kept[p] = sum(kept[k] for k in children[p])
        kept[p] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]), leaves[p], kept[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    table = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA).repartition(3)
    found = trie.trie(table, **options)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def mixed(seed, convs):
    """Few texts, so that prefixes are shared; copies, long copies and near copies of them."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 1 else "user", rng.choice(["a", "é", "Hi", ""]) if t else "hot"))
    for c in range(1000, 1030):  # copies of a long conversation, some with another last turn
        rows += [(c, t, "user", f"long {t}" if t < 59 or c % 3 else f"end {c}") for t in range(60)]
    return rows


ODD = [
    (None, 0, "user", "nobody"), (-7, None, None, None), (-7, 1, "user", "x"), (-7, 1, "user", "x"), (-7, 1, None, "y"),
    (-5, 0, "user", "Ä" * 50_000), (3, 0, "user", "single"), (2**60, 0, "", ""), (2**60 + 1, None, "u", "z"), (4, 5, "ab", "c"), (4, 6, "a", "bc"),
]


@pytest.mark.parametrize("limit, chunk", [(5, 2), (150, 7), (1024, 4096)])
def test_nodes_against_prefixes(spark, limit, chunk):
    check(spark, mixed(limit, 60) + [(c + 500 if c is not None and 0 <= c < 100 else c, *r) for c, *r in ODD], limit=limit, chunk=chunk)


def test_one_conversation_longer_than_a_container(spark):
    check(spark, [(5, t, "user", f"turn {t}") for t in range(90)] + [(10, t, "user", f"turn {t}") for t in range(90)], limit=8)


def test_odd_rows(spark):
    check(spark, ODD, limit=3)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(6, 40) if c % 5]  # their first conversations are absent
    found = brute(rows)
    assert any(r[1] == 0 and r[7] != trie.NO_ENDS for r in found)
    check(spark, rows)


def test_no_conversations(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
