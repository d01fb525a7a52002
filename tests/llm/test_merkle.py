"""The manifest against a plain recursive tree, and stored hash states against the library."""

import hashlib
import zlib

import numpy as np
import pytest

from motorlake.llm import merkle, sha256

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf int, position int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def leaf_of(row, text):
    return h(*(field(x) for x in (row[0], row[3], row[2], row[4], text)))


def climb(nodes, at):
    """(root, siblings of entry ``at``, level by level)"""
    others = []
    while len(nodes) > 1:
        start = at // 8 * 8
        others += [x for i, x in enumerate(nodes[start : start + 8], start) if i != at]
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], others


def brute(rows):
    trees = {}
    for n, row in enumerate(rows):
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), n))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {lang: sorted(trees[lang]) for lang in langs}
    tops = [climb([x[2] for x in ordered[lang]], 0)[0] for lang in langs]
    out = []
    for k, lang in enumerate(langs):
        nodes = [x[2] for x in ordered[lang]]
        for i, (_, _, leaf, n) in enumerate(ordered[lang]):
            row = rows[n]
            subroot, others = climb(nodes, i)
            root, more = climb(tops, k)
            hit = zlib.crc32(str(row[0] if row[0] is not None else "").encode()) % 3 == 0
            new = list(nodes)
            new[i] = leaf_of(row, lower(row[1])) if hit else leaf
            changed = list(tops)
            changed[k] = climb(new, i)[0]
            folded = climb(changed, k)[0]
            out.append((row[0], leaf, subroot, root, h(*others, *more), folded, folded == root))
    return sorted(out, key=str)


def rows_of(sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"Text {i} Ä é" if i % 5 else "small", lang, f"s{i % 3}", i * 7, "clash", 1, 2))
            i += 1
    return rows


ODD = [
    (None, "No id", None, None, None), (None, "No id", None, None, None), (5, None, "", "", 0), (5, "", "", "", 0),
    (5, "Twice", "", "", 0), (5, "Twice", "", "", 0), (-3, "MINUS", "zz", None, -1), (2**60 + 1, "Ünïcode X" * 30_000, "zz", "s", 9),
]


@pytest.mark.parametrize("step, sizes", [
    (1, {"en": 1}), (1, {"en": 8, "de": 9, None: 64}), (2, {"en": 65, "fr": 600, "é": 2, None: 1}), (1, {"a": 513}),
    (4, {f"l{i:02d}": i % 4 + 1 for i in range(20)}), (1, {f"l{i:02d}": i % 4 + 1 for i in range(70)}),
])
def test_manifest_against_plain_trees(spark, step, sizes):
    rows = rows_of(sizes) + [r + ("clash", 1, 2) for r in ODD]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = merkle.manifest(docs, step)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_one_leaf_is_the_root(spark):
    (row,) = merkle.manifest(spark.createDataFrame(rows_of({"en": 1}), SCHEMA)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h("")


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame(rows_of({"en": 1}), SCHEMA).limit(0)).collect() == []


def test_states_resume():
    rng = np.random.default_rng(3)
    digests = rng.integers(0, 2**32, (5, 7, 8), dtype=np.uint32)
    now = np.tile(sha256.START, (5, 1))
    for slot in range(7):
        now = sha256.absorb(now, sha256.hex_blocks(digests[:, slot]))
    ends = sha256.finish(now, np.full(5, 7))
    for row, end in zip(digests, ends):
        text = "".join(sha256.to_bytes(d).hex() for d in row)
        assert sha256.to_bytes(end).hex() == hashlib.sha256(text.encode()).hexdigest()


def test_left_siblings_are_not_read():
    rng = np.random.default_rng(4)
    digests = rng.integers(0, 2**32, (8, 8), dtype=np.uint32)
    counts, children, states, (plain,) = merkle._runs(digests)
    blank = children.copy()
    blank[0, :5] = 0
    (again,) = merkle.resume(counts, blank, states, np.array([5]), digests[5:6])
    assert (again == plain).all()
