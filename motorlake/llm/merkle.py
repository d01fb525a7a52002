"""Merkle manifest of a dataset whose parents keep the hash states before each child.

A row's leaf is the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count,
``:`` and its value. Per partition of the table (``lang``) the leaves ascend by id; runs of
``ARITY`` become their parent, whose message is the children's digests as hexadecimal text.
The tops of the partitions, in the order of the partition values (null first), are the leaves
of a last tree, which gives the root.

A parent is stored with its children's digests and the hash state before each of them. To
fold a changed leaf, the state before its slot is resumed and takes the replacement and the
siblings to its right only; what stands to the left is never read again.

Trees grow in rounds: a round hashes ``STEP`` levels of blocks of ARITY**STEP consecutive
nodes, each block a group of its own, so no task holds more than that many nodes of one
tree, and the next round has that many times fewer. Paths come down the same way: a block's
way to the root is found once and shared by its leaves.

Rows without an id come first; of rows with equal ids the smaller leaf comes first, and fully
equal rows are interchangeable. A null partition value is a partition like any other. An
empty table has no leaves and gives no rows. Columns that are not hashed are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm import sha256
from motorlake.llm.common import numbered, remainder, saved

ARITY = 8
STEP = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NODE = "tree long, size long, level int, node long, digest binary, children binary, states binary, top boolean"
_PATH = "tree long, position long, path array<binary>"
_PROOF = "doc_id string, leaf binary, subroot binary, proof_sha256 string, folded_root binary"


def digest_of(fields: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of the fields, each led by its length in bytes."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, part: str = "lang", key: str = "doc_id",
           text: str = "text", every: int = 3) -> DataFrame:
    """Stored rows (part, doc_id, leaf, changed): one pass over the texts.

    ``changed`` is the leaf after tampering: where ``every`` divides the key's crc32 (a null
    key counts as ''), A-Z in the text become small; elsewhere it is the leaf itself.
    """
    columns = [F.col(f"`{f}`") for f in fields]
    lower = [F.translate(c.cast("string"), _UPPER, _UPPER.lower()) if f == text else c
             for f, c in zip(fields, columns)]
    leaf = digest_of(columns)
    rows = docs.select(
        F.col(f"`{part}`").cast("string").alias("part"),
        F.col(f"`{key}`").alias("doc_id"),
        leaf.alias("leaf"),
        F.when(remainder(f"`{key}`", every) == 0, digest_of(lower)).otherwise(leaf).alias("changed"),
    )
    return saved(rows.withColumn("row_id", F.monotonically_increasing_id()), "leaves")


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with tree, size and position in their tree; trees with part and size)."""
    rows = numbered(rows, ["part", "doc_id", "leaf", "row_id"], "ordered", "place")
    sizes = rows.groupBy("part").agg(F.count("*").alias("size"), F.min("place").alias("start"))
    trees = numbered(sizes, ["part"], "trees", "tree")
    inside = rows.alias("r").join(trees.alias("t"), F.col("r.part").eqNullSafe(F.col("t.part")))
    inside = inside.select(
        "tree", "size", (F.col("place") - F.col("start")).alias("position"), "doc_id", "leaf", "changed"
    )
    return inside, trees.select("tree", "part", "size")


def height(size: int) -> int:
    levels = 0
    while ARITY**levels < size:
        levels += 1
    return levels


# ---------------------------------------------------------------- building, a block a group

def _runs(digests: np.ndarray):
    """One level: digests (n, 8) to counts, children, states (parents, slots, 8) and parents."""
    parents = -(-len(digests) // ARITY)
    counts = np.full(parents, ARITY)
    counts[-1] = len(digests) - ARITY * (parents - 1)
    children = np.zeros((parents, ARITY, 8), dtype=np.uint32)
    children.reshape(-1, 8)[: len(digests)] = digests
    states = np.zeros_like(children)
    now = np.tile(sha256.START, (parents, 1))
    for slot in range(ARITY):
        live = counts > slot
        states[live, slot] = now[live]
        if live.any():
            now[live] = sha256.absorb(now[live], sha256.hex_blocks(children[live, slot]))
    return counts, children, states, sha256.finish(now, counts)


def _build(base: int, step: int):
    def block(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position")
        tree, size = int(group["tree"].iloc[0]), int(group["size"].iloc[0])
        digests = sha256.to_words(b"".join(group["digest"]))
        node = int(group["position"].iloc[0])
        rows, high = [], height(size)
        for level in range(base + 1, min(base + step, high) + 1):
            node //= ARITY
            counts, children, states, digests = _runs(digests)
            for i, n in enumerate(counts):
                rows.append((
                    tree, size, level, node + i, sha256.to_bytes(digests[i]), sha256.to_bytes(children[i, :n]),
                    sha256.to_bytes(states[i, :n]), level == high,
                ))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _NODE.split(", ")])

    return block


def build(entries: DataFrame, step: int = STEP) -> list[DataFrame]:
    """The parents of all trees over ``entries`` (tree, size, position, digest), by rounds.

    Round r holds the levels r * step + 1 to (r + 1) * step. Only the largest size reaches
    the driver: it says how many rounds there are.
    """
    largest = entries.agg(F.max("size")).first()[0] or 0
    rounds: list[DataFrame] = []
    for r in range(max(1, -(-height(largest) // step))):
        block = F.floor(F.col("position") / ARITY**step).cast("long").alias("block")
        grouped = entries.select("tree", "size", "position", "digest", block).groupBy("tree", "block")
        rounds.append(saved(grouped.applyInPandas(_build(r * step, step), _NODE), "nodes"))
        entries = rounds[-1].filter((F.col("level") == (r + 1) * step) & ~F.col("top")).select(
            "tree", "size", F.col("node").alias("position"), "digest"
        )
    return rounds


def tops(entries: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree; a lone leaf is its own top."""
    found = entries.filter("size = 1").select("tree", "digest")
    for nodes in rounds:
        found = found.unionByName(nodes.filter("top").select("tree", "digest"))
    return found


# ---------------------------------------------------------------- paths, top down

def _levels(nodes: pd.DataFrame):
    """The stored levels of one block, lowest first: (counts, children, states)."""
    for _, level in nodes[nodes["level"] > 0].sort_values(["level", "node"]).groupby("level"):
        counts = np.array([len(c) // 32 for c in level["children"]])
        full = 32 * ARITY
        yield counts, *(
            sha256.to_words(b"".join(x.ljust(full, b"\0") for x in level[name])).reshape(-1, ARITY, 8)
            for name in ("children", "states")
        )


def _steps(levels, index: int) -> list[bytes]:
    """The way of one entry up a block: slot, state before it, all children, level by level."""
    way = []
    for counts, children, states in levels:
        parent, slot = divmod(index, ARITY)
        way.append(bytes([slot]) + sha256.to_bytes(states[parent, slot])
                   + sha256.to_bytes(children[parent, : counts[parent]]))
        index = parent
    return way


def _entry_paths(base: int, step: int):
    def block(group: pd.DataFrame) -> pd.DataFrame:
        above = list(group.loc[group["level"] == 0, "path"].iloc[0])
        levels = list(_levels(group))
        tree = int(group["tree"].iloc[0])
        first = int(group["block"].iloc[0]) * ARITY**step
        entries = int(levels[0][0].sum()) if levels else 1
        return pd.DataFrame({
            "tree": tree, "position": range(first, first + entries),
            "path": [_steps(levels, i) + above for i in range(entries)],
        })

    return block


def _with_uppers(nodes: DataFrame, uppers: DataFrame, base: int, step: int) -> DataFrame:
    """The nodes of each block and, at level 0, the way from the block's top upwards."""
    block = F.floor(F.col("node") / F.pow(F.lit(ARITY), F.lit(base + step) - F.col("level"))).cast("long")
    stored = nodes.select(
        "tree", block.alias("block"), "level", "node", "children", "states", F.lit(None).cast("array<binary>").alias("path")
    )
    nothing = F.lit(None).cast("binary")
    return stored.unionByName(uppers.select(
        "tree", "block", F.lit(0).alias("level"), F.lit(0).cast("long").alias("node"),
        nothing.alias("children"), nothing.alias("states"), "path",
    ))


def uppers(rounds: list[DataFrame], above: DataFrame, step: int = STEP) -> DataFrame:
    """(tree, block, path) for the blocks of the first round: the way from their tops upwards.

    ``above`` (tree, size, path) holds the way from each tree's top.
    """
    found = None
    for r in reversed(range(len(rounds))):
        last = F.col("size") <= ARITY ** (step * (r + 1))
        if r:
            last &= F.col("size") > ARITY ** (step * r)
        ends = above.filter(last).select("tree", F.lit(0).cast("long").alias("block"), "path")
        found = ends if found is None else ends.unionByName(found)
        if r:
            found = entry_paths(rounds[r], found, r, step).withColumnRenamed("position", "block")
    return saved(found, "uppers")


def entry_paths(nodes: DataFrame, found: DataFrame, r: int = 0, step: int = STEP) -> DataFrame:
    """(tree, position, path) for every entry of the blocks of round r."""
    rows = _with_uppers(nodes, found, r * step, step)
    return rows.groupBy("tree", "block").applyInPandas(_entry_paths(r * step, step), _PATH)


# ---------------------------------------------------------------- folding

def resume(counts, children, states, index: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The parents' digests with entry ``index`` replaced by ``digests``; equal folds run once."""
    keys = np.column_stack([index.astype(np.uint32), digests]).astype(np.uint32)
    keys = np.ascontiguousarray(keys).view([("", np.uint32)] * 9).ravel()
    _, first, back = np.unique(keys, return_index=True, return_inverse=True)
    parent, slot = np.divmod(index[first], ARITY)
    new, ends = digests[first], counts[parent]
    now = states[parent, slot]
    for s in range(ARITY):
        live = (slot <= s) & (s < ends)
        if live.any():
            own = np.where((slot == s)[:, None], new, children[parent, s])
            now[live] = sha256.absorb(now[live], sha256.hex_blocks(own[live]))
    return sha256.finish(now, ends)[back.ravel()]


def _fold(step: int):
    def block(_key, rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=[c.split()[0] for c in _PROOF.split(", ")])
        upper = nodes[nodes["level"] == 0].iloc[0]
        levels = list(_levels(nodes))
        index = rows["position"].to_numpy() % ARITY**step
        digests = sha256.to_words(b"".join(rows["changed"]))
        at = index
        for level in levels:
            digests = resume(*level, at, digests)
            at = at // ARITY
        tail = b""
        for one in upper["path"]:
            slot, state, run = one[0], one[1:33], one[33:]
            shape, n = (1, ARITY, 8), len(run) // 32
            children = sha256.to_words(run.ljust(32 * ARITY, b"\0")).reshape(shape)
            states = np.zeros(shape, dtype=np.uint32)
            states[0, slot] = sha256.to_words(state)[0]
            digests = resume(np.array([n]), children, states, np.full(len(rows), slot), digests)
            tail += (run[: 32 * slot] + run[32 * slot + 32 :]).hex().encode()
        runs = [
            [sha256.to_bytes(c[:n]).hex().encode() for n, c in zip(counts, children)]
            for counts, children, _ in levels
        ]
        proofs = []
        for i in index.tolist():
            proof = hashlib.sha256()
            for level in runs:
                i, slot = divmod(i, ARITY)
                proof.update(level[i][: 64 * slot] + level[i][64 * slot + 64 :])
            proof.update(tail)
            proofs.append(proof.hexdigest())
        raw = sha256.to_bytes(digests)
        return pd.DataFrame({
            "doc_id": rows["doc_id"], "leaf": rows["leaf"], "subroot": [upper["subroot"]] * len(rows),
            "proof_sha256": proofs, "folded_root": [raw[i : i + 32] for i in range(0, len(raw), 32)],
        })

    return block


def fold(rows: DataFrame, nodes: DataFrame, found: DataFrame, subroots: DataFrame, step: int = STEP) -> DataFrame:
    """Each row (tree, position, doc_id, leaf, changed) with its proof and the root its
    changed leaf folds to. ``nodes`` are those of the first round."""
    kind = rows.schema["doc_id"].dataType
    block = F.floor(F.col("position") / ARITY**step).cast("long").alias("block")
    left = rows.select("tree", block, "position", F.col("doc_id").cast("string").alias("doc_id"), "leaf", "changed")
    own = subroots.select("tree", F.col("digest").alias("subroot"))
    right = _with_uppers(nodes, found, 0, step).join(own, "tree")
    grouped = left.groupBy("tree", "block").cogroup(right.groupBy("tree", "block"))
    return grouped.applyInPandas(_fold(step), _PROOF).withColumn("doc_id", F.col("doc_id").cast(kind))


def manifest(docs: DataFrame, step: int = STEP, **options) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is folded from the tampered leaf where there is one, otherwise from the
    leaf itself, with the stored states and siblings of the untouched trees.
    """
    spark = docs.sparkSession
    rows, trees = placed(leaves(docs, **options))
    entries = rows.select("tree", "size", "position", F.col("leaf").alias("digest"))
    rounds = build(entries, step)
    subroots = saved(tops(entries, rounds), "subroots")
    number = trees.count()
    parts = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(number).cast("long").alias("size"),
        F.col("tree").alias("position"), "digest",
    )
    over = build(parts, step)
    root = tops(parts, over).first()
    root = bytes(root.digest) if root else b""
    top = spark.createDataFrame([(0, number, [])], "tree long, size long, path array<binary>")
    ways = entry_paths(over[0], uppers(over, top, step), 0, step)
    above = ways.select(F.col("position").alias("tree"), "path").join(trees.select("tree", "size"), "tree")
    folded = fold(rows, rounds[0], uppers(rounds, saved(above, "above"), step), subroots, step)
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "folded_root")}
    return folded.withColumn("root", F.lit(root.hex())).withColumns(text).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    ).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
