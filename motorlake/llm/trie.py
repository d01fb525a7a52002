"""Prefix trie of conversations, grown as a burst trie.

A node is a distinct sequence of first turns. Conversations with equal turns are one suffix
with a number of members. All suffixes start in one container under the root. A container of
more than ``LIMIT`` turns bursts: its suffixes are followed to the first depth at which they
differ and dealt, by the id of the turn there, into containers under new heads; the turns
they shared become a chain of nodes. A round bursts every oversized container at once, as
joins and grouped minima that Spark spreads, and rounds grow with the forks above the
largest containers, not with their depth. What remains is dealt by head to tasks, sorted, and
swept into nodes: a suffix keeps the nodes of what it shares with the one before it. A
container of one suffix is a chain, whatever its length. Totals of subtrees go back up the
rounds.

No task holds more than a container; a chain is summed in blocks; the ids of the members of
one suffix are joined in chunks, which one hash takes in turn.

Every conversation is rebuilt before: see ``rebuilt``. Turn ids are the first 128 bits of a
SHA-256 over role and text; null role or text counts as empty. Turns of equal number are
ordered by turn id. Rows without a conversation id are left out, ids are integers, other
columns are ignored. A table without conversations gives no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, numbered, saved

LIMIT = 1024
GROUP = 5
HEADS = 9
CHUNK = 4096
BLOCK = 1024
NO_ENDS = hashlib.sha256(b"").hexdigest()
_ROOT = bytearray(b"root")
_ENDS = "len long, k1 long, k2 long, s long, n long, ends string"
_SWEPT = (
    "head binary, parent binary, is_head boolean, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_COLUMNS = [c.split()[0] for c in _SWEPT.split(", ")]


def short_hash(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns_of(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """Stored rows (c, t, b, place): every turn's id and bytes, numbered by conversation and turn."""
    who, said = clean_text(F.col(f"`{role}`")), clean_text(F.col(f"`{text}`"))
    lead = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary")
    rows = conversations.select(
        F.col(f"`{key}`").cast("long").alias("c"),
        F.col(f"`{turn}`").alias("turn"),
        short_hash(lead).alias("t"),
        F.octet_length(said).cast("long").alias("b"),
        F.monotonically_increasing_id().alias("row_id"),
    ).filter("c is not null")
    return numbered(rows, ["c", "turn", "t", "row_id"], "turns", "place")


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conversation ids, turns (c, d, t, b) with depths from 1), both stored.

    Conversation c takes the first h turns of conversation c - c % group and then its own
    after its first h; h is crc32 of the id modulo ``heads``. One join gives every turn the
    conversations it goes to: its own, and the few that begin with it.
    """
    info = saved(turns.groupBy("c").agg(F.min("place").alias("start"), F.count("*").alias("n")), "conversations")
    h = F.crc32(F.col("c").cast("string")) % heads
    known = info.select("c", "start", "n", (F.col("c") - F.col("c") % group).alias("base"), h.alias("h"))
    followers = known.groupBy("base").agg(F.collect_list(F.struct("c", "h")).alias("followers"))
    first = known.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    plan = known.join(first, "base", "left").select(
        "c", "start", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("before")
    ).join(followers.withColumnRenamed("base", "c"), "c", "left")
    i = F.col("i")
    own = F.when(i >= F.col("h"), F.array(F.struct("c", (F.col("before") + i - F.col("h") + 1).alias("d"))))
    given = F.transform(
        F.filter("followers", lambda f: i < f.h), lambda f: F.struct(f.c.alias("c"), (i + 1).alias("d"))
    )
    none = F.array().cast("array<struct<c:bigint,d:bigint>>")
    dealt = turns.join(saved(plan, "plan"), "c").withColumn("i", F.col("place") - F.col("start"))
    to = F.concat(F.coalesce(own, none), F.when(i < heads - 1, F.coalesce(given, none)).otherwise(none))
    return info.select("c"), saved(dealt.select(F.inline(to), "t", "b"), "rebuilt")


def _hash_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted chunks of member ids to one row per sequence; only a hash state is held."""
    now, state, first, n = None, None, 0, 0
    for batch in batches:
        done = []
        for *key, ids, least, count in zip(*(batch[c] for c in ("len", "k1", "k2", "ids", "least", "count"))):
            if key != now:
                if now:
                    done.append((*now, first, n, state.hexdigest()))
                now, state, first, n = key, hashlib.sha256(ids.encode()), least, count
            else:
                state.update(b"," + ids.encode())
                n += count
        yield pd.DataFrame(done, columns=[c.split()[0] for c in _ENDS.split(", ")])
    if now:
        yield pd.DataFrame([(*now, first, n, state.hexdigest())], columns=[c.split()[0] for c in _ENDS.split(", ")])


def sequences(ids: DataFrame, turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Stored rows (s, n, len, ends): each distinct sequence with its smallest member, their
    number and the hash of their ids in order. Equal means equal length and two hashes."""
    key = turns.groupBy("c").agg(
        F.count("*").alias("len"), F.bit_xor(F.xxhash64("d", "t")).alias("k1"),
        F.bit_xor(F.xxhash64("t", "d", F.lit("second"))).alias("k2"),
    )
    whole = ids.join(key, "c", "left").fillna(0, ["len", "k1", "k2"])
    rows = numbered(whole, ["len", "k1", "k2", "c"], "members")
    rows = rows.withColumn("chunk", F.floor(F.col("position") / chunk))
    names = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",")
    chunks = rows.groupBy("len", "k1", "k2", "chunk").agg(
        names.alias("ids"), F.min("c").alias("least"), F.count("*").alias("count")
    )
    keys = ["len", "k1", "k2"]
    dealt = chunks.repartition(*keys).sortWithinPartitions(*keys, "chunk")
    return saved(dealt.mapInPandas(_hash_ends, _ENDS).select("s", "n", "len", "ends"), "sequences")


# ---------------------------------------------------------------- bursting

def burst(suffixes: DataFrame, turns: DataFrame, limit: int = LIMIT):
    """(suffixes in containers that need no burst, chains, steps of the chains), by rounds.

    A suffix is (s, n, len, ends, head, parent, depth, hb): its container's head, the head
    that one was burst from, its depth and the bytes of the turn that leads to it. A chain is
    what the suffixes of a burst container share: (head, parent, depth, last, n, conv_id,
    ends) and its steps (head, d, b).
    """
    calm, chains, steps = [], [], []
    while True:
        size = suffixes.groupBy("head").agg(
            F.sum(F.col("len") - F.col("depth")).alias("rows"), F.count("*").alias("members")
        )
        big = saved(size.filter((F.col("rows") > limit) & (F.col("members") > 1)).select("head", "members"), "big")
        if big.isEmpty():
            calm.append(suffixes)
            return calm, chains, steps
        calm.append(suffixes.join(big, "head", "left_anti"))
        crowd = saved(suffixes.join(big, "head"), "crowd")
        spread = saved(
            turns.join(crowd.select("s", "head", "depth", "members"), "s").filter("d > depth")
            .groupBy("head", "members", "d")
            .agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count("*").alias("seen"), F.max("b").alias("b")),
            "spread",
        )
        forks = spread.filter("low <> high or seen < members").groupBy("head").agg(F.min("d").alias("fork"))
        forks = saved(forks, "forks")
        crowd = crowd.join(forks, "head")
        ended = F.max(F.when(F.col("len") == F.col("fork") - 1, F.col("ends"))).alias("ends")
        chains.append(saved(
            crowd.groupBy("head").agg(
                F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("hb").alias("hb"),
                (F.first("fork") - 1).alias("last"), F.sum("n").alias("n"), F.min("s").alias("conv_id"), ended,
            ), "chains",
        ))
        steps.append(spread.join(forks, "head").filter("d < fork").select("head", "d", "b"))
        suffixes = saved(
            crowd.join(turns.withColumnRenamed("d", "fork"), ["s", "fork"]).select(
                "s", "n", "len", "ends", short_hash("head", "t").alias("head"), F.col("head").alias("parent"),
                F.col("fork").alias("depth"), F.col("b").alias("hb"),
            ), "suffixes",
        )


# ---------------------------------------------------------------- sweeping

def _container(rows: list[tuple]) -> list[tuple]:
    """The nodes of one container, its head first, from its suffixes in sorted order."""
    head, parent, depth, hb = rows[0][:4]
    depths, over, size, n, conv, ends = [depth], [0], [hb], [0], [1 << 63], [NO_ENDS]
    way, last = [0], ()
    for *_, s, members, ended, ids, lengths in rows:
        shared = 0
        for a, b in zip(last, ids):
            if a != b:
                break
            shared += 1
        del way[shared + 1 :]
        for step in range(shared, len(ids)):
            over.append(way[-1])
            way.append(len(depths))
            depths.append(depth + 1 + step)
            size.append(lengths[step])
            n.append(0)
            conv.append(1 << 63)
            ends.append(NO_ENDS)
        node = way[-1]
        n[node], conv[node], ends[node] = members, s, ended
        last = ids
    children, leaves, kept = [0] * len(n), [0] * len(n), [0] * len(n)
    for i in range(len(n) - 1, -1, -1):
        leaves[i] = leaves[i] or 1
        kept[i] += (n[i] - 1) * size[i]
        if i:
            above = over[i]
            n[above] += n[i]
            conv[above] = min(conv[above], conv[i])
            children[above] += 1
            leaves[above] += leaves[i]
            kept[above] += kept[i]
    return [
        (head, parent, i == 0, conv[i], depths[i], conv[over[i]], n[i], children[i], leaves[i], kept[i], ends[i])
        for i in range(len(n))
    ]


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["head", "parent", "depth", "hb", "s", "n", "ends", "ids", "lengths"]
    rows: list[tuple] = []
    for batch in batches:
        done: list[tuple] = []
        for row in zip(*(batch[c] for c in names)):
            if rows and row[0] != rows[0][0]:
                done += _container(rows)
                rows = []
            rows.append(row)
        yield pd.DataFrame(done, columns=_COLUMNS)
    if rows:
        yield pd.DataFrame(_container(rows), columns=_COLUMNS)


def swept(suffixes: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of containers that fit a task, each head with ``is_head``."""
    rest = turns.join(suffixes.select("s", "depth"), "s").filter("d > depth").groupBy("s").agg(
        F.array_sort(F.collect_list(F.struct("d", "t", "b"))).alias("rest")
    )
    whole = suffixes.join(rest, "s", "left").withColumn(
        "rest", F.coalesce("rest", F.array().cast("array<struct<d:bigint,t:binary,b:bigint>>"))
    )
    rows = whole.select("head", "parent", "depth", "hb", "s", "n", "ends", F.col("rest.t").alias("ids"),
                        F.col("rest.b").alias("lengths"))
    dealt = rows.repartition("head").sortWithinPartitions("head", "ids")
    return saved(dealt.mapInPandas(_sweep, _SWEPT), "swept")


# ---------------------------------------------------------------- chains

def rests(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(head, d, rest): the bytes of a chain's steps from d on, summed in blocks."""
    rows = steps.withColumn("block", F.floor(F.col("d") / block))
    after = Window.partitionBy("head").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    later = rows.groupBy("head", "block").agg(F.sum("b").alias("total")).select(
        "head", "block", F.coalesce(F.sum("total").over(after), F.lit(0)).alias("later")
    )
    within = Window.partitionBy("head", "block").orderBy(F.desc("d"))
    summed = rows.select("head", "block", "d", F.sum("b").over(within).alias("own"))
    return summed.join(later, ["head", "block"]).select("head", "d", (F.col("own") + F.col("later")).alias("rest"))


def chain_nodes(chains: DataFrame, steps: DataFrame) -> DataFrame:
    """Nodes of chains that carry (kids, leaves, below): what hangs under their last node."""
    heads = chains.select("head", F.col("depth").alias("d"), F.col("hb").alias("b"))
    at_end = F.col("d") == F.col("last")
    return saved(
        rests(steps.unionByName(heads)).join(chains, "head").select(
            "head", "parent", (F.col("d") == F.col("depth")).alias("is_head"), "conv_id", F.col("d").alias("depth"),
            F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(at_end, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"), (F.col("below") + (F.col("n") - 1) * F.col("rest")).alias("saved_tokens"),
            F.when(at_end, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
        ), "chain-nodes",
    )


def trie(conversations: DataFrame, limit: int = LIMIT, group: int = GROUP, heads: int = HEADS,
         chunk: int = CHUNK, **columns: str) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    ids, turns = rebuilt(turns_of(conversations, **columns), group, heads)
    seqs = sequences(ids, turns, chunk)
    turns = saved(turns.join(seqs.select(F.col("s").alias("c")), "c").withColumnRenamed("c", "s"), "distinct")
    zero = F.lit(0).cast("long")
    start = seqs.select("s", "n", "len", "ends", F.lit(_ROOT).alias("head"), F.lit(None).cast("binary").alias("parent"),
                        zero.alias("depth"), zero.alias("hb"))
    calm, chains, steps = burst(saved(start, "suffixes"), turns, limit)
    suffixes = calm[0]
    for more in calm[1:]:
        suffixes = suffixes.unionByName(more)
    long = (F.col("len") - F.col("depth")) > limit  # only in a container of one suffix
    nodes = swept(suffixes.filter(~long), turns)
    alone = suffixes.filter(long)
    ways = turns.join(alone.select("s", "head", "depth"), "s").filter("d > depth").select("head", "d", "b")
    lone = alone.select("head", "parent", "depth", "hb", F.col("len").alias("last"), "n", F.col("s").alias("conv_id"),
                        "ends", zero.alias("kids"), F.lit(1).cast("long").alias("leaves"), zero.alias("below"))
    nodes = nodes.unionByName(chain_nodes(lone, ways))
    settled, newest = [nodes], nodes
    for chain, way in zip(reversed(chains), reversed(steps)):
        tops = nodes if newest is nodes else nodes.unionByName(newest)
        below = tops.filter("is_head").groupBy(F.col("parent").alias("head")).agg(
            F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below")
        )
        newest = chain_nodes(chain.join(below, "head"), way)
        settled.append(newest)
    for more in settled[1:]:
        nodes = nodes.unionByName(more)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.filter("not is_head").select(out)
    owners = [chain.select(F.col("head").alias("parent"), F.col("conv_id").alias("owner")) for chain in chains]
    top = nodes.filter("is_head")
    if owners:
        every = owners[0]
        for more in owners[1:]:
            every = every.unionByName(more)
        top = top.join(every, "parent", "left")
    else:
        top = top.withColumn("owner", F.lit(None).cast("long"))
    return inner.unionByName(top.withColumn("parent_conv_id", F.col("owner")).select(out))
