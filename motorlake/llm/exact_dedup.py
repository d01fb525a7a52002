"""Exact dedup against an index of digests already seen.

The index is a minimal perfect hash over the distinct digests of a history table. It is
split into shards by the leading digits of the digest; SHA-256 spreads them evenly, and there
are so many shards that one holds about ``SHARD_KEYS`` digests of the history and about as
many that arrive, whichever are more, whatever the tables' sizes. In a shard every digest
owns one slot, and the slot keeps the whole digest and the locator of its winner (code
points, id, row). A lookup hashes to a slot and compares all 32 bytes: equal means repeat,
anything else is no member. Digests that are no members are grouped among themselves.

Texts are equal when they agree after deleting the white space of ``common.SPACES``; a null
text counts as empty. Of equal texts the row with most code points stays, then the smallest
id (null ids last), then the first stored row, so that of fully repeated rows one stays. Ids
are integers (other types are cast, and a cast that fails is an error); tasks carry them as
text, so that a null beside them changes nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import SPACES, clean_text, saved

SHARD_KEYS = 50_000
_LOAD = 1.7  # bits per key on a level
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64
)
_SLOTS = "shard int, levels array<binary>, digests binary, chars array<long>, ids array<string>, rows array<long>, counts array<long>"
_WINNERS = "text_sha256 string, chars long, keep_id string, keep_row long, group_size long"


def digested(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, chars, text_sha256, row_id of every row, stored."""
    body = clean_text(text)
    return saved(
        docs.select(
            F.col(key).cast("long").alias("doc_id"),
            F.length(body).cast("long").alias("chars"),
            F.sha2(F.translate(body, SPACES, "").cast("binary"), 256).alias("text_sha256"),
        ).withColumn("row_id", F.monotonically_increasing_id()),
        "digests",
    )


def best_of(rows: DataFrame) -> DataFrame:
    """One row per digest, combined before the shuffle: the winner and the group's size."""
    order = F.struct(
        (-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"
    )
    return rows.groupBy("text_sha256").agg(F.min(order).alias("b"), F.count("*").alias("group_size")).select(
        "text_sha256", (-F.col("b.less")).alias("chars"), F.col("b.doc_id").alias("keep_id"),
        F.col("b.row_id").alias("keep_row"), "group_size",
    )


def shard_of(digest: str, shards: int) -> Column:
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % shards).cast("int")


# ---------------------------------------------------------------- the hash, inside tasks

def as_words(digests: pd.Series) -> np.ndarray:
    """Hexadecimal digests as rows of four 64-bit words."""
    return np.frombuffer(bytes.fromhex("".join(digests)), dtype=np.uint64).reshape(-1, 4)


def _position(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where each key falls on a level. The level enters every word before they are summed, so
    keys whose sums agree on one level part on another."""
    with np.errstate(over="ignore"):
        mixed = (words ^ (np.uint64(level + 1) * _FACTORS[::-1])) * _FACTORS
        mixed ^= mixed >> np.uint64(31)
        h = (mixed * _FACTORS[[1, 2, 3, 0]]).sum(axis=1, dtype=np.uint64)
        h ^= h >> np.uint64(32)
        h *= _FACTORS[1]
        h ^= h >> np.uint64(29)
        h *= _FACTORS[0]
        h ^= h >> np.uint64(32)
    return (h % np.uint64(size)).astype(np.int64)


def build_levels(words: np.ndarray) -> list[bytes]:
    """Bit arrays of a minimal perfect hash. On each level a key that is alone in its
    position sets the bit there; the others go to the next level."""
    levels = []
    left = words
    while len(left):
        size = max(64, int(len(left) * _LOAD) + 7 & ~7)
        place = _position(left, len(levels), size)
        alone = np.bincount(place, minlength=size) == 1
        levels.append(np.packbits(alone).tobytes())
        left = left[~alone[place]]
    return levels


def slots_of(words: np.ndarray, levels: list[bytes]) -> np.ndarray:
    """Slot of each key: the rank of its bit; -1 where no level has one."""
    out = np.full(len(words), -1, dtype=np.int64)
    left, before = np.arange(len(words)), 0
    for depth, packed_bits in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(packed_bits, dtype=np.uint8))
        rank = np.cumsum(bits, dtype=np.int64) - 1
        place = _position(words[left], depth, len(bits))
        hit = bits[place] == 1
        out[left[hit]] = before + rank[place[hit]]
        before += int(bits.sum(dtype=np.int64))
        left = left[~hit]
    return out


def _build(group: pd.DataFrame) -> pd.DataFrame:
    words = as_words(group["text_sha256"])
    levels = build_levels(words)
    order = np.argsort(slots_of(words, levels))
    placed = group.iloc[order]
    return pd.DataFrame(
        {
            "shard": [int(group["shard"].iloc[0])],
            "levels": [levels],
            "digests": [words[order].tobytes()],
            "chars": [placed["chars"].tolist()],
            "ids": [placed["keep_id"].tolist()],
            "rows": [placed["keep_row"].tolist()],
            "counts": [placed["group_size"].tolist()],
        }
    )


def shards_for(*numbers: int) -> int:
    """How many shards keep all of these numbers of digests near ``SHARD_KEYS`` a shard."""
    return max(numbers) // SHARD_KEYS + 1


def build_index(history: DataFrame, shards: int | None = None) -> tuple[DataFrame, int]:
    """The index of ``digested`` rows: one stored row per shard, and the number of shards."""
    best = saved(best_of(history), "history")
    shards = shards or shards_for(best.count())
    return index_of(best, shards), shards


def index_of(best: DataFrame, shards: int) -> DataFrame:
    """The index of a history's best rows."""
    return saved(_dealt(best, shards).groupBy("shard").applyInPandas(_build, _SLOTS), "index")


def _dealt(best: DataFrame, shards: int) -> DataFrame:
    return best.withColumns({"shard": shard_of("text_sha256", shards), "keep_id": F.col("keep_id").cast("string")})


def _rank(row) -> tuple:
    """The order of rows of one digest (digest, chars, id, row, ...): the first stays."""
    return -row[1], row[2] is None, int(row[2] or 0), row[3]


def _lookup(_key, slots: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """All digests of a shard: each slot with what arrived for it, then the non-members."""
    columns = ["text_sha256", "chars", "keep_id", "keep_row", "group_size"]
    fresh = list(new[columns].itertuples(index=False, name=None))
    if not len(slots):
        return pd.DataFrame(fresh, columns=columns, dtype=object)
    index = slots.iloc[0]
    held = np.frombuffer(index["digests"], dtype=np.uint64).reshape(-1, 4)
    rows = [
        [h.tobytes().hex(), int(c), i, int(r), int(n)]
        for h, c, i, r, n in zip(held, index["chars"], index["ids"], index["rows"], index["counts"])
    ]
    if fresh:
        words = as_words(new["text_sha256"])
        slot = slots_of(words, list(index["levels"]))
        member = slot >= 0
        member[member] = (held[slot[member]] == words[member]).all(axis=1)
        for row, place, known in zip(fresh, slot, member):
            if not known:
                rows.append(list(row))
                continue
            old = rows[place]
            size = old[4] + row[4]
            rows[place] = [*min(old, row, key=_rank)]
            rows[place][4] = size
    return pd.DataFrame(rows, columns=columns, dtype=object)


def winners(index: DataFrame, shards: int, arrivals: DataFrame) -> DataFrame:
    """One row per distinct digest of history and arrivals together."""
    return _met(index, shards, best_of(arrivals))


def _met(index: DataFrame, shards: int, new: DataFrame) -> DataFrame:
    grouped = index.groupBy("shard").cogroup(_dealt(new, shards).groupBy("shard"))
    return grouped.applyInPandas(_lookup, _WINNERS).withColumn("keep_id", F.col("keep_id").cast("long"))


def deduplicate(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Every row of both tables (as ``digested``, row ids unique over both) with the row
    that stays for it, the size of its group and whether it is the one that stays."""
    known, new = saved(best_of(history), "history"), saved(best_of(arrivals), "arrivals")
    shards = shards_for(known.count(), new.count())
    stay = _met(index_of(known, shards), shards, new).withColumnRenamed("chars", "keep_chars")
    rows = history.unionByName(arrivals).join(stay, "text_sha256")
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
        "text_sha256", "row_id",
    )


def batches(rows: DataFrame) -> Iterator[DataFrame]:
    """History and arrivals of a table that came at once: even row numbers are the history."""
    for part in (0, 1):
        yield rows.filter(F.col("row_id") % 2 == part)
