"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: A-Z in lower case, words between the white space of ``common.SPACES``,
shingles of ``SHINGLE`` words with repeats (a shorter text is one shingle; a text without
words, null included, has fingerprint 0). A bit is set when it is set in over half of the
XXH64 values. Whole texts of any length are read, in blocks of shingles.

Search: each bit position gets a non-zero vector of radius + 1 bits, and each non-zero
vector v gives one mask: the positions whose vector has odd product with v. The vectors of
``radius`` differing positions span less than the whole space, so some v is orthogonal to
all of them, and under its mask both fingerprints agree. Every pair within the radius
therefore meets in one of the 2^(radius+1) - 1 tables, each of about half the bits.

Equal fingerprints are one row before the search. A bucket with more than ``BLOCK`` members
is dealt into blocks, and every pair of blocks becomes a cell of its own: all pairs are
still compared, each task sees at most two blocks, and a cell returns a spanning forest of
the links instead of all of them, which keeps the components. Ties and repeated rows share
their component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, keyed, saved
from motorlake.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
BLOCK = 2048
_HASHES = 65_536  # shingles hashed at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    count = len(words) - size + 1
    from_, to = starts[:count].tolist(), ends[size - 1 :].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, dtype=np.int64)
    for block in range(0, count, _HASHES):
        hashes = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(from_[block : block + _HASHES], to[block : block + _HASHES])]
        )
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big", signed=True)


def fingerprint_of(text, shingle: int = SHINGLE):
    """Column of fingerprints (long)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(text)


def as_hex(column) -> F.Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def masks(radius: int, bits: int = BITS) -> list[int]:
    """The covering masks, as signed 64-bit numbers."""
    vectors = 2 ** (radius + 1) - 1
    place = [i % vectors + 1 for i in range(bits)]
    out = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(bits) if (place[i] & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius that keep every component of these fingerprints."""
    links, left = [], members.astype(np.int64).view(np.uint64)
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = np.bitwise_count(left ^ one) <= radius
            if near.any():
                found, left = left[near], left[~near]
                links.extend((one, other) for other in found)
                front.extend(found)
    return links


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b) within the radius, enough of them to connect all that belongs together.

    ``prints`` has one row per distinct fingerprint in column ``fp``.
    """
    keys = F.array(
        *[
            F.struct(F.lit(t).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("k"))
            for t, mask in enumerate(masks(radius))
        ]
    )
    rows = prints.select("fp", F.inline(keys))
    crowded = rows.groupBy("t", "k").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    rows = rows.join(crowded, ["t", "k"], "left").withColumn(
        "g", F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    cells = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    grouped = (
        cells.select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
        .groupBy("t", "k", "i", "j")
        .agg(F.collect_list("fp").alias("members"))
        .filter(F.size("members") > 1)
        .select("members")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [pair for members in batch["members"] for pair in forest(np.asarray(members), radius)]
            yield pd.DataFrame(
                np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"]
            )

    return grouped.mapInPandas(compare, "a long, b long").distinct()


def groups(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``rows``; equal roots are one group."""
    prints = saved(rows.select("fp").distinct(), "prints")
    roots = components(links(prints, radius), "links").withColumnRenamed("node", "fp")
    return prints.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id (smallest id of the group; null without any)."""
    rows = saved(
        docs.select(F.col(key).alias("doc_id"), fingerprint_of(clean_text(text), shingle).alias("fp")), "fingerprints"
    )
    found = groups(rows, radius)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    named = saved(found.join(least, "fp"), "classes")
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = named.join(ids, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """The rows that stay: of each group the smallest id (nulls last), of equal ids one row."""
    rows = keyed(docs, "staged", fp=fingerprint_of(clean_text(f"row.{text}"), shingle))
    order = F.struct(F.col(f"row.{key}").isNull().alias("no_id"), F.col(f"row.{key}").alias("id"), "row_id")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    found = groups(rows, radius)
    stay = found.join(first, "fp").groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.row_id").alias("row_id")
    )
    return rows.join(stay, "row_id", "left_semi").select("row.*")
