"""Best-fit packing of documents into sequences by swap-based local search.

A document's ids and an end are cut into pieces of ``LENGTH`` only where they are longer; a
full piece is a sequence. The other pieces are dealt by hash into groups of about ``GROUP``,
and each group is packed by a task: best fit, longest first, then local search between the
underfull bins. The emptiest bin gives: a document moves, or one is exchanged for one, two
for one, or one for two, with the bin where the sum of squared fills grows most, until the
bin is empty, or the next one has its turn. Every exchange raises that sum, so the search
ends; it also ends when the group needs no more bins than its total length does, or after
``PATIENCE`` bins in a row that could not be emptied.

Bins left with more than ``SLACK`` free are undone, and their pieces are dealt and packed
again across the groups, in rounds that get smaller, until one group holds them all or a
round leaves more than half of its pieces open (then lengths, not chance, keep bins open).

Null text counts as empty: its only id is the end. Rows that share an id, or have none, are
packed like any other. Any type of id is kept. An empty table gives no sequence. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm import word_tokens
from motorlake.llm.common import clean_text, saved

LENGTH = 2048
END = 0
GROUP = 2048
PATIENCE = 512
SLACK = LENGTH // 64
_PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long, ids binary"
_PLACES = "row_id long, length long, sequence_id long, offset long, free long"


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
           vocabulary: str | None = None) -> DataFrame:
    """Stored rows (row_id, doc_id, piece, start, length, ids_crc32, ids).

    ``ids`` are little-endian numbers of 16 bits, or 32 for a vocabulary beyond 65,536 ids;
    the checksum is always of 32-bit ids.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(word_tokens.read_vocabulary(vocabulary))
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = word_tokens.words_of(shipped.value)
        for batch in batches:
            for some in range(0, len(batch), 2048):
                part, rows = batch.iloc[some : some + 2048], []
                for doc_id, found in zip(part["doc_id"], encode(part["text"].tolist())):
                    ids = np.append(found, encode.kind.type(END))
                    for number, start in enumerate(range(0, len(ids), length)):
                        own = ids[start : start + length]
                        rows.append((doc_id, number, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), own.tobytes()))
                yield pd.DataFrame(rows, columns=names)

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), clean_text(F.col(f"`{text}`")).alias("text"))
    cutted = rows.mapInPandas(cut, _PIECES).withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))
    return saved(cutted.withColumn("row_id", F.monotonically_increasing_id()), "pieces")


# ---------------------------------------------------------------- one group, inside a task

def best_fit(lengths: list[int], cap: int) -> list[list[int]]:
    """Bins of item numbers: the longest item first, each into the fullest bin that holds it."""
    free_now: list[list[int]] = [[] for _ in range(cap + 1)]  # bins by free space
    present = 0  # bit f: some bin has f free
    bins: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        if fitting := present >> size:
            free = (fitting & -fitting).bit_length() - 1 + size
            number = free_now[free].pop()
            if not free_now[free]:
                present ^= 1 << free
        else:
            number, free = len(bins), cap
            bins.append([])
        bins[number].append(item)
        free_now[free - size].append(number)
        present |= 1 << (free - size)
    return bins


class Search:
    """Local search between the underfull bins of a group."""

    def __init__(self, lengths: list[int], bins: list[list[int]], cap: int):
        self.lengths, self.cap = lengths, cap
        self.bins = dict(enumerate(bins))
        self.fill = {b: sum(lengths[i] for i in items) for b, items in self.bins.items()}
        self.least = -(-sum(lengths) // cap)
        self.units: dict[int, np.ndarray] = {}

    def offers(self, b: int) -> np.ndarray:
        """What a bin can give: rows (total, first, second), 0 for nothing; equal lengths count once."""
        if b not in self.units:
            counts = Counter(self.lengths[i] for i in self.bins[b])
            own = sorted(counts)
            rows = [(0, 0, 0)] + [(x, x, 0) for x in own]
            rows += [(x + y, x, y) for k, x in enumerate(own) for y in own[k:] if x != y or counts[x] > 1]
            self.units[b] = np.array(rows, dtype=np.int64)
        return self.units[b]

    def exchange(self, giver: int) -> bool:
        """The exchange with the greatest gain in squared fill; False if none has a gain."""
        others = [b for b, f in self.fill.items() if f < self.cap and b != giver]
        if not others:
            return False
        blocks = [self.offers(b) for b in others]
        taken = np.concatenate(blocks)
        owner = np.repeat(np.arange(len(others)), [len(x) for x in blocks])
        fill = np.array([self.fill[b] for b in others], dtype=np.int64)[owner]
        best, chosen = 0, None
        for total, first, second in self.offers(giver)[1:].tolist():
            more = total - taken[:, 0]
            fits = (more > 0) & (more <= self.cap - fill)
            if second:  # two of the giver go for one at most
                fits &= taken[:, 2] == 0
            gain = np.where(fits, more * (fill + more - self.fill[giver]), 0)
            at = int(gain.argmax())
            if gain[at] > best:
                best, chosen = int(gain[at]), (others[owner[at]], (first, second), taken[at, 1:].tolist())
        if chosen is None:
            return False
        taker, out, back = chosen
        self._pass(giver, taker, out)
        self._pass(taker, giver, back)
        if not self.bins[giver]:
            del self.bins[giver], self.fill[giver]
        return True

    def _pass(self, source: int, target: int, sizes) -> None:
        for size in filter(None, sizes):
            item = next(i for i in self.bins[source] if self.lengths[i] == size)
            self.bins[source].remove(item)
            self.bins[target].append(item)
            self.fill[source] -= size
            self.fill[target] += size
        self.units.pop(source, None)
        self.units.pop(target, None)

    def run(self, patience: int = PATIENCE) -> list[list[int]]:
        """The bins after the search."""
        failed: set[int] = set()
        while len(self.bins) > self.least and len(failed) < patience:
            open_bins = [b for b, f in self.fill.items() if f < self.cap and b not in failed]
            if not open_bins:
                break
            giver = min(open_bins, key=self.fill.__getitem__)
            while giver in self.bins and self.exchange(giver):
                pass
            if giver in self.bins:
                failed.add(giver)
            else:
                failed.clear()
        return list(self.bins.values())


def pack_group(lengths: list[int], cap: int = LENGTH, patience: int = PATIENCE) -> list[list[int]]:
    return Search(lengths, best_fit(lengths, cap), cap).run(patience)


def _group(cap: int, patience: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row_id"], ascending=[False, True])
        ids, lengths = group["row_id"].tolist(), group["length"].tolist()
        rows = []
        for items in pack_group(lengths, cap, patience):
            name, at = min(ids[i] for i in items), 0
            free = cap - sum(lengths[i] for i in items)
            for i in items:
                rows.append((ids[i], lengths[i], name, at, free))
                at += lengths[i]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _PLACES.split(", ")])

    return pack


# ---------------------------------------------------------------- all groups

def places(parts: DataFrame, cap: int = LENGTH, group: int = GROUP, slack: int = SLACK,
           patience: int = PATIENCE) -> DataFrame:
    """(row_id, sequence_id, offset) of all pieces (row_id, length) shorter than a sequence.

    A sequence is named by the smallest row id in it. Only counts reach the driver.
    """
    left, settled, turn = parts.filter(F.col("length") < cap).select("row_id", "length"), None, 0
    number = left.count()
    while True:
        groups = max(1, number // group)
        dealt = left.withColumn("deal", F.pmod(F.xxhash64("row_id", F.lit(turn)), F.lit(groups)))
        packed = saved(dealt.groupBy("deal").applyInPandas(_group(cap, patience), _PLACES), "packed")
        left = packed.filter(F.col("free") > slack)
        open_now = left.count() if groups > 1 else 0
        again = 0 < open_now <= number / 2
        done = packed.filter(F.col("free") <= slack) if again else packed
        settled = done if settled is None else settled.unionByName(done)
        if not again:
            return settled.select("row_id", "sequence_id", "offset")
        left, number, turn = left.select("row_id", "length"), open_now, turn + 1


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         vocabulary: str | None = None, group: int = GROUP) -> DataFrame:
    """One row per piece: row_id, doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset."""
    parts = pieces(docs, key, text, length, vocabulary)
    found = places(parts, length, group, length // 64)
    return parts.join(found, "row_id", "left").withColumns({
        "sequence_id": F.coalesce("sequence_id", "row_id"), "offset": F.coalesce("offset", F.lit(0).cast("long")),
    })


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, lengths, ids): the ids of each sequence, its pieces in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(bytearray()), lambda so_far, part: F.concat(so_far, part.ids))
    return rows.select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.length").alias("lengths"),
                       joined.alias("ids"))
