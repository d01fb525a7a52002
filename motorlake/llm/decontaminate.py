"""Documents that hold a benchmark item, found by SimHash over item-sized windows.

Words are runs of letters, digits and underscores in lower case, so that punctuation and
case do not hide a copy. A window has as many words as the item it is held against, starts
at every word, and is the whole document where that is shorter. Window and item are sets of
five-word shingles weighted by how often they occur (a shorter item is one shingle of all
its words).

For every item length the windows get SimHash fingerprints of 64 bits, from running sums of
shingle bits. Candidates come from a multi-index: the fingerprint is cut into ``BLOCKS``
blocks; two fingerprints within ``RADIUS`` bits differ in at most RADIUS // BLOCKS bits of
some block, and each block's table holds every value that near to an item's. A candidate
within the radius is verified by the exact weighted Jaccard similarity of the shingles, and
counts from ``SIMILARITY`` on. Similarity 0.8 leaves about ten differing bits with a
deviation of three; the radius lies over four deviations beyond.

A window without any shingle of an item has similarity 0 to it, so windows are only formed
where a document holds one, and held against the items that have it; nothing is lost by that.
The documents are read once for a benchmark of any size: each keeps the hashes of its shingles
that a filter of ``FILTER_BITS`` bits lets pass (all shingles of items do), and the others
leave. What is left is joined with the items' shingles and sent to the blocks of items, of
about ``ITEM_CHARS`` characters, that share one with it. A task holds one block and reads
documents in a stream; a block that many documents meet is dealt to many tasks. A null or empty
text or item matches nothing, repeated items match each for itself, and an empty table gives
an empty result.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, keyed, saved

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
ITEM_CHARS = 4 << 20
FILTER_BITS = 1 << 26  # a power of two, 2**16 at least
DOC_CHARS = 8 << 20  # of the documents a task holds against one block of items
_ITEM_COST = 512  # characters an item counts as beside its own, for its tables
_HASHED = 400_000  # words whose hashes a task remembers
_PAIRS = 1 << 20  # pairs of window and item compared at once
_WIDTH = 64 // BLOCKS
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOWS = 8192  # windows compared at once
_WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def shingles(words: list[str], size: int) -> list[str]:
    return [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / max(1, sum(max(a[k], b[k]) for k in keys))


def shingle_bits(parts: list[str]) -> np.ndarray:
    """A row of 64 bits for each shingle."""
    hashes = b"".join([xxhash.xxh64_digest(p.encode(), 0) for p in parts])
    return np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)


class WordHashes(dict):
    """64-bit hashes of words, remembered by word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _HASHED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode(), 0)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def codes_of(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash for each run of ``length`` words."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    code = np.full(count, length, dtype=np.uint64)
    for shift in range(length):
        code += hashes[shift : shift + count]
        code *= _BASE
        code ^= code >> np.uint64(31)
    return code


def _prints(sums: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints as rows of eight bytes out of sums of bits over ``size`` shingles."""
    return np.packbits(sums * 2 > size, axis=1)


def near_values(value: int, bits: int, width: int = _WIDTH) -> list[int]:
    """All block values that differ from this one in at most ``bits`` bits."""
    return [
        value ^ sum(1 << i for i in flips)
        for count in range(bits + 1)
        for flips in combinations(range(width), count)
    ]


class Items:
    """The multi-index over the items of one block."""

    def __init__(self, rows: list[tuple[str, str]], radius: int, threshold: float):
        self.radius, self.threshold = radius, threshold
        self.ids, self.words, self.bags = [], [], []
        self.hashes = WordHashes()
        by_size: dict[int, list[int]] = defaultdict(list)
        self.row: list[int] = []  # of each item among those of its size
        # Items by the codes of their shingles, by shingle length: what a window must share.
        self.codes: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            number, length = len(self.ids), min(SHINGLE, len(words))
            self.row.append(len(by_size[len(words)]))
            by_size[len(words)].append(number)
            self.ids.append(item_id)
            self.words.append(words)
            self.bags.append(Counter(shingles(words, length)))
            for code in np.unique(codes_of(self.hashes.of(words), length)).tolist():
                self.codes[length][code].append(number)
        self.sizes = {size: self._tables(size, members) for size, members in by_size.items()}
        self.gates = {n: np.array(sorted(codes), dtype=np.uint64) for n, codes in self.codes.items()}

    def _tables(self, size: int, members: list[int]):
        """Members of one size, their fingerprints, and whether a member is near a value of a
        block: a table with all values of every block."""
        length = min(SHINGLE, size)
        bits = [shingle_bits(shingles(self.words[m], length)).sum(axis=0, dtype=np.int64) for m in members]
        prints = _prints(np.array(bits), size - length + 1)
        tables = np.zeros((BLOCKS, 1 << _WIDTH, len(members)), dtype=bool)
        for row, blocks in enumerate(prints):
            for table, value in zip(tables, blocks.tolist()):
                table[near_values(value, self.radius // BLOCKS), row] = True
        return np.array(members), prints.view(np.uint64).ravel(), tables

    def search(self, text: str) -> list[tuple]:
        """(item, similarity, distance, start, words): the best window of every item this
        text holds."""
        words = words_of(text)
        hashes = self.hashes.of(words)
        places: dict[int, list[int]] = defaultdict(list)  # item size -> places of its shingles
        sharing: dict[int, set[int]] = defaultdict(set)  # item size -> items with one of them
        for length, gate in self.gates.items():
            # A text shorter than its items' shingles cannot hold one.
            codes = codes_of(hashes, length)
            near = np.minimum(np.searchsorted(gate, codes), len(gate) - 1)
            hit = np.flatnonzero(gate[near] == codes)
            at: dict[int, list[int]] = defaultdict(list)
            for place, code in zip(hit.tolist(), codes[hit].tolist()):
                at[code].append(place)
            for code, found in at.items():
                members = self.codes[length][code]
                sizes = {len(self.words[item]) for item in members}
                for size in sizes:
                    places[size] += found
                for item in members:
                    sharing[len(self.words[item])].add(self.row[item])
        best: dict[int, tuple] = {}
        for size, found in places.items():
            self._windows(words, size, found, np.array(sorted(sharing[size])), best)
        return [(self.ids[item], *best[item]) for item in sorted(best)]

    def _windows(self, words, size: int, places: list[int], rows: np.ndarray, best: dict[int, tuple]) -> None:
        length, span = min(SHINGLE, size), min(size, len(words))
        count = span - length + 1  # shingles of a window
        last = len(words) - span
        places = np.array(places, dtype=np.int64)
        lead = np.maximum(places - count + 1, 0)  # first window over each place
        over = np.bincount(lead[lead <= last], minlength=last + 2)
        over -= np.bincount(np.minimum(places, last)[lead <= last] + 1, minlength=last + 2)
        starts = np.flatnonzero(np.cumsum(over) > 0)
        for block in np.split(starts, range(_WINDOWS, len(starts), _WINDOWS)):
            if not len(block):
                continue
            # Running sums restart at every gap, so a few places in a long text stay cheap.
            for run in np.split(block, np.flatnonzero(np.diff(block) > count) + 1):
                first = int(run[0])
                bits = shingle_bits(shingles(words[first : int(run[-1]) + span], length))
                sums = np.zeros((len(bits) + 1, 64), dtype=np.int64)
                np.cumsum(bits, axis=0, out=sums[1:])
                at = run - first
                prints = _prints(sums[at + count] - sums[at], count)
                step = max(1, _PAIRS // len(rows))
                for a in range(0, len(run), step):
                    self._compare(words, size, span, run[a : a + step], prints[a : a + step], rows, best)

    def _compare(self, words, size, span, starts, prints, rows, best) -> None:
        members, items, tables = self.sizes[size]
        found = np.zeros((len(starts), len(rows)), dtype=bool)
        for table, values in zip(tables, prints.T):
            found |= table[:, rows][values]
        distance = np.bitwise_count(prints.view(np.uint64).reshape(-1, 1) ^ items[rows][None, :])
        length, bags = min(SHINGLE, size), {}
        for at, row in np.argwhere(found & (distance <= self.radius)).tolist():
            start, item = int(starts[at]), int(members[rows[row]])
            if at not in bags:
                bags = {at: Counter(shingles(words[start : start + span], length))}
            alike = similarity(bags[at], self.bags[item])
            if alike >= self.threshold and (item not in best or alike > best[item][0]):
                best[item] = alike, int(distance[at, row]), start, span


# ---------------------------------------------------------------- on tables

class Benchmark:
    """The stored items, each in a block small enough for a task, the codes of their shingles
    and the filter that all of those pass."""

    def __init__(self, benchmark: DataFrame, chars: int):
        rows = benchmark.select(F.col("item_id").cast("long").cast("string").alias("id"), clean_text("text").alias("text"))
        total = rows.agg(F.sum(F.length("text") + _ITEM_COST)).first()[0] or 0
        block = F.pmod(F.xxhash64("id", "text"), F.lit(total // chars + 1)).cast("int")
        self.items = saved(rows.withColumn("block", block), "leak-items")
        self.codes = saved(self.items.mapInPandas(_item_codes, "length int, code long, block int").distinct(), "leak-codes")
        self.lengths = sorted(r.length for r in self.codes.select("length").distinct().collect())  # 5 at most
        low, high = (F.col("code").bitwiseAND(F.lit(FILTER_BITS - 1)),
                     F.shiftrightunsigned("code", 32).bitwiseAND(F.lit(FILTER_BITS - 1)))
        place = self.codes.select(F.explode(F.array(low, high)).alias("place")).select((F.col("place") + 1).alias("place"))
        marked = place.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        self.filter = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for r in marked.collect():  # never more than the filter's own size
            part = np.frombuffer(r.bits, dtype=np.uint8)
            self.filter[(r.part - 1) * len(part) : r.part * len(part)] = part

    def candidates(self, spark):
        """A function of texts: the codes of their shingles that pass the filter."""
        lengths, shipped = self.lengths, spark.sparkContext.broadcast(self.filter)

        @F.pandas_udf("array<long>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            hashes, bits, mask = WordHashes(), shipped.value, np.uint64(FILTER_BITS - 1)

            def passes(place: np.ndarray) -> np.ndarray:
                return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

            def found(text: str) -> np.ndarray:
                values, out = hashes.of(words_of(text)), []
                for length in lengths:
                    code = codes_of(values, length)
                    code = code[passes(code & mask)]
                    out.append(np.unique(code[passes((code >> np.uint64(32)) & mask)]).view(np.int64))
                return np.concatenate(out) if out else np.empty(0, dtype=np.int64)

            for texts in batches:
                yield pd.Series(list(map(found, texts)), dtype=object)

        return run.asNondeterministic()  # run once, not again in each filter on its result

    def matches(self, docs: DataFrame, radius: int, threshold: float) -> DataFrame:
        """(row_id, item_id, similarity, distance, start, words) out of the stored rows
        (row_id, text, codes)."""
        shared = docs.select("row_id", F.length("text").alias("chars"), F.explode("codes").alias("code")).join(
            self.codes.select("code", "block"), "code")
        pairs = saved(shared.select("row_id", "chars", "block").distinct(), "leak-pairs")
        tasks = pairs.groupBy("block").agg((F.floor(F.sum("chars") / DOC_CHARS) + 1).cast("int").alias("tasks"))
        items = self.items.join(tasks, "block").select(
            "block", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"), "id", "text")
        rows = pairs.select("row_id", "block").join(tasks, "block").join(docs.select("row_id", "text"), "row_id").select(
            "block", F.pmod(F.xxhash64("row_id"), "tasks").cast("int").alias("task"), F.lit(1).alias("kind"),
            F.col("row_id").cast("string").alias("id"), "text")
        dealt = items.unionByName(rows).repartition("block", "task").sortWithinPartitions("block", "task", "kind")
        found = dealt.mapInPandas(
            functools.partial(_search, radius=radius, threshold=threshold),
            "row_id string, item_id string, similarity double, distance int, start long, words long")
        return found.withColumns({"row_id": F.col("row_id").cast("long"), "item_id": F.col("item_id").cast("long")})


def _item_codes(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for frame in batches:
        for block, text in zip(frame["block"], frame["text"]):
            words = words_of(text)
            if words:
                length = min(SHINGLE, len(words))
                codes = np.unique(codes_of(hashes.of(words), length)).view(np.int64)
                yield pd.DataFrame({"length": length, "code": codes, "block": block})


def _search(batches: Iterable[pd.DataFrame], radius: int, threshold: float) -> Iterator[pd.DataFrame]:
    """Items of a block come first, then the documents to hold against them."""
    held, items, index = None, [], None
    for frame in batches:
        out = []
        for block, kind, name, text in zip(frame["block"], frame["kind"], frame["id"], frame["text"]):
            if block != held:
                held, items, index = block, [], None
            if kind == 0:
                if index is None:  # else the next task's copy of the same items
                    items.append((name, text))
                continue
            index = index or Items(items, radius, threshold)
            out += [(name, *match) for match in index.search(text)]
        yield pd.DataFrame(out, columns=["row_id", "item_id", "similarity", "distance", "start", "words"])


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS,
            threshold: float = SIMILARITY, chars: int = ITEM_CHARS) -> DataFrame:
    """(doc_id, item_id, similarity, distance, start, words) for each item a document holds:
    its best window, the first of equals. Documents without any have no row."""
    index = Benchmark(benchmark, chars)
    rows = docs.select(F.col(key).alias("doc_id"), clean_text(text).alias("text"))
    hits = rows.withColumn("codes", index.candidates(docs.sparkSession)("text")).filter(F.size("codes") > 0)
    hits = saved(hits.withColumn("row_id", F.monotonically_increasing_id()), "leak-rows")
    return index.matches(hits, radius, threshold).join(hits.select("row_id", "doc_id"), "row_id").select(
        "doc_id", "item_id", "similarity", "distance", "start", "words")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", radius: int = RADIUS,
          threshold: float = SIMILARITY, chars: int = ITEM_CHARS) -> DataFrame:
    """The documents that hold no item, with all their columns. Only documents that share a
    shingle with an item are shuffled."""
    index = Benchmark(benchmark, chars)
    rows = keyed(docs, "leak-rows", codes=index.candidates(docs.sparkSession)(clean_text(f"row.{text}")))
    shares = F.size("codes") > 0
    hits = rows.filter(shares).select("row_id", clean_text(f"row.{text}").alias("text"), "codes")
    found = index.matches(hits, radius, threshold).select("row_id")
    kept = rows.filter(shares).join(found, "row_id", "left_anti").select("row")
    return rows.filter(~shares).select("row").unionByName(kept).select("row.*")
