"""Repeated runs of lines, found in a suffix array and deleted where they come again.

A text is a sequence of lines (split at line feeds), a line is its class among equal lines.
The suffix array comes from prefix doubling: ``rank`` k orders all suffixes by their first
2^k lines, and rank k + 1 follows from the pair of ranks at s and s + 2^k. Suffixes whose
prefix occurs once leave, so a round is as large as what still repeats, and the rounds end
with the longest repeated run. Suffixes of equal rank are an interval of the array whose
common prefix has at least 2^k lines.

For every suffix the longest prefix that occurs earlier is found by going down these
intervals from the longest: an interval is named by its first member (in the order of ids,
null ids last, then stored rows, then lines) and its length. The first member of an
interval one step longer either went the same way or is the first member of the present
one, so each step needs the rows that go this way and one more per interval.

A run is such a prefix with ``MIN_WORDS`` words or more; all its lines are deleted, the
first copy stays. Only grouped minima and equi-joins on (text, line) or interval are used.
Repeats inside one text count, overlapping ones too. Null text stays null and has no lines;
an empty text is one line without words. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.functions.rows import as_stored
from motorlake.llm.common import WORD, keyed, numbered, saved

MIN_WORDS = 25


def line_table(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Lines that occur more than once: d, p, words, r (rank by the line itself).

    d numbers the texts in the order in which copies count as earlier, p the lines.
    """
    lines = rows.filter(F.col(f"row.{text}").isNotNull()).select(
        "row_id", F.col(f"row.{key}").alias("key"),
        F.posexplode(F.split(F.col(f"row.{text}").cast("string"), "\n", -1)).alias("p", "line"),
    ).select(
        "row_id", "key", F.col("p").cast("long").alias("p"),
        F.regexp_count("line", F.lit(WORD)).cast("long").alias("words"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"),
    )
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1")
    ranks = numbered(repeated.select("h1", "h2"), ["h1", "h2"], "line-ranks", "r")
    found = saved(lines.join(ranks, ["h1", "h2"]).drop("h1", "h2"), "lines")
    texts = found.groupBy("row_id").agg(F.first("key").alias("key")).withColumn("no_key", F.col("key").isNull())
    order = numbered(texts, ["no_key", "key", "row_id"], "texts", "d").select("row_id", "d")
    return saved(found.join(order, "row_id").select("row_id", "d", "p", "words", "r"), "lines")


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """Rank k of every suffix whose first 2^k lines occur more than once: tables (d, p, r)."""
    levels = [lines.select("d", "p", "r")]
    while True:
        step = 2 ** (len(levels) - 1)
        now = levels[-1]
        second = now.select("d", (F.col("p") - step).alias("p"), F.col("r").alias("b"))
        pairs = now.withColumnRenamed("r", "a").join(second, ["d", "p"])
        repeated = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
        ranks = numbered(repeated.select("a", "b"), ["a", "b"], "ranks", "r")
        level = saved(pairs.join(ranks, ["a", "b"]).select("d", "p", "r"), "suffixes")
        if level.isEmpty():
            return levels
        levels.append(level)


def earlier_prefixes(levels: list[DataFrame]) -> DataFrame:
    """(d, p, length): lines of the longest prefix of each suffix that occurs earlier."""
    state = levels[0].select("d", "p", F.lit(0).cast("long").alias("length"),
                             F.lit(-1).cast("long").alias("fd"), F.lit(-1).cast("long").alias("fp"))
    interval = ["length", "fd", "fp", "r"]
    for k in reversed(range(len(levels))):
        ranks = levels[k].select(F.col("d").alias("rd"), F.col("p").alias("rp"), "r")
        here = (F.col("d") == F.col("rd")) & (F.col("p") + F.col("length") == F.col("rp"))
        going = state.join(ranks, here, "left").drop("rd", "rp")
        firsts = state.filter("length > 0").select("length", "fd", "fp").distinct()
        there = (F.col("fd") == F.col("rd")) & (F.col("fp") + F.col("length") == F.col("rp"))
        first_rows = firsts.join(ranks, there).select(*interval, F.col("fd").alias("d"), F.col("fp").alias("p"))
        members = going.filter("r is not null").select(*interval, "d", "p").unionByName(first_rows)
        best = members.groupBy(*interval).agg(F.min(F.struct("d", "p")).alias("best"), F.count("*").alias("n"))
        # Stored, not joined where it was grouped: Spark can then split a common interval.
        best = saved(best.filter("n > 1").drop("n"), "intervals")
        longer = going.join(best, interval, "left")
        late = F.coalesce(F.col("best") < F.struct("d", "p"), F.lit(False))
        state = saved(
            longer.select(
                "d", "p",
                F.when(late, F.col("length") + 2**k).otherwise(F.col("length")).alias("length"),
                F.when(late, F.col("best.d")).otherwise(F.col("fd")).alias("fd"),
                F.when(late, F.col("best.p")).otherwise(F.col("fp")).alias("fp"),
            ),
            "prefixes",
        )
    return state.select("d", "p", "length")


def repeated_lines(rows: DataFrame, key: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(row_id, p) of every line that belongs to a run which came earlier."""
    lines = line_table(rows, key, text)
    runs = earlier_prefixes(suffix_ranks(lines)).filter("length > 0")
    in_text = Window.partitionBy("d").orderBy("p")
    summed = saved(lines.select("row_id", "d", "p", "words", F.sum("words").over(in_text).alias("upto")), "words")
    ends = summed.select("d", F.col("p").alias("last"), F.col("upto").alias("end_upto"))
    long_runs = (
        runs.withColumn("last", F.col("p") + F.col("length") - 1)
        .join(ends, ["d", "last"])
        .join(summed.select("d", "p", "words", "upto"), ["d", "p"])
        .filter(F.col("end_upto") - F.col("upto") + F.col("words") >= min_words)
        .select("d", "p", "last")
    )
    # A run reaches the lines up to its last; of the runs begun so far the farthest counts.
    reached = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return summed.select("row_id", "d", "p").join(long_runs, ["d", "p"], "left").withColumn(
        "reached", reached
    ).filter("reached >= p").select("row_id", "p")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The documents as (row, lines, removed, text): the text without the lines of later
    copies. All rows come back; ``row`` is the row as it was."""
    rows = keyed(docs, "staged")
    gone = repeated_lines(rows, key, text, min_words).groupBy("row_id").agg(
        F.collect_list(F.col("p").cast("int")).alias("gone")
    )
    split = as_stored(
        rows.join(gone, "row_id", "left").select(
            "row", F.split(F.col(f"row.{text}").cast("string"), "\n", -1).alias("parts"), "gone"
        )
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")
    rest = F.array_join(F.transform(kept, lambda i: F.col("parts")[i]), "\n")
    return split.select(
        "row",
        F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.size("parts")).cast("long").alias("lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed"),
        F.when(F.col("gone").isNull(), F.col(f"row.{text}").cast("string")).otherwise(rest).alias("text"),
    )
