"""Keyed writes, resume lists and run summaries.

Conflict rules are aggregates, never windows: the greatest or least (order, row) combines
on the map side, so a key that holds a large share of the rows reaches the reducer as one
row per task. A row whose order is null counts only where its key has no other; rows of
equal order are told apart by their values, so the result does not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake import schemas
from motorlake.functions.text import strip


# ---------------------------------------------------------------- conflict rules

def _resolve(rows: DataFrame, keys: Sequence[str], pick, order: Sequence[Column]) -> DataFrame:
    others = [c for c in rows.columns if c not in keys]
    keyed = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    ranked = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], F.struct(*others).alias("_row"))
    chosen = keyed.groupBy(*keys).agg(pick(ranked).alias("_best"))
    return chosen.select(*keys, "_best._row.*").select(*rows.columns)


def last_wins(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One whole row per key: the one with the greatest ``order``. Null keys drop out."""
    return _resolve(rows, keys, F.max, [part for c in order for part in (c.isNotNull(), c)])


def first_wins(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One whole row per key: the one with the least ``order``. Null keys drop out."""
    return _resolve(rows, keys, F.min, [part for c in order for part in (c.isNull(), c)])


def upsert_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], position: str
) -> DataFrame:
    """Replace whole rows of ``target`` by key with the last row of ``batch``.

    ``position`` orders rows inside the batch; ``target`` holds each key once. Only the
    batch is aggregated. Spark broadcasts its keys while they are small, and the target
    then passes through without a shuffle; a larger batch joins by key.
    """
    newest = last_wins(batch, keys, F.col(position))
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


def upsert_latest_items(
    target: DataFrame, batch: DataFrame, position: str = "ingest_seq"
) -> DataFrame:
    return upsert_latest(target, batch, ["id"], position)


def upsert_latest_cars(
    target: DataFrame, batch: DataFrame, position: str, now: Column | None = None
) -> DataFrame:
    """Like items; a replaced car gets a new ``scraped_at``."""
    return upsert_latest(target, default_timestamp(batch, now=now), ["id"], position)


def default_timestamp(
    rows: DataFrame, column: str = "scraped_at", now: Column | None = None
) -> DataFrame:
    return rows.withColumn(column, F.current_timestamp() if now is None else now)


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Rows of ``batch`` to append: the first per key whose key the target lacks.

    The target is first cut down to the keys of the batch, which needs no shuffle of the
    target as long as Spark can broadcast those keys. The batch is read more than once:
    store it first if it is dear to compute.
    """
    fresh = first_wins(batch, keys, F.col(order))
    taken = target.select(*keys).join(fresh.select(*keys), list(keys), "left_semi")
    return fresh.join(taken, list(keys), "left_anti")


def insert_ignore_tags(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target after the insert; the first value of (car, attribute) stays."""
    return target.unionByName(insert_ignore(target, batch, ["car_id", "attribute"], "seq"))


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _publish(rows: DataFrame, path: str, version: int) -> None:
    """Write whole buckets as a new version, then say so in the table of versions.

    Rebalancing puts a bucket into one task, and splits one that grew too large. Readers see
    a version once its one small file of bucket numbers is there; a run lost before that
    leaves the table as it was, and the next one overwrites what it left.
    """
    data = f"{path}/data/version={version}"
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
    written = rows.sparkSession.read.parquet(data).select("bucket").distinct()
    written.withColumn("version", F.lit(version)).coalesce(1).write.mode("append").parquet(f"{path}/versions")


def _newest(spark, path: str, before: int | None = None) -> list:
    """(bucket, version) of every bucket, as it is or was before a version: as many rows as
    the table has buckets."""
    versions = spark.read.schema("bucket int, version int").parquet(f"{path}/versions")
    if before is not None:
        versions = versions.where(F.col("version") < before)
    return versions.groupBy("bucket").agg(F.max("version").alias("version")).collect()


def _buckets_at(spark, path: str, newest: list) -> DataFrame:
    by_version: dict[int, list[int]] = {}
    for bucket, version in newest:
        by_version.setdefault(version, []).append(bucket)
    chosen = F.lit(False)
    for version, buckets in sorted(by_version.items()):
        chosen = chosen | ((F.col("version") == version) & F.col("bucket").isin(buckets))
    return spark.read.parquet(f"{path}/data").where(chosen)


def bucket_table(spark, path: str) -> DataFrame:
    """The rows of a table stored in buckets: the newest version of each bucket. Only the
    folders of those versions are read."""
    return _buckets_at(spark, path, _newest(spark, path)).drop("version", "bucket")


def touched_rows(
    spark, path: str, batch: DataFrame, keys: Sequence[str], buckets: int, before: int | None = None
) -> DataFrame:
    """The rows of the buckets that the keys of a batch fall in; no other bucket is read."""
    touched = {r.bucket for r in _bucketed(batch, keys, buckets).select("bucket").distinct().collect()}
    newest = [(b, v) for b, v in _newest(spark, path, before) if b in touched]
    return _buckets_at(spark, path, newest).drop("version", "bucket")


def store_in_buckets(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a keyed table in folders by a hash of its key, for ``upsert_in_place``.

    Keep the bucket count for the life of the table; a bucket of about 1 GB is a good size.
    """
    _publish(_bucketed(rows, keys, buckets), path, 0)


def upsert_in_place(
    path: str, batch: DataFrame, keys: Sequence[str], position: str, buckets: int, number: int | None = None
) -> None:
    """``upsert_latest`` on a stored table, at the cost of the buckets the batch touches.

    A batch with a ``number`` (1 after the first write, then 2, ...) becomes the version of
    that number and starts from the versions below it.

    Those buckets are written anew beside the old ones, which readers go on using until the
    new version is published. Running the same batch again gives the same table. The batch
    is read more than once: store it first if it is dear to compute.
    """
    spark = batch.sparkSession
    newest = _newest(spark, path, number)
    stored = _buckets_at(spark, path, newest).drop("version")
    latest = _bucketed(last_wins(batch, keys, F.col(position)), keys, buckets)
    touched = stored.join(latest.select("bucket").distinct(), "bucket", "left_semi")
    merged = upsert_latest(touched.select(*stored.columns), latest, keys, position)
    if number is None:
        number = max([version for _, version in newest], default=-1) + 1
    _publish(merged, path, number)


def null_key_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What the conflict rules leave out, for the quarantine table."""
    return rows.where(" OR ".join(f"`{k}` IS NULL" for k in keys))


def union_batches(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for batch in rest:
        first = first.unionByName(batch)
    return first


# ---------------------------------------------------------------- resume

def _membership(cars: DataFrame, tags: DataFrame) -> DataFrame:
    """(id, in_cars, in_tags), one row per id seen on either side.

    A union and one hash aggregate instead of a join: both sides shrink to one row per
    id and task before the shuffle, whatever their skew.
    """
    seen = cars.select("id", F.lit(1).alias("c"), F.lit(0).alias("t")).unionByName(
        tags.select(F.col("car_id").alias("id"), F.lit(0).alias("c"), F.lit(1).alias("t"))
    )
    return (
        seen.where("id IS NOT NULL")
        .groupBy("id")
        .agg(F.max("c").alias("in_cars"), F.max("t").alias("in_tags"))
    )


def pending_ids(cars: DataFrame, tags: DataFrame) -> DataFrame:
    """Cars no tag was ever written for."""
    return _membership(cars, tags).where("in_cars = 1 AND in_tags = 0").select("id")


def pending_counts(cars: DataFrame, tags: DataFrame) -> DataFrame:
    return _membership(cars, tags).agg(
        F.coalesce(F.sum("in_cars"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("in_tags"), F.lit(0)).alias("done"),
        F.count_if((F.col("in_cars") == 1) & (F.col("in_tags") == 0)).alias("pending"),
    )


def set_difference_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def distinct_car_ids(tags: DataFrame) -> DataFrame:
    return tags.select("car_id").distinct()


# ---------------------------------------------------------------- outcomes, bad rows

def page_outcome(status: Column, has_table: Column) -> Column:
    return (
        F.when(status == 404, "gone")
        .when(status.isNull() | (status != 200), "retry")
        .when(~F.coalesce(has_table, F.lit(False)), "no_table")
        .otherwise("ok")
    )


def outcome_summary(pages: DataFrame, status: str = "status", has_table: str = "has_table") -> DataFrame:
    outcome = page_outcome(F.col(status), F.col(has_table)).alias("outcome")
    return pages.groupBy(outcome).agg(F.count("*").alias("n"))


# A plain decimal number; Spark's cast alone would also take ``NaN``, ``Infinity``, ``1d``.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def _number(text: Column) -> Column:
    bare = strip(text)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def coerce_cars(raw: DataFrame) -> DataFrame:
    """Typed cars from raw text, with the reason a row is unusable in ``error``."""
    price = _number(F.col("price"))
    number = _number(F.col("year"))
    year = F.when(number == F.floor(number), number.try_cast("int"))
    error = (
        F.when(F.col("id").isNull(), "id")
        .when(F.col("price").isNotNull() & price.isNull(), "price")
        .when(F.col("year").isNotNull() & year.isNull(), "year")
    )
    return raw.select(
        *[c for c in raw.columns if c not in ("price", "year")],
        F.col("price").alias("price_raw"),
        F.col("year").alias("year_raw"),
        price.alias("price"),
        year.alias("year"),
        error.alias("error"),
    )


def quarantine_bad_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the batch goes on without its bad rows, which keep their raw text."""
    typed = coerce_cars(raw)
    good = typed.where("error IS NULL").drop("error", "price_raw", "year_raw")
    return good, typed.where("error IS NOT NULL")


# ---------------------------------------------------------------- crawl ranges

def running_total(
    rows: DataFrame, group: str, order: str, value: str, name: str, block: int = 10_000
) -> DataFrame:
    """Running sum of ``value`` per group over dense integer ``order``, in blocks.

    A plain window puts a whole group into one task. Here each window holds at most one
    block of order values, and the totals of earlier blocks come from a second window
    that sees one row per block.
    """
    # The block is never null, and plainly so, which lets both uses share one shuffle.
    cut = rows.withColumn("_block", F.coalesce(F.floor(F.col(order) / block), F.lit(-1)))
    totals = cut.groupBy(group, "_block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group, "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy(group, "_block").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.alias("cut").join(
            offsets.alias("offsets"),
            F.col(f"cut.{group}").eqNullSafe(F.col(f"offsets.{group}"))
            & (F.col("cut._block") == F.col("offsets._block")),
        )
        .select("cut.*", "_offset")
        .withColumn(name, F.col("_offset") + F.sum(value).over(inside))
        .drop("_block", "_offset")
    )


def range_page_totals(pages: DataFrame) -> DataFrame:
    """(range_id, page, n_rows) -> the same with the running total of its range."""
    per_page = pages.groupBy("range_id", "page").agg(F.sum("n_rows").alias("n_rows"))
    return running_total(per_page, "range_id", "page", "n_rows", "running_rows")


def range_run_summary(pages: DataFrame) -> DataFrame:
    """Rows, pages and empty pages per price range."""
    per_page = pages.groupBy("range_id", "page").agg(F.sum("n_rows").alias("n_rows"))
    return per_page.groupBy("range_id").agg(
        F.count("*").alias("pages"),
        F.sum("n_rows").alias("total_rows"),
        F.count_if(F.col("n_rows") == 0).alias("empty_pages"),
    )


def crawl_frontier(ranges: DataFrame, pages: str = "pages", block: int = 10_000) -> DataFrame:
    """One row per page to fetch from rows (range_lo, range_hi, pages).

    Pages are unrolled in two steps with a shuffle between, so a range with very many
    pages becomes neither one giant array nor one task. The shuffle has a fixed width:
    adaptive execution would merge its few bytes into one task, which then had to produce
    every page.
    """
    width = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last_block = F.floor((F.col(pages) - 1) / block)
    blocks = (
        ranges.where(F.col(pages) >= 1)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
        .repartition(width, "range_lo", "range_hi", "_block")
    )
    start = F.col("_block") * block + 1
    end = F.least(F.col(pages).cast("bigint"), (F.col("_block") + 1) * block)
    return blocks.withColumn("page", F.explode(F.sequence(start, end))).drop("_block", pages)


def category_url(base: str, page: Column) -> Column:
    """The first page of a category carries no number."""
    return F.when(page == 1, base).otherwise(F.concat(F.lit(base + "/"), page))


def frontier_pending(frontier: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pages not landed yet; landed pages shrink to distinct keys before the join."""
    rest = frontier.join(landed.select(*keys).distinct(), list(keys), "left_anti")
    return rest.select(*frontier.columns)


def price_range_assign(
    cars: DataFrame, ranges: Sequence[tuple[float, float]] = K.PRICE_RANGES
) -> DataFrame:
    """Each car once per closed range its price lies in.

    The ranges are a configured list, so they go into the expression: no join at all.
    """
    bounds = F.array(
        *[F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")) for lo, hi in ranges]
    )
    hits = F.filter(bounds, lambda r: F.col("price").between(r["lo"], r["hi"]))
    return cars.select("*", F.explode(hits).alias("_r")).select(*cars.columns, "_r.lo", "_r.hi")


def search_request_filter(
    unified: DataFrame,
    price_range: tuple[float, float],
    years: tuple[int, int] = K.SEARCH_YEARS,
    mileage: tuple[float, float] = K.SEARCH_MILEAGE,
    mileage_column: str = "mileage",
) -> DataFrame:
    """The site's own search, newest first, bounds included."""
    return unified.where(
        F.col("year").between(*years)
        & F.col("price").between(*price_range)
        & F.col(mileage_column).between(*mileage)
    ).orderBy(F.col("scraped_at").desc(), "id")


# ---------------------------------------------------------------- batch log on storage

def append_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch as its own folder; writing it again replaces just that folder."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def current_items(log: DataFrame) -> DataFrame:
    """The table a batch log stands for: the last row per id over all batches."""
    return last_wins(log, ["id"], F.col("batch_id"), F.col("ingest_seq")).select(
        *schemas.ITEMS.fieldNames()
    )
