"""Landed pages as streams.

Every micro-batch is written to its own folder of a batch log, named by the batch id
Spark hands over. A batch that is run again after a failure replaces the same folder, so
the log holds each batch once. The conflict rule is applied when the log is read: no
micro-batch ever reads or rewrites what earlier ones wrote. A log belongs to its
checkpoint: batch ids start over with a new checkpoint, so a new one needs a new log.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pyspark.storagelevel import StorageLevel

from motorlake.operators import extract, ingest
from motorlake.plans import price_model


def read_landing(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a folder (or of all that match a path pattern) as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run(rows: DataFrame, write, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


# Fixed value: tasks a split of landed pages is dealt into; markup compresses several times.
TASKS_A_SPLIT = 4


def _dealt(batch: DataFrame) -> DataFrame:
    """The pages of a micro-batch, dealt over all cores: a few files are few splits, and
    parsing, not moving them, takes the time. Large micro-batches get more tasks, so that
    none grows with them."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch.repartition(max(cores, TASKS_A_SPLIT * batch.rdd.getNumPartitions()))


def stream_extract_upsert(pages: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Streaming pages (page_id, html) -> cards -> batch log, reduced to one row per id.

    Rows of a batch are ordered by (page_id, pos), as pages were fetched in turn.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        cards = extract.extract_gl_cards(_dealt(batch))
        last = ingest.last_wins(cards, ["id"], F.col("page_id"), F.col("pos"))
        ingest.append_batch(last, log, batch_id)

    return _run(pages, write, checkpoint)


def _last_per_id(spark: SparkSession, log: str) -> DataFrame:
    order = [F.col(c) for c in ("batch_id", "page_id", "pos")]
    return ingest.last_wins(spark.read.parquet(log), ["id"], *order)


def upserted_cards(spark: SparkSession, log: str) -> DataFrame:
    """The items table of a card log: the last write per id."""
    return _last_per_id(spark, log).select("id", "image_src", "p_text", "l_text", "at_text")


def stream_offer_upsert(pages: DataFrame, log: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Streaming search pages (page_id, html) -> usable cards -> batch log, one row per id;
    cards that cannot be used go to the quarantine log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        cards = price_model.offer_cards(_dealt(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        good = cards.where("error IS NULL").drop("error", "price_raw", "year_raw")
        last = ingest.last_wins(good, ["id"], F.col("page_id"), F.col("pos"))
        ingest.append_batch(ingest.default_timestamp(last), log, batch_id)
        ingest.append_batch(cards.where("error IS NOT NULL"), quarantine, batch_id)
        cards.unpersist()

    return _run(pages, write, checkpoint)


def upserted_cars(spark: SparkSession, log: str) -> DataFrame:
    """The cars table of an offer log: the last write per id."""
    return _last_per_id(spark, log).drop("batch_id", "page_id", "pos")


def stream_detail_tags(
    pages: DataFrame, log: str, checkpoint: str, landing: str | None = None
) -> StreamingQuery:
    """Streaming detail pages (car_id, html) -> tags -> batch log, first value per key.

    ``landing`` names a column of the pages that orders landings of one car; the log keeps it
    as ``landing``. Batches come one after the other, so it decides inside a batch only.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        tags = price_model.landed_tags(_dealt(batch), landing)
        ingest.append_batch(tags.withColumnRenamed(landing, "landing") if landing else tags, log, batch_id)

    return _run(pages, write, checkpoint)


def stream_first_wins(tags: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Streaming tags (car_id, attribute, value, seq) -> batch log, first value per key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        first = ingest.first_wins(batch, ["car_id", "attribute"], F.col("seq"))
        ingest.append_batch(first, log, batch_id)

    return _run(tags, write, checkpoint)


def first_tags(spark: SparkSession, log: str) -> DataFrame:
    """The tags table of a tag log: the first write per (car, attribute)."""
    return _first_per_key(spark, log).select("car_id", "attribute", "value")


def _first_per_key(spark: SparkSession, log: str) -> DataFrame:
    rows = spark.read.parquet(log)
    order = [F.col(c) for c in ("batch_id", "landing", "seq") if c in rows.columns]
    return ingest.first_wins(rows, ["car_id", "attribute"], *order)


def _leaves(column: Column, kind: T.DataType) -> list[Column]:
    """What tells values of a column apart in a hash, which passes over nulls."""
    if isinstance(kind, T.StructType):
        fields = [part for f in kind for part in _leaves(column.getField(f.name), f.dataType)]
        return [column.isNull(), *fields]
    return [column.isNull(), column]


def _digest(rows: DataFrame, names: list[str]) -> dict[str, Column]:
    """Two 64-bit hashes of the named columns."""
    leaves = [part for n in names for part in _leaves(F.col(n), rows.schema[n].dataType)]
    return {"_key": F.xxhash64(*leaves), "_key2": F.xxhash64(F.lit("second"), *leaves)}


_STORE = "spark.sql.streaming.stateStore"
# A state of hashes, kept on the executors' disks; hashes do not compress.
STATE_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.compression": "none",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, not in the executors' heaps. What
    the session sets itself stays, and the session is left as it was."""
    added = {k: v for k, v in STATE_ON_DISK.items() if spark.conf.get(k, None) is None}
    try:
        for key, value in added.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def stream_fresh_tags(tags: DataFrame, log: str, checkpoint: str, kept: str = "1 day") -> StreamingQuery:
    """Like ``stream_first_wins`` for crawls that land the same pages over and over: a tag
    (car_id, attribute, value, seq) that arrived in the last ``kept`` is not written again.

    The state store holds the tags of that time and no older ones, each as 128 bits of hashes
    on the executors' disks, so it is not bounded by their heaps. Time is that of arrival,
    so no row is ever late, and none is lost. A repeat that comes later is written once more,
    and settled where all are: by the first write per key, when the log is read. Checkpoints
    whose state holds whole tags cannot be carried on: compact their log and start a new one.
    """
    keys = _digest(tags, ["car_id", "attribute", "value", "seq"])
    arrived = tags.withColumns(keys).withColumn("_arrived", F.current_timestamp())
    fresh = arrived.withWatermark("_arrived", kept).dropDuplicatesWithinWatermark([*keys])

    def write(batch: DataFrame, batch_id: int) -> None:
        first = ingest.first_wins(batch.drop(*keys, "_arrived"), ["car_id", "attribute"], F.col("seq"))
        ingest.append_batch(first, log, batch_id)

    with _state_on_disk(tags.sparkSession):
        return _run(fresh, write, checkpoint)


def first_tags_stateful(tags: DataFrame) -> DataFrame:
    """First value per key straight from the stream.

    Keeps every key in the state store for good; use the log for an unbounded crawl.
    """
    return tags.dropDuplicates(["car_id", "attribute"])


def stream_progress(
    pages: DataFrame, keys: list[str], log: str, checkpoint: str
) -> StreamingQuery:
    """Running page counts per key, one folder of totals per micro-batch."""
    counts = pages.groupBy(*keys).agg(F.count("*").alias("n"))
    write = lambda batch, n: ingest.append_batch(batch, log, n)
    return _run(counts, write, checkpoint, mode="complete")


def stream_progress_changes(
    pages: DataFrame, keys: list[str], log: str, checkpoint: str
) -> StreamingQuery:
    """Running page counts per key; a micro-batch's folder holds the totals it changed."""
    counts = pages.groupBy(*keys).agg(F.count("*").alias("n"))
    write = lambda batch, n: ingest.append_batch(batch, log, n)
    return _run(counts, write, checkpoint, mode="update")


def progress_totals(spark: SparkSession, log: str, keys: list[str]) -> DataFrame:
    """The newest total of every key of a log of changes."""
    newest = F.max(F.struct("batch_id", "n")).alias("newest")
    return spark.read.parquet(log).groupBy(*keys).agg(newest).select(*keys, "newest.n")


def progress_counts(spark: SparkSession, log: str) -> DataFrame:
    """The totals of the newest micro-batch; older folders are not scanned."""
    totals = spark.read.parquet(log)
    newest = totals.agg(F.max("batch_id").alias("b")).scalar()
    return totals.where(F.col("batch_id") == newest).drop("batch_id")


# Batch id of what a log starts from: before all ids a stream hands out.
START = -1


def compact_log(spark: SparkSession, log: str, target: str) -> None:
    """Start a new card or offer log with the resolved rows of an old one, order columns
    included. A stream with a new checkpoint goes on from there."""
    ingest.append_batch(_last_per_id(spark, log).drop("batch_id"), target, START)


def compact_tag_log(spark: SparkSession, log: str, target: str) -> None:
    """Start a new tag log with the first values of an old one, which stay the first."""
    ingest.append_batch(_first_per_key(spark, log).drop("batch_id"), target, START)
