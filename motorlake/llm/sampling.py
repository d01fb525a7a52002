"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: int,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows that are not held out.

    The ids with the smallest hashes are taken, the same on any cluster; only the chosen ids,
    at most ``most`` of them, are sent to the scan of the documents. Of several labels of an
    id the least counts, of several documents of an id the one whose text has the least hash:
    they are reduced before the shuffle, so an id with a third of all rows costs a row a task.
    """
    marked = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & (remainder(key, modulus) != held))
    marked = marked.groupBy(F.col(key).alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col(key).alias("doc_id"), clean_text(text).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    return found.groupBy("doc_id").agg(least, F.min("label").alias("label")).select("doc_id", "least.text", "label")


def unlabelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: int,
                      key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of at most ``most`` documents without a label that are not held out,
    chosen and made distinct like the labelled ones."""
    marked = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("doc_id"))
    ids = docs.select(F.col(key).alias("doc_id")).filter(F.col("doc_id").isNotNull() & (remainder("doc_id", modulus) != held))
    chosen = ids.distinct().join(marked, "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col(key).alias("doc_id"), clean_text(text).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    return found.groupBy("doc_id").agg(least).select("doc_id", "least.text")
