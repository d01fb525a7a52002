"""Training-order materialisation of token ids.

Texts become token ids, each text ends with ``tokens.END``, and every task packs its texts
one after the other into sequences of ``length`` ids; only a task's last one is filled up
with ``tokens.END``. The stored sequences are numbered without a gap, and a keyed Feistel
network with cycle-walking maps the numbers one to one onto slots: the training order. One
shard holds ``slots`` slots; task i writes shard i, slot after slot, each ``length`` 16-bit
little-endian ids, so that slot s lies in shard s // slots at byte (s % slots) * stride.
A reader that knows the next slot goes on from there.

A sequence lists its parts: the id of the document, the number of the first token taken
from it and how many. Null text counts as empty: its only token is the end. Rows that share
an id, or have none, are packed like any other. An empty table gives no shard.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from motorlake.llm import tokens
from motorlake.llm.common import clean_text, placed, saved
from motorlake.llm.files import place, write_whole
from motorlake.session import new_folder

LENGTH = 2048
SLOTS = 4096
KEY = "order-1"
_ROUNDS = 6
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PARTS = "parts array<struct<doc_id:string,first:long,n:long>>"


def sequences(docs: DataFrame, key: str, text: str, length: int, vocabulary: bytes) -> DataFrame:
    """Stored rows (position, parts, n_tokens, ids): numbered sequences."""
    spark, stride = docs.sparkSession, 2 * length
    shipped = spark.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = tokens.Pieces(shipped.value), np.array([tokens.END], dtype="<u2").tobytes()
        held, parts, done = bytearray(), [], []

        def rows():
            return pd.DataFrame(done, columns=["parts", "n_tokens", "ids"])

        def coded():
            for batch in batches:
                yield from zip(batch["doc_id"], encode.texts(batch["text"].tolist()))

        for doc_id, body in coded():
            ids = memoryview(body.tobytes() + end)
            at = 0
            while at < len(ids):
                take = min(stride - len(held), len(ids) - at)
                held += ids[at : at + take]
                parts.append({"doc_id": doc_id, "first": at // 2, "n": take // 2})
                at += take
                if len(held) == stride:
                    done.append((parts, length, bytes(held)))
                    held, parts = bytearray(), []
            if len(done) >= 256:
                yield rows()
                done = []
        if held:
            n = len(held) // 2
            done.append((parts, n, bytes(held) + end * (length - n)))
        if done:
            yield rows()

    rows = docs.select(F.col(key).cast("string").alias("doc_id"), clean_text(text).alias("text"))
    return placed(rows.mapInPandas(pack, f"{_PARTS}, n_tokens int, ids binary"), "sequences", level=6)


# ---------------------------------------------------------------- the permutation

def round_keys(key: str) -> np.ndarray:
    digest = hashlib.sha256(key.encode()).digest() + hashlib.sha256(b"+" + key.encode()).digest()
    return np.frombuffer(digest, dtype="<u8")[:_ROUNDS]


def _scramble(x: np.ndarray, key: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + key) * _MIX
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _feistel(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ (_scramble(right, key) & mask)
    return (left << shift) | right


def permute(positions: np.ndarray, size: int, key: str = KEY) -> np.ndarray:
    """Slots of the positions: a keyed permutation of range(size).

    The network permutes the smallest even-bit range that holds size; a value beyond size
    walks on through the network until it is back inside, which keeps it one to one.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    keys = round_keys(key)
    out = _feistel(positions.astype(np.uint64), half, keys)
    while (outside := out >= np.uint64(size)).any():
        out[outside] = _feistel(out[outside], half, keys)
    return out.astype(np.int64)


# ---------------------------------------------------------------- shards

def write(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
          slots: int = SLOTS, order_key: str = KEY, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Write the shards; returns the stored table of slots (slot, shard, start, parts, ...)."""
    rows = sequences(docs, key, text, length, tokens.read_vocabulary(vocabulary))
    size, stride = rows.count(), 2 * length
    shards = max(1, -(-size // slots))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(6).compress  # less to shuffle
        for batch in batches:
            slot = permute(batch["position"].to_numpy(), size, order_key)
            yield pd.DataFrame({"slot": slot, "parts": batch["parts"], "n_tokens": batch["n_tokens"],
                                "ids": [squeeze(ids) for ids in batch["ids"]]})

    dealt = rows.select("position", "parts", "n_tokens", "ids").mapInPandas(
        deal, f"slot long, {_PARTS}, n_tokens int, ids binary"
    )
    ranged = dealt.withColumn("shard", F.floor(F.col("slot") / slots).cast("int"))
    ranged = ranged.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unzip, listed = zstandard.ZstdDecompressor().decompress, []

        def bodies():
            for batch in batches:
                listed.append(batch.drop(columns="ids").assign(
                    crc=[zlib.crc32(unzip(ids)) for ids in batch["ids"]]))
                if (batch["shard"] != listed[0]["shard"].iloc[0]).any():
                    raise RuntimeError("a task holds more than one shard")
                for ids in batch["ids"]:
                    yield unzip(ids)

        stream = bodies()
        first = next(stream, None)
        if first is None:
            return
        shard = int(listed[0]["shard"].iloc[0])
        write_whole(shard_path(folder, shard), _chain(first, stream))
        yield from listed

    written = ranged.mapInPandas(store, f"slot long, {_PARTS}, n_tokens int, shard int, crc long")
    return saved(
        written.select(
            "slot", "shard", ((F.col("slot") % slots) * stride).alias("start"), "n_tokens", "crc",
            F.transform("parts", lambda p: F.struct(p.doc_id.cast(docs.schema[key].dataType).alias("doc_id"), p["first"].alias("first"),
                                                    p.n.alias("n"))).alias("parts"),
        ),
        "slots",
    )


def _chain(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.bin"


def read_slots(folder: str, start: int, stop: int, length: int = LENGTH, slots: int = SLOTS) -> Iterator[np.ndarray]:
    """The sequences of slots start to stop, read one after the other from the shards."""
    stride = 2 * length
    system, root = place(folder)
    while start < stop:
        shard, at = divmod(start, slots)
        end = min(stop, (shard + 1) * slots)
        with system.open_input_file(shard_path(root, shard)) as file:
            file.seek(at * stride)
            for _ in range(start, end):
                yield np.frombuffer(file.read(stride), dtype="<u2")
        start = end


def verify(written: DataFrame, folder: str, length: int = LENGTH, slots: int = SLOTS) -> DataFrame:
    """The slots, each with whether its bytes, read back from the shard, have its checksum."""
    stride = 2 * length

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, opened = None, None
        for batch in batches:
            good = []
            for shard, at, crc in zip(batch["shard"], batch["start"], batch["crc"]):
                if shard != opened:
                    system, path = place(shard_path(folder, shard))
                    file, opened = system.open_input_file(path), shard
                file.seek(at)
                good.append(zlib.crc32(file.read(stride)) == crc)
            yield batch.assign(stored=good)

    return written.mapInPandas(check, StructType([*written.schema, StructField("stored", BooleanType())]))


def materialise(docs: DataFrame, **options) -> DataFrame:
    """Write the shards into a new shared folder and read every slot back."""
    folder = new_folder(docs.sparkSession, "shards")
    sizes = {k: options[k] for k in ("length", "slots") if k in options}
    return verify(write(docs, folder, **options), folder, **sizes)


def slots(docs: DataFrame, **options) -> DataFrame:
    """``materialise`` with the parts as lists: document ids, first tokens, token counts."""
    return materialise(docs, **options).select(
        "slot", "shard", "start", "n_tokens", "crc", "stored",
        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.first").alias("first_tokens"),
        F.col("parts.n").alias("token_counts"),
    )
