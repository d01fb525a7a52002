"""WARC archives out of pages, and a globally ordered index of what they hold.

Writing: one record per page. Of pages with equal payloads of ``LEAST`` bytes or more the
one with the largest id is written as response, the others as revisits that refer to it and
carry no payload; equal means same SHA-256 and length. Tasks write gzip files of about
``FILE_BYTES``, one gzip member per record, under names no other attempt uses; the stored
manifest lists those of the attempts that counted.

Reading: every file of the manifest is read member by member, and digests are taken from
the payload again. The captures of a file, sorted by URL key and timestamp, are one run.

Merging: the captures are dealt over ranges of (URL key, timestamp, id), so that a host or
address with a third of all captures spreads over many ranges, and in each range a loser
tree merges the runs. Range after range is the history of all captures.

Null html counts as an empty payload. A null url has the URL key "-". Rows that repeat id
and payload are all responses if their id is the largest; rows without id refer to it like
the others, and are responses where no id exists. The capture time is 2024-01-01 plus the id
in seconds. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, placed, saved
from motorlake.llm.files import place, write_whole
from motorlake.session import new_folder

LEAST = 1000
FILE_BYTES = 8 << 20
ROWS_PER_RANGE = 100_000
_READ = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = datetime.datetime(2024, 1, 1)
CAPTURE = (
    "urlkey string, captured string, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, run string, start long, length long"
)
ORDER = ["urlkey", "captured", "page_id", "run", "start"]


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html and refers_to (null for responses)."""
    html = clean_text("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.when(F.octet_length(html) >= least, F.concat_ws(":", F.sha2(html.cast("binary"), 256), F.octet_length(html)))
        .alias("payload"),
    )
    repeated = (
        rows.filter("payload is not null")
        .groupBy("payload").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null").select("payload", "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(repeated, "payload", "left").select("page_id", "url", "html", refers.alias("refers_to"))


# ---------------------------------------------------------------- records

def capture_time(page_id) -> str:
    shift = 0 if page_id is None else int(page_id) % 1_000_000_000
    return (_EPOCH + datetime.timedelta(seconds=shift)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _header_safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, html: str, refers_to) -> bytes:
    """One record as a gzip member."""
    payload = html.encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {capture_time(page_id)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_safe(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return squeeze.compress(whole) + squeeze.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write rows of ``with_revisits``; returns the stored manifest (path, records)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush():
            path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            write_whole(path, held)
            return pd.DataFrame({"path": [path], "records": [len(held)]})

        for batch in batches:
            for page_id, url, html, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"]):
                held.append(record(*(None if pd.isna(x) else x for x in (page_id, url)), html,
                                   None if pd.isna(refers) else int(refers)))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    ids = pages.withColumn("page_id", F.col("page_id").cast("string"))  # no rounding through floats
    ids = ids.withColumn("refers_to", F.col("refers_to").cast("string"))
    return saved(ids.mapInPandas(write, "path string, records long"), "archives")


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, content) of every gzip member."""
    start, pending = 0, b""
    while True:
        unzip, parts, length = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            chunk = pending or stream.read(_READ)
            pending = b""
            if not chunk:
                if length:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(unzip.decompress(chunk))
            length += len(chunk)
        pending = unzip.unused_data
        length -= len(pending)
        yield start, length, b"".join(parts)
        start += length


def url_key(url: str | None) -> str:
    """Host parts from the last to the first, then path and query, in lower case."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def _number(urn: str):
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def capture(run: str, start: int, length: int, content: bytes) -> tuple:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response":
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if digest != stated:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    else:
        digest, size = stated, int(re.search(rb"Content-Length: (\d+)", http)[1])
    url = fields.get("WARC-Target-URI")
    refers = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return (url_key(url), fields["WARC-Date"], _number(fields["WARC-Record-ID"]), url, kind, size, digest, refers,
            run, start, length)


def _rank(row: tuple) -> tuple:
    """Order of captures; a null id comes first."""
    return (row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9])


def read_archives(manifest: DataFrame) -> DataFrame:
    """Captures of all files: one run per file, sorted in itself."""
    names = [f.split()[0] for f in CAPTURE.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, inner = place(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    run = path.rpartition("/")[2]
                    rows = sorted((capture(run, *m) for m in members(stream)), key=_rank)
                yield pd.DataFrame(rows, columns=names, dtype=object)

    files = max(1, manifest.count())
    return saved(manifest.repartition(files, "path").mapInPandas(read, CAPTURE), "runs")


# ---------------------------------------------------------------- merging

class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root the winner."""

    def __init__(self, runs: list[Iterator], rank):
        self.runs, self.rank = [iter(r) for r in runs], rank
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [self._key(i) for i in range(len(runs))]
        self.losers = [-1] * len(runs)
        for run in range(len(runs)):
            self._replay(run)

    def _key(self, run: int):
        head = self.heads[run]
        return (1,) if head is None else (0, self.rank(head), run)

    def _replay(self, run: int) -> None:
        node = (run + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # first to arrive: waits for its match
                self.losers[node] = run
                return
            if self.keys[other] < self.keys[run]:
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self):
        while self.runs:
            best = self.losers[0]
            if self.heads[best] is None:
                return
            yield self.heads[best]
            self.heads[best] = next(self.runs[best], None)
            self.keys[best] = self._key(best)
            self._replay(best)


def merge_index(captures: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All captures with ``position``, their place in the order of ``ORDER``."""
    names = captures.columns
    run_at = names.index("run")
    ranges = captures.count() // rows_per_range + 1

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, last = [], None
        for batch in batches:
            batch["page_id"] = batch["page_id"].map(lambda x: None if pd.isna(x) else int(x)).astype(object)
            batch["refers_to"] = batch["refers_to"].map(lambda x: None if pd.isna(x) else int(x)).astype(object)
            for row in batch.itertuples(index=False, name=None):
                if row[run_at] != last:
                    last = row[run_at]
                    runs.append([])
                runs[-1].append(row)
        out = []
        for row in LoserTree(runs, _rank):
            out.append(row)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)

    text = captures.withColumn("page_id", F.col("page_id").cast("decimal(20,0)"))
    text = text.withColumn("refers_to", F.col("refers_to").cast("decimal(20,0)"))
    keys = [F.col(c) for c in ORDER]
    dealt = text.repartitionByRange(ranges, *keys).sortWithinPartitions("run", *keys[:3], "start")
    return placed(dealt.mapInPandas(merge, CAPTURE), "index")


def archive(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write, read back, merge: the ordered index of every capture."""
    folder = new_folder(pages.sparkSession, "warc")
    return merge_index(read_archives(write_archives(with_revisits(pages, least), folder)))
