"""WARC archives: writing, the monolithic gzip normaliser, and reading by offset index.

A common fault of WARC collections is the archive compressed as one gzip stream: no record can be
read without inflating all before it. `normalise` inflates each such file once, rewrites every record
as a gzip member of its own, and writes a sidecar index with the offset of each member, so that later
readers start anywhere and an archive can be shared out among tasks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskweave.llm.common import base32, file_system, new_folder, row_number, stored

DATE = "2024-01-01T00:00:00Z"  # every record carries the same date, so archives are repeatable
PIECE = 1 << 20
SPAN = 16 << 20  # bytes of archive that one reading task takes

INDEX = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()),
])


# -- writing ------------------------------------------------------------------------------------


def _header(name: str, value: Column) -> Column:
    """A header line, nothing when the value is null; line ends inside a value are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its digest and size, record_type, refers_to and the record ids.

    Of equal payloads (null html counts as empty) the row with the smallest page_id is the response
    and all others revisit it. A null page_id comes after all others; of repeated rows with the same
    page_id one is the response. Only one small row per distinct payload is compared with the rows,
    after map-side combine; adaptive execution splits a payload that a third of the pages share.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        row_number(pages).alias("_id"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("_sha1"),
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "_id"))
    heads = rows.groupBy("_sha1").agg(first.alias("_head")).hint("shuffle_hash")
    head = F.col("_head._id") == F.col("_id")
    record = lambda i: F.concat(F.lit("<urn:page-row:"), i.cast("string"), F.lit(">"))
    return rows.join(heads, "_sha1").select(
        "page_id",
        "url",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.col("_sha1")).alias("payload_digest"),
        F.when(head, "response").otherwise("revisit").alias("record_type"),
        F.when(~head, F.col("_head.page_id")).alias("refers_to"),
        record(F.col("_id")).alias("record_id"),
        F.when(~head, record(F.col("_head._id"))).alias("refers_to_record"),
    )


def write_monolithic(records: DataFrame, folder: str) -> None:
    """Archives compressed as one gzip stream each, one per partition of `records`.

    A revisit carries no payload, only its digest, its size and whom it refers to.
    """
    response = F.col("record_type") == "response"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(response, F.concat(http, F.col("payload"))).otherwise(http)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Refers-To", F.col("refers_to_record")),
        F.when(~response, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(""),
        _header("X-Page-Id", F.col("page_id").cast("string")),
        _header("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
        _header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
    )
    record = F.concat(head, F.octet_length(F.col("_block")).cast("string"), F.lit("\r\n\r\n"), F.col("_block"))
    lines = records.withColumn("_block", block).select(record.alias("value"))
    # The text writer ends each row with the two line ends that close a WARC record.
    lines.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(folder)


# -- inside tasks -------------------------------------------------------------------------------


class _Inflated:
    """The inflated bytes of a gzip stream with any number of members, read piece by piece."""

    def __init__(self, source):
        self.source, self.inflater, self.buffer = source, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        piece = self.inflater.unused_data if self.inflater.eof else b""
        if self.inflater.eof:
            self.inflater = zlib.decompressobj(31)
        piece = piece or self.source.read(PIECE)
        if not piece:
            return False
        self.buffer += self.inflater.decompress(piece)
        return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with the mark, or all that is left."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                at = len(self.buffer) - len(mark)
                break
        return self.take(at + len(mark))

    def skip(self, characters: bytes) -> bool:
        """Past these characters; whether anything is left."""
        while True:
            kept = self.buffer.lstrip(characters)
            if kept or not self._more():
                self.buffer = kept
                return bool(kept)

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def warc_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, raw record) of a stream of WARC records, one record in memory at a time."""
    stream = _Inflated(source)
    while stream.skip(b"\r\n"):
        head = stream.until(b"\r\n\r\n")
        headers = parse_headers(head)
        size = int(headers["content-length"])
        block = stream.take(size)
        if len(block) < size or not head.startswith(b"WARC/"):
            raise ValueError("the archive ends inside a record or holds something else")
        yield headers, head + block + b"\r\n\r\n"


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines if x)}


def _rewriter(folder: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source in batch["path"]:
                yield pd.DataFrame([_rewrite_archive(source, folder)])

    return rewrite


def _rewrite_archive(source: str, folder: str) -> dict:
    """One archive rewritten with a member per record, and its sidecar.

    Both files are written under a name of this attempt and then moved, so a task that runs twice or
    dies half-way leaves no partial archive under the final name.
    """
    name = source.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
    fs_in, path_in = file_system(source)
    fs, base = file_system(folder)
    archive, sidecar = f"{base}/{name}.warc.gz", f"{base}/{name}.idx.jsonl"
    attempt = f".{uuid.uuid4().hex}.part"
    offset = count = 0
    with fs_in.open_input_stream(path_in, compression=None) as raw, fs.open_output_stream(
        archive + attempt, compression=None
    ) as out, fs.open_output_stream(sidecar + attempt, compression=None) as index:
        for headers, record in warc_records(raw):
            member = gzip.compress(record, 6, mtime=0)
            out.write(member)
            entry = {
                "archive": f"{folder}/{name}.warc.gz", "offset": offset, "length": len(member),
                "record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"),
            }
            index.write(json.dumps(entry).encode() + b"\n")
            offset, count = offset + len(member), count + 1
    fs.move(archive + attempt, archive)
    fs.move(sidecar + attempt, sidecar)
    return {"archive": f"{folder}/{name}.warc.gz", "records": count, "bytes": offset}


def _read_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records at the offsets given. Each member is opened by itself; its payload is checked against its digest."""
    open_path, handle = None, None
    for batch in batches:
        rows = []
        for archive, offset, length in zip(batch["archive"], batch["offset"], batch["length"], strict=True):
            if archive != open_path:
                if handle is not None:
                    handle.close()
                fs, path = file_system(archive)
                open_path, handle = archive, fs.open_input_file(path)
            handle.seek(offset)
            rows.append(_page(zlib.decompress(handle.read(length), 31)))
        yield pd.DataFrame(rows, columns=[f.name for f in PAGES]).astype({"page_id": "Int64", "refers_to": "Int64"})
    if handle is not None:
        handle.close()


PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])


def _page(record: bytes) -> tuple:
    head, _, block = record.partition(b"\r\n\r\n")
    headers = parse_headers(head)
    block = block[: int(headers["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, size = headers["warc-payload-digest"].removeprefix("sha1:"), int(headers["x-payload-length"])
    whole = headers["warc-type"] == "response"
    if whole and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {headers['warc-record-id']} differs from its digest")
    number = lambda k: int(headers[k]) if k in headers else None
    return (
        number("x-page-id"), headers.get("warc-target-uri"), size, digest, headers["warc-type"],
        number("x-refers-to-page-id"), payload if whole else None,
    )


# -- jobs ---------------------------------------------------------------------------------------


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites every *.gz archive of `source` into `target`; returns (archive, records, bytes).

    One task works on whole archives, with one record in memory. Archives of any number of members
    are read, so running it over normal archives changes nothing but the compression.
    """
    fs, path = file_system(target)
    fs.create_dir(path, recursive=True)
    # Only the names are read here: the content column is pruned.
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    spread = found.repartition(max(1, spark.sparkContext.defaultParallelism * 4))
    return stored(spread.mapInPandas(_rewriter(target), "archive string, records long, bytes long"), "warc-archives")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx.jsonl").json(folder)


def read_pages(index: DataFrame, span: int = SPAN) -> DataFrame:
    """The records of an index, with `PAGES` columns. Tasks take runs of about `span` bytes of an archive."""
    runs = index.withColumn("_run", F.floor(F.col("offset") / span))
    return (
        runs.repartition("archive", "_run").sortWithinPartitions("archive", "offset")
        .select("archive", "offset", "length").mapInPandas(_read_members, PAGES)
    )


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as monolithic archives, normalised, and read back through the sidecar index.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to, url. An empty
    table gives an empty one; columns other than page_id, url and html are left out.
    """
    spark = pages.sparkSession
    raw, clean = new_folder(spark, "warc-raw"), new_folder(spark, "warc")
    write_monolithic(with_revisits(pages), raw)
    normalise(spark, raw, clean)
    return read_pages(read_index(spark, clean)).drop("payload")
