"""WARC archives: write them, normalise monolithic ones, and read single records.

A monolithic archive is one gzip stream over the whole file, so a record can only be
reached through all before it. The normaliser inflates each such file once, as a stream,
writes every record as a gzip member of its own, and beside the archive a sidecar index
with a line for each record: where its member begins and how long it is. A reader then
takes any record by one positioned read, so large archives are read by many tasks.

Records are written by Spark's text sink: a record ends in the two line ends that the
format asks for anyway. The normaliser and the reader reach files by their URI, so what
holds them must be a store that pyarrow knows (a shared mount, HDFS, S3 and the like).
A file is worked off by one task, whose memory holds one record. Members and index go to
names of their own first and are then moved, the index last, so a task that is run again
after a lost executor replaces what it finds with the same bytes.

A page's payload is its html in UTF-8, empty for NULL. Of pages with equal payloads of
``REVISIT_BYTES`` or more the one with the largest id is the response and the others
revisit it; with no id at all, or one largest id several times, each of those is a
response. A NULL url has no target line. White space and control characters of a url,
which a header cannot hold, become ``%20``. An empty table gives empty archives.
Other columns play no part. A damaged archive fails with its name.
"""

from __future__ import annotations

import gzip
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.native import table

REVISIT_BYTES = 1_000
RECORDS_PER_FILE = 100_000
READ_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
# Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset bigint, length bigint, record_id string, record_type string"
RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, declared_digest string, "
    "declared_bytes bigint, payload binary"
)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``value``: the WARC record of each ``(page_id, url, html)`` row, as text.

    Repeated payloads are found on digests alone. Their table is sized, so the pages are
    shuffled to it only when it is too large to broadcast; adaptive execution then splits
    a payload that many pages share.
    """
    body = F.coalesce("html", F.lit(""))
    pages = pages.select(
        "page_id", "url", body.alias("body"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("n")
    )
    repeats = pages.filter(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n").agg(
        F.max("page_id").alias("top"), F.count("*").alias("times")
    )
    repeats = table(repeats.filter("times > 1 AND top IS NOT NULL").drop("times"), "repeats")
    pages = pages.join(repeats, ["digest", "n"], "left")
    revisits = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _header("Content-Length", F.col("n").cast("string")), F.lit("\r\n")
    )
    block = F.concat(http, F.when(revisits, "").otherwise(F.col("body")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _page_urn(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisits,
            F.concat(_header("WARC-Profile", F.lit(REVISIT_PROFILE)), _header("WARC-Refers-To", _page_urn(F.col("top")))),
        ).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return pages.select(F.concat(head, block).alias("value"))


def write_monolithic(records: DataFrame, folder: str) -> None:
    """Archives of one gzip stream each."""
    sink = records.select("value").write.option("compression", "gzip").option("lineSep", END)
    sink.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def inflated(raw) -> Iterator[bytes]:
    """What a gzip file holds, piece by piece, be it one member or many."""
    inflate = zlib.decompressobj(31)
    while data := raw.read(READ_BYTES):
        while data:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            yield inflate.decompress(data, READ_BYTES)
            while inflate.unconsumed_tail:
                yield inflate.decompress(inflate.unconsumed_tail, READ_BYTES)
            data = inflate.unused_data
    if not inflate.eof and inflate.flush():
        raise ValueError("the archive ends within a member")


def headers_of(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and bytes of each record of a stream; one record is held at a time."""
    buffer = bytearray()
    end = END.encode()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            buffer.extend(piece)
        return piece is not None

    while True:
        # the line ends between two records may come in different pieces
        while b"\r\n".startswith(bytes(buffer[:2])):
            if len(buffer) < 2 and not more():
                break
            if buffer[:2] == b"\r\n":
                del buffer[:2]
        searched = 0
        while (at := buffer.find(end, searched)) < 0:
            searched = max(0, len(buffer) - len(end))
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends within a record")
                return
        headers = headers_of(bytes(buffer[:at]))
        if not buffer.startswith(b"WARC/") or not headers.get("content-length", "").isdigit():
            raise ValueError("not a WARC record")
        whole = at + len(end) + int(headers["content-length"])
        while len(buffer) < whole:
            if not more():
                raise ValueError("the archive ends within a record")
        yield headers, bytes(buffer[:whole])
        del buffer[:whole]


def normalise_file(source: str, folder: str, name: str) -> tuple[int, int]:
    """Rewrite one archive to ``folder/name`` with its sidecar; gives records and bytes."""
    store, path = _open(source)
    target, into = _open(folder)
    mark, n, offset = uuid.uuid4().hex, 0, 0
    parts = [f"{into}/_{mark}.{kind}" for kind in ("gz", "idx")]
    try:
        with store.open_input_stream(path, compression=None) as raw, target.open_output_stream(
            parts[0], compression=None
        ) as members, target.open_output_stream(parts[1], compression=None) as index:
            for headers, record in records_of(inflated(raw)):
                member = gzip.compress(record + END.encode(), 6, mtime=0)
                members.write(member)
                line = {
                    "archive": name,
                    "offset": offset,
                    "length": len(member),
                    "record_id": headers.get("warc-record-id"),
                    "record_type": headers.get("warc-type"),
                }
                index.write(json.dumps(line).encode() + b"\n")
                offset += len(member)
                n += 1
    except (ValueError, zlib.error) as problem:
        raise ValueError(f"{source}: {problem}") from problem
    target.move(parts[0], f"{into}/{name}")
    target.move(parts[1], f"{into}/{name}.idx")
    return n, offset


def normalise(spark: SparkSession, source: str, folder: str) -> tuple[int, int]:
    """Rewrite all ``*.gz`` archives of a folder; gives the records and bytes written."""
    target, into = _open(folder)
    target.create_dir(into, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    n_files = files.count()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = re.sub(r"(\.warc|\.txt)?\.gz$", "", path.rsplit("/", 1)[-1]) + ".warc.gz"
                n, size = normalise_file(path, folder, name)
                yield pa.RecordBatch.from_pydict({"n": [n], "size": [size]})

    if not n_files:
        return 0, 0
    done = files.repartitionByRange(n_files, "path").mapInArrow(work, "n bigint, size bigint")
    return tuple(done.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first())


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(folder)


def read_records(index: DataFrame, folder: str, n_parts: int) -> DataFrame:
    """The records of index rows, each by one positioned read, neighbours in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, archive = None, None
        rows, held = [], 0
        for batch in batches:
            for at in batch.to_pylist():
                if at["archive"] != name:
                    if archive:
                        archive.close()
                    name = at["archive"]
                    archive = store.open_input_file(f"{base}/{name}")
                record = gzip.decompress(archive.read_at(at["length"], at["offset"]))
                head, _, block = record.partition(END.encode())
                headers = headers_of(head)
                block = block[: int(headers["content-length"])]
                http, _, payload = block.partition(END.encode())
                declared = headers_of(http).get("content-length", "")
                rows.append(
                    {
                        "record_id": headers.get("warc-record-id"),
                        "record_type": headers.get("warc-type"),
                        "refers_to": headers.get("warc-refers-to"),
                        "target_uri": headers.get("warc-target-uri"),
                        "declared_digest": headers.get("warc-payload-digest"),
                        "declared_bytes": int(declared) if declared.isdigit() else None,
                        "payload": payload,
                    }
                )
                held += len(payload)
                if held > READ_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if archive:
            archive.close()
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in RECORD.split(", "))])
    dealt = index.repartition(max(1, n_parts), "archive", F.floor(F.col("offset") / BLOCK_BYTES))
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(work, RECORD)
