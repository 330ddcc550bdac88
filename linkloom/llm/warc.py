"""WARC archives: writing, normalising monolithic gzip streams to a member per record, and reading back.

Spark's own text sink writes the archives, so they go to any store that Spark
reaches and a lost task leaves nothing behind. Each task writes whole files of a
bounded number of records; no page is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources.scratch import materialize, new_path

#: Records of a monolithic archive, which bounds its size.
FILE_RECORDS = 1000
_END = b"\r\n\r\n"
#: A member's last byte is the high byte of its length, zero below 16 MiB; the text sink writes it as its separator.
_SEPARATOR = "\x00"
_STEP = 1 << 16


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a binary column's SHA-1: five hex digits are four of base32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def repeats(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(digest, keeper)`` of payloads that several rows have: the largest ``page_id``. A written table.

    Counted per digest before the shuffle. Payloads under ``least_bytes`` are never repeats.
    """
    sums = pages.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("rows")
    )
    return materialize(sums.where("rows > 1").select("digest", "keeper"), "repeats")


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A WARC record per row of ``pages (page_id, url, html)`` as text, without the blank lines that end it.

    A row whose payload a larger ``page_id`` also has is a revisit without
    payload. Null html is an empty payload; control characters of a URL are
    percent-encoded, a null URL is left out; a null ``page_id`` has an empty id.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", base32_sha1(F.col("payload")))
    known = repeats(rows, least_bytes).withColumnRenamed("digest", "_digest")
    rows = rows.join(known, (F.col("digest") == F.col("_digest")), "left")
    short = F.octet_length("payload") < least_bytes
    revisit = F.col("_digest").isNotNull() & ~short & ~F.col("page_id").eqNullSafe(F.col("keeper"))

    def uri(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    size = F.octet_length("payload").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n")
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    length = F.octet_length(http) + F.octet_length(body)
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), uri(F.col("page_id"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri(F.col("keeper")))),
        F.when(
            revisit,
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    )
    return rows.select(F.concat(head, F.lit("\r\n\r\n"), http, body).alias("value"))


def write_monolithic(pages: DataFrame, path: str, least_bytes: int = 0, file_records: int = FILE_RECORDS) -> None:
    """Write ``pages`` as archives that are one gzip stream each."""
    sink = records(pages, least_bytes).write.option("compression", "gzip").option("lineSep", _END.decode())
    sink.option("maxRecordsPerFile", file_records).text(path)


def split_records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, end lines included, of an inflated archive that comes in parts."""
    held = bytearray()
    for part in stream:
        held += part
        at = 0
        while True:
            head = held.find(_END, at)
            if head < 0:
                break
            found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", held[at:head])
            end = head + 4 + (int(found[1]) if found else 0) + 4
            if end > len(held):
                break
            yield bytes(held[at:end])
            at = end
        del held[:at]
    if held:
        raise ValueError("the archive ends inside a record")


def inflated(content: bytes) -> Iterator[bytes]:
    """An archive's bytes in parts, whatever its gzip members."""
    view, at = memoryview(content), 0
    inflate = zlib.decompressobj(31)
    while at < len(view):
        part = view[at : at + _STEP]
        yield inflate.decompress(part)
        at += len(part)
        if inflate.eof:
            at -= len(inflate.unused_data)
            inflate = zlib.decompressobj(31)
    if len(view) and at == len(view) and not inflate.eof:
        yield inflate.flush()


def member(record: bytes) -> bytes:
    """One record as a gzip member; the same bytes in every run."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


def normalize(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite each record of the archives in ``source`` as a gzip member of its own, in archives in ``target``.

    A stream is inflated once, in parts; a task holds one archive and one
    record. Members of records from 16 MiB are followed by a zero byte, which
    their index entry leaves out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out: list[bytes] = []
                size = 0
                for record in split_records(inflated(content.as_py())):
                    packed = member(record)
                    out.append(packed[:-1] if packed[-1] == 0 else packed)
                    size += len(packed)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    files = spark.read.format("binaryFile").load(source).select("content")
    members = files.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("compression", "none").option("lineSep", _SEPARATOR).text(target)


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and inflated record of each member."""
    view, at = memoryview(content), 0
    while at < len(view):
        if view[at] == 0:  # behind the member of a very long record
            at += 1
            continue
        inflate, start, out = zlib.decompressobj(31), at, []
        while not inflate.eof:
            part = view[at : at + _STEP]
            if not len(part):
                raise ValueError("the archive ends inside a member")
            out.append(inflate.decompress(part))
            at += len(part)
        at -= len(inflate.unused_data)
        yield start, at - start, b"".join(out)


def _field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + name + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else None


def write_index(spark: SparkSession, archives: str, path: str) -> None:
    """The sidecar: a JSON line per member with its archive, offset, length, record id, type and URI."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for offset, length, record in _members(content.as_py()):
                    head = record.partition(_END)[0]
                    fields = [_field(head, k) for k in (b"warc-record-id", b"warc-type", b"warc-target-uri")]
                    rows.append((name.as_py(), offset, length, *fields))
                if rows:
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=INDEX.replace("long", "").replace("string", "").replace(" ", "").split(","))

    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    files.mapInArrow(run, INDEX).write.json(path)


INDEX = "archive string, offset long, length long, record string, type string, uri string"


def parse(record: bytes) -> tuple[str | None, str | None, str | None, str | None, int, str]:
    """Record id, type, what it refers to, URI, payload bytes and digest; a response's are taken from its payload."""
    head, _, block = record.partition(_END)
    kind = _field(head, b"warc-type")
    http, _, payload = block[:-4].partition(_END)
    if kind == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (_field(head, b"warc-payload-digest") or "").removeprefix("sha1:") != digest:
            raise ValueError("a payload does not have the digest of its record")
    else:
        size = int(_field(http, b"content-length") or 0)
        digest = (_field(head, b"warc-payload-digest") or "").removeprefix("sha1:")
    return _field(head, b"warc-record-id"), kind, _field(head, b"warc-refers-to"), _field(head, b"warc-target-uri"), size, digest


def read_archives(spark: SparkSession, archives: str, index: str) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)`` of each indexed record.

    Each member is cut out by its index entry alone. Entries are gathered per
    archive, whose number of records is bounded.
    """
    entries = spark.read.schema(INDEX).json(index).groupBy("archive").agg(
        F.collect_list(F.struct("offset", "length")).alias("entries")
    )
    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def number(uri: str | None) -> int | None:
        digits = (uri or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, listed in zip(batch.column(0), batch.column(1)):
                view, rows = memoryview(content.as_py()), []
                for entry in listed.as_py():
                    start = entry["offset"]
                    record = zlib.decompress(view[start : start + entry["length"]], 31)
                    page, kind, refers, uri, size, digest = parse(record)
                    rows.append((number(page), uri, size, digest, kind, number(refers)))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = files.join(entries, F.col("path") == F.col("archive")).select("content", "entries")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return joined.mapInArrow(run, schema)


def archive_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives, normalise them, index them and read them back.

    ``folder`` gets ``monolithic``, ``archives`` and ``index``; by default a new
    one beside other shared tables. One row per row of ``pages``, repeated rows
    included; rows with the largest ``page_id`` of a payload are all responses.
    An empty table gives an empty result. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    write_monolithic(pages, f"{folder}/monolithic", least_bytes)
    normalize(spark, f"{folder}/monolithic", f"{folder}/archives")
    write_index(spark, f"{folder}/archives", f"{folder}/index")
    return read_archives(spark, f"{folder}/archives", f"{folder}/index")
