"""Legacy web archives to WARC: ARC header lines and declared lengths in, equivalent WARC records out, and back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.llm.arrow import BYTES, ROWS, release, slices
from tideline.session import broadcast_if_small, shared_dir

#: Fixed by the ARC formats: the fields of a header line in each version.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
#: Fixed by the WARC format.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The HTTP field that carries a row's id through an archive.
KEY = "X-Row-Key"


def sha1(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload_of(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP header (with its empty line) and the body; a block that is no HTTP response is all body."""
    if block.startswith(b"HTTP/"):
        header, found, body = block.partition(b"\r\n\r\n")
        if found:
            return header + found, body
    return b"", block


def key_of(header: bytes) -> str | None:
    found = re.search(rb"(?mi)^" + KEY.encode() + rb":[ \t]*([^\r\n]*)", header)
    return unquote(found[1].decode()) if found else None


class Source:
    """Lines and blocks of an archive, plain or in any number of gzip members, with the place in what they hold."""

    def __init__(self, content: bytes, path: str):
        self.stream: BinaryIO = io.BytesIO(content)
        if content[:2] == b"\x1f\x8b":
            self.stream = io.BufferedReader(gzip.GzipFile(fileobj=self.stream))
        self.path, self.place = path, 0

    def line(self) -> bytes:
        line = self.stream.readline()
        self.place += len(line)
        return line

    def take(self, n: int) -> bytes:
        block = self.stream.read(n)
        self.place += len(block)
        if len(block) != n:
            raise self.wrong(f"ends {n - len(block)} bytes before a record does")
        return block

    def wrong(self, what: str) -> ValueError:
        return ValueError(f"{self.path} {what}, at byte {self.place}")


class Arc(NamedTuple):
    offset: int
    uri: str | None
    ip: str
    date: str
    kind: str
    block: bytes


def read_arc(source: Source) -> Iterator[Arc]:
    """The records of an ARC file but for its version block, which says how their header lines look.

    Lengths are as declared. Fields are taken from the right, so a URL may hold spaces.
    """
    fields: list[str] = []
    while True:
        offset, line = source.place, source.line()
        if not line:
            return
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        if not fields:
            if not line.startswith(b"filedesc://") or not line.rsplit(b" ", 1)[-1].isdigit():
                raise source.wrong("has no ARC version block")
            about = source.take(int(line.rsplit(b" ", 1)[1])).split(b"\n")
            version = int(about[0].split(b" ")[0]) if about[0][:1].isdigit() else 0
            if version not in ARC_FIELDS:
                raise source.wrong(f"has ARC version {version}")
            fields = ARC_FIELDS[version]
            continue
        cells = line.rsplit(b" ", len(fields) - 1)
        if len(cells) != len(fields) or not cells[-1].isdigit():
            raise source.wrong("has an unreadable ARC header line")
        given = dict(zip(fields, (c.decode("utf-8", "replace") for c in cells)))
        uri = given["URL"] if given["URL"] != "-" else None
        yield Arc(offset, uri, given["IP-address"], given["Archive-date"], given["Content-type"], source.take(int(cells[-1])))


def arc_header(version: int, uri: str | None, ip: str, date: str, kind: str, length: int, archive: str, status: str = "200") -> bytes:
    """A header line. Characters that a line cannot hold are percent-encoded; an absent URL is a dash."""
    plain = re.sub(r"[^\x21-\x7E]", lambda m: quote(m[0]), uri) if uri else "-"
    cells = [plain, ip, date, kind] + ([] if version == 1 else [status, "-", "-", "0", archive]) + [str(length)]
    return " ".join(cells).encode() + b"\n"


def arc_opening(version: int, archive: str, date: str) -> bytes:
    about = f"{version} 0 Tideline\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_header(version, f"filedesc://{archive}", "0.0.0.0", date, "text/plain", len(about), archive) + about + b"\n"


def record_id(path: str, offset: int) -> str:
    """The same for the same place of the same archive, so a repeated task writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}>"


def warc_date(digits: str) -> str:
    """A 14-digit date as WARC writes it; missing digits are the start of the period."""
    d = (re.sub(r"\D", "", digits) + "00000101000000"[min(14, len(re.sub(r"\D", "", digits))) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def warc_record(fields: Sequence[tuple[str, str | None]], block: bytes) -> bytes:
    head = [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def warc_opening(archive: str, date: str) -> bytes:
    block = b"software: Tideline\r\nformat: WARC File Format 1.1\r\n"
    kept = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(archive, 0)), ("WARC-Date", warc_date(date)), ("WARC-Filename", archive)]
    return warc_record([*kept, ("Content-Type", "application/warc-fields")], block)


def converted(row: dict) -> bytes:
    """The WARC record equal to an ARC record: a response, a resource if it is no HTTP message, or a revisit of ``first``."""
    block, first = row["block"], row["first"]
    header, body = payload_of(block)
    kind = "response" if header else "resource"
    fields = [("WARC-Record-ID", record_id(row["path"], row["offset"])), ("WARC-Date", warc_date(row["date"])), ("WARC-Target-URI", row["uri"])]
    fields += [("WARC-IP-Address", row["ip"] if row["ip"] not in ("0.0.0.0", "-") else None), ("WARC-Payload-Digest", f"sha1:{sha1(body)}")]
    if first:
        kind, block = "revisit", header
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Truncated", "length"), ("WARC-Refers-To", record_id(first["path"], first["offset"]))]
        fields += [("WARC-Refers-To-Target-URI", first["uri"]), ("WARC-Refers-To-Date", warc_date(first["date"]))]
    fields.append(("WARC-Block-Digest", f"sha1:{sha1(block)}"))
    return warc_record([("WARC-Type", kind), *fields, ("Content-Type", "application/http; msgtype=response" if header else row["kind"])], block)


class Warc(NamedTuple):
    offset: int
    fields: dict[str, str]
    block: bytes


def read_warc(source: Source) -> Iterator[Warc]:
    """All records of a WARC file. Field names are lower-cased; a record's block is as long as declared."""
    while True:
        offset, line = source.place, source.line()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise source.wrong("has no WARC version line where a record should begin")
        fields: dict[str, str] = {}
        while (line := source.line()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise source.wrong("has a record without a length")
        yield Warc(offset, fields, source.take(int(fields["content-length"])))


def _archived(df: DataFrame, folder: str, size: str, opening: Callable[[str], bytes], record: Callable[[dict], bytes], archive_bytes: int) -> None:
    """Write each task's rows as archives of about ``archive_bytes`` and at most one record more, through Spark's committer.

    ``size`` is the column that decides how many rows become Python objects at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, parts, held = 0, [], 0

        def close() -> pa.RecordBatch:
            # The writer ends each file with the line end that stands behind the last record anyway.
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1]], pa.binary())], names=["value"])

        for batch in batches:
            for part in slices(batch, size):
                for row in part.to_pylist():
                    if not parts:
                        parts.append(opening(f"{context.partitionId() if context else 0:05d}-{number:05d}"))
                    parts.append(record(row))
                    held += len(parts[-1])
                    if held >= archive_bytes:
                        yield close()
                        number, parts, held = number + 1, [], 0
        if parts:
            yield close()
        release()

    made = df.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    # Level three is a twentieth larger than the usual six in less than half the time.
    made.write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("zlib.compress.level", "THREE").text(folder)


def _records(spark: SparkSession, folder: str, schema: str, read: Callable[[Source], Iterator[tuple]]) -> DataFrame:
    """Rows of ``schema`` that ``read`` finds in each file of ``folder``."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    out = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for row in read(Source(content.as_py(), path.as_py())):
                    rows.append(row)
                    held += sum(len(c) for c in row if isinstance(c, bytes))
                    if held > BYTES or len(rows) >= ROWS:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)
        release()

    return files.mapInArrow(run, out)


def write_arc(
    df: DataFrame, folder: str, *, id: str = "page_id", url: str = "url", html: str = "html", captured: str = "20000101000000", version: int = 1, archive_bytes: int = 32 << 20
) -> None:
    """Write every row as an ARC record: an HTTP response whose body is ``html`` in UTF-8 (null: empty).

    The id travels in the HTTP field ``X-Row-Key`` (null: absent). Archives are gzip files.
    """
    rows = df.select(F.col(id).cast("string").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("html"))

    def record(row: dict) -> bytes:
        body = row["html"]
        head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
        head += [f"{KEY}: {quote(row['id'], safe='')}"] if row["id"] is not None else []
        block = "\r\n".join([*head, "", ""]).encode() + body
        return arc_header(version, row["url"], "0.0.0.0", captured, "text/html", len(block), "pages") + block + b"\n"

    _archived(rows, folder, "html", lambda archive: arc_opening(version, f"{archive}.arc", captured), record, archive_bytes)


def arc_records(spark: SparkSession, folder: str, *, blocks: bool = True) -> DataFrame:
    """The records of all ARC files (version 1 or 2, plain or gzip) in ``folder``.

    path, offset (in what the file holds), uri, ip, date, kind, key, payload_bytes, payload_digest and block
    (null without ``blocks``). A file that is cut off or malformed raises an error that names the place.
    """

    def read(source: Source) -> Iterator[tuple]:
        for r in read_arc(source):
            header, body = payload_of(r.block)
            yield source.path, r.offset, r.uri, r.ip, r.date, r.kind, key_of(header), len(body), sha1(body), r.block if blocks else None

    schema = "path string, offset long, uri string, ip string, date string, kind string, key string, payload_bytes long, payload_digest string, block binary"
    return _records(spark, folder, schema, read)


def convert(spark: SparkSession, arc: str, folder: str, *, id_type: str = "long", revisit_from: int = 0, captured: str = "20000101000000", archive_bytes: int = 32 << 20) -> None:
    """Write the WARC equivalents of all ARC files in ``arc`` to ``folder``.

    Of records with equal payloads of at least ``revisit_from`` bytes, the one with the smallest key (as
    ``id_type``; null keys last, then path and offset) keeps the payload and the others become revisits
    of it. First passes over the archives only give digests; which payloads repeat is added up by digest
    before and after one shuffle. That table is broadcast if it is small (measured), so no payload is
    shuffled; beyond that the join shuffles, and Spark splits a digest that many share.
    """
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key").cast(id_type).alias("key"), "path", "offset", "uri", "date")
    seen = arc_records(spark, arc, blocks=False).filter(F.col("payload_bytes") >= revisit_from)
    repeated = seen.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).filter("n > 1").drop("n")
    name = shared_dir(spark, "warc-repeated")
    repeated.write.parquet(name)
    repeated = spark.read.schema(repeated.schema).parquet(name)
    rows = arc_records(spark, arc).join(broadcast_if_small(repeated), "payload_digest", "left")
    itself = (F.col("first.path") == F.col("path")) & (F.col("first.offset") == F.col("offset"))
    again = (F.col("payload_bytes") >= revisit_from) & ~itself
    first = F.when(again, F.struct("first.path", "first.offset", "first.uri", "first.date"))
    rows = rows.select("path", "offset", "uri", "ip", "date", "kind", "block", first.alias("first"))
    _archived(rows, folder, "block", lambda archive: warc_opening(f"{archive}.warc", captured), converted, archive_bytes)


def warc_records(spark: SparkSession, folder: str, *, blocks: bool = True) -> DataFrame:
    """The records of all WARC files (plain or gzip) in ``folder``, but for warcinfo.

    path, offset, record_id, type, uri, date, refers_to (a record id), key, payload_bytes and payload_digest
    (of what the record holds; those of a revisit are null and as declared), and block (null without ``blocks``).
    A digest that contradicts the payload raises an error, as do cut off or malformed files.
    """

    def read(source: Source) -> Iterator[tuple]:
        for offset, fields, block in read_warc(source):
            kind = fields.get("warc-type")
            if kind == "warcinfo":
                continue
            header, body = payload_of(block)
            size, digest = len(body), fields.get("warc-payload-digest", "").removeprefix("sha1:")
            if kind == "revisit":
                size = None
            elif digest not in ("", sha1(body)):
                raise source.wrong("has a payload that its digest contradicts")
            else:
                digest = sha1(body)
            common = fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-refers-to")
            yield source.path, offset, *common, key_of(header), size, digest or None, block if blocks else None

    schema = "path string, offset long, record_id string, type string, uri string, date string, refers_to string, key string, payload_bytes long, payload_digest string, block binary"
    return _records(spark, folder, schema, read)


def archive(df: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0, version: int = 1, archive_bytes: int = 32 << 20) -> DataFrame:
    """Archive every row as ARC, convert that to WARC, and say what the WARC files hold, one row per row of ``df``.

    Returns the id, payload_bytes and payload_digest (bare upper-case base32 SHA-1, both of the full
    payload), record_type (response or revisit), refers_to (the response's id) and record_id. Files stay below
    the shared folder of the session.

    A null html is an empty payload. A null url has no target URI. Rows of one id are records of their own; of
    those with equal payloads one is the response. A null id is later than all others; a revisit of its record
    has a null refers_to. A very long html is one record of an archive of its own. An empty table gives no
    rows. Other columns are left out.
    """
    spark = df.sparkSession
    kind = df.schema[id].dataType.simpleString()
    arc, folder = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_arc(df, arc, id=id, url=url, html=html, version=version, archive_bytes=archive_bytes)
    convert(spark, arc, folder, id_type=kind, revisit_from=revisit_from, archive_bytes=archive_bytes)
    name = shared_dir(spark, "warc-records")
    found = warc_records(spark, folder, blocks=False).select(F.col("key").cast(kind).alias("id"), "record_id", "type", "refers_to", "payload_bytes", "payload_digest")
    found.write.parquet(name)
    found = spark.read.schema(found.schema).parquet(name)
    columns = ["payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    responses = found.filter("type <> 'revisit'")
    target = responses.select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("size"), F.col("id").alias("target"))
    revisits = found.filter("type = 'revisit'").join(target, "refers_to", "left").withColumn("payload_bytes", F.col("size"))
    out = F.col("id").alias(id)
    whole = responses.select(out, *columns, F.lit(None).cast(kind).alias("refers_to"), "record_id")
    return whole.unionByName(revisits.select(out, *columns, F.col("target").alias("refers_to"), "record_id"))
