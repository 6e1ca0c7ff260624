"""Legacy archive converter: ARC files to WARC files.

``write_arc`` stores pages as ARC files, version 1 or 2; ``read_arc`` parses
ARC files by their version block, version-specific header lines and declared
lengths; ``convert`` synthesises WARC records from them (identifier, date,
type, digests) and writes WARC files; ``read_warc`` reads those back.  Lengths
are trusted, never searched for: a payload may contain header lines.

A payload of ``MIN_REVISIT`` bytes or more that occurs several times is stored
once: the record with the smallest page id (then archive name and offset, ids
that are null last) is the ``response``, the others are ``revisit`` records
without payload that name it.

Files are gzip text files, written at the codec's fastest level; each holds at
most ``records`` records, as many as come to about ``FILE_BYTES`` at the mean
payload size unless the caller says otherwise, so a file fits in memory when
read.  Defined cases: null or empty html is an empty
payload; a null url is written as ``-``; white space in a url is percent-coded;
a null page id has no header and comes back null; an ARC date that is no date
becomes 1970-01-01; a wrong declared length or header raises ``ValueError``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewarden.llm.common import shared_path, stored

# Fixed by the ARC file format: field names of the two URL-record versions.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"),
}
MIN_REVISIT = 100
FILE_BYTES = 128 << 20           # raw bytes of a file, about
HEAD_BYTES = 600                 # of a record beside its payload
FASTEST = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
ARC_SCHEMA = ("archive string, place long, url string, ip string, date string, mime string, status int, head binary, "
              "payload binary, digest string, size long, page_id long")
WARC_SCHEMA = ("page_id long, record_id string, type string, url string, date string, payload_bytes long, "
               "payload_digest string, refers_to long, refers_to_record string, payload binary")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _batches(rows, ddl: str, most: int = 200, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    schema, batch, size = _schema(ddl), [], 0
    for row in rows:
        batch.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(batch) == most or size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*batch), schema)], schema=schema)
            batch, size = [], 0
    if batch:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*batch), schema)], schema=schema)


def _spaceless(s: str | None) -> str:
    s = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", s or "")
    return s or "-"


def records_for(rows: DataFrame, size) -> int:
    """Records of a file of about ``FILE_BYTES``, from the mean payload size."""
    mean = rows.agg(F.avg(size).alias("mean")).first()["mean"] or 0
    return max(1, int(FILE_BYTES // (mean + HEAD_BYTES)))


# -- writing ARC ---------------------------------------------------------------

def version_block(name: str, version: int, date: str) -> bytes:
    """First record of an ARC file, without the line end that closes it."""
    body = f"{version} 0 slicewarden\n{' '.join(FIELDS[version])}\n"
    head = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    head += [] if version == 1 else ["200", "-", "-", "0", name]
    return f"{' '.join([*head, str(len(body))])}\n{body}".encode()


def arc_record(page_id, url, payload: bytes, name: str, version: int, date: str) -> bytes:
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n" + (f"X-Page-Id: {page_id}\r\n" if page_id is not None else "") + "\r\n"
    doc = http.encode() + payload
    head = [_spaceless(url), "0.0.0.0", date, "text/html"]
    head += [] if version == 1 else ["200", "-", "-", "0", name]
    return " ".join([*head, str(len(doc))]).encode() + b"\n" + doc


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000", versions: tuple[int, ...] = (1, 2),
              records: int | None = None) -> None:
    """Pages (page_id, url, html) as ARC files under ``path``; the tasks take
    turns in the format version.  Each file opens with its version block."""
    records = records or records_for(pages, F.coalesce(F.octet_length("html"), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = versions[part % len(versions)]

        def rows():
            n = 0
            for batch in batches:
                for page_id, url, html in zip(*[batch.column(c) for c in range(3)]):
                    name = f"part-{part:05d}-{n // records:05d}.arc"
                    if n % records == 0:
                        yield (version_block(name, version, date),)
                    n += 1
                    payload = html.as_buffer().to_pybytes()
                    yield (arc_record(page_id.as_py(), url.as_py(), payload, name, version, date),)

        yield from _batches(rows(), "value binary")

    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
     .mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.options(**FASTEST).option("lineSep", "\n").option("maxRecordsPerFile", records + 1).text(path))


# -- reading ARC ---------------------------------------------------------------

def parse_arc(stream, name: str) -> Iterator[tuple]:
    """Rows of ``ARC_SCHEMA`` from one uncompressed ARC stream."""
    fields, place, offset = None, 0, 0
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\n", b"\r\n"):                # closes the record before
            offset += len(line)
            continue
        values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        try:
            length = int(values[-1])
        except ValueError:
            raise ValueError(f"{name} at {offset}: no length in {line[:200]!r}") from None
        body = stream.read(length)
        if length < 0 or len(body) < length:
            raise ValueError(f"{name} at {offset}: {length} bytes declared, {len(body)} there")
        start, offset = offset, offset + len(line) + length
        if values[0].startswith("filedesc:"):
            version, names = body.decode("utf-8", "replace").split("\n")[:2]
            try:
                fields = FIELDS[int(version.split(" ")[0])]
            except (KeyError, ValueError):
                raise ValueError(f"{name}: ARC version {version!r} is not known") from None
            if tuple(names.rstrip("\r").split(" ")) != fields:
                raise ValueError(f"{name}: fields {names!r} are not those of version {version!r}")
            continue
        if fields is None:
            raise ValueError(f"{name}: no version block")
        if len(values) != len(fields):
            raise ValueError(f"{name} at {start}: {len(values)} fields, version has {len(fields)}")
        got = dict(zip(fields, values))
        head, payload, status, page_id = b"", body, None, None
        if body.startswith(b"HTTP/"):
            end = body.find(b"\r\n\r\n")
            head, payload = (body, b"") if end < 0 else (body[:end + 4], body[end + 4:])
            first = head.split(b"\r\n", 1)[0].split()
            status = int(first[1]) if len(first) > 1 and first[1].isdigit() else None
            m = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
            page_id = int(m[1]) if m else None
        if status is None and got.get("Result-code", "").isdigit():
            status = int(got["Result-code"])
        yield (name, place, got["URL"], got["IP-address"], got["Archive-date"], got["Content-type"], status, head,
               payload, hashlib.sha256(payload).hexdigest(), len(payload), page_id)
        place += 1


def _stream(content: bytes):
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the ARC files under ``path`` (plain or gzip)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for r in parse_arc(_stream(content.as_buffer()), name.rsplit("/", 1)[-1]):
                        yield r if payloads else (*r[:7], None, None, *r[9:])

        yield from _batches(rows(), ARC_SCHEMA)

    return _files(spark, path).mapInArrow(run, ARC_SCHEMA)


# -- ARC to WARC ---------------------------------------------------------------

def warc_date(arc_date: str) -> str:
    """ISO date of a 14-digit ARC date; shorter ones are filled up."""
    d = arc_date + "00000101000000"[len(arc_date):] if arc_date.isdigit() and 4 <= len(arc_date) <= 14 else ""
    m = re.fullmatch(r"(\d{4})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])([01]\d|2[0-3])([0-5]\d)([0-5]\d)", d)
    return "{}-{}-{}T{}:{}:{}Z".format(*m.groups()) if m else "1970-01-01T00:00:00Z"


def record_id(url: str, date: str, archive: str, place: int, digest: str) -> str:
    """Identifier that is the same whenever the record is converted."""
    return "urn:uuid:" + str(uuid.uuid5(uuid.NAMESPACE_URL, "\n".join([url, date, archive, str(place), digest])))


def warc_record(r: dict) -> bytes:
    """WARC record of an ARC row; ``first_*`` names the response of a revisit."""
    http = r["head"].startswith(b"HTTP/")
    revisit = r["first_place"] is not None
    kind = "revisit" if revisit else "response" if http or r["url"].startswith("dns:") else "resource"
    block = r["head"] + (b"" if revisit else r["payload"])
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {r['url']}", f"WARC-Date: {warc_date(r['date'])}",
             f"WARC-Record-ID: <{record_id(r['url'], r['date'], r['archive'], r['place'], r['digest'])}>",
             f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha256:{r['digest']}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             f"Content-Type: {'application/http;msgtype=response' if http else r['mime']}",
             f"X-Payload-Length: {r['size']}"]
    if r["page_id"] is not None:
        lines.append(f"X-Page-Id: {r['page_id']}")
    if revisit:
        first = record_id(r["first_url"], r["first_date"], r["first_archive"], r["first_place"], r["digest"])
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{first}>", f"WARC-Refers-To-Target-URI: {r['first_url']}",
                  f"WARC-Refers-To-Date: {warc_date(r['first_date'])}"]
        if r["first_page_id"] is not None:
            lines.append(f"X-Refers-To-Page-Id: {r['first_page_id']}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def convert(spark: SparkSession, arc_path: str, warc_path: str, records: int | None = None) -> None:
    """Write the ARC files under ``arc_path`` as WARC files to ``warc_path``."""
    index = stored(read_arc(spark, arc_path, payloads=False).drop("head", "payload"), "index")
    records = records or records_for(index, F.col("size"))
    index = index.where(F.col("size") >= MIN_REVISIT)
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "archive", "place", "url", "date")
    firsts = stored(index.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("digest", "first"), "firsts")
    # Both sides are plain reads, so a payload with very many copies is split.
    rows = read_arc(spark, arc_path).join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~((F.col("archive") == F.col("first.archive"))
                                           & (F.col("place") == F.col("first.place")))
    names = [f.split()[0] for f in ARC_SCHEMA.split(", ")]
    firsts_of = ("page_id", "archive", "place", "url", "date")
    rows = rows.select(*names, *[F.when(again, F.col(f"first.{c}")).alias(f"first_{c}") for c in firsts_of])
    keys = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            n = 0
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
                for values in zip(*cols):
                    if n % records == 0:
                        body = b"software: slicewarden\r\nformat: WARC File Format 1.1\r\n"
                        part = f"{TaskContext.get().partitionId()}-{n // records}"
                        yield (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Record-ID: "
                               f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, part)}>\r\nContent-Type: application/warc-fields"
                               f"\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body,)
                    n += 1
                    yield (warc_record(dict(zip(keys, values))),)

        yield from _batches(out(), "value binary")

    # The text writer ends every record with the separator, WARC's record end.
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.options(**FASTEST).option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records + 1)
     .text(warc_path))


def parse_warc(stream, name: str) -> Iterator[tuple]:
    """Rows of ``WARC_SCHEMA`` from one uncompressed WARC stream; digests and
    lengths are checked."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"{name}: {line[:80]!r} where a record should begin")
        head = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            head[key.lower()] = value.strip()
        length = int(head["content-length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{name}: record {head.get('warc-record-id')} does not end where it declares")
        if head["warc-type"] == "warcinfo":
            continue
        if "sha256:" + hashlib.sha256(block).hexdigest() != head["warc-block-digest"]:
            raise ValueError(f"{name}: block digest of {head['warc-record-id']} differs")
        digest, size, payload = head["warc-payload-digest"].partition(":")[2], int(head["x-payload-length"]), None
        if head["warc-type"] != "revisit":
            at = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
            payload = block[at:]
            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                raise ValueError(f"{name}: payload of {head['warc-record-id']} differs from its digest")

        def number(key):
            return int(head[key]) if key in head else None

        yield (number("x-page-id"), head["warc-record-id"], head["warc-type"], head["warc-target-uri"],
               head["warc-date"], size, digest, number("x-refers-to-page-id"), head.get("warc-refers-to"), payload)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the WARC files under ``path``, checked against their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for r in parse_warc(_stream(content.as_buffer()), name.rsplit("/", 1)[-1]):
                        yield r if payloads else (*r[:9], None)

        yield from _batches(rows(), WARC_SCHEMA)

    return _files(spark, path).mapInArrow(run, WARC_SCHEMA)


def archive_pages(pages: DataFrame, records: int | None = None) -> tuple[str, str]:
    """Write pages as ARC files and convert those; returns both folders."""
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc, records=records)
    convert(spark, arc, warc, records)
    return arc, warc
