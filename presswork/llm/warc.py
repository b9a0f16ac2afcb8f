"""Legacy archives: ARC files of version 1 and 2 converted to WARC.

An ARC file begins with a ``filedesc:`` record whose block names its version
and the fields of the header lines; each record is a header line, the declared
number of bytes, and a line feed. The converter reads the fields by the names
that the file gives (version 1: five, version 2: ten), takes exactly the
declared bytes, and makes for each record the WARC equivalents: a name-based
UUID, an ISO timestamp from the 14 digits, a type (``warcinfo`` for the file
description, ``response`` for HTTP messages, else ``resource``) and SHA-256
digests of block and payload. Responses whose payload of at least
``least_bytes`` bytes is that of a record with a smaller id become ``revisit``
records, which carry the HTTP head only.

Archives are rows ``(path, content)``, as Spark's ``binaryFile`` source gives
them, plain or gzipped. WARC files are written by Spark's text writer with the
record separator as line separator: a file is a run of whole records, gzipped,
on whatever store the path names.

Defined results: a null payload is empty; a null or empty url is written as
``urn:null``; blanks and control characters of a url are percent-encoded; a
null id leaves out the id header and sorts last; rows equal in all columns are
one capture and get the same record id and type. A header line that does not
fit the file's fields, or a declared length beyond the end of the file, ends
that file with one row of type ``malformed``; what stood before is kept. Empty
tables write no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import cut_lineage
from presswork.session import checkpoint_dir

#: Field names of ARC header lines by version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
END = b"\r\n\r\n"
ID_HEADER = "X-Page-Id"
_BAD = re.compile(r"[\x00-\x20\x7f]")
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-to-warc")


# --- ARC -----------------------------------------------------------------

def _clean_url(url: str | None) -> str:
    return _BAD.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:null"


def arc_bytes(name: str, records: Iterable[tuple[str, str, str, int, bytes]], version: int = 1, date: str = "20240101000000") -> bytes:
    """An ARC file of ``(url, date, content type, result code, body)`` records."""
    out = io.BytesIO()
    block = (f"{version} 0 presswork\n" + " ".join(ARC_FIELDS[version]) + "\n").encode()

    def line(url, when, kind, code, length):
        if version == 1:
            return f"{url} 0.0.0.0 {when} {kind} {length}\n".encode()
        return f"{url} 0.0.0.0 {when} {kind} {code} - - {out.tell()} {name} {length}\n".encode()

    out.write(line(f"filedesc://{name}", date, "text/plain", 200, len(block)) + block)
    for url, when, kind, code, body in records:
        out.write(b"\n")
        out.write(line(url, when, kind, code, len(body)))
        out.write(body)
    out.write(b"\n")
    return out.getvalue()


def _runs(sizes: np.ndarray, records: int, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs of at most ``records`` rows of ``most_bytes`` together, or one larger row."""
    ends, a = np.concatenate([[0], np.cumsum(sizes)]), 0
    while a < len(sizes):
        b = min(a + records, max(a + 1, int(np.searchsorted(ends, ends[a] + most_bytes, "right")) - 1))
        yield a, b
        a = b


def pages_to_arc(pages: DataFrame, version: int = 1, records: int = 400, id_col: str = "page_id", url: str = "url",
                 html: str = "html", date: str = "20240101000000", most_bytes: int = 64 << 20) -> DataFrame:
    """Archives ``(path, content)`` of the pages of each task, at most
    ``records`` and ``most_bytes`` of html to a file (a larger page has its
    own); the id is a header of the archived HTTP response."""

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            for a, b in _runs(sizes, records, most_bytes):
                part = batch.slice(a, b - a)
                name = f"pages-{hashlib.sha256(repr(part.column(0).to_pylist()).encode()).hexdigest()[:16]}.arc"
                rows = []
                for i, u, h in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    body = h or b""
                    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"{ID_HEADER}: {i}\r\n" if i is not None else "")
                    rows.append((_clean_url(u), date, "text/html", 200, f"{head}Content-Length: {len(body)}\r\n\r\n".encode() + body))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_bytes(name, rows, version, date)], pa.binary())], names=["path", "content"])

    return (pages.select(F.col(id_col).cast("string"), F.col(url), F.col(html).cast("binary"))
            .mapInArrow(run, "path string, content binary"))


class Malformed(ValueError):
    pass


def _open(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def parse_arc(content: bytes) -> Iterator[tuple[int, dict[str, str], int, bytes]]:
    """Version, fields by name, offset and body of each record of an ARC file."""
    f = _open(content)

    def body_of(fields: dict[str, str]) -> bytes:
        n = fields.get("Archive-length", "")
        if not n.isdigit():
            raise Malformed(f"declared length {n!r}")
        body = f.read(int(n))
        if len(body) != int(n):
            raise Malformed(f"{len(body)} of {n} declared bytes")
        return body

    first = f.readline().decode("utf-8", "replace").rstrip("\r\n").split(" ")
    if not first[0].startswith("filedesc:") or len(first) not in (len(ARC_FIELDS[1]), len(ARC_FIELDS[2])):
        raise Malformed("no file description")
    # the length of the description is its last field in either version
    names = ARC_FIELDS[1] if len(first) == len(ARC_FIELDS[1]) else ARC_FIELDS[2]
    fields = dict(zip(names, first, strict=True))
    block = body_of(fields)
    lines = block.decode("utf-8", "replace").splitlines()
    version = lines[0].split(" ")[0] if lines else ""
    if version not in ("1", "2"):
        raise Malformed(f"version {version!r}")
    names = tuple(lines[1].split(" ")) if len(lines) > 1 and lines[1].startswith("URL ") else ARC_FIELDS[int(version)]
    yield int(version), fields, 0, block
    while True:
        at, line = f.tell(), f.readline()
        if not line:
            return
        if line in (b"\n", b"\r\n"):
            continue
        got = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(names) - 1)
        if len(got) != len(names):
            raise Malformed(f"header line with {len(got)} of {len(names)} fields")
        fields = dict(zip(names, got, strict=True))
        yield int(version), fields, at, body_of(fields)


def iso_date(digits: str) -> str:
    """``20240131235959`` as ``2024-01-31T23:59:59Z``; missing digits are the least."""
    d = digits if digits.isdigit() and 4 <= len(digits) <= 14 else "1970"
    d = d + "00000101000000"[len(d):] if len(d) in (4, 6, 8, 10, 12, 14) else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _http(body: bytes) -> tuple[bytes, bytes] | None:
    if not body.startswith(b"HTTP/"):
        return None
    head, end, payload = body.partition(END)
    return (head + end, payload) if end else (body, b"")


def _header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?mi)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m else None


_CONVERTED = ("path string, arc_version int, record_id string, warc_type string, uri string, date string, mime string, "
              "page_key string, head binary, payload binary, payload_bytes long, payload_digest string, error string")


def convert(path: str, content: bytes) -> Iterator[tuple]:
    """Rows of ``_CONVERTED`` for the records of one ARC file."""
    try:
        for version, f, at, body in parse_arc(content):
            uri, mime = f["URL"], f.get("Content-type", "application/octet-stream")
            http = None if at == 0 else _http(body)
            head, payload = http or (b"", body)
            kind = "warcinfo" if at == 0 else "response" if http else "resource"
            digest = hashlib.sha256(payload).hexdigest()
            key = _header(head, ID_HEADER)
            name = f"{uri} {f.get('Archive-date', '')} {key} {digest}" if at else f"{path} {digest}"
            yield (path, version, f"urn:uuid:{uuid.uuid5(_SPACE, name)}", kind, uri, iso_date(f.get("Archive-date", "")), mime,
                   key, head, payload, len(payload), digest, None)
    except (Malformed, EOFError, OSError) as e:
        yield (path, None, None, "malformed", None, None, None, None, None, None, None, None, str(e)[:200])


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    cols = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), kinds[k]) for x, (_, k) in zip(zip(*rows, strict=True), cols, strict=True)],
                                      names=[c for c, _ in cols])


def _by_archive(schema: str, one, batches, limit: int = 4 << 20):
    """Rows of each archive in batches of a few MB."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got, size = [], 0
            for row in one(path, content or b""):
                got.append(row)
                size += sum(len(x) for x in row if isinstance(x, bytes))
                if size > limit or len(got) >= 4096:
                    yield _rows(schema, got)
                    got, size = [], 0
            if got:
                yield _rows(schema, got)


def convert_archives(archives: DataFrame) -> DataFrame:
    """The records of ARC files as WARC fields, a row for each."""
    return archives.select("path", "content").mapInArrow(lambda it: _by_archive(_CONVERTED, convert, it), _CONVERTED)


# --- revisits ------------------------------------------------------------

def headers(records: DataFrame) -> DataFrame:
    """What decides of records, without their payloads; written, so that the
    archives are not parsed for each reader."""
    return cut_lineage(records.select("record_id", "warc_type", "uri", "date", "page_key", "payload_bytes", "payload_digest"))


def with_revisits(records: DataFrame, least_bytes: int = 100, order: str = "bigint", known: DataFrame | None = None) -> DataFrame:
    """Records with ``refers_to_id`` and the id of the record referred to;
    ``known``: their ``headers``.

    First the digests alone are grouped (partial aggregation, so a payload in
    a third of all records meets in one row a task); the payloads then meet
    their decision by record id, which spreads them evenly.
    """
    key = F.col("page_key").cast(order)
    known = headers(records) if known is None else known
    small = (known.where((F.col("warc_type") == "response") & (F.col("payload_bytes") >= least_bytes))
             .select("record_id", "payload_digest", "uri", "date", key.alias("key")))
    first = small.groupBy("payload_digest").agg(
        F.min(F.struct(F.col("key").isNull().alias("last"), "key", "record_id", "uri", "date")).alias("f"))
    refer = (small.join(first, "payload_digest")
             .where(F.when(F.col("f.key").isNull(), F.col("f.record_id") != F.col("record_id")).otherwise(~F.col("key").eqNullSafe(F.col("f.key"))))
             .groupBy("record_id").agg(F.min("f").alias("f"))
             .select("record_id", F.col("f.record_id").alias("refers_to_id"), F.col("f.uri").alias("refers_to_uri"), F.col("f.date").alias("refers_to_date")))
    return records.join(refer, "record_id", "left")


# --- WARC ----------------------------------------------------------------

_IN = ("record_id", "warc_type", "uri", "date", "mime", "head", "payload", "payload_digest", "refers_to_id", "refers_to_uri", "refers_to_date")


def warc_record(record_id, kind, uri, date, mime, head, payload, digest, refers_id, refers_uri, refers_date) -> bytes:
    """One WARC record without the two line ends that close it."""
    head, payload = head or b"", payload or b""
    revisit = refers_id is not None
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if kind != "warcinfo":
        lines.append(f"WARC-Target-URI: {uri}")
        lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{refers_id}>", f"WARC-Refers-To-Target-URI: {refers_uri}", f"WARC-Refers-To-Date: {refers_date}"]
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              "Content-Type: " + ("application/http;msgtype=response" if kind == "response" else "application/warc-fields" if kind == "warcinfo" else mime),
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


#: A WARC file is read back as one value: bytes of payloads in a file, and the
#: size from which a payload is written to files of fewer records.
FILE_BYTES, LARGE = 1 << 30, 256 << 10


def write_bounded(records: DataFrame, path: str, largest: int) -> None:
    """Writes WARC files of at most ``FILE_BYTES`` of payloads (one larger payload
    has its own), given the ``largest`` payload's size: payloads up to ``LARGE``
    first, the others, where there are any, with fewer to a file."""
    size = F.coalesce("payload_bytes", F.lit(0))
    if largest <= LARGE:
        write_warc(records, path, FILE_BYTES // LARGE)
    else:
        write_warc(records.where(size <= LARGE), path, FILE_BYTES // LARGE)
        write_warc(records.where(size > LARGE), path, max(1, FILE_BYTES // largest), "append")


def write_warc(records: DataFrame, path: str, records_per_file: int = 4096, mode: str = "errorifexists") -> None:
    """Writes gzipped WARC files to the folder ``path``."""

    def run(batches):
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for a in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array([warc_record(*x) for x in rows[a:a + 256]], pa.binary())], names=["value"])

    raw = records.where("warc_type <> 'malformed'").select(*_IN).mapInArrow(run, "value binary")
    # a binary cast to string keeps its bytes, whatever they are
    (raw.select(F.col("value").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).mode(mode).text(path))


_READ = ("path string, record_id string, record_type string, uri string, date string, page_key string, "
         "payload_bytes long, payload_digest string, declared_digest string, refers_to_id string, error string")


def parse_warc(path: str, content: bytes) -> Iterator[tuple]:
    """Rows of ``_READ``; digest and size are those of the bytes read (null for
    revisits, which have no payload of their own)."""
    f = _open(content)
    try:
        while line := f.readline():
            if line in (b"\r\n", b"\n"):
                continue
            if not line.startswith(b"WARC/"):
                raise Malformed("no WARC version line")
            h = {}
            while (line := f.readline()) not in (b"\r\n", b"\n", b""):
                k, _, v = line.decode("utf-8", "replace").partition(":")
                h[k.strip().lower()] = v.strip()
            n = int(h.get("content-length", "-1"))
            block = f.read(n) if n >= 0 else b""
            if n < 0 or len(block) != n:
                raise Malformed(f"{len(block)} of {n} declared bytes")
            http = _http(block)
            head, payload = http or (b"", block)
            kind = h.get("warc-type")
            own = kind != "revisit"
            yield (path, h.get("warc-record-id", "")[1:-1], kind, h.get("warc-target-uri"), h.get("warc-date"), _header(head, ID_HEADER),
                   len(payload) if own else None, hashlib.sha256(payload).hexdigest() if own else None,
                   h.get("warc-payload-digest", "").removeprefix("sha256:") or None, h["warc-refers-to"][1:-1] if "warc-refers-to" in h else None, None)
    except (Malformed, EOFError, OSError, ValueError) as e:
        yield (path, None, "malformed", None, None, None, None, None, None, None, str(e)[:200])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(lambda it: _by_archive(_READ, parse_warc, it), _READ)


def archive_pages(pages: DataFrame, version: int = 2, path: str | None = None, least_bytes: int = 100, id_col: str = "page_id") -> DataFrame:
    """Pages through ARC archives, the converter and WARC files, read back:
    page_id, payload_bytes, payload_digest, record_type, refers_to, record_id.
    The WARC files stay in ``path`` (default: a new folder in the checkpoint folder)."""
    spark, kind = pages.sparkSession, dict(pages.dtypes)[id_col]
    path = path or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = convert_archives(pages_to_arc(pages, version, id_col=id_col))
    known = headers(records)
    largest = known.agg(F.max("payload_bytes")).first()[0] or 0
    write_bounded(with_revisits(records, least_bytes, kind, known), path, largest)
    back = read_warc(spark, path).where("record_type in ('response', 'revisit', 'malformed')")
    back = back.withColumn("ok", F.when(F.col("record_type") == "malformed", F.raise_error(F.concat(F.lit("archive read back with an error: "), F.col("error"))).cast("boolean"))
                           .when(F.col("payload_digest") != F.col("declared_digest"), F.raise_error(F.lit("payload differs from its declared digest")).cast("boolean"))
                           .otherwise(F.lit(True))).where("ok")
    # the archives are parsed once for the readers below
    back = cut_lineage(back.select("record_id", "record_type", "page_key", "payload_bytes", "payload_digest", "declared_digest", "refers_to_id"))
    key = F.col("page_key").cast(kind)
    own = back.where("record_type = 'response'").select(key.alias("page_id"), "payload_bytes", "payload_digest",
                                                        "record_type", F.lit(None).cast(kind).alias("refers_to"), "record_id")
    first = own.groupBy("record_id").agg(F.min("payload_bytes").alias("payload_bytes"), F.min("page_id").alias("refers_to"))
    again = (back.where("record_type = 'revisit'").select(key.alias("page_id"), F.col("declared_digest").alias("payload_digest"), "record_type",
                                                          F.col("record_id"), F.col("refers_to_id"))
             .join(first.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left"))
    return own.unionByName(again.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"))
