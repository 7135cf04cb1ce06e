"""WARC archives with an index that is written first and read by byte ranges.

Writing: every task streams its rows into archives of its own (a new one after
``ARCHIVE_BYTES``) and returns an index row per record: file, offset, length, URL, payload
digest, type. The index is written as a table, and only archives that it names count, so
files of failed or repeated tasks are never read. Of records with equal payloads of at least
``LEAST_BYTES`` the one with the smallest page_id holds the payload (``response``), the
others are ``revisit`` records that refer to it. The payload of a page that thousands share
is a hot key: the ``HEAVY`` most frequent digests are matched by a bounded broadcast, and
their rows are spread over the shuffle that matches the rest.

Reading: index rows are selected first, sorted by file and offset over range partitions of about
``TASK_BYTES`` of records; neighbouring byte ranges (gaps up to ``GAP_BYTES``) are read in one request of at most
``READ_BYTES`` and cut into records again. A revisit's payload facts come from the
response that it refers to, over salted keys, since one response can have most revisits.

Archives are opened through pyarrow's file systems (local, hdfs, s3, gs), in the shared folder.

Rows: a null html is an empty payload, and payloads under ``LEAST_BYTES`` are all responses. A null url has no
target header; other URLs are percent-encoded where a header line could not hold them (the index has them as
they are). Null page_ids come after all others and have no page header. Of rows that tie for the smallest id
(repeated rows) one is the response, the others revisit it. Payloads of any length are written whole; a record is
held in memory once. An empty table gives an empty index and result. Extra columns are ignored. The pages
must be read from files or be written before, so that positions stay when a task is repeated.
"""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import written
from clickweave.session import shared_path

LEAST_BYTES = 100
HEAVY = 1024
SALT_ROWS = 10_000
ARCHIVE_BYTES = 1 << 30
GAP_BYTES, READ_BYTES, BATCH_BYTES, TASK_BYTES = 64 << 10, 8 << 20, 16 << 20, 32 << 20

INDEX = "file string, offset long, length long, url string, digest string, record_type string, page_id long, refers_to long, copies long"
RECORD = "file string, offset long, record_type string, page_id long, refers_to long, payload_digest string, copies long, payload binary"
# Header names and the profile of the public WARC 1.1 format.
VERSION, PROFILE, DATE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))
BREAK = b"\r\n"


def file_system(uri: str):
    """The pyarrow file system of a path or URI, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/(?!/)", "file:///", uri)))


# ---- one record ----

def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The record's bytes. A revisit holds the HTTP header alone."""
    block = HTTP + b"Content-Length: %d" % len(payload) + BREAK * 2 + payload if kind == "response" else HTTP + BREAK
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>", "WARC-Date": DATE,
              "WARC-Target-URI": None if url is None else quote(url, safe=PRINTABLE), "WARC-Payload-Digest": f"sha256:{digest}",
              "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    if kind == "revisit":
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{'' if refers_to is None else refers_to}>"}
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items() if v is not None)]
    return BREAK.join(lines) + BREAK * 2 + block + BREAK * 2


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (empty for a revisit) of one record's bytes."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    head, _, rest = raw.partition(BREAK * 2)
    version, *lines = head.split(BREAK)
    fields = dict(line.decode().split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if version != VERSION or rest[size:] != BREAK * 2:
        raise ValueError("not a WARC record")
    return fields, rest[:size].partition(BREAK * 2)[2] if fields["WARC-Type"] == "response" else b""


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# ---- writing ----

def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, copies, record_type, refers_to of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"), F.monotonically_increasing_id().alias("row"))
    order = F.struct(F.col("page_id").isNull().alias("late"), "page_id", "row")
    first = written(rows.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("digest")
                    .agg(F.min(order).alias("first"), F.count("*").alias("copies")).where("copies > 1"), "first")
    heavy = first.orderBy(F.desc("copies"), "digest").limit(HEAVY).select("digest", F.col("first").alias("first_h"), F.col("copies").alias("copies_h"))
    # Rows that are matched, or have nothing to match, are dealt by their position.
    settled = F.col("copies_h").isNotNull() | (F.octet_length("payload") < LEAST_BYTES)
    here = (rows.join(F.broadcast(heavy), "digest", "left")
            .withColumn("key", F.when(settled, F.concat(F.lit("row "), F.col("row").cast("string"))).otherwise(F.col("digest"))))
    light = first.select(F.col("digest").alias("key"), F.col("first").alias("first_l"), F.col("copies").alias("copies_l"))
    head = F.coalesce("first_h", "first_l")
    again = head["row"] != F.col("row")
    return here.join(light, "key", "left").select(
        "page_id", "url", "payload", "digest", F.coalesce("copies_h", "copies_l", F.lit(1)).alias("copies"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, head["page_id"]).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, compress: bool = False, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives and return their index. ``compress`` makes each record a gzip member."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    rows = marked(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index: list[tuple] = []
                cols = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "copies", "record_type", "refers_to")]
                for values in zip(*cols, strict=True):
                    page, url, payload, digest, copies, kind, refers = (v.as_py() for v in values)
                    raw = record(kind, page, url, payload, digest, refers)
                    if compress:
                        raw = gzip.compress(raw, 6, mtime=0)
                    if out is None or (at and at + len(raw) > archive_bytes):
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc{'.gz' if compress else ''}", 0
                        out = system.open_output_stream(f"{path}/{name}", compression=None, buffer_size=READ_BYTES)
                    out.write(raw)
                    index.append((f"{folder}/{name}", at, len(raw), url, digest, kind, page, refers, copies))
                    at += len(raw)
                if index:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index, strict=True), INDEX_TYPES, strict=True)], names=INDEX_NAMES)
        finally:
            if out is not None:
                out.close()

    return written(rows.mapInArrow(run, INDEX), "warc_index")


def _arrow(schema: str) -> tuple[list[str], list[pa.DataType]]:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return [n for n, _ in fields], [kinds[k] for _, k in fields]


INDEX_NAMES, INDEX_TYPES = _arrow(INDEX)
RECORD_NAMES, RECORD_TYPES = _arrow(RECORD)


# ---- reading ----

def ranges(rows: Iterator[tuple[str, int, int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[list[tuple[str, int, int, int]]]:
    """Runs of (file, offset, length, copies), sorted by file and offset, that one read of at most
    ``most`` bytes serves (one record may be longer)."""
    run: list[tuple[str, int, int, int]] = []
    end = 0
    for row in rows:
        file, offset, length, _ = row
        if run and (file != run[0][0] or offset - end > gap or max(end, offset + length) - run[0][1] > most):
            yield run
            run = []
        end = max(end, offset + length) if run else offset + length
        run.append(row)
    if run:
        yield run


def read(index: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The records of the selected index rows, read from their archives: file, offset, record_type,
    page_id, refers_to, payload_digest (as the record states it), copies, payload."""
    size = index.agg(F.sum("length").alias("bytes")).first().bytes or 0
    plan = (index.select("file", "offset", "length", "copies").repartitionByRange(-(-size // TASK_BYTES) or 1, "file", "offset")
            .sortWithinPartitions("file", "offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, out, held = None, None, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), RECORD_TYPES, strict=True)], names=RECORD_NAMES)

        try:
            for some in ranges((row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)), gap, most):
                if some[0][0] != name:
                    if source is not None:
                        source.close()
                    name = some[0][0]
                    system, path = file_system(name)
                    source = system.open_input_file(path)
                start = some[0][1]
                data = source.read_at(max(o + n for _, o, n, _ in some) - start, start)
                for file, offset, length, copies in some:
                    fields, payload = parse(data[offset - start:offset - start + length])
                    out.append((file, offset, fields["WARC-Type"], _page(fields["WARC-Record-ID"]), _page(fields.get("WARC-Refers-To")),
                                fields["WARC-Payload-Digest"].removeprefix("sha256:"), copies, payload))
                    held += len(payload) + 256
                    if held > BATCH_BYTES:
                        yield flush()
                        out, held = [], 0
            if out:
                yield flush()
        finally:
            if source is not None:
                source.close()

    return plan.mapInArrow(run, RECORD)


def _checked(stated: Column, actual: Column) -> Column:
    return F.when(stated == actual, actual).otherwise(F.raise_error(F.concat(F.lit("payload does not have the digest "), stated)).cast("string"))


def payload_facts(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of a whole
    index, from the archives. Sizes and digests are computed from the payloads that were
    read, a revisit's from its response's; a payload that does not have the digest its record states is an error."""
    facts = written(read(index).select(
        "file", "offset", "page_id", "record_type", "refers_to", "payload_digest", "copies",
        F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(F.col("record_type") == "response", _checked(F.col("payload_digest"), F.sha2("payload", 256))).alias("read_digest")), "warc_facts")
    salts = F.ceil(F.col("copies") / SALT_ROWS)
    own = facts.where("record_type = 'response'")
    shared = own.where("copies > 1").select(F.col("payload_digest").alias("stated"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"),
                                            "payload_bytes", "read_digest")
    again = (facts.where("record_type = 'revisit'").drop("payload_bytes", "read_digest")
             .withColumn("salt", F.pmod(F.xxhash64("file", "offset"), salts)))
    found = again.join(shared, (again["payload_digest"] == shared["stated"]) & (again["salt"] == shared["salt"]), "left")
    cols = ["page_id", "payload_bytes", F.col("read_digest").alias("payload_digest"), "record_type", "refers_to"]
    return own.select(*cols).unionByName(found.select(*cols))
