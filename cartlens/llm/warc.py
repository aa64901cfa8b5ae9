"""WARC archives of web pages, as a table of chunks: oversized payloads are never held whole by a task's Python.

``chunks`` turns each page into rows of a record number, a chunk number and at most ``CHUNK`` bytes, cut by
Spark, and carries the SHA-1 of all bytes up to each chunk's end from row to row. ``write_archive`` makes a
WARC record of each chunk: the first is a ``response``, further ones are ``continuation`` records, numbered as
segments. ``read_archive`` reads the records back in pieces of files, checks every block's length and digest,
takes what is complete as it is, and follows the segments of long records in order with one running digest.

A page whose payload equals that of a page with a smaller id is a ``revisit``: headers only, with the id it
refers to. Payloads under ``min_bytes`` are always responses.

Files are written and read by Spark as text whose lines end with the empty line that ends each record, so they
can lie in any store, and plain ones be split. A chunk in which a record seems to begin is cut there once more.

Defined results: a null payload is empty; equal ids with equal payloads are all what their id is; a page
without an id revisits the smallest id with its payload, or is a response where there is none. Payloads are
archived byte for byte; control characters and non-ASCII characters of an address are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, shared_path, stored

CHUNK = 1 << 14
FILE_RECORDS = 4096
DATE = "2024-01-01T00:00:00Z"
_BEGIN = b"WARC/1.1"
_END = "\r\n\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _payloads(pages: DataFrame) -> DataFrame:
    """Id, address, payload and a hash that tells payloads of one id apart."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), body.alias("body"))
    return rows.withColumn("key", F.xxhash64("body"))


def _cut(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """A row for each chunk of ``body``, in order, with the row's other columns."""
    total = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / chunk_bytes)).cast("int")
    rows = rows.withColumns({"record": F.monotonically_increasing_id(), "total": total})
    others = [c for c in rows.columns if c != "body"]
    cut = rows.select(*others, "body", F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("chunk"))
    data = F.expr(f"substring(body, chunk * {chunk_bytes} + 1, {chunk_bytes})").alias("data")
    return cut.select(*others, "chunk", data)


def chunks(pages: DataFrame, *, chunk_bytes: int = CHUNK) -> DataFrame:
    """record, page_id, total (chunks), body_bytes, chunk (from 0), data, and digest: the SHA-1, in base 32, of the
    payload up to the end of this chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha1()
        for batch in batches:
            digests = []
            for number, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
                if number == 0:
                    running = hashlib.sha1()
                running.update(data.as_buffer())
                digests.append(_base32(running.digest()))
            yield batch.append_column("digest", pa.array(digests, pa.string()))

    find_package(pages.sparkSession)
    rows = _payloads(pages).withColumn("body_bytes", F.octet_length("body").cast("long")).drop("url")
    cut = _cut(rows, chunk_bytes).select("record", "page_id", "key", "total", "body_bytes", "chunk", "data")
    ddl = "record long, page_id long, key long, total int, body_bytes long, chunk int, data binary, digest string"
    return cut.mapInArrow(run, ddl)


def _decisions(pages: DataFrame, min_bytes: int, chunk_bytes: int) -> DataFrame:
    """Length, digest and the page referred to, of each page id and payload."""
    last = chunks(pages, chunk_bytes=chunk_bytes).where("chunk = total - 1")
    found = stored(last.select("page_id", "key", "body_bytes", "digest").distinct(), "digests")
    firsts = found.groupBy("digest", "body_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.where((F.col("n") > 1) & (F.col("body_bytes") >= min_bytes)).drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    decided = found.join(firsts, ["digest", "body_bytes"], "left")
    return decided.select(F.col("page_id").alias("id"), F.col("key").alias("of"), "body_bytes", "digest", refers)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def _http(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    """A record without the empty line that ends it."""
    fields = {
        "WARC-Type": kind, "WARC-Date": DATE, **fields,
        "WARC-Block-Digest": f"sha1:{_base32(hashlib.sha1(block).digest())}", "Content-Length": len(block),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return _BEGIN + b"\r\n" + head.encode() + b"\r\n" + block


def _pieces(data: bytes) -> Iterator[bytes]:
    """The chunk, cut wherever a record seems to begin, behind that place's first byte."""
    low = 0
    while (at := data.find(_BEGIN, low)) >= 0:
        yield data[low : at + 1]
        low = at + 1
    yield data[low:]


def _fields(row: dict, digest: str) -> dict[str, object]:
    address = quote(row["url"] or f"urn:page:{row['page_id']}", safe=":/?#[]@!$&'()*+,;=%-._~")
    refers = row["refers_to"]
    return {
        "WARC-Record-ID": _record_id(row["page_id"], digest),
        "WARC-Target-URI": address,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Refers-To": None if refers is None else _record_id(refers, digest),
        "WARC-Profile": None
        if refers is None
        else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "X-Page": row["page_id"],
        "X-Refers-To-Page": refers,
        "X-Row": row["record"],
    }


def _records(row: dict, running: "hashlib._Hash", segment: int) -> Iterator[bytes]:
    """The records of one chunk; ``segment`` is the number of the page's segments before it."""
    if row["refers_to"] is not None:
        yield _record("revisit", _fields(row, row["digest"]), _http(row["body_bytes"]))
        return
    pieces = list(_pieces(row["data"]))
    last_chunk = row["chunk"] == row["total"] - 1
    for i, piece in enumerate(pieces):
        running.update(piece)
        segment += 1
        last = last_chunk and i == len(pieces) - 1
        if segment == 1:
            fields = _fields(row, row["digest"])
            if not last:
                fields["WARC-Segment-Number"] = 1
            yield _record("response", fields, _http(row["body_bytes"]) + piece)
        else:
            fields = {
                "WARC-Record-ID": _record_id(row["page_id"], f"{row['digest']}/{segment}"),
                "WARC-Segment-Origin-ID": _record_id(row["page_id"], row["digest"]),
                "WARC-Segment-Number": segment,
                "WARC-Segment-Total-Length": len(_http(row["body_bytes"])) + row["body_bytes"] if last else None,
                "X-Page": row["page_id"],
                "X-Row": row["record"],
                "X-Payload-Digest-So-Far": f"sha1:{_base32(running.digest())}",
            }
            yield _record("continuation", fields, piece)


def write_archive(
    pages: DataFrame,
    path: str | None = None,
    *,
    min_bytes: int = 0,
    chunk_bytes: int = CHUNK,
    compression: str = "gzip",
) -> str:
    """Write the pages (page_id, url, html) as WARC files and return their folder. Compressed files (``none`` for
    plain ones) are read by one task each, so they are kept to ``FILE_RECORDS`` records."""
    path = path or shared_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, segment = hashlib.sha1(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["chunk"] == 0:
                    running, segment = hashlib.sha1(), 0
                records = list(_records(row, running, segment))
                segment += len(records)
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    decided = _decisions(pages, min_bytes, chunk_bytes)
    rows = _payloads(pages).join(decided, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("of")))
    body = F.when(F.col("refers_to").isNull(), F.col("body")).otherwise(F.lit(b""))
    rows = rows.select("page_id", "url", body.alias("body"), "body_bytes", "digest", "refers_to")
    records = _cut(rows, chunk_bytes).mapInArrow(run, "record binary")
    lines = records.select(F.col("record").cast("string")).write.option("lineSep", _END)
    lines.option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS).text(path)
    return path


READ_DDL = (
    "page_id long, line long, segment int, total_bytes long, record_type string, refers_to long, "
    "declared string, data binary, payload_bytes long, payload_digest string"
)


def _parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record; its first line may have gone with the line separator."""
    raw = raw.removeprefix(_BEGIN + b"\r\n")
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    block = block[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
    if fields["WARC-Block-Digest"] != f"sha1:{_base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"the block of record {fields['WARC-Record-ID']} does not have its digest")
    return fields, block


def _read(raw: bytes) -> tuple:
    """A row of ``READ_DDL``: complete records have their length and digest, others their data."""
    fields, block = _parsed(raw)
    kind, page, line = fields["WARC-Type"], fields.get("X-Page"), int(fields["X-Row"])
    page = None if page is None else int(page)
    if kind == "continuation":
        return page, line, int(fields["WARC-Segment-Number"]), None, None, None, None, block, None, None
    head, _, payload = block.partition(b"\r\n\r\n")
    total = int(head.rpartition(b"Content-Length: ")[2])
    declared = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "revisit":
        refers = int(fields["X-Refers-To-Page"])
        return page, line, 0, total, kind, refers, declared, None, total, declared
    if "WARC-Segment-Number" in fields:
        return page, line, 1, total, kind, None, declared, payload, None, None
    return page, line, 1, total, kind, None, declared, None, len(payload), _base32(hashlib.sha1(payload).digest())


def _columns(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_RESULT = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each page in the archive."""
    find_package(spark)
    names = [part.split()[0] for part in READ_DDL.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    types += [pa.int64(), pa.string()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _columns([_read(raw.as_py()) for raw in batch.column("record")], names, types)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Follow each page's segments, which come in order, with one running digest."""
        first, running, length = {}, hashlib.sha1(), 0
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in names}
                if row["segment"].as_py() <= 1:
                    first = {name: row[name].as_py() for name in names if name != "data"}
                    running, length = hashlib.sha1(), 0
                if row["data"].is_valid:
                    running.update(row["data"].as_buffer())
                    length += row["data"].as_buffer().size
                    if length < first["total_bytes"]:
                        continue
                    first |= {"payload_bytes": length, "payload_digest": _base32(running.digest())}
                if first["payload_digest"] != first["declared"] or first["payload_bytes"] != first["total_bytes"]:
                    raise ValueError(f"the payload of page {first['page_id']} does not have its digest")
                out.append(tuple(first[name] for name in _RESULT))
            yield _columns(out, _RESULT, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()])

    lines = spark.read.option("lineSep", _END + _BEGIN.decode() + "\r\n").text(path)
    parsed = lines.select(F.col("value").cast("binary").alias("record")).mapInArrow(parse, READ_DDL)
    together = parsed.repartition("page_id", "line").sortWithinPartitions("page_id", "line", "segment")
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return together.mapInArrow(join, ddl)
