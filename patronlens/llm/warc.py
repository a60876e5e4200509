"""WARC archives of pages, written and read as tables of chunks.

A payload is written as segments of bounded size, one record each: the first is the
``response``, the others are ``continuation`` records with the same record id and their
number. So neither side ever holds more of a payload than a chunk, besides the row
that brings it. A page whose payload another page has already is a ``revisit``
without a block.

The files are Spark text files whose lines are records: the separator of the writer is the
end of a record, that of the reader the first line of a record. The writer cuts a
payload inside every such line that it holds, so no chunk contains the separator. A
file is compressed as a whole and read by one task in order, which lets digests run
over the chunks of a record without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm.common import utf8_length
from patronlens.session import materialize

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Payload bytes of one chunk.
CHUNK_BYTES = 1 << 16

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary ``data``."""
    return base32(F.sha1(data))


def base32(digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal: 32 signs of five bits each.

    ``digest`` is read for each sign; give a column that is computed already, not the digest of a long payload.
    """
    # Five hexadecimal digits are four signs.
    quads = [F.conv(F.substring(digest, at, 5), 16, 10).cast("bigint") for at in range(1, 41, 5)]
    signs = F.lit(_BASE32)
    return F.concat(*[
        F.substr(signs, (F.shiftright(quad, shift).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
        for quad in quads
        for shift in (15, 10, 5, 0)
    ])


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), one row per distinct page and payload.

    Of the pages with equal payloads of ``least`` bytes or more the one with the smallest
    id is the response, the others revisit it; pages without an id come last. Null
    payloads count as empty.
    """
    return _decided(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _decided(pages: DataFrame, least: int) -> DataFrame:
    """``page_records`` with the digest in hexadecimal too, as ``sha1``."""
    rows = pages.select("page_id", utf8_length("html").alias("payload_bytes"), F.sha1(_payload()).alias("sha1"))
    rows = materialize(rows.distinct())
    # Smaller payloads all stand for themselves and need no look-up.
    firsts = rows.groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("_first"))
    named = rows.join(firsts.filter(F.col("payload_bytes") >= least), ["sha1", "payload_bytes"], "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return named.select(
        "page_id",
        "payload_bytes",
        base32(F.col("sha1")).alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"),
        "sha1",
    )


def cuts(payload: bytes, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of chunks of ``size`` bytes at most, none of which holds the first line of a record."""
    at = 0
    while at < len(payload):
        end = min(at + size, len(payload))
        # The end of the record follows the chunk and may complete such a line.
        found = (payload[at:end] + RECORD_END.encode()).find(VERSION)
        if found >= 0:
            end = at + found + len(VERSION) // 2
        yield at, end
        at = end


def _head(fields: list[tuple[str, object]]) -> bytes:
    return VERSION + "".join(f"{name}: {value}\r\n" for name, value in fields).encode() + b"\r\n"


def _clean(url: str | None) -> str:
    """A URL that can stand in a header line."""
    return "".join(url.split()).replace("WARC/1.1", "WARC%2F1.1") if url else "about:blank"


def _records(page: dict, size: int) -> Iterator[bytes]:
    """The records of one page, each without its end."""
    payload, name = page["payload"] or b"", page["page_id"]
    common = [
        ("WARC-Record-ID", f"<urn:page:{'' if name is None else name}>"),
        ("WARC-Target-URI", _clean(page["url"])),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
    ]
    about = [("WARC-Payload-Digest", f"sha1:{page['payload_digest']}"), ("WARC-Payload-Length", page["payload_bytes"])]
    if page["record_type"] == "revisit":
        more = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{page['refers_to']}>"), ("Content-Length", 0)]
        yield _head([("WARC-Type", "revisit"), *common, *about, *more])
        return
    parts = list(cuts(payload, size)) or [(0, 0)]
    for number, (a, b) in enumerate(parts, 1):
        block = (HTTP_HEAD if number == 1 else b"") + payload[a:b]
        fields = [("WARC-Type", "response" if number == 1 else "continuation"), *common]
        if number == 1:
            fields += [*about, ("Content-Type", "application/http; msgtype=response")]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", number))
        if number == len(parts) > 1:
            fields.append(("WARC-Segment-Total-Length", len(HTTP_HEAD) + len(payload)))
        yield _head([*fields, ("Content-Length", len(block))]) + block


def write_archives(pages: DataFrame, path: str, least: int = 0, size: int = CHUNK_BYTES) -> None:
    """Write one response or revisit per row of ``pages`` (page_id, url, html) to archives below ``path``.

    Spark's own writer commits the files, so a lost or repeated task leaves none behind.
    """
    decided = _decided(pages, least).withColumnsRenamed({"page_id": "_page", "sha1": "_sha1"})
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), _payload().alias("payload"))
    # One digest of each payload: the join's own checks would compute every sign of a base32 one anew.
    rows = rows.withColumn("sha1", F.sha1("payload"))
    same = rows["page_id"].eqNullSafe(decided["_page"]) & (rows["sha1"] == decided["_sha1"])
    whole = rows.join(decided, same).drop("_page", "_sha1", "sha1")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                page = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                for record in _records(page, size):
                    yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["value"])

    records = whole.mapInArrow(lines, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk rows of the archives below ``path``, each with the digest of its record so far.

    (record_id, chunk, last, record_type, refers_to, payload_bytes, payload_digest, read_bytes,
    read_digest, data): ``read_bytes`` and ``read_digest`` cover the payload up to and with
    this chunk. A record that is cut off or out of order is an error.
    """
    lines = spark.read.option("lineSep", VERSION.decode()).text(path).select(F.col("value").cast("binary"))
    schema = (
        "record_id string, chunk int, last boolean, record_type string, refers_to string, payload_bytes bigint,"
        " payload_digest string, read_bytes bigint, read_digest string, data binary"
    )
    return lines.mapInArrow(_chunks, schema)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = "record_id chunk last record_type refers_to payload_bytes payload_digest read_bytes read_digest data".split()
    kinds = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    open_record: dict = {}
    for batch in batches:
        out = []
        for line in batch.column(0).to_pylist():
            if not line:
                continue  # what stands before the first record
            head, _, rest = line.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
            length = int(fields["Content-Length"])
            block = rest[:length]
            if len(block) < length or rest[length:] != RECORD_END.encode():
                raise ValueError(f"record {fields['WARC-Record-ID']} is not as long as it says")
            name, number = fields["WARC-Record-ID"], int(fields.get("WARC-Segment-Number", 1))
            if number == 1:
                if open_record:
                    raise ValueError(f"record {open_record['name']} has no end")
                digest, at = hashlib.sha1(), 0
                _, _, data = block.partition(b"\r\n\r\n")
                about = {k: fields.get(k) for k in ("WARC-Type", "WARC-Refers-To", "WARC-Payload-Length", "WARC-Payload-Digest")}
            else:
                if (name, number) != (open_record.get("name"), open_record.get("next")):
                    raise ValueError(f"segment {number} of record {name} is out of order")
                digest, at, about, data = open_record["digest"], open_record["at"], open_record["about"], block
            digest.update(data)
            at += len(data)
            last = number == 1 and "WARC-Segment-Number" not in fields or "WARC-Segment-Total-Length" in fields
            open_record = {} if last else {"name": name, "next": number + 1, "digest": digest, "at": at, "about": about}
            so_far = base64.b32encode(digest.digest()).decode()
            declared = int(about["WARC-Payload-Length"]), about["WARC-Payload-Digest"].removeprefix("sha1:")
            if last and about["WARC-Type"] == "response" and (at, so_far) != declared:
                raise ValueError(f"record {name} does not have the payload it declares")
            out.append((name, number - 1, last, about["WARC-Type"], about["WARC-Refers-To"], *declared, at, so_far, data))
        columns = zip(*out, strict=True) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)
    if open_record:
        raise ValueError(f"record {open_record['name']} has no end")


def record_number(name: str) -> Column:
    """The page id in a record id; null for a page without one."""
    return F.nullif(F.regexp_extract(F.col(name), r"^<urn:page:(.*)>$", 1), F.lit("")).cast("bigint")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record, from its last chunk.

    Digests and sizes of responses are those of the payload read; revisits have the
    declared ones.
    """
    ends = read_chunks(spark, path).filter("last")
    response = F.col("record_type") == "response"
    return ends.select(
        record_number("record_id").alias("page_id"),
        F.when(response, F.col("read_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("read_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        record_number("refers_to").alias("refers_to"),
    )
