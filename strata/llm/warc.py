"""WARC archives with an index that is written first.

Pages become gzip members, one per record, in ``.warc.gz`` files. As a task
writes a record it notes file, offset, length, URL and digest; these rows are
the index table. Reading starts from the index: the selected records are
sorted by file and offset, neighbouring byte ranges are joined into few large
reads, and only those bytes are fetched.

Of records with equal payloads of some size, one is a ``response`` and the
others are ``revisit`` records that refer to it and hold no payload.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.llm.storage import fresh_name, open_input, open_output
from strata.session import scratch_path

RESPONSE, REVISIT = "response", "revisit"
# Payloads from so many bytes on are stored once.
MIN_REVISIT_BYTES = 1000
# A file closes after the record that brings it to so many bytes.
FILE_BYTES = 512 << 20
# Joined reads: so many bytes at most, bridging gaps of at most so many.
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:strata:page:"
_INDEX = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])
_INDEX_DDL = ("path string, offset bigint, length bigint, page_id bigint, url string, digest string, "
              "record_type string")


# --- records ----------------------------------------------------------------------------------

def _header_value(value: str) -> str:
    """Line breaks would end a header line; they are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def _record_id(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    text = record_id.strip("<>").removeprefix(_ID)
    return int(text) if text else None


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                  revisit: bool, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head and leaves out the payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {REVISIT if revisit else RESPONSE}", f"WARC-Record-ID: {_record_id(page_id)}",
             f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def decode_record(member: bytes) -> dict:
    """Headers of a record and its payload (None for a revisit)."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line for line in http.decode().split("\r\n") if line.startswith("Content-Length: ")]
    revisit = fields["WARC-Type"] == REVISIT
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    return {"page_id": _page_id(fields["WARC-Record-ID"]), "payload_bytes": int(sizes[0].split(": ")[1]),
            "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": _page_id(fields["WARC-Refers-To"]) if revisit else None,
            "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload}


# --- writing, index first ---------------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page and return the index, one row per record.

    Of equal payloads of at least ``min_revisit_bytes`` that with the largest
    page_id is the response; rows that repeat that page_id are responses too.
    A null html is an empty payload. A null page_id counts as the smallest
    and may refer to a page; where a group has only null ids, all are
    responses. A null url is left out of the record. An empty table gives an
    empty index; other columns are ignored.

    Only digests are shuffled to find equal payloads. The payloads stay where
    they were read, unless the groups of equal payloads outgrow a broadcast.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    source = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    size = F.octet_length(payload)
    keepers = materialise(spark, (pages.where(size >= min_revisit_bytes).select("page_id", F.sha1(payload).alias("digest"))
                                  .groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                                  .where((F.col("n") > 1) & F.col("keeper").isNotNull()).select("digest", "keeper")), "warc-keepers")
    rows = source.join(keepers, "digest", "left").select(
        "page_id", "url", "payload", "digest", "keeper",
        (F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, path, offset = None, "", 0
        for batch in batches:
            index = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "keeper", "revisit"))
            for page_id, url, data, digest, keeper, revisit in zip(*columns):
                if sink is None:
                    path = fresh_name(folder, ".warc.gz")
                    sink, offset = open_output(path), 0
                record = encode_record(page_id, url, data, digest, keeper, revisit, date)
                sink.write(record)
                index.append({"path": path, "offset": offset, "length": len(record), "page_id": page_id, "url": url,
                              "digest": digest, "record_type": REVISIT if revisit else RESPONSE})
                offset += len(record)
                if offset >= file_bytes:
                    sink.close()
                    sink = None
            yield pa.RecordBatch.from_pylist(index, schema=_INDEX)
        if sink is not None:
            sink.close()

    return materialise(spark, rows.mapInArrow(write, _INDEX_DDL), "warc-index")


# --- reading through the index ----------------------------------------------------------------

def joined_ranges(rows: Iterator[tuple[str, int, int]], read_bytes: int = READ_BYTES,
                  gap_bytes: int = GAP_BYTES) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(path, start, stop, records) of joined reads over rows sorted by path and offset."""
    path, start, stop, records = None, 0, 0, []
    for row_path, offset, length in rows:
        if records and (row_path != path or offset - stop > gap_bytes or offset + length - start > read_bytes):
            yield path, start, stop, records
            records = []
        if not records:
            path, start = row_path, offset
        records.append((offset, length))
        stop = offset + length
    if records:
        yield path, start, stop, records


def read_records(index: DataFrame, payload: bool = False, read_bytes: int = READ_BYTES) -> DataFrame:
    """Read the records that ``index`` rows name: what their headers and payloads say.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to and
    url, and the payload itself where ``payload`` asks for it. Every payload
    read is checked against its digest. A row of the index is small but stands
    for its record, so tasks are dealt by the records' bytes: ranges of files
    and offsets of about two reads each.
    """
    chosen = index.select("path", "offset", "length")
    total = chosen.agg(F.sum("length")).first()[0] or 0
    dealt = (chosen.repartitionByRange(1 + total // (2 * read_bytes), "path", "offset")
             .sortWithinPartitions("path", "offset"))
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
    if payload:
        fields.append(("payload", pa.binary()))
    schema = pa.schema(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int]]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, opened = None, None
        for path, start, stop, records in joined_ranges(rows(batches), read_bytes):
            if path != opened:
                if source is not None:
                    source.close()
                source, opened = open_input(path), path
            source.seek(start)
            data = memoryview(source.read(stop - start))
            made = [decode_record(bytes(data[offset - start:offset - start + length])) for offset, length in records]
            yield pa.RecordBatch.from_pylist(made, schema=schema)
        if source is not None:
            source.close()

    ddl = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
           + (", payload binary" if payload else ""))
    return dealt.mapInArrow(read, ddl)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives below the shared checkpoint folder."""
    return scratch_path(spark, "warc")
