"""WARC archives with an index (operator 4).

Writing: each task appends its records, one gzip member each, to an archive of its own in a folder that all
executors share, and returns the index: file, offset, length, URL, payload digest and bytes of every record.
The index is written as a table when all archives are there. An archive has a name of its own for every attempt,
so a lost executor leaves at most an archive that no index row names.

Payloads of at least ``MIN_SHARED_BYTES`` that several records share are stored once, by the record with the
smallest id; the others are revisits that refer to it.

Reading: the index is filtered to the records that are asked for, dealt in sorted ranges, and byte ranges that
touch or nearly touch are read at once, up to a bounded size.

A null payload counts as empty and a null URL leaves out the header line. A row without an id is always a
response. Rows that repeat the smallest id are responses all of them. Control characters, blanks and percent
signs of a URL are percent-encoded and decoded again. Other columns are not looked at.
"""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.llm.common import stored
from clausemill.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_SHARED_BYTES = 100
GZIP_LEVEL = 4
GAP_BYTES = 64 * 1024  # ranges with a smaller gap are read at once
READ_BYTES = 8 * 1024 * 1024  # up to so many bytes

INDEX = (
    "file string, offset long, length long, record_id long, url string, record_type string, refers_to long,"
    " payload_digest string, payload_bytes long"
)
RECORDS = (
    "record_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def _id(number: int | None) -> str:
    return "<urn:page:none>" if number is None else f"<urn:page:{number}>"


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(
    number: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, size: int, payload: bytes
) -> bytes:
    """One record, uncompressed. The block of a revisit ends with its HTTP header, which tells the payload's size."""
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {_id(number)}", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~^|{}\\\"<>`"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if kind == "response":
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[str]) -> dict[str, str]:
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """The header fields of a record and of its HTTP block, names in lower case, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = _fields(lines[1:])
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, _fields(http.decode().split("\r\n")[1:]), payload


def _filesystem(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def _writer(folder: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _filesystem(folder)
        name, out, offset = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                if out is None and len(batch):
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                rows = []
                for row in batch.itertuples(index=False):
                    number = None if pd.isna(row.record_id) else int(row.record_id)
                    refers_to = None if pd.isna(row.refers_to) else int(row.refers_to)
                    kind = "response" if refers_to is None else "revisit"
                    raw = record(number, row.url, kind, refers_to, row.payload_digest, row.payload_bytes, bytes(row.payload or b""))
                    member = gzip.compress(raw, GZIP_LEVEL, mtime=0)
                    out.write(member)
                    rows.append(
                        (name, offset, len(member), number, row.url, kind, refers_to, row.payload_digest, row.payload_bytes)
                    )
                    offset += len(member)
                yield _frame(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    return write


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [part.split()[0] for part in schema.split(",")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({n: "Int64" for n in names if f"{n} long" in schema})


def write(pages: DataFrame, folder: str, record_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row below ``folder``; the index, as a written table."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload")
    rows = pages.select(F.col(record_id).cast("long").alias("record_id"), F.col(url).cast("string").alias("url"), body)
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    first = (
        rows.where(F.col("payload_bytes") >= MIN_SHARED_BYTES)
        .groupBy("payload_digest")
        .agg(F.min("record_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "first")
    )
    # Written, so that the payloads meet a shuffled side and a payload with a third of all rows can be split.
    first = stored(spark, first, "shared-payloads")
    rows = rows.join(first, "payload_digest", "left").withColumn(
        "refers_to", F.when(F.col("record_id") != F.col("first"), F.col("first"))
    )
    rows = rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    index = rows.select("record_id", "url", "payload_digest", "payload_bytes", "refers_to", "payload").mapInPandas(
        _writer(folder), INDEX
    )
    return stored(spark, index, "warc-index")


def _coalesced(entries: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Sorted (offset, length) as (first entry, last entry, start, end) of the ranges to read."""
    first, start, end = 0, *((entries[0][0], sum(entries[0])) if entries else (0, 0))
    for at, (offset, length) in enumerate(entries[1:], 1):
        if offset - end > GAP_BYTES or offset + length - start > READ_BYTES:
            yield first, at, start, end
            first, start = at, offset
        end = offset + length
    if entries:
        yield first, len(entries), start, end


def _reader(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _filesystem(folder)
        for batch in batches:
            for name, part in batch.groupby("file", sort=True):
                part = part.sort_values("offset")
                entries = list(zip(part["offset"].tolist(), part["length"].tolist(), strict=True))
                with system.open_input_file(f"{base}/{name}") as archive:
                    for first, last, start, end in _coalesced(entries):
                        chunk = archive.read_at(end - start, start)
                        rows = []
                        for offset, length in entries[first:last]:
                            raw = zlib.decompress(chunk[offset - start : offset - start + length], 31)
                            fields, http, payload = parse(raw)
                            kind = fields["warc-type"]
                            uri = fields.get("warc-target-uri")
                            rows.append(
                                (
                                    _number(fields["warc-record-id"]),
                                    None if uri is None else unquote(uri),
                                    kind,
                                    _number(fields.get("warc-refers-to")),
                                    fields["warc-payload-digest"].removeprefix("sha256:"),
                                    len(payload) if kind == "response" else int(http["content-length"]),
                                    payload if kind == "response" else None,
                                )
                            )
                        yield _frame(rows, RECORDS)

    return read


def read(selected: DataFrame, folder: str) -> DataFrame:
    """The records that index rows name, read from the archives; a revisit comes without payload."""
    sorted_ = selected.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return sorted_.mapInPandas(_reader(folder), RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload also for revisits, taken from the responses they refer to."""
    responses = records.where("record_type = 'response' AND record_id IS NOT NULL").select(
        F.col("record_id").alias("refers_to"), "payload_digest", F.col("payload").alias("shared")
    )
    return (
        records.join(responses.dropDuplicates(["refers_to", "payload_digest"]), ["refers_to", "payload_digest"], "left")
        .withColumn("payload", F.coalesce("payload", "shared"))
        .drop("shared")
    )


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives that all executors reach."""
    return scratch_path(spark, "warc")
