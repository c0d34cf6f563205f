"""WARC archives with an index first.

Each task writes the records of its pages to archives of its own in the shared folder, one gzip member per record, and
returns an index row per record: archive, offset, length, URL and digest. The index is stored before anything is read.
An attempt that fails leaves archives that no index row names. Reading sorts the index rows that are wanted by archive
and offset and joins neighbouring byte ranges into few reads.

Of equal payloads the one with the largest page_id is kept whole; the others are revisit records that name it. Only the
pages that become revisits are listed and joined to the pages.

Defined cases: a null html is an empty payload; a page without an id is a response and is never referred to; rows that
repeat a page_id with equal payloads have equal record types; line breaks in a URL are percent-encoded and a null URL is
an empty one; payloads may be of any length.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import spread, stored, table
from riskspark.session import new_dir

ARCHIVE_BYTES = 256 << 20
#: Ranges less than GAP apart are read at once, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

INDEX = (
    "page_id long, url string, payload_digest string, record_type string, archive string, offset long, length long"
)
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def name_of(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    value = name.rsplit(":", 1)[1].rstrip(">")
    return None if value == "none" else int(value)


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed. The full payload's length goes with revisits too."""
    head = HTTP.format(len(payload)).encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name_of(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {name_of(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of a record. A response's digest is that of its payload; a wrong one in the header is an error."""
    top, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI", ""), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload,
    }


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, refers_to of the pages whose payload of at least ``least_bytes`` a page with a larger id has too."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digests = stored(pages.where(F.col("page_id").isNotNull() & (F.octet_length(payload) >= least_bytes)).select("page_id", F.sha1(payload).alias("sha1")))
    kept = stored(digests.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to"))
    return stored(digests.join(kept, "sha1").where("page_id < refers_to").select("page_id", "sha1", "refers_to").distinct())


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) below ``folder`` and returns the stored index."""
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    again = revisits(pages, least_bytes).select(F.col("page_id").alias("of"), F.col("sha1").alias("same"), "refers_to")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col("page_id").cast("long"), url.alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    marked = rows.join(again, (F.col("page_id") == F.col("of")) & (F.col("sha1") == F.col("same")), "left")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        out, offset, name = None, 0, ""
        try:
            for batch in batches:
                index = []
                for page_id, uri, body, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or offset >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    digest = digest_of(body)
                    packer = zlib.compressobj(LEVEL, wbits=31)
                    data = packer.compress(record(page_id, uri, body, digest, refers_to)) + packer.flush()
                    out.write(data)
                    index.append((page_id, uri, digest, "response" if refers_to is None else "revisit", name, offset, len(data)))
                    offset += len(data)
                yield as_batch(index, INDEX)
        finally:
            if out is not None:
                out.close()

    return stored(marked.select("page_id", "url", "payload", "refers_to").mapInArrow(archive, INDEX))


def as_batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = [c.split() for c in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if t == "long" else pa.string()) for c, (_, t) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(archive, offset, length) in order, as few reads: archive, start, end and the records inside."""
    archive, start, end, inside = "", 0, 0, []
    for name, offset, length in rows:
        if inside and (name != archive or offset - end > GAP or offset + length - start > READ):
            yield archive, start, end, inside
            inside = []
        if not inside:
            archive, start = name, offset
        inside.append((offset, length))
        end = offset + length
    if inside:
        yield archive, start, end, inside


def read(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records that the rows of ``index`` name, as they are in the archives."""
    parts = spread(index.sparkSession, index.count(), 20_000)
    wanted = index.select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in batches:
            for archive, start, end, inside in ranges(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                with fs.open_input_file(f"{path}/{archive}") as source:
                    data = source.read_at(end - start, start)
                found = [parsed(zlib.decompress(data[o - start : o - start + n], wbits=31)) for o, n in inside]
                out = as_batch([tuple(r[c.split()[0]] for c in RECORD.split(", ")) for r in found], RECORD)
                yield out.append_column("payload", pa.array([r["payload"] for r in found], pa.binary())) if payloads else out

    return wanted.mapInArrow(fetch, RECORD + ", payload binary" * payloads)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back."""
    folder = new_dir(spark, "warc")
    return read(write(table(spark, sf_dir, "pages"), folder), folder)
