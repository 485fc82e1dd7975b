"""WARC archives with an index first: offset, length, URL and digest per record, then coalesced byte-range reads."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.storage import new_path, table, written

#: Payloads of fewer bytes are always stored.
MIN_REVISIT_BYTES = 100
#: A new file begins when one has so many bytes.
FILE_BYTES = 128 << 20
#: Wanted records that lie at most so far apart are read at once, up to READ_BYTES (or one record).
GAP_BYTES = 256 << 10
READ_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, file string, offset long, length long"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member of its own."""
    block = _HTTP + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', '', url or '')}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {_PROFILE}"] * revisit
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each row into files under folder and returns the index, which is itself a table there.

    Of rows with equal payloads of at least MIN_REVISIT_BYTES, those with the least page_id are responses and the others
    revisit it; rows with a null id revisit it too, and are responses where no equal row has an id. A null html is an
    empty payload, a null URL an empty one. Other columns are not read. An empty table gives an empty index. A task that
    is run again writes new files; the index names only those of the run that counted.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # Partial aggregation first, so a payload that a third of all pages share costs little. The result is written, so that
    # the join is one of two plain shuffles, of which Spark splits the hot side.
    first = rows.where(F.octet_length("html") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and first is not null").drop("_n")
    first = written(first, "first")
    joined = rows.join(first, "digest", "left").select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for page, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    revisit = first is not None and page != first
                    member = record(page, url, html, digest, first, revisit)
                    out.write(member)
                    index.append((page, url, digest, len(html), "revisit" if revisit else "response", first if revisit else None, name, at, len(member)))
                    at += len(member)
                columns = list(zip(*index)) or [()] * 9
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    spark = pages.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return written(joined.mapInArrow(run, INDEX), "warc-index")


def coalesced(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """From sorted (offset, length): the reads (offset, length, first and last + 1 of the ranges they serve)."""
    out: list[tuple[int, int, int, int]] = []
    for i, (offset, length) in enumerate(ranges):
        if out:
            begin, size, first, _ = out[-1]
            if offset - (begin + size) <= GAP_BYTES and offset + length - begin <= READ_BYTES:
                out[-1] = (begin, max(size, offset + length - begin), first, i + 1)
                continue
        out.append((offset, length, i, i + 1))
    return out


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index rows select: page_id, url, payload_bytes, payload_digest, record_type, refers_to and
    payload (null in revisits), all from the archives. The digest of a response is computed from what was read; a revisit
    has its own and its length in its headers."""
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // (32 << 20)))
    ordered = index.select("file", "offset", "length", "page_id").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            at = 0
            while at < len(rows):
                end = next((i for i in range(at, len(rows)) if rows[i][0] != rows[at][0]), len(rows))
                if rows[at][0] != name:
                    if source is not None:
                        source.close()
                    name, source = rows[at][0], store.open_input_file(f"{base}/{rows[at][0]}")
                part = rows[at:end]
                for begin, size, first, last in coalesced([(r[1], r[2]) for r in part]):
                    source.seek(begin)
                    data = source.read(size)
                    out = []
                    for _, offset, length, page in part[first:last]:
                        head, payload = parse(data[offset - begin : offset - begin + length])
                        kind = head["WARC-Type"]
                        refers = head.get("WARC-Refers-To", "")[len("<urn:x-page:") : -1]
                        digest = hashlib.sha256(payload).hexdigest() if kind == "response" else head["WARC-Payload-Digest"].removeprefix("sha256:")
                        n = len(payload) if kind == "response" else int(head["X-Payload-Length"])
                        out.append((page, head.get("WARC-Target-URI"), n, digest, kind, int(refers) if refers else None, payload if with_payload and kind == "response" else None))
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
                at = end
        if source is not None:
            source.close()

    return ordered.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of pages, from the archives; see write_archives for nulls, repeated ids and empty payloads."""
    folder = new_path(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: In SQL, what reading the archives back must give.
_ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

QUERIES: dict[str, Callable] = {"op9_warc": op9_warc}
ORACLES: dict[str, str] = {"op9_warc": _ORACLE}
