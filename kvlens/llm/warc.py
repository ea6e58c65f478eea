"""WARC archives of Zstandard-compressed records with a shared dictionary.

Each archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself a Zstandard frame; every record after it is a frame of its
own, so one can be read alone. The dictionary is built from the archive's own
first records: ``SAMPLE`` of them at most, and of each its first ``SAMPLE_BYTES``.

Of rows with equal payloads of ``least`` bytes or more, the one with the smallest
page_id is a ``response`` and the others are ``revisit`` records that refer to
it. Which is which comes from an aggregation by digest before any page moves.

Defined cases: null html is the empty payload; null page_ids are never referred
to and, in a group of equal payloads, are revisits unless all are null; rows that
repeat a page_id and its payload are all what the first of them is; a null url
gives an empty target; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import pieces
from .storage import fresh, get, put, written

SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 8192, 32768
#: A fixed date: the tables have none, and equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP headers, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    clean = " ".join((url or "").split())
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-ID: {page_id}"]
    block = http
    if refers_to is None:
        block += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def archive(records: Iterator[bytes], sample: list[bytes], level: int = 6) -> Iterator[bytes]:
    """The archive's blocks: the dictionary's frame, then each record's."""
    import zstandard as z

    trained = b""
    if len(sample) >= 8:
        try:
            trained = z.train_dictionary(DICTIONARY_BYTES, [s[:SAMPLE_BYTES] for s in sample]).as_bytes()
        except z.ZstdError:  # too little or too uniform a sample: its bytes serve as a raw dictionary
            trained = b"".join(s[:SAMPLE_BYTES] for s in sample)[-DICTIONARY_BYTES:]
    packed = z.ZstdCompressor(level=19).compress(trained)
    yield SKIPPABLE + len(packed).to_bytes(4, "little") + packed
    c = z.ZstdCompressor(level=level, dict_data=z.ZstdCompressionDict(trained)) if trained else z.ZstdCompressor(level=level)
    for r in records:
        yield c.compress(r)


def read_archive(blob: bytes) -> Iterator[bytes]:
    """An archive's records, one frame at a time."""
    import zstandard as z

    if blob[:4] != SKIPPABLE:
        raise ValueError("no dictionary frame")
    size = int.from_bytes(blob[4:8], "little")
    trained = z.ZstdDecompressor().decompress(blob[8 : 8 + size])
    d, at = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(trained)) if trained else z.ZstdDecompressor(), 8 + size
    view = memoryview(blob)
    while at < len(blob):
        o = d.decompressobj()
        # A frame's end is not known before it is read: windows grow until it is met.
        out, step = [], 1 << 16
        while True:
            part = view[at : at + step]
            out.append(o.decompress(part))
            at += len(part)
            if o.eof:
                at -= len(o.unused_data)
                break
            if not len(part):
                raise ValueError("archive breaks off")
        yield b"".join(out)


def classify(pages: DataFrame, page_id: str, payload: str, least: int) -> DataFrame:
    """page_id and digest of the groups that hold more than one page: the page_id that others refer to."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.sha2(payload, 256).alias("digest")).where(F.octet_length(payload) >= least)
    return rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("d"), "first")


def write(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """Writes archives of all rows; gives their manifest: path, records, bytes (one row an archive)."""
    spark = pages.sparkSession
    folder = folder or fresh(spark, "warc")
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"), F.coalesce(pages[html], F.lit("")).alias("html"))
    keys = rows.select("page_id", F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("bytes"))
    groups = written(classify(rows, "page_id", "html", least), "warc-groups")
    # Only pages of such groups need to know it; they are joined by digest without their html.
    others = keys.where(F.col("bytes") >= least).join(groups, F.col("digest") == F.col("d")).where(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first").distinct()
    others = written(others, "warc-revisits")
    marked = rows.withColumn("digest", F.sha2("html", 256)).join(others, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left").select("page_id", "url", "html", "digest", "first", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _records(batches)
        ahead, sample = [], []
        part = None
        for part, data in stream:
            ahead.append(data)
            sample.append(data)
            if len(sample) == SAMPLE:
                break
        if part is None:
            return
        n = 0

        def all_of() -> Iterator[bytes]:
            nonlocal n
            for data in ahead:
                n += 1
                yield data
            for _, data in stream:
                n += 1
                yield data

        path = f"{folder}/part-{part:06d}.warc.zst"
        size = put(path, archive(all_of(), sample))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

    return written(marked.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for piece in pieces(batches, "html"):
        for row in piece.to_pylist():
            yield row["part"], record(row["page_id"], row["url"], row["html"].encode("utf-8"), row["digest"], row["first"])


FIELDS = "url string, payload_bytes long, payload_digest string, record_type string, refers_to long, stored_digest string"


def read(manifest: DataFrame) -> DataFrame:
    """Rows of the archives: page_id, url, payload_bytes, payload_digest (as the record states it), record_type, refers_to, and stored_digest (of the payload found in a response)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "stored_digest"]
        whole = lambda x: None if x in (None, "None") else int(x)
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows = []
                for data in read_archive(get(path)):
                    h, block = parse_record(data)
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    kind = h["warc-type"]
                    stored = hashlib.sha256(body).hexdigest() if kind == "response" else None
                    rows.append((whole(h["x-page-id"]), h["warc-target-uri"], size, h["warc-payload-digest"].removeprefix("sha256:"), kind, whole(h.get("x-refers-to-page-id")), stored))
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    n = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(n, "path").mapInArrow(run, f"page_id long, {FIELDS}")


def op6(spark, sf_dir: str) -> DataFrame:
    found = read(write(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    # A response's digest is that of the bytes read back; a revisit's payload is its response's.
    return found.select("page_id", "payload_bytes", F.coalesce("stored_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') as html from pages),
k as (select page_id, octet_length(encode(html)) as payload_bytes, sha256(html) as payload_digest from p),
g as (select *, min(page_id) over (partition by payload_digest) as first, count(*) over (partition by payload_digest) as n from k)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= 100 and n > 1 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and n > 1 and page_id is distinct from first then first end as refers_to
from g
"""
