"""Token ids in binary files.

Ids are replaced by their rank of frequency over all documents (ties to the
smaller id), so that common ids take one byte. A file holds documents in
ascending doc_id order::

    b"TKVB" | u32 version | u64 documents | u64 ids | u64 bytes of counts' data
    control bytes of the documents' counts | their data
    control bytes of the ranks | their data

Each number takes 1 to 4 bytes, little-endian. Its length less one is two bits of
a control byte, which holds those of four numbers (the first in the low bits);
control bytes stand apart from data, so that a decoder looks up four lengths at
a time. ``vocabulary.bin`` beside the files has the ids by rank as u32.

Documents are dealt by ranges of (doc_id, a hash of their ids), so one doc_id may
hold any share of the rows; a partition's documents go to one file after another,
of about ``FILE`` packed bytes each.

Defined cases: null and empty texts are the end id alone; rows of the same
doc_id stand in order of that hash, then of their ids' bytes; null doc_ids come
first; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import pieces
from .encoding import PIECE, blobs, chunk_encoder
from .storage import discard, fresh, get, put, written

MAGIC, HEAD = b"TKVB", struct.Struct("<4sIQQQ")
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)
_TOTALS = _LENGTHS.sum(axis=1, dtype=np.int64)
_OFFSETS = (np.cumsum(_LENGTHS, axis=1) - _LENGTHS).astype(np.int64)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(5)], np.uint32)
#: Control bytes decoded at a time.
STEP = 1 << 18
#: Packed bytes after which a file ends.
FILE = 1 << 24


def pack_numbers(x: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data of unsigned 32-bit numbers."""
    x = np.ascontiguousarray(x, "<u4")
    code = (x > 0xFF).view(np.uint8) + (x > 0xFFFF).view(np.uint8) + (x > 0xFFFFFF).view(np.uint8)
    padded = np.zeros(-(-len(x) // 4) * 4, np.uint8)
    padded[: len(x)] = code
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4) <= code[:, None]
    return control.astype(np.uint8).tobytes(), x.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack_numbers(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """``count`` numbers of control bytes and data (uint8 arrays; data may go on)."""
    out = np.empty(len(control) * 4, np.uint32)
    at = 0
    for a in range(0, len(control), STEP):
        c = control[a : a + STEP]
        total = _TOTALS[c]
        ends = np.cumsum(total)
        part = np.concatenate([data[at : at + int(ends[-1])], np.zeros(4, np.uint8)])
        where = ((ends - total)[:, None] + _OFFSETS[c]).ravel()
        size = _LENGTHS[c].ravel()
        window = np.lib.stride_tricks.sliding_window_view(part, 4)[np.minimum(where, len(part) - 4)]
        out[a * 4 : a * 4 + len(where)] = np.ascontiguousarray(window).view("<u4").ravel() & _MASKS[size]
        at += int(ends[-1])
    return out[:count]


def data_size(control: np.ndarray, count: int) -> int:
    """Bytes of data of ``count`` numbers: a last control byte's unused places stand for none."""
    return int(_TOTALS[control].sum()) - (len(control) * 4 - count)


def _head(docs: int, ids: int, size: int) -> bytes:
    return HEAD.pack(MAGIC, 1, docs, ids, size)


def file_bytes(counts: np.ndarray, ranks: np.ndarray) -> list[bytes]:
    c1, d1 = pack_numbers(counts)
    c2, d2 = pack_numbers(ranks)
    return [_head(len(counts), len(ranks), len(d1)), c1, d1, c2, d2]


def read_file(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The documents' counts and all ranks."""
    magic, version, docs, ids, size = HEAD.unpack_from(blob)
    if magic != MAGIC or version != 1:
        raise ValueError("not a token file")
    b, at = np.frombuffer(blob, np.uint8), HEAD.size
    n = -(-docs // 4)
    counts = unpack_numbers(b[at : at + n], b[at + n : at + n + size], docs)
    at += n + size
    n = -(-ids // 4)
    return counts, unpack_numbers(b[at : at + n], b[at + n :], ids)


def encode(df: DataFrame, path: str, kind: str, text: str = "text", doc_id: str = "doc_id", end_id: int = 1) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit if the vocabulary needs it, else 16-bit, with the end id)."""
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"

    source = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, kind, dtype)
        for piece in pieces(batches, "text", PIECE):
            yield pa.RecordBatch.from_arrays([piece["doc_id"], blobs(*encoder.encode_array(piece["text"], end_id))], names=["doc_id", "ids"])

    out = source.mapInArrow(run, schema)
    out.ids_dtype = dtype
    return out


def frequencies(ids: DataFrame, dtype: str) -> DataFrame:
    """(id, n): each task counts its ids, so at most a vocabulary's rows leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch["ids"]:
                part = np.bincount(np.frombuffer(x.as_buffer(), dtype))
                if len(part) > len(n):
                    part, n = n, part
                n[: len(part)] += part
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(df: DataFrame, path: str, kind: str, folder: str | None = None, text: str = "text", doc_id: str = "doc_id", end_id: int = 1, file_bytes: int = FILE) -> tuple[DataFrame, str]:
    """Writes files of all documents; gives their manifest (part, file_no, path, n_docs, n_ids; one row a file) and folder."""
    spark = df.sparkSession
    folder = folder or fresh(spark, "token-files")
    encoded = encode(df, path, kind, text, doc_id, end_id)
    dtype = encoded.ids_dtype
    ids = written(encoded, "token-ids")
    # As many rows as the vocabulary has ids, at most: bounded by the tokenizer's file.
    count = frequencies(ids, dtype).orderBy(F.desc("n"), "id").collect()
    by_rank = np.array([r.id for r in count], "<u4")
    put(f"{folder}/vocabulary.bin", [by_rank.tobytes()])
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
    rank[by_rank] = np.arange(len(by_rank))
    shared = spark.sparkContext.broadcast(rank)
    # Sort keys are sampled by the driver, so no ids are among them.
    dealt = ids.withColumn("hash", F.xxhash64("ids")).repartitionByRange(F.col("doc_id").asc_nulls_first(), "hash").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "hash", "ids")
    field = ids.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, file = 0, None
        for batch in pieces(batches, "ids", min(1 << 20, file_bytes)):
            if file is None:
                part, file = batch["part"][0].as_py(), _File()
            counts = pc.binary_length(batch["ids"]).to_numpy() // np.dtype(dtype).itemsize
            file.add(batch["doc_id"], counts, shared.value[np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype)])
            if file.size >= file_bytes:
                yield file.put(folder, part, no)
                no, file = no + 1, _File()
        if file is not None and file.counts:
            yield file.put(folder, part, no)

    manifest = written(dealt.select("doc_id", "ids", F.spark_partition_id().alias("part")).mapInArrow(run, MANIFEST), "token-manifest")
    discard(ids)
    manifest.doc_id_field = field
    return manifest, folder


MANIFEST = "part int, file_no int, path string, n_docs long, n_ids long"


class _File:
    """A file's documents, packed as they come."""

    def __init__(self):
        self.docs, self.counts, self.control, self.data, self.pending, self.total, self.size = [], [], [], [], np.zeros(0, "<u4"), 0, 0

    def add(self, docs: pa.Array, counts: np.ndarray, ranks: np.ndarray) -> None:
        self.docs.append(docs)
        self.counts.append(counts)
        self.total += len(ranks)
        ranks = np.concatenate([self.pending, ranks])
        whole = len(ranks) // 4 * 4
        self._pack(ranks[:whole])
        self.pending = ranks[whole:]

    def _pack(self, ranks: np.ndarray) -> None:
        control, data = pack_numbers(ranks)
        self.control.append(control)
        self.data.append(data)
        self.size += len(control) + len(data)

    def put(self, folder: str, part: int, no: int) -> pa.RecordBatch:
        """Writes the file; its row of the manifest."""
        self._pack(self.pending)
        counts = np.concatenate(self.counts)
        control, data = pack_numbers(counts)
        at = f"{folder}/part-{part:06d}-{no:05d}.tkvb"
        put(at, [_head(len(counts), self.total, len(data)), control, data, *self.control, *self.data])
        # The files have no doc_ids: they go beside them, in the manifest's own order.
        put(at + ".ids", [_column(self.docs)])
        values = ((part, pa.int32()), (no, pa.int32()), (at, pa.string()), (len(counts), pa.int64()), (self.total, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in values], names=["part", "file_no", "path", "n_docs", "n_ids"])


def _column(parts: list[pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({"doc_id": pa.chunked_array(parts)})
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def read(manifest: DataFrame, folder: str, field: T.StructField) -> DataFrame:
    """Rows of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    # One row for each partition of the writer; files are added up within theirs.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    upto = np.cumsum([0, *(p.n for p in parts)]).tolist()
    begin = spark.createDataFrame([(p.part, b) for p, b in zip(parts, upto, strict=False)], "p int, begin long")
    earlier = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("part", "file_no", "path", earlier.alias("earlier")).join(F.broadcast(begin), F.col("part") == F.col("p"))
    todo = files.select("part", "file_no", "path", (F.col("begin") + F.col("earlier")).alias("before")).repartitionByRange(max(1, len(parts)), "part", "file_no")
    names = ("start", "n_tokens", "ids_crc32")
    schema = T.StructType([field, *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = None
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["before"].to_pylist(), strict=True):
                if by_rank is None:
                    by_rank = np.frombuffer(get(f"{folder}/vocabulary.bin"), "<u4")
                counts, ranks = read_file(get(path))
                counts = counts.astype(np.int64)
                doc = pa.ipc.open_stream(get(path + ".ids")).read_all()["doc_id"].combine_chunks()
                ids = by_rank[ranks]
                del ranks
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc, pa.array(ends - counts + start), pa.array(counts), pa.array(crc, pa.int64())], names=["doc_id", *names])

    return todo.mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest, folder = write(docs, public_tokenizers.path("word_bpe_49k.json"), "word")
    return read(manifest, folder, manifest.doc_id_field)

