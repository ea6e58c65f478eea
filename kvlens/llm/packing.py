"""Harmonic packing of documents into sequences of a fixed capacity.

Class j holds pieces of lengths in (capacity / (j + 1), capacity / j]; a bin of
class j takes exactly j pieces, whatever their lengths. A document gives whole
sequences (class 1, full) as long as it can; of the rest, a length that fills
its class's slot but for a small share is a piece of that class, any other gives
a piece that fills a slot of the next class exactly, and the remainder is looked
at again. Bins are filled by each worker alone, as rows stream by: no shuffle,
no row waits for another worker, and a bin is given out as soon as it is full.

At a partition's end the pieces of unfilled bins are laid end to end and cut
anew at the capacity; the last of those sequences is cut into lengths that are
powers of two, which need no padding.

Defined cases: null and empty texts are the end id alone; repeated rows are
documents of their own; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import pieces
from .encoding import PIECE, chunk_encoder

CAPACITY = 1024
#: The share of a slot that may stay empty.
SLACK = 1 / 128


def cuts(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(class, length) of a document's pieces, in order."""
    out = [(1, capacity)] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        slot = capacity // j
        if slot - rest <= slack * slot:
            out.append((j, rest))
            break
        out.append((j + 1, capacity // (j + 1)))
        rest -= capacity // (j + 1)
    return out


class Packer:
    """Takes documents' ids; gives rows (document, start, ids, sequence, offset) of bins as they fill."""

    def __init__(self, capacity: int = CAPACITY, slack: float = SLACK, first: int = 0):
        self.capacity, self.slack, self.next, self.open = capacity, slack, first, {}
        self.known: dict[int, list[tuple[int, int]]] = {}

    def _close(self, bin_: list) -> Iterator[tuple]:
        at = 0
        for doc, start, ids in bin_:
            yield doc, start, ids, self.next, at
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        size, at = len(ids), 0
        rest = size % self.capacity
        if rest not in self.known:
            self.known[rest] = cuts(rest, self.capacity, self.slack)
        for j, n in [(1, self.capacity)] * (size // self.capacity) + self.known[rest]:
            bin_ = self.open.setdefault(j, [])
            bin_.append((doc, at, ids[at : at + n]))
            at += n
            if len(bin_) == j:
                del self.open[j]
                yield from self._close(bin_)

    def finish(self) -> Iterator[tuple]:
        left = [p for j in sorted(self.open) for p in self.open[j]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in range(self.capacity.bit_length() - 1, -1, -1) if total % self.capacity >> b & 1]
        k, used = 0, 0
        for size in sizes:
            bin_, room = [], size
            while room:
                doc, start, ids = left[k]
                part = ids[used : used + room]
                bin_.append((doc, start + used, part))
                room -= len(part)
                used += len(part)
                if used == len(ids):
                    k, used = k + 1, 0
            yield from self._close(bin_)


def pack(df: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", end_id: int = 0, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    sequence_ids are unique, not consecutive: the high bits number the partition.
    """
    source = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"), F.spark_partition_id().alias("part"))
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("start", "length")], T.StructField("ids", T.BinaryType()), *[T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, "byte")
        packer, kind = None, None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, sequence, offset = zip(*rows, strict=True) if rows else ([],) * 5
            numbers = lambda x: pa.array(x, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in doc], kind), numbers(start), numbers([len(i) for i in ids]), pa.array([i.tobytes() for i in ids], pa.binary()), numbers([d[1] for d in doc]), numbers(sequence), numbers(offset)], names=schema.names)

        for piece in pieces(batches, "text", PIECE):
            if packer is None:
                packer, kind = Packer(capacity, slack, piece["part"][0].as_py() << 40), piece["doc_id"].type
            rows = []
            ids, count = encoder.encode_array(piece["text"], end_id)
            for doc, own in zip(piece["doc_id"].to_pylist(), np.split(ids, np.cumsum(count)[:-1]), strict=True):
                rows += packer.add((doc, len(own)), own)
            yield batch(rows)
        if packer is not None:
            yield batch(list(packer.finish()))

    return source.mapInArrow(run, schema)


def op7(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    found = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
