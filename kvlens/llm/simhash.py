"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits. They are cut into ``blocks`` blocks; two fingerprints
that differ in at most ``max_bits`` bits agree on at least ``blocks - max_bits``
whole blocks, so they share one of the keys made of that many blocks. Rows join
on those keys and each pair in a bucket is verified by its Hamming distance.

Work is on distinct fingerprints: however many copies a text has, it is one row.
A bucket of up to ``bucket_limit`` fingerprints is verified pair by pair in
memory and gives only a spanning forest of its links (the closure is the same).
A larger bucket is never gathered: each of its fingerprints is expanded to all
values within half the distance, and two fingerprints are within ``max_bits`` if
and only if they share such a value, so one equi-aggregation over these values
gives the same closure with cost in proportion to the bucket.

Defined cases: a null text counts as empty; texts without words have fingerprint
zero and link like any other; repeated rows each get their row; null doc_ids are
ignored when the least doc_id of a component is taken (null if there is no other).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import with_columns
from .components import components
from .storage import written

SEED = 42
BITS = 64


def hashed(text: str, words: int = 4) -> np.ndarray:
    """The XXH64 of a text's shingles, in text order; a text of fewer words is one shingle."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(parts) - words + 1].tolist()
    return np.fromiter([digest(joined[a:b], SEED) for a, b in zip(start, end[words - 1 :].tolist(), strict=True)], np.uint64, len(start))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    set_bits = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        part = hashes[a : a + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    on = np.flatnonzero(set_bits * 2 > len(hashes))
    return sum(1 << int(b) for b in on)


def fingerprint(text: str, words: int = 4) -> int:
    """The SimHash of a text: a bit is set if it is set in over half the shingles' XXH64."""
    return majority(hashed(text, words))


def with_fingerprint(df: DataFrame, text: str = "text", words: int = 4, name: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """df with a long column: the fingerprint's 64 bits as a signed number."""

    def make():
        def call(rows: list[str]) -> list:
            return [np.array([fingerprint(t, words) for t in rows], np.uint64).view(np.int64)]

        return call

    return with_columns(df, text, [T.StructField(name, T.LongType())], make, keep)


def _masks(blocks: int, agree: int) -> list[tuple[int, int]]:
    """For each choice of ``agree`` blocks: its number and the mask of their bits, as a signed long."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    one = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [(k, signed(sum(one[i] for i in c))) for k, c in enumerate(combinations(range(blocks), agree))]


def _blocks(distinct: int, max_bits: int) -> int:
    """The fewest blocks whose keys are long enough that about 64 unrelated fingerprints at most share one."""
    return next((b for b in range(max_bits + 2, 2 * max_bits + 5) if distinct >> int(BITS * (b - max_bits) / b) <= 64), 2 * max_bits + 4)


def _forest(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of close pairs within each run of equal keys (rows sorted by key)."""
    n = len(fp)
    label = np.arange(n)
    out_a, out_b = [], []
    rows = np.arange(n)
    for d in range(1, n):
        rows = rows[rows + d < n]
        rows = rows[key[rows] == key[rows + d]]
        if not len(rows):
            break
        apart = rows[label[rows] != label[rows + d]]
        near = apart[np.bitwise_count(fp[apart] ^ fp[apart + d]) <= max_bits]
        for i in near.tolist():
            a, b = i, i + d
            while label[a] != a:
                label[a] = label[label[a]]
                a = label[a]
            while label[b] != b:
                label[b] = label[label[b]]
                b = label[b]
            if a != b:
                label[max(a, b)] = min(a, b)
                out_a.append(i)
                out_b.append(i + d)
        if len(near):
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return np.array(out_a, np.int64), np.array(out_b, np.int64)


def _flips(half: int) -> np.ndarray:
    """All 64-bit masks with at most ``half`` bits set."""
    return np.array([sum(1 << i for i in c) for k in range(half + 1) for c in combinations(range(BITS), k)], np.uint64)


def links(prints: DataFrame, max_bits: int = 4, blocks: int = 6, bucket_limit: int = 4096) -> DataFrame:
    """Distinct fingerprints (long ``fp``) to links (u, v) whose closure is that of all pairs within ``max_bits``."""
    masks = F.array(*[F.struct(F.lit(k).alias("no"), F.lit(m).cast("long").alias("mask")) for k, m in _masks(blocks, blocks - max_bits)])
    keyed = prints.select("fp", F.explode(masks).alias("m")).select("fp", F.xxhash64(F.col("m.no"), F.col("fp").bitwiseAND(F.col("m.mask"))).alias("key"))
    keyed = written(keyed, "simhash-keys")
    counts = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "k"), "simhash-counts")
    shared = keyed.join(counts, F.col("key") == F.col("k"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_k, left_f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def linked(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = _forest(k, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(f[a].view(np.int64)), pa.array(f[b].view(np.int64))], names=["u", "v"])

        for batch in batches:
            k = np.concatenate([left_k, batch["key"].to_numpy()])
            f = np.concatenate([left_f, batch["fp"].to_numpy().view(np.uint64)])
            if not len(k):
                continue
            whole = int(np.searchsorted(k, k[-1], "left"))  # the last key may go on in the next batch
            if whole:
                yield linked(k[:whole], f[:whole])
            left_k, left_f = k[whole:], f[whole:]
        if len(left_k):
            yield linked(left_k, left_f)

    small = shared.where(F.col("n") <= bucket_limit).select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(verify, "u long, v long")

    half = max_bits // 2
    # Values within half the distance: pairs at 2 * half or less meet; an odd max_bits needs the larger half on one side.
    far = max_bits - half

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = _flips(far)
        near = np.bitwise_count(flips) <= half
        for batch in batches:
            for f in batch["fp"].to_numpy().view(np.uint64):
                yield pa.RecordBatch.from_arrays([pa.array((flips ^ f).view(np.int64)), pa.array(np.full(len(flips), f).view(np.int64)), pa.array(near)], names=["mid", "fp", "near"])

    hot = written(shared.where(F.col("n") > bucket_limit).select("fp").distinct(), "simhash-hot")
    if hot.isEmpty():
        return small
    met = hot.mapInArrow(spread, "mid long, fp long, near boolean")
    # Every fingerprint at a shared value links to the least one that is within ``half`` of it; with an even max_bits all are.
    best = met.where("near").groupBy("mid").agg(F.min("fp").alias("m")).select(F.col("mid").alias("at"), "m")
    wide = met.join(best, F.col("mid") == F.col("at")).where("fp <> m").select(F.col("fp").alias("u"), F.col("m").alias("v"))
    return small.union(wide.distinct())


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4, blocks: int | None = None, bucket_limit: int = 4096) -> DataFrame:
    """One row per row of df: doc_id, fp (long), component_id (the least doc_id that it reaches over links)."""
    prints = written(with_fingerprint(df, text, words, "fp", [doc_id]).withColumnRenamed(doc_id, "doc_id"), "simhash-prints")
    return grouped(prints, max_bits, blocks, bucket_limit)


def grouped(prints: DataFrame, max_bits: int = 4, blocks: int | None = None, bucket_limit: int = 4096) -> DataFrame:
    """Rows (doc_id, fp) with their component_id; prints must be cheap to read again."""
    least = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    blocks = blocks or _blocks(least.count(), max_bits)
    found = components(links(least.select("fp"), max_bits, blocks, bucket_limit))
    found = written(found, "simhash-roots")
    labelled = written(least.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-labelled")
    best = written(labelled.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r"), "simhash-best")
    named = written(labelled.join(best, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id"), "simhash-named")
    return prints.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def op9(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
