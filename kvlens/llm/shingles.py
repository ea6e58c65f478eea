"""Near copies by the share of common shingles: SimHash candidates and an exact prefix join.

A text is the set of its shingles' XXH64, cut to 48 bits. Two texts are
linked if their sets' Jaccard similarity is 4/5 or more; every link is verified on
the whole sets. Work is on distinct sets, so exact copies cost nothing.

No radius in bits holds this bound, so candidates have two sources. Fingerprints
within ``max_bits`` (pigeonhole blocks) come first. The prefix join finds the rest
without a miss: with all shingles in one order, two sets of n shingles that are
linked share one of their first n - ceil(4n/5) + 1 each. The order is rare first,
by counts over all sets, so shingles that a set alone holds come before all others
and two sets that each have too many of these never meet.

Of the sets at a shared shingle each is first compared with the one that has the
fewest shingles alone: of edited copies of a text that is the least edited. Then
all pairs that these links leave in different components are compared, so the
closure is that of all pairs, and a large group of near copies isn't squared.

Defined cases: a null text counts as empty; texts without words are copies of each
other and near no other text; a text of fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import each, pieces, with_columns
from .components import components
from .resident import release
from .simhash import _blocks, hashed, links, majority
from .storage import bucketed, discard, freed, written

#: Bytes of shingles that are packed at a time; shingles of a bucket, on average.
PACK, BUCKET = 1 << 23, 1 << 20
#: Bytes of a shingle's hash.
WIDTH = 6


def needed(n):
    """The least number of common shingles of a set of ``n`` with a linked one: ceil(4n/5)."""
    return (4 * n + 4) // 5


def _raw(hashes: np.ndarray) -> bytes:
    """A text's set: the distinct upper 48 bits of its hashes, ascending, six bytes each."""
    return np.unique(hashes >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def _set(raw) -> np.ndarray:
    narrow = np.frombuffer(raw, np.uint8).reshape(-1, WIDTH)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :WIDTH] = narrow
    return wide.view("<u8").ravel()


def with_set(df: DataFrame, text: str = "text", words: int = 5, keep: list[str] | None = None, whole: bool = True) -> DataFrame:
    """df with a long ``sig`` (the set's hash) and, if ``whole``, ``fp``, ``n`` and the sorted set as bytes."""
    import xxhash

    fields = [T.StructField("sig", T.LongType())]
    if whole:
        fields += [T.StructField("fp", T.LongType()), T.StructField("n", T.LongType()), T.StructField("shingles", T.BinaryType())]

    def make():
        release()

        def call(rows: list[str]) -> list:
            every = [hashed(t, words) for t in rows]
            sets = [_raw(h) for h in every]
            sig = np.array([xxhash.xxh3_64_intdigest(s) for s in sets], np.uint64).view(np.int64)
            if not whole:
                return [sig]
            return [sig, np.array([majority(h) for h in every], np.uint64).view(np.int64), [len(s) // WIDTH for s in sets], sets]

        return call

    return with_columns(df, text, fields, make, keep)


def _packed(buckets: int):
    """Rows of sets to rows (bucket, piece, head, data): a piece's shingles by bucket, and its sets' sig and n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([batch]), "shingles", PACK):
                for low in range(0, len(part), 1 << 16):
                    yield from packed(part.slice(low, 1 << 16))

    def packed(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sig, n = part["sig"].to_numpy(), part["n"].to_numpy()
        x = _set(b"".join(part["shingles"].to_pylist()))
        at = ((x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(16)).astype(np.uint16)
        order = np.argsort(at, kind="stable")
        of = np.repeat(np.arange(len(n)), n).astype("<u2")[order]
        x, at = x.astype("<u4")[order], at[order]
        cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(x) else np.empty(0, np.int64)
        data = [x[a:b].tobytes() + of[a:b].tobytes() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(x)], strict=False)]
        bucket = np.append(at[cuts].astype(np.int32), np.int32(int(sig[0]) % buckets))
        head = np.arange(len(bucket)) == len(cuts)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(bucket), sig[0])), pa.array(head), pa.array([*data, sig.tobytes() + n.tobytes()], pa.binary())], names=["bucket", "piece", "head", "data"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket: each row's shingles that occur again in the bucket, and how often; heads as they are."""
    for table in each(batches, "bucket"):
        table = table.combine_chunks()
        heads = table.filter(table["head"])
        if len(heads):
            yield from heads.to_batches()
        table = table.filter(pc.invert(table["head"]))
        data = table["data"].to_pylist()
        if not data:
            continue
        size = np.array([len(d) // 6 for d in data], np.int64)
        x = np.concatenate([np.frombuffer(d, "<u4", s) for d, s in zip(data, size.tolist(), strict=True)])
        of = np.concatenate([np.frombuffer(d, "<u2", s, 4 * s) for d, s in zip(data, size.tolist(), strict=True)])
        order = np.argsort(x, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], x[order][1:] != x[order][:-1]]))
        times = np.diff(np.append(start, len(x)))
        count = np.empty(len(x), np.int64)
        count[order] = np.repeat(times, times)
        again = count > 1
        ends = np.cumsum(size)
        kept = np.concatenate([[0], np.cumsum(again)[ends - 1]]).tolist()
        x, of, count = x[again], of[again], np.minimum(count[again], 0xFFFF).astype("<u2")
        out = [x[a:b].tobytes() + of[a:b].tobytes() + count[a:b].tobytes() for a, b in zip(kept, kept[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["bucket"], table["piece"], table["head"])] + [pa.array(out, pa.binary())], names=["bucket", "piece", "head", "data"])


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by piece: the entries of each of its sets."""
    for table in each(batches, "piece"):
        rows = table.to_pylist()
        sig = n = None
        tokens, of, count = [], [], []
        for r in rows:
            d = r["data"]
            if r["head"]:
                sig, n = np.frombuffer(d, np.int64).reshape(2, -1)
                continue
            s = len(d) // 8
            tokens.append(np.frombuffer(d, "<u4", s).astype(np.int64) | np.int64(r["bucket"] << 32))
            of.append(np.frombuffer(d, "<u2", s, 4 * s).astype(np.int64))
            count.append(np.frombuffer(d, "<u2", s, 6 * s))
        if not tokens:
            continue
        tokens, of, count = np.concatenate(tokens), np.concatenate(of), np.concatenate(count)
        if not len(tokens):
            continue
        order = np.lexsort((tokens, count, of))
        tokens, of = tokens[order], of[order]
        many = np.bincount(of, minlength=len(n))
        alone = n - many
        at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + alone[of]
        # Two shingles of a set that count as one stand at the place of the first.
        k = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])]) & (at <= n[of] - needed(n[of]))
        of = of[k]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (tokens[k], sig[of], n[of], at[k], alone[of])], names=["token", "sig", "n", "at", "alone"])


def prefixes(sets: DataFrame) -> DataFrame:
    """(token, sig, n, at, alone): of each set's first shingles in the common order those that another set has, their places in it, and how many of the set's shingles no other has.

    The order is by the number of sets that hold a shingle, counted over all sets. Shingles cross the
    network packed, in buckets by their upper bits; within one they count by their lower 32.
    """
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = min(1 << 16, max(1, -(-total // BUCKET)))
    row = "bucket int, piece long, head boolean, data binary"
    packed = sets.select("sig", "n", "shingles").mapInArrow(_packed(buckets), row)
    counted = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_counted, row)
    return counted.repartition("piece").sortWithinPartitions("piece").mapInArrow(_first, "token long, sig long, n long, at long, alone long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) of sets that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch["a"], batch["b"], strict=True):
                x, y = _set(a.as_buffer()), _set(b.as_buffer())
                common = len(x) + len(y) - len(np.union1d(x, y))
                good.append(5 * common >= 4 * (len(x) + len(y) - common) and common > 0)
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("sig").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("sig").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def linked(sets: DataFrame, max_bits: int = 4, bucket_limit: int = 4096) -> DataFrame:
    """Distinct sets to (node, root): the components of all pairs that are linked."""
    # Fingerprints: a set with the least of its fingerprint, and the least ones of close fingerprints.
    prints = written(sets.groupBy("fp").agg(F.min("sig").alias("first")), "shingles-prints")
    near = links(prints.select("fp"), max_bits, _blocks(prints.count(), max_bits), bucket_limit)
    a = prints.select(F.col("fp").alias("u"), F.col("first").alias("a"))
    b = prints.select(F.col("fp").alias("v"), F.col("first").alias("b"))
    close = near.join(a, "u").join(b, "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    same = sets.select("fp", "sig").join(prints.withColumnRenamed("fp", "f"), F.col("fp") == F.col("f")).select(F.col("sig").alias("u"), F.col("first").alias("v"))

    entries = written(prefixes(sets), "shingles-prefixes")
    freed(sets.sparkSession)
    # Counted by the token alone, so that no more than it crosses the network; sets are named once few entries are left.
    counts = entries.groupBy("token").count().where("count > 1").select(F.col("token").alias("t"))
    shared = written(entries.join(counts, F.col("token") == F.col("t")).drop("t"), "shingles-shared")
    freed(sets.sparkSession, entries)
    firsts = shared.groupBy("token").agg(F.min(F.struct("alone", "sig", "n")).alias("first")).select(F.col("token").alias("t"), "first")
    sizes = lambda x, y: (5 * x >= 4 * y) & (5 * y >= 4 * x)
    own = 9 * F.least(F.col("n") - F.col("alone"), F.col("first.n") - F.col("first.alone")) >= 4 * (F.col("n") + F.col("first.n"))
    star = shared.join(firsts, F.col("token") == F.col("t")).where(sizes(F.col("n"), F.col("first.n")) & own).select(F.col("sig").alias("u"), F.col("first.sig").alias("v"))
    pairs = written(close.union(same).union(star).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "shingles-pairs")
    found = written(verified(pairs, sets), "shingles-links")

    root = written(components(found), "shingles-roots")
    placed = shared.join(root, F.col("sig") == F.col("node"), "left").select("token", "sig", "n", "at", F.coalesce("root", "sig").alias("root"))
    placed = written(placed, "shingles-placed")
    discard(shared)
    mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(F.col("token").alias("t"))
    open_ = written(placed.join(mixed, F.col("token") == F.col("t")).drop("t"), "shingles-open")
    freed(sets.sparkSession, placed)
    x, y = open_.alias("x"), open_.alias("y")
    # The first common shingle of two sets leaves so many at most; a linked pair passes at that one.
    left = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    passes = (F.col("x.sig") < F.col("y.sig")) & (F.col("x.root") != F.col("y.root")) & sizes(F.col("x.n"), F.col("y.n")) & (9 * left >= 4 * (F.col("x.n") + F.col("y.n")))
    rest = x.join(y, (F.col("x.token") == F.col("y.token")) & passes).select(F.col("x.sig").alias("u"), F.col("y.sig").alias("v")).distinct()
    rest = written(rest.join(pairs, ["u", "v"], "left_anti"), "shingles-pairs")
    more = written(verified(rest, sets), "shingles-links")
    freed(sets.sparkSession, open_, rest, pairs)
    return components(found.union(more))


def near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """One row per row of df: doc_id, sig, and component_id and component_sig (those of the least doc_id of its near copies, null last)."""
    rows = written(with_set(df, text, words, [doc_id], False).withColumnRenamed(doc_id, "doc_id"), "shingles-rows")
    # Whole sets are hashed again, so that they are written once: distinct, and where joins on them find them.
    sets = bucketed(with_set(df, text, words, []).dropDuplicates(["sig"]), "shingles-sets", "sig")
    freed(df.sparkSession)
    root = written(linked(sets), "shingles-roots")
    freed(df.sparkSession, sets)
    named = rows.select("doc_id", "sig").join(root, F.col("sig") == F.col("node"), "left").select("doc_id", "sig", F.coalesce("root", "sig").alias("root"))
    named = written(named, "shingles-named")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig")).alias("least")
    best = named.groupBy("root").agg(least).select(F.col("root").alias("r"), F.col("least.doc_id").alias("component_id"), F.col("least.sig").alias("component_sig"))
    return named.join(best, F.col("root") == F.col("r")).select("doc_id", "sig", "component_id", "component_sig")
