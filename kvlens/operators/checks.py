"""Comparison of two keyspaces: one equi-join on the key, one verdict per source key.

Payload columns enter the join only in the modes that compare them. Defined cases:
a null key matches nothing and is missing; null payloads equal each other; repeated
target keys count once (the largest row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("outline", "smart", "length", "full")
MISSING, TYPE, LENGTH, VALUE, TTL, SAME = "missing", "type_mismatch", "length_mismatch", "value_mismatch", "ttl_mismatch", "consistent"


def length(kind: str = "type", canon: str = "canon"):
    """Characters of a string, else elements of a collection."""
    k, c = F.col(kind), F.col(canon)
    parts = lambda sep: F.size(F.split(c, sep)).cast("long")
    return F.when(k == "string", F.length(c).cast("long")).when(k == "hash", parts(";")).otherwise(parts(","))


def compare(src: DataFrame, tgt: DataFrame, mode: str = "full", big: int = 5000, as_built: bool = False) -> DataFrame:
    """key, type, target_type and verdict.

    outline: existence, type and TTL; length: lengths too; smart: lengths, and values of
    keys of at most ``big`` elements; full: all. ``as_built``: outline and smart stop at types, length compares values.
    """
    if mode not in MODES:
        raise ValueError(mode)
    values = mode in ("full", "smart") if not as_built else mode in ("full", "length")
    lengths = mode in ("length", "smart", "full") if not as_built else False
    ttl = not as_built
    columns = ["key", "type", *(["expire_ms"] if ttl else []), *(["canon"] if values or lengths else [])]
    right = tgt.select(F.col("key").alias("k2"), F.struct(*columns[1:]).alias("t")).groupBy("k2").agg(F.max("t").alias("t")).select("k2", F.col("t.type").alias("target_type"), *[F.col(f"t.{c}").alias(f"{c}2") for c in columns[2:]])
    both = src.select(*columns).join(right, F.col("key") == F.col("k2"), "left")
    verdict = F.when(F.col("k2").isNull(), MISSING).when(F.col("type") != F.col("target_type"), TYPE)
    if lengths:
        verdict = verdict.when(length() != length("type", "canon2"), LENGTH)
    if values:
        small = length() <= big if mode == "smart" and not as_built else F.lit(True)
        verdict = verdict.when(small & ~F.col("canon").eqNullSafe(F.col("canon2")), VALUE)
    if ttl:
        verdict = verdict.when(F.col("expire_ms") != F.col("expire_ms2"), TTL)
    return both.select("key", "type", "target_type", verdict.otherwise(SAME).alias("verdict"))


def summary(found: DataFrame) -> DataFrame:
    of = lambda *v: F.count_if(F.col("verdict").isin(*v))
    return found.agg(F.count(F.lit(1)).alias("total"), of(SAME).alias("consistent"), F.count_if(F.col("verdict") != SAME).alias("inconsistent"), of(MISSING).alias("missing"))


def missing(src: DataFrame, tgt: DataFrame) -> DataFrame:
    return src.select("key", "type").join(tgt.select("key").distinct(), "key", "left_anti")


def extra(src: DataFrame, tgt: DataFrame) -> DataFrame:
    return missing(tgt, src)


def common(src: DataFrame, tgt: DataFrame) -> DataFrame:
    return src.select("key").join(tgt.select("key"), "key", "left_semi").distinct()


def key_filter(df: DataFrame, pattern: str) -> DataFrame:
    """Rows whose key has one of the ``|``-parted patterns: a prefix where it ends in ``*``, else the whole key."""
    hit = F.lit(False)
    for p in filter(None, (x.strip() for x in pattern.split("|"))):
        hit = hit | (F.col("key").startswith(p[:-1]) if p.endswith("*") else F.col("key") == p)
    return df.where(hit)


def resolve(src: DataFrame, tgt: DataFrame, policy: str = "overwrite") -> DataFrame:
    """Rows of a target after an import: overwrite or skip keys it has; panic gives the keys in conflict."""
    ours, theirs = src.select("key", "type", "canon"), tgt.select("key", "type", "canon")
    if policy == "overwrite":
        return ours.unionByName(theirs.join(ours.select("key"), "key", "left_anti"))
    if policy == "skip":
        return theirs.unionByName(ours.join(theirs.select("key"), "key", "left_anti"))
    if policy == "panic":
        return common(ours, theirs)
    raise ValueError(policy)
