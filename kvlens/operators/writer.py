"""Sinks' batches: numbering without a window over a whole node, groups, rendering, filters by allow and block lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chunks(routed: DataFrame, size: int = 500) -> DataFrame:
    """key, node, chunk: rows of a node by (slot, key) in chunks of ``size``.

    A row's number is its rank within its slot and the count of the node's earlier
    slots: the sort is of one slot, and what is summed is at most one row per slot.
    """
    counts = routed.groupBy("node", "slot").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("node").orderBy("slot")) - F.col("n")
    first = counts.select(F.col("slot").alias("s"), before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("slot").orderBy("key")) - 1
    ranked = routed.select("key", "node", "slot", rank.alias("rank"))
    return ranked.join(first, F.col("slot") == F.col("s")).select("key", "node", F.expr(f"(before + rank) div {int(size)}").alias("chunk"))


def replacing(df: DataFrame, commands: dict[str, str], as_of_ms: int) -> DataFrame:
    """key, step, command: DEL, the write, and PEXPIRE of what is left of its life, if any is."""
    name = F.lit(None).cast("string")
    for kind, cmd in commands.items():
        name = F.when(F.col("type") == kind, cmd).otherwise(name)
    left = F.col("expire_ms") - as_of_ms
    steps = F.array(F.concat_ws(" ", F.lit("DEL"), "key"), F.concat_ws(" ", name, "key", "canon"), F.when((F.col("expire_ms") > 0) & (left > 0), F.concat_ws(" ", F.lit("PEXPIRE"), "key", left.cast("string"))))
    return df.where(name.isNotNull()).select("key", F.posexplode(F.array_compact(steps)).alias("step", "command")).withColumn("step", F.col("step").cast("long"))


def allowed(df: DataFrame, allow: dict, block: dict, key: str = "key") -> DataFrame:
    """Rows that an allow rule names (all, without rules) and no block rule does.

    Rules: keys, prefixes, suffixes, patterns (regular expressions), types. Null keys match no rule.
    """
    k = F.coalesce(F.col(key), F.lit(""))

    def hit(rules: dict):
        out = k.isin(list(rules.get("keys", []))) if rules.get("keys") else F.lit(False)
        for p in rules.get("prefixes", []):
            out = out | k.startswith(p)
        for s in rules.get("suffixes", []):
            out = out | k.endswith(s)
        for r in rules.get("patterns", []):
            out = out | k.rlike(r)
        return out | F.col("type").isin(list(rules["types"])) if rules.get("types") else out

    return df.where((hit(allow) if allow else F.lit(True)) & ~hit(block))
