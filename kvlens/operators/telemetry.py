"""Throughput and latency over samples (flow, us, n, latency, id).

Percentiles are the element at floor(n * p) of the sorted values, counted from 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERCENTS = (50, 95, 99)


def qps(samples: DataFrame, span_us: int = 3_600_000_000) -> DataFrame:
    """id, flow, and the ops of the trailing span with its oldest time."""
    w = Window.partitionBy("flow").orderBy("us").rangeBetween(-(span_us - 1), 0)
    return samples.select("id", "flow", F.sum("n").over(w).alias("ops"), (F.col("us") - F.min("us").over(w)).alias("span_us"))


def percentiles(samples: DataFrame) -> DataFrame:
    """Per flow: p50, p95, p99 and max latency, count. Ranks come from value counts, so no flow's samples meet in one task."""
    counts = samples.groupBy("flow", "latency").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("flow").orderBy("latency")
    ranked = counts.withColumn("upto", F.sum("c").over(upto)).withColumn("total", F.sum("c").over(Window.partitionBy("flow")))
    at = lambda p: F.min(F.when(F.col("upto") > F.expr(f"total * {p} div 100"), F.col("latency"))).alias(f"p{p}")
    return ranked.groupBy("flow").agg(*[at(p) for p in PERCENTS], F.max("latency").alias("max_latency"), F.max("total").alias("samples"))


def last_n(samples: DataFrame, n: int) -> DataFrame:
    """The newest n samples of each flow: its rows pass a window group limit before the shuffle."""
    w = Window.partitionBy("flow").orderBy(F.desc("us"), F.desc("id"))
    return samples.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def coalesced(samples: DataFrame, every_us: int = 2_000_000) -> DataFrame:
    """The last latency of each flow in each span of time."""
    return samples.groupBy("flow", F.expr(f"us div {int(every_us)}").alias("span")).agg(F.max_by("latency", F.struct("us", "id")).alias("latency"))
