"""Change journals: classes of records, replay into current state, offsets and transactions.

Orders within a flow are by two steps, so a flow's rows need not meet in one task:
ranks within ranges of ``BUCKET`` sequence numbers, and sums over the ranges.

Defined cases: records without arguments change nothing, nor does an HSET without a
whole pair; of a field that a command writes twice its last pair counts; an empty
journal gives an empty state; a snapshot's equal keys and fields count once (the
largest value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Commands on a whole server, and commands that replay applies.
GLOBAL = ["FLUSHDB", "FLUSHALL"]
APPLIED = ["SET", "HSET", "DEL"]
#: Sequence numbers of a flow that are ranked together.
BUCKET = 1 << 16


def classified(journal: DataFrame) -> DataFrame:
    """journal with class: apply, skip_global, unsupported, ping, lsn."""
    cmd = F.upper("cmd")
    kind = F.when(F.col("opcode") == "PING", "ping").when(F.col("opcode") == "LSN", "lsn").when(cmd.isin(GLOBAL), "skip_global").when(cmd.isin(APPLIED), "apply").otherwise("unsupported")
    return journal.withColumn("class", kind)


_WRITES = """case cmd
  when 'SET' then array(struct(args[0] as key, '' as field, false as hashed, 0 as at, get(args, 1) as value, false as gone))
  when 'HSET' then transform(sequence(1, greatest(size(args) - 1, 2) div 2), i -> struct(args[0] as key, get(args, 2 * i - 1) as field, true as hashed, i - 1 as at, get(args, 2 * i) as value, false as gone))
  else transform(args, x -> struct(x as key, '' as field, false as hashed, 0 as at, cast(null as string) as value, true as gone)) end"""


def writes(journal: DataFrame) -> DataFrame:
    """Journal records to what they write: seq, key, field (empty for strings), hashed, at (place in the command), value, gone."""
    live = classified(journal).where((F.col("class") == "apply") & (F.size("args") > 0)).select("seq", "args", F.upper("cmd").alias("cmd"))
    return live.where("cmd <> 'HSET' or size(args) > 2").select("seq", F.explode(F.expr(_WRITES)).alias("w")).select("seq", "w.*")


def current(journal: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """State after replay: key, field (empty for strings), value, seq; the last writer of each key and field wins.

    HSET writes all its pairs, DEL removes all its keys, and a SET replaces a hash (an HSET a string) of its key.
    ``snapshot`` (key, field or null for a string, value) holds what was there before: its seq is -1.
    """
    rows = writes(journal)
    if snapshot is not None:
        before = snapshot.select("key", F.coalesce("field", F.lit("")).alias("field"), F.col("field").isNotNull().alias("hashed"), F.lit(-1).cast("long").alias("seq"), F.lit(0).alias("at"), "value", F.lit(False).alias("gone"))
        rows = rows.unionByName(before)
    # max over (seq, ...) combines before the shuffle, so a hot key sends one row from each task.
    last = rows.where("not gone").groupBy("key", "field", "hashed").agg(F.max(F.struct("seq", "at", "value")).alias("w"))
    of = lambda c, name: F.max(F.when(c, F.col("seq"))).alias(name)
    cuts = rows.groupBy(F.col("key").alias("k")).agg(of(F.col("gone"), "cut"), of(~F.col("gone") & ~F.col("hashed"), "string"), of(F.col("hashed"), "hash"))
    later = F.greatest("cut", F.when(F.col("hashed"), F.col("string")).otherwise(F.col("hash")))  # skips nulls
    return last.join(cuts, F.col("key") == F.col("k")).where(later.isNull() | (F.col("w.seq") > later)).select("key", "field", F.col("w.value").alias("value"), F.col("w.seq").alias("seq"))


def replay_stats(journal: DataFrame) -> DataFrame:
    c = F.col("class")
    return classified(journal).agg(F.count(F.lit(1)).alias("total"), F.count_if(c == "apply").alias("ok"), F.count_if(c.isin("ping", "skip_global")).alias("skipped"), F.count_if(c == "unsupported").alias("failed"))


def last_lsn(journal: DataFrame) -> DataFrame:
    return journal.where("lsn is not null").groupBy("flow").agg(F.max_by("lsn", "seq").alias("lsn"))


def _ranked(df: DataFrame, *columns: str) -> DataFrame:
    """flow, seq and columns with ``bucket`` and ``local``, the rank within it."""
    rows = df.select("flow", "seq", *columns, F.expr(f"seq div {BUCKET}").alias("bucket"))
    return rows.withColumn("local", F.row_number().over(Window.partitionBy("flow", "bucket").orderBy("seq")).cast("long"))


def _over_buckets(ranked: DataFrame, *more) -> DataFrame:
    """One row for each bucket (f, b): its n, the rows of its flow before it, and more aggregates."""
    parts = ranked.groupBy(F.col("flow").alias("f"), F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("n"), *more)
    return parts.withColumn("before", F.sum("n").over(Window.partitionBy("f").orderBy("b")) - F.col("n"))


def acks(journal: DataFrame) -> DataFrame:
    """Running acknowledgement of each flow: an LSN record jumps ahead if it is greater, any other record adds 1."""
    ranked = _ranked(journal, "lsn")
    jump = F.max(F.col("lsn") - F.col("local"))
    earlier = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    parts = _over_buckets(ranked, jump.alias("most")).withColumn("ahead", F.max(F.col("most") - F.col("before")).over(earlier))
    own = jump.over(Window.partitionBy("flow", "bucket").orderBy("seq"))
    rows = ranked.withColumn("own", own).join(parts.select("f", "b", "before", "ahead"), (F.col("flow") == F.col("f")) & (F.col("bucket") == F.col("b")))
    return rows.select("flow", "seq", (F.col("before") + F.col("local") + F.greatest(F.lit(0), F.coalesce(F.greatest("ahead", F.col("own") - F.col("before")), F.lit(0)))).alias("ack"))


def transactions(journal: DataFrame) -> DataFrame:
    """txid, the flows seen, and whether as many as its shard count are."""
    return journal.groupBy("txid").agg(F.count_distinct("flow").alias("flows"), F.max("shard_cnt").alias("shards")).withColumn("complete", F.col("flows") >= F.col("shards"))


def batches(df: DataFrame, size: int = 500) -> DataFrame:
    """flow, seq and the number of its batch of ``size`` rows."""
    ranked = _ranked(df)
    parts = _over_buckets(ranked).select("f", "b", "before")
    return ranked.join(parts, (F.col("flow") == F.col("f")) & (F.col("bucket") == F.col("b"))).select("flow", "seq", F.expr(f"(before + local - 1) div {int(size)}").alias("batch"))
