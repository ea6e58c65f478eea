"""Replay of collection commands: lists, sets, sorted sets, streams, expiries.

State is kept as rows, one for each element, so a key with very many elements is
never gathered in one task. DEL of a key removes what was written before it.

Defined cases: commands without a key change nothing; a member written twice counts
once, with its last score; the conditions of a ZADD (NX, XX, GT, LT) and its CH and
INCR are no scores, but aren't evaluated; relative times count from ``as_of_ms``, as
the log holds no clock; an id that is not a number is left out of a trim.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _arg(i: int):
    return F.get("args", F.lit(i))


def surviving(log: DataFrame, *commands: str) -> DataFrame:
    """Rows of the commands that no later DEL of their key removes: key, seq, cmd, args."""
    rows = log.where(F.size("args") > 0).select(_arg(0).alias("key"), "seq", F.upper("cmd").alias("cmd"), "args")
    cut = rows.where("cmd = 'DEL'").select(F.explode("args").alias("k"), "seq").groupBy("k").agg(F.max("seq").alias("cut"))
    return rows.where(F.col("cmd").isin(*commands)).join(cut, F.col("key") == F.col("k"), "left").where("cut is null or seq > cut").drop("k", "cut")


def lists(log: DataFrame) -> DataFrame:
    """key, pos, item: RPUSH appends at a rising position, LPUSH at a falling one; a list is its items by pos.

    A command has at most 1048576 arguments (the protocol's limit), so positions are apart.
    """
    rows = surviving(log, "RPUSH", "LPUSH").select("key", "seq", "cmd", F.posexplode(F.expr("slice(args, 2, size(args))")).alias("i", "item"))
    at = F.col("seq") * 1048576 + F.col("i")
    return rows.select("key", F.when(F.col("cmd") == "RPUSH", at).otherwise(-at).alias("pos"), "item")


def sets(log: DataFrame) -> DataFrame:
    return surviving(log, "SADD").select("key", F.explode(F.expr("slice(args, 2, size(args))")).alias("member")).distinct()


# Options of ZADD that stand before its pairs, and options of SET with how much a unit is and whether from now on.
ZADD_OPTIONS = ("NX", "XX", "GT", "LT", "CH", "INCR")
SET_TIMES = {"EX": (1000, True), "PX": (1, True), "EXAT": (1000, False), "PXAT": (1, False)}
EXPIRE_TIMES = {"EXPIRE": (1000, True), "PEXPIRE": (1, True), "EXPIREAT": (1000, False), "PEXPIREAT": (1, False)}


def sorted_sets(log: DataFrame) -> DataFrame:
    """key, member, score: each member's last score, of all pairs of a command; a score that isn't a number is 0."""
    options = ", ".join(f"'{o}'" for o in ZADD_OPTIONS)
    rest = surviving(log, "ZADD").withColumn("rest", F.expr("slice(args, 2, size(args))"))
    first = F.coalesce(F.nullif(F.expr(f"array_position(transform(rest, x -> upper(x) in ({options})), false)"), F.lit(0)), F.size("rest") + 1)
    rest = rest.withColumn("first", first.cast("int")).withColumn("rest", F.expr("slice(rest, first, size(rest))"))
    each = rest.where("size(rest) > 1").select("key", "seq", F.posexplode(F.expr("transform(sequence(1, size(rest) div 2), i -> struct(rest[2 * i - 2] as score, rest[2 * i - 1] as member))")).alias("i", "p"))
    return each.groupBy("key", F.col("p.member").alias("member")).agg(F.expr("coalesce(try_cast(max_by(p.score, struct(seq, i)) as double), 0d)").alias("score"))


def deleted(log: DataFrame) -> DataFrame:
    """Keys whose last command is a DEL, of one key or several."""
    rows = log.where(F.size("args") > 0).select(F.explode(F.when(F.upper("cmd") == "DEL", F.col("args")).otherwise(F.array(_arg(0)))).alias("key"), "seq", (F.upper("cmd") == "DEL").alias("gone"))
    return rows.groupBy("key").agg(F.max("seq").alias("last"), F.max(F.when(F.col("gone"), F.col("seq"))).alias("cut")).where("last = cut").select("key", "cut")


def expiries(log: DataFrame, as_of_ms: int) -> DataFrame:
    """key, expire_ms, expired: of the last command that sets or clears a key's time, unless a later DEL removes the key.

    A SET without a time clears it, unless it says KEEPTTL; PERSIST clears it.
    """
    until = lambda amount, unit, relative: amount * unit + (as_of_ms if relative else 0)
    rows = surviving(log, *EXPIRE_TIMES, "PERSIST", "SET").withColumn("options", F.when(F.col("cmd") == "SET", F.expr("transform(slice(args, 3, size(args)), x -> upper(x))")))
    rows = rows.where("not coalesce(array_contains(options, 'KEEPTTL'), false)")
    at = F.lit(None).cast("long")
    for cmd, (unit, relative) in EXPIRE_TIMES.items():
        at = F.when(F.col("cmd") == cmd, until(F.expr("try_cast(args[1] as bigint)"), unit, relative)).otherwise(at)
    for name, (unit, relative) in SET_TIMES.items():
        amount = F.expr(f"try_cast(get(args, cast(array_position(options, '{name}') as int) + 2) as bigint)")
        at = F.when((F.col("cmd") == "SET") & F.array_contains("options", name), until(amount, unit, relative)).otherwise(at)
    last = rows.withColumn("until", at).groupBy("key").agg(F.max(F.struct("seq", "until")).alias("w")).select("key", F.col("w.until").alias("expire_ms")).where("expire_ms is not null")
    return last.withColumn("expired", F.col("expire_ms") < as_of_ms)


def trim_maxlen(entries: DataFrame, n: int) -> DataFrame:
    """The newest n entries of each stream; a window group limit cuts before the shuffle."""
    order = Window.partitionBy("key").orderBy(F.desc("ms"), F.desc("no"))
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rank")


def trim_minid(entries: DataFrame, ms: int, no: int = 0) -> DataFrame:
    return entries.where((F.col("ms") > ms) | (F.col("ms") == ms) & (F.col("no") >= no))


def stream_ids(deltas: DataFrame) -> DataFrame:
    """key, seq, id: ids from a master id and differences of milliseconds."""
    run = F.sum("delta").over(Window.partitionBy("key").orderBy("seq"))
    return deltas.select("key", "seq", F.concat((F.col("master") + run).cast("string"), F.lit("-0")).alias("id"))
