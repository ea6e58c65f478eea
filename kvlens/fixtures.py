"""Keyspace, journal and telemetry tables derived from the shared Parquet tables (FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF_MS = 1705276800000
FLOWS = 4
# Nodes and their first and last hash slots, three masters.
NODES = [("n1", 0, 5460), ("n2", 5461, 10922), ("n3", 10923, 16383)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def epoch_us(column: str):
    return F.expr(_US.replace("ts)", f"{column})"))


def _family(df: DataFrame, kind: str, enc: int, key, n, canon, expires: bool = False) -> DataFrame:
    n = n.cast("long")
    expire = F.when(n % 3 != 0, F.lit(0)).otherwise(F.lit(AS_OF_MS) + (n % 200 - 100) * 60000) if expires else F.lit(0)
    return df.select(key.alias("key"), F.lit(kind).alias("type"), F.lit(enc).alias("enc"), n.alias("n"), expire.cast("long").alias("expire_ms"), (n % FLOWS).cast("long").alias("flow"), canon.alias("canon"))


def _joined(*order: str, text: str = "text"):
    """Elements of a group in the order of some columns, comma-joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda x: x[text]), ",")


def keyspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key of six types: key, type, enc, n, expire_ms, flow, canon (the payload as text)."""
    t = lambda name: table(spark, sf_dir, name)
    say = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    items = t("lineitem").withColumn("text", F.col("l_partkey").cast("string")).groupBy("l_orderkey").agg(_joined("l_linenumber", "l_partkey", "l_suppkey").alias("c"))
    nations = t("customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_list(F.col("c_custkey").cast("string"))), ",").alias("c"))
    brands = t("part").withColumn("member", F.col("p_partkey").cast("string")).withColumn("text", F.concat("member", F.lit(":"), F.format_string("%f", "p_retailprice"))).groupBy("p_brand").agg(_joined("p_retailprice", "member").alias("c"))
    streams = t("events").withColumn("us", epoch_us("ts")).withColumn("text", F.concat(F.expr("cast(us div 1000 as string)"), F.lit("-0|"), "event_type")).groupBy("user_id").agg(_joined("us", "event_id").alias("c"))
    parts = [
        _family(t("customer"), "string", 0, say("customer:", "c_custkey"), F.col("c_custkey"), F.col("c_name"), True),
        _family(t("orders"), "hash", 16, say("order:", "o_orderkey"), F.col("o_orderkey"), F.concat(F.lit("cust="), F.col("o_custkey").cast("string"), F.lit(";prio="), "o_orderpriority", F.lit(";status="), "o_orderstatus")),
        _family(items, "list", 18, say("items:", "l_orderkey"), F.col("l_orderkey"), F.col("c")),
        _family(nations, "set", 20, say("nation:", "c_nationkey"), F.col("c_nationkey"), F.col("c")),
        _family(brands, "zset", 17, say("brand:", "p_brand"), F.regexp_extract("p_brand", r"(\d+)", 1), F.col("c")),
        _family(streams, "stream", 21, say("stream:", "user_id"), F.col("user_id"), F.col("c")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def damaged(src: DataFrame) -> DataFrame:
    """A target keyspace: src with keys dropped, retyped, lengthened, changed and re-timed, and some extra ones."""
    n, text = F.col("n"), F.col("canon")
    first = lambda m: n % m == 0
    retyped, longer = first(37), ~first(37) & first(29)
    changed = ~first(37) & ~first(29) & first(23)
    timed = ~first(37) & ~first(29) & ~first(23) & first(31) & (F.col("expire_ms") > 0)
    tail = F.when(F.col("type") == "string", "x").when(F.col("type") == "hash", ";x=1").otherwise(",x")
    kept = src.where(~first(11)).select(
        "key",
        F.when(retyped, F.when(F.col("type") == "string", "list").otherwise("string")).otherwise(F.col("type")).alias("type"),
        "enc", "n",
        F.when(timed, F.col("expire_ms") + 60000).otherwise(F.col("expire_ms")).alias("expire_ms"),
        "flow",
        F.when(longer, F.concat(text, tail)).when(changed, F.concat(F.expr("substring(canon, 1, length(canon) - 1)"), F.lit("~"))).otherwise(text).alias("canon"),
    )
    extra = src.where((F.col("type") == "string") & (n % 50 == 0)).select(F.concat(F.lit("extra:"), n.cast("string")).alias("key"), *[c for c in src.columns if c != "key"])
    return kept.unionByName(extra)


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal_of(table(spark, sf_dir, "events"))


def journal_of(e: DataFrame) -> DataFrame:
    """Change records of events (a table or a stream): flow, seq, opcode, db, txid, shard_cnt, lsn, cmd, args."""
    kind = F.col("event_type")
    glob, incr = F.col("event_id") % 997 == 0, F.col("event_id") % 499 == 0
    user, cart = F.concat(F.lit("user:"), F.col("user_id").cast("string")), F.concat(F.lit("cart:"), F.col("user_id").cast("string"))
    value = F.format_string("%f", "value")
    return e.select(
        (F.col("user_id") % FLOWS).alias("flow"), F.col("event_id").alias("seq"),
        F.when(glob | incr | kind.isin("click", "purchase"), "COMMAND").when(kind == "error", "EXPIRED").when(kind == "view", "PING").otherwise("LSN").alias("opcode"),
        F.lit(0).cast("long").alias("db"), F.expr("event_id div 3").alias("txid"), F.lit(2).cast("long").alias("shard_cnt"),
        F.when(~glob & ~incr & (kind == "signup"), F.col("event_id") * 2).alias("lsn"),
        F.when(glob, "FLUSHALL").when(incr, "INCR").when(kind == "click", "SET").when(kind == "purchase", "HSET").when(kind == "error", "DEL").alias("cmd"),
        F.when(glob, F.array().cast("array<string>")).when(incr, F.array(user)).when(kind == "click", F.array(user, value)).when(kind == "purchase", F.array(cart, F.get_json_object("props", "$.k"), value)).when(kind == "error", F.array(user)).alias("args"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry: flow, us (epoch microseconds), n, latency (whole hundredths), id."""
    return table(spark, sf_dir, "events").select((F.col("user_id") % FLOWS).alias("flow"), epoch_us("ts").alias("us"), F.lit(1).cast("long").alias("n"), F.round(F.col("value") * 100).cast("long").alias("latency"), F.col("event_id").alias("id"))


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records on lists, sets, sorted sets and expiries: seq, cmd, args."""
    e = table(spark, sf_dir, "events")
    user, item, k = F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.get_json_object("props", "$.k")
    of = lambda kind: F.concat(F.lit(kind + ":"), user)
    kind, third = F.col("event_type"), F.col("event_id") % 3
    gone = F.when(third == 0, of("list")).when(third == 1, of("set")).otherwise(of("zset"))
    until = (F.lit(AS_OF_MS) + (F.col("event_id") % 200 - 100) * 60000).cast("string")
    args = F.when(kind == "click", F.array(of("list"), item)).when(kind == "view", F.array(of("list"), item, k)).when(kind == "purchase", F.array(of("set"), k)).when(kind == "signup", F.array(of("zset"), F.format_string("%f", "value"), k)).otherwise(F.array(gone))
    rows = e.select(F.col("event_id").alias("seq"), F.when(kind == "click", "RPUSH").when(kind == "view", "LPUSH").when(kind == "purchase", "SADD").when(kind == "signup", "ZADD").otherwise("DEL").alias("cmd"), args.alias("args"))
    return rows.unionByName(e.where("event_id % 4 = 1").select(F.col("event_id").alias("seq"), F.lit("PEXPIREAT").alias("cmd"), F.array(of("set"), until).alias("args")))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of streams: key, ms, no, seq, kind."""
    return table(spark, sf_dir, "events").select(F.concat(F.lit("stream:"), F.col("user_id").cast("string")).alias("key"), F.expr(f"{_US} div 1000").alias("ms"), F.lit(0).cast("long").alias("no"), F.col("event_id").alias("seq"), F.col("event_type").alias("kind"))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with several pairs, keys and options: seq, opcode, cmd, args."""
    e = table(spark, sf_dir, "events")
    user, item, k, kind = F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.get_json_object("props", "$.k"), F.col("event_type")
    of = lambda name, n=user: F.concat(F.lit(name + ":"), n)
    value, lit = F.format_string("%f", "value"), F.lit
    fifth = F.col("event_id") % 5
    string = F.when(fifth == 0, F.array(of("h"), item)).when(fifth == 1, F.array(of("s"), value, lit("EX"), lit("60"))).when(fifth == 2, F.array(of("s"), value, lit("NX"), lit("PXAT"), item)).when(fifth == 3, F.array(of("s"), value, lit("keepttl"))).otherwise(F.array(of("s"), value))
    args = F.when(kind == "click", F.array(of("h"), k, value, lit("n"), item, k, lit("again"))).when(kind == "view", string)
    args = args.when(kind == "purchase", F.array(of("h"), of("h", (F.col("user_id") + 1).cast("string")))).when(kind == "signup", F.array(of("z"), lit("CH"), lit("gt"), value, k, item, lit("b")))
    return e.select(F.col("event_id").alias("seq"), lit("COMMAND").alias("opcode"), F.when(kind == "click", "HSET").when(kind == "view", "SET").when(kind == "signup", "ZADD").otherwise("DEL").alias("cmd"), args.otherwise(F.array(of("z"), of("s"))).alias("args"))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a keyspace held before the journal: strings user:N and hash fields cart:N: key, field (null for a string), value."""
    c = table(spark, sf_dir, "customer")
    named = lambda kind: F.concat(F.lit(kind), F.col("c_custkey").cast("string")).alias("key")
    fields = F.explode(F.array(F.struct(F.lit("seg").alias("field"), F.col("c_mktsegment").alias("value")), F.struct(F.lit("a").alias("field"), F.col("c_name").alias("value")))).alias("p")
    return c.select(named("user:"), F.lit(None).cast("string").alias("field"), F.col("c_name").alias("value")).union(c.select(named("cart:"), fields).select("key", "p.field", "p.value"))
