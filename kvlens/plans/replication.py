"""Queries of the replication side: decoding, sinks, replay of collections, status, streams; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixtures import AS_OF_MS, NODES, collections, commands, damaged, entries, epoch_us, journal, journal_of, keyspace, samples, table
from ..functions.slots import slot
from ..operators import changes, checks, decode, routing, telemetry, writer
from ..operators import collections as coll
from ..streaming import replay as streams

_n = lambda name: F.count(F.lit(1)).alias(name)
_of = lambda source, f: lambda spark, d: f(source(spark, d))
_table = lambda name, f: lambda spark, d: f(table(spark, d, name))
_text = lambda c: F.col(c).cast("string")
_joined = lambda e: F.expr(f"array_join({e}, ',')")

# A topology as three masters and a replica report it; keys allowed and blocked in the filter query.
TOPOLOGY = ["a1 10.0.0.1:6379@16379 myself,master - 0 0 1 connected 0-5460", "a2 10.0.0.2:6379@16379 master - 0 0 2 connected 5461-10922 16000", "a3 10.0.0.3:6379@16379 master - 0 0 3 connected 10923-15999 16001-16383", "a4 10.0.0.4:6379@16379 slave a1 0 0 1 connected"]
ALLOW = {"prefixes": ["customer:", "order:"], "keys": ["nation:7"]}
BLOCK = {"suffixes": ["7"], "patterns": ["^order:1.*0$"], "types": ["stream"]}
PAGE_AT, PAGE, TAIL = 100, 50, 100


def _literal(rows: list[str]):
    return lambda spark, d: decode.cluster_nodes(spark.createDataFrame([(r,) for r in rows], "line string"))


def _lines(e: DataFrame) -> DataFrame:
    return e.select(F.col("event_id"), F.format_string("[%s] event=%d user=%d", F.upper("event_type"), "event_id", "user_id").alias("line"))


def _inline(j: DataFrame) -> DataFrame:
    """Blobs of at most eight records, unpacked again."""
    blobs = j.groupBy("flow", F.expr("seq div 8").alias("blob")).agg(F.array_sort(F.collect_list(F.struct("seq", "opcode"))).alias("records"))
    return blobs.select("flow", "blob", F.posexplode("records").alias("at", "r")).select("flow", "blob", F.col("at").cast("long").alias("at"), "r.seq", "r.opcode")


def _payload(j: DataFrame) -> DataFrame:
    text = j.where("cmd is not null").select("seq", F.concat_ws(" ", "cmd", F.array_join("args", " ")).alias("p")).select("seq", F.split(F.trim("p"), " ").alias("w"))
    return text.select("seq", F.get("w", F.lit(0)).alias("cmd"), (F.size("w") - 1).cast("long").alias("n_args"), _joined("slice(w, 2, size(w))").alias("args"))


def _both(spark, d):
    src = keyspace(spark, d)
    return src, damaged(src)


def _progress(spark, d):
    src, tgt = _both(spark, d)
    count = lambda df, name: df.agg(_n(name))
    both = count(src, "source_keys").join(count(checks.common(src, tgt), "synced_keys"))  # one row each
    share = F.when(F.col("source_keys") > 0, F.col("synced_keys") / F.col("source_keys")).otherwise(F.lit(0.0))
    return both.withColumn("progress", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)), 6))


def _flow_progress(spark, d):
    done = keyspace(spark, d).groupBy(F.col("flow").alias("f")).agg(_n("n"))
    return spark.range(6).select(F.col("id").alias("flow")).join(done, F.col("flow") == F.col("f"), "left").select("flow", F.coalesce("n", F.lit(0)).alias("imported"))


def _loaded(s: DataFrame) -> DataFrame:
    gone = (F.col("expire_ms") > 0) & (F.col("expire_ms") < AS_OF_MS)
    failed = ~gone & (F.col("type") == "stream")
    return s.select("flow", gone.alias("gone"), failed.alias("failed"))


def _outcomes() -> list:
    return [F.count_if(~F.col("gone") & ~F.col("failed")).alias("ok"), F.count_if("gone").alias("skipped"), F.count_if("failed").alias("failed")]


def _lag(j: DataFrame) -> DataFrame:
    last = changes.last_lsn(j)
    return last.join(last.agg(F.max("lsn").alias("top"))).select("flow", F.greatest(F.lit(0), F.col("top") - F.col("lsn")).alias("lag"))


def _stages(e: DataFrame) -> DataFrame:
    return e.select(F.col("event_type").alias("name"), epoch_us("ts").alias("us"), F.get_json_object("props", "$.k").alias("status")).groupBy("name").agg(F.max_by("status", "us").alias("status"), F.max("us").alias("updated_us"))


def _cross_latency(s: DataFrame) -> DataFrame:
    return telemetry.percentiles(s).agg(*[F.round(F.avg(f"p{p}"), 6).alias(f"p{p}") for p in telemetry.PERCENTS], F.max("max_latency").alias("max_latency"))


def _beats(j: DataFrame) -> DataFrame:
    """Ticks of ten records: the last ack of each, and whether it is sent: it grew, or a PING came."""
    acks = changes.acks(j).select(F.col("flow").alias("f"), F.col("seq").alias("s"), "ack")
    rows = j.join(acks, (F.col("flow") == F.col("f")) & (F.col("seq") == F.col("s")))
    ticks = rows.groupBy("flow", F.expr("seq div 10").alias("tick")).agg(F.max_by("ack", "seq").alias("ack"), F.bool_or(F.col("opcode") == "PING").alias("ping"))
    before = F.lag("ack", 1, 0).over(Window.partitionBy("flow").orderBy("tick"))
    return ticks.withColumn("send", (F.col("ack") > before) | F.col("ping"))


def _expire_attach(e: DataFrame) -> DataFrame:
    w = Window.partitionBy("flow").orderBy("seq")
    rows = e.select((F.col("user_id") % 4).alias("flow"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "signup", F.col("event_id") * 1000).alias("pending"))
    return rows.select("seq", "pending", F.lag("pending").over(w).alias("expire_ms")).where("pending is null").select("seq", "expire_ms")


def _select_db(e: DataFrame) -> DataFrame:
    w = Window.partitionBy("flow").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = e.select((F.col("user_id") % 4).alias("flow"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 97 == 0, F.col("event_id") % 16).alias("chosen"))
    return rows.select("flow", "seq", "chosen", F.coalesce(F.last("chosen", True).over(w), F.lit(0)).alias("db")).where("chosen is null").select("flow", "seq", "db")


def _metrics(s: DataFrame) -> DataFrame:
    """Old metrics (even ids) merged with new ones (odd ids): a name's new value wins."""
    rows = s.select(F.concat(F.lit("flow."), _text("flow"), F.lit(".latency")).alias("name"), F.struct((F.col("id") % 2).alias("new"), "id", "latency").alias("r"))
    return rows.groupBy("name").agg(F.max("r").alias("r")).select("name", F.col("r.latency").alias("value"))


def _reset(e: DataFrame) -> DataFrame:
    prefix = F.when(F.col("event_type") == "click", "flow.").when(F.col("event_type") == "view", "incremental.").when(F.col("event_type") == "purchase", "rdb.").otherwise("source.")
    return e.groupBy(F.concat(prefix, "event_type").alias("name")).agg(_n("value")).where("not name rlike 'flow|incremental|rdb'")


def _commands(j: DataFrame) -> DataFrame:
    found = j.where("cmd is not null").select("seq", "cmd", F.get("args", F.lit(0)).alias("key"))
    return routing.routed(found).select("seq", "cmd", "slot", "node")


def _cross_slot(e: DataFrame) -> DataFrame:
    u = _text("user_id")
    tagged = F.col("event_id") % 3 == 0
    keys = [F.when(tagged, F.concat(F.lit("{"), u, F.lit("}:" + c))).otherwise(F.concat(u, F.lit(":" + c))) for c in "ab"]
    return e.select(F.col("event_id").alias("seq"), slot(keys[0]).alias("slot1"), slot(keys[1]).alias("slot2")).where("slot1 <> slot2")


def _union(spark, d):
    return keyspace(spark, d).select("flow", F.col("n").alias("seq"), F.lit("snapshot").alias("phase")).unionByName(journal(spark, d).select("flow", "seq", F.lit("journal").alias("phase")))


def _entry_diff(spark, d):
    one = lambda df: df.where("type = 'stream'").select("key", F.explode(F.split("canon", ",")).alias("entry"))
    src, tgt = _both(spark, d)
    return one(src).join(one(tgt), ["key", "entry"], "left_anti")


def _deltas(e: DataFrame) -> DataFrame:
    w = Window.partitionBy("key").orderBy("seq")
    first = e.groupBy(F.col("key").alias("k")).agg(F.min_by("ms", "seq").alias("master"))
    moved = e.select("key", "seq", F.coalesce(F.col("ms") - F.lag("ms").over(w), F.lit(0)).alias("delta"))
    return coll.stream_ids(moved.join(first, F.col("key") == F.col("k")))


def _events(spark, d, files: int = 1000) -> DataFrame:
    return streams.source(spark, d, "events", files)


def _timed(e: DataFrame) -> DataFrame:
    return e.withColumn("at", F.timestamp_micros(epoch_us("ts")))


def _twice(spark, d):
    rows = _timed(_events(spark, d)).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return streams.once(rows.select((F.col("user_id") % 4).alias("flow"), F.col("event_id").alias("seq"), "at"), ["flow", "seq"])


def _rated(spark, d):
    counts = _events(spark, d, 1).groupBy((F.col("user_id") % 4).alias("flow")).agg(_n("entries"))
    return streams.drained(counts, "stream-rated", "update").groupBy("flow").agg(F.max("entries").alias("entries"))


QUERIES = {
    "inline_journal_ops": _of(journal, _inline),
    "journal_payload": _of(journal, _payload),
    "scan_keys": lambda spark, d: (lambda p: p[0].select("key").union(p[1].select("key")).distinct())(_both(spark, d)),
    "keyspace_info_total": _table("customer", lambda c: decode.info_keys(c.groupBy("c_nationkey").agg(F.format_string("db%d:keys=%d,expires=0,avg_ttl=0", "c_nationkey", F.count(F.lit(1))).alias("line")))),
    "cluster_nodes_parse": _literal(TOPOLOGY),
    "log_page": _table("events", lambda e: _lines(e).orderBy("event_id").offset(PAGE_AT).limit(PAGE).select("line")),
    "log_tail": _table("events", lambda e: _lines(e).orderBy(F.desc("event_id")).limit(TAIL).select("line")),
    "log_search": _table("events", lambda e: _lines(e).where(F.lower("line").contains("error")).select("line")),
    "flush_groups": _of(keyspace, lambda s: routing.routed(s.where("type <> 'stream'")).groupBy("node").agg(_n("entries"), (F.count(F.lit(1)) + F.count_if(F.col("expire_ms") > 0)).alias("commands"))),
    "pipeline_chunks": _of(keyspace, lambda s: writer.chunks(routing.routed(s.select("key"))).groupBy("node", "chunk").agg(_n("entries"), F.min("key").alias("first_key"))),
    "render_commands_replace": _of(keyspace, lambda s: writer.replacing(s, routing.COMMANDS, AS_OF_MS)),
    "checkpoint_state": _of(journal, lambda j: changes.last_lsn(j).select(F.struct("flow", "lsn").alias("r")).agg(_n("num_flows"), F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: F.concat(x["flow"].cast("string"), F.lit("="), x["lsn"].cast("string"))), ",").alias("flow_lsns"))),
    "filter_allow_block": _of(keyspace, lambda s: writer.allowed(s, ALLOW, BLOCK).select("key", "type")),
    "unrouted_keys": _of(keyspace, lambda s: routing.routed(s.select("key"), NODES[:2]).where("node is null").select("key", "slot")),
    "pairs_to_map": _table("orders", lambda o: o.select(F.col("o_orderkey").alias("key"), F.array(F.lit("cust"), _text("o_custkey"), F.lit("prio"), "o_orderpriority", F.lit("odd")).alias("a")).select("key", F.expr(decode.pairs_to_map("a")).alias("m")).select("key", F.size("m").cast("long").alias("fields"), F.col("m")["cust"].alias("cust"), F.col("m")["prio"].alias("prio"))),
    "list_flatten": _table("orders", lambda o: o.select(F.col("o_orderkey").alias("key"), F.array(F.array("o_orderstatus", "o_orderpriority"), F.array(_text("o_custkey"))).alias("nodes")).select("key", _joined("flatten(nodes)").alias("items"))),
    "set_normalize": _table("orders", lambda o: o.select(F.col("o_orderkey").alias("key"), F.array("o_orderpriority", "o_orderstatus", "o_orderpriority").alias("a")).select("key", _joined("array_sort(array_distinct(a))").alias("members"))),
    "zset_parse": _table("part", lambda p: p.select(_text("p_partkey").alias("member"), F.when(F.col("p_partkey") % 10 == 0, "bad").otherwise(F.format_string("%f", "p_retailprice")).alias("s")).select("member", F.expr("coalesce(try_cast(s as double), 0d)").alias("score"))),
    "stream_ids": _of(entries, _deltas),
    "expire_seconds": _table("customer", lambda c: c.select("c_custkey", (F.col("c_custkey") * F.lit(10) * F.lit(1000)).cast("long").alias("expire_ms"))),
    "score_format": _table("part", lambda p: p.select("p_partkey", F.format_string("%f", "p_retailprice").alias("score"))),
    "truncate_key": _of(keyspace, lambda s: s.select("key", decode.truncated(F.col("key"), 10).alias("short"))),
    "moved_parse": _table("events", lambda e: e.select("event_id", F.concat(F.lit("MOVED "), (F.col("event_id") % 16384).cast("string"), F.lit(" 10.0.0."), (F.col("event_id") % 3).cast("string"), F.lit(":6379")).alias("r")).select("event_id", decode.moved(F.col("r"))[0].alias("slot"), decode.moved(F.col("r"))[1].alias("addr"))),
    "sync_progress": _progress,
    "opcode_name": _table("events", lambda e: e.groupBy((F.col("event_id") % 17).alias("code")).agg(_n("records")).select("code", decode.opcode_name(F.col("code")).alias("name"), "records")),
    "journal_display": _of(journal, lambda j: j.select("seq", F.concat_ws(" ", F.format_string("[%s] db=%d txid=%d", "opcode", "db", "txid"), "cmd", F.array_join("args", " ")).alias("line")).select("seq", F.rtrim("line").alias("line"))),
    "flow_progress": _flow_progress,
    "check_full_stream_entries": _entry_diff,
    "flow_snapshot_stats": _of(keyspace, lambda s: _loaded(s).groupBy("flow").agg(*_outcomes())),
    "snapshot_totals": _of(keyspace, lambda s: _loaded(s).agg(*_outcomes())),
    "flow_imported_keys": _of(keyspace, lambda s: s.groupBy("flow").agg(_n("imported")).withColumn("published", F.expr("imported div 500 * 500"))),
    "writer_stats": _of(keyspace, lambda s: s.groupBy("flow").agg(_n("received"), F.count_if(F.col("type") != "stream").alias("written")).withColumn("batches", F.expr("(received + 499) div 500"))),
    "latency_cross_flow": _of(samples, _cross_latency),
    "latency_last_100": _of(samples, lambda s: telemetry.percentiles(telemetry.last_n(s, 100))),
    "success_rate": _of(journal, lambda j: changes.replay_stats(j).select("total", "ok", F.expr("case when total = 0 then 0d else (1000 * ok div total) / 10 end").cast("double").alias("percent"))),
    "lsn_lag": _of(journal, _lag),
    "latest_stage": _table("events", lambda e: _stages(e).orderBy(F.desc("updated_us"), "name").limit(1)),
    "stage_details": _table("events", lambda e: _stages(e).orderBy("name")),
    "qps_peak_avg": _of(samples, lambda s: telemetry.qps(s).groupBy("flow").agg(F.max("ops").alias("peak"), F.round(F.avg("ops"), 6).alias("mean"))),
    "heartbeat_decisions": _of(journal, _beats),
    "expire_attach": _table("events", _expire_attach),
    "select_db_carry": _table("events", _select_db),
    "union_flows": _union,
    "metrics_merge": _of(samples, _metrics),
    "reset_run_metrics": _table("events", _reset),
    "route_commands": _of(journal, _commands),
    "cross_slot_commands": _table("events", _cross_slot),
    "replay_set": _of(journal, lambda j: changes.current(j.where("cmd in ('SET', 'DEL')")).select("key", "value", "seq")),
    "replay_hset": _of(journal, lambda j: changes.current(j.where("cmd in ('HSET', 'DEL')"))),
    "replay_push": _of(collections, coll.lists),
    "replay_sadd": _of(collections, coll.sets),
    "replay_zadd": _of(collections, coll.sorted_sets),
    "replay_del": _of(collections, coll.deleted),
    "replay_expire": _of(collections, lambda c: coll.expiries(c, AS_OF_MS)),
    "replay_several_fields": _of(commands, changes.current),
    "replay_several_keys": _of(commands, coll.deleted),
    "replay_several_scores": _of(commands, coll.sorted_sets),
    "replay_set_times": _of(commands, lambda c: coll.expiries(c, AS_OF_MS)),
    "replay_stream": _of(entries, lambda e: e.groupBy("key").agg(_n("length"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))),
    "stream_trim_maxlen": _of(entries, lambda e: coll.trim_maxlen(e, 50)),
    "stream_trim_minid": _of(entries, lambda e: coll.trim_minid(e, AS_OF_MS)),
    "stream_replay_lww": lambda spark, d: streams.last_writes(changes.writes(journal_of(_events(spark, d)))),
    "stream_window_counts": lambda spark, d: streams.window_counts(_timed(_events(spark, d)), "event_type"),
    "stream_ack_counter": lambda spark, d: streams.acks(journal_of(_events(spark, d)).select("flow", "seq", "lsn")),
    "stream_dedup": _twice,
    "stream_rate_limited": _rated,
}


def sql() -> dict[str, str]:
    """DuckDB SQL for each of the queries."""
    from .oracle import JOURNAL, NODE, ORACLES, ROUTED, SAMPLES, SRC, TGT, _percent, _slot, _with

    k = "json_extract_string(props, '$.k')"
    stages = f"(select event_type as name, arg_max({k}, ts) as status, epoch_us(max(ts)) as updated_us from events group by 1)"
    line = "select event_id, '[' || upper(event_type) || '] event=' || event_id || ' user=' || user_id as line from events"
    loaded = f"loaded as (select flow, expire_ms > 0 and expire_ms < {AS_OF_MS} as gone, type = 'stream' and not (expire_ms > 0 and expire_ms < {AS_OF_MS}) as failed from src)"
    loads = "count(*) filter (where not gone and not failed) as ok, count(*) filter (where gone) as skipped, count(*) filter (where failed) as failed"
    names = " ".join(f"when {c} then '{n}'" for c, n in decode.OPCODES.items())
    acked = "numbered as (select *, row_number() over (partition by flow order by seq) as rn from journal), acked as (select *, rn + greatest(0, coalesce(max(lsn - rn) over (partition by flow order by seq), 0)) as ack from numbered)"
    lsn = "lsns as (select flow, max_by(lsn, seq) as lsn from journal where lsn is not null group by flow)"
    log = f"""clog as (select event_id as seq, user_id as u, event_type as t, value, {k} as k,
      case when event_type in ('click', 'view') then 'list' when event_type = 'purchase' then 'set' when event_type = 'signup' then 'zset' when event_id % 3 = 0 then 'list' when event_id % 3 = 1 then 'set' else 'zset' end || ':' || user_id as key,
      event_type not in ('click', 'view', 'purchase', 'signup') as gone from events),
      cuts as (select key as ck, max(seq) as cut from clog where gone group by key),
      alive as (select clog.* from clog left join cuts on key = ck where not gone and (cut is null or seq > cut))"""
    ent = "entry as (select 'stream:' || user_id as key, epoch_us(ts) // 1000 as ms, 0::bigint as no, event_id as seq, event_type as kind from events)"
    perc = ", ".join(_percent(p) for p in (50, 95, 99)) + ", max(latency) as max_latency"
    writes = ORACLES["materialize_lww"]
    several = """ev as (select event_id as seq, user_id as u, event_type as t, printf('%.6f', value) as val, json_extract_string(props, '$.k') as k from events),
dels as (select 'h:' || u as key, seq from ev where t = 'purchase' union all select 'h:' || (u + 1), seq from ev where t = 'purchase' union all select unnest(['z:' || u, 's:' || u]), seq from ev where t not in ('click', 'view', 'purchase', 'signup')),
gone as (select key, max(seq) as cut from dels group by key)"""
    topology = "values ('a1', '10.0.0.1:6379', 'myself,master', null, 0::bigint, 5460::bigint), ('a2', '10.0.0.2:6379', 'master', null, 5461, 10922), ('a2', '10.0.0.2:6379', 'master', null, 16000, 16000), ('a3', '10.0.0.3:6379', 'master', null, 10923, 15999), ('a3', '10.0.0.3:6379', 'master', null, 16001, 16383), ('a4', '10.0.0.4:6379', 'slave', 'a1', null, null)"
    return {
        "inline_journal_ops": _with(JOURNAL) + "select flow, seq // 8 as blob, row_number() over (partition by flow, seq // 8 order by seq) - 1 as at, seq, opcode from journal",
        "journal_payload": _with(JOURNAL) + "select seq, cmd, case cmd when 'FLUSHALL' then 0 when 'SET' then 2 when 'HSET' then 3 else 1 end::bigint as n_args, case cmd when 'FLUSHALL' then '' when 'SET' then 'user:' || user_id || ',' || v when 'HSET' then 'cart:' || user_id || ',' || field || ',' || v else 'user:' || user_id end as args from journal where cmd is not null",
        "scan_keys": _with(SRC, TGT) + "select key from src union select key from tgt",
        "keyspace_info_total": "select count(*) as total from customer",
        "cluster_nodes_parse": f"select * from ({topology}) t(id, addr, flags, master, slot_start, slot_end)",
        "log_page": f"select line from ({line}) order by event_id limit {PAGE} offset {PAGE_AT}",
        "log_tail": f"select line from ({line}) order by event_id desc limit {TAIL}",
        "log_search": f"select line from ({line}) where lower(line) like '%error%'",
        "flush_groups": _with(SRC, ROUTED) + "select r.node, count(*) as entries, count(*) + count(*) filter (where s.expire_ms > 0) as commands from routed r join src s on r.key = s.key where s.type <> 'stream' group by r.node",
        "pipeline_chunks": _with(SRC, ROUTED) + "select node, chunk, count(*) as entries, min(key) as first_key from (select key, node, (row_number() over (partition by node order by slot, key) - 1) // 500 as chunk from routed) group by all",
        "render_commands_replace": _with(SRC, "live as (select * from src where type <> 'stream')") + f"select key, 0::bigint as step, 'DEL ' || key as command from live union all select key, 1, case type when 'string' then 'SET' when 'hash' then 'HSET' when 'list' then 'RPUSH' when 'set' then 'SADD' else 'ZADD' end || ' ' || key || ' ' || canon from live union all select key, 2, 'PEXPIRE ' || key || ' ' || (expire_ms - {AS_OF_MS}) from live where expire_ms > {AS_OF_MS}",
        "checkpoint_state": _with(JOURNAL, lsn) + "select count(*) as num_flows, string_agg(flow || '=' || lsn, ',' order by flow) as flow_lsns from lsns",
        "filter_allow_block": _with(SRC) + "select key, type from src where (key like 'customer:%' or key like 'order:%' or key = 'nation:7') and not (key like '%7' or regexp_matches(key, '^order:1.*0$') or type = 'stream')",
        "unrouted_keys": _with(SRC, ROUTED) + "select key, slot from routed where node = 'n3'",
        "pairs_to_map": "select o_orderkey as key, 2::bigint as fields, o_custkey::varchar as cust, o_orderpriority as prio from orders",
        "list_flatten": "select o_orderkey as key, o_orderstatus || ',' || o_orderpriority || ',' || o_custkey as items from orders",
        "set_normalize": "select o_orderkey as key, array_to_string(list_sort(list_distinct([o_orderpriority, o_orderstatus])), ',') as members from orders",
        "zset_parse": "select p_partkey::varchar as member, case when p_partkey % 10 = 0 then 0 else printf('%.6f', p_retailprice)::double end as score from part",
        "stream_ids": _with(ent) + "select key, seq, ms || '-0' as id from entry",
        "expire_seconds": "select c_custkey, c_custkey * 10000 as expire_ms from customer",
        "score_format": "select p_partkey, printf('%.6f', p_retailprice) as score from part",
        "truncate_key": _with(SRC) + "select key, case when strlen(key) <= 10 then key else key[1:10] || '...' end as short from src",
        "moved_parse": "select event_id, event_id % 16384 as slot, '10.0.0.' || (event_id % 3) || ':6379' as addr from events",
        "sync_progress": _with(SRC, TGT) + "select a as source_keys, b as synced_keys, round(b / a, 6) as progress from (select count(*) as a, count(*) filter (where key in (select key from tgt)) as b from src)",
        "opcode_name": f"select code, case code {names} else 'UNKNOWN(' || code || ')' end as name, records from (select event_id % 17 as code, count(*) as records from events group by 1)",
        "journal_display": _with(JOURNAL) + "select seq, rtrim('[' || opcode || '] db=0 txid=' || txid || coalesce(' ' || cmd, '') || coalesce(' ' || case when cmd is null then null when cmd = 'SET' then 'user:' || user_id || ' ' || v when cmd = 'HSET' then 'cart:' || user_id || ' ' || field || ' ' || v when cmd = 'FLUSHALL' then null else 'user:' || user_id end, '')) as line from journal",
        "flow_progress": _with(SRC) + "select range as flow, count(key) as imported from range(6) left join src on flow = range group by range",
        "check_full_stream_entries": _with(SRC, TGT) + "select key, entry from (select key, unnest(string_split(canon, ',')) as entry from src where type = 'stream') a where not exists (select 1 from (select key, unnest(string_split(canon, ',')) as entry from tgt where type = 'stream') b where a.key = b.key and a.entry = b.entry)",
        "flow_snapshot_stats": _with(SRC, loaded) + f"select flow, {loads} from loaded group by flow",
        "snapshot_totals": _with(SRC, loaded) + f"select {loads} from loaded",
        "flow_imported_keys": _with(SRC) + "select flow, count(*) as imported, count(*) // 500 * 500 as published from src group by flow",
        "writer_stats": _with(SRC) + "select flow, count(*) as received, count(*) filter (where type <> 'stream') as written, (count(*) + 499) // 500 as batches from src group by flow",
        "latency_cross_flow": _with(SAMPLES) + f"select round(avg(p50), 6) as p50, round(avg(p95), 6) as p95, round(avg(p99), 6) as p99, max(max_latency) as max_latency from (select {perc} from samples group by flow)",
        "latency_last_100": _with(SAMPLES) + f"select flow, {perc}, count(*) as samples from (select *, row_number() over (partition by flow order by us desc, id desc) as rank from samples) where rank <= 100 group by flow",
        "success_rate": _with(JOURNAL) + "select count(*) as total, count(*) filter (where class = 'apply') as ok, (1000 * count(*) filter (where class = 'apply') // count(*)) / 10 as percent from classed",
        "lsn_lag": _with(JOURNAL, lsn) + "select flow, (select max(lsn) from lsns) - lsn as lag from lsns",
        "latest_stage": f"select * from {stages} order by updated_us desc, name limit 1",
        "stage_details": f"select * from {stages} order by name",
        "qps_peak_avg": _with(SAMPLES) + "select flow, max(ops)::bigint as peak, round(avg(ops), 6) as mean from (select flow, sum(n) over (partition by flow order by us range between 3599999999 preceding and current row) as ops from samples) group by flow",
        "heartbeat_decisions": _with(JOURNAL, acked) + "select flow, tick, ack, ping, ack > lag(ack, 1, 0) over (partition by flow order by tick) or ping as send from (select flow, seq // 10 as tick, max_by(ack, seq) as ack, bool_or(opcode = 'PING') as ping from acked group by all)",
        "expire_attach": "select seq, before as expire_ms from (select event_id as seq, event_type, lag(case when event_type = 'signup' then event_id * 1000 end) over (partition by user_id % 4 order by event_id) as before from events) where event_type <> 'signup'",
        "select_db_carry": "select flow, seq, coalesce(db, 0) as db from (select user_id % 4 as flow, event_id as seq, last_value(case when event_id % 97 = 0 then event_id % 16 end ignore nulls) over (partition by user_id % 4 order by event_id rows between unbounded preceding and current row) as db from events) where seq % 97 <> 0",
        "union_flows": _with(SRC, JOURNAL) + "select flow, n as seq, 'snapshot' as phase from src union all select flow, seq, 'journal' from journal",
        "metrics_merge": _with(SAMPLES) + "select 'flow.' || flow || '.latency' as name, arg_max(latency, (id % 2, id)) as value from samples group by flow",
        "reset_run_metrics": "select 'source.' || event_type as name, count(*) as value from events where event_type not in ('click', 'view', 'purchase') group by event_type",
        "route_commands": _with(JOURNAL, f"keyed as (select seq, cmd, case cmd when 'FLUSHALL' then null when 'HSET' then 'cart:' else 'user:' end || user_id as key from journal where cmd is not null), sloted as (select seq, cmd, {_slot('key')} as slot from keyed)") + f"select seq, cmd, slot, {NODE} as node from sloted",
        "cross_slot_commands": f"select seq, slot1, slot2 from (select event_id as seq, {_slot('k1')} as slot1, {_slot('k2')} as slot2 from (select event_id, case when event_id % 3 = 0 then '{{' || user_id || '}}' else user_id::varchar end || ':a' as k1, case when event_id % 3 = 0 then '{{' || user_id || '}}' else user_id::varchar end || ':b' as k2 from events)) where slot1 <> slot2".replace("'{{'", "'{'").replace("'}}'", "'}'"),
        "replay_set": f"select key, value, seq from ({writes}) where field = ''",
        "replay_hset": f"select * from ({writes}) where field <> ''",
        "replay_push": _with(log) + "select key, case t when 'click' then seq * 1048576 else -(seq * 1048576) end as pos, seq::varchar as item from alive where t in ('click', 'view') union all select key, -(seq * 1048576 + 1), k from alive where t = 'view'",
        "replay_sadd": _with(log) + "select distinct key, k as member from alive where t = 'purchase'",
        "replay_zadd": _with(log) + "select key, k as member, printf('%.6f', arg_max(value, seq))::double as score from alive where t = 'signup' group by all",
        "replay_del": _with(log, "last as (select key as lk, max(seq) as last from (select key, seq from clog union all select 'set:' || u, seq from clog where seq % 4 = 1) group by 1)") + "select ck as key, cut from cuts join last on ck = lk where cut = last",
        "replay_expire": _with(log) + f"select key, ms as expire_ms, ms < {AS_OF_MS} as expired from (select 'set:' || u as key, arg_max({AS_OF_MS} + (seq % 200 - 100) * 60000, seq) as ms from clog left join cuts on ck = 'set:' || u where seq % 4 = 1 and (cut is null or seq > cut) group by 1)",
        "replay_several_fields": _with(several) + """, hw as (select * from (select 'h:' || u as key, f, v, seq from ev, lateral (values (k, 'again'), ('n', seq::varchar)) p(f, v) where t = 'click') union all
  select 'h:' || u, '', seq::varchar, seq from ev where t = 'view' and seq % 5 = 0 union all select 's:' || u, '', val, seq from ev where t = 'view' and seq % 5 <> 0),
  top as (select key, f, arg_max(v, seq) as value, max(seq) as s from hw group by all),
  other as (select key, max(seq) filter (f = '') as str, max(seq) filter (f <> '') as hash from hw group by key)
  select key, f as field, value, s as seq from top join other using (key) left join gone using (key) where s > coalesce(cut, -1) and s > coalesce(case when f = '' then hash else str end, -1)""",
        "replay_several_keys": _with(several) + """, alln as (select key, cut as seq from gone union all select case when t = 'click' or seq % 5 = 0 and t = 'view' then 'h:' when t = 'view' then 's:' else 'z:' end || u, seq from ev where t in ('click', 'view', 'signup'))
  select key, max(cut) as cut from gone join (select key, max(seq) as last from alln group by key) using (key) where cut = last group by key""",
        "replay_several_scores": _with(several) + """, zw as (select 'z:' || u as key, m, sc, seq, i from ev, lateral (values (k, val, 0), ('b', seq::varchar, 1)) p(m, sc, i) where t = 'signup')
  select key, m as member, arg_max(sc, (seq, i))::double as score from zw left join gone using (key) where seq > coalesce(cut, -1) group by all""",
        "replay_set_times": _with(several) + f""", st as (select 's:' || u as key, seq, case seq % 5 when 1 then {AS_OF_MS} + 60000 when 2 then seq end as until from ev where t = 'view' and seq % 5 in (1, 2, 4) union all select 'h:' || u, seq, null from ev where t = 'view' and seq % 5 = 0)
  select key, until as expire_ms, until < {AS_OF_MS} as expired from (select key, unnest(max(struct_pack(seq := seq, until := coalesce(until, -1)))) from st left join gone using (key) where seq > coalesce(cut, -1) group by key) where until >= 0""",
        "replay_stream": _with(ent) + "select key, count(*) as length, min(ms) as first_ms, max(ms) as last_ms from entry group by key",
        "stream_trim_maxlen": _with(ent) + "select key, ms, no, seq, kind from (select *, row_number() over (partition by key order by ms desc, no desc) as r from entry) where r <= 50",
        "stream_trim_minid": _with(ent) + f"select * from entry where ms >= {AS_OF_MS}",
        "stream_replay_lww": writes,
        "stream_window_counts": "select epoch_us(ts) // 3600000000 * 3600000000 as start_us, event_type, count(*) as n from events group by all",
        "stream_ack_counter": _with(JOURNAL, acked) + "select flow, count(*) as entries, max_by(ack, seq) as ack from acked group by flow",
        "stream_dedup": "select user_id % 4 as flow, event_id as seq from events",
        "stream_rate_limited": "select user_id % 4 as flow, count(*) as entries from events group by 1",
    }
