"""The registered queries: operators over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import AS_OF_MS, damaged, journal, keyspace, samples, snapshot, table
from ..functions.slots import slot
from ..operators import changes, checks, routing, telemetry
from . import replication


def _pair(spark, d):
    src = keyspace(spark, d)
    return src, damaged(src)


def _check(mode, as_built=False, kind=None, big=10):
    def run(spark, d):
        src, tgt = _pair(spark, d)
        return checks.compare(src.where(F.col("type") == kind) if kind else src, tgt, mode, big, as_built)

    return run


def _of_pair(f):
    return lambda spark, d: f(*_pair(spark, d))


def _of(source, f):
    return lambda spark, d: f(source(spark, d))


def _keys(f):
    return _of(keyspace, f)


def _log(f):
    return _of(journal, f)


def _sample(f):
    return _of(samples, f)


def _strings(src, tgt):
    left, right = (x.where("type = 'string'").select("key", F.col("canon").alias(n)) for x, n in ((src, "source_value"), (tgt, "target_value")))
    return left.join(right, "key").where("coalesce(source_value, '') <> coalesce(target_value, '')")


def _full(src, tgt):
    return checks.compare(src, tgt, "full")


def _tagged(spark, d):
    key = F.concat(F.lit("{nation"), F.col("c_nationkey").cast("string"), F.lit("}:customer:"), F.col("c_custkey").cast("string"))
    return table(spark, d, "customer").select(key.alias("key")).withColumn("slot", slot(F.col("key")))


_count = lambda name: F.count(F.lit(1)).alias(name)

QUERIES = {
    "scan_keyspace": keyspace,
    "type_of_encoding": _keys(lambda s: s.select("enc", routing.type_of(F.col("enc")).alias("type")).groupBy("enc", "type").agg(_count("keys"))),
    "type_histogram": _keys(lambda s: s.groupBy("type").agg(_count("keys"))),
    "filter_expired": _keys(lambda s: routing.live(s, AS_OF_MS).select("key", "expire_ms")),
    "ttl_remaining": _keys(lambda s: s.where("expire_ms > 0").select("key", F.greatest(F.col("expire_ms") - AS_OF_MS, F.lit(0)).alias("ttl_ms"))),
    "value_length": _keys(lambda s: s.select("key", checks.length().alias("length"))),
    "big_keys": _keys(lambda s: s.select("key", checks.length().alias("length")).where("length > 10")),
    "check_outline": _check("outline"),
    "check_outline_as_built": _check("outline", as_built=True),
    "check_length": _check("length"),
    "check_length_as_built": _check("length", as_built=True),
    "check_smart_as_built": _check("smart", as_built=True),
    "check_smart": _check("smart"),
    "check_full": _check("full"),
    **{f"check_full_{k}": _check("full", kind=k) for k in ("string", "hash", "list", "set", "zset", "stream")},
    "check_summary": _of_pair(lambda s, t: checks.summary(_full(s, t))),
    "check_missing": _of_pair(checks.missing),
    "check_type_mismatch": _of_pair(lambda s, t: checks.compare(s, t, "outline").where("verdict = 'type_mismatch'").select("key", "type", "target_type")),
    "check_extra": _of_pair(checks.extra),
    "check_max_keys": _keys(lambda s: s.select("key", "type").orderBy("key").limit(1000)),
    "mismatch_samples": _of_pair(lambda s, t: _full(s, t).where("verdict <> 'consistent'").select("key", "verdict").orderBy("key").limit(100)),
    "string_mismatches": _of_pair(_strings),
    "common_keys": _of_pair(checks.common),
    "key_filter_prefix": _keys(lambda s: checks.key_filter(s, "nation:*|customer:1*|order:7").select("key", "type")),
    "conflict_overwrite": _of_pair(lambda s, t: checks.resolve(s, t, "overwrite")),
    "conflict_skip": _of_pair(lambda s, t: checks.resolve(s, t, "skip")),
    "conflict_panic_keys": _of_pair(lambda s, t: checks.resolve(s, t, "panic")),
    "key_slot": _keys(lambda s: s.select("key", slot(F.col("key")).alias("slot"))),
    "hash_tag": _tagged,
    "slot_to_node": _keys(lambda s: routing.routed(s.select("key"))),
    "slot_histogram": _keys(lambda s: routing.routed(s.select("key")).groupBy("slot").agg(_count("keys"))),
    "keys_per_node": _keys(lambda s: routing.routed(s.select("key")).groupBy("node").agg(_count("keys"))),
    "render_commands": _keys(routing.rendered),
    "rdb_command_count": _keys(lambda s: routing.rendered(s).agg(_count("commands"), F.count_distinct("key").alias("keys"))),
    "scan_journal": _log(lambda j: j.select("flow", "seq", "opcode", "txid", "shard_cnt", "lsn", "cmd")),
    "classify_journal": _log(lambda j: changes.classified(j).select("seq", "class")),
    "skip_global_commands": _log(lambda j: changes.classified(j).where("cmd is not null and class <> 'skip_global'").select("seq", "cmd")),
    "unsupported_commands": _log(lambda j: changes.classified(j).where("class = 'unsupported'").select("seq", "cmd")),
    "replay_stats": _log(changes.replay_stats),
    "entries_per_flow": _log(lambda j: j.groupBy("flow").agg(_count("entries"))),
    "flow_last_lsn": _log(changes.last_lsn),
    "global_lsn": _log(lambda j: changes.last_lsn(j).agg(F.max("lsn").alias("lsn"))),
    "txn_completeness": _log(changes.transactions),
    "ack_counter": _log(changes.acks),
    "batch_assignment": _log(changes.batches),
    "materialize_lww": _log(changes.current),
    "materialize_snapshot_journal": lambda spark, d: changes.current(journal(spark, d), snapshot(spark, d)),
    "qps_sliding": _sample(telemetry.qps),
    "latency_percentiles": _sample(telemetry.percentiles),
    "history_last_n": _sample(lambda s: telemetry.last_n(s, 100).select("id", "flow", "rank")),
    "metrics_coalesce": _sample(telemetry.coalesced),
    **replication.QUERIES,
}
