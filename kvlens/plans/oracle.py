"""DuckDB SQL for the registered queries: shared tables as CTEs and one body per query."""

from __future__ import annotations

from ..fixtures import AS_OF_MS, FLOWS, NODES
from ..functions.slots import crc_table

_FAMILY = "select key, type, enc, n, {expire} as expire_ms, n % " + str(FLOWS) + " as flow, canon from ({body})"
_EXPIRE = f"case when n % 3 <> 0 then 0 else {AS_OF_MS} + (n % 200 - 100) * 60000 end"

SRC = "src as (" + " union all ".join(
    _FAMILY.format(expire=e, body=b)
    for e, b in [
        (_EXPIRE, "select 'customer:' || c_custkey as key, 'string' as type, 0 as enc, c_custkey as n, c_name as canon from customer"),
        ("0", "select 'order:' || o_orderkey as key, 'hash' as type, 16 as enc, o_orderkey as n, 'cust=' || o_custkey || ';prio=' || o_orderpriority || ';status=' || o_orderstatus as canon from orders"),
        ("0", "select 'items:' || l_orderkey as key, 'list' as type, 18 as enc, l_orderkey as n, string_agg(l_partkey::varchar, ',' order by l_linenumber, l_partkey, l_suppkey) as canon from lineitem group by l_orderkey"),
        ("0", "select 'nation:' || c_nationkey as key, 'set' as type, 20 as enc, c_nationkey::bigint as n, string_agg(c_custkey::varchar, ',' order by c_custkey::varchar) as canon from customer group by c_nationkey"),
        ("0", "select 'brand:' || p_brand as key, 'zset' as type, 17 as enc, regexp_extract(p_brand, '(\\d+)', 1)::bigint as n, string_agg(p_partkey::varchar || ':' || printf('%.6f', p_retailprice), ',' order by p_retailprice, p_partkey::varchar) as canon from part group by p_brand"),
        ("0", "select 'stream:' || user_id as key, 'stream' as type, 21 as enc, user_id as n, string_agg((epoch_us(ts) // 1000)::varchar || '-0|' || event_type, ',' order by ts, event_id) as canon from events group by user_id"),
    ]
) + ")"

TGT = """kept as (select * from src where n % 11 <> 0),
tgt as (select key,
  case when n % 37 = 0 then case when type = 'string' then 'list' else 'string' end else type end as type, enc, n,
  case when n % 37 <> 0 and n % 29 <> 0 and n % 23 <> 0 and n % 31 = 0 and expire_ms > 0 then expire_ms + 60000 else expire_ms end as expire_ms, flow,
  case when n % 37 <> 0 and n % 29 = 0 then canon || case type when 'string' then 'x' when 'hash' then ';x=1' else ',x' end
       when n % 37 <> 0 and n % 29 <> 0 and n % 23 = 0 then substr(canon, 1, length(canon) - 1) || '~' else canon end as canon
  from kept
  union all select 'extra:' || n, type, enc, n, expire_ms, flow, canon from src where type = 'string' and n % 50 = 0)"""


def _len(kind: str, canon: str) -> str:
    return f"(case {kind} when 'string' then length({canon}) when 'hash' then len(string_split({canon}, ';')) else len(string_split({canon}, ',')) end)"


BOTH = f"""paired as (select s.key, s.type, t.type as target_type, s.expire_ms, t.expire_ms as e2, s.canon, t.canon as c2, t.key as k2,
  {_len('s.type', 's.canon')} as len1, {_len('s.type', 't.canon')} as len2 from src s left join tgt t on s.key = t.key)"""

JOURNAL = f"""journal as (select user_id % {FLOWS} as flow, event_id as seq,
  case when event_id % 997 = 0 or event_id % 499 = 0 or event_type in ('click', 'purchase') then 'COMMAND' when event_type = 'error' then 'EXPIRED' when event_type = 'view' then 'PING' else 'LSN' end as opcode,
  event_id // 3 as txid, 2::bigint as shard_cnt,
  case when event_id % 997 <> 0 and event_id % 499 <> 0 and event_type = 'signup' then event_id * 2 end as lsn,
  case when event_id % 997 = 0 then 'FLUSHALL' when event_id % 499 = 0 then 'INCR' when event_type = 'click' then 'SET' when event_type = 'purchase' then 'HSET' when event_type = 'error' then 'DEL' end as cmd,
  user_id, printf('%.6f', value) as v, json_extract_string(props, '$.k') as field from events),
classed as (select *, case when opcode = 'PING' then 'ping' when opcode = 'LSN' then 'lsn' when cmd = 'FLUSHALL' then 'skip_global' when cmd in ('SET', 'HSET', 'DEL') then 'apply' else 'unsupported' end as class from journal)"""

SAMPLES = f"samples as (select user_id % {FLOWS} as flow, epoch_us(ts) as us, 1 as n, round(value * 100)::bigint as latency, event_id as id from events)"

_TABLE = "[" + ", ".join(map(str, crc_table())) + "]"


def _slot(key: str) -> str:
    tag = f"case when regexp_extract({key}, '^[^{{]*\\{{([^}}]+)\\}}', 1) <> '' then regexp_extract({key}, '^[^{{]*\\{{([^}}]+)\\}}', 1) else {key} end"
    digits = f"hex(encode({tag}))"
    codes = f"list_transform(range(0, length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::bigint)"
    return f"(list_reduce({codes}, lambda c, b: xor((c << 8) & 65535, {_TABLE}[(xor(c >> 8, b) & 255) + 1]::bigint), 0::bigint) % 16384)"


NODE = "case " + " ".join(f"when slot between {a} and {b} then '{n}'" for n, a, b in NODES) + " end"
ROUTED = f"slotted as (select key, type, n, {_slot('key')} as slot from src), routed as (select *, {NODE} as node from slotted)"
RENDERED = """rendered as (select key, 0::bigint as step, case type when 'string' then 'SET' when 'hash' then 'HSET' when 'list' then 'RPUSH' when 'set' then 'SADD' else 'ZADD' end || ' ' || key || ' ' || canon as command from src where type <> 'stream'
  union all select key, 1, 'PEXPIREAT ' || key || ' ' || expire_ms from src where type <> 'stream' and expire_ms > 0)"""
TAGGED = f"tagged as (select key, {_slot('key')} as slot from (select '{{nation' || c_nationkey || '}}:customer:' || c_custkey as key from customer))"


def _with(*tables: str) -> str:
    return "with " + ", ".join(tables) + " "


def _verdict(length: bool, value: str, ttl: bool) -> str:
    parts = ["when k2 is null then 'missing'", "when type <> target_type then 'type_mismatch'"]
    parts += ["when len1 <> len2 then 'length_mismatch'"] * length
    parts += [f"when {value} and canon is distinct from c2 then 'value_mismatch'"] * bool(value)
    parts += ["when expire_ms <> e2 then 'ttl_mismatch'"] * ttl
    return "case " + " ".join(parts) + " else 'consistent' end"


FULL = f"found as (select key, type, target_type, {_verdict(True, 'true', True)} as verdict from paired)"
_check = lambda *a: _with(SRC, TGT, BOTH) + f"select key, type, target_type, {_verdict(*a)} as verdict from paired"
_full_of = lambda kind: _with(SRC, TGT, BOTH, FULL) + f"select * from found where type = '{kind}'"

STATE = """writes as (select case when cmd = 'HSET' then 'cart:' else 'user:' end || user_id as key, case when cmd = 'HSET' then field else '' end as field, seq, case when cmd <> 'DEL' then v end as value, cmd = 'DEL' as gone from classed where class = 'apply'),
last as (select key, field, max_by(value, seq) filter (not gone) as value, max(seq) filter (not gone) as seq from writes group by all),
cut as (select key, max(seq) as cut from writes where gone group by key)"""
_percent = lambda p: f"list_sort(list(latency))[count(*) * {p} // 100 + 1] as p{p}"

ORACLES = {
    "scan_keyspace": _with(SRC) + "select key, type, enc, n, expire_ms, flow, canon from src",
    "type_of_encoding": _with(SRC) + "select enc, type, count(*) as keys from src group by all",
    "type_histogram": _with(SRC) + "select type, count(*) as keys from src group by type",
    "filter_expired": _with(SRC) + f"select key, expire_ms from src where expire_ms = 0 or expire_ms >= {AS_OF_MS}",
    "ttl_remaining": _with(SRC) + f"select key, greatest(expire_ms - {AS_OF_MS}, 0) as ttl_ms from src where expire_ms > 0",
    "value_length": _with(SRC) + f"select key, {_len('type', 'canon')} as length from src",
    "big_keys": _with(SRC) + f"select key, {_len('type', 'canon')} as length from src where {_len('type', 'canon')} > 10",
    "check_outline": _check(False, "", True),
    "check_outline_as_built": _check(False, "", False),
    "check_length": _check(True, "", True),
    "check_length_as_built": _check(False, "true", False),
    "check_smart_as_built": _check(False, "", False),
    "check_smart": _check(True, "len1 <= 10", True),
    "check_full": _check(True, "true", True),
    **{f"check_full_{k}": _full_of(k) for k in ("string", "hash", "list", "set", "zset", "stream")},
    "check_summary": _with(SRC, TGT, BOTH, FULL) + "select count(*) as total, count(*) filter (where verdict = 'consistent') as consistent, count(*) filter (where verdict <> 'consistent') as inconsistent, count(*) filter (where verdict = 'missing') as missing from found",
    "check_missing": _with(SRC, TGT) + "select key, type from src where key not in (select key from tgt)",
    "check_type_mismatch": _with(SRC, TGT, BOTH) + "select key, type, target_type from paired where type <> target_type",
    "check_extra": _with(SRC, TGT) + "select key, type from tgt where key not in (select key from src)",
    "check_max_keys": _with(SRC) + "select key, type from src order by key limit 1000",
    "mismatch_samples": _with(SRC, TGT, BOTH, FULL) + "select key, verdict from found where verdict <> 'consistent' order by key limit 100",
    "string_mismatches": _with(SRC, TGT, BOTH) + "select key, canon as source_value, c2 as target_value from paired where type = 'string' and target_type = 'string' and coalesce(canon, '') <> coalesce(c2, '')",
    "common_keys": _with(SRC, TGT) + "select key from src intersect select key from tgt",
    "key_filter_prefix": _with(SRC) + "select key, type from src where key like 'nation:%' or key like 'customer:1%' or key = 'order:7'",
    "conflict_overwrite": _with(SRC, TGT) + "select key, type, canon from src union all select key, type, canon from tgt where key not in (select key from src)",
    "conflict_skip": _with(SRC, TGT) + "select key, type, canon from tgt union all select key, type, canon from src where key not in (select key from tgt)",
    "conflict_panic_keys": _with(SRC, TGT) + "select key from src intersect select key from tgt",
    "key_slot": _with(SRC, ROUTED) + "select key, slot from routed",
    "hash_tag": _with(TAGGED) + "select key, slot from tagged",
    "slot_to_node": _with(SRC, ROUTED) + "select key, slot, node from routed",
    "slot_histogram": _with(SRC, ROUTED) + "select slot, count(*) as keys from routed group by slot",
    "keys_per_node": _with(SRC, ROUTED) + "select node, count(*) as keys from routed group by node",
    "render_commands": _with(SRC, RENDERED) + "select key, step, command from rendered",
    "rdb_command_count": _with(SRC, RENDERED) + "select count(*) as commands, count(distinct key) as keys from rendered",
    "scan_journal": _with(JOURNAL) + "select flow, seq, opcode, txid, shard_cnt, lsn, cmd from journal",
    "classify_journal": _with(JOURNAL) + "select seq, class from classed",
    "skip_global_commands": _with(JOURNAL) + "select seq, cmd from classed where cmd is not null and class <> 'skip_global'",
    "unsupported_commands": _with(JOURNAL) + "select seq, cmd from classed where class = 'unsupported'",
    "replay_stats": _with(JOURNAL) + "select count(*) as total, count(*) filter (where class = 'apply') as ok, count(*) filter (where class in ('ping', 'skip_global')) as skipped, count(*) filter (where class = 'unsupported') as failed from classed",
    "entries_per_flow": _with(JOURNAL) + "select flow, count(*) as entries from journal group by flow",
    "flow_last_lsn": _with(JOURNAL) + "select flow, max_by(lsn, seq) as lsn from journal where lsn is not null group by flow",
    "global_lsn": _with(JOURNAL) + "select max(lsn) as lsn from journal",
    "txn_completeness": _with(JOURNAL) + "select txid, count(distinct flow) as flows, max(shard_cnt) as shards, count(distinct flow) >= max(shard_cnt) as complete from journal group by txid",
    "ack_counter": _with(JOURNAL, "numbered as (select *, row_number() over (partition by flow order by seq) as rn from journal)") + "select flow, seq, rn + greatest(0, coalesce(max(lsn - rn) over (partition by flow order by seq), 0)) as ack from numbered",
    "batch_assignment": _with(JOURNAL) + "select flow, seq, (row_number() over (partition by flow order by seq) - 1) // 500 as batch from journal",
    "materialize_lww": _with(JOURNAL, STATE) + "select l.key, l.field, l.value, l.seq from last l left join cut c on l.key = c.key where l.seq is not null and (c.cut is null or l.seq > c.cut)",
    "materialize_snapshot_journal": _with(JOURNAL, STATE, """old as (select 'user:' || c_custkey as key, '' as field, c_name as value from customer
  union all select 'cart:' || c_custkey, 'seg', c_mktsegment from customer union all select 'cart:' || c_custkey, 'a', c_name from customer),
new as (select l.key, l.field, l.value, l.seq from last l left join cut c on l.key = c.key where l.seq is not null and (c.cut is null or l.seq > c.cut))""") + """select * from new
  union all select o.key, o.field, o.value, -1 from old o anti join cut using (key) where not exists (from new n where n.key = o.key and n.field = o.field)""",
    "qps_sliding": _with(SAMPLES) + "select id, flow, (sum(n) over w)::bigint as ops, us - min(us) over w as span_us from samples window w as (partition by flow order by us range between 3599999999 preceding and current row)",
    "latency_percentiles": _with(SAMPLES) + f"select flow, {', '.join(_percent(p) for p in (50, 95, 99))}, max(latency) as max_latency, count(*) as samples from samples group by flow",
    "history_last_n": _with(SAMPLES) + "select id, flow, rank from (select *, row_number() over (partition by flow order by us desc, id desc) as rank from samples) where rank <= 100",
    "metrics_coalesce": _with(SAMPLES) + "select flow, us // 2000000 as span, arg_max(latency, (us, id)) as latency from samples group by all",
}


def _replication() -> dict[str, str]:
    from .replication import sql

    return sql()


ORACLES |= _replication()
