"""Decoding of text replies and payloads with built-in expressions.

Defined cases: an odd last element of a pair list is ignored; a score that isn't a
number is 0; a reply that doesn't match gives null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Numbers and names of journal records.
OPCODES = {0: "NOOP", 6: "SELECT", 9: "EXPIRED", 10: "COMMAND", 13: "PING", 15: "LSN", 99: "FIN"}


def pairs_to_map(a: str) -> str:
    return f"map_from_entries(transform(filter(sequence(0, size({a})), i -> i % 2 = 0 and i + 1 < size({a})), i -> struct({a}[i], {a}[i + 1])))"


def opcode_name(code):
    out = F.concat(F.lit("UNKNOWN("), code.cast("string"), F.lit(")"))
    for k, v in OPCODES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def truncated(text, n: int):
    return F.when(F.octet_length(text) <= n, text).otherwise(F.concat(F.substring(text, 1, n), F.lit("...")))


def moved(reply):
    """(slot, address) of a redirect."""
    part = lambda i: F.nullif(F.regexp_extract(reply, r"MOVED (\d+) (\S+)", i), F.lit(""))
    return part(1).cast("long"), part(2)


def info_keys(lines: DataFrame) -> DataFrame:
    """The sum of ``keys=`` over lines of keyspace statistics."""
    return lines.agg(F.coalesce(F.sum(F.regexp_extract("line", r"keys=(\d+)", 1).try_cast("long")), F.lit(0).cast("long")).alias("total"))


def cluster_nodes(lines: DataFrame) -> DataFrame:
    """One row for each slot range of a line of topology: id, addr, flags, master, slot_start, slot_end (null without slots)."""
    w = F.split("line", " ")
    ranges = lines.select(w.alias("w")).select("w", F.explode_outer(F.expr("filter(slice(w, 9, greatest(size(w) - 8, 0)), x -> x rlike '^[0-9]')")).alias("r"))
    end = lambda i: F.element_at(F.split("r", "-"), i).cast("long")
    master = F.when(F.get("w", F.lit(3)) != "-", F.get("w", F.lit(3)))
    return ranges.select(F.get("w", F.lit(0)).alias("id"), F.split_part(F.get("w", F.lit(1)), F.lit("@"), F.lit(1)).alias("addr"), F.get("w", F.lit(2)).alias("flags"), master.alias("master"), end(1).alias("slot_start"), end(-1).alias("slot_end"))
