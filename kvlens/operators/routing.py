"""Keys to hash slots and nodes, and rendering of records as write commands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import NODES
from ..functions.slots import slot

# Value encodings of each logical type.
ENCODINGS = {"string": [0], "hash": [4, 13, 16], "list": [14, 18], "set": [2, 11, 20], "zset": [5, 12, 17], "stream": [15, 19, 21]}
# The write command of each type.
COMMANDS = {"string": "SET", "hash": "HSET", "list": "RPUSH", "set": "SADD", "zset": "ZADD"}


def routed(df: DataFrame, nodes=NODES, key: str = "key") -> DataFrame:
    """df with slot and node; the ranges are at most one per slot and become one expression, so nothing is shuffled."""
    s = slot(F.col(key))
    node = F.lit(None).cast("string")
    for name, first, last in nodes:
        node = F.when(F.col("slot").between(first, last), name).otherwise(node)
    return df.withColumn("slot", s).withColumn("node", node)


def type_of(enc):
    out = F.lit("unsupported")
    for kind, codes in ENCODINGS.items():
        out = F.when(enc.isin(codes), kind).otherwise(out)
    return out


def rendered(df: DataFrame) -> DataFrame:
    """key, step and command: a write for each record of a supported type, then PEXPIREAT where it expires."""
    name = F.lit(None).cast("string")
    for kind, cmd in COMMANDS.items():
        name = F.when(F.col("type") == kind, cmd).otherwise(name)
    write = F.concat_ws(" ", name, "key", "canon")
    expire = F.when(F.col("expire_ms") > 0, F.concat_ws(" ", F.lit("PEXPIREAT"), "key", F.col("expire_ms").cast("string")))
    return df.where(name.isNotNull()).select("key", F.posexplode(F.array_compact(F.array(write, expire))).alias("step", "command")).withColumn("step", F.col("step").cast("long"))


def live(df: DataFrame, as_of_ms: int) -> DataFrame:
    """Records that haven't expired: no expiry, or one that isn't before ``as_of_ms``."""
    return df.where((F.col("expire_ms") == 0) | (F.col("expire_ms") >= as_of_ms))
