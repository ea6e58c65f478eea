"""Change streams with Structured Streaming, each run over what is available now.

Every query keeps its offsets and its output in the folder that the session names in
``spark.checkpoint.dir``, so a lost executor or a new start goes on from there. State
is held by the built-in state store, by key; outputs are written in each batch under
the batch's number, so a batch that is run again replaces its own rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _folder(spark: SparkSession, name: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="kvlens-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def source(spark: SparkSession, folder: str, name: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the Parquet files of a table: of one file, or of a folder of files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # As a pattern the path may be a file as well as a folder.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{folder}/{name}.parque[t]")


def drained(stream: DataFrame, name: str, mode: str, at: str | None = None) -> DataFrame:
    """Runs a stream over all that is there; returns what each batch gave, with its number in ``batch``.

    ``at`` is the folder of its offsets, state and output: a later run with the same one goes on from there.
    """
    spark, at = stream.sparkSession, at or _folder(stream.sparkSession, name)

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{at}/out/batch={batch}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/out")
    there = found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)
    return spark.read.schema(schema).option("basePath", f"{at}/out").parquet(f"{at}/out") if there else spark.createDataFrame([], schema)


def last_writes(writes: DataFrame, at: str | None = None) -> DataFrame:
    """Stream of (key, field, seq, at, value, gone) to the state after it: a later DEL of a key removes its fields."""
    each = writes.groupBy("key", "field").agg(F.max(F.struct("seq", "at", "value", "gone")).alias("w"), F.max(F.when(F.col("gone"), F.col("seq"))).alias("cut"))
    state = drained(each, "stream-lww", "update", at).groupBy("key", "field").agg(F.max("w").alias("w"), F.max("cut").alias("cut"))
    cuts = state.where("cut is not null").groupBy(F.col("key").alias("k")).agg(F.max("cut").alias("c"))
    return state.join(cuts, F.col("key") == F.col("k"), "left").where("not w.gone and (c is null or w.seq > c)").select("key", "field", F.col("w.value").alias("value"), F.col("w.seq").alias("seq"))


def window_counts(events: DataFrame, by: str, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts of tumbling windows of event time (column ``at``, timestamp); rows later than ``late`` are left out."""
    counts = events.withWatermark("at", late).groupBy(F.window("at", size).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    found = drained(counts.select(F.unix_micros("w.start").alias("start_us"), by, "n"), "stream-windows", "update")
    return found.groupBy("start_us", by).agg(F.max("n").alias("n"))


def acks(journal: DataFrame, at: str | None = None) -> DataFrame:
    """flow, entries, ack after a stream of (flow, seq, lsn): an LSN record jumps ahead if it is greater, any other adds 1."""

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        entries, ahead = state.get if state.exists else (0, 0)
        batch = pd.concat([p[["seq", "lsn"]] for p in parts]).sort_values("seq")
        number = entries + 1 + pd.Series(range(len(batch)), index=batch.index)
        jump = (batch["lsn"] - number).max()
        entries, ahead = entries + len(batch), max(ahead, 0 if pd.isna(jump) else int(jump))
        state.update((entries, ahead))
        yield pd.DataFrame({"flow": [key[0]], "entries": [entries], "ack": [entries + ahead]})

    found = journal.groupBy("flow").applyInPandasWithState(fold, "flow long, entries long, ack long", "entries long, ahead long", "update", GroupStateTimeout.NoTimeout)
    return drained(found, "stream-acks", "update", at).groupBy("flow").agg(F.max("entries").alias("entries"), F.max_by("ack", "entries").alias("ack"))


def once(rows: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once, among rows within ``late`` of each other (column ``at``, timestamp)."""
    return drained(rows.withWatermark("at", late).dropDuplicatesWithinWatermark(keys).select(*keys), "stream-once", "append").select(*keys)
