"""Files that the driver and every executor can reach.

The folder is the one the session names in ``spark.checkpoint.dir``; only where
that is unset (tests, a laptop) is a temporary folder set for the session.
Executors reach it by ``pyarrow.fs``, which opens file, hdfs, s3 and gs paths.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="kvlens-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root if "://" in root else "file://" + os.path.abspath(root)


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: its lineage ends there."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``written``, dealt and sorted by key: joins on it don't move these rows again. ``freed`` also drops its table."""
    spark = df.sparkSession
    path, table = fresh(spark, name), f"kvlens_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.written_at, out.written_as = path, table
    return out


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Deletes the files of frames made by ``written``, once nothing reads them."""
    for df in frames:
        remove(df.sparkSession, df.written_at)


def freed(spark: SparkSession, *frames: DataFrame) -> None:
    """Discards frames, and lets the driver free the shuffle files that nothing refers to any more."""
    discard(*frames)
    for df in frames:
        if hasattr(df, "written_as"):
            spark.sql(f"drop table {df.written_as}")
    gc.collect()
    spark._jvm.System.gc()


def put(uri: str, blocks) -> int:
    """Writes byte blocks to uri: under another name first, so that a lost or repeated task leaves whole files only."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part, n = f"{path}.{uuid.uuid4().hex}", 0
    with store.open_output_stream(part, compression=None) as out:
        for b in blocks:
            out.write(b)
            n += len(b)
    store.move(part, path)
    return n


def get(uri: str) -> bytes:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path, compression=None) as f:
        return f.read()
