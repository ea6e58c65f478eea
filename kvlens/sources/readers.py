"""Spark readers for binary snapshots and journals: one partition for each file, which is one flow.

``register(spark)``, then ``spark.read.format("kv_snapshot").load(folder)`` or
``"kv_journal"``. Files are opened by ``pyarrow.fs`` where the task runs (file, hdfs,
s3, gs) and read once; a lost task reads its own file again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import binary

SNAPSHOT = "flow long, seq long, db long, key string, enc long, type string, expire_ms long, str string, items array<string>, hash map<string,string>, zset array<struct<score:double,member:string>>, stream array<struct<ms:long,no:long,fields:map<string,string>>>"
JOURNAL = "flow long, seq long, phase string, opcode string, db long, txid long, shard_cnt long, lsn long, cmd string, args array<string>"


class File(InputPartition):
    def __init__(self, flow: int, uri: str):
        self.flow, self.uri = flow, uri


def _text(b: bytes) -> str:
    return b.decode("utf-8", "replace")


class _Reader(DataSourceReader):
    def __init__(self, path: str, only: str):
        self.path, self.only = path if "://" in path else f"file://{path}", only

    def partitions(self) -> list[File]:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(at)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at))
        names = sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))
        root = self.path[: len(self.path) - len(at)] if self.path.endswith(at) else self.path.split("://")[0] + "://"
        return [File(i, root + n) for i, n in enumerate(names)]

    def read(self, partition: File) -> Iterator[tuple]:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(partition.uri)
        with store.open_input_stream(at, compression=None, buffer_size=1 << 20) as file:
            yield from self.rows(partition.flow, file)


class _Snapshot(_Reader):
    def rows(self, flow: int, file) -> Iterator[tuple]:
        for seq, (_, r) in enumerate(x for x in binary.snapshot(file) if x[0] == "record"):
            kind, v = r["type"], r["value"]
            pairs = lambda p: {_text(a): _text(b) for a, b in p}
            yield (
                flow, seq, r["db"], _text(r["key"]), r["enc"], kind, r["expire_ms"],
                _text(v) if kind == "string" else None,
                [_text(x) for x in v] if kind in ("list", "set") else None,
                pairs(v) if kind == "hash" else None,
                sorted((s, _text(m)) for m, s in v) if kind == "zset" else None,
                [(ms, no, pairs(f)) for ms, no, f in v] if kind == "stream" else None,
            )


class _Journal(_Reader):
    def rows(self, flow: int, file) -> Iterator[tuple]:
        inline = self.only == "inline"
        found = (r for k, r in binary.snapshot(file) if k == "journal") if inline else binary.journal(file)
        for seq, r in enumerate(found):
            yield flow, seq, "inline" if inline else "stable", r["opcode"], r["db"], r["txid"], r["shard_cnt"], r["lsn"], r["cmd"], r["args"]


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kv_snapshot"

    def schema(self) -> str:
        return SNAPSHOT

    def reader(self, schema) -> DataSourceReader:
        return _Snapshot(self.options["path"], "record")


class JournalSource(DataSource):
    """Option ``phase``: ``stable`` (journal files, the default) or ``inline`` (the changes within snapshots)."""

    @classmethod
    def name(cls) -> str:
        return "kv_journal"

    def schema(self) -> str:
        return JOURNAL

    def reader(self, schema) -> DataSourceReader:
        return _Journal(self.options["path"], self.options.get("phase", "stable"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SnapshotSource)
    spark.dataSource.register(JournalSource)
