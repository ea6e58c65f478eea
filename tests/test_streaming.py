"""Streams over several files, one a micro-batch, against the same rows as a batch; late rows; a run that goes on from another."""

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kvlens.fixtures import journal_of
from kvlens.operators import changes
from kvlens.streaming import replay


@pytest.fixture
def files(spark, data, tmp_path):
    """events in four files, in order of time."""
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    rows = spark.read.parquet(f"{data}/events.parquet")
    cuts = rows.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.0)
    for i in range(4):
        part = rows.where(f"event_id > {cuts[i - 1] if i else -1} and event_id <= {cuts[i] if i < 3 else 1e18}")
        part.coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        shutil.copy(next((tmp_path / f"w{i}").glob("*.parquet")), folder / f"part-{i}.parquet")
    return tmp_path


def test_state_is_carried_over_batches(spark, files):
    stream = journal_of(replay.source(spark, str(files), "events", 1))
    batch = journal_of(spark.read.parquet(f"{files}/events.parquet"))
    at = f"file://{files}/lww"
    got = replay.last_writes(changes.writes(stream), at)
    assert spark.read.parquet(f"{at}/out").select("batch").distinct().count() >= 4
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, changes.current(batch).collect()))
    last = {r.flow: r.ack for r in changes.acks(batch).groupBy("flow").agg(F.max_by("ack", "seq").alias("ack")).collect()}
    assert {r.flow: r.ack for r in replay.acks(stream.select("flow", "seq", "lsn")).collect()} == last


def test_a_run_goes_on_from_another(spark, files):
    at, held = f"file://{files}/acks", files / "held.parquet"
    shutil.move(files / "events.parquet" / "part-3.parquet", held)
    run = lambda: {r.flow: (r.entries, r.ack) for r in replay.acks(journal_of(replay.source(spark, str(files), "events", 1)).select("flow", "seq", "lsn"), at).collect()}
    first = run()
    assert run() == first
    shutil.move(held, files / "events.parquet" / "part-3.parquet")
    whole = journal_of(spark.read.parquet(f"{files}/events.parquet"))
    want = {r.flow: (r.n, r.ack) for r in changes.acks(whole).groupBy("flow").agg(F.count(F.lit(1)).alias("n"), F.max_by("ack", "seq").alias("ack")).collect()}
    assert run() == want != first


def test_late_rows_are_left_out(spark, tmp_path):
    """A row behind the watermark of the batch before isn't counted; one within it is."""
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    for i, times in enumerate((["10:05", "10:10"], ["14:00"], ["14:05"], ["13:30", "10:20"])):
        spark.createDataFrame([(f"2024-01-01 {t}:00", "k") for t in times], "t string, by string").withColumn("at", F.to_timestamp("t")).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        shutil.copy(next((tmp_path / f"w{i}").glob("*.parquet")), folder / f"part-{i}.parquet")
    got = replay.window_counts(replay.source(spark, str(tmp_path), "events", 1), "by")
    counts = {r.start_us // 3_600_000_000 % 24: r.n for r in got.collect()}
    assert counts == {10: 2, 14: 2, 13: 1}


def test_orders_over_many_buckets(spark, monkeypatch):
    """Acknowledgements and batches are those of one window over a flow, wherever the ranges are cut."""
    monkeypatch.setattr(changes, "BUCKET", 7)
    rows = [(i % 3, i, i * 2 if i % 11 == 0 else None) for i in range(0, 400, 2)]
    df = spark.createDataFrame(rows, "flow long, seq long, lsn long")
    want_ack, want_batch = {}, {}
    for flow in range(3):
        ack = 0
        for n, (_, seq, lsn) in enumerate(r for r in rows if r[0] == flow):
            ack = max(ack + 1, lsn or 0)
            want_ack[flow, seq], want_batch[flow, seq] = ack, n // 9
    assert {(r.flow, r.seq): r.ack for r in changes.acks(df).collect()} == want_ack
    assert {(r.flow, r.seq): r.batch for r in changes.batches(df, 9).collect()} == want_batch


def test_hash_and_string_replace_each_other(spark):
    rows = [(1, "HSET", ["h", "f", "1", "g", "2", "f", "3"]), (2, "SET", ["h", "s"]), (3, "HSET", ["k", "f", "1", "odd"]), (4, "SET", ["x", "1"]), (5, "DEL", ["x", "nothing"]), (6, "HSET", ["bad", "f"]), (7, "SET", ["z"]), (8, "SET", [])]
    df = spark.createDataFrame([(s, "COMMAND", c, a) for s, c, a in rows], "seq long, opcode string, cmd string, args array<string>")
    assert sorted(map(tuple, changes.current(df).collect())) == [("h", "", "s", 2), ("k", "f", "1", 3), ("z", "", None, 7)]
    assert changes.current(df.limit(0)).collect() == []
