"""Hand-built bytes through the decoders and the readers."""

import io
import struct

import pytest
import zstandard

from kvlens.sources import binary, readers


def s(x: bytes) -> bytes:
    return (bytes([len(x)]) if len(x) < 64 else bytes([0x40 | len(x) >> 8, len(x) & 255])) + x


def lp(*items: bytes) -> bytes:
    body = b""
    for x in items:
        e = bytes([0x80 | len(x)]) + x
        body += e + bytes([len(e)])
    return struct.pack("<IH", len(body) + 7, len(items)) + body + b"\xff"


def command(*words: bytes, code=10) -> bytes:
    return bytes([code, 5, 2, len(words)]) + bytes([sum(map(len, words))]) + b"".join(map(s, words))


def snapshot() -> bytes:
    hidden = b"\x00" + s(b"z") + s(b"in block") + b"\xcb"
    block = zstandard.ZstdCompressor().compress(hidden)
    zl = struct.pack("<IIH", 0, 0, 2) + b"\x00\x01a" + b"\x03\xf5" + b"\xff"
    stream = lp(b"1", b"0", b"1", b"f", b"0", b"2", b"0", b"0", b"v", b"0")
    return (
        b"REDIS0009" + b"\xfa" + s(b"ver") + s(b"1") + b"\xfe\x03" + b"\xfb\x01\x00"
        + b"\xfc" + struct.pack("<q", 99) + b"\x00" + s(b"a") + b"\xc1\x2c\x01"
        + b"\xfd" + struct.pack("<i", 7) + b"\x04" + s(b"h") + b"\x01" + s(b"f") + s(b"v")
        + b"\x12" + s(b"l") + b"\x02\x01" + s(b"plain") + b"\x02" + s(lp(b"x", b"y"))
        + b"\x0b" + s(b"i") + s(struct.pack("<IIhh", 2, 2, -5, 6))
        + b"\x11" + s(b"zs") + s(lp(b"m", b"1.5", b"n", b"bad"))
        + b"\x05" + s(b"z2") + b"\x01" + s(b"m") + struct.pack("<d", 2.25)
        + b"\x0a" + s(b"zl") + s(zl)
        + b"\xd2\x01" + s(command(b"SET", b"k", b"v"))
        + b"\x0f" + s(b"st") + b"\x01" + s(struct.pack(">QQ", 10, 1)) + s(stream) + b"\x01\x0a\x01\x00"
        + b"\xc9" + s(block) + b"\xd3" + bytes(8) + b"\xff" + bytes(8)
    )


def test_snapshot_bytes():
    found = list(binary.snapshot(io.BytesIO(snapshot())))
    keys = {r["key"]: r for k, r in found if k == "record"}
    assert keys[b"a"]["value"] == b"300" and keys[b"a"]["expire_ms"] == 99 and keys[b"a"]["db"] == 3
    assert keys[b"h"]["value"] == [(b"f", b"v")] and keys[b"h"]["expire_ms"] == 7000
    assert keys[b"l"]["value"] == [b"plain", b"x", b"y"] and keys[b"l"]["expire_ms"] == 0
    assert keys[b"i"]["value"] == [b"-5", b"6"]
    assert keys[b"zs"]["value"] == [(b"m", 1.5), (b"n", 0.0)]
    assert keys[b"z2"]["value"] == [(b"m", 2.25)]
    assert keys[b"zl"]["value"] == [b"a", b"4"]
    assert keys[b"st"]["value"] == [(10, 1, [(b"f", b"v")])]
    assert keys[b"z"]["value"] == b"in block"
    assert [r["args"] for k, r in found if k == "journal"] == [["k", "v"]]


def test_faults_are_told():
    with pytest.raises(ValueError):
        list(binary.snapshot(io.BytesIO(b"RUBBISH09")))
    with pytest.raises(ValueError):
        list(binary.snapshot(io.BytesIO(snapshot()[:40])))
    with pytest.raises(ValueError):
        list(binary.journal(b"\x00"))
    assert list(binary.journal(b"")) == []


def test_lzf_listpack_numbers():
    assert binary.unlzf(b"\x00a\x40\x00", 5) == b"aaaaa"
    data = struct.pack("<IH", 0, 4) + b"\x05\x01" + b"\xdf\xff\x02" + b"\xf1\xfe\xff\x03" + b"\xf3\x00\x00\x01\x00\x05" + b"\xff"
    assert binary.listpack(data) == [b"5", b"-1", b"-2", b"65536"]


def test_readers(spark, tmp_path):
    readers.register(spark)
    for name in ("0.rdb", "1.rdb"):
        (tmp_path / "snap").mkdir(exist_ok=True)
        (tmp_path / "snap" / name).write_bytes(snapshot())
    df = spark.read.format("kv_snapshot").load(str(tmp_path / "snap"))
    assert df.count() == 18 and {r[0] for r in df.select("flow").collect()} == {0, 1}
    assert df.where("key = 'h'").first().hash == {"f": "v"}
    assert spark.read.format("kv_journal").option("phase", "inline").load(str(tmp_path / "snap")).count() == 2
    (tmp_path / "log").write_bytes(b"\x06\x02" + command(b"HSET", b"k", b"f", b"1") + b"\x0d" + b"\x0f\x40\xff" + command(b"DEL", b"k", code=9))
    rows = spark.read.format("kv_journal").load(str(tmp_path / "log")).orderBy("seq").collect()
    assert [(r.opcode, r.db, r.lsn, r.cmd) for r in rows] == [("COMMAND", 2, None, "HSET"), ("PING", 2, None, None), ("LSN", 2, 255, None), ("EXPIRED", 2, None, "DEL")]
