"""Binary snapshots and change journals: decoders that read a stream once, in bounded steps.

A snapshot is the public RDB layout (version 9) with inline journal blocks and
Zstandard blocks; a journal is a run of records. Only one record is held at a time.

Defined cases: an unknown code, a wrong magic or an early end raises ValueError, as
what follows can't be told apart; a file that stops between two records ends there.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

# Codes of a snapshot stream.
EXPIRE_S, EXPIRE_MS, SELECT, RESIZE, AUX, END, IDLE, FREQ = 0xFD, 0xFC, 0xFE, 0xFB, 0xFA, 0xFF, 0xF8, 0xF9
SYNC_END, ZSTD, LZ4, BLOCK_END, JOURNAL, OFFSET = 0xC8, 0xC9, 0xCA, 0xCB, 0xD2, 0xD3
# Codes of journal records.
J_SELECT, J_EXPIRED, J_COMMAND, J_PING, J_LSN = 6, 9, 10, 13, 15
J_NAMES = {J_EXPIRED: "EXPIRED", J_COMMAND: "COMMAND", J_PING: "PING", J_LSN: "LSN"}


class Bytes:
    """Exact reads from a file-like object."""

    def __init__(self, file):
        self.file = file

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while left:
            part = self.file.read(min(left, 1 << 20))
            if not part:
                raise ValueError(f"stream ends {left} bytes early")
            parts.append(part)
            left -= len(part)
        return b"".join(parts)

    def code(self) -> int | None:
        b = self.file.read(1)
        return b[0] if b else None

    def number(self, layout: str) -> int | float:
        return struct.unpack(layout, self.take(struct.calcsize(layout)))[0]

    def length(self) -> tuple[int, bool]:
        """(value, whether it names a special encoding)."""
        b = self.take(1)[0]
        kind = b >> 6
        if kind == 0:
            return b & 63, False
        if kind == 1:
            return (b & 63) << 8 | self.take(1)[0], False
        if kind == 3:
            return b & 63, True
        if b == 0x80:
            return self.number(">I"), False
        if b == 0x81:
            return self.number(">Q"), False
        raise ValueError(f"length code {b:#x}")

    def uint(self) -> int:
        value, special = self.length()
        if special:
            raise ValueError("a number is expected")
        return value

    def string(self) -> bytes:
        value, special = self.length()
        if not special:
            return self.take(value)
        if value < 3:
            return str(self.number("<" + "bhi"[value])).encode()
        if value == 3:
            packed, size = self.uint(), self.uint()
            return unlzf(self.take(packed), size)
        raise ValueError(f"string code {value}")


def unlzf(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        c = data[i]
        i += 1
        if c < 32:
            out += data[i : i + c + 1]
            i += c + 1
            continue
        n = c >> 5
        if n == 7:
            n += data[i]
            i += 1
        at = len(out) - ((c & 31) << 8) - data[i] - 1
        i += 1
        if at < 0:
            raise ValueError("LZF reference before the start")
        for k in range(n + 2):
            out.append(out[at + k])
    if len(out) != size:
        raise ValueError("LZF size")
    return bytes(out)


def _int(data: bytes) -> bytes:
    return str(int.from_bytes(data, "little", signed=True)).encode()


def listpack(data: bytes) -> list[bytes]:
    out, i = [], 6
    while data[i] != 0xFF:
        b, head = data[i], 1
        if b < 0x80:
            value, n = str(b).encode(), 0
        elif b < 0xC0:
            n = b & 63
            value = data[i + 1 : i + 1 + n]
        elif b < 0xE0:
            v, n = (b & 31) << 8 | data[i + 1], 1
            value = str(v - 8192 if v >= 4096 else v).encode()
        elif b < 0xF0:
            n, head = (b & 15) << 8 | data[i + 1], 2
            value = data[i + 2 : i + 2 + n]
        elif b == 0xF0:
            n, head = int.from_bytes(data[i + 1 : i + 5], "little"), 5
            value = data[i + 5 : i + 5 + n]
        elif b <= 0xF4:
            n = (2, 3, 4, 8)[b - 0xF1]
            value = _int(data[i + 1 : i + 1 + n])
        else:
            raise ValueError(f"listpack code {b:#x}")
        out.append(value)
        size = head + n
        i += size + next(k for k in range(1, 6) if size < 1 << 7 * k or k == 5)
    return out


def ziplist(data: bytes) -> list[bytes]:
    out, i = [], 10
    while data[i] != 0xFF:
        i += 5 if data[i] == 0xFE else 1
        b = data[i]
        i += 1
        if b < 0xC0:
            if b < 0x40:
                n = b
            elif b < 0x80:
                n = (b & 63) << 8 | data[i]
                i += 1
            else:
                n = int.from_bytes(data[i : i + 4], "big")
                i += 4
            out.append(data[i : i + n])
            i += n
        elif 0xF1 <= b <= 0xFD:
            out.append(str(b - 0xF1).encode())
        else:
            n = {0xC0: 2, 0xD0: 4, 0xE0: 8, 0xF0: 3, 0xFE: 1}.get(b)
            if n is None:
                raise ValueError(f"ziplist code {b:#x}")
            out.append(_int(data[i : i + n]))
            i += n
    return out


def intset(data: bytes) -> list[bytes]:
    width, n = struct.unpack_from("<II", data)
    return [_int(data[8 + k * width : 8 + (k + 1) * width]) for k in range(n)]


def _pairs(flat: list) -> list[tuple]:
    return list(zip(flat[::2], flat[1::2], strict=False))  # an odd last element has no partner


def _score(text: bytes) -> float:
    try:
        return float(text)
    except ValueError:
        return 0.0


def _old_score(src: Bytes) -> float:
    n = src.take(1)[0]
    return {253: float("nan"), 254: float("inf"), 255: float("-inf")}[n] if n > 252 else _score(src.take(n))


def _stream(src: Bytes, enc: int) -> list[tuple[int, int, list[tuple[bytes, bytes]]]]:
    """Entries (ms, no, fields) of a log; its consumer groups are read over."""
    out = []
    for _ in range(src.uint()):
        ms, no = struct.unpack(">QQ", src.string())
        words = iter(listpack(src.string()))
        number = lambda w=words: int(next(w))
        left = number() + number()  # live and deleted entries
        names = [next(words) for _ in range(number())]
        number()
        for _ in range(left):
            flags, dms, dno = number(), number(), number()
            if flags & 2:
                fields = [(name, next(words)) for name in names]
            else:
                fields = [(next(words), next(words)) for _ in range(number())]
            number()
            if not flags & 1:
                out.append((ms + dms, no + dno, fields))
    for _ in range(3 if enc == 15 else 8):  # length and last id; later layouts: first id, greatest deleted id, entries ever
        src.uint()
    for _ in range(src.uint()):
        src.string()
        for _ in range(2 if enc == 15 else 3):
            src.uint()
        for _ in range(src.uint()):
            src.take(24)
            src.uint()
        for _ in range(src.uint()):
            src.string()
            src.take(16 if enc == 21 else 8)
            src.take(16 * src.uint())
    return out


def value(src: Bytes, enc: int) -> tuple[str, object]:
    """(type, payload) of a record: bytes, a list of bytes, of pairs, of (member, score), or of stream entries."""
    if enc == 0:
        return "string", src.string()
    if enc in (1, 2):
        return ("list", "set")[enc - 1], [src.string() for _ in range(src.uint())]
    if enc in (3, 5):
        return "zset", [(src.string(), src.number("<d") if enc == 5 else _old_score(src)) for _ in range(src.uint())]
    if enc == 4:
        return "hash", [(src.string(), src.string()) for _ in range(src.uint())]
    if enc == 10:
        return "list", ziplist(src.string())
    if enc == 11:
        return "set", intset(src.string())
    if enc == 20:
        return "set", listpack(src.string())
    if enc in (12, 17):
        return "zset", [(m, _score(s)) for m, s in _pairs((ziplist if enc == 12 else listpack)(src.string()))]
    if enc in (13, 16):
        return "hash", _pairs((ziplist if enc == 13 else listpack)(src.string()))
    if enc == 14:
        return "list", [x for _ in range(src.uint()) for x in ziplist(src.string())]
    if enc == 18:
        out: list[bytes] = []
        for _ in range(src.uint()):
            plain = src.uint() == 1
            node = src.string()
            out += [node] if plain else listpack(node)
        return "list", out
    if enc in (15, 19, 21):
        return "stream", _stream(src, enc)
    raise ValueError(f"value code {enc}")


def journal(file) -> Iterator[dict]:
    """Change records of a stream, in order; a SELECT sets the db of those after it."""
    import io

    src = Bytes(file if hasattr(file, "read") else io.BytesIO(file))
    db = seq = 0
    while (code := src.code()) is not None:
        if code == J_SELECT:
            db = src.uint()
            continue
        if code not in J_NAMES:
            raise ValueError(f"journal code {code}")
        row = {"seq": seq, "opcode": J_NAMES[code], "db": db, "txid": None, "shard_cnt": None, "lsn": None, "cmd": None, "args": None}
        if code == J_LSN:
            row["lsn"] = src.uint()
        elif code != J_PING:
            row["txid"], row["shard_cnt"] = src.uint(), src.uint()
            if n := src.uint():
                src.uint()  # the size of the whole command
                words = [src.take(src.uint()).decode("utf-8", "replace") for _ in range(n)]
                row["cmd"], row["args"] = words[0], words[1:]
        yield row
        seq += 1


def snapshot(file) -> Iterator[tuple[str, dict]]:
    """("record", ...) for each key and ("journal", ...) for each inline change, in stream order."""
    import io

    import zstandard

    outer = Bytes(file)
    if outer.take(5) != b"REDIS" or not outer.take(4).isdigit():
        raise ValueError("not a snapshot")
    db, expire, stack = 0, 0, [outer]
    while stack:
        src = stack[-1]
        code = src.code()
        if code is None or code == BLOCK_END and len(stack) > 1:
            stack.pop()
        elif code == END:
            return
        elif code == AUX:
            src.string(), src.string()
        elif code == SELECT:
            db = src.uint()
        elif code == RESIZE:
            src.uint(), src.uint()
        elif code == EXPIRE_S:
            expire = src.number("<i") * 1000
        elif code == EXPIRE_MS:
            expire = src.number("<q")
        elif code in (SYNC_END, OFFSET):
            src.take(8)
        elif code == IDLE:
            src.uint()
        elif code == FREQ:
            src.take(1)
        elif code == ZSTD:
            stack.append(Bytes(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(src.string()))))
        elif code == LZ4:
            raise ValueError("LZ4 blocks need a decoder that isn't installed")
        elif code == JOURNAL:
            src.uint()
            for row in journal(src.string()):
                yield "journal", row
        else:
            key = src.string()
            kind, payload = value(src, code)
            yield "record", {"db": db, "key": key, "enc": code, "type": kind, "expire_ms": expire, "value": payload}
            expire = 0
