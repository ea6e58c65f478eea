"""Hash slots as built-in expressions: CRC16 (XMODEM) of a key's hash tag, modulo 16384."""

from __future__ import annotations

from pyspark.sql import functions as F

SLOTS = 16384


def crc_table() -> list[int]:
    """CRC16 of each single byte, by the polynomial x^16 + x^12 + x^5 + 1."""
    out = []
    for byte in range(256):
        crc = byte << 8
        for _ in range(8):
            crc = (crc << 1) ^ 0x1021 if crc & 0x8000 else crc << 1
        out.append(crc & 0xFFFF)
    return out


def hash_tag(key):
    """What stands between the first ``{`` and the next ``}``, if that isn't empty, else the key."""
    tag = F.regexp_extract(key, r"^[^{]*\{([^}]+)\}", 1)
    return F.when(tag != "", tag).otherwise(key)


def crc16(text):
    table = F.array(*[F.lit(x) for x in crc_table()])
    # One character for each byte; the text is an argument, not part of the lambda, so it is evaluated once a row.
    codes = F.transform(F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), ""), F.ascii)
    step = lambda c, b: F.shiftleft(c, 8).bitwiseAND(65535).bitwiseXOR(F.get(table, F.shiftright(c, 8).bitwiseXOR(b).bitwiseAND(255)))
    return F.aggregate(codes, F.lit(0), step)


def slot(key):
    return (crc16(hash_tag(key)) % SLOTS).cast("long")
