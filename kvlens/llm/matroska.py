"""Matroska: a parser to packet tables, and a writer for lossless 8-bit samples.

EBML elements have identifiers and sizes of 1 to 8 bytes, the count of leading
zero bits telling which; a size of all ones is unknown and ends where an element
of the same or a higher level begins. The parser walks segments, clusters, block
groups and simple blocks, undoes Xiph, EBML and fixed lacing, and gives one row
for each packet with its track, timestamp, flags and byte range in the file, and
the cues with the packets that they point to.

Defined cases: null media have no packets; a file that breaks off gives the
whole packets before the break; null texts are stored as empty ones, and each
text is stored as its UTF-8 bytes, zeros added up to a positive multiple of 64.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import pieces, with_columns

# Identifiers of elements in the Matroska specification.
EBML, VERSION, READ_VERSION, MAX_ID, MAX_SIZE, DOCTYPE, DOCTYPE_VERSION, DOCTYPE_READ = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, MUXER, WRITER, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741, 0x4489
TRACKS, TRACK, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, LACING, AUDIO, RATE, CHANNELS, DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUES, CUE, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER, CUE_RELATIVE = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1, 0xF0
TOP = {SEGMENT, EBML}
LEVEL1 = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469}

#: Samples a second, and bytes of a packet, packets of a block and blocks of a cluster that the writer makes.
SAMPLE_RATE, PACKET, LACED, BLOCKS = 8000, 512, 8, 8


def read_vint(data, at: int, keep_marker: bool = False) -> tuple[int, int, bool]:
    """(value, next position, all ones) of a variable-length number."""
    first = data[at]
    if not first:
        raise ValueError("number of more than 8 bytes")
    size = 9 - first.bit_length()
    if at + size > len(data):
        raise IndexError
    value = int.from_bytes(data[at : at + size], "big")
    plain = value & ((1 << 7 * size) - 1)
    return value if keep_marker else plain, at + size, plain == (1 << 7 * size) - 1


def vint(x: int, size: int = 0) -> bytes:
    """x as a size of as few bytes as hold it (or ``size``)."""
    size = size or max(1, -(-(x + 1).bit_length() // 7))
    return (x | 1 << 7 * size).to_bytes(size, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(ident: int, x: int) -> bytes:
    return element(ident, x.to_bytes(max(1, (x.bit_length() + 7) // 8), "big"))


def children(data, at: int, end: int, level: int) -> Iterator[tuple[int, int, int, int]]:
    """(identifier, element's position, body's start, body's end) in a range; stops where the bytes break off.

    A body of unknown size goes up to the next element of its own level or a higher one.
    """
    while at < end:
        begin = at
        try:
            ident, at, _ = read_vint(data, at, True)
            size, at, unknown = read_vint(data, at)
        except (IndexError, ValueError):
            return
        if unknown:
            stop, outer = at, TOP if level == 0 else TOP | LEVEL1
            while stop < end:
                try:
                    inner, p, _ = read_vint(data, stop, True)
                    n, p, more = read_vint(data, p)
                except (IndexError, ValueError):
                    break
                if inner in outer:
                    break
                stop = p if more else min(p + n, end)
        else:
            stop = at + size
            if stop > end:
                yield ident, begin, at, end
                return
        yield ident, begin, at, stop
        at = stop


def laces(data, at: int, end: int, flags: int) -> list[tuple[int, int]]:
    """(position, size) of a block's frames."""
    kind = flags >> 1 & 3
    if not kind:
        return [(at, end - at)]
    count = data[at] + 1
    at += 1
    if kind == 2:
        sizes = [(end - at) // count] * count
        return [(at + i * n, n) for i, n in enumerate(sizes)]
    sizes = []
    if kind == 1:
        for _ in range(count - 1):
            n = 0
            while data[at] == 255:
                n += 255
                at += 1
            sizes.append(n + data[at])
            at += 1
    else:
        for i in range(count - 1):
            begin = at
            x, at, _ = read_vint(data, at)
            sizes.append(x if not i else sizes[-1] + x - (1 << 7 * (at - begin) - 1) + 1)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laces longer than their block")
    out = []
    for n in sizes:
        out.append((at, n))
        at += n
    return out


def number(data, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def parse(data: bytes) -> dict:
    """tracks {number: (codec, rate, default)}, packets and cues of a file.

    A packet: (track, timestamp in ns, position, size, keyframe, lace, cluster). A cue: (time in ns, track, cluster's position).
    """
    out: dict = {"scale": 1_000_000, "duration": 0.0, "tracks": {}, "packets": [], "cues": [], "clusters": 0}
    for ident, _, a, b in children(data, 0, len(data), 0):
        if ident == SEGMENT:
            _segment(data, a, b, out)
    return out


def _segment(data, a: int, b: int, out: dict) -> None:
    for ident, begin, s, e in children(data, a, b, 1):
        if ident == INFO:
            for k, _, x, y in children(data, s, e, 2):
                if k == TIMESTAMP_SCALE:
                    out["scale"] = number(data, x, y)
                elif k == DURATION:
                    out["duration"] = struct.unpack(">d" if y - x == 8 else ">f", data[x:y])[0]
        elif ident == TRACKS:
            for k, _, x, y in children(data, s, e, 2):
                if k == TRACK:
                    t = {i: data[p:q] for i, _, p, q in children(data, x, y, 3)}
                    audio = {i: data[p:q] for i, _, p, q in children(t[AUDIO], 0, len(t[AUDIO]), 4)} if AUDIO in t else {}
                    rate = struct.unpack(">d" if len(audio[RATE]) == 8 else ">f", audio[RATE])[0] if RATE in audio else 0.0
                    out["tracks"][int.from_bytes(t.get(TRACK_NUMBER, b""), "big")] = (t.get(CODEC, b"").decode("ascii", "replace"), rate)
        elif ident == CLUSTER:
            time, no = 0, out["clusters"]
            out["clusters"] += 1
            for k, _, x, y in children(data, s, e, 2):
                if k == CLUSTER_TIME:
                    time = number(data, x, y)
                elif k == SIMPLE_BLOCK:
                    _block(data, x, y, time, None, no, out)
                elif k == BLOCK_GROUP:
                    inner = [(i, p, q) for i, _, p, q in children(data, x, y, 3)]
                    key = all(i != REFERENCE for i, _, _ in inner)
                    for i, p, q in inner:
                        if i == BLOCK:
                            _block(data, p, q, time, key, no, out)
        elif ident == CUES:
            for k, _, x, y in children(data, s, e, 2):
                if k == CUE:
                    time, where = 0, []
                    for i, _, p, q in children(data, x, y, 3):
                        if i == CUE_TIME:
                            time = number(data, p, q)
                        elif i == CUE_POSITIONS:
                            c = {j: number(data, u, v) for j, _, u, v in children(data, p, q, 4)}
                            where.append((c.get(CUE_TRACK, 0), a + c.get(CUE_CLUSTER, 0)))
                    out["cues"] += [(time * out["scale"], t, w) for t, w in where]


def _block(data, a: int, b: int, time: int, key: bool | None, cluster: int, out: dict) -> None:
    try:
        track, at, _ = read_vint(data, a)
        rel, flags = struct.unpack_from(">hB", data, at)
        frames = laces(data, at + 3, b, flags)
    except (IndexError, ValueError, struct.error):
        return
    stamp = (time + rel) * out["scale"]
    out["packets"] += [(track, stamp, p, n, bool(flags & 0x80) if key is None else key, i, cluster) for i, (p, n) in enumerate(frames)]


def mux(samples: bytes) -> bytes:
    """8-bit samples as a Matroska file: blocks of EBML-laced packets in clusters, a cue for each cluster."""
    head = element(EBML, uint(VERSION, 1) + uint(READ_VERSION, 1) + uint(MAX_ID, 4) + uint(MAX_SIZE, 8) + element(DOCTYPE, b"matroska") + uint(DOCTYPE_VERSION, 4) + uint(DOCTYPE_READ, 2))
    info = element(INFO, uint(TIMESTAMP_SCALE, 125_000) + element(DURATION, struct.pack(">d", len(samples))) + element(MUXER, b"kvlens") + element(WRITER, b"kvlens"))
    audio = element(AUDIO, element(RATE, struct.pack(">d", SAMPLE_RATE)) + uint(CHANNELS, 1) + uint(DEPTH, 8))
    tracks = element(TRACKS, element(TRACK, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(LACING, 1) + element(CODEC, b"A_PCM/INT/LIT") + audio))
    body, cues, at = [info, tracks], [], len(info) + len(tracks)
    block, cluster = PACKET * LACED, PACKET * LACED * BLOCKS
    for c in range(0, len(samples), cluster):
        parts = [uint(CLUSTER_TIME, c)]
        for b in range(c, min(c + cluster, len(samples)), block):
            data = samples[b : b + block]
            # A timestamp unit is a sample: a cluster is shorter than a block's 15 bits hold.
            sizes = [min(PACKET, len(data) - i) for i in range(0, len(data), PACKET)]
            lead = b"\x81" + struct.pack(">h", b - c)
            if len(sizes) == 1:
                parts.append(element(SIMPLE_BLOCK, lead + b"\x80" + data))
            else:
                # EBML lacing: the first size, then differences (here 0), biased to be unsigned.
                laced = bytes([len(sizes) - 1]) + vint(sizes[0]) + b"\xbf" * (len(sizes) - 2)
                parts.append(element(SIMPLE_BLOCK, lead + b"\x86" + laced + data))
        done = element(CLUSTER, b"".join(parts))
        cues.append(element(CUE, uint(CUE_TIME, c) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at))))
        body.append(done)
        at += len(done)
    return head + element(SEGMENT, b"".join([*body, element(CUES, b"".join(cues))]))


def payload(text: str) -> tuple[bytes, int]:
    """UTF-8 with zeros up to a positive multiple of 64, and its length without them."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + bytes(64 - len(raw) if not raw else -len(raw) % 64), len(raw)


def samples_of(data: bytes, found: dict, track: int = 1) -> bytes:
    return b"".join([data[p : p + n] for t, _, p, n, *_ in found["packets"] if t == track])


def features(found: dict) -> str:
    """Counts of tracks, clusters, cues and packets, keyframes, the largest packet and the last timestamp (ns)."""
    p = found["packets"]
    return f"tracks={len(found['tracks'])};clusters={found['clusters']};cues={len(found['cues'])};packets={len(p)};keyframes={sum(x[4] for x in p)};largest={max((x[3] for x in p), default=0)};last_ns={max((x[1] for x in p), default=0)}"


PACKETS = "track long, timestamp_ns long, position long, size long, keyframe boolean, lace int, cluster int"


def store(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df's ``keep`` columns with ``media``: each text as a Matroska file."""
    return with_columns(df, text, [T.StructField("media", T.BinaryType())], lambda: lambda rows: [pa.array([mux(payload(t)[0]) for t in rows], pa.binary())], keep)


def packets(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """The packet table: ``keep`` columns of the media's row and one row per packet, batch by batch."""
    kept = [c for c in df.columns if c != media] if keep is None else keep
    source = df.select(*[df[c] for c in kept], df[media].alias("media"))
    schema = T.StructType([*[source.schema[c] for c in kept], *T._parse_datatype_string(PACKETS).fields])
    kinds = [pa.int64()] * 4 + [pa.bool_(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "media"):
            rows, take = [], []
            for i, data in enumerate(piece["media"].to_pylist()):
                got = parse(data)["packets"] if data else []
                rows += got
                take += [i] * len(got)
            at = pa.array(take, pa.int32())
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([*[piece[c].take(at) for c in kept], *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]], names=schema.names)

    return source.mapInArrow(run, schema)


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    names = {"n_bytes": T.LongType(), "payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(), "media_bytes": T.LongType(), "media_sha256": T.StringType(), "feature": T.StringType()}

    def make():
        def one(text: str) -> tuple:
            stored, n = payload(text)
            media = mux(stored)
            found = parse(media)
            back = samples_of(media, found)
            return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), features(found)

        return lambda rows: [list(x) for x in zip(*map(one, rows), strict=True)]

    return with_columns(docs, "text", [T.StructField(n, k) for n, k in names.items()], make, ["doc_id"])

