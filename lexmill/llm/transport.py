"""Media columns: MPEG transport streams (ISO/IEC 13818-1) as binary columns.

``mux`` stores bytes as one private-data elementary stream: a program association table, a program map table and
elementary packets with a presentation time stamp each, cut into 188-byte transport packets. The first packet of every
elementary packet carries a clock reference and the random-access flag. ``demux`` reads any such stream: it parses the
program tables (checking their CRC), follows each packet identifier, checks continuity counters, reassembles elementary
packets and keeps their time stamps and random-access points.

The stream depends on the payload alone, so equal texts have equal media. Nothing is kept beyond one text at a time,
and a text may be as long as a value can be.

Null and empty texts are 64 zero bytes; null media have null features. Repeated rows are each stored, ties do not arise, extra
columns may have any name, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Packet size, sync byte, identifiers, stream kinds and the CRC polynomial of the format.
PACKET = 188
SYNC = 0x47
PAT_PID = 0x0000
PMT_PID = 0x0100
DATA_PID = 0x0101
NULL_PID = 0x1FFF
PRIVATE_DATA = 0x06
PRIVATE_STREAM_1 = 0xBD
CRC_POLYNOMIAL = 0x04C11DB7
CLOCK = 90_000

FIRST_HEAD, PES_HEAD, NEXT_HEAD = 4 + 8, 14, 4
FIRST_ROOM, NEXT_ROOM = PACKET - FIRST_HEAD - PES_HEAD, PACKET - NEXT_HEAD
FULL_PACKETS = 88
FULL_PES = FIRST_ROOM + (FULL_PACKETS - 1) * NEXT_ROOM
TICKS = 3_600
BLOCK = 64


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = ((c << 1) ^ CRC_POLYNOMIAL if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        table.append(c)
    return table


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | (5 + len(body) + 4)).to_bytes(2, "big") + number.to_bytes(2, "big") + bytes([0xC1, 0, 0])
    return head + body + section_crc(head + body).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section).ljust(PACKET, b"\xff")


_TABLES = _table_packet(PAT_PID, _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))) + _table_packet(
    PMT_PID, _section(2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")
)


def _pts_bytes(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, 0x01 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 0x01 | pts << 1 & 0xFE])


def _pes_head(n: int, pts: int) -> bytes:
    return b"\x00\x00\x01" + bytes([PRIVATE_STREAM_1]) + (n + PES_HEAD - 6).to_bytes(2, "big") + b"\x84\x80\x05" + _pts_bytes(pts)


def _clock_field(length: int, pts: int) -> bytes:
    base = pts & (1 << 33) - 1
    return (bytes([length, 0x50]) + ((base << 15) | 0x7E00).to_bytes(6, "big")).ljust(length + 1, b"\xff")


def mux(payload: bytes) -> bytes:
    """The transport stream that holds ``payload``, which must not be empty."""
    whole, rest = divmod(len(payload), FULL_PES)
    data = np.frombuffer(payload, np.uint8)
    out = [np.frombuffer(_TABLES, np.uint8)]
    count = 0
    if whole:
        packets = np.empty((whole, FULL_PACKETS, PACKET), np.uint8)
        units = data[: whole * FULL_PES].reshape(whole, FULL_PES)
        packets[:, :, 0], packets[:, :, 1], packets[:, :, 2] = SYNC, DATA_PID >> 8, DATA_PID & 255
        packets[:, :, 3] = 0x10 | (np.arange(whole * FULL_PACKETS) & 15).reshape(whole, FULL_PACKETS)
        packets[:, 0, 1] |= 0x40
        packets[:, 0, 3] |= 0x20
        for k in range(whole):
            packets[k, 0, 4 : FIRST_HEAD + PES_HEAD] = np.frombuffer(_clock_field(7, k * TICKS) + _pes_head(FULL_PES, k * TICKS), np.uint8)
        packets[:, 0, FIRST_HEAD + PES_HEAD :] = units[:, :FIRST_ROOM]
        packets[:, 1:, NEXT_HEAD:] = units[:, FIRST_ROOM:].reshape(whole, FULL_PACKETS - 1, NEXT_ROOM)
        out.append(packets.reshape(-1))
        count = whole * FULL_PACKETS
    if rest:
        tail, pts, made = payload[whole * FULL_PES :], whole * TICKS, bytearray()
        first = tail[: min(rest, FIRST_ROOM)]
        made += bytes([SYNC, 0x40 | DATA_PID >> 8, DATA_PID & 255, 0x30 | count & 15]) + _clock_field(7 + FIRST_ROOM - len(first), pts) + _pes_head(rest, pts) + first
        at = len(first)
        while at < rest:
            count += 1
            part = tail[at : at + NEXT_ROOM]
            at += len(part)
            spare = NEXT_ROOM - len(part)
            made += bytes([SYNC, DATA_PID >> 8, DATA_PID & 255, (0x30 if spare else 0x10) | count & 15])
            if spare:
                made += (bytes([spare - 1]) + (b"\x00" if spare > 1 else b"")).ljust(spare, b"\xff")
            made += part
        out.append(np.frombuffer(bytes(made), np.uint8))
    return np.concatenate(out).tobytes()


@dataclass
class Stream:
    """What ``demux`` finds for one elementary stream."""

    pid: int
    kind: int
    payload: bytes = b""
    time_stamps: list[int | None] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    random_access: list[int] = field(default_factory=list)
    continuity_errors: int = 0


@dataclass
class Demuxed:
    packets: int = 0
    sync_errors: int = 0
    table_errors: int = 0
    programs: dict[int, int] = field(default_factory=dict)
    streams: dict[int, Stream] = field(default_factory=dict)


def _sections(packets: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Sections of one table's packets: from each pointer field on, running over into the packets that follow."""
    out, held = [], b""
    for p, s in zip(packets, starts.tolist(), strict=True):
        raw = p[s:].tobytes()
        if p[1] & 0x40:
            pointer = raw[0] if raw else 0
            held = (held + raw[1 : 1 + pointer] if held else b"")
            out += _split(held)[0]
            held = raw[1 + pointer :]
        elif held:
            held += raw
        done, held = _split(held)
        out += done
    return out


def _split(held: bytes) -> tuple[list[bytes], bytes]:
    done = []
    while len(held) >= 3 and held[0] != 0xFF:
        n = 3 + (int.from_bytes(held[1:3], "big") & 0x0FFF)
        if len(held) < n:
            return done, held
        done.append(held[:n])
        held = held[n:]
    return done, b"" if held[:1] == b"\xff" else held


def demux(media: bytes) -> Demuxed:
    """Parse a transport stream. Damaged packets and tables are counted, not raised; a trailing part of a packet is a sync error."""
    out = Demuxed()
    n, part = divmod(len(media), PACKET)
    out.sync_errors = int(part > 0)
    packets = np.frombuffer(media, np.uint8, n * PACKET).reshape(n, PACKET)
    good = packets[:, 0] == SYNC
    out.sync_errors += int(n - good.sum())
    packets = packets[good & (packets[:, 1] < 0x80)] if n else packets
    out.packets = n
    pids = ((packets[:, 1].astype(np.int32) & 0x1F) << 8) | packets[:, 2]
    has_field, has_payload = (packets[:, 3] & 0x20) > 0, (packets[:, 3] & 0x10) > 0
    starts = np.where(has_field, 5 + packets[:, 4].astype(np.int32), 4)
    starts = np.where(has_payload, np.minimum(starts, PACKET), PACKET)

    def good_sections(pid: int) -> list[bytes]:
        own = pids == pid
        found = _sections(packets[own], starts[own])
        fine = [s for s in found if len(s) >= 12 and section_crc(s) == 0]
        out.table_errors += len(found) - len(fine)
        return fine

    for s in good_sections(PAT_PID):
        for k in range(8, len(s) - 4, 4):
            if number := int.from_bytes(s[k : k + 2], "big"):
                out.programs[number] = int.from_bytes(s[k + 2 : k + 4], "big") & 0x1FFF
    for pid in dict.fromkeys(out.programs.values()):
        for s in good_sections(pid):
            k = 12 + (int.from_bytes(s[10:12], "big") & 0x0FFF)
            while k + 5 <= len(s) - 4:
                own = int.from_bytes(s[k + 1 : k + 3], "big") & 0x1FFF
                out.streams.setdefault(own, Stream(own, s[k]))
                k += 5 + (int.from_bytes(s[k + 3 : k + 5], "big") & 0x0FFF)
    for stream in out.streams.values():
        own = np.flatnonzero(pids == stream.pid)
        if len(own):
            _reassemble(stream, packets[own], starts[own], has_field[own], has_payload[own])
    return out


def _reassemble(stream: Stream, packets: np.ndarray, starts: np.ndarray, has_field: np.ndarray, has_payload: np.ndarray) -> None:
    counters = packets[:, 3].astype(np.int32) & 15
    flagged = np.where(has_field & (packets[:, 4] > 0), packets[:, 5], 0)
    step = (counters[1:] - counters[:-1]) & 15
    # A packet without payload keeps the counter; one repeat of a packet is allowed and is dropped.
    repeat = (step == 0) & has_payload[1:] & has_payload[:-1] & (packets[1:, 6:] == packets[:-1, 6:]).all(axis=1)
    expected = has_payload[1:].astype(np.int32)
    stream.continuity_errors = int(((step != expected) & ~repeat & ((flagged[1:] & 0x80) == 0)).sum())
    keep = np.concatenate([[True], ~repeat])
    packets, starts, flagged = packets[keep], starts[keep], flagged[keep]
    lengths = PACKET - starts
    places = np.concatenate([[0], np.cumsum(lengths)])
    raw = packets[np.arange(PACKET)[None, :] >= starts[:, None]].tobytes()
    heads = np.flatnonzero(packets[:, 1] & 0x40)
    parts, at = [], 0
    for i, h in enumerate(heads.tolist()):
        lo, hi = int(places[h]), int(places[heads[i + 1]]) if i + 1 < len(heads) else len(raw)
        unit = raw[lo:hi]
        if len(unit) < 9 or unit[:3] != b"\x00\x00\x01":
            stream.continuity_errors += 1
            continue
        pts = None
        if unit[7] & 0x80 and len(unit) >= 14:
            pts = (unit[9] & 0x0E) << 29 | unit[10] << 22 | (unit[11] & 0xFE) << 14 | unit[12] << 7 | unit[13] >> 1
        declared = int.from_bytes(unit[4:6], "big")
        body = unit[9 + unit[8] : 6 + declared if declared else len(unit)]
        stream.time_stamps.append(pts)
        stream.starts.append(at)
        if flagged[h] & 0x40:
            stream.random_access.append(at)
        parts.append(body)
        at += len(body)
    stream.payload = b"".join(parts)


def padded(text: str | None) -> bytes:
    """UTF-8 of the text with bytes 0 up to a positive multiple of 64."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % BLOCK if raw else BLOCK)


@F.pandas_udf(T.BinaryType())
def media_column(texts: pd.Series) -> pd.Series:
    """A transport stream for each text; null counts as empty."""
    return pd.Series([mux(padded(t)) for t in texts], dtype=object)


_LONG, _TEXT = T.LongType(), T.StringType()
FEATURES = T.StructType([
    T.StructField(name, kind)
    for kind, names in (
        (_LONG, "payload_bytes tail_crc32 media_bytes units first_pts last_pts continuity_errors sync_errors table_errors"),
        (_TEXT, "payload_sha256 media_sha256 feature"),
        (T.ArrayType(_LONG), "random_access"),
    )
    for name in names.split()
])


@F.pandas_udf(FEATURES)
def media_features(media: pd.Series) -> pd.DataFrame:
    """What the stored streams hold, read back from their bytes; null media give nulls."""
    rows = []
    for m in media:
        if m is None:
            rows.append((None,) * 13)
            continue
        found = demux(m)
        s = next(iter(found.streams.values()), Stream(0, 0))
        counts = np.bincount(np.frombuffer(s.payload, np.uint8) >> 4, minlength=16) if s.payload else np.zeros(16, int)
        stamps = [t for t in s.time_stamps if t is not None]
        first, last = (stamps[0], stamps[-1]) if stamps else (None, None)
        feature = f"programs={len(found.programs)};pid={s.pid};type={s.kind};packets={found.packets};units={len(s.starts)};pts={first}-{last};rap={','.join(map(str, s.random_access))};cc={s.continuity_errors};histogram={','.join(map(str, counts.tolist()))}"
        rows.append((len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-BLOCK:]), len(m), hashlib.sha256(m).hexdigest(), len(s.starts), first, last, s.random_access, s.continuity_errors, found.sync_errors, found.table_errors, feature))
    return pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "units", "first_pts", "last_pts", "random_access", "continuity_errors", "sync_errors", "table_errors", "feature"])


def with_media(docs: DataFrame, text: str | Column = "text", name: str = "media") -> DataFrame:
    """``docs`` with a binary column of streams."""
    return docs.withColumn(name, media_column(F.col(text) if isinstance(text, str) else text))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes and the features of its stored stream, which itself is not returned.

    Null and empty texts are 64 zero bytes. Repeated rows are each stored. An empty table gives an empty result.
    """
    stored = with_media(docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")), "_text", "_media")
    read = stored.select("_key", F.octet_length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_bytes"), media_features("_media").alias("f"))
    return read.select(F.col("_key").alias(key), "n_bytes", "f.payload_bytes", "f.payload_sha256", "f.tail_crc32", "f.media_bytes", "f.media_sha256", "f.feature", "f.units", "f.continuity_errors", F.size("f.random_access").alias("n_random_access"))
