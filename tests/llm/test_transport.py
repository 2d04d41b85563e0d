import hashlib
import random
import zlib

import pytest

from lexmill.llm import transport as ts

TEXTS = ["", None, "short", "x" * 64, "y" * 65, "é" * 100, "long text " * 5000, "a\0b", "short"]


@pytest.mark.parametrize("n", [1, 64, 162, 163, 346, 347, ts.FULL_PES - 1, ts.FULL_PES, ts.FULL_PES + 1, 3 * ts.FULL_PES, 100_003])
def test_round_trip(n):
    payload = random.Random(n).randbytes(n)
    media = ts.mux(payload)
    found = ts.demux(media)
    s = found.streams[ts.DATA_PID]
    assert len(media) % 188 == 0 and s.payload == payload and not (s.continuity_errors or found.sync_errors or found.table_errors) and found.programs == {1: ts.PMT_PID}
    units = -(-n // ts.FULL_PES)
    assert s.time_stamps == [k * ts.TICKS for k in range(units)] and s.random_access == s.starts == [k * ts.FULL_PES for k in range(units)]


def test_time_stamps_use_33_bits():
    for pts in (0, 1, 1 << 15, (1 << 30) + 5, (1 << 33) - 1):
        b = ts._pts_bytes(pts)
        assert (b[0] & 0x0E) << 29 | b[1] << 22 | (b[2] & 0xFE) << 14 | b[3] << 7 | b[4] >> 1 == pts


def test_damage_is_counted():
    media = bytearray(ts.mux(random.Random(1).randbytes(5000)))
    lost = bytes(media[: 188 * 5] + media[188 * 6 :])
    assert ts.demux(lost).streams[ts.DATA_PID].continuity_errors == 1
    repeated = bytes(media[: 188 * 6] + media[188 * 5 : 188 * 6] + media[188 * 6 :])
    assert ts.demux(repeated).streams[ts.DATA_PID].payload == ts.demux(bytes(media)).streams[ts.DATA_PID].payload
    bad_table = bytes(media[:10]) + bytes([media[10] ^ 1]) + bytes(media[11:])
    assert ts.demux(bad_table).table_errors == 1 and not ts.demux(bad_table).streams
    assert ts.demux(bytes(media) + b"\x47\x00").sync_errors == 1
    assert ts.demux(bytes(188) + bytes(media)).sync_errors == 1
    assert ts.demux(b"").packets == 0


def test_other_streams_between_are_ignored():
    payload = b"z" * 1000
    media = ts.mux(payload)
    null = bytes([0x47, 0x1F, 0xFF, 0x10]) + bytes(184)
    mixed = b"".join(media[k : k + 188] + null for k in range(0, len(media), 188))
    found = ts.demux(mixed)
    assert found.streams[ts.DATA_PID].payload == payload and found.streams[ts.DATA_PID].continuity_errors == 0


def test_digest(docs_of):
    rows = {r["doc_id"]: r for r in ts.digest(docs_of(TEXTS)).collect()}
    for k, t in enumerate(TEXTS):
        raw = (t or "").encode()
        want = raw + bytes(-len(raw) % 64 if raw else 64)
        r = rows[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        media = ts.mux(want)
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest()) and r["continuity_errors"] == 0
    assert rows[2]["feature"] == rows[8]["feature"] and rows[0]["media_sha256"] == rows[1]["media_sha256"] and ts.digest(docs_of([])).count() == 0


def read_plainly(media):
    """The one elementary stream of a transport stream, packet by packet: payload, stamps, places of units and of access points, packets."""
    packets = [media[k : k + 188] for k in range(0, len(media), 188)]
    after = lambda p: p[4 + (1 + p[4] if p[3] & 0x20 else 0) :] if p[3] & 0x10 else b""
    of = lambda pid: [p for p in packets if int.from_bytes(p[1:3], "big") & 0x1FFF == pid]
    pat = after(of(0)[0])[1:]
    pmt_pid = int.from_bytes(pat[10:12], "big") & 0x1FFF
    pmt = after(of(pmt_pid)[0])[1:]
    kind, pid = pmt[12], int.from_bytes(pmt[13:15], "big") & 0x1FFF
    payload, stamps, access, unit = b"", [], [], b""
    for n, p in enumerate(of(pid)):
        assert p[0] == 0x47 and p[3] & 15 == n % 16
        if p[1] & 0x40:
            payload, unit = payload + unit, b""
            head = after(p)
            assert head[:4] == b"\0\0\1\xbd"
            bits = "".join(f"{b:08b}" for b in head[9:14])
            stamps.append(int(bits[4:7] + bits[8:23] + bits[24:39], 2))
            if p[3] & 0x20 and p[5] & 0x40:
                access.append(len(payload))
            unit = head[9 + head[8] :]
        else:
            unit += after(p)
    return payload + unit, kind, pid, stamps, access, len(packets)


@pytest.mark.parametrize("text", ["", "short", "é" * 100, "long text " * 5000, "z" * (2 * ts.FULL_PES)])
def test_feature_and_media_are_those_of_a_plain_reader(docs_of, text):
    media = ts.with_media(docs_of([text])).first()["media"]
    payload, kind, pid, stamps, access, packets = read_plainly(bytes(media))
    raw = text.encode()
    assert payload == raw + bytes(-len(raw) % 64 if raw else 64)
    histogram = ",".join(str(sum(b >> 4 == k for b in payload)) for k in range(16))
    r = ts.digest(docs_of([text])).first()
    assert r["feature"] == f"programs=1;pid={pid};type={kind};packets={packets};units={len(stamps)};pts={stamps[0]}-{stamps[-1]};rap={','.join(map(str, access))};cc=0;histogram={histogram}"
    assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(bytes(media)).hexdigest()) and r["n_random_access"] == len(access) == len(stamps)


def test_repeated_and_null_keys_and_clashing_columns(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of(["a", "a", "b"]).withColumns({"doc_id": F.when(F.col("doc_id") < 2, F.lit(None)).otherwise(7).cast("long"), "f": F.lit("x"), "_media": F.lit("x")})
    rows = ts.digest(docs).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["7", "None", "None"] and len({r["media_sha256"] for r in rows}) == 2
