"""Randomized check of the framing expressions against a direct Python
statement of the rules (brute force on generated values)."""

from __future__ import annotations

import random


from framelake.functions.framing import frame_outcome, schema_id, strip_framing, varint_bytes, zigzag

MAX_INT = 2**31 - 1


def _read_varint(buf: bytes, pos: int):
    """(value, next position) of the varint at ``pos``, or None when it runs
    past the end, needs more than six bytes or exceeds 2^31 - 1."""
    value = 0
    for k in range(6):
        if pos + k >= len(buf):
            return None
        b = buf[pos + k]
        value |= (b & 0x7F) << (7 * k)
        if b < 0x80:
            return (value, pos + k + 1) if value <= MAX_INT else None
    return None


def expected(buf: bytes | None):
    if buf is None:
        return None, "null_value", None
    if len(buf) == 0:
        return None, "empty", None
    if buf[0] != 0:
        return buf, "plain", None
    if len(buf) < 6:
        return None, "too_short", None
    count = _read_varint(buf, 5)
    if count is None:
        return None, "bad_index", None
    raw, pos = count
    n = (raw >> 1) ^ -(raw & 1)
    if n < 0:
        return None, "bad_index", None
    for _ in range(n):
        nxt = _read_varint(buf, pos)
        if nxt is None:
            return None, "bad_index", None
        pos = nxt[1]
    sid = int.from_bytes(buf[1:5], "big", signed=True)
    return buf[pos:], "framed", sid


def _cases(seed: int, count: int) -> list[bytes | None]:
    rng = random.Random(seed)
    out: list[bytes | None] = [None, b""]
    for _ in range(count):
        kind = rng.random()
        payload = bytes(rng.randrange(256) for _ in range(rng.randrange(0, 12)))
        sid = rng.choice([0, 1, 7, 255, 2**31 - 1, 2**31, 2**32 - 1, rng.randrange(2**32)])
        head = b"\x00" + sid.to_bytes(4, "big")
        if kind < 0.05:  # 64+ indexes: a multi-byte count varint
            idx = [rng.choice([0, 3, 200, 70000]) for _ in range(rng.randrange(64, 200))]
            body = varint_bytes(zigzag(len(idx))) + b"".join(varint_bytes(i) for i in idx)
            value = head + body + payload
            out.append(value if rng.random() < 0.7 else value[: rng.randrange(6, len(value))])
        elif kind < 0.35:  # well-formed frame with a random index array
            idx = [rng.choice([0, 1, 5, 127, 128, 300, 2**21, MAX_INT]) for _ in range(rng.randrange(0, 5))]
            body = varint_bytes(zigzag(len(idx))) + b"".join(varint_bytes(i) for i in idx)
            out.append(head + body + payload)
        elif kind < 0.55:  # frame, then corrupted or truncated somewhere
            idx = [rng.randrange(2**32) for _ in range(rng.randrange(0, 4))]
            body = varint_bytes(rng.randrange(0, 20)) + b"".join(varint_bytes(i) for i in idx)
            value = head + body + payload
            cut = rng.randrange(0, len(value) + 1)
            out.append(value[:cut])
        elif kind < 0.75:  # hostile varints: long continuation runs, padded encodings
            run = bytes(rng.choice([0x80, 0x81, 0x87, 0x88, 0xFF]) for _ in range(rng.randrange(0, 8)))
            tail = bytes([rng.choice([0x00, 0x01, 0x07, 0x08, 0x7F])])
            out.append(head + rng.choice([b"\x02", b"\x04", b"\x06", b"\x80\x01", b""]) + run + tail + payload)
        else:  # arbitrary bytes, often starting with 0
            first = b"\x00" if rng.random() < 0.7 else b""
            out.append(first + bytes(rng.randrange(256) for _ in range(rng.randrange(0, 16))))
    return out


def test_framing_matches_rules_on_random_values(spark):
    cases = _cases(seed=20240101, count=6000)
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(cases)], "i int, v binary")
    got = {
        r.i: r
        for r in df.select(
            "i", strip_framing("v").alias("s"), frame_outcome("v").alias("o"), schema_id("v").alias("sid")
        ).collect()
    }
    mismatches = []
    for i, value in enumerate(cases):
        stripped, outcome, sid = expected(value)
        row = got[i]
        actual = None if row.s is None else bytes(row.s)
        if (actual, row.o, row.sid) != (stripped, outcome, sid):
            mismatches.append((None if value is None else value.hex(), (stripped, outcome, sid), (actual, row.o, row.sid)))
    assert not mismatches, mismatches[:5]
    long_counts = sum(1 for v in cases if v and len(v) > 6 and v[0] == 0 and v[5] >= 0x80 and expected(v)[1] == "framed")
    assert long_counts > 50  # the multi-byte count path was exercised with success
    outcomes = {r.o for r in got.values()}
    assert {"framed", "bad_index", "plain", "too_short", "null_value", "empty"} <= outcomes
