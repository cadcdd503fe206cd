"""Schema-registry wire framing as Catalyst expressions.

A framed record value is::

    byte 0      magic byte 0
    bytes 1..4  schema id, big-endian
    bytes 5..   zig-zag varint count n, then n varint message indexes
    rest        the protobuf message

Each operation is built from built-in expressions, so stripping, classifying
and reading schema ids run in the JVM with no Python worker: as column
functions (``strip_framing(col)``), which need nothing registered, and as
temporary SQL functions (``strip_confluent_protobuf(value)``), which Spark
inlines into the plan.

The common frame (count byte ``00``) takes a ``substring`` fast path. Other
index arrays are walked over a Latin-1 view of the bytes (one char per byte):
``split`` after each varint's last byte with limit ``n + 1`` yields the n index
varints and the message, and one find-regex rejects any varint the reader would
not accept. This is exact for any n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- Fixed values of the wire format ----------------------------------------
MAGIC_BYTE = 0
SCHEMA_ID_BYTES = 4
MIN_FRAME_SIZE = 6  # magic + schema id + at least one index byte
# Outcome labels of frame_outcome(); decode_error is added by the decoder.
OUTCOME_NULL = "null_value"
OUTCOME_EMPTY = "empty"
OUTCOME_PLAIN = "plain"
OUTCOME_FRAMED = "framed"
OUTCOME_TOO_SHORT = "too_short"
OUTCOME_BAD_INDEX = "bad_index"
OUTCOME_DECODE_ERROR = "decode_error"
USABLE_OUTCOMES = (OUTCOME_PLAIN, OUTCOME_FRAMED)

# A varint the frame reader accepts: at most six bytes and a value of at most
# 2^31-1. Over the Latin-1 view a continuation byte is [\x80-\xff] and a last
# byte [\x00-\x7f]; a fifth byte may carry three value bits, a sixth none.
VARINT_RE = r"(?:[\x80-\xff]{0,3}[\x00-\x7f]|[\x80-\xff]{4}(?:[\x00-\x07]|[\x80-\x87]\x00))"
# Zero-width split point after each varint's last byte.
AFTER_VARINT_RE = r"(?<=[\x00-\x7f])"
# Found anywhere in a run of whole varints iff one of them is not accepted:
# from the start of a run of continuation bytes, six or more of them; four and
# a last byte above 7; or five whose fifth is above 0x87 or whose last is not 0.
INVALID_VARINT_RE = (
    r"(?<![\x80-\xff])[\x80-\xff]{4}"
    r"(?:[\x80-\xff]{2}|[\x08-\x7f]|[\x88-\xff][\x00-\x7f]|[\x80-\x87][\x01-\x7f])"
)


# --- The byte walk -------------------------------------------------------------
#
# The fast path (count byte 0) is a few byte compares. The slow path is a chain
# of steps, ``transform(transform(array(value), v -> ...), s -> ...)``, each of
# which binds what it computed in a struct for the next. A lambda is evaluated
# as an opaque expression, which keeps the walk out of the generated code of the
# projection (without steps it was over 70 KB of Java for 2 KB of SQL, too large
# for the JIT) and keeps plans small when the optimizer copies the expression.
# The steps follow each other rather than nest: a Python UDF over a lambda that
# uses a variable of an outer lambda is not extracted by the planner.
#
# The index walk reads a window of the bytes after the count (at most 6 * n
# bytes when the count is one byte: no index varint is longer than six bytes),
# ``split``s it after each varint end with limit n + 1 (fewer pieces means the
# array is cut off) and checks the n index varints with one find-regex. No
# regex repetition, so no recursion on hostile input, and exact for any n.

_P = "framelake_frame_"  # prefix of the library's internal SQL functions
_COUNT_POS = SCHEMA_ID_BYTES + 2  # 1-based position of the count varint


def _varint_value_sql(chars: str) -> str:
    terms = [f"shiftleft(CAST(ascii(substring({chars}, {i + 1}, 1)) AS BIGINT) & 127, {7 * i})" for i in range(6)]
    return " + ".join(terms)


def _latin1(data: str) -> str:
    return f"decode({data}, 'ISO-8859-1')"


# Variable and body of each step, from a value whose count byte is not 0 to the
# position of its message, or NULL.
_SLOW_STEPS: list[tuple[str, str]] = [
    # The count byte; below 128 it is the whole count.
    ("v", f"struct(v AS v, ascii({_latin1(f'substring(v, {_COUNT_POS}, 1)')}) AS b)"),
    ("s", f"struct(s.v AS v, s.b AS b, CASE WHEN s.b >= 128 THEN regexp_extract({_latin1(f'substring(s.v, {_COUNT_POS}, 6)')}, r'^({VARINT_RE})', 1) END AS c)"),
    ("s", f"struct(s.v AS v, s.b AS b, s.c AS c, CASE WHEN s.b < 128 THEN CAST(s.b AS BIGINT) WHEN length(s.c) > 0 THEN {_varint_value_sql('s.c')} END AS z)"),
    # Number of indexes (odd means negative) and where they start.
    (
        "s",
        "struct(s.v AS v, s.b AS b, CASE WHEN s.z & 1 = 0 THEN CAST(shiftright(s.z, 1) AS INT) END AS n,"
        f" CASE WHEN s.b < 128 THEN {_COUNT_POS + 1} ELSE {_COUNT_POS} + length(s.c) END AS at)",
    ),
    (
        "s",
        "struct(s.n AS n, s.at AS at, CASE WHEN s.n IS NULL THEN NULL WHEN s.b < 128"
        f" THEN {_latin1('substring(s.v, s.at, 6 * s.n)')} ELSE {_latin1('substring(s.v, s.at)')} END AS w)",
    ),
    ("s", f"struct(s.n AS n, s.at AS at, s.w AS w, split(s.w, r'{AFTER_VARINT_RE}', s.n + 1) AS p)"),
    ("s", "struct(s.at AS at, s.w AS w, CASE WHEN size(s.p) >= s.n + 1 THEN length(s.w) - length(element_at(s.p, -1)) END AS i)"),
    ("s", f"CASE WHEN s.i IS NULL OR substring(s.w, 1, s.i) RLIKE r'{INVALID_VARINT_RE}' THEN CAST(NULL AS INT) ELSE s.at + s.i END"),
]


def _slow_start_sql() -> str:
    walk = "array(value)"
    for name, body in _SLOW_STEPS:
        walk = f"transform({walk}, {name} -> {body})"
    return f"element_at({walk}, 1)"


def _start_sql() -> str:
    return (
        "CASE"
        " WHEN value IS NULL OR length(value) = 0 THEN CAST(NULL AS INT)"
        " WHEN substring(value, 1, 1) <> X'00' THEN 1"
        f" WHEN length(value) < {MIN_FRAME_SIZE} THEN CAST(NULL AS INT)"
        f" WHEN substring(value, {_COUNT_POS}, 1) = X'00' THEN {MIN_FRAME_SIZE + 1}"
        f" ELSE {_slow_start_sql()}"
        " END"
    )


# (name, parameters, return type, body), in dependency order.
_DEFINITIONS: list[tuple[str, str, str, str]] = [
    # 1-based position of the message in the value (1 for plain protobuf),
    # NULL when the value carries none.
    ("start", "value BINARY", "INT", _start_sql()),
    (
        "strip_at",
        "value BINARY, start INT",
        "BINARY",
        "CASE WHEN start = 1 THEN value WHEN start > 1 THEN substring(value, start) END",
    ),
    (
        "outcome_at",
        "value BINARY, start INT",
        "STRING",
        "CASE"
        f" WHEN value IS NULL THEN '{OUTCOME_NULL}'"
        f" WHEN length(value) = 0 THEN '{OUTCOME_EMPTY}'"
        f" WHEN substring(value, 1, 1) <> X'00' THEN '{OUTCOME_PLAIN}'"
        f" WHEN length(value) < {MIN_FRAME_SIZE} THEN '{OUTCOME_TOO_SHORT}'"
        f" WHEN start IS NULL THEN '{OUTCOME_BAD_INDEX}'"
        f" ELSE '{OUTCOME_FRAMED}'"
        " END",
    ),
    # Bytes 1..4 as a signed big-endian int (sign-extended by the shifts),
    # widened to BIGINT, for frames only.
    (
        "schema_id_at",
        "value BINARY, start INT",
        "BIGINT",
        f"CASE WHEN start > 1 THEN shiftright(shiftleft(CAST(conv(hex(substring(value, 2, {SCHEMA_ID_BYTES})), 16, 10)"
        " AS BIGINT), 32), 32) END",
    ),
]
_RETURN_TYPES = {"strip": "BINARY", "outcome": "STRING", "schema_id": "BIGINT"}
DEFAULT_STRIP_FUNCTION = "strip_confluent_protobuf"


def register_sql_functions(
    spark: SparkSession,
    strip_name: str = DEFAULT_STRIP_FUNCTION,
    outcome_name: str = "frame_outcome",
    schema_id_name: str = "frame_schema_id",
) -> dict[str, str]:
    """Register ``strip_confluent_protobuf(value)``, ``frame_outcome(value)``
    and ``frame_schema_id(value)`` (names configurable) as temporary SQL
    functions of this session, for SQL users; again is harmless. Returns
    kind -> name."""

    def create(name: str, params: str, rtype: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {rtype} RETURN {body}")

    for name, params, rtype, body in _DEFINITIONS:
        create(_P + name, params, rtype, body)
    names = {"strip": strip_name, "outcome": outcome_name, "schema_id": schema_id_name}
    for kind, name in names.items():
        create(name, "value BINARY", _RETURN_TYPES[kind], f"{_P}{kind}_at(value, {_P}start(value))")
    return names


# --- Column functions ------------------------------------------------------------
#
# The same rules as expressions over a column. Nothing is looked up in a
# session, so they work on any DataFrame: of another session, or inside
# ``foreachBatch``. The fast path stays in generated code; the slow path is the
# steps above, over the column.


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _byte(value: Column, position: int) -> Column:
    return F.substring(value, position, 1)


_ZERO = bytearray([MAGIC_BYTE])


def message_start(value: Column | str) -> Column:
    """1-based position of the message inside the value (1 for plain
    protobuf), NULL when there is none. Compute it once and derive the rest
    with the ``*_at`` functions when several are needed."""
    v = _column(value)
    none = F.lit(None).cast("int")
    walk = F.array(v)
    for name, body in _SLOW_STEPS:
        walk = F.call_function("transform", walk, F.expr(f"{name} -> {body}"))
    slow = F.element_at(walk, 1)
    return (
        F.when(v.isNull() | (F.length(v) == 0), none)
        .when(_byte(v, 1) != F.lit(_ZERO), F.lit(1))
        .when(F.length(v) < MIN_FRAME_SIZE, none)
        .when(_byte(v, _COUNT_POS) == F.lit(_ZERO), F.lit(MIN_FRAME_SIZE + 1))
        .otherwise(slow)
    )


def strip_at(value: Column | str, start: Column | str) -> Column:
    v = _column(value)
    return F.substring(v, _column(start), F.length(v))


def outcome_at(value: Column | str, start: Column | str) -> Column:
    v = _column(value)
    return (
        F.when(v.isNull(), F.lit(OUTCOME_NULL))
        .when(F.length(v) == 0, F.lit(OUTCOME_EMPTY))
        .when(_byte(v, 1) != F.lit(_ZERO), F.lit(OUTCOME_PLAIN))
        .when(F.length(v) < MIN_FRAME_SIZE, F.lit(OUTCOME_TOO_SHORT))
        .when(_column(start).isNull(), F.lit(OUTCOME_BAD_INDEX))
        .otherwise(F.lit(OUTCOME_FRAMED))
    )


def schema_id_at(value: Column | str, start: Column | str) -> Column:
    unsigned = F.conv(F.hex(F.substring(_column(value), 2, SCHEMA_ID_BYTES)), 16, 10).cast("long")
    return F.when(_column(start) > 1, F.shiftright(F.shiftleft(unsigned, 32), 32))


def strip_framing(value: Column | str) -> Column:
    """Normalise a record value to plain protobuf bytes: NULL stays NULL, an
    empty value gives NULL, a value whose first byte is not 0 is plain protobuf
    and is returned unchanged, a frame gives the bytes after its index array
    (possibly empty), a malformed frame gives NULL."""
    return strip_at(value, message_start(value))


def frame_outcome(value: Column | str) -> Column:
    """``null_value``, ``empty``, ``plain``, ``framed``, ``too_short`` or
    ``bad_index``; only ``plain`` and ``framed`` carry a message."""
    return outcome_at(value, message_start(value))


def schema_id(value: Column | str) -> Column:
    """Schema id of a well-formed frame, NULL for anything else."""
    return schema_id_at(value, message_start(value))


# --- Encoding ----------------------------------------------------------------


def varint_bytes(value: int) -> bytes:
    """Unsigned LEB128 varint of a non-negative int."""
    if value < 0:
        raise ValueError("varint of a negative number")
    out = bytearray()
    while True:
        byte = value & 0x7F
        value >>= 7
        if value:
            out.append(byte | 0x80)
        else:
            out.append(byte)
            return bytes(out)


def zigzag(value: int) -> int:
    return (value << 1) if value >= 0 else ((-value) << 1) - 1


def message_index_bytes(indexes: Sequence[int] = (0,)) -> bytes:
    """Index array for the message at ``indexes`` in its schema file, in the
    serializer's convention: the first top-level message ``[0]`` is the single
    byte 0, otherwise a zig-zag count followed by zig-zag indexes."""
    if list(indexes) == [0]:
        return b"\x00"
    out = bytearray(varint_bytes(zigzag(len(indexes))))
    for index in indexes:
        out += varint_bytes(zigzag(index))
    return bytes(out)


def frame(payload: Column | str, schema_id: int | Column, indexes: Sequence[int] | bytes = (0,)) -> Column:
    """Frame protobuf ``payload`` bytes with a schema id (an int or an integer
    column) and a message index array (indexes, or the raw index-array bytes)."""
    index_bytes = bytes(indexes) if isinstance(indexes, (bytes, bytearray)) else message_index_bytes(indexes)
    body = F.col(payload) if isinstance(payload, str) else payload
    if isinstance(schema_id, int):
        header = bytes([MAGIC_BYTE]) + (schema_id & 0xFFFFFFFF).to_bytes(SCHEMA_ID_BYTES, "big") + index_bytes
        return F.concat(F.lit(bytearray(header)), body)
    id_bytes = F.unhex(F.lpad(F.hex(schema_id.cast("long").bitwiseAND(0xFFFFFFFF)), 2 * SCHEMA_ID_BYTES, "0"))
    return F.concat(F.lit(bytearray([MAGIC_BYTE])), id_bytes, F.lit(bytearray(index_bytes)), body)
