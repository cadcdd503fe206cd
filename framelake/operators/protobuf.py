"""Protobuf decode and encode of binary columns (DEC-2, and the encoder used
to publish records).

``from_protobuf``/``to_protobuf`` take the message full name and a serialized
``FileDescriptorSet``. When Spark's protobuf connector is on the classpath they
call it (JVM-side). Otherwise they run an Arrow UDF that decodes each Arrow
batch with the protobuf runtime; the descriptor pool is built once per Python
worker. Both give the same Spark types and NULL rules as the connector with
default options:

* int32/sint32/sfixed32/uint32/fixed32 -> INT, 64-bit ints -> BIGINT,
  float/double -> FLOAT/DOUBLE, bool, string, bytes -> BINARY, enum -> STRING
  (value name), message -> STRUCT, repeated -> ARRAY, map -> MAP,
  google.protobuf.Timestamp -> TIMESTAMP, google.protobuf.Duration ->
  INTERVAL DAY TO SECOND;
* a field that is not present (a proto3 scalar at its zero value, an unset
  message) is NULL, but an absent proto2 field with a default has its default,
  and an empty repeated or map field is an empty collection;
* a NULL input gives a NULL struct; bytes that do not parse raise in
  ``FAILFAST`` mode and give a NULL struct in ``PERMISSIVE`` mode.
"""

from __future__ import annotations

import functools
import importlib
from datetime import datetime, timezone

import pyarrow as pa
from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
from google.protobuf.descriptor import FieldDescriptor
from google.protobuf.message import DecodeError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from framelake.session import ship_package

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"
_TIMESTAMP = "google.protobuf.Timestamp"
_DURATION = "google.protobuf.Duration"
_EPOCH_NAIVE = datetime(1970, 1, 1)

# ---------------------------------------------------------------------------
# Descriptor handling


def _ordered_files(files: list[descriptor_pb2.FileDescriptorProto]) -> list[descriptor_pb2.FileDescriptorProto]:
    """Files with dependencies first; well-known imports missing from the set
    are taken from the runtime's own copies."""
    by_name = {f.name: f for f in files}
    ordered: list[descriptor_pb2.FileDescriptorProto] = []
    done: set[str] = set()

    def visit(name: str, trail: tuple[str, ...] = ()) -> None:
        if name in done:
            return
        if name in trail:
            raise ValueError(f"import cycle through {name}")
        proto = by_name.get(name)
        if proto is None:
            if name.startswith("google/protobuf/"):
                # Loads the runtime's copy into the default pool.
                importlib.import_module("google.protobuf." + name.rsplit("/", 1)[-1].replace(".proto", "_pb2"))
            proto = descriptor_pb2.FileDescriptorProto()
            descriptor_pool.Default().FindFileByName(name).CopyToProto(proto)
        for dep in proto.dependency:
            visit(dep, trail + (name,))
        done.add(name)
        ordered.append(proto)

    for f in files:
        visit(f.name)
    return ordered


@functools.lru_cache(maxsize=32)
def message_class(descriptor_set: bytes, message_name: str):
    """Python message class for ``message_name`` in a serialized
    FileDescriptorSet (cached per process, so once per Python worker)."""
    fds = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set)
    pool = descriptor_pool.DescriptorPool()
    for fd in _ordered_files(list(fds.file)):
        pool.Add(fd)
    try:
        descriptor = pool.FindMessageTypeByName(message_name)
    except KeyError as exc:
        raise ValueError(f"message {message_name!r} is not in the descriptor set") from exc
    return message_factory.GetMessageClass(descriptor)


def _field_type(fd: FieldDescriptor, depth: tuple[str, ...]) -> T.DataType:
    if fd.type == FieldDescriptor.TYPE_MESSAGE:
        mt = fd.message_type
        if mt.GetOptions().map_entry:
            key = _field_type(mt.fields_by_name["key"], depth)
            value = _field_type(mt.fields_by_name["value"], depth)
            return T.MapType(key, value, True)
        element: T.DataType
        if mt.full_name == _TIMESTAMP:
            element = T.TimestampType()
        elif mt.full_name == _DURATION:
            element = T.DayTimeIntervalType()
        else:
            element = _struct_type(mt, depth)
    else:
        element = _SCALAR_TYPES[fd.type]
    if fd.is_repeated:
        return T.ArrayType(element, True)
    return element


def _struct_type(descriptor, depth: tuple[str, ...] = ()) -> T.StructType:
    if descriptor.full_name in depth:
        raise ValueError(f"recursive message {descriptor.full_name} cannot be mapped to a Spark type")
    depth = depth + (descriptor.full_name,)
    return T.StructType([T.StructField(fd.name, _field_type(fd, depth), True) for fd in descriptor.fields])


_SCALAR_TYPES: dict[int, T.DataType] = {
    FieldDescriptor.TYPE_DOUBLE: T.DoubleType(),
    FieldDescriptor.TYPE_FLOAT: T.FloatType(),
    FieldDescriptor.TYPE_INT64: T.LongType(),
    FieldDescriptor.TYPE_UINT64: T.LongType(),
    FieldDescriptor.TYPE_INT32: T.IntegerType(),
    FieldDescriptor.TYPE_FIXED64: T.LongType(),
    FieldDescriptor.TYPE_FIXED32: T.IntegerType(),
    FieldDescriptor.TYPE_BOOL: T.BooleanType(),
    FieldDescriptor.TYPE_STRING: T.StringType(),
    FieldDescriptor.TYPE_BYTES: T.BinaryType(),
    FieldDescriptor.TYPE_UINT32: T.IntegerType(),
    FieldDescriptor.TYPE_ENUM: T.StringType(),
    FieldDescriptor.TYPE_SFIXED32: T.IntegerType(),
    FieldDescriptor.TYPE_SFIXED64: T.LongType(),
    FieldDescriptor.TYPE_SINT32: T.IntegerType(),
    FieldDescriptor.TYPE_SINT64: T.LongType(),
}


def message_schema(descriptor_set: bytes, message_name: str) -> T.StructType:
    """Spark struct type that decoding ``message_name`` produces."""
    return _struct_type(message_class(descriptor_set, message_name).DESCRIPTOR)


# ---------------------------------------------------------------------------
# Message <-> Python values (run inside the Arrow UDFs)


def _wrap(bits: int):
    limit = 1 << bits
    half = limit >> 1
    return lambda v: v - limit if v >= half else v


def _scalar_reader(fd: FieldDescriptor):
    if fd.type == FieldDescriptor.TYPE_ENUM:
        values = fd.enum_type.values_by_number
        return lambda v: values[v].name if v in values else str(v)
    if fd.type in (FieldDescriptor.TYPE_UINT32, FieldDescriptor.TYPE_FIXED32):
        return _wrap(32)
    if fd.type in (FieldDescriptor.TYPE_UINT64, FieldDescriptor.TYPE_FIXED64):
        return _wrap(64)
    return None


def _element_reader(fd: FieldDescriptor):
    """Function turning one (non-repeated view of a) field value into the
    Python value Arrow expects, or None for identity."""
    if fd.type != FieldDescriptor.TYPE_MESSAGE:
        return _scalar_reader(fd)
    name = fd.message_type.full_name
    if name == _TIMESTAMP:
        return lambda m: m.ToDatetime(tzinfo=timezone.utc)
    if name == _DURATION:
        return lambda m: m.ToTimedelta()
    return _message_reader(fd.message_type)


def _field_reader(fd: FieldDescriptor):
    if fd.type == FieldDescriptor.TYPE_MESSAGE and fd.message_type.GetOptions().map_entry:
        value_read = _element_reader(fd.message_type.fields_by_name["value"])
        if value_read is None:
            return lambda m: list(m.items())
        return lambda m: [(k, value_read(v)) for k, v in m.items()]
    read = _element_reader(fd)
    if fd.is_repeated:
        if read is None:
            return list
        return lambda values: [read(v) for v in values]
    return read


@functools.lru_cache(maxsize=None)
def _readers(descriptor) -> dict[int, tuple[int, str, object]]:
    return {fd.number: (i, fd.name, _field_reader(fd)) for i, fd in enumerate(descriptor.fields)}


_FLAT_TYPES = {
    FieldDescriptor.TYPE_STRING, FieldDescriptor.TYPE_BYTES, FieldDescriptor.TYPE_BOOL, FieldDescriptor.TYPE_ENUM,
    FieldDescriptor.TYPE_INT32, FieldDescriptor.TYPE_INT64, FieldDescriptor.TYPE_UINT32, FieldDescriptor.TYPE_UINT64,
    FieldDescriptor.TYPE_SINT32, FieldDescriptor.TYPE_SINT64, FieldDescriptor.TYPE_FIXED32, FieldDescriptor.TYPE_FIXED64,
    FieldDescriptor.TYPE_SFIXED32, FieldDescriptor.TYPE_SFIXED64,
}


@functools.lru_cache(maxsize=None)
def _flat_plan(descriptor):
    """Per-field getters for a message whose fields are all singular
    string/bytes/bool/enum/integer fields, else None. A field without
    presence is absent at its zero value; one with presence asks HasField."""
    if not all(fd.type in _FLAT_TYPES and not fd.is_repeated and not fd.has_default_value for fd in descriptor.fields):
        return None
    return [(i, fd.name, fd.has_presence, fd.default_value, _scalar_reader(fd)) for i, fd in enumerate(descriptor.fields)]


@functools.lru_cache(maxsize=None)
def _always_present(descriptor) -> list:
    """Fields that have a value even when absent: repeated and map ones, and
    proto2 ones with a default."""
    return [fd for fd in descriptor.fields if fd.is_repeated or fd.has_default_value]


def _present(msg):
    """(field, value) of the fields that decode to something other than NULL."""
    seen = msg.ListFields()
    extra = _always_present(msg.DESCRIPTOR)
    if extra:
        numbers = {fd.number for fd, _ in seen}
        seen = [*seen, *((fd, getattr(msg, fd.name)) for fd in extra if fd.number not in numbers)]
    return seen


def _message_reader(descriptor):
    def read(msg) -> dict:
        readers = _readers(descriptor)
        out = {}
        for fd, value in _present(msg):
            _, name, reader = readers[fd.number]
            out[name] = reader(value) if reader is not None else value
        return out

    return read


def _malformed(message_name: str) -> ValueError:
    return ValueError(
        "[MALFORMED_PROTOBUF_MESSAGE] Malformed Protobuf messages are detected in message "
        f"deserialization of {message_name}. Parse Mode: FAILFAST. To process malformed protobuf "
        "message as null result, try setting the option 'mode' as 'PERMISSIVE'."
    )


def decode_batch(data: pa.Array, descriptor_set: bytes, message_name: str, mode: str, arrow_type: pa.DataType) -> pa.Array:
    """Decode one Arrow batch of serialized messages into a StructArray."""
    cls = message_class(descriptor_set, message_name)
    rows = data.to_pylist()
    columns: list[list] = [[None] * len(rows) for _ in range(len(cls.DESCRIPTOR.fields))]
    nulls = [False] * len(rows)
    failfast = mode.upper() == FAILFAST
    parse = cls.FromString
    flat = _flat_plan(cls.DESCRIPTOR)
    if flat is not None:
        getters = [(columns[i], name, presence, default, reader) for i, name, presence, default, reader in flat]
    else:
        readers = _readers(cls.DESCRIPTOR)
    for r, raw in enumerate(rows):
        if raw is None:
            nulls[r] = True
            continue
        try:
            msg = parse(raw)
        except DecodeError as exc:
            if failfast:
                raise _malformed(message_name) from exc
            nulls[r] = True
            continue
        if flat is not None:
            for column, name, presence, default, reader in getters:
                value = getattr(msg, name)
                if msg.HasField(name) if presence else value != default:
                    column[r] = value if reader is None else reader(value)
        else:
            for fd, value in _present(msg):
                i, _, reader = readers[fd.number]
                columns[i][r] = value if reader is None else reader(value)
    arrays = [pa.array(col, type=arrow_type.field(i).type) for i, col in enumerate(columns)]
    return pa.StructArray.from_arrays(arrays, fields=list(arrow_type), mask=pa.array(nulls, type=pa.bool_()))


def _timestamp_out(value) -> dict:
    micros = round(value.timestamp() * 1_000_000) if value.tzinfo else round(
        (value - _EPOCH_NAIVE).total_seconds() * 1_000_000
    )
    seconds, rest = divmod(micros, 1_000_000)
    return {"seconds": seconds, "nanos": rest * 1000}


def _duration_out(value) -> dict:
    micros = (value.days * 86_400 + value.seconds) * 1_000_000 + value.microseconds
    seconds = int(micros / 1_000_000)  # toward zero: seconds and nanos share a sign
    return {"seconds": seconds, "nanos": (micros - seconds * 1_000_000) * 1000}


def _element_writer(fd: FieldDescriptor):
    """Function turning one Spark-side value into what the message
    constructor accepts, or None for identity."""
    if fd.type == FieldDescriptor.TYPE_MESSAGE:
        name = fd.message_type.full_name
        if name == _TIMESTAMP:
            return _timestamp_out
        if name == _DURATION:
            return _duration_out
        plan = _writers(fd.message_type)
        return lambda row: {
            k: (plan[k](v) if plan[k] else v) for k, v in row.items() if v is not None
        }
    if fd.type == FieldDescriptor.TYPE_ENUM:
        by_name = fd.enum_type.values_by_name
        return lambda v: by_name[v].number if isinstance(v, str) else v
    if fd.type in (FieldDescriptor.TYPE_UINT32, FieldDescriptor.TYPE_FIXED32):
        return lambda v: v & 0xFFFFFFFF
    if fd.type in (FieldDescriptor.TYPE_UINT64, FieldDescriptor.TYPE_FIXED64):
        return lambda v: v & 0xFFFFFFFFFFFFFFFF
    return None


def _field_writer(fd: FieldDescriptor):
    if fd.type == FieldDescriptor.TYPE_MESSAGE and fd.message_type.GetOptions().map_entry:
        value_write = _element_writer(fd.message_type.fields_by_name["value"])
        return lambda items: {
            k: (value_write(v) if value_write else v)
            for k, v in (items.items() if isinstance(items, dict) else items)
            if v is not None
        }
    write = _element_writer(fd)
    if fd.is_repeated:
        return lambda values: [write(v) if write else v for v in values if v is not None]
    return write


@functools.lru_cache(maxsize=None)
def _writers(descriptor) -> dict[str, object]:
    return {fd.name: _field_writer(fd) for fd in descriptor.fields}


def encode_batch(data: pa.Array, descriptor_set: bytes, message_name: str) -> pa.Array:
    """Serialize one Arrow batch of structs into message bytes."""
    cls = message_class(descriptor_set, message_name)
    plan = _writers(cls.DESCRIPTOR)
    names = [f.name for f in data.type]
    unknown = [n for n in names if n not in plan]
    if unknown:
        raise ValueError(f"fields {unknown} are not in message {message_name}")
    writers = [plan[n] for n in names]
    columns = [data.field(i).to_pylist() for i in range(len(names))]
    nulls = data.is_null().to_pylist() if data.null_count else None
    out: list[bytes | None] = []
    for r, row in enumerate(zip(*columns)) if columns else enumerate([()] * len(data)):
        if nulls is not None and nulls[r]:
            out.append(None)
            continue
        kwargs = {}
        for name, write, value in zip(names, writers, row):
            if value is not None:
                kwargs[name] = write(value) if write else value
        out.append(cls(**kwargs).SerializeToString())
    return pa.array(out, type=pa.binary())


# ---------------------------------------------------------------------------
# Column functions

_connector_state: dict[str, bool] = {}


def connector_available(spark: SparkSession) -> bool:
    """Whether Spark's protobuf connector is loaded in this JVM."""
    if "loaded" not in _connector_state:
        from pyspark.sql.protobuf import functions as pb

        from framelake.schemas import DEMO_EVENT, demo_descriptor_set

        try:
            spark.range(0).select(
                pb.from_protobuf(F.lit(None).cast("binary"), DEMO_EVENT, binaryDescriptorSet=demo_descriptor_set())
            ).schema
            _connector_state["loaded"] = True
        except Exception as exc:  # noqa: BLE001 - the connector reports absence as an error
            if not str(getattr(exc, "getCondition", str)() or "").startswith("PROTOBUF_NOT_LOADED"):
                raise
            _connector_state["loaded"] = False
    return _connector_state["loaded"]


def _use_connector(impl: str) -> bool:
    if impl == "connector":
        return True
    if impl == "arrow":
        return False
    return connector_available(SparkSession.active())


def from_protobuf(
    data: Column | str, message_name: str, descriptor_set: bytes, mode: str = FAILFAST, impl: str = "auto", once: bool = False
) -> Column:
    """Decode serialized ``message_name`` messages into a struct column.

    Filters on other columns move below the decode, so records they drop are
    not decoded. With ``once`` they stay above it, and a filter on the decoded
    struct itself does not make the optimizer copy the decode."""
    if mode.upper() not in (FAILFAST, PERMISSIVE):
        raise ValueError(f"mode must be {FAILFAST} or {PERMISSIVE}, not {mode!r}")
    col = F.col(data) if isinstance(data, str) else data
    if _use_connector(impl):
        from pyspark.sql.protobuf import functions as pb

        return pb.from_protobuf(col, message_name, options={"mode": mode}, binaryDescriptorSet=descriptor_set)
    schema = message_schema(descriptor_set, message_name)
    arrow_type = to_arrow_type(schema)
    ship_package(SparkSession.active())

    @F.arrow_udf(schema)
    def decode(values: pa.Array) -> pa.Array:
        return decode_batch(values, descriptor_set, message_name, mode, arrow_type)

    return (decode.asNondeterministic() if once else decode)(col)


def to_protobuf(data: Column | str, message_name: str, descriptor_set: bytes, impl: str = "auto") -> Column:
    """Serialize a struct column whose fields are named like the message's."""
    col = F.col(data) if isinstance(data, str) else data
    if _use_connector(impl):
        from pyspark.sql.protobuf import functions as pb

        return pb.to_protobuf(col, message_name, binaryDescriptorSet=descriptor_set)
    message_class(descriptor_set, message_name)  # fail early on an unknown name
    ship_package(SparkSession.active())

    @F.arrow_udf(T.BinaryType())
    def encode(values: pa.Array) -> pa.Array:
        return encode_batch(values, descriptor_set, message_name)

    return encode.asNondeterministic()(col)
