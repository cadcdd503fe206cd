"""Topics of several messages: a frame's schema id and message indexes name the
message it holds (DEC-1 and DEC-2 together).

A schema id stands for a file of the descriptor set, the indexes for a path in
it: the position of a top-level message, then of one nested in it, and so on.
The paths of a set of files are few, so the message is looked up by the bytes of
the index array in an expression, and each message's records are decoded with
its own schema. Bodies of different messages share one ``VARIANT`` column.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from google.protobuf import descriptor_pb2
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.framing import SCHEMA_ID_BYTES, message_index_bytes, message_start, schema_id_at, strip_at, varint_bytes, zigzag
from framelake.operators.protobuf import FAILFAST, from_protobuf


def message_paths(descriptor_set: bytes, file: str) -> dict[str, tuple[int, ...]]:
    """Full name -> message indexes of every message of ``file``; map entries
    have a place among their siblings but no name."""
    files = {f.name: f for f in descriptor_pb2.FileDescriptorSet.FromString(descriptor_set).file}
    if file not in files:
        raise ValueError(f"file {file!r} is not in the descriptor set")

    def walk(messages, prefix: str, path: tuple[int, ...]) -> Iterator[tuple[str, tuple[int, ...]]]:
        for at, message in enumerate(messages):
            if not message.options.map_entry:
                name = f"{prefix}.{message.name}" if prefix else message.name
                yield name, (*path, at)
                yield from walk(message.nested_type, name, (*path, at))

    return dict(walk(files[file].message_type, files[file].package, ()))


def _index_arrays(path: tuple[int, ...]) -> list[bytes]:
    """How serializers write ``path``: with its count, the first message also
    as a single zero byte."""
    counted = varint_bytes(zigzag(len(path))) + b"".join(varint_bytes(zigzag(i)) for i in path)
    return list({counted, message_index_bytes(path)})


def message_names(schema_files: Mapping[int, str], descriptor_set: bytes) -> dict[tuple[int, bytes], str]:
    """(schema id, index array) -> message for the schema ids of ``schema_files``."""
    names = {}
    for schema, file in schema_files.items():
        for name, path in message_paths(descriptor_set, file).items():
            for array in _index_arrays(path):
                names[schema, array] = name
    return names


def framed_message(value: Column | str, start: Column | str, schema_files: Mapping[int, str], descriptor_set: bytes) -> Column:
    """The full name of the message that a frame holds, NULL for what is not a
    frame or names no message. ``start`` is ``message_start(value)``."""
    v, at = (F.col(c) if isinstance(c, str) else c for c in (value, start))
    indexes = F.hex(F.substring(v, SCHEMA_ID_BYTES + 2, at - F.lit(SCHEMA_ID_BYTES + 2)))
    key = F.concat_ws(":", schema_id_at(v, at).cast("string"), indexes)
    known = message_names(schema_files, descriptor_set)
    names = F.create_map(*[F.lit(x) for (schema, array), name in known.items() for x in (f"{schema}:{array.hex().upper()}", name)])
    return F.when(at > 1, F.try_element_at(names, key))


def decode_mixed(
    records: DataFrame, schema_files: Mapping[int, str], descriptor_set: bytes, value: str = "value", mode: str = FAILFAST, impl: str = "auto"
) -> DataFrame:
    """``records`` with ``message``, the name of the message that a record
    holds, and ``body``, its fields as ``VARIANT`` (NULL where there is none).
    Each record is decoded once, by its own message: the others' decoders get a
    NULL in its place. Repeated schema ids of one file share a decoder."""
    messages = sorted(set(message_names(schema_files, descriptor_set).values()))
    found = records.withColumn("_start", message_start(value))
    found = found.withColumn("message", framed_message(value, "_start", schema_files, descriptor_set))
    payload = strip_at(value, "_start")
    bodies = [F.to_variant_object(from_protobuf(F.when(F.col("message") == m, payload), m, descriptor_set, mode=mode, impl=impl)) for m in messages]
    return found.withColumn("body", F.coalesce(*bodies)).drop("_start")
