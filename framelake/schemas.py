"""Message schemas as protobuf descriptor sets, built without protoc.

The decode and encode operators take a serialized ``FileDescriptorSet`` (what
``buf build --as-file-descriptor-set`` or ``protoc --descriptor_set_out``
writes). This module builds such sets in-process so tests, fixtures and the
driver queries need no code generator.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from google.protobuf import descriptor_pb2

_FDP = descriptor_pb2.FieldDescriptorProto

_SCALARS = {
    "double": _FDP.TYPE_DOUBLE,
    "float": _FDP.TYPE_FLOAT,
    "int64": _FDP.TYPE_INT64,
    "uint64": _FDP.TYPE_UINT64,
    "int32": _FDP.TYPE_INT32,
    "fixed64": _FDP.TYPE_FIXED64,
    "fixed32": _FDP.TYPE_FIXED32,
    "bool": _FDP.TYPE_BOOL,
    "string": _FDP.TYPE_STRING,
    "bytes": _FDP.TYPE_BYTES,
    "uint32": _FDP.TYPE_UINT32,
    "sfixed32": _FDP.TYPE_SFIXED32,
    "sfixed64": _FDP.TYPE_SFIXED64,
    "sint32": _FDP.TYPE_SINT32,
    "sint64": _FDP.TYPE_SINT64,
}


def _camel(name: str) -> str:
    return "".join(part[:1].upper() + part[1:] for part in name.split("_"))


def _set_type(field: descriptor_pb2.FieldDescriptorProto, type_name: str) -> None:
    if type_name in _SCALARS:
        field.type = _SCALARS[type_name]
    elif type_name.startswith("enum:"):
        field.type = _FDP.TYPE_ENUM
        field.type_name = type_name[len("enum:") :]
    else:
        field.type = _FDP.TYPE_MESSAGE
        field.type_name = type_name if type_name.startswith(".") else "." + type_name


def message_proto(
    full_name: str, fields: Sequence[tuple[str, int, str]]
) -> descriptor_pb2.DescriptorProto:
    """One message. ``fields`` are ``(name, number, type)``; type is a scalar
    name, a message full name, ``repeated <type>`` or ``map<k,v>``."""
    msg = descriptor_pb2.DescriptorProto(name=full_name.rsplit(".", 1)[-1])
    for name, number, type_name in fields:
        field = msg.field.add(name=name, number=number, json_name=_camel(name)[:1].lower() + _camel(name)[1:])
        type_name = type_name.replace(" ", "")
        if type_name.startswith("map<"):
            key_type, value_type = type_name[4:-1].split(",")
            entry = msg.nested_type.add(name=_camel(name) + "Entry")
            entry.options.map_entry = True
            _set_type(entry.field.add(name="key", number=1, label=_FDP.LABEL_OPTIONAL, json_name="key"), key_type)
            _set_type(entry.field.add(name="value", number=2, label=_FDP.LABEL_OPTIONAL, json_name="value"), value_type)
            field.label = _FDP.LABEL_REPEATED
            field.type = _FDP.TYPE_MESSAGE
            field.type_name = f".{full_name}.{entry.name}"
        elif type_name.startswith("repeated"):
            field.label = _FDP.LABEL_REPEATED
            _set_type(field, type_name[len("repeated") :])
        else:
            field.label = _FDP.LABEL_OPTIONAL
            _set_type(field, type_name)
    return msg


def file_proto(
    path: str,
    package: str,
    messages: Iterable[tuple[str, Sequence[tuple[str, int, str]]]],
    dependencies: Sequence[str] = (),
) -> descriptor_pb2.FileDescriptorProto:
    """A proto3 file holding ``messages`` (simple names) in ``package``."""
    fd = descriptor_pb2.FileDescriptorProto(name=path, package=package, syntax="proto3")
    fd.dependency.extend(dependencies)
    for name, fields in messages:
        fd.message_type.append(message_proto(f"{package}.{name}", fields))
    return fd


def descriptor_set(files: Iterable[descriptor_pb2.FileDescriptorProto]) -> bytes:
    """Serialized ``FileDescriptorSet`` of ``files`` (dependencies first)."""
    return descriptor_pb2.FileDescriptorSet(file=list(files)).SerializeToString()


# --- Fixed values: the message schemas of the event topic --------------------
# acme/demo/v1/demo.proto      DemoEvent    { string id = 1; int64 created_at_epoch_ms = 2; string payload = 3; }
#                              DemoEventBytes { bytes id = 1; int64 created_at_epoch_ms = 2; string payload = 3; }
# acme/demo/v1/envelope.proto  DemoEnvelope { DemoEvent event = 1; map<string, string> headers = 2; }
# acme/test/v1/base.proto      Base         { string id = 1; }
# acme/test/v1/common.proto    Common       { int64 ts = 1; }
# acme/test/v1/root.proto      Root         { Base base = 1; Common common = 2; }  (imports base, common)
DEMO_EVENT = "acme.demo.v1.DemoEvent"
DEMO_EVENT_BYTES = "acme.demo.v1.DemoEventBytes"
DEMO_ENVELOPE = "acme.demo.v1.DemoEnvelope"
TEST_ROOT = "acme.test.v1.Root"


def demo_files() -> list[descriptor_pb2.FileDescriptorProto]:
    demo = file_proto(
        "acme/demo/v1/demo.proto",
        "acme.demo.v1",
        [
            ("DemoEvent", [("id", 1, "string"), ("created_at_epoch_ms", 2, "int64"), ("payload", 3, "string")]),
            ("DemoEventBytes", [("id", 1, "bytes"), ("created_at_epoch_ms", 2, "int64"), ("payload", 3, "string")]),
        ],
    )
    envelope = file_proto(
        "acme/demo/v1/envelope.proto",
        "acme.demo.v1",
        [("DemoEnvelope", [("event", 1, DEMO_EVENT), ("headers", 2, "map<string,string>")])],
        dependencies=["acme/demo/v1/demo.proto"],
    )
    return [demo, envelope]


def test_files() -> list[descriptor_pb2.FileDescriptorProto]:
    base = file_proto("acme/test/v1/base.proto", "acme.test.v1", [("Base", [("id", 1, "string")])])
    common = file_proto("acme/test/v1/common.proto", "acme.test.v1", [("Common", [("ts", 1, "int64")])])
    root = file_proto(
        "acme/test/v1/root.proto",
        "acme.test.v1",
        [("Root", [("base", 1, "acme.test.v1.Base"), ("common", 2, "acme.test.v1.Common")])],
        dependencies=["acme/test/v1/base.proto", "acme/test/v1/common.proto"],
    )
    return [base, common, root]


def demo_descriptor_set() -> bytes:
    """Descriptor set holding every schema above."""
    return descriptor_set(demo_files() + test_files())
