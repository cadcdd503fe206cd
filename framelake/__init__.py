"""Spark-native ingest of schema-registry framed protobuf topics."""

from framelake.functions.framing import (
    frame,
    frame_outcome,
    message_start,
    register_sql_functions,
    schema_id,
    strip_framing,
)
from framelake.functions.headers import cloudevents_columns, cloudevents_headers, headers_map
from framelake.operators.protobuf import from_protobuf, message_schema, to_protobuf
from framelake.settings import Settings

__all__ = [
    "Settings",
    "cloudevents_columns",
    "cloudevents_headers",
    "frame",
    "frame_outcome",
    "from_protobuf",
    "headers_map",
    "message_schema",
    "message_start",
    "register_sql_functions",
    "schema_id",
    "strip_framing",
    "to_protobuf",
]
