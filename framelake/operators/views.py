"""Projections of topic records (PRJ-1..PRJ-8).

Every view is a plain ``select`` over the record stream; Catalyst prunes what
a view does not use, so the header view never decodes messages and the payload
view never builds the header map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.framing import strip_framing
from framelake.functions.headers import cloudevents_columns, headers_map
from framelake.operators.protobuf import FAILFAST, from_protobuf
from framelake.settings import Settings

RECORD_KEY_COLUMNS = ("topic", "partition", "offset", "timestamp", "key")
# The message fields the payload view shows.
PAYLOAD_FIELDS = ("id", "payload")


def record_view(records: DataFrame) -> DataFrame:
    """PRJ-1: record metadata, key as string, raw value, header map."""
    headers = headers_map("headers") if "headers" in records.columns else F.lit(None).cast("map<string,string>")
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value"),
        headers.alias("headers"),
    )


def decoded_message(
    value: Column | str,
    message_name: str,
    descriptor_set: bytes,
    mode: str = FAILFAST,
    impl: str = "auto",
) -> Column:
    """DEC-1 then DEC-2: strip the framing, decode the message."""
    return from_protobuf(strip_framing(value), message_name, descriptor_set, mode=mode, impl=impl)


def payload_view(
    base: DataFrame,
    message_name: str,
    descriptor_set: bytes,
    fields: Sequence[str] | None = PAYLOAD_FIELDS,
    mode: str = FAILFAST,
    impl: str = "auto",
) -> DataFrame:
    """PRJ-5: record metadata plus decoded message fields (``fields=None``
    keeps every field of the message)."""
    decoded = base.select(
        *RECORD_KEY_COLUMNS, decoded_message("value", message_name, descriptor_set, mode, impl).alias("msg")
    )
    picked = [F.col("msg.*")] if fields is None else [F.col(f"msg.{f}").alias(f) for f in fields]
    return decoded.select(*RECORD_KEY_COLUMNS, *picked)


def headers_view(base: DataFrame) -> DataFrame:
    """PRJ-6: record metadata plus the four CloudEvents attributes."""
    return base.select(*RECORD_KEY_COLUMNS, *cloudevents_columns("headers"))


def raw_view(base: DataFrame) -> DataFrame:
    """PRJ-7: record metadata plus the unstripped value as upper-case hex."""
    return base.select(*RECORD_KEY_COLUMNS, F.hex("value").alias("value_hex"))


def inspect_views(records: DataFrame, settings: Settings, descriptor_set: bytes | None) -> dict[str, DataFrame]:
    """PRJ-8: the views the inspect job prints. A message name selects the
    decoded payload view, none the raw hex view; ``print_mode='headers'``
    selects the header view; dual mode returns both."""
    base = record_view(records)
    if settings.message_name:
        if descriptor_set is None:
            raise ValueError("decoding needs a descriptor set")
        payload = payload_view(
            base, settings.message_name, descriptor_set, mode=settings.decode_mode, impl=settings.protobuf_impl
        )
    else:
        payload = raw_view(base)
    headers = headers_view(base)
    if settings.dual_stream:
        return {"payload": payload, "headers": headers}
    if settings.print_mode == "headers":
        return {"headers": headers}
    return {"payload": payload}


def ingest_view(
    records: DataFrame,
    message_name: str,
    descriptor_set: bytes,
    mode: str = FAILFAST,
    impl: str = "auto",
) -> DataFrame:
    """The ingest projection: ``id``, ``payload``, ``ingested_at`` (processing
    time, one value per micro-batch), plus the record's topic, partition and
    offset so duplicates across runs can be found."""
    msg = decoded_message("value", message_name, descriptor_set, mode, impl)
    return records.select(
        msg.alias("msg"), "topic", "partition", "offset"
    ).select(
        F.col("msg.id").alias("id"),
        F.col("msg.payload").alias("payload"),
        F.current_timestamp().alias("ingested_at"),
        "topic",
        "partition",
        "offset",
    )
