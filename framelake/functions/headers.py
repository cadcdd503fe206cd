"""Record headers as a map and as CloudEvents columns (FN-2..FN-5, PRJ-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The CloudEvents attributes carried as record headers, and the
# spec version the producer writes.
CE_ATTRIBUTES = ("ce_id", "ce_specversion", "ce_type", "ce_source")
CE_SPECVERSION = "1.0"


def headers_map(headers: Column | str = "headers") -> Column:
    """``array<struct<key string, value binary>>`` -> ``map<string,string>``.

    Values are cast to string (bytes that are not UTF-8 are kept, not
    rejected). A NULL array gives a NULL map. A repeated key raises unless the
    session sets ``spark.sql.mapKeyDedupPolicy=LAST_WIN``; a NULL key raises.
    """
    col = F.col(headers) if isinstance(headers, str) else headers
    return F.map_from_entries(
        F.transform(col, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    )


def cloudevents_columns(headers: Column | str = "headers") -> list[Column]:
    """The four CloudEvents attributes looked up in a header map (absent key
    or NULL map -> NULL)."""
    col = F.col(headers) if isinstance(headers, str) else headers
    return [col.getItem(name).alias(name) for name in CE_ATTRIBUTES]


def cloudevents_headers(ce_id: Column, ce_type: Column | str, ce_source: Column | str) -> Column:
    """Record headers for a published event, in the Kafka header type."""

    def as_col(v: Column | str) -> Column:
        return F.lit(v) if isinstance(v, str) else v

    values = {
        "ce_id": ce_id,
        "ce_specversion": F.lit(CE_SPECVERSION),
        "ce_type": as_col(ce_type),
        "ce_source": as_col(ce_source),
    }
    return F.array(
        *[
            F.struct(F.lit(name).alias("key"), values[name].cast("string").cast("binary").alias("value"))
            for name in CE_ATTRIBUTES
        ]
    )
