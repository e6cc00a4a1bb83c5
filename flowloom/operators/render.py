"""Packets and sessions as text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.numbertext import named_values, seconds_text
from flowloom.operators.headers import FIELDS, TEXT_COLUMNS, column_of
from flowloom.operators.sessions import KEY

# Fixed values of the record format. The feature mark starts with a backslash and the letter n.
PACKET_MARK = "<pck>"
FEATURE_MARK = "\\n<feature>"
PAYLOAD_DIGITS = 128
PAYLOAD_FIELDS = ("tcp.payload", "udp.payload")


def _field_value(field: str) -> Column:
    name = column_of(field)
    value = F.col(name)
    if name.endswith("_us"):
        return seconds_text(value)
    if field in PAYLOAD_FIELDS:
        value = F.substring(value, 1, PAYLOAD_DIGITS)
    return F.nullif(value, F.lit("")) if name in TEXT_COLUMNS else value.cast("string")


def packet_text(headers: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """Add ``text``: ``field: value`` pairs joined by ``, ``; empty fields are left out."""
    values = F.array(*[_field_value(f) for f in fields])
    return headers.withColumn("text", named_values(fields, values))


def session_text(packets: DataFrame) -> DataFrame:
    """One row per session: packets in order, each as mark, text and a blank.

    Sessions come cut to their first packets, so a group is a handful of rows,
    and already hashed on the session key, so no shuffle is added.
    """
    ordered = F.sort_array(F.collect_list(F.struct("pos", "text")))
    marked = F.transform(ordered, lambda p: F.concat(F.lit(PACKET_MARK), p["text"], F.lit(" ")))
    return packets.groupBy(*KEY).agg(
        F.count("*").alias("n_pkts"), F.array_join(marked, "").alias("packets_text")
    )


def with_feature_text(sessions: DataFrame, features: Column) -> DataFrame:
    """Add ``text``: the packets, the feature mark and the session's features (may be empty)."""
    return sessions.withColumn(
        "text",
        F.concat("packets_text", F.lit(FEATURE_MARK), F.coalesce(features, F.lit(""))),
    )
