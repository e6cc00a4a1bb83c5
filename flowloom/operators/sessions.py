"""Bidirectional sessions: grouping, filters, first packets and per-class report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.operators.endpoints import flow_key, is_forward, with_endpoints
from flowloom.plans.ranks import slice_positions

# Fixed values of the dataset build.
FIRST_PACKETS = 5
MIN_PACKETS = 3
MIN_CAPTURE_BYTES = 2048
CAPTURE_HEADER_BYTES = 24
RECORD_HEADER_BYTES = 16

KEY = ["class", "flow_key"]
CAPTURE_ORDER = ["ts_us", "capture", "capture_pos"]


def assign_sessions(packets: DataFrame) -> DataFrame:
    """Keep TCP and UDP packets and add ``flow_key`` and ``forward`` (direction)."""
    ends = ["src_ip", "src_port", "dst_ip", "dst_port"]
    cols = [F.col(c) for c in ends]
    return (
        with_endpoints(packets)
        .where(F.col("l4").isNotNull())
        .withColumn("flow_key", flow_key(*cols, F.col("proto")))
        .withColumn("forward", is_forward(*cols))
    )


def session_positions(sessions: DataFrame, order: list[str] = CAPTURE_ORDER) -> DataFrame:
    """Position of every packet within its session, in capture-time order.

    Long sessions are ranked in ranges, also where many packets share a time.
    """
    return slice_positions(sessions, KEY, order)


def session_stats(sessions: DataFrame) -> DataFrame:
    """One row per session: packets, size as a capture file, first and last time."""
    return sessions.groupBy(*KEY).agg(
        F.count("*").alias("n_pkts"),
        (F.sum(F.col("caplen") + RECORD_HEADER_BYTES) + CAPTURE_HEADER_BYTES).alias("size_bytes"),
        F.min("ts_us").alias("first_ts_us"),
        F.max("ts_us").alias("last_ts_us"),
    )


def surviving_sessions(
    sessions: DataFrame, min_packets: int = MIN_PACKETS, min_bytes: int = MIN_CAPTURE_BYTES
) -> DataFrame:
    """Sessions with enough packets and bytes, from map-side combined totals."""
    return session_stats(sessions).where(
        (F.col("n_pkts") >= min_packets) & (F.col("size_bytes") >= min_bytes)
    )


def first_packets(
    sessions: DataFrame, order: list[str] = CAPTURE_ORDER, k: int = FIRST_PACKETS
) -> DataFrame:
    """The first ``k`` packets of each session with ``pos`` 1…k.

    The rank is filtered directly, so each input partition forwards at most ``k``
    packets of a session and a hot session is cut before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))
    return sessions.withColumn("pos", rank).where(F.col("pos") <= k)


def kept_packets(
    sessions: DataFrame,
    order: list[str] = CAPTURE_ORDER,
    k: int = FIRST_PACKETS,
    min_packets: int = MIN_PACKETS,
    min_bytes: int = MIN_CAPTURE_BYTES,
) -> DataFrame:
    """First packets of the surviving sessions.

    Totals and first packets are both hashed on the session key, so the join
    adds no shuffle of its own.
    """
    survivors = surviving_sessions(sessions, min_packets, min_bytes)
    return first_packets(sessions, order, k).join(survivors, KEY)


def class_report(sessions: DataFrame, k: int = FIRST_PACKETS) -> DataFrame:
    """Per class: sessions and packets before and after the filter."""
    passed = (F.col("n_pkts") >= MIN_PACKETS) & (F.col("size_bytes") >= MIN_CAPTURE_BYTES)
    return (
        session_stats(sessions)
        .groupBy("class")
        .agg(
            F.count("*").alias("n_sessions"),
            F.sum("n_pkts").alias("n_packets"),
            F.count_if(passed).alias("n_sessions_kept"),
            F.sum(F.when(passed, F.least("n_pkts", F.lit(k))).otherwise(0)).alias("n_packets_kept"),
        )
    )
