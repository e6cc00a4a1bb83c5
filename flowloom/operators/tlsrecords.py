"""TLS records of a packet, walked over the contiguous bytes of its direction.

A record counts for the packet that completes it. A header that is not TLS ends
the walk of its packet; the walk goes on at the next packet boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.bytefields import hex_at, uint_at
from flowloom.operators.tcpstate import so_far

# TLS record header layout and limits.
HEADER_BYTES = 5
FIRST_TYPE, LAST_TYPE = 20, 24
MAJOR_VERSION = "03"
MAX_RECORD_BYTES = (1 << 14) + 2048

_SHORT_WALK = 32
_RECORD = "struct<type:int,version:string,length:int,start:int,end:int>"
_STATE = f"struct<at:int,records:array<{_RECORD}>,done:boolean>"


def _walk(stream: Column, total: Column, ends: Column, steps: Column) -> Column:
    """Fold ``steps`` record steps over the hex ``stream``; ``ends`` are packet ends in bytes."""

    def state(at: Column, records: Column, done: bool) -> Column:
        return F.struct(at.alias("at"), records.alias("records"), F.lit(done).alias("done")).cast(
            _STATE
        )

    def step(acc: Column, _: Column) -> Column:
        at = acc["at"]
        kind = uint_at(stream, at, 1)
        length = uint_at(stream, at + 3, 2)
        valid = (
            kind.between(FIRST_TYPE, LAST_TYPE)
            & (hex_at(stream, at + 1, 1) == MAJOR_VERSION)
            & (length <= MAX_RECORD_BYTES)
        )
        end = at + HEADER_BYTES + length
        record = F.struct(
            kind.alias("type"),
            F.concat(F.lit("0x"), hex_at(stream, at + 1, 2)).alias("version"),
            length.alias("length"),
            at.alias("start"),
            end.alias("end"),
        ).cast(_RECORD)
        next_packet = F.coalesce(F.array_min(F.filter(ends, lambda e: e > at)), total)
        return (
            F.when(acc["done"], acc)
            .when(at + HEADER_BYTES > total, state(at, acc["records"], True))
            .when(~valid, state(next_packet, acc["records"], False))
            .when(end > total, state(at, acc["records"], True))
            .otherwise(state(end, F.array_append(acc["records"], record), False))
        )

    start = state(F.lit(0), F.array().cast(f"array<{_RECORD}>"), False)
    return F.aggregate(F.sequence(F.lit(1), steps), start, step)


def with_tls_records(packets: DataFrame) -> DataFrame:
    """Add ``tls_records`` (completed by the packet) and ``reassembled_length``.

    Needs ``payload_hex`` and the columns of :func:`with_tcp_state`; meant for
    sessions cut to their first packets, whose payloads fit in one row.
    """
    fresh = F.when(
        F.col("in_order"),
        F.struct(
            F.col("stream_run").alias("run"),
            F.substring("payload_hex", F.col("overlap").cast("int") * 2 + 1, F.length("payload_hex"))
            .alias("bytes"),
        ),
    )
    ahead = F.collect_list(F.when(F.col("forward"), fresh)).over(so_far())
    back = F.collect_list(F.when(~F.col("forward"), fresh)).over(so_far())
    own = F.when(F.col("forward"), ahead).otherwise(back)
    size = lambda s: (F.length(s) / 2).cast("int")
    segments = F.transform(
        F.filter("_own", lambda s: s["run"] == F.col("stream_run")), lambda s: s["bytes"]
    )
    total, ends = F.col("_total"), F.col("_ends")
    # Every step passes a packet end or a record header, so this many always suffice.
    enough = F.floor(total / HEADER_BYTES).cast("int") + F.size(ends) + 1
    finished = F.col("_short")["done"] | (F.col("_short")["at"] >= total)
    return (
        packets.withColumn("_own", own)
        .withColumn("_segments", F.when(F.col("in_order"), segments))
        .withColumn("_stream", F.array_join("_segments", ""))
        .withColumn("_total", size(F.col("_stream")))
        .withColumn(
            "_ends",
            F.aggregate(
                "_segments",
                F.array().cast("array<int>"),
                lambda acc, s: F.array_append(acc, F.coalesce(F.array_max(acc), F.lit(0)) + size(s)),
            ),
        )
        .withColumn("_own_start", total - size(F.element_at("_segments", -1)))
        .withColumn(
            "_short",
            F.when(
                total > 0,
                _walk(F.col("_stream"), total, ends, F.least(enough, F.lit(_SHORT_WALK))),
            ),
        )
        .withColumn(
            "_walked",
            F.when(finished, F.col("_short")).when(
                total > 0, _walk(F.col("_stream"), total, ends, enough)
            ),
        )
        .withColumn(
            "tls_records",
            F.filter(F.col("_walked")["records"], lambda r: r["end"] > F.col("_own_start")),
        )
        .withColumn(
            "reassembled_length",
            F.get(
                F.transform(
                    F.filter("tls_records", lambda r: r["start"] < F.col("_own_start")),
                    lambda r: r["end"] - r["start"],
                ),
                F.lit(0),
            ),
        )
        .drop(
            "_own", "_segments", "_stream", "_total", "_ends", "_own_start", "_short", "_walked"
        )
    )
