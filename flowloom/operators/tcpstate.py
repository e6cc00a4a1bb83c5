"""Running TCP state of a session: bytes in flight, bytes since PSH, window scale.

Meant for sessions already cut to their first packets; every window is over
``(class, flow_key)`` by ``pos``, the partitioning the cut left behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from flowloom.operators.sessions import KEY

SEQ_MODULUS = 1 << 32
SEQ_HALF = 1 << 31


def session_frame(first: int, last: int) -> WindowSpec:
    """Packets of the row's session from ``first`` to ``last``, counted from the row."""
    return Window.partitionBy(*KEY).orderBy("pos").rowsBetween(first, last)


def so_far() -> WindowSpec:
    return session_frame(Window.unboundedPreceding, 0)


def _relative(number: Column, base: Column) -> Column:
    """Signed distance of two 32-bit sequence numbers."""
    return F.pmod(number - base + SEQ_HALF, F.lit(SEQ_MODULUS)) - SEQ_HALF


def _per_direction(aggregate, value: Column, window, own: bool) -> Column:
    """``aggregate`` over the packets of the row's own direction, or of the other one."""
    forward = F.col("forward")
    ahead = aggregate(F.when(forward, value)).over(window)
    back = aggregate(F.when(~forward, value)).over(window)
    return F.when(forward, ahead if own else back).otherwise(back if own else ahead)


def with_tcp_state(packets: DataFrame) -> DataFrame:
    """Add ``in_order, overlap, stream_run, bytes_in_flight, push_bytes, window_scaled``.

    Needs ``seq, ack, tcp_len, is_ack, is_psh, is_syn, window, wscale``; rows of
    other protocols keep nulls. ``stream_run`` numbers gap-free stretches of one
    direction, ``in_order`` is false for a segment that brings no new bytes and
    ``overlap`` counts its leading bytes that came before.
    """
    first = lambda c: F.first(c, ignorenulls=True)
    has_data = F.col("tcp_len") > 0
    until_now = so_far()
    before = session_frame(Window.unboundedPreceding, -1)
    whole = session_frame(Window.unboundedPreceding, Window.unboundedFollowing)
    based = packets.withColumns(
        {
            "_base": _per_direction(first, F.col("seq"), whole, True),
            "_peer_base": _per_direction(first, F.col("seq"), whole, False),
            "_wscale": _per_direction(F.max, F.col("wscale"), whole, True),
            "_peer_wscale": _per_direction(F.max, F.col("wscale"), whole, False),
            "_sent": _per_direction(F.sum, F.col("tcp_len"), until_now, True),
        }
    )
    relative = based.withColumns(
        {
            "_seq": _relative(F.col("seq"), F.col("_base")),
            "_rel_ack": F.when(
                F.col("is_ack") == 1, _relative(F.col("ack"), F.col("_peer_base"))
            ),
        }
    )
    end = F.col("_seq") + F.col("tcp_len")
    running = relative.withColumns(
        {
            "_end_before": _per_direction(F.max, F.when(has_data, end), before, True),
            "_end_max": _per_direction(F.max, end, until_now, True),
            "_start": _per_direction(F.min, F.col("_seq"), until_now, True),
            "_acked": _per_direction(F.max, F.col("_rel_ack"), until_now, False),
            "_at_push": _per_direction(
                F.max, F.when(F.col("is_psh") == 1, F.col("_sent")), before, True
            ),
        }
    )
    in_flight = F.col("_end_max") - F.coalesce("_acked", "_start")
    zero = F.lit(0)
    # Scaling counts once both sides have offered it.
    scaled = F.col("_wscale").isNotNull() & F.col("_peer_wscale").isNotNull()
    return (
        running.withColumns(
            {
                "_gap": (has_data & (F.col("_seq") > F.col("_end_before"))).cast("int"),
                "in_order": has_data & F.coalesce(end > F.col("_end_before"), F.lit(True)),
                "overlap": F.greatest(
                    F.coalesce(F.col("_end_before") - F.col("_seq"), zero), zero
                ),
                "bytes_in_flight": F.when(has_data & (in_flight > 0), in_flight),
                "push_bytes": F.when(has_data, F.col("_sent") - F.coalesce("_at_push", zero)),
                "window_scaled": F.when(
                    scaled & (F.col("is_syn") == 0),
                    F.expr("shiftleft(window, cast(_wscale as int))"),
                ).otherwise(F.col("window")),
            }
        )
        .withColumn(
            "stream_run", F.coalesce(_per_direction(F.sum, F.col("_gap"), until_now, True), zero)
        )
        .drop(
            "_base", "_peer_base", "_wscale", "_peer_wscale", "_sent", "_seq", "_rel_ack",
            "_end_before", "_end_max", "_start", "_acked", "_at_push", "_gap",
        )
    )
