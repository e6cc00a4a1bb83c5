"""The 44 protocol fields of a packet as typed columns.

Byte offsets follow RFC 791 (IPv4), RFC 793 (TCP) and RFC 768 (UDP). Column
names are the field names with ``_`` for ``.``; times are kept in microseconds
(``*_us``) until they are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.bytefields import bit, hex_at, hex_literal, uint_at
from flowloom.operators.endpoints import TCP, UDP
from flowloom.operators.sessions import KEY
from flowloom.operators.tcpstate import with_tcp_state
from flowloom.operators.tlsrecords import with_tls_records

# The rendered fields, in rendering order.
FIELDS = [
    "frame.time_delta",
    "frame.time_relative",
    "frame.len",
    "frame.protocols",
    "ip.version",
    "ip.hdr_len",
    "ip.dsfield",
    "ip.dsfield.dscp",
    "ip.dsfield.ecn",
    "ip.len",
    "ip.flags",
    "ip.flags.df",
    "ip.flags.mf",
    "ip.ttl",
    "ip.proto",
    "tcp.srcport",
    "tcp.dstport",
    "tcp.len",
    "tcp.hdr_len",
    "tcp.flags",
    "tcp.flags.cwr",
    "tcp.flags.urg",
    "tcp.flags.ack",
    "tcp.flags.push",
    "tcp.flags.reset",
    "tcp.flags.syn",
    "tcp.flags.fin",
    "tcp.flags.str",
    "tcp.window_size",
    "tcp.time_relative",
    "tcp.time_delta",
    "tcp.analysis.bytes_in_flight",
    "tcp.analysis.push_bytes_sent",
    "tcp.reassembled.length",
    "tls.record.content_type",
    "tls.record.version",
    "tls.record.length",
    "tcp.payload",
    "udp.srcport",
    "udp.dstport",
    "udp.length",
    "udp.time_relative",
    "udp.time_delta",
    "udp.payload",
]
TEXT_FIELDS = {
    "frame.protocols",
    "ip.dsfield",
    "ip.flags",
    "tcp.flags",
    "tcp.flags.str",
    "tls.record.content_type",
    "tls.record.version",
    "tls.record.length",
    "tcp.payload",
    "udp.payload",
}
# One letter per TCP flag bit, from bit 11 down, and the mark of an unset bit.
FLAG_LETTERS = "RRRACEUAPRSF"
FLAG_UNSET = "·"

# IPv4 and TCP headers are at most 60 bytes each.
_HEADERS = 120
_IPV6_HEADER = 40
_OPTION_STEPS = 40


def column_of(field: str) -> str:
    """Column that holds ``field``."""
    name = field.replace(".", "_")
    return f"{name}_us" if ".time_" in field else name


HEADER_COLUMNS = [column_of(f) for f in FIELDS]
TEXT_COLUMNS = {column_of(f) for f in TEXT_FIELDS}


def _window_scale(options: Column) -> Column:
    """Shift of the window-scale option (kind 3) in the hex of the TCP options."""
    state = "struct<at:int,shift:int>"

    def pack(at: Column, shift: Column) -> Column:
        return F.struct(at.alias("at"), shift.alias("shift")).cast(state)

    none = F.lit(None).cast("int")

    def step(acc: Column, _: Column) -> Column:
        at = acc["at"]
        kind = uint_at(options, at, 1)
        return (
            F.when(acc["shift"].isNotNull() | kind.isNull() | (kind == 0), acc)
            .when(kind == 1, pack(at + 1, none))
            .when(kind == 3, pack(at, F.least(uint_at(options, at + 2, 1), F.lit(14))))
            .otherwise(pack(at + F.greatest(uint_at(options, at + 1, 1), F.lit(2)), none))
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_OPTION_STEPS)), pack(F.lit(0), none), step
    )["shift"]


def _flags_text(flags: Column) -> Column:
    top = len(FLAG_LETTERS) - 1
    return F.concat(
        *[
            F.when(flags.bitwiseAND(1 << (top - i)) != 0, letter).otherwise(FLAG_UNSET)
            for i, letter in enumerate(FLAG_LETTERS)
        ]
    )


def _with_layers(kept: DataFrame) -> DataFrame:
    """Raw header numbers, transport payload and per-session times."""
    h, t, o = F.col("_h"), F.col("_t"), F.col("_o")
    tcp, udp, v4 = F.col("proto") == TCP, F.col("proto") == UDP, F.col("ip_version") == 4
    by_pos = Window.partitionBy(*KEY).orderBy("pos")
    bytes_at = lambda at, n: F.substring("data", at + 1, F.lit(n))
    v6, network = F.col("ip_version") == 6, F.col("l4") - F.col("ip0")
    # Headers between the fixed IPv6 header and the transport header are left out.
    six = F.concat(bytes_at(F.col("ip0"), _IPV6_HEADER), bytes_at(F.col("l4"), _HEADERS - _IPV6_HEADER))
    cut = (
        kept.withColumn("_h", F.hex(F.when(v6, six).otherwise(bytes_at(F.col("ip0"), _HEADERS))))
        .withColumn("_o", F.when(v6, _IPV6_HEADER).otherwise(network))
        # Transport fields stay null unless the whole fixed header was captured.
        .withColumn("_t", F.when(F.length(h) >= (o + F.when(tcp, 20).otherwise(8)) * 2, h))
        .withColumns(
            {
                "time_delta_us": F.col("ts_us") - F.lag("ts_us", 1).over(by_pos),
                "time_relative_us": F.col("ts_us") - F.first("ts_us").over(by_pos),
            }
        )
    )
    # A length of zero marks segmentation offload: the rest of the frame is meant.
    named = cut.withColumn(
        "_ip_len",
        F.when(v4, uint_at(h, 2, 2)).when(v6, uint_at(h, 4, 2) + _IPV6_HEADER),
    ).withColumn("_thl", F.when(tcp, F.shiftright(uint_at(t, o + 12, 1), 4) * 4))
    rest = F.col("origlen") - F.col("l4")
    l4_len = F.when(F.col("_ip_len") > network, F.col("_ip_len") - network).otherwise(rest)
    measured = (
        named.withColumn("tcp_len", F.when(tcp, F.greatest(l4_len - F.col("_thl"), F.lit(0))))
        .withColumn("_udp_len", F.when(udp, uint_at(t, o + 4, 2)))
        .withColumn("_flags", F.when(tcp, uint_at(t, o + 12, 2).bitwiseAND(0xFFF)))
    )
    start = F.when(tcp, F.col("l4") + F.col("_thl")).when(udp, F.col("l4") + 8)
    length = F.when(tcp, F.col("tcp_len")).when(udp, F.greatest(F.col("_udp_len") - 8, F.lit(0)))
    flags = F.col("_flags")
    return (
        measured.withColumn(
            "payload_hex",
            F.lower(F.hex(F.substring("data", start.cast("int") + 1, length.cast("int")))),
        )
        .withColumn("seq", F.when(tcp, uint_at(t, o + 4, 4)))
        .withColumn("ack", F.when(tcp, uint_at(t, o + 8, 4)))
        .withColumn("window", F.when(tcp, uint_at(t, o + 14, 2)))
        .withColumn("is_ack", bit(flags, 0x10))
        .withColumn("is_psh", bit(flags, 0x08))
        .withColumn("is_syn", bit(flags, 0x02))
        .withColumn(
            "wscale",
            F.when(
                (F.col("is_syn") == 1) & (F.col("_thl") > 20),
                _window_scale(F.substring(t, (o + 20) * 2 + 1, (F.col("_thl").cast("int") - 20) * 2)),
            ),
        )
        .drop("data")
    )


def decode_headers(kept: DataFrame) -> DataFrame:
    """Add the 44 fields to packets that carry endpoints, ``flow_key`` and ``pos``.

    Feed it sessions cut to their first packets: the windows for times and TCP
    state hold one cut session at a time and reuse its partitioning.
    """
    layered = with_tls_records(with_tcp_state(_with_layers(kept)))
    h, flags = F.col("_h"), F.col("_flags")
    v4, tcp, udp = F.col("ip_version") == 4, F.col("proto") == TCP, F.col("proto") == UDP
    records = F.col("tls_records")
    some = F.size(records) > 0

    def of_v4(value: Column) -> Column:
        return F.when(v4, value)

    def listed(field: str) -> Column:
        return F.when(
            some, F.array_join(F.transform(records, lambda r: r[field].cast("string")), ",")
        )

    delta = F.coalesce("time_delta_us", F.lit(0))
    ds, ip_flags = uint_at(h, 1, 1), F.shiftright(uint_at(h, 6, 1), 5)
    # Ethernet has its network header at 14 or more; a cooked capture's lies at 16 or 20, between tags.
    ahead = F.when(F.col("ip0") == 0, "raw").when(F.col("ip0") == 4, "null")
    link = ahead.when(F.col("ip0").isin(16, 20), "sll:ethertype").otherwise(
        F.concat(F.lit("eth:ethertype"), F.repeat(F.lit(":vlan:ethertype"), F.col("vlan_tags")))
    )
    values = {
        "frame_time_delta_us": delta,
        "frame_time_relative_us": F.col("time_relative_us"),
        "frame_len": F.col("origlen"),
        "frame_protocols": F.concat_ws(
            ":",
            link,
            F.when(v4, "ip").otherwise("ipv6"),
            F.when(tcp, "tcp").when(udp, "udp"),
            F.when(some, "tls"),
        ),
        "ip_version": of_v4(F.shiftright(uint_at(h, 0, 1), 4)),
        "ip_hdr_len": of_v4(uint_at(h, 0, 1).bitwiseAND(15) * 4),
        "ip_dsfield": of_v4(hex_literal(ds, 2)),
        "ip_dsfield_dscp": of_v4(F.shiftright(ds, 2)),
        "ip_dsfield_ecn": of_v4(ds.bitwiseAND(3)),
        "ip_len": of_v4(F.col("_ip_len")),
        "ip_flags": of_v4(hex_literal(ip_flags, 2)),
        "ip_flags_df": of_v4(bit(ip_flags, 2)),
        "ip_flags_mf": of_v4(bit(ip_flags, 1)),
        "ip_ttl": of_v4(uint_at(h, 8, 1)),
        "ip_proto": of_v4(F.col("proto")),
        "tcp_srcport": F.when(tcp, F.col("src_port")),
        "tcp_dstport": F.when(tcp, F.col("dst_port")),
        "tcp_len": F.col("tcp_len"),
        "tcp_hdr_len": F.col("_thl"),
        "tcp_flags": hex_literal(flags, 4),
        "tcp_flags_cwr": bit(flags, 0x80),
        "tcp_flags_urg": bit(flags, 0x20),
        "tcp_flags_ack": bit(flags, 0x10),
        "tcp_flags_push": bit(flags, 0x08),
        "tcp_flags_reset": bit(flags, 0x04),
        "tcp_flags_syn": bit(flags, 0x02),
        "tcp_flags_fin": bit(flags, 0x01),
        "tcp_flags_str": F.when(tcp, _flags_text(flags)),
        "tcp_window_size": F.col("window_scaled"),
        "tcp_time_relative_us": F.when(tcp, F.col("time_relative_us")),
        "tcp_time_delta_us": F.when(tcp, delta),
        "tcp_analysis_bytes_in_flight": F.col("bytes_in_flight"),
        "tcp_analysis_push_bytes_sent": F.col("push_bytes"),
        "tcp_reassembled_length": F.col("reassembled_length"),
        "tls_record_content_type": listed("type"),
        "tls_record_version": listed("version"),
        "tls_record_length": listed("length"),
        "tcp_payload": F.when(tcp & (F.col("payload_hex") != ""), F.col("payload_hex")),
        "udp_srcport": F.when(udp, F.col("src_port")),
        "udp_dstport": F.when(udp, F.col("dst_port")),
        "udp_length": F.col("_udp_len"),
        "udp_time_relative_us": F.when(udp, F.col("time_relative_us")),
        "udp_time_delta_us": F.when(udp, delta),
        "udp_payload": F.when(udp & (F.col("payload_hex") != ""), F.col("payload_hex")),
    }
    passed = [c for c in kept.columns if c not in HEADER_COLUMNS and c != "data"]
    typed = [
        values[c].cast("string" if c in TEXT_COLUMNS else "bigint").alias(c) for c in HEADER_COLUMNS
    ]
    return layered.select(*passed, *typed)
