"""Input views derived from the given tables by Spark.

``lineitem`` rows become packets: each row yields one Ethernet frame whose
header values are functions of the row, so that decoding the bytes can be
checked against the row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.endpoints import TCP, UDP
from flowloom.operators.sessions import assign_sessions
from flowloom.plans.staging import stage_table

PACKET_ORDER = ["ts_us", "pkt_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Header values of a packet as SQL that both engines read alike.
PACKET_COLUMNS = {
    "proto": "case when l_linestatus = 'F' then 6 else 17 end",
    "caplen": "cast(60 + l_quantity * 20 as int)",
    "src_ip": "case when l_orderkey % 2 = 0 then concat('10.0.0.', cast(l_partkey % 20 as string))"
    " else concat('10.0.1.', cast(l_suppkey % 20 as string)) end",
    "src_port": "cast(case when l_orderkey % 2 = 0 then 1000 + l_linenumber else 443 end as int)",
    "dst_ip": "case when l_orderkey % 2 = 0 then concat('10.0.1.', cast(l_suppkey % 20 as string))"
    " else concat('10.0.0.', cast(l_partkey % 20 as string)) end",
    "dst_port": "cast(case when l_orderkey % 2 = 0 then 443 else 1000 + l_linenumber end as int)",
    "pkt_key": "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string),"
    " cast(l_partkey as string), cast(l_suppkey as string),"
    " cast(cast(l_shipdate as date) as string))",
    "day_us": "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) * 1000003"
    " % 86400000000",
    "digest": "substr(repeat(md5(concat(cast(l_orderkey as string), '/',"
    " cast(l_partkey as string))), 8), 1, cast(l_quantity * 4 as int))",
    "vlan": "case when l_suppkey % 7 = 0 then 1 else 0 end",
    "tos": "(l_partkey % 64) * 4 + l_suppkey % 4",
    "df": "case when l_orderkey % 3 = 0 then 0 else 1 end",
    "ttl": "40 + l_linenumber",
    "syn": "case when l_linenumber = 1 and l_orderkey % 5 < 2 then 1 else 0 end",
    "fin": "case when l_linenumber = 7 then 1 else 0 end",
    "rst": "case when l_orderkey % 17 = 0 then 1 else 0 end",
    "psh": "case when l_orderkey % 4 < 2 then 1 else 0 end",
    "ackf": "case when l_linenumber = 1 and l_orderkey % 10 = 0 then 0 else 1 end",
    "urg": "case when l_partkey % 13 = 0 then 1 else 0 end",
    "cwr": "case when l_partkey % 11 = 0 then 1 else 0 end",
    "win": "1000 + l_partkey * 30 % 60000",
    "shift": "case when l_linenumber = 1 and l_orderkey % 5 < 2 then l_suppkey % 9 end",
    "tls_kind": "l_suppkey % 3",
}
# Sequence numbers grow with time, 200 a minute; acknowledgements lag behind by up to 5 days.
SEQ = "ts_us // 60000000 * 200"
ACK = "ts_us // 60000000 * 200 - l_partkey % 5 * 288000"


def _hex(pattern: str, *values: str) -> Column:
    """Hex digits of SQL integers by a format such as ``%02X%04X``; null where one of them is null."""
    parts, rest = [], iter(values)
    for text, width in re.findall(r"([^%]+)|%0(\d)X", pattern):
        digits = F.lit(text) if text else F.hex(F.expr(next(rest)).cast("bigint"))
        # Wider numbers keep all their digits.
        parts.append(digits if text else F.lpad(digits, F.greatest(F.length(digits), F.lit(int(width))), F.lit("0")))
    return F.concat(*parts)


def _apart(rows: DataFrame) -> DataFrame:
    """The same rows, with their columns ready: what is made of them later is code of its own, short enough for the JVM to compile."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def packet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header values and payload of each packet, without the frame."""
    # The table may be one row group, which is one task; packets are made from rows dealt out by key.
    base = table(spark, sf_dir, "lineitem").repartition("l_orderkey", "l_linenumber").select(
        "*", F.col("l_returnflag").alias("class"),
        *[F.expr(sql).alias(name) for name, sql in PACKET_COLUMNS.items()],
    )
    day = F.expr("datediff(cast(l_shipdate as date), date'1970-01-01')").cast("bigint")
    timed = base.withColumn("ts_us", day * 86_400_000_000 + F.col("day_us"))
    div = lambda sql: F.expr(sql.replace("//", "div"))
    raw = F.concat(F.lit("ff"), F.expr("substr(digest, 3)"))
    record = F.concat(_hex("%04X", "length(digest) div 2"), F.col("digest"))
    tls = (
        F.when(F.col("tls_kind") == 0, F.concat(F.lit("160303"), record))
        .when(F.col("tls_kind") == 1, F.concat(F.lit("140301000101170303"), record))
        .otherwise(raw)
    )
    return (
        timed.withColumn("seq", div(SEQ))
        .withColumn("ack", div(ACK))
        .withColumn("payload", F.when(F.col("proto") == TCP, tls).otherwise(F.col("digest")))
    )


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """A derived table, written once per application and read by every query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = stage_table(build(spark, sf_dir), name, "zstd")
    return _STAGED[key]


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured packets of all ``lineitem`` rows."""
    return staged(spark, sf_dir, "frames", build_frames)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same packets with their session, staged as the dataset job stages them."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Frames are not written for this alone; where another query has written them, they are read.
        known = (spark.sparkContext.applicationId, sf_dir, "frames") in _STAGED
        return assign_sessions((frames if known else build_frames)(spark, sf_dir))

    return staged(spark, sf_dir, "sessions", build)


def build_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets as captured: ``class, capture, pkt_key, ts_us, caplen, origlen, data``.

    Frames are zero-padded to ``caplen`` as Ethernet pads short frames.
    """
    values = packet_rows(spark, sf_dir).withColumn("hdr", F.expr("case when syn = 1 then 24 else 20 end"))
    rows = _apart(values.select(
        "class", "pkt_key", "ts_us", "caplen", "l_orderkey", "proto", "hdr", "payload", "vlan", "tos", "df", "ttl", "src_ip",
        "dst_ip", "src_port", "dst_port", "seq", "ack", "cwr", "urg", "ackf", "psh", "rst", "syn", "fin", "win", "shift",
    ))
    addresses = [f"substring_index(substring_index({c}, '.', {i + 1}), '.', -1)" for c in ("src_ip", "dst_ip") for i in range(4)]
    l4_bytes = f"(case when proto = {TCP} then hdr else 8 end + length(payload) div 2)"
    ethernet = F.when(F.col("vlan") == 1, "020000000002020000000001810000050800").otherwise(
        "0200000000020200000000010800"
    )
    ip = _hex(
        "45%02X%04X%04X%04X%02X%02X0000" + "%02X" * 8,
        "tos", f"20 + {l4_bytes}", "l_orderkey % 65536", "df * 16384", "ttl", "proto", *addresses,
    )
    tcp = F.concat(
        _hex(
            "%04X%04X%08X%08X%02X%02X%04X00000000",
            "src_port", "dst_port", "seq", "ack", "hdr div 4 * 16",
            "cwr * 128 + urg * 32 + ackf * 16 + psh * 8 + rst * 4 + syn * 2 + fin", "win",
        ),
        F.when(F.col("syn") == 1, _hex("010303%02X", "shift")).otherwise(""),
    )
    udp = _hex("%04X%04X%04X0000", "src_port", "dst_port", l4_bytes)
    passed = ["class", "pkt_key", "ts_us", "caplen"]
    networked = _apart(rows.withColumn("_ip", F.concat(ethernet, ip)))
    transport = F.when(F.col("proto") == TCP, tcp).when(F.col("proto") == UDP, udp)
    framed = _apart(networked.select(*passed, F.concat("_ip", transport, "payload").alias("frame")))
    frame, digits = F.col("frame"), F.col("caplen") * 2
    # A repeated zero is copied in blocks, rpad copies digit by digit.
    zeros = F.expr("repeat('0', caplen * 2 - length(frame))")
    padded = F.when(F.length(frame) > digits, F.substring(frame, F.lit(1), digits)).otherwise(F.concat(frame, zeros))
    return framed.select(
        "class",
        F.concat("class", F.lit(".pcap")).alias("capture"),
        "pkt_key",
        "ts_us",
        "caplen",
        F.col("caplen").alias("origlen"),
        F.unhex(padded).alias("data"),
    )


def session_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session file names, one per direction seen."""
    name = F.concat(
        F.col("class"), F.lit(".pcap."), F.when(F.col("proto") == TCP, "TCP").otherwise("UDP"),
        F.lit("_"), F.replace("src_ip", F.lit("."), F.lit("-")), F.lit("_"), F.col("src_port"),
        F.lit("_"), F.replace("dst_ip", F.lit("."), F.lit("-")), F.lit("_"), F.col("dst_port"),
        F.lit(".pcap"),
    )
    return packet_rows(spark, sf_dir).select(name.alias("file_name")).distinct()


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per directional session id; ids whose digest starts with 0 are left out.

    The smallest packet key of an id stands for its row number in the file.
    """
    flow_id = F.concat_ws("-", "src_ip", "dst_ip", "src_port", "dst_port", "proto")
    grouped = (
        packet_rows(spark, sf_dir)
        .withColumn("Flow ID", flow_id)
        .groupBy("class", "Flow ID", "src_ip", "proto")
        .agg(
            F.min("pkt_key").alias("row_no"),
            F.count("*").alias("Tot Pkts"),
            F.sum("caplen").alias("Tot Bytes"),
            F.min("ts_us").alias("Timestamp"),
        )
    )
    n, total = F.col("Tot Pkts"), F.col("Tot Bytes")
    return grouped.where(~F.md5("Flow ID").startswith("0")).select(
        "class", "row_no", "Flow ID", F.col("src_ip").alias("Src IP"),
        F.col("proto").alias("Protocol"), "Timestamp", "Tot Pkts", "Tot Bytes",
        (total / n).alias("Mean Bytes"),
        (total.cast("double") * 4096).alias("Bulk"),
        (n / F.lit(8192.0)).alias("Rate"),
        (n / F.lit(1048576.0)).alias("Small Rate"),
        F.when(n % 5 != 0, total.cast("double")).alias("Idle"),
        F.when(F.col("proto") == TCP, "stream").otherwise("datagram").alias("Kind"),
        F.lit("BENIGN").alias("Label"),
    )


def named_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one of nine dataset names each, two of them unknown to the task table."""
    names = [
        "ustc-tfc-2016", "iscx-botnet", "iscx-vpn-2016", "lfett-2021", "dohbrw-2020",
        "iscx-tor-2016", "dapt-2020", "cross-platform", "other",
    ]
    chosen = F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("doc_id") % 9 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", chosen.alias("dataset_name"))
