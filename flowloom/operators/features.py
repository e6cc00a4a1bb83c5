"""Session statistics: file names, matching to sessions and feature text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.numbertext import named_values, with_value_texts
from flowloom.operators.endpoints import TCP, UDP, flow_key
from flowloom.operators.sessions import KEY

# Statistics columns that identify a session and are not features.
EXCLUDED_COLUMNS = [
    "Flow ID",
    "Src IP",
    "Src Port",
    "Dst IP",
    "Dst Port",
    "Protocol",
    "Timestamp",
    "Flow Duration",
    "Label",
]
FLOW_ID = "Flow ID"
# Fixed value: <class>.pcap.<PROTO>_<ip>_<port>_<ip>_<port>.pcap, dashes for dots (or colons) in addresses.
FILE_NAME = r"^(.*)\.pcap\.([^._]+)_([^_]+)_([0-9]+)_([^_]+)_([0-9]+)\.pcap$"
# A further part of a session's packets in a file of its own.
LATER_PART = r"\.pcap\.part[0-9]+\.pcap$"
# Fixed value: <ip>-<ip>-<port>-<port>-<protocol>.
FLOW_ID_PATTERN = r"^([^-]+)-([^-]+)-([0-9]+)-([0-9]+)-([0-9]+)$"


def protocol_number(name: Column) -> Column:
    """6 for TCP, 17 for anything else."""
    return F.when(name == "TCP", TCP).otherwise(UDP)


def _address(dashed: Column) -> Column:
    """The address of a file name: eight parts are IPv6, with colons, others have dots."""
    colons = F.length(dashed) - F.length(F.replace(dashed, F.lit("-"))) == 7
    return F.when(colons, F.translate(dashed, "-", ":")).otherwise(F.translate(dashed, "-", "."))


def parse_flow_name(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Split a session file name; adds ``class, proto, src_ip … dst_port, flow_key``.

    The pattern is anchored on the protocol part, so dots in the class name are fine.
    """

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(name, FILE_NAME, i), F.lit(""))

    return (
        files.withColumn("class", part(1))
        .withColumn("proto", protocol_number(part(2)))
        .withColumn("src_ip", _address(part(3)))
        .withColumn("src_port", part(4).try_cast("int"))
        .withColumn("dst_ip", _address(part(5)))
        .withColumn("dst_port", part(6).try_cast("int"))
        .withColumn(
            "flow_key",
            flow_key(*[F.col(c) for c in ("src_ip", "src_port", "dst_ip", "dst_port", "proto")]),
        )
    )


def file_key(name: Column) -> Column:
    """Direction-free key of the endpoints in a session file's name."""

    def part(i: int) -> Column:
        return F.regexp_extract(name, FILE_NAME, i)

    return flow_key(
        _address(part(3)), part(4).try_cast("int"), _address(part(5)), part(6).try_cast("int"), protocol_number(part(2))
    )


def flow_id_key(flow_id: Column) -> Column:
    """Direction-free form of a statistics id; text of another shape is its own key."""

    def part(i: int) -> Column:
        return F.regexp_extract(flow_id, FLOW_ID_PATTERN, i)

    canonical = flow_key(
        part(1), part(3).try_cast("int"), part(2), part(4).try_cast("int"), part(5)
    )
    return F.when(flow_id.rlike(FLOW_ID_PATTERN), canonical).otherwise(flow_id)


def feature_columns(statistics: DataFrame) -> list[str]:
    """Statistics columns to render, in file order."""
    skipped = {*EXCLUDED_COLUMNS, *KEY, "row_no"}
    return [c for c in statistics.columns if c not in skipped]


def _listed(statistics: DataFrame) -> bool:
    """Whether rows come as lists of names and texts, each row with its own columns."""
    return {"names", "texts"} <= set(statistics.columns)


def _flow_id(statistics: DataFrame) -> Column:
    if _listed(statistics):
        return F.get("texts", (F.array_position("names", FLOW_ID) - 1).cast("int"))
    return F.col(f"`{FLOW_ID}`")


def _listed_text() -> Column:
    pairs = F.filter(
        F.arrays_zip(F.col("names").alias("name"), F.col("texts").alias("text")),
        lambda p: ~p["name"].isin(EXCLUDED_COLUMNS),
    )
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit(": "), p["text"])), ", ")


def feature_text(statistics: DataFrame, keep: list[str] = []) -> DataFrame:
    """``class, flow_id, row_no, features``: every feature as ``column: value``, ``, `` between."""
    if _listed(statistics):
        return statistics.select(
            "class", *keep, _flow_id(statistics).alias("flow_id"), "row_no", _listed_text().alias("features")
        )
    names = feature_columns(statistics)
    return with_value_texts(statistics, names, "_values").select(
        "class",
        *keep,
        F.col(f"`{FLOW_ID}`").alias("flow_id"),
        "row_no",
        named_values(names, F.col("_values")).alias("features"),
    )


def first_features(statistics: DataFrame) -> DataFrame:
    """One row per session key: the features of its first row in file order, either direction.

    ``min_by`` combines before the shuffle, so an id with very many rows stays
    cheap, and only the rows that remain are rendered.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in statistics.columns if c != "class"])
    first = (
        statistics.withColumn("flow_key", flow_id_key(_flow_id(statistics)))
        .groupBy(*KEY)
        .agg(F.min_by(row, "row_no").alias("_row"))
        .select(*KEY, "_row.*")
    )
    return feature_text(first, ["flow_key"]).select(*KEY, "features")


def join_features(sessions: DataFrame, statistics: DataFrame) -> DataFrame:
    """Add ``features``; sessions without statistics get an empty text.

    A session that is a file of its own has the file's name as its key; its
    statistics are found by the endpoints in that name. Several files of one pair of
    endpoints share a row of statistics, which then is a key of few sessions.
    """
    by_name = F.regexp_extract("flow_key", FILE_NAME, 0) != ""
    key = F.when(by_name, file_key(F.col("flow_key"))).otherwise(F.col("flow_key"))
    first = first_features(statistics).withColumnRenamed("flow_key", "_key")
    return (
        sessions.withColumn("_key", key)
        .join(first, ["class", "_key"], "left")
        .withColumn("features", F.coalesce("features", F.lit("")))
        .select(*sessions.columns, "features")
    )
