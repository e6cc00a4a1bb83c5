"""End-to-end jobs: sessions from raw captures, dataset build, re-split, train and evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.operators.endpoints import flow_key, is_forward, with_endpoints
from flowloom.operators.features import LATER_PART, join_features
from flowloom.operators.headers import decode_headers
from flowloom.operators.labelling import (
    DEFAULT_TASK,
    GRANULARITY,
    TASK_OF_DATASET,
    TASK_TEMPLATES,
    dataset_rows,
    label_dictionary,
    template_of,
)
from flowloom.operators.modelling import fit_select, report, save_model
from flowloom.operators.render import packet_text, session_text, with_feature_text
from flowloom.operators.sessions import (
    CAPTURE_ORDER,
    FIRST_PACKETS,
    KEY,
    MIN_CAPTURE_BYTES,
    MIN_PACKETS,
    kept_packets,
)
from flowloom.operators.splitting import MAX_PER_CLASS, SEED, split_assign
from flowloom.plans.ranks import slice_positions
from flowloom.plans.staging import leaves_nothing, stage_table
from flowloom.sources.captures import (
    PART_BYTES,
    fetch_packets,
    first_packets_of_files,
    good_packets,
    index_captures,
    place_sessions,
    quarantine,
    write_session_files,
)
from flowloom.sources.datasets import (
    read_dataset,
    write_dataset,
    write_dataset_csv,
    write_labels,
    write_split_files,
)

_ENDS = ["proto", "src_ip", "src_port", "dst_ip", "dst_port"]


def packet_index(
    spark: SparkSession, input_path: str, class_from: str = "file", filesystem: str | None = None
) -> DataFrame:
    """Packets of raw captures with their endpoints and their place in the file, and a row per unreadable file.

    The class is the base name of a capture; with ``class_from="directory"`` a folder holds all captures of a class,
    such as rotated ones. Captures are read once, and the staged table is narrow: totals, positions, the choice of
    packets and the count of what is left out run on it, and bytes are fetched for the packets that are chosen.
    """

    def shape(rows: DataFrame) -> DataFrame:
        return with_endpoints(rows).select(*rows.columns, "ip_version", *_ENDS, "l4")

    return index_captures(spark, input_path, class_from, shape, filesystem=filesystem)


def sessions_of_index(index: DataFrame) -> DataFrame:
    """The packets of a :func:`packet_index` that have ports, with their session."""
    ends = [F.col(c) for c in ("src_ip", "src_port", "dst_ip", "dst_port")]
    known = good_packets(index).where(F.col("l4").isNotNull())
    keyed = known.withColumn("flow_key", flow_key(*ends, F.col("proto"))).withColumn("forward", is_forward(*ends))
    return keyed.drop("ip_version", "l4", *_ENDS)


def session_index(
    spark: SparkSession, input_path: str, class_from: str = "file", filesystem: str | None = None
) -> DataFrame:
    """Packets of raw captures with their session and their place in the file, without their bytes."""
    return sessions_of_index(packet_index(spark, input_path, class_from, filesystem))


def left_out(index: DataFrame) -> DataFrame:
    """``class, capture, capture_pos, reason`` of what a :func:`packet_index` has that no session takes.

    One row per unreadable or damaged capture, with the place where reading stopped, and
    one per packet that is no TCP or UDP packet of a known link type.
    """
    damaged = quarantine(index).select("class", "capture", "capture_pos", F.col("error").alias("reason"))
    unknown = good_packets(index).where(F.col("l4").isNull())
    reason = F.when(F.col("ip_version").isNull(), "no IP packet of a known link type").otherwise("no TCP or UDP ports")
    return damaged.unionByName(unknown.select("class", "capture", "capture_pos", reason.alias("reason")))


def _count_reasons(rows: DataFrame) -> DataFrame:
    return rows.groupBy("class", "reason").agg(F.count("*").alias("n"))


def _with_bytes(index: DataFrame, filesystem: str | None) -> DataFrame:
    """Indexed packets with their bytes and what is decoded from them."""
    return with_endpoints(fetch_packets(index, filesystem))


@leaves_nothing
def split_captures(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    class_from: str = "file",
    part_bytes: int = PART_BYTES,
    filesystem: str | None = None,
) -> None:
    """Cut raw captures into session files, ``<class>/<class>.pcap.<PROTO>_<ip>_<port>_<ip>_<port>.pcap``.

    Packets are ordered on the index, so bytes move once, to the task that writes their file. Counts by class and
    reason of what was left out come from the same index, and go to ``_left_out`` beside the files.
    """
    index = packet_index(spark, input_path, class_from, filesystem)
    placed = place_sessions(sessions_of_index(index), CAPTURE_ORDER, part_bytes)
    # The source's name gives way to that of the session file; the place in the source stays.
    write_session_files(fetch_packets(placed, filesystem), output_path, filesystem)
    _count_reasons(left_out(index)).write.mode("overwrite").parquet(f"{output_path}/_left_out")


def packets_of_captures(
    spark: SparkSession, input_path: str, class_from: str = "file", filesystem: str | None = None
) -> DataFrame:
    """Kept packets of raw captures: chosen on the index, and their bytes alone fetched."""
    return _with_bytes(kept_packets(session_index(spark, input_path, class_from, filesystem)), filesystem)


def packets_of_session_files(spark: SparkSession, flow_path: str, filesystem: str | None = None) -> DataFrame:
    """Kept packets of ``flow/<class>/*.pcap``, one session per file.

    The size filter runs on the file listing (of compressed files, on the length that their end tells), and a file is
    read no further than the last packet needed, whatever its size. The key of a session is its file's name: files of
    the same endpoints stay apart, and so do files whose names tell no endpoints, which get no statistics. Later parts
    of a session are not read.
    """
    files = first_packets_of_files(
        spark, flow_path, max_packets=FIRST_PACKETS, min_bytes=MIN_CAPTURE_BYTES, filesystem=filesystem
    )
    packets = good_packets(files).where(~F.col("capture").rlike(LATER_PART))
    keyed = packets.withColumn("flow_key", F.col("capture")).withColumn(
        "pos", (F.col("capture_pos") + 1).cast("int")
    )
    ends = [F.col(c) for c in ("src_ip", "src_port", "dst_ip", "dst_port")]
    counted = with_endpoints(keyed).withColumn("forward", is_forward(*ends))
    size = F.count("*").over(Window.partitionBy(*KEY))
    return counted.withColumn("n_pkts", size).where(F.col("n_pkts") >= MIN_PACKETS)


def write_quarantine(
    spark: SparkSession, input_path: str, output_path: str, class_from: str = "directory", filesystem: str | None = None
) -> DataFrame:
    """Write what the jobs leave out of the captures below ``input_path`` (:func:`left_out`), and return counts by class and reason."""
    left_out(packet_index(spark, input_path, class_from, filesystem)).write.mode("overwrite").parquet(output_path)
    return _count_reasons(spark.read.parquet(output_path))


def session_records(kept: DataFrame, statistics: DataFrame) -> DataFrame:
    """``class, flow_key, n_pkts, features, text`` of every kept session."""
    texts = session_text(packet_text(decode_headers(kept)))
    joined = join_features(texts, statistics)
    return with_feature_text(joined, F.col("features")).drop("packets_text")


@leaves_nothing
def build_dataset(
    kept: DataFrame,
    statistics: DataFrame,
    dataset_name: str,
    output_path: str,
    task_templates: list[tuple[str, str, str]] = TASK_TEMPLATES,
    granularity: str = GRANULARITY,
    cap: int = MAX_PER_CLASS,
    seed: int = SEED,
    small: str = "replicate",
    csv: bool = False,
) -> None:
    """Write ``data`` (every session), ``splits`` and ``label.tsv`` below ``output_path``.

    ``csv`` adds ``data.tsv, train.tsv, val.tsv, test.tsv``. The rendered sessions are written first: class ids, splits and rows read
    that table, each only the columns it needs.
    """
    spark = kept.sparkSession
    records = stage_table(session_records(kept, statistics), "sessions")
    labels = stage_table(label_dictionary(records), "labels")
    write_labels(labels, f"{output_path}/label.tsv")
    task = TASK_OF_DATASET.get(dataset_name, DEFAULT_TASK)
    template = template_of(task, task_templates, granularity)
    dataset_rows(records, labels, template, granularity).write.mode("overwrite").parquet(
        f"{output_path}/data"
    )
    rows = spark.read.parquet(f"{output_path}/data")
    if csv:
        write_dataset_csv(rows, f"{output_path}/data.tsv")
    write_splits(rows, output_path, "class", KEY, cap, seed, small, csv)


@leaves_nothing
def write_splits(
    rows: DataFrame,
    output_path: str,
    by: str,
    key: list[str],
    cap: int = MAX_PER_CLASS,
    seed: int = SEED,
    small: str = "replicate",
    csv: bool = False,
) -> None:
    """Assign splits on ``by`` and ``key`` alone, then fetch the chosen rows."""
    chosen = split_assign(rows.select(*dict.fromkeys([by, *key])), by, key, cap, seed, small)
    picked = rows.join(stage_table(chosen, "splits"), list(dict.fromkeys([by, *key])))
    write_dataset(picked, f"{output_path}/splits", list(dict.fromkeys([by, *key])))
    if csv:
        write_split_files(read_dataset(rows.sparkSession, f"{output_path}/splits"), output_path)


@leaves_nothing
def resplit_dataset(
    rows: DataFrame, output_path: str, cap: int = MAX_PER_CLASS, seed: int = SEED, csv: bool = False
) -> None:
    """Split a stored dataset anew by its ``labels``; rows without a label are left out.

    Rows with a ``flow_key`` keep it as their key. Otherwise the key is the digest
    of the row and its number among equal rows; equal rows are numbered partition
    by partition, so very many copies of one row are no hot group.
    """
    if "flow_key" in rows.columns:
        write_splits(rows, output_path, "labels", KEY, cap, seed, csv=csv)
        return
    text = F.to_json(F.struct("inputs", "labels", "str_labels"))
    staged = stage_table(
        rows.withColumn("_digest", F.md5(text)).withColumn("_part", F.spark_partition_id()), "rows"
    )
    numbered = slice_positions(staged, ["_digest"], ["_part"], "_copy")
    write_splits(
        numbered.drop("_part"), output_path, "labels", ["_digest", "_copy"], cap, seed, csv=csv
    )


def train_and_evaluate(
    dataset: DataFrame, key: list[str], model_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fit on ``train``, choose on ``val``; metrics and confusion matrix by split, of ``val`` and ``test``."""
    model, _, _ = fit_select(dataset, key)
    if model_path is not None:
        save_model(model, model_path)
    return report(model, dataset, key)
