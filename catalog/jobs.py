"""The registered queries: each runs an operator of the library over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures
from catalog.fixtures import PACKET_ORDER, table
from flowloom.functions.numbertext import seconds_text
from flowloom.operators import evaluation, features, labelling, render, splitting, tokens
from flowloom.operators.endpoints import with_endpoints
from flowloom.operators.headers import HEADER_COLUMNS, decode_headers
from flowloom.operators.modelling import fit_select as fit_and_select
from flowloom.operators.modelling import score_splits
from flowloom.operators.sessions import (
    KEY,
    assign_sessions,
    class_report as report_classes,
    first_packets as take_first_packets,
    kept_packets,
    session_positions,
    session_stats,
    surviving_sessions,
)
from flowloom.plans.jobs import packets_of_session_files, session_index, session_records
from flowloom.plans.ranks import slice_positions
from flowloom.plans.staging import fresh_path, stage_table
from flowloom.sources import statistics
from flowloom.sources.captures import (
    fetch_packets,
    place_sessions,
    write_class_captures,
    write_session_files,
)
from flowloom.sources.datasets import (
    read_dataset,
    read_dataset_csv,
    write_dataset,
    write_dataset_csv,
)

TIMING = [c for c in HEADER_COLUMNS if c.endswith("_us")]


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_sessions(fixtures.frames(spark, sf_dir))


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_packets(fixtures.sessions(spark, sf_dir), PACKET_ORDER)


def _first_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_headers(
        take_first_packets(fixtures.sessions(spark, sf_dir), PACKET_ORDER)
    )


def _ints(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def session_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_stats(_sessions(spark, sf_dir))


def session_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranges are sampled, so rows are read twice: decoded once, and without their bytes.
    narrow = stage_table(_sessions(spark, sf_dir).select(*KEY, *PACKET_ORDER), "order")
    ordered = session_positions(narrow, PACKET_ORDER)
    return ordered.select(*KEY, "pkt_key", F.col("pos").cast("bigint").alias("pos"))


def first_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = take_first_packets(_sessions(spark, sf_dir), PACKET_ORDER)
    return _ints(first, "pos", "proto").select(
        *KEY, "pos", "pkt_key", "ts_us", "proto", "src_ip", "dst_ip", "forward"
    )


def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _kept(spark, sf_dir)
        .groupBy(*KEY)
        .agg(
            F.count("*").alias("n_kept"),
            F.max("n_pkts").alias("n_pkts"),
            F.max("size_bytes").alias("size_bytes"),
        )
    )


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_classes(_sessions(spark, sf_dir))


def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [c for c in HEADER_COLUMNS if c != "tcp_flags_str"]
    letters = F.replace("tcp_flags_str", F.lit("·"), F.lit("-")).alias("tcp_flags_str")
    return _ints(_first_headers(spark, sf_dir), "pos").select(*KEY, "pos", *fields, letters)


def packet_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _ints(_first_headers(spark, sf_dir), "pos")
    return timed.select(*KEY, "pos", *[seconds_text(F.col(c)).alias(c[:-3]) for c in TIMING])


def tcp_running_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    tcp = _first_headers(spark, sf_dir).where(F.col("tcp_len").isNotNull())
    return _ints(tcp, "pos").select(
        *KEY, "pos", "tcp_len", "tcp_window_size", "tcp_analysis_bytes_in_flight",
        "tcp_analysis_push_bytes_sent",
    )


def packet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = render.packet_text(decode_headers(_kept(spark, sf_dir)))
    return _ints(rendered, "pos").select(*KEY, "pos", "text")


def session_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = render.session_text(render.packet_text(decode_headers(_kept(spark, sf_dir))))
    return render.with_feature_text(texts, F.lit("")).select(*KEY, "n_pkts", "text")


def flow_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.parse_flow_name(fixtures.session_files(spark, sf_dir)).select(
        "file_name", "class", F.col("proto").cast("bigint").alias("proto"), "src_ip",
        F.col("src_port").cast("bigint").alias("src_port"), "dst_ip",
        F.col("dst_port").cast("bigint").alias("dst_port"), "flow_key",
    )


def feature_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_text(fixtures.statistics(spark, sf_dir)).select(
        "class", "flow_id", "features"
    )


def statistics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics as GBK files with a header of their own for each class, in two column orders, read back.

    A column of notes holds line ends and quotes; features come back in the order of the class's file.
    """
    note = F.concat("Kind", F.lit('\n"'), "class", F.lit('"\r\nend'))
    rows = fixtures.statistics(spark, sf_dir).withColumns({"Note": note, "part": F.concat("class", F.lit(".pcap_Flow.csv"))})
    path = fresh_path(spark, "statistics")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # Spark writes this encoding only so
    names = [c for c in rows.columns if c not in ("class", "row_no", "part")]
    for own, order in ((F.col("class") != "A", names), (F.col("class") == "A", names[::-1])):
        # One writer for each class, as a class is one file, in the order of its rows.
        files = rows.where(own).repartition("class").sortWithinPartitions("class", "row_no")
        writer = files.select("part", *[F.col(f"`{c}`") for c in order]).write.partitionBy("part").mode("append")
        writer.option("header", "true").option("escape", '"').option("encoding", statistics.ENCODING).csv(path)
    read = statistics.read_statistics_by_class(spark, f"{path}/*")
    return features.feature_text(read).select("class", "flow_id", "features")


def feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    survivors = surviving_sessions(fixtures.sessions(spark, sf_dir)).select(*KEY)
    return features.join_features(survivors, fixtures.statistics(spark, sf_dir))


def label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = labelling.label_dictionary(surviving_sessions(fixtures.sessions(spark, sf_dir)))
    return _ints(labels, "label")


def task_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fixtures.named_datasets(spark, sf_dir)
    return (
        named.withColumn("task", labelling.task_of(F.col("dataset_name")))
        .groupBy("dataset_name", "task")
        .agg(F.count("*").alias("n"))
    )


def instruction_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fixtures.named_datasets(spark, sf_dir).withColumn(
        "task", labelling.task_of(F.col("dataset_name"))
    )
    return labelling.with_instruction(named).select(
        "doc_id", "task", "instruction",
        F.replace("label_format", F.lit("{label}"), F.col("lang")).alias("str_labels"),
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_records(_kept(spark, sf_dir), fixtures.statistics(spark, sf_dir))


def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole dataset build: frames to instructed, labelled text rows."""
    labels = labelling.label_dictionary(surviving_sessions(fixtures.sessions(spark, sf_dir)))
    template = labelling.template_of(labelling.TASK_OF_DATASET["dohbrw-2020"])
    rows = labelling.dataset_rows(_records(spark, sf_dir), labels, template)
    return _ints(rows, "labels")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow rows of two groupings: few big classes, and many that are small."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return docs.withColumn("lang_source", F.concat_ws("/", "lang", "source"))


def class_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = splitting.class_cap(_documents(spark, sf_dir), "lang", ["doc_id"])
    return _ints(capped, "rank").select("lang", "doc_id", "rank")


def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return splitting.split_assign(docs, "lang_source", ["doc_id"]).select(
        "lang_source", "doc_id", "split"
    )


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    sizes = [
        splitting.split_sizes(splitting.split_assign(docs, by, ["doc_id"])).withColumn(
            "grouping", F.lit(by)
        )
        for by in ("lang", "lang_source")
    ]
    return sizes[0].unionByName(sizes[1])


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return _ints(splitting.seeded_shuffle(docs, ["doc_id"], ["lang"]), "shuffle_pos").select(
        "lang", "doc_id", "shuffle_pos"
    )


def dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as dataset rows through parquet and comma-separated files."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("text").alias("inputs"), F.length("lang").alias("labels"),
        F.col("source").alias("str_labels"),
        F.when(F.col("doc_id") % 10 < 8, "train").when(F.col("doc_id") % 10 == 8, "val")
        .otherwise("test").alias("split"),
    )
    stored, exported = fresh_path(spark, "dataset"), fresh_path(spark, "csv")
    write_dataset(docs, stored)
    write_dataset_csv(read_dataset(spark, stored), exported)
    return read_dataset_csv(spark, exported).select(
        F.md5("inputs").alias("inputs_md5"), F.length("inputs").cast("bigint").alias("n_chars"),
        F.col("labels").cast("bigint").alias("labels"), "str_labels", "split",
    )


def pcap_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packet into captures of its class and back: indexed, placed in its session, fetched by place."""
    path = fresh_path(spark, "captures")
    write_class_captures(fixtures.frames(spark, sf_dir), path, PACKET_ORDER, compression="zstd")
    placed = session_positions(session_index(spark, path, "directory"))
    return with_endpoints(fetch_packets(placed)).select(
        *KEY, "pos", "ts_us", F.col("caplen").cast("bigint").alias("caplen"),
        F.col("proto").cast("bigint").alias("proto"), "src_ip",
        F.col("src_port").cast("bigint").alias("src_port"), "dst_ip",
        F.col("dst_port").cast("bigint").alias("dst_port"), "forward",
    )


def session_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session into a file of its own, and the first packets of the files that are large enough."""
    path = fresh_path(spark, "flow")
    placed = place_sessions(fixtures.sessions(spark, sf_dir), PACKET_ORDER)
    write_session_files(placed, path, order=PACKET_ORDER, compression="zstd")
    kept = packets_of_session_files(spark, path)
    return _ints(kept, "pos", "caplen", "proto").select(
        "class", "capture", "pos", "n_pkts", "ts_us", "caplen", "proto", "src_ip", "dst_ip", "forward"
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two proxies: the largest component of embeddings against their label, and document labels."""
    vectors = table(spark, sf_dir, "embeddings")
    logits = vectors.select("vec_id", F.col("embedding").alias("logits"))
    far = evaluation.score_predictions(logits, vectors.select("vec_id", "label"), ["vec_id"])
    two = table(spark, sf_dir, "labels").select(
        F.lit("labels").alias("proxy"), F.col("quality").alias("y_true"),
        F.col("toxic").alias("y_pred"),
    )
    far = far.select(F.lit("embeddings").alias("proxy"), "y_true", "y_pred")
    return two.unionByName(far)


def argmax_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        "vec_id",
        evaluation.argmax(F.col("embedding")).cast("bigint").alias("y_pred"),
        F.col("label").cast("bigint").alias("y_true"),
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluation.eval_metrics(_scored(spark, sf_dir), ["proxy"])
    return _rounded(metrics, "accuracy", "precision", "recall", "f1")


def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluation.per_class_metrics(_scored(spark, sf_dir), ["proxy"])
    return _rounded(_ints(metrics, "label"), "precision", "recall", "f1")


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = evaluation.confusion_long(_scored(spark, sf_dir), ["proxy"])
    return _ints(cells, "y_true", "y_pred")


def best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), "event_id", "ts", F.col("value").alias("f1")
    )
    epochs = slice_positions(events, ["run"], ["ts", "event_id"], "epoch")
    best = _ints(evaluation.best_epoch(epochs), "n_epochs", "stop_epoch", "best_epoch")
    return _rounded(best, "best_score")


def vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.vocab_build(table(spark, sf_dir, "documents"), "text")
    return _ints(vocabulary, "id")


def encode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabulary = tokens.vocab_build(docs, "text")
    encoded = tokens.encode_tokens(docs, ["doc_id"], "text", vocabulary)
    return encoded.select(
        "doc_id",
        F.array_join("ids", ",").alias("ids"),
        F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
    )


def fit_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of a document from its text: rows scored per split and label, and whether
    macro F1 there beats the most frequent label of the split."""
    docs = table(spark, sf_dir, "documents")
    labels = stage_table(labelling.label_dictionary(docs, "lang"), "labels")
    chosen = splitting.split_assign(docs.select("lang", "doc_id"), "lang", ["doc_id"])
    rows = (
        docs.select("doc_id", F.col("text").alias("inputs"))
        .join(stage_table(chosen, "splits"), "doc_id")
        .join(labels.withColumnRenamed("str_label", "lang"), "lang")
        .select("doc_id", "inputs", F.col("label").alias("labels"), "split")
    )
    dataset = stage_table(rows, "dataset")
    model, _, _ = fit_and_select(dataset, ["doc_id"], grid=(0.01, 0.1))
    scored = stage_table(score_splits(model, dataset, ["doc_id"]), "scored")
    counts = scored.groupBy("split", F.col("y_true").cast("bigint").alias("label")).agg(F.count("*").alias("n"))
    common = counts.groupBy("split").agg(F.max_by("label", F.struct("n", "label")).alias("y_pred"))
    plain = evaluation.eval_metrics(scored.drop("y_pred").join(common, "split"), ["split"])
    own = evaluation.eval_metrics(scored, ["split"]).select("split", F.col("f1").alias("own"))
    better = own.join(plain, "split").select("split", (F.col("own") > F.col("f1")).alias("beats_common_label"))
    return counts.join(better, "split").select("split", "label", "n", "beats_common_label")


QUERIES = {
    f.__name__: f
    for f in (
        session_groups, session_order, first_packets, session_filter, class_report, header_fields,
        packet_timing, tcp_running_state, packet_text, session_text, flow_name_parse, feature_text,
        statistics_roundtrip,
        feature_join, label_dictionary, task_mapping, instruction_text, dataset_rows, class_cap,
        split_assign, split_sizes, seeded_shuffle, dataset_roundtrip, pcap_roundtrip,
        session_files,
        argmax_predict, eval_metrics, per_class_metrics, confusion_matrix, best_epoch, vocab_build,
        encode_tokens, fit_select,
    )
}
