"""Dataset files: ``inputs, labels, str_labels`` per split, and the class dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: columns of a dataset file.
DATASET_SCHEMA = "inputs string, labels int, str_labels string"
SPLIT_NAMES = ("train", "val", "test")

# Quotes are doubled; blanks at the ends of a text are kept.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# A missing value is written as nothing, an empty text as a pair of quotes. The reader tells
# them apart only if its mark for missing values is not the empty text.
_MISSING = "\u0000"
_ROWS_PER_FILE = 200_000


def write_dataset(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Parquet, one folder per ``split``.

    With ``order`` rows are dealt out by ranges of it and sorted within, so a folder's files read by name are in order.
    """
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions("split", *order)
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """All splits; a filter on ``split`` reads only that folder."""
    return spark.read.parquet(path)


def write_dataset_csv(rows: DataFrame, path: str) -> None:
    """Comma-separated files, one folder per ``split`` if there is one.

    A text with line ends keeps its file from being split on reading, so files
    are kept to a bounded number of rows.
    """
    columns = [c for c in ("inputs", "labels", "str_labels", "split") if c in rows.columns]
    writer = (
        rows.select(*columns).write.mode("overwrite").options(**_CSV)
        .option("maxRecordsPerFile", _ROWS_PER_FILE)
    )
    if "split" in columns:
        writer = writer.partitionBy("split")
    writer.csv(path)


def read_dataset_csv(spark: SparkSession, path: str, line_ends: bool = True) -> DataFrame:
    """Dataset rows of comma-separated files, with ``split`` where folders name it.

    ``line_ends=False`` declares that no text holds a line end; files are then
    read in blocks.
    """
    return (
        spark.read.schema(DATASET_SCHEMA).options(**_CSV)
        .option("nullValue", _MISSING)
        .option("multiLine", str(line_ends).lower())
        .option("lineSep", "\n")
        .csv(path)
    )


def write_split_files(rows: DataFrame, directory: str) -> None:
    """``train.tsv, val.tsv, test.tsv`` (comma-separated despite the name), one folder each."""
    for name in SPLIT_NAMES:
        write_dataset_csv(rows.where(F.col("split") == name).drop("split"), f"{directory}/{name}.tsv")


def read_split_files(spark: SparkSession, directory: str, line_ends: bool = True) -> DataFrame:
    """``train.tsv, val.tsv, test.tsv``, files or folders, as one frame with ``split``."""
    parts = [
        read_dataset_csv(spark, f"{directory}/{name}.tsv", line_ends).withColumn("split", F.lit(name))
        for name in SPLIT_NAMES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def write_labels(labels: DataFrame, path: str) -> None:
    """Class dictionary with columns ``str, int``."""
    labels.select(F.col("str_label").alias("str"), F.col("label").alias("int")).write.mode(
        "overwrite"
    ).option("header", "true").csv(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("str string, int int").option("header", "true").csv(path)
        .select(F.col("str").alias("str_label"), F.col("int").alias("label"))
    )
