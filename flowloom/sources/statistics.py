"""Session statistics files: ``feature/<class>.pcap_Flow.csv``, GBK-encoded, with a header."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.numbertext import float_text
from flowloom.plans.staging import stage_table

# Encoding and file name of the statistics files.
ENCODING = "GBK"
FILE_NAME = r"([^/=]+)\.pcap_Flow\.csv(?:/part-[^/]*)?$"
# Texts that read as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# A field of a record as Python reads it: quoted, with doubled quotes and whatever follows, or plain.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+'
_FIELD = rf'(?:"{_QUOTED}|[^",][^,]*+|)'
# Lines that end outside of quotes: those that begin outside, and those that begin within.
_ENDS_OUTSIDE = rf"(?s)^{_FIELD}(?:,{_FIELD})*+$"
_LEAVES_QUOTES = rf"(?s)^{_QUOTED}(?:,{_FIELD})*+$"


@contextmanager
def _java_charsets(spark: SparkSession) -> Iterator[None]:
    """Expressions made in the block may name this encoding; they keep that, the session's setting is put back."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _after(state: str, swaps: Column) -> Column:
    """The state after ``swaps`` changes of it."""
    return (F.col(state) + swaps) % 2


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_no, record): the records of comma-separated files, which quoted line ends do not cut.

    Files are read in parallel blocks of lines. Whether a line begins within quotes follows from the lines ahead of it: a line
    keeps that state, turns it, or sets it, which two patterns tell for either beginning. Each block is scanned from its last
    line that sets the state, one row a block is scanned over the file, and records are cut where a line
    begins outside. Blank records are left out. A file that ends within quotes is an error.
    """
    file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    raw = spark.read.option("lineSep", "\n").text(path).select(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.decode(F.col("value").cast("binary"), ENCODING).alias("line"),
    )
    # A carriage return that no line feed follows ends a line as well, and stays with it.
    pieces = raw.select("file", "block", "seq", F.posexplode(F.split("line", r"(?<=\r)(?!$)")).alias("piece", "line"))
    body = F.regexp_replace("line", r"\r$", "")
    lines = pieces.select(
        "file", "block", F.struct("seq", "piece").alias("at"), "line",
        F.when(body.rlike(_ENDS_OUTSIDE), 0).otherwise(1).alias("from_0"),
        F.when(body.rlike(_LEAVES_QUOTES), 0).otherwise(1).alias("from_1"),
    )
    lines = stage_table(lines, "lines")
    sets, turns = F.col("from_0") == F.col("from_1"), (F.col("from_0") == 1) & (F.col("from_1") == 0)
    own = Window.partitionBy("file", "block").orderBy("at")
    ahead = own.rowsBetween(Window.unboundedPreceding, -1)
    marked = lines.withColumns({"turn": turns.cast("int"), "to": F.when(sets, F.col("from_0"))})
    counted = marked.withColumn("turned", F.coalesce(F.sum("turn").over(ahead), F.lit(0)))
    last_set = F.last(F.when(F.col("to").isNotNull(), F.struct("to", (F.col("turned") + F.col("turn")).alias("turned"))), ignorenulls=True)
    scanned = counted.withColumn("known", last_set.over(ahead))
    # One row a block: the state it sets, if any, how often it is turned after that, and where its lines would begin a record.
    end = F.max_by(F.struct("to", F.struct("known", "turned", "turn").alias("seen")), "at")
    ends = scanned.groupBy("file", "block").agg(end.alias("end"))
    turned = F.col("end.seen.turned") + F.col("end.seen.turn")
    blocks = ends.select(
        "file", "block",
        F.coalesce("end.to", "end.seen.known.to").alias("to"),
        F.when(F.col("end.to").isNotNull(), 0).otherwise(turned - F.coalesce("end.seen.known.turned", F.lit(0))).alias("turns"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = blocks.withColumn("all", F.sum("turns").over(Window.partitionBy("file").orderBy("block")))
    set_by = F.last(F.when(F.col("to").isNotNull(), F.struct((F.col("to") + F.col("turns")).alias("to"), "all")), ignorenulls=True).over(before)
    passed = F.coalesce(F.sum("turns").over(before), F.lit(0))
    begun = whole.withColumns({"by": set_by, "passed": passed}).withColumn(
        "begin", (F.coalesce("by.to", F.lit(0)) + F.col("passed") - F.coalesce("by.all", F.lit(0))) % 2
    )
    finish = F.when(F.col("to").isNotNull(), _after("to", F.col("turns"))).otherwise(_after("begin", F.col("turns")))
    begun = begun.withColumn("finish", finish).withColumn("last", F.row_number().over(Window.partitionBy("file").orderBy(F.col("block").desc())) == 1)
    open_end = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file"))).cast("int")
    begun = stage_table(begun.select("file", "block", F.when(F.col("last") & (F.col("finish") == 1), open_end).otherwise(F.col("begin")).alias("begin")), "blocks")
    placed = scanned.join(begun, ["file", "block"])
    within = F.when(F.col("known").isNotNull(), (F.col("known.to") + F.col("turned") - F.col("known.turned")) % 2).otherwise(_after("begin", F.col("turned")))
    started = placed.withColumn("starts", F.when(within == 0, F.struct("block", "at")))
    # The record a line belongs to began in its block, or else in the last block where one began.
    first = F.last("starts", ignorenulls=True).over(own)
    begins = started.groupBy("file", "block").agg(F.max("starts").alias("starts"))
    earlier = begins.select("file", "block", F.last("starts", ignorenulls=True).over(before).alias("carried"))
    known = started.withColumn("record_no", first).join(stage_table(earlier, "earlier"), ["file", "block"])
    grouped = known.groupBy("file", F.coalesce("record_no", "carried").alias("row_no")).agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("lines")
    )
    # Inner line ends come back as they were; the last one goes.
    texts = F.transform("lines", lambda x: x["line"])
    nexts = F.transform("lines", lambda x: x["at"]["seq"])
    joined = F.array_join(
        F.transform(texts, lambda text, i: F.concat(F.when(i == 0, "").otherwise(F.when(F.get(nexts, i) != F.get(nexts, i - 1), "\n").otherwise("")), text)), ""
    )
    record = F.regexp_replace(joined, r"\r$", "")
    return grouped.select("file", "row_no", record.alias("record")).where(F.trim("record") != "")


def _class_of(file: Column) -> Column:
    return F.regexp_extract(file, FILE_NAME, 1)


_CSV = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "multiLine": "true"}


def read_statistics(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Statistics rows with ``class`` (from the file name) and ``row_no`` (file order).

    For files that all have the same columns in the same order; files that differ are for
    :func:`read_statistics_by_class`. Give a ``schema`` where it is known: without one, the records are read
    once more to tell whole numbers and floats from texts.
    """
    with _java_charsets(spark):
        records = stage_table(read_records(spark, path), "records")
    heads = records.groupBy("file").agg(F.min("row_no").alias("head_no"), F.min_by("record", "row_no").alias("head"))
    heads = stage_table(heads, "headers")
    rows = records.join(heads, "file").where(F.col("row_no") > F.col("head_no"))
    if schema is None:
        head = heads.select("head").first()
        names = next(csv.reader([head["head"]])) if head else []
        texts = ", ".join(f"c{i} string" for i in range(len(names))) or "c0 string"
        cells = rows.select(F.from_csv("record", texts, _CSV).alias("r")).select("r.*")
        kinds = {}
        for i in range(len(names)):
            value = F.col(f"c{i}")
            whole = value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNotNull()
            number = value.try_cast("double").isNotNull()
            kinds |= {f"w{i}": F.min(value.isNull() | whole), f"d{i}": F.min(value.isNull() | number), f"n{i}": F.max(value.isNotNull())}
        found = cells.agg(*[c.alias(k) for k, c in kinds.items()]).first() if names else {}
        kind_of = lambda i: "string" if not found[f"n{i}"] else "bigint" if found[f"w{i}"] else "double" if found[f"d{i}"] else "string"
        schema = T.StructType([T.StructField(name, T._parse_datatype_string(kind_of(i))) for i, name in enumerate(names)])
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    parsed = F.from_csv("record", _ddl(schema), _CSV)
    return rows.select(_class_of(F.col("file")).alias("class"), "row_no", parsed.alias("r")).select(
        "class", "row_no", *[F.col(f"r.`{f.name}`") for f in schema]
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def read_statistics_by_class(spark: SparkSession, path: str) -> DataFrame:
    """``class, row_no, names, texts``: rows of files that each have a header of their own.

    ``names`` has a row's columns in the order of its file, ``texts`` its values as they are
    rendered. Types are those of a class's own values: whole numbers stay whole where
    none is missing, other numbers are spelt as floats, missing numbers read ``nan``, and
    everything else stays text. The longest header's number of columns is all that comes back to the driver.
    """
    with _java_charsets(spark):
        lines = stage_table(read_records(spark, path).withColumnRenamed("record", "line"), "records")
    heads = stage_table(
        lines.groupBy("file").agg(
            F.min("row_no").alias("head_no"), F.min_by("line", "row_no").alias("head")
        ),
        "headers",
    )
    # Commas in quotes only make this number larger than need be.
    width = heads.agg(F.max(F.size(F.split("head", ",")))).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(width))

    def cells(text: str):
        parsed = F.from_csv(F.col(text), schema, _CSV)
        return F.array(*[parsed[f"c{i}"] for i in range(width)])

    names = F.filter(cells("head"), lambda name: name.isNotNull())
    known = heads.select(F.col("file").alias("_file"), "head_no", names.alias("names"))
    rows = lines.join(known, F.col("file") == F.col("_file")).where(F.col("row_no") > F.col("head_no"))
    value = lambda v: F.when(~F.coalesce(v, F.lit("")).isin(MISSING), v)
    rows = rows.select(
        _class_of(F.col("file")).alias("class"), "file", "row_no", "names",
        F.slice(F.transform(cells("line"), value), 1, F.size("names")).alias("values"),
    )
    each = rows.select("class", F.inline(F.arrays_zip(F.col("names").alias("name"), F.col("values").alias("value"))))
    whole = F.col("value").rlike(r"^[+-]?[0-9]+$") & F.col("value").try_cast("bigint").isNotNull()
    kinds = each.groupBy("class", "name").agg(
        F.coalesce(F.min(F.col("value").isNull() | whole), F.lit(False)).alias("_whole"),
        F.coalesce(F.min(F.col("value").isNull() | F.col("value").try_cast("double").isNotNull()), F.lit(False)).alias("_number"),
        F.max(F.col("value").isNull()).alias("_missing"),
    )
    kind = F.when(F.col("_whole") & ~F.col("_missing"), "whole").when(F.col("_number"), "number").otherwise("text")
    by_class = kinds.groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("name", kind))).alias("kinds"))

    def text(v, k):
        number = v.try_cast("double")
        return (
            F.when((k == "whole"), v.try_cast("bigint").cast("string"))
            .when(k == "number", float_text(number))
            .otherwise(F.coalesce(v, F.lit("nan")))
        )

    own = F.transform("names", lambda name: F.element_at("kinds", name))
    return rows.join(by_class, "class").select(
        "class",
        F.struct("file", "row_no").alias("row_no"),
        "names",
        F.zip_with("values", own, text).alias("texts"),
    )
