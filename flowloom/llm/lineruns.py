"""Repeated runs of lines: a suffix array over line ids by prefix doubling, later copies deleted.

Lines that occur once end every run, so only repeated lines get an id. Ids are ranks; from the
ranks of all sequences of 2^k lines those of 2^(k+1) follow by ranking pairs, and sequences
that occur once drop out. Equal ranks are an interval of the suffix array whose
longest common prefix is at least that many lines.

A run counts if it has ``min_words`` words. Whether lines a..b occur earlier is asked for the
shortest such stretch from each line on and the shortest one up to each line: together they
cover every line of every maximal repeated run of that size. Stretches of any length are
compared by the ranks of two overlapping sequences of 2^k lines.

All steps are DataFrame operations. Documents come in order of id, then of a digest of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.staging import stage_table

MIN_WORDS = 50
_WORD = r"[^\x09-\x0D\x20]+"


def _met(facts: DataFrame, groups: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Rows with what their group, of which ``groups`` has one row, knows.

    Always by sort and merge, so that the plan is the same for any size; the rows of a hot group
    are split by adaptive execution, as the written ``groups`` are an exchange of their own.
    """
    return facts.join(stage_table(groups, "groups").hint("merge"), on, how)


def _key(id_col: str, text_col: str) -> Column:
    """What names a row: its id and text. Repeated rows are one document."""
    parts = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text_col, F.lit("")))
    return F.unhex(F.md5(parts))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    lines = docs.select(
        F.col(id_col).alias("doc"), _key(id_col, text_col).alias("key"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("line", "text")
    )
    return lines.select("doc", "key", "line", F.unhex(F.md5("text")).alias("hash"), F.regexp_count("text", F.lit(_WORD)).alias("words"))


def _ranked(groups: DataFrame, by: list[str], rank: str) -> DataFrame:
    """Ranks in the order of ``by``, not dense; the written table fixes them."""
    return groups.orderBy(*by).select(*by, F.monotonically_increasing_id().alias(rank))


def _double(level: DataFrame, size: int) -> DataFrame:
    """Ranks (key, line, rank) of sequences of ``2 * size`` lines from those of ``size``; unique ones drop out."""
    ahead = level.select("key", (F.col("line") - size).alias("line"), F.col("rank").alias("next"))
    pairs = stage_table(level.join(ahead, ["key", "line"]).select("key", "line", "rank", "next"), "pairs")
    shared = pairs.groupBy("rank", "next").count().where(F.col("count") > 1)
    ranks = _ranked(shared, ["rank", "next"], "own")
    return stage_table(_met(pairs, ranks, ["rank", "next"]).select("key", "line", F.col("own").alias("rank")), "level")


def _stretches(active: DataFrame, min_words: int) -> DataFrame:
    """(doc, key, start, stop): the shortest stretches of ``min_words`` words from and up to each line, stop included."""
    by_line = Window.partitionBy("key").orderBy("line")
    joined = active.withColumn("part", F.col("line") - F.row_number().over(by_line))
    so_far = Window.partitionBy("key", "part").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    summed = joined.withColumn("through", F.sum("words").over(so_far)).withColumn("before", F.col("through") - F.col("words"))
    on = Window.partitionBy("key", "part").orderBy("before").rangeBetween(0, min_words - 1)
    back = Window.partitionBy("key", "part").orderBy("through").rangeBetween(1 - min_words, 0)
    ends = summed.select(
        "doc",
        "key",
        F.struct(
            F.col("line").alias("start"),
            F.max("line").over(on).alias("stop"),
            (F.max("through").over(on) - F.col("before")).alias("size"),
        ).alias("onward"),
        F.struct(
            F.min("line").over(back).alias("start"),
            F.col("line").alias("stop"),
            (F.col("through") - F.min("before").over(back)).alias("size"),
        ).alias("backward"),
    )
    both = ends.select("doc", "key", F.explode(F.array("onward", "backward")).alias("s"))
    return both.where(F.col("s.size") >= min_words).select("doc", "key", "s.start", "s.stop").distinct()


def later_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, runs): for documents with deletable lines, their maximal runs as an ordered list of (start, stop).

    ``key`` names a row by id and text; lines count from 0, stop is included.
    """
    lines = _lines(docs, id_col, text_col)
    # A row that is repeated in the table would repeat its own lines.
    often = lines.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    ids = _ranked(often, ["hash"], "rank")
    active = _met(lines, ids, ["hash"]).select("doc", "key", "line", "words", "rank").dropDuplicates(["key", "line"])
    active = stage_table(active, "active")
    asked = stage_table(_stretches(active, min_words), "stretches")
    length = F.col("stop") - F.col("start") + 1
    longest = asked.agg(F.max(length)).first()[0] or 0
    level = active.select("key", "line", "rank")
    levels, size, power = level.withColumn("power", F.lit(0)), 1, 0
    while 2 * size <= longest:
        level, size, power = _double(level, size), 2 * size, power + 1
        levels = levels.unionByName(level.withColumn("power", F.lit(power)))
    powered = asked.withColumn("power", F.floor(F.log2(length + 0.5)).cast("int")).withColumn(
        "second", (F.col("stop") + 1 - F.expr("shiftleft(1, power)")).cast("int")
    )
    first = levels.select("key", F.col("line").alias("start"), "power", F.col("rank").alias("rank_a"))
    second = levels.select("key", F.col("line").alias("second"), "power", F.col("rank").alias("rank_b"))
    named = powered.join(first, ["key", "start", "power"]).join(second, ["key", "second", "power"])
    place = F.struct("doc", "key", "start")
    named = stage_table(named.select("rank_a", "rank_b", length.alias("length"), "start", "stop", "key", place.alias("place")), "named")
    same = ["rank_a", "rank_b", "length"]
    firsts = named.groupBy(*same).agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    later = _met(named, firsts, same).where(F.col("place") > F.col("earliest"))
    gone = later.select("key", F.explode(F.sequence("start", "stop")).alias("line")).distinct()
    island = F.col("line") - F.row_number().over(Window.partitionBy("key").orderBy("line"))
    runs = gone.withColumn("island", island).groupBy("key", "island").agg(F.min("line").alias("start"), F.max("line").alias("stop"))
    return runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def _free(name: str, taken: list[str]) -> str:
    low = {c.lower() for c in taken}
    while name in low:
        name += "_"
    return name


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns: the kept text and the removed runs; and the names of the two.

    A null text stays null and an empty one empty: neither has words. A null id comes ahead of all
    others. Rows equal in id and text are one document and keep or lose the same lines.
    """
    key, runs, kept = (_free(n, docs.columns) for n in ("_key", "_runs", "_kept"))
    found = later_runs(docs, id_col, text_col, min_words).select(F.col("key").alias(key), F.col("runs").alias(runs))
    whole = _met(docs.withColumn(key, _key(id_col, text_col)), found, [key], "left")
    lines = F.split(F.col(text_col), "\n")
    # Kept lines lie before, between and after the runs.
    begin = lambda n: F.when(n == 0, 0).otherwise(F.get(runs, n - 1)["stop"] + 1)
    end = lambda n: F.coalesce(F.get(runs, n)["start"], F.size(lines))
    pieces = F.transform(F.sequence(F.lit(0), F.size(runs)), lambda n: F.slice(lines, begin(n) + 1, end(n) - begin(n)))
    text = F.when(F.col(runs).isNull(), F.col(text_col)).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return whole.withColumn(kept, text).drop(key), kept, runs


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` without later copies of runs; documents of which nothing is left go. All columns stay."""
    whole, kept, runs = deduplicated(docs, id_col, text_col, min_words)
    left = whole.where(F.col(runs).isNull() | (F.length(kept) > 0))
    changed = F.col(runs).isNotNull()
    columns = []
    for field in docs.schema.fields:
        column = F.col(field.name)
        if field.name == text_col:
            column = F.col(kept)
        elif field.name == length_col:
            column = F.when(changed, F.length(kept).cast(field.dataType)).otherwise(column)
        columns.append(column.alias(field.name))
    return left.select(*columns)


def digest_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, n_runs and the SHA-256 of the text that is kept."""
    whole, kept, runs = deduplicated(docs.select(id_col, text_col), id_col, text_col, min_words)
    removed = F.aggregate(runs, F.lit(0).cast("long"), lambda total, run: total + run["stop"] - run["start"] + 1)
    return whole.select(
        F.col(id_col).alias("doc_id"),
        F.size(F.split(F.coalesce(text_col, F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size(runs), F.lit(0)).cast("long").alias("n_runs"),
        F.sha2(F.coalesce(kept, F.lit("")), 256).alias("kept_sha256"),
    )
