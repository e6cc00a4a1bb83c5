"""Vocabulary and fixed-length token arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.ranks import slice_positions
from flowloom.plans.staging import join_staged, stage_table

# Fixed values of the encoder.
MAX_TOKENS = 512
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_ID = 2
SEPARATOR = "[ \\t\\n\\r]+"
VOCABULARY_SIZE = 30_000


def split_tokens(text: Column, limit: int = -1) -> Column:
    """Non-empty pieces of ``text`` between blanks, tabs and line ends."""
    return F.filter(F.split(text, SEPARATOR, limit), lambda t: t != "")


def _least_count(counts: DataFrame, size: int) -> tuple[int, int]:
    """The count from which on ``size`` tokens are reached, and how many tokens have a larger one.

    Counts of counts tell: first by the bits of a count, of which there are 63 at most, then by the
    counts of that many bits alone. No more than ``size`` numbers come to the driver.
    """
    bits = F.length(F.bin("n"))
    above = 0
    for row in counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("tokens")).orderBy(F.desc("bits")).collect():
        if above + row["tokens"] < size:
            above += row["tokens"]
            continue
        same = counts.where(bits == row["bits"]).groupBy("n").agg(F.count("*").alias("tokens"))
        for each in same.orderBy(F.desc("n")).limit(size).collect():
            if above + each["tokens"] >= size:
                return each["n"], above
            above += each["tokens"]
    return 0, above


def vocab_build(rows: DataFrame, text: str, size: int = VOCABULARY_SIZE) -> DataFrame:
    """``token, n, id``: the ``size`` most frequent tokens of whole texts, ids from 2.

    Counts combine before the shuffle and are staged. Tokens above the least count that is taken are chosen by a filter;
    of those that have it the first come, ranked in ranges. Only the chosen tokens meet in one task, to be numbered.
    """
    counts = stage_table(
        rows.select(F.explode(split_tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n")), "counts"
    )
    least, above = _least_count(counts, size)
    tied = slice_positions(counts.where(F.col("n") == least), ["n"], ["token"], "_rank").where(F.col("_rank") <= size - above)
    top = counts.where(F.col("n") > least).unionByName(tied.drop("_rank"))
    number = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.withColumn("id", (number + (FIRST_ID - 1)).cast("int"))


def pad_and_mask(rows: DataFrame, ids: str = "ids", length: int = MAX_TOKENS) -> DataFrame:
    """Cut or pad ``ids`` to ``length`` and add the attention ``mask``."""
    cut = F.slice(ids, 1, length)
    missing = F.lit(length) - F.size(cut)
    return rows.withColumn(
        "mask", F.concat(F.transform(cut, lambda _: F.lit(1)), F.array_repeat(F.lit(0), missing))
    ).withColumn(ids, F.concat(cut, F.array_repeat(F.lit(PAD_ID), missing)))


def encode_tokens(
    rows: DataFrame,
    key: list[str],
    text: str,
    vocabulary: DataFrame,
    length: int = MAX_TOKENS,
    keep: list[str] = [],
) -> DataFrame:
    """``key…, keep…, ids, mask`` of fixed length; unknown tokens get id 1.

    ``key`` must be unique. All other columns, the text among them, are dropped.

    Truncation to ``length`` is the encoder's contract, so splitting stops there.
    Rows are hashed on their key while they are still one row each: looking up
    the exploded tokens and collecting them again then needs no shuffle.
    """
    first = F.slice(split_tokens(F.col(text), length + 2), 1, length)
    placed = (
        rows.select(*key, *keep, first.alias("_tokens"))
        .repartition(*key)
        .select(*key, *keep, F.posexplode_outer("_tokens").alias("_pos", "_token"))
    )
    ids = vocabulary.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    known = join_staged(placed, ids, ["_token"], "left")
    word = F.when(
        F.col("_token").isNotNull(),
        F.struct("_pos", F.coalesce("_id", F.lit(UNKNOWN_ID)).alias("id")),
    )
    gathered = known.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in keep],
        F.transform(F.sort_array(F.collect_list(word)), lambda w: w["id"]).alias("ids"),
    )
    return pad_and_mask(gathered, "ids", length)


def encode_with(
    rows: DataFrame,
    text: str,
    tokenizer: Callable[[list[str]], list[list[int]]],
    length: int = MAX_TOKENS,
) -> DataFrame:
    """Same result columns with a tokenizer of the caller's own, called on batches of texts."""

    @F.pandas_udf("array<int>")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(tokenizer(batch.tolist()), index=batch.index)

    return pad_and_mask(rows.withColumn("ids", ids_of(F.col(text))), "ids", length)
