"""Two tables that meet under a key, dealt out in cells of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from flowloom.plans.staging import stage_table


def meet(
    entries: DataFrame,
    queries: DataFrame,
    place: list[str],
    turn: str,
    sizes: tuple[int, int],
    run: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """``run(entries, queries)`` for cells in which every entry meets every query of its ``place`` once.

    ``sizes`` bound, on average, the entries and the queries of a cell; rows are dealt by the hash of
    their column ``turn``. A place that only one side has costs nothing.
    """

    def many(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy(*place).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    none = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def run_cell(e: pa.Table, q: pa.Table) -> pa.Table:
        # Hashes may leave a cell without rows of one side.
        return run(e, q) if e.num_rows and q.num_rows else none

    blocks = many(entries, sizes[0], "_es").join(many(queries, sizes[1], "_qs"), place)
    blocks = stage_table(blocks, "blocks")
    one_of = lambda n: F.pmod(F.xxhash64(turn), F.col(n)).cast("int")
    each_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def dealt(df: DataFrame, e: Column, q: Column) -> DataFrame:
        return df.join(blocks, place).withColumn("_e", e).withColumn("_q", q).drop("_es", "_qs")

    key = [*place, "_e", "_q"]
    left = dealt(entries, one_of("_es"), each_of("_qs"))
    right = dealt(queries, each_of("_es"), one_of("_qs"))
    named = [F.col(k).alias(f"_of_{k}") for k in key]
    right = right.select(*named, *[c for c in right.columns if c not in key]).groupBy(*[f"_of_{k}" for k in key])
    return left.groupBy(*key).cogroup(right).applyInArrow(run_cell, schema)
