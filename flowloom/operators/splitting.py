"""Class cap, train/val/test split and seeded shuffle, all by seeded hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.hashing import seeded_hash
from flowloom.plans.ranks import lowest_per_group, slice_positions

# Fixed values of the sampler.
MAX_PER_CLASS = 600
SMALL_CLASS = 10
SEED = 42
SPLITS = ("train", "val", "test")


def class_cap(
    rows: DataFrame, by: str, key: list[str], cap: int = MAX_PER_CLASS, seed: int = SEED
) -> DataFrame:
    """At most ``cap`` rows per class, picked by seeded hash, with ``rank`` in the class.

    Feed it narrow rows (class and key) and join the texts back afterwards.
    """
    hashed = rows.withColumn("_hash", seeded_hash(seed, *key))
    return lowest_per_group(hashed, [by], ["_hash", *key], cap).drop("_hash")


def split_of_rank(rank: Column, n: Column) -> Column:
    """Split of the ``rank``-th of ``n`` rows: 20 % held out, half of it (rounded up) for test."""
    hold = F.floor((n + 4) / 5)
    test = F.floor((hold + 1) / 2)
    return (
        F.when(rank <= n - hold, SPLITS[0]).when(rank <= n - test, SPLITS[1]).otherwise(SPLITS[2])
    )


def split_assign(
    rows: DataFrame,
    by: str,
    key: list[str],
    cap: int = MAX_PER_CLASS,
    seed: int = SEED,
    small: str = "replicate",
) -> DataFrame:
    """Cap each class and add ``split``.

    A class of fewer than ten rows, counted ahead of the cap, goes whole to all
    three splits, or to ``train`` only with ``small="train"``.
    """
    if small not in ("replicate", "train"):
        raise ValueError("small must be 'replicate' or 'train'")
    known = rows.where(F.col(by).isNotNull())
    # Totals combine before the shuffle; a capped class has the cap's rows or all of its own.
    totals = known.groupBy(by).agg(F.count("*").alias("_all"))
    sized = class_cap(known, by, key, cap, seed).join(totals, by)
    sized = sized.withColumn("_n", F.least("_all", F.lit(cap)))
    everywhere = F.array(*[F.lit(s) for s in (SPLITS if small == "replicate" else SPLITS[:1])])
    target = F.when(F.col("_all") < SMALL_CLASS, everywhere).otherwise(
        F.array(split_of_rank(F.col("rank"), F.col("_n")))
    )
    return sized.withColumn("split", F.explode(target)).drop("_n", "_all", "rank")


def split_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split").agg(F.count("*").alias("n"))


def seeded_shuffle(
    rows: DataFrame, key: list[str], by: list[str], seed: int = SEED, pos: str = "shuffle_pos"
) -> DataFrame:
    """Add the position of each row in the seeded order of its split.

    A split is ranked in ranges of the order, so no task sees a whole split.
    """
    hashed = rows.withColumn("_hash", seeded_hash(seed, *key))
    return slice_positions(hashed, by, ["_hash", *key], pos).drop("_hash")
