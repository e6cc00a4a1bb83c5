"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking.

A table turns unit vectors by three rounds of random signs and a fast Hadamard transform; the
nearest of the signed axes is the bucket. Queries also probe the next nearest axes. Vectors that
meet in a bucket are compared exactly, in double precision on the original vectors.

Equal vectors are one entry with their least ids. Buckets are dealt out in blocks of
``BLOCK`` entries and ``BLOCK`` probes, so no task holds a whole hot bucket and none is cut off.
Queries that find too few neighbours are compared with all entries, block by block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.plans.staging import join_staged, stage_table

TABLES = 12
PROBES = 10
# Hashes that together make a bucket; more of them make buckets of larger tables smaller.
HASHES = 1
NEIGHBOURS = 5
BLOCK = 4096
SEED = 1


def _hadamard(rows: np.ndarray) -> np.ndarray:
    size, half = rows.shape[1], 1
    while half < size:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2).reshape(len(rows), size)
        half *= 2
    return rows / np.sqrt(size)


def _axes(rows: np.ndarray, table: int, turn: int) -> np.ndarray:
    """Nearness to the 2n signed axes after the pseudo-rotation of (table, turn)."""
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    signs = np.random.default_rng([SEED, table, turn]).choice((-1.0, 1.0), (3, size))
    turned = np.zeros((len(rows), size))
    turned[:, : rows.shape[1]] = rows
    for sign in signs:
        turned = _hadamard(turned * sign)
    return np.concatenate((turned, -turned), axis=1)


def buckets(rows: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` buckets of each row whose axes lie nearest, nearest first."""
    codes, worth = np.zeros((len(rows), 1), np.int64), np.zeros((len(rows), 1))
    for turn in range(hashes):
        near = _axes(rows, table, turn)
        top = np.argsort(-near, axis=1, kind="stable")[:, :probes]
        both = worth[:, :, None] + np.take_along_axis(near, top, axis=1)[:, None, :]
        coded = codes[:, :, None] * near.shape[1] + top[:, None, :]
        flat = both.reshape(len(rows), -1)
        best = np.argsort(-flat, axis=1, kind="stable")[:, :probes]
        worth = np.take_along_axis(flat, best, axis=1)
        codes = np.take_along_axis(coded.reshape(len(rows), -1), best, axis=1)
    return codes


def _unit(vectors: list[list[float]]) -> np.ndarray:
    """Rows of length one; very large or small ones are scaled ahead of squaring."""
    rows = np.array(vectors, np.float64)
    most = np.abs(rows).max(axis=1, keepdims=True)
    rows = np.where((most > 1e100) | (most < 1e-100), rows / most, rows)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _hashed(df: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """(dim, part, bucket, id, vector): a row for each table and probe of every row of (id, vector)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            ids, vectors = part.column(0).to_pylist(), part.column(1).to_pylist()
            by_size: dict[int, list[int]] = {}
            for row, vector in enumerate(vectors):
                by_size.setdefault(len(vector), []).append(row)
            for dim, rows in by_size.items():
                unit = _unit([vectors[r] for r in rows])
                for table in range(tables):
                    found = buckets(unit, table, hashes, probes)
                    again = np.repeat(rows, found.shape[1])
                    many = len(again)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(many, dim), pa.int32()),
                            pa.array(np.full(many, table), pa.int32()),
                            pa.array(found.ravel()),
                            pa.array([ids[r] for r in again], pa.int64()),
                            part.column(1).take(pa.array(again)),
                        ],
                        names=["dim", "part", "bucket", "id", "vector"],
                    )

    kind = df.schema["vector"].dataType.simpleString()
    return df.select("id", "vector").mapInArrow(run, f"dim int, part int, bucket bigint, id bigint, vector {kind}")


def _best(queries: pa.Table, entries: pa.Table, keep: int) -> pa.Table:
    """For each query the ``keep`` nearest entries, ties to the smaller id."""
    names = ["query_id", "id", "score"]
    if not queries.num_rows or not entries.num_rows:
        return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    ids = entries.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    rows = _unit(entries.column("vector").to_pylist())[order]
    asked = queries.column("id").to_numpy()
    unit = _unit(queries.column("vector").to_pylist())
    out: list[list[np.ndarray]] = [[], [], []]
    for start in range(0, len(asked), 256):
        near = unit[start : start + 256] @ rows.T
        if near.shape[1] > keep:
            # The keep-th largest value bounds what can be kept; all that reach it are sorted.
            bound = np.partition(near, -keep, axis=1)[:, -keep]
        else:
            bound = np.full(len(near), -np.inf)
        for line, (scores, least) in enumerate(zip(near, bound, strict=True)):
            # A product of matrices rounds by their shapes; what is returned must not, so the few are
            # summed again. The slack keeps those whose last bits the product has put below the bound.
            at = np.flatnonzero(scores >= least - 1e-9)
            exact = (rows[at] * unit[start + line]).sum(axis=1)
            order = np.lexsort((ids[at], -exact))[:keep]
            out[0].append(np.full(len(order), asked[start + line]))
            out[1].append(ids[at][order])
            out[2].append(exact[order])
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)


def _meet(queries: DataFrame, entries: DataFrame, keep: int, block: int) -> DataFrame:
    """(query_id, id, score): the nearest entries of each query within every block of its buckets."""
    place = ["dim", "part", "bucket"]
    many = lambda df, name: df.groupBy(*place).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    blocks = stage_table(many(entries, "entry_blocks").join(many(queries, "query_blocks"), place), "blocks")
    one_of = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shown = entries.join(blocks, place).withColumn("e", one_of("entry_blocks")).withColumn("q", each_of("query_blocks"))
    asked = queries.join(blocks, place).withColumn("q", one_of("query_blocks")).withColumn("e", each_of("entry_blocks"))
    key = [*place, "e", "q"]
    left = asked.select(*key, "id", "vector").groupBy(*key)
    right = shown.select(*[F.col(k).alias(f"_{k}") for k in key], "id", "vector").groupBy(*[f"_{k}" for k in key])
    return left.cogroup(right).applyInArrow(
        lambda q, e: _best(q, e, keep), "query_id bigint, id bigint, score double"
    )


def _valid(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
    tables: int = TABLES,
    probes: int = PROBES,
    hashes: int = HASHES,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found other rows of each query, by cosine, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``. Vectors that are null, zero or hold null or
    non-finite numbers take no part, nor do rows without an id; only vectors of equal length
    are compared. Repeated rows count once; of several vectors under one query id the least is
    asked for. A query without other rows to find has no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("vector")))
    # Of equal vectors no more rows can come up than the neighbours and the query itself.
    keep = neighbours + 1
    # Copies of a row go ahead of the ranks, where they would take other ids' places.
    turn = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    least = rows.distinct().withColumn("turn", turn).where(F.col("turn") <= keep)
    entries = least.groupBy("vector").agg(F.min("id").alias("id"), F.slice(F.array_sort(F.collect_set("id")), 1, keep).alias("ids"))
    entries = stage_table(entries, "entries")
    queries = stage_table(rows.where(is_query).groupBy("id").agg(F.min("vector").alias("vector")), "queries")

    def ranked(met: DataFrame) -> DataFrame:
        first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
        # An entry that several tables have found counts once.
        once = met.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        near = once.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= keep)
        members = near.join(entries.select("id", "ids"), "id").select("query_id", "score", F.explode("ids").alias("vec_id"))
        last = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        others = members.where(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(last))
        return others.where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")

    index = _hashed(entries, tables, hashes, 1)
    found = stage_table(ranked(_meet(_hashed(queries, tables, hashes, probes), index, keep, block)), "found")
    # The exact way for queries that found too few: every entry, in blocks.
    served = found.where(F.col("rank") == neighbours).select(F.col("query_id").alias("id"))
    short = stage_table(queries.join(served, "id", "left_anti"), "short")
    everywhere = lambda df: df.select(F.size("vector").alias("dim"), F.lit(-1).alias("part"), F.lit(0).cast("long").alias("bucket"), "id", "vector")
    rest = ranked(_meet(everywhere(short), everywhere(entries), keep, block))
    enough = join_staged(found, served.withColumnRenamed("id", "query_id"), ["query_id"], "left_semi")
    return enough.unionByName(rest)
