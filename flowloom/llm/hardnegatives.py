"""Hard negatives by rotated one-bit codes, with intervals that decide which rows are scored in integers.

A vector of whole numbers is turned by one random rotation. Its code is the signs of its components, and its
alignment with the code vector is stored; what is left of it is coded again, ``LEVELS`` times in all, and the
length of the last remainder is stored too. Queries are cut into 8 bit planes, so a code is weighed by counting bits.

The estimate of an inner product errs by what the remainder can add. By Cauchy-Schwarz that is no more than the remainder's
length times that of the query off the last code vector, and the same holds for what the bit planes round
away. So each pair has an interval that surely holds its score. Rows whose interval cannot reach the result
are dropped; the others are scored exactly. Nothing is missed, whatever the codes are worth.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.cells import meet
from flowloom.plans.staging import stage_table

POSITIVES = 5
NEGATIVES = 5
# A negative's score in hundredths of the positive's: at least, and at most.
BAND = (80, 100)
SCALE = 256
LEVELS = 4
SEED = 1
CELL_ROWS = 4096
CELL_QUERIES = 4096
_PLANES = 8
_LONG = (1 << 63) - 1
# Sums of products up to here are exact in floating point.
_EXACT = 1 << 53
# Room for rounding, as a part of the product of lengths.
_SLACK = 1e-9


@lru_cache(8)
def rotation(size: int) -> np.ndarray:
    made, _ = np.linalg.qr(np.random.default_rng([SEED, size]).standard_normal((size, size)))
    return made


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as words of 64 bits."""
    raw = np.packbits(bits, axis=-1)
    spare = -raw.shape[-1] % 8
    return np.ascontiguousarray(np.pad(raw, [(0, 0)] * (raw.ndim - 1) + [(0, spare)])).view(np.uint64)


class Codes:
    """Codes, alignments and remainders of rows of whole numbers."""

    def __init__(self, rows: np.ndarray, levels: int = LEVELS) -> None:
        size = rows.shape[1]
        rest = rows @ rotation(size).T
        self.length = np.sqrt((rest * rest).sum(axis=1))
        bits, align = [], []
        for _ in range(levels):
            positive = rest >= 0
            own = np.abs(rest).sum(axis=1) / np.sqrt(size)
            rest = rest - own[:, None] * np.where(positive, 1.0, -1.0) / np.sqrt(size)
            bits.append(_packed(positive))
            align.append(own)
        self.bits, self.align = np.stack(bits, axis=1), np.stack(align, axis=1)
        self.rest = np.sqrt((rest * rest).sum(axis=1))


class Planes:
    """Rotated queries in bit planes."""

    def __init__(self, rows: np.ndarray) -> None:
        self.size = rows.shape[1]
        turned = rows @ rotation(self.size).T
        self.low = turned.min(axis=1)
        self.step = (turned.max(axis=1) - self.low) / ((1 << _PLANES) - 1)
        self.step[self.step == 0] = 1.0
        steps = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        off = turned - (self.low[:, None] + self.step[:, None] * steps)
        self.off, self.length = np.sqrt((off * off).sum(axis=1)), np.sqrt((turned * turned).sum(axis=1))
        self.total = self.low * self.size + self.step * steps.sum(axis=1)
        self.planes = np.stack([_packed((steps >> p) & 1 == 1) for p in range(_PLANES)], axis=1)

    def intervals(self, query: int, codes: Codes, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score that ``rows`` can have with a query; any, where numbers are too large to tell."""
        bits = codes.bits[rows]
        ones = np.bitwise_count(bits).sum(axis=2, dtype=np.int64)
        weight = np.zeros(ones.shape)
        for p in range(_PLANES):
            weight += np.bitwise_count(bits & self.planes[query, p]).sum(axis=2, dtype=np.int64) << p
        along = (2 * (self.low[query] * ones + self.step[query] * weight) - self.total[query]) / np.sqrt(self.size)
        middle = (codes.align[rows] * along).sum(axis=1)
        surely = np.maximum(0.0, np.abs(along[:, -1]) - self.off[query])
        across = np.sqrt(np.maximum(0.0, self.length[query] ** 2 - surely**2))
        rest, length = codes.rest[rows], codes.length[rows]
        reach = rest * across + (length + rest) * self.off[query] + _SLACK * (1 + length) * (1 + self.length[query])
        known = np.isfinite(middle) & np.isfinite(reach)
        # Scores are longs, and end where longs end.
        ends = np.clip(np.where(known, np.stack((middle - reach, middle + reach)), [[-np.inf], [np.inf]]), -_LONG, _LONG)
        return ends[0], ends[1]


def scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as longs, exact; beyond a long's range they are its ends."""
    if np.abs(query).max(initial=0) * np.abs(rows).max(initial=0) * len(query) < _EXACT:
        return (rows @ query).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(query.tolist(), row, strict=True)) for row in rows.tolist()]
    return np.array([max(-_LONG - 1, min(_LONG, x)) for x in exact], np.int64)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(table: pa.Table) -> Codes:
    codes = Codes.__new__(Codes)
    codes.align = _matrix(table, "align")
    codes.bits = _matrix(table, "bits").view(np.uint64).reshape(table.num_rows, codes.align.shape[1], -1)
    codes.rest, codes.length = table.column("rest").to_numpy(), table.column("length").to_numpy()
    return codes


def _top(ids: np.ndarray, score: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, ~score))[:keep]


def _rows(names: list[str], parts: list[tuple]) -> pa.Table:
    columns = zip(*parts, strict=True) if parts else [[] for _ in names]
    return pa.table({n: pa.array(np.concatenate([*c, np.array([], np.int64)]), pa.int64()) for n, c in zip(names, columns, strict=True)})


@np.errstate(over="ignore", invalid="ignore")
def positives_of_cell(entries: pa.Table, queries: pa.Table, keep: int) -> pa.Table:
    """(anchor_id, positive_id, positive_score): of each query the best rows of its label in the cell."""
    ids, labels, whole = entries.column("id").to_numpy(), entries.column("label").to_numpy(), _matrix(entries, "whole")
    asked, codes, out = _matrix(queries, "whole"), _codes(entries), []
    planes = Planes(asked)
    own = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
    for at, (anchor, label) in enumerate(zip(*(queries.column(c).to_pylist() for c in ("id", "label")), strict=True)):
        rows = own.get(label, np.array([], np.int64))
        rows = rows[ids[rows] != anchor]
        if len(rows) > keep:
            least, most = planes.intervals(at, codes, rows)
            rows = rows[most >= np.partition(least, -keep)[-keep]]
        score = scores(asked[at], whole[rows])
        best = _top(ids[rows], score, keep)
        out.append((np.full(len(best), anchor), ids[rows[best]], score[best]))
    return _rows(["anchor_id", "positive_id", "positive_score"], out)


def within_reach(least: np.ndarray, most: np.ndarray, low: int, high: int, keep: int) -> np.ndarray:
    """Places whose interval leaves room for one of the ``keep`` highest scores from ``low`` to ``high``."""
    room = (most >= low) & (least <= high)
    sure = least[room & (least >= low) & (most <= high)]
    return np.flatnonzero(room & (most >= np.partition(sure, -keep)[-keep])) if len(sure) >= keep else np.flatnonzero(room)


@np.errstate(over="ignore", invalid="ignore")
def negatives_of_cell(entries: pa.Table, queries: pa.Table, keep: int, band: tuple[int, int]) -> pa.Table:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score): of each positive the best negatives in the cell."""
    ids, labels, whole = entries.column("id").to_numpy(), entries.column("label").to_numpy(), _matrix(entries, "whole")
    asked, codes, out = _matrix(queries, "whole"), _codes(entries), []
    planes = Planes(asked)
    for at, (anchor, label, positives) in enumerate(zip(*(queries.column(c).to_pylist() for c in ("id", "label", "positives")), strict=True)):
        rows = np.flatnonzero((labels != label) & (ids != anchor))
        least, most = planes.intervals(at, codes, rows)
        for positive in positives:
            value = positive["positive_score"]
            # Hundredths in whole numbers: low is rounded up, high down.
            low, high = -(-band[0] * value // 100), band[1] * value // 100
            near = rows[within_reach(least, most, low, high, keep)]
            score = scores(asked[at], whole[near])
            near, score = near[(score >= low) & (score <= high)], score[(score >= low) & (score <= high)]
            best = _top(ids[near], score, keep)
            many = len(best)
            out.append((np.full(many, anchor), np.full(many, positive["positive_id"]), np.full(many, value), ids[near[best]], score[best]))
    return _rows(["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], out)


def index(rows: DataFrame, scale: int = SCALE, levels: int = LEVELS) -> DataFrame:
    """(dim, id, label, whole, bits, align, rest, length) of rows (id, label, vector): components floor(scale * x) and their codes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            vectors = part.column(2).to_pylist()
            by_size: dict[int, list[int]] = {}
            for row, vector in enumerate(vectors):
                by_size.setdefault(len(vector), []).append(row)
            for size, own in by_size.items():
                with np.errstate(over="ignore"):
                    # Components beyond the range of doubles count as its ends.
                    whole = np.nan_to_num(np.floor(float(scale) * np.array([vectors[r] for r in own], np.float64)))
                # Lengths of huge vectors would overflow; a scaled copy has the same code.
                unit = np.maximum(1.0, np.abs(whole).max(axis=1) / 1e100)
                codes = Codes(whole / unit[:, None], levels)
                lists = lambda a, kind: pa.array(list(a.reshape(len(own), -1)), pa.list_(kind))  # noqa: B023, E731
                taken = part.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), size), pa.int32()), taken.column(0), taken.column(1), lists(whole, pa.float64()),
                        lists(codes.bits.view(np.int64), pa.int64()), lists(codes.align * unit[:, None], pa.float64()),
                        pa.array(codes.rest * unit), pa.array(codes.length * unit),
                    ],
                    names=["dim", "id", "label", "whole", "bits", "align", "rest", "length"],
                )

    schema = "dim int, id bigint, label bigint, whole array<double>, bits array<bigint>, align array<double>, rest double, length double"
    return rows.select("id", "label", "vector").mapInArrow(run, schema)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    scale: int = SCALE,
    cell_rows: int = CELL_ROWS,
    cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``. An anchor's positives are its best other rows of its
    label; for each the best rows of other labels whose score lies in the band come back, ranked. Scores are inner
    products of whole components; ties go to the smaller id. Rows with a null id or label, a null or empty vector
    or null or non-finite components take no part. Rows of one id count as one, that of the least label and vector;
    only vectors of equal length are compared. No rows give no rows.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite))
    once = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")
    entries = stage_table(index(once, scale), "index")
    queries = stage_table(entries.where(is_anchor).select("dim", "id", "label", "whole"), "queries")

    def best(met: DataFrame, by: list[str], score: str, other: str, keep: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col(score).desc(), other)
        return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)

    sizes, schema = (cell_rows, cell_queries), "anchor_id bigint, positive_id bigint, positive_score bigint"
    met = meet(entries, queries, ["dim"], "id", sizes, lambda e, q: positives_of_cell(e, q, positives), schema)
    chosen = best(met, ["anchor_id"], "positive_score", "positive_id", positives)
    lists = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = stage_table(queries.join(lists.withColumnRenamed("anchor_id", "id"), "id"), "asked")
    more = schema + ", negative_id bigint, negative_score bigint"
    met = meet(entries, asked, ["dim"], "id", sizes, lambda e, q: negatives_of_cell(e, q, negatives, band), more)
    found = best(met, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
