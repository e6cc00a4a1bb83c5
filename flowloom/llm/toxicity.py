"""Toxicity by logistic regression over hashed word n-grams, fitted with FTRL-proximal.

Features are the distinct words, word pairs and pairs with one word between them, hashed to
``2 ** BITS`` places. Each place has its own learning rate, and the L1 term keeps most
weights at exactly zero, so the model is a short list that is sent to executors.

The fit reads a sample of about ``SAMPLE_ROWS`` labelled documents (a documented bound): those
whose hashed id falls below ``SAMPLE_ROWS`` in the number of labelled documents. Scoring
reads all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowloom.llm.batches import keep_or_rewrite, map_rows, slices

BITS = 18
SAMPLE_ROWS = 16_000
ROUNDS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 7.0, 0.1
THRESHOLD = 0.5
HELD_OUT_OF = 5

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Odd multipliers of the three kinds of features.
_ONE, _NEXT, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Places of a text's features; one may come several times. An empty text has none."""
    words = _WORD.findall(text.encode().lower()) if text else []
    if not words:
        return np.zeros(0, np.int64)
    own = np.array(list(map(zlib.crc32, words)), np.uint64) + np.uint64(1)
    shift = np.uint64(64 - bits)
    one = own * _ONE
    kinds = [one, (one[:-1] ^ (one[:-1] >> np.uint64(29))) * _NEXT + one[1:] * _SKIP]
    if len(own) > 2:
        kinds.append((one[:-2] ^ (one[:-2] >> np.uint64(31))) * _SKIP + one[2:] * _NEXT)
    mixed = np.concatenate(kinds)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _NEXT
    return (mixed >> shift).astype(np.int64)


class Ftrl:
    """State of FTRL-proximal; the last place is the intercept, which has no L1 term."""

    def __init__(self, bits: int = BITS) -> None:
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(z.shape, L1)
        l1[-1] = 0.0  # callers put the intercept last
        pull = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -pull / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        slope = sigmoid(float(weights.sum())) - label
        n = self.n[at]
        step = (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA
        self.z[at] += slope - step * weights
        self.n[at] = n + slope * slope


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


class Model:
    """Non-zero weights by place, and the intercept."""

    def __init__(self, places: list[int], weights: list[float], intercept: float, bits: int = BITS) -> None:
        self.places, self.values, self.intercept, self.bits = places, weights, intercept, bits

    def scorer(self):
        dense = np.zeros(1 << self.bits)
        dense[self.places] = self.values

        def score(text: str | None) -> float:
            at = features(text, self.bits)
            used = np.unique(at[dense[at] != 0])
            return sigmoid(self.intercept + float(dense[used].sum()))

        return score


def held_out(id_col: str) -> Column:
    """Whether the CRC-32 of the id as text is divisible by five; a null id is not held out."""
    rest = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(HELD_OUT_OF)) == 0
    return F.coalesce(rest, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    bits: int = BITS,
) -> Model:
    """A model of labelled rows that are not held out; without such rows all scores are one half."""
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    share = min(1.0, sample_rows / max(1, known.count()))
    picked = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 30)) < int(share * (1 << 30))

    def as_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [np.unique(features(t, bits)).astype(np.int32).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made), part.column(2)], names=["_id", "_at", "_label"])

    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(picked("_id"))
    # Rows of one id are one example, that of the least text digest, however often the id repeats.
    least = F.min_by("_text", F.md5(F.coalesce("_text", F.lit(""))))
    examples = (
        chosen.join(known.where(picked("_id")), "_id")
        .groupBy("_id")
        .agg(least.alias("_text"), F.first("_label").alias("_label"))
        .select(F.col("_id").cast("string").alias("_id"), "_text", "_label")
        .mapInArrow(as_features, "_id string, _at binary, _label int")
    )

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort(key=lambda r: (zlib.crc32(r[0].encode()), r))
        state = Ftrl(bits)
        for _ in range(ROUNDS):
            for _, at, label in rows:
                state.learn(np.append(np.frombuffer(at, np.int32).astype(np.int64), 1 << bits), label)
        weights = state.weights(slice(None))
        places = np.flatnonzero(weights[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([places.tolist()]), pa.array([weights[places].tolist()]), pa.array([float(weights[-1])])],
            names=["places", "weights", "intercept"],
        )

    # The sample is bounded by sample_rows; one task goes through it in a fixed order.
    row = examples.repartition(1).mapInArrow(learn, "places array<bigint>, weights array<double>, intercept double").first()
    return Model(row["places"], row["weights"], row["intercept"], bits) if row else Model([], [], 0.0, bits)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row.

    A null or empty text gets the score of the intercept; a null id passes through; repeated
    rows are kept; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        of = sent.value.scorer()

        def row(key, out, text):
            value = of(text)
            return key, out, value, int(value >= THRESHOLD)

        return row

    rows = docs.select(F.col(id_col).alias("_key"), held_out(id_col).alias("_out"), F.col(text_col).alias("_text"))
    fields = [
        ("doc_id", id_type, to_arrow_type(docs.schema[id_col].dataType)),
        ("held_out", "boolean", pa.bool_()),
        ("score", "double", pa.float64()),
        ("predicted", "int", pa.int32()),
    ]
    return map_rows(rows, ["_key", "_out", "_text"], make, fields)


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model calls toxic; all columns and other rows stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = sent.value.scorer()
        return lambda text: (of(text) < THRESHOLD, text)

    return keep_or_rewrite(docs, text_col, make, None)
