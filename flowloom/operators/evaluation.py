"""Predictions, macro metrics, confusion matrix and the best epoch of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.ranks import max_before_slice

# Fixed value: evaluations without a better score before a run stops.
PATIENCE = 3

_SLICE_EPOCHS = 4096


def argmax(scores: Column) -> Column:
    """0-based position of the largest score; the first one wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def score_predictions(predictions: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """``key…, y_true, y_pred`` from ``logits`` and the true ``label`` of the same key."""
    predicted = predictions.select(*key, argmax(F.col("logits")).alias("y_pred"))
    truth = labels.select(*key, F.col("label").alias("y_true"))
    return predicted.join(truth, key).select(*key, "y_true", "y_pred")


def pair_counts(scored: DataFrame, by: list[str] = []) -> DataFrame:
    """``by…, y_true, y_pred, n``: all that the metrics need, combined before the shuffle."""
    return scored.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


def _per_label(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Support, predicted and hit counts per label, from both ends of each pair."""
    ends = F.array(
        F.struct(F.col("y_true").alias("label"), F.lit(True).alias("real")),
        F.struct(F.col("y_pred").alias("label"), F.lit(False).alias("real")),
    )
    each = pairs.select(*by, "n", (F.col("y_true") == F.col("y_pred")).alias("hit"), F.inline(ends))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return each.groupBy(*by, "label").agg(
        total(F.col("real")).alias("support"),
        total(~F.col("real")).alias("predicted"),
        total(F.col("real") & F.col("hit")).alias("hits"),
    )


def per_class_metrics(scored: DataFrame, by: list[str] = []) -> DataFrame:
    """Precision, recall and F1 of every true or predicted label; 0 where undefined."""

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    both = F.col("support") + F.col("predicted")
    return _per_label(pair_counts(scored, by), by).select(
        *by,
        "label",
        "support",
        "predicted",
        "hits",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), both).alias("f1"),
    )


def eval_metrics(scored: DataFrame, by: list[str] = []) -> DataFrame:
    """Rows, accuracy and macro precision, recall and F1 (plain means over labels)."""
    return per_class_metrics(scored, by).groupBy(*by).agg(
        F.sum("support").alias("n"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
    )


def confusion_matrix(scored: DataFrame, by: list[str] = []) -> DataFrame:
    """``by…, y_true, counts``: one row per label, ``counts`` along the sorted labels.

    Works on the pair counts. A row of the matrix is one array, filled with zeros
    where a pair never occurs.
    """
    pairs = pair_counts(scored, by)
    labels = (
        pairs.select(*by, F.explode(F.array("y_true", "y_pred")).alias("label"))
        .groupBy(*by)
        .agg(F.array_sort(F.collect_set("label")).alias("labels"))
    )
    found = pairs.groupBy(*by, "y_true").agg(
        F.map_from_entries(F.collect_list(F.struct("y_pred", "n"))).alias("found")
    )
    rows = labels.select(*by, "labels", F.explode("labels").alias("y_true"))
    zero = F.lit(0).cast("bigint")
    return rows.join(found, [*by, "y_true"], "left").select(
        *by,
        "y_true",
        "labels",
        F.transform(
            "labels", lambda label: F.coalesce(F.try_element_at("found", label), zero)
        ).alias("counts"),
    )


def confusion_long(scored: DataFrame, by: list[str] = []) -> DataFrame:
    """The same matrix as ``by…, y_true, y_pred, n`` rows, zeros kept."""
    cells = F.arrays_zip(F.col("labels").alias("y_pred"), F.col("counts").alias("n"))
    return confusion_matrix(scored, by).select(*by, "y_true", F.inline(cells))


def best_epoch(
    metrics: DataFrame, run: str = "run", epoch: str = "epoch", score: str = "f1",
    patience: int = PATIENCE,
) -> DataFrame:
    """``run, n_epochs, stop_epoch, best_epoch, best_score`` of every run.

    A run stops once ``patience`` evaluations in a row do not beat the best score
    so far; the best epoch is the last that did up to there. Epochs are numbered
    1…n. A long run is scanned in slices of epochs that carry the best score and
    the best epoch of earlier slices, so no task sees a whole run.
    """
    sliced = metrics.select(
        F.col(run).alias("run"), F.col(epoch).alias("epoch"), F.col(score).alias("score"),
        F.floor((F.col(epoch) - 1) / _SLICE_EPOCHS).alias("_slice"),
    )
    key = ["run", "_slice"]
    inside = Window.partitionBy(*key).orderBy("epoch")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)

    carried = max_before_slice(sliced, ["run"], "_slice", F.col("score"), "_carried_score")
    ahead = F.greatest("_carried_score", F.max("score").over(before))
    improving = sliced.join(carried, key).withColumn("_ahead", ahead).withColumn(
        "_improved",
        F.when(F.col("_ahead").isNull() | (F.col("score") > F.col("_ahead")), F.col("epoch")),
    )
    last = max_before_slice(improving, ["run"], "_slice", F.col("_improved"), "_carried_epoch")
    tracked = improving.join(last, key).withColumn(
        "_best", F.greatest("_carried_epoch", F.max("_improved").over(so_far))
    )
    stalled = F.col("epoch") - F.col("_best") >= patience
    state = F.struct("epoch", "_best", F.greatest("_ahead", "score").alias("_top"))
    ends = tracked.groupBy("run").agg(
        F.max("epoch").alias("n_epochs"),
        F.coalesce(F.min(F.when(stalled, state)), F.max(state)).alias("_stop"),
    )
    return ends.select(
        "run",
        "n_epochs",
        F.col("_stop")["epoch"].alias("stop_epoch"),
        F.col("_stop")["_best"].alias("best_epoch"),
        F.col("_stop")["_top"].alias("best_score"),
    )
