"""Model evaluation as DataFrames (K1-K9, C17, H1).

All classification metrics come from one confusion-count aggregation ``groupBy(group, label, prediction).count()``
(map-side combined, classes^2 rows per group), so accuracy, weighted precision/recall/F1, per-class scores and the
confusion matrix cost one pass over the predictions, and several splits or models are evaluated together by adding
a group column. Labels and predictions may be indices or class names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.expressions import accuracy_verdict, index_to_label, overfitting_flag, safe_div
from ..session import ensure_checkpoint_dir
from .ordered import cumulative_by_value
from .pairwise import classes_of, packed_units

#: Classes of a block of the dense confusion matrix, and its rows that are written at once.
GRID_CLASSES = 512
GRID_ROWS = 64


def confusion_counts(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """K5 (sparse): ``group..., actual, predicted, count`` for observed cells; NULL labels are left out."""
    g = list(group_cols)
    return pred.where(F.col(label_col).isNotNull() & F.col(prediction_col).isNotNull()) \
        .groupBy(*g, F.col(label_col).alias("actual"), F.col(prediction_col).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("count"))


def _per_class(counts: DataFrame, g: list[str]) -> DataFrame:
    """``group..., class, tp, support (actual), predicted_n`` over the union of actual and predicted classes."""
    # Each confusion cell speaks for two classes: as the actual class (support, true positives) and as the predicted
    # class (predicted count). Exploding the two roles and summing once replaces a join of two aggregates.
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(zero)
    roles = F.array(
        F.struct(F.col("actual").alias("class"), F.col("count").alias("support"), hit.alias("tp"),
                 zero.alias("predicted_n")),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"), zero.alias("tp"),
                 F.col("count").alias("predicted_n")))
    return counts.select(*g, F.inline(roles)).groupBy(*g, "class").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted_n").alias("predicted_n"))


def per_class_metrics(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """K4: ``class, precision, recall, f1, support``; 0 where undefined (the sklearn default)."""
    g = list(group_cols)
    pc = _per_class(confusion_counts(pred, label_col, prediction_col, g), g)
    p = F.coalesce(safe_div("tp", "predicted_n"), F.lit(0.0))
    r = F.coalesce(safe_div("tp", "support"), F.lit(0.0))
    f1 = F.coalesce(safe_div(2 * p * r, p + r), F.lit(0.0))
    return pc.select(*g, "class", p.alias("precision"), r.alias("recall"), f1.alias("f1"),
                     F.col("support").cast("long").alias("support"))


def classification_metrics(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                           group_cols: Sequence[str] = ()) -> DataFrame:
    """K1/K7: ``group..., n, accuracy, f1_score, precision, recall`` (weighted by true-class support).

    Same definitions as ``MulticlassClassificationEvaluator`` metrics ``accuracy``, ``f1``, ``weightedPrecision``,
    ``weightedRecall``: classes that are only predicted weigh 0; a class never predicted has precision 0.
    """
    g = list(group_cols)
    scores = per_class_metrics(pred, label_col, prediction_col, g)
    w = F.col("support").cast("double")
    out = scores.groupBy(*g).agg(
        F.sum("support").alias("n"),
        F.sum(F.col("recall") * w).alias("_tp"),
        F.sum(F.col("f1") * w).alias("_f1"),
        F.sum(F.col("precision") * w).alias("_p"),
        F.sum(F.col("recall") * w).alias("_r"))
    return out.select(*g, F.col("n").cast("long").alias("n"),
                      safe_div("_tp", "n").alias("accuracy"), safe_div("_f1", "n").alias("f1_score"),
                      safe_div("_p", "n").alias("precision"), safe_div("_r", "n").alias("recall"))


def accuracy_by_counting(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """C17: share of all rows with ``label == prediction``; a NULL on either side is a miss (NULL for no rows)."""
    hit = F.coalesce(F.col(label_col) == F.col(prediction_col), F.lit(False))
    return pred.agg(F.avg(hit.cast("double")).alias("accuracy"))


def confusion_matrix(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                     classes: Sequence[str] | None = None) -> DataFrame:
    """K5: dense ``actual, predicted, count`` over classes x classes, keyed by class (not by axis position).

    The classes (the union of labels and predictions unless given) are packed into blocks; every two blocks meet
    (``pairwise.packed_units``), are joined to the packed cells observed between them, and a task writes the cells of one
    meeting at a time. Neither classes nor cells pass through the driver or one task, and no row of the grid is shuffled:
    what is, is a list of classes for every two blocks. The predictions are read once.
    """
    counts = confusion_counts(pred, label_col, prediction_col)
    kind = counts.schema["actual"].dataType
    counts = counts.withColumn("predicted", F.col("predicted").cast(kind))
    ensure_checkpoint_dir(pred.sparkSession)
    counts = counts.checkpoint(eager=True)  # the observed cells
    if classes is None:
        table = classes_of(counts.select(F.explode(F.array("actual", "predicted")).alias("cls")), "cls", None).table.select("cls")
    else:
        table = classes_of(counts, "actual", classes).table.select("cls")
    blocks = max(1, math.ceil(table.count() / GRID_CLASSES))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    packed = table.groupBy(block("cls").alias("block")).agg(F.collect_list("cls").alias("cls"))
    cells = counts.select(block("actual").alias("l_block"), block("predicted").alias("r_block"), "actual", "predicted", "count")
    lists = cells.groupBy("l_block", "r_block").agg(F.collect_list(F.struct("actual", "predicted", "count")).alias("cells"))
    # the number of tasks is set here: AQE would merge them by the bytes of the lists, not of the grid
    parts = min(blocks * blocks, max(blocks, int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))))
    units = packed_units(packed, blocks, half=False).repartition(parts, "l_block", "r_block")
    met = units.join(lists, ["l_block", "r_block"], "left").select(
        "l_cls", "r_cls", *[F.col(f"cells.{c}").alias(c) for c in ("actual", "predicted", "count")])
    schema = StructType([StructField("actual", kind), StructField("predicted", kind), StructField("count", LongType())])
    return met.mapInArrow(_dense_cells, schema)


def _dense_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class of the first list and class of the second, with the count of the cell or 0."""
    for batch in batches:
        for row in range(batch.num_rows):
            left, right = (batch.column(c)[row].values for c in ("l_cls", "r_cls"))
            grid = np.zeros((len(left), len(right)), np.int64)
            if batch.column("count")[row].is_valid:
                at = [pc.index_in(batch.column(c)[row].values, value_set=v).to_numpy(zero_copy_only=False).astype(np.float64)
                      for c, v in (("actual", left), ("predicted", right))]
                seen = ~(np.isnan(at[0]) | np.isnan(at[1]))  # cells of classes that weren't asked for go
                np.add.at(grid, (at[0][seen].astype(np.int64), at[1][seen].astype(np.int64)),
                          batch.column("count")[row].values.to_numpy()[seen])
            for lo in range(0, len(left), GRID_ROWS):
                some = left.slice(lo, GRID_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [some.take(pa.array(np.repeat(np.arange(len(some)), len(right)))),
                     right.take(pa.array(np.tile(np.arange(len(right)), len(some)))), pa.array(grid[lo:lo + GRID_ROWS].ravel())],
                    ["actual", "predicted", "count"])


def overfitting_gap(pred: DataFrame, split_col: str = "split", label_col: str = "label",
                    prediction_col: str = "prediction", threshold: float = 0.15) -> DataFrame:
    """K6: ``train_accuracy, test_accuracy, gap, overfitting, verdict`` from one grouped pass over both splits."""
    acc = pred.groupBy(split_col).agg(F.avg((F.col(label_col) == F.col(prediction_col)).cast("double")).alias("a"))
    row = acc.agg(F.max(F.when(F.col(split_col) == "train", F.col("a"))).alias("train_accuracy"),
                  F.max(F.when(F.col(split_col) == "test", F.col("a"))).alias("test_accuracy"))
    gap = F.col("train_accuracy") - F.col("test_accuracy")
    return row.select("train_accuracy", "test_accuracy", gap.alias("gap"),
                      overfitting_flag(gap, threshold).alias("overfitting"),
                      accuracy_verdict("test_accuracy").alias("verdict"))


def regression_metrics(pred: DataFrame, label_col: str, prediction_col: str = "prediction") -> DataFrame:
    """K3: one row ``RMSE, R2, MAE`` in one aggregation (R2 uses the population variance of the label x n)."""
    y, yhat = F.col(label_col).cast("double"), F.col(prediction_col).cast("double")
    valid = pred.where(y.isNotNull() & yhat.isNotNull())
    row = valid.agg(F.count(F.lit(1)).alias("n"), F.sum((y - yhat) * (y - yhat)).alias("sse"),
                    F.sum(F.abs(y - yhat)).alias("sae"), F.var_pop(y).alias("vy"))
    return row.select(F.sqrt(safe_div("sse", "n")).alias("RMSE"),
                      (F.lit(1.0) - safe_div(F.col("sse"), F.col("vy") * F.col("n"))).alias("R2"),
                      safe_div("sae", "n").alias("MAE"))


def auc_roc(pred: DataFrame, label_col: str = "label", score_col: str = "score", positive=1.0,
            num_partitions: int | None = None) -> DataFrame:
    """K2: exact area under the ROC curve of a score for a binary label, ties counted one half.

    ``AUC = sum over scores s of pos(s) * (neg(< s) + neg(= s) / 2) / (P * N)``, with the negative counts below each
    score from the range-partitioned prefix sums (no single sorted task, no binning).
    """
    base = pred.where(F.col(label_col).isNotNull() & F.col(score_col).isNotNull()).select(
        F.col(score_col).cast("double").alias("s"),
        (F.col(label_col) == F.lit(positive)).cast("long").alias("pos"),
        (F.col(label_col) != F.lit(positive)).cast("long").alias("neg"))
    cum = cumulative_by_value(base, [], "s", ["pos", "neg"], num_partitions)
    area = cum.agg(F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0))
                   .alias("_area"), F.max("total_pos").alias("P"), F.max("total_neg").alias("N"))
    return area.select(
        safe_div(F.col("_area"), F.col("P") * F.col("N")).alias("auc"),
        F.col("P").cast("long").alias("positives"), F.col("N").cast("long").alias("negatives"))


def prediction_sample(pred: DataFrame, key_col: str, columns: Sequence[str], n: int = 20) -> DataFrame:
    """D3: the first ``n`` predictions by key: a repeatable top-k report (the reference's unordered ``limit``)."""
    return pred.select(key_col, *columns).orderBy(key_col).limit(n)


def with_predicted_label(pred: DataFrame, labels: Sequence[str], prediction_col: str = "prediction",
                         out_col: str = "predicted_label") -> DataFrame:
    """H1/K9: map a predicted index to its class name, ``"Unknown"`` when out of range (no Python UDF)."""
    return pred.withColumn(out_col, index_to_label(prediction_col, labels))


def feature_importance(model, feature_names: Sequence[str]) -> DataFrame:
    """K8: ``feature, importance`` ascending, from a fitted tree model (or a PipelineModel ending in one)."""
    from pyspark.sql import SparkSession

    stage = model.stages[-1] if hasattr(model, "stages") else model
    values = stage.featureImportances.toArray().tolist()
    if len(values) != len(feature_names):
        raise ValueError(f"{len(values)} importances for {len(feature_names)} names")
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(feature_names, [float(v) for v in values])), "feature string, importance double")
    return df.orderBy("importance", "feature")
