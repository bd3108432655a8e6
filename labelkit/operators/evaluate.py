"""Accuracy, weighted precision / recall / F1 from one confusion table.

The reference ran the multiclass evaluator four times per model, each time
re-running the whole uncached plan from the text file.  Here one
``groupBy(label, prediction).count()`` (partial aggregation per task, at most
``classes**2`` rows after the shuffle) feeds a tiny aggregate that yields all
four numbers, with the same definitions as Spark's MulticlassMetrics:

* per class c: ``tp`` = rows with label c predicted c, ``pp`` = rows predicted
  c, ``sup`` = rows with label c;
* ``precision = tp/pp`` (0 if ``pp`` = 0), ``recall = tp/sup``,
  ``f1 = 2pr/(p+r)`` (0 if ``p+r`` = 0);
* accuracy = sum(tp)/sum(sup), weighted metric = sum(metric*sup)/sum(sup).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion_table(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``: one row per observed pair."""
    return scored.groupBy(F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., cls, tp, pp, sup, precision, recall, f1)`` from a confusion
    table ``(by..., label, prediction, n)``."""
    by = list(by)
    n = F.col("n").cast("double")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(F.lit(0.0))
    zero = F.lit(0.0)
    sides = F.array(
        F.struct(F.col("label").alias("cls"), hit.alias("tp"), zero.alias("pp"), n.alias("sup")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("tp"), n.alias("pp"), zero.alias("sup")),
    )
    stats = (
        cm.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.cls").alias("cls"))
        .agg(F.sum("s.tp").alias("tp"), F.sum("s.pp").alias("pp"), F.sum("s.sup").alias("sup"))
    )
    p = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(F.lit(0.0))
    r = F.when(F.col("sup") > 0, F.col("tp") / F.col("sup")).otherwise(F.lit(0.0))
    stats = stats.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(
        (F.col("precision") + F.col("recall")) > 0,
        2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(F.lit(0.0))
    return stats.withColumn("f1", f1)


def metrics_from_confusion(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., accuracy, precision, recall, f1`` (weighted by class support):
    one row, or one row per ``by`` group."""
    pc = per_class(cm, by)
    total = F.sum("sup")
    return pc.groupBy(*by).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("sup")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("sup")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("sup")) / total).alias("f1"),
    )


def evaluate(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """All four metrics of one scored table, as one row.

    Labels and predictions may be indexes or the label strings themselves
    (``gender``, ``predicted_label``).  With strings a label that the model has
    never seen counts as an error like any other.
    """
    return metrics_from_confusion(confusion_table(scored, label_col, prediction_col))


def accuracy(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    return evaluate(scored, label_col, prediction_col).select("accuracy")


def weighted_precision(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    return evaluate(scored, label_col, prediction_col).select("precision")


def weighted_recall(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    return evaluate(scored, label_col, prediction_col).select("recall")


def weighted_f1(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    return evaluate(scored, label_col, prediction_col).select("f1")


def evaluate_models(rows: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """``(model, accuracy, precision, recall, f1)`` for several models in ONE
    pass over ``rows`` (labelled rows that already carry ``raw_features``,
    e.g. ``Prepared.test``).

    Every model's scoring head runs in one projection with prefixed columns.
    One ``groupBy`` over all ``(label, predictions...)`` combinations (partially
    aggregated per task) follows, and the per-model confusion tables are sums
    over it.  Labels are compared as strings, so a label that no model has seen
    is an error row.
    """
    from labelkit.operators import models as mx

    stages, cols = [], []
    for name, model in models.items():
        prefix = f"{name}_"
        stages += mx.prefixed_head(model, prefix)
        cols.append((name, mx.label_indexer(model).getInputCol(), prefix + mx.output_cols(model)["predicted_label"]))
    scored = PipelineModel(stages).transform(rows)
    seen = dict.fromkeys(c for _, lab, pred in cols for c in (lab, pred))
    cube = scored.groupBy(*seen).agg(F.count(F.lit(1)).alias("n"))
    per_model = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(lab).alias("label"), F.col(pred).alias("prediction"))
            for name, lab, pred in cols
        ]
    )
    cm = (
        cube.select(F.explode(per_model).alias("m"), "n")
        .groupBy("m.model", "m.label", "m.prediction")
        .agg(F.sum("n").alias("n"))
    )
    return metrics_from_confusion(cm, ["model"])
