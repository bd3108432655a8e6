"""Side-by-side comparison of two models.

``compare_predictions`` runs both models in ONE pass over the input: the
shared feature chain (clean, tokenize, stop words, hash) is evaluated once and
each model's fitted head writes its own prefixed columns.  No join, no
shuffle: the plan is the scan plus one projection chain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.functions.text import first_token
from labelkit.operators import models as mx
from labelkit.operators.evaluate import METRICS
from labelkit.operators.score import confidence

# Display names of the metrics in the comparison table (fixed values).
METRIC_NAMES = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1": "F1 Score"}


def compare_metrics(metrics: Mapping[str, DataFrame] | DataFrame, digits: int = 3, names: Sequence[str] | None = None) -> DataFrame:
    """``(metric, <model>...)``, rounded.

    ``metrics`` is either the output of ``evaluate.evaluate_models`` (one row
    per model, all models scored in one pass) or a mapping from model name to
    a one-row ``evaluate`` output.
    """
    if isinstance(metrics, DataFrame):
        if names is None:
            raise ValueError("give the model names of an evaluate_models table")
        names, table = list(names), metrics.select("model", *METRICS)
    else:
        names, table = list(metrics), None
        for name, m in metrics.items():
            part = m.select(F.lit(name).alias("model"), *METRICS)
            table = part if table is None else table.unionByName(part)
    # One row with every model's metrics, then one output row per metric.
    wide = table.agg(*[F.max(F.when(F.col("model") == n, F.col(k))).alias(f"{i}_{k}") for i, n in enumerate(names) for k in METRICS])
    rows = [
        F.struct(F.lit(shown).alias("metric"), *[F.round(F.col(f"{i}_{k}"), digits).alias(n) for i, n in enumerate(names)])
        for k, shown in METRIC_NAMES.items()
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def compare_predictions(
    df: DataFrame,
    model_a: PipelineModel,
    model_b: PipelineModel,
    keys: Sequence[str] = (),
    text_col: str = "name",
    names: tuple[str, str] = ("lr", "nb"),
    use_first_token: bool = True,
) -> DataFrame:
    """``keys..., name, a_label, a_confidence, b_label, b_confidence,
    models_agree, more_confident_model, preferred_label`` in one pass.

    When both models share the feature chain (same cleaning, stop words and
    hash width - any two models fitted with the same ``num_features`` and
    stop words, whatever their classifier or IDF use) it is evaluated once;
    otherwise each model runs its own chain, still in one projection.
    """
    a, b = names
    pa, pb = f"{a}_", f"{b}_"
    stages = mx.feature_part(model_a) + mx.prefixed_head(model_a, pa)
    if mx.same_features(model_a, model_b):
        stages += mx.prefixed_head(model_b, pb)
    else:
        # Different cleaning / stop words / width: b gets its own prefixed
        # feature chain, still in the same projection (no join).
        stages += mx.prefixed_stages(model_b.stages, pb)
    own = mx.text_col(model_a)
    if mx.text_col(model_b) != own:
        raise ValueError("the models read different text columns")
    src = df.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        (first_token(text_col) if use_first_token else F.col(text_col)).alias(own),
    )
    scored = PipelineModel(stages).transform(src)
    ca, cb = mx.output_cols(model_a), mx.output_cols(model_b)
    out = scored.select(
        *[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)],
        F.col(own).alias(text_col),
        F.col(pa + ca["predicted_label"]).alias(f"{a}_label"),
        confidence(pa + ca["probability"], pa + ca["prediction"]).alias(f"{a}_confidence"),
        F.col(pb + cb["predicted_label"]).alias(f"{b}_label"),
        confidence(pb + cb["probability"], pb + cb["prediction"]).alias(f"{b}_confidence"),
    )
    return with_agreement(out, names)


def with_agreement(df: DataFrame, names: tuple[str, str] = ("lr", "nb")) -> DataFrame:
    """Add ``models_agree``, ``more_confident_model`` (ties go to the first
    model) and ``preferred_label`` (the agreed label, else the label of the
    more confident model)."""
    a, b = names
    agree = F.col(f"{a}_label") == F.col(f"{b}_label")
    a_wins = F.col(f"{a}_confidence") >= F.col(f"{b}_confidence")
    return df.select(
        "*",
        agree.alias("models_agree"),
        F.when(a_wins, F.lit(a)).otherwise(F.lit(b)).alias("more_confident_model"),
        F.when(agree | a_wins, F.col(f"{a}_label")).otherwise(F.col(f"{b}_label")).alias("preferred_label"),
    )


def agreement_rate(compared: DataFrame) -> DataFrame:
    """Share of rows on which both models agree, and the row count."""
    return compared.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col("models_agree").cast("double")).alias("agreement_rate"),
    )
