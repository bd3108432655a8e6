"""Scoring: whole tables through a fitted model, map-only (no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.functions.text import first_token
from labelkit.operators import models as mx


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Append features, ``prediction``, ``probability``, ``predicted_label``.

    A table without the label column skips the label-index stage.
    """
    return model.transform(df)


def confidence(probability_col: str = mx.PROBABILITY_COL, prediction_col: str = mx.PREDICTION_COL) -> Column:
    """Probability of the predicted class."""
    return F.get(vector_to_array(F.col(probability_col)), F.col(prediction_col).cast("int"))


def decode_prediction(scored: DataFrame, model: PipelineModel, prefix: str = "") -> DataFrame:
    """Add ``<prefix>confidence``; ``<prefix>predicted_label`` comes from the
    model's own index-to-label stage."""
    cols = mx.output_cols(model)
    return scored.withColumn(
        f"{prefix}confidence", confidence(f"{prefix}{cols['probability']}", f"{prefix}{cols['prediction']}")
    )


def predict_names(
    df: DataFrame,
    model: PipelineModel,
    keys: Sequence[str] = (),
    text_col: str = "name",
    use_first_token: bool = True,
) -> DataFrame:
    """Name -> first word -> features -> model -> ``predicted_label, confidence``.

    Output: ``keys..., name, predicted_label, confidence``.  The reference did
    this for one typed name with a ``collect()``; here it is a lazy,
    map-only plan over any table.
    """
    own = mx.text_col(model)
    # Keys and text get names of their own first: a table may have a column named as the model's text, too.
    src = df.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        (first_token(text_col) if use_first_token else F.col(text_col)).alias(own),
    )
    scored = decode_prediction(score(src, model), model)
    return scored.select(
        *[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], F.col(own).alias(text_col), mx.PREDICTED_LABEL_COL, "confidence"
    )
