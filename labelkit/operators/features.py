"""Text -> hashed term-frequency features, as Spark ML stages.

The feature chain is stateless (no fit): clean -> tokenize -> drop stop words
-> hash into ``num_features`` buckets.  It is a narrow, map-only projection:
every document is handled whole inside the task that read it.  The fitted
parts (IDF, label index, classifier) live in :mod:`labelkit.operators.models`.

Column names follow the reference: ``clean_name``, ``name_tokens``,
``filtered_tokens``, ``raw_features``, ``features``, ``label``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import HashingTF, IDF, IDFModel, SQLTransformer, StopWordsRemover, StringIndexer, StringIndexerModel, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.functions.text import CLEAN_PATTERN

# Defaults of the reference (fixed values).
NUM_FEATURES = 20

CLEAN_COL = "clean_name"
TOKENS_COL = "name_tokens"
FILTERED_COL = "filtered_tokens"
RAW_COL = "raw_features"
FEATURES_COL = "features"
LABEL_COL = "label"


def clean_stage(text_col: str = "name", output_col: str = CLEAN_COL) -> SQLTransformer:
    """``regexp_replace(lower(text), '[^a-z ]', '')`` as a persistable stage.

    A null text is cleaned as the empty text: Spark's Tokenizer fails on
    null, and one null row must not fail a whole scoring job (the row is
    kept and scored like an empty name).
    """
    return SQLTransformer(
        statement=(
            f"SELECT *, regexp_replace(lower(coalesce(`{text_col}`, '')), '{CLEAN_PATTERN}', '') "
            f"AS `{output_col}` FROM __THIS__"
        )
    )


def tokenizer(input_col: str = CLEAN_COL, output_col: str = TOKENS_COL) -> Tokenizer:
    """Lower-case and split on ``\\s``; trailing empty tokens are dropped."""
    return Tokenizer(inputCol=input_col, outputCol=output_col)


def stop_words_remover(
    input_col: str = TOKENS_COL, output_col: str = FILTERED_COL, stop_words: Sequence[str] | None = None
) -> StopWordsRemover:
    """Drop stop words (Spark's default English list unless given)."""
    remover = StopWordsRemover(inputCol=input_col, outputCol=output_col)
    if stop_words is not None:
        remover.setStopWords(list(stop_words))
    return remover


def hashing_tf(
    input_col: str = FILTERED_COL, output_col: str = RAW_COL, num_features: int = NUM_FEATURES
) -> HashingTF:
    """Term counts in ``num_features`` murmur3 buckets (not binary)."""
    return HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=num_features)


def feature_stages(
    text_col: str = "name", num_features: int = NUM_FEATURES, stop_words: Sequence[str] | None = None
) -> list[Transformer]:
    """The stateless chain text -> ``raw_features``."""
    return [
        clean_stage(text_col),
        tokenizer(),
        stop_words_remover(stop_words=stop_words),
        hashing_tf(num_features=num_features),
    ]


def featurizer(
    text_col: str = "name", num_features: int = NUM_FEATURES, stop_words: Sequence[str] | None = None
) -> PipelineModel:
    """The stateless chain as one PipelineModel (nothing to fit)."""
    return PipelineModel(feature_stages(text_col, num_features, stop_words))


def fit_idf(features: DataFrame, input_col: str = RAW_COL, output_col: str = FEATURES_COL) -> IDFModel:
    """Document frequency per bucket -> ``ln((m+1)/(df+1))``.  One pass, partial sums per task."""
    return IDF(inputCol=input_col, outputCol=output_col).fit(features)


def fit_label_index(df: DataFrame, input_col: str = "gender", output_col: str = LABEL_COL) -> StringIndexerModel:
    """Labels -> 0, 1, ... by descending frequency, ties by label."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, stringOrderType="frequencyDesc").fit(df)


def label_index_from_counts(
    counts: Sequence[tuple[str, int]], input_col: str = "gender", output_col: str = LABEL_COL
) -> StringIndexerModel:
    """The label index StringIndexer(frequencyDesc) would fit, from label
    counts already at hand: descending count, ties by label."""
    labels = [label for label, _ in sorted(counts, key=lambda c: (-c[1], c[0]))]
    return StringIndexerModel.from_labels(labels, inputCol=input_col, outputCol=output_col)


def vector_entries(vec: Column | str, index_name: str = "bucket", value_name: str = "value") -> Column:
    """Non-zero entries of an ML vector as ``array<struct<index, value>>``.

    Explode the result to get one row per (row, bucket).  Goes through a
    dense array, which is fine for the narrow hash spaces used here
    (``num_features`` 20 by default); for very wide spaces prefer keeping the
    vector.
    """
    arr = vector_to_array(F.col(vec) if isinstance(vec, str) else vec)
    pairs = F.transform(arr, lambda v, i: F.struct(i.alias(index_name), v.alias(value_name)))
    return F.filter(pairs, lambda p: p[value_name] != 0.0)


def explode_vector(
    df: DataFrame, keys: Sequence[str], vec: str, index_name: str = "bucket", value_name: str = "value"
) -> DataFrame:
    """``(keys..., bucket, value)`` for every non-zero vector entry."""
    entry = F.explode(vector_entries(vec, index_name, value_name)).alias("_e")
    return df.select(*keys, entry).select(*keys, f"_e.{index_name}", f"_e.{value_name}")
