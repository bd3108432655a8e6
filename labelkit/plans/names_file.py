"""The reference app's whole flow over a ``name;label`` file, as one plan:
load -> summary -> features -> split -> fit both models -> metrics table.

Rows of a names file carry their own label, so there is no join: equal lines
are counted first (combined before the shuffle), each distinct line is
featurized once, ``(copy, name, label, raw_features)`` is written once to the
shared folder, and both fits and both evaluations read that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.operators import compare as cx
from labelkit.operators import evaluate as ev
from labelkit.operators import features as fx
from labelkit.operators import models as mx
from labelkit.operators import summary as su
from labelkit.operators.split import SEED, TRAIN_SHARE, split_train_test
from labelkit.plans.training import Prepared, fit_many
from labelkit.sources.lines import load_labelled


COPY = "copy"
# Copies of one line are numbered this many to a row before they are spread.
COPIES_PER_CHUNK = 10_000


@dataclass
class NamesRun:
    data: DataFrame
    summary: DataFrame
    prepared: Prepared
    models: dict[str, PipelineModel]
    metrics: DataFrame
    loaded: bool  # all models came from ``model_dir``


def prepare_labelled_text(
    df: DataFrame,
    text_col: str = "name",
    label_col: str = "gender",
    num_features: int = fx.NUM_FEATURES,
    stop_words: Sequence[str] | None = None,
    share: float = TRAIN_SHARE,
    seed: int = SEED,
) -> Prepared:
    """Featurize a labelled text table once and split it, whatever its layout.

    A names file has no key, and identical lines are common (one name can
    hold a large share of a file).  Splitting on the content alone would send
    all copies of a line to the same side, so the copies of a line are
    numbered and the split hashes ``(seed, text, label, copy)``: a multiset of
    lines has one split, on any cluster and for any order or file splits.
    Lines are grouped with a count that combines before the shuffle; copies
    of a hot line are numbered in chunks, which are dealt over the tasks.
    """
    stages = fx.feature_stages(text_col, num_features, stop_words)
    lines = df.groupBy(text_col, label_col).agg(F.count(F.lit(1)).alias("_n"))
    feats = PipelineModel(stages).transform(lines).select(text_col, label_col, fx.RAW_COL, "_n")
    last_chunk = F.floor((F.col("_n") - 1) / COPIES_PER_CHUNK).cast("long")
    chunks = feats.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    chunks = chunks.repartition(text_col, label_col, "_chunk")
    first = F.col("_chunk") * COPIES_PER_CHUNK
    copies = F.sequence(first, F.least(first + COPIES_PER_CHUNK, F.col("_n")) - 1)
    rows = chunks.select(F.explode(copies).alias(COPY), text_col, label_col, fx.RAW_COL)
    labelled = mx.materialize(rows, "labelled-features")
    train, test = split_train_test(labelled, [text_col, label_col, COPY], share, seed)
    return Prepared(stages, labelled, train, test)


def train_and_evaluate(
    spark: SparkSession,
    source: str | Sequence[str] | DataFrame,
    kinds: Sequence[str] = mx.KINDS,
    model_dir: str | None = None,
    settings: dict | None = None,
    **prepare_kw,
) -> NamesRun:
    """Everything the reference's "Load Data & Train Models" button did.

    With ``model_dir``, models saved there from the same rows and parameters
    are loaded, and the others are trained and saved (``models.load_or_train``).
    ``settings`` are parameters of the fits (``use_idf``, ``max_iter``, ...).
    """
    settings = settings or {}
    data = load_labelled(spark, source)
    summary = su.data_summary(data)
    prep = prepare_labelled_text(data, **prepare_kw)
    if model_dir:
        paths = {kind: f"{model_dir.rstrip('/')}/{kind}" for kind in kinds}
        label_col = prepare_kw.get("label_col", "gender")
        models, loaded = mx.load_or_train(spark, prep.train, paths, label_col, stages=prep.stages, **settings)
    else:
        models = fit_many(prep, {kind: {"kind": kind} | settings for kind in kinds})
        loaded = False
    metrics = cx.compare_metrics(ev.evaluate_models(prep.test, models), names=list(models))
    return NamesRun(data, summary, prep, models, metrics, loaded)
