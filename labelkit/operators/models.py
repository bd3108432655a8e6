"""Logistic regression and Naive Bayes text classifiers as one PipelineModel.

A fitted model is a plain :class:`pyspark.ml.PipelineModel` with stages::

    clean -> tokenize -> stop words -> hashing TF        (stateless "feature" part)
    [IDF] -> label index -> classifier -> index-to-label  (fitted "head" part)

The same object scores training rows and new rows, so training and scoring
can never disagree on IDF (the reference trained on TF-IDF but scored raw TF),
and labels are decoded with the indexer's own order (the reference always
decoded index 0 as ``F``).

Fitting touches the text once: the stateless chain turns each row into a
sparse vector, and only ``(label, raw_features)`` - about 100 bytes per row
whatever the text length - is written once as parquet to the shared folder
(``spark.checkpoint.dir``).  IDF, the label index and the classifier (10
L-BFGS rounds for LR) then all read that small table, and an executor lost
mid-fit re-reads those files rather than re-scanning and re-tokenizing text.

The model on the driver holds ``classes x num_features`` doubles; with the
default 20 buckets that is nothing, with ``num_features`` near 2**18 it is a
few MB per class.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import HashingTF, IDFModel, IndexToString, SQLTransformer, StopWordsRemover, StringIndexerModel, Tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from labelkit.operators import features as fx
from labelkit.session import remove, scratch_path

# Reference defaults (fixed values).
MAX_ITER = 10
TOL = 1e-6
REG_PARAM = 0.1
SMOOTHING = 1.0

KINDS = ("logistic_regression", "naive_bayes")

PREDICTION_COL = "prediction"
PROBABILITY_COL = "probability"
RAW_PREDICTION_COL = "rawPrediction"
PREDICTED_LABEL_COL = "predicted_label"

_N_FEATURE_STAGES = 4
MAX_CLASSES = 10_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the input only once
    (an eager checkpoint runs its input twice: once to count, once to write),
    and the files survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _classifier(kind: str, features_col: str, max_iter: int, reg_param: float, smoothing: float, tol: float = TOL):
    common = dict(
        featuresCol=features_col,
        labelCol=fx.LABEL_COL,
        predictionCol=PREDICTION_COL,
        probabilityCol=PROBABILITY_COL,
        rawPredictionCol=RAW_PREDICTION_COL,
    )
    if kind == "logistic_regression":
        return LogisticRegression(maxIter=max_iter, regParam=reg_param, tol=tol, **common)
    if kind == "naive_bayes":
        return NaiveBayes(smoothing=smoothing, modelType="multinomial", **common)
    raise ValueError(f"Unknown model type: {kind!r}; expected one of {KINDS}")


def label_counts(data: DataFrame, label_col: str) -> list[tuple]:
    """``(label, rows)`` of at most ``MAX_CLASSES`` labels; more are an error (a
    wrong label column would bring its whole key set to the driver)."""
    counts = data.groupBy(label_col).count().limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"label column {label_col!r} has more than {MAX_CLASSES} values")
    return [(r[0], r[1]) for r in counts]


def fit_models(
    train_features: DataFrame,
    specs: Mapping[str, Mapping],
    stages: Sequence[Transformer],
    label_col: str = "gender",
    materialize_input: bool = True,
) -> dict[str, PipelineModel]:
    """Fit several models on the same rows, sharing every common pass.

    ``specs`` maps a name to ``{"kind": ..., "use_idf": True, "max_iter": ...,
    "reg_param": ..., "smoothing": ..., "tol": ...}``.  The rows are persisted
    once, the label index and the IDF are fitted once, and only the
    classifiers run per model.  ``stages`` is the stateless chain that
    produced ``raw_features``; it is prepended so that every returned model
    scores raw text.
    """
    for spec in specs.values():
        if spec["kind"] not in KINDS:
            raise ValueError(f"Unknown model type: {spec['kind']!r}; expected one of {KINDS}")
    data = train_features.select(label_col, fx.RAW_COL)
    if materialize_input:
        data = materialize(data, "train-features")
    # Several passes follow (label counts, IDF, classifiers): keep the small
    # table in executor memory, spilling to disk; a lost block is re-read from
    # the files written above.  Its partitions are those of the files.
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The label order: frequency descending, ties by label (StringIndexer's
        # frequencyDesc).
        counts = label_counts(data, label_col)
        if not counts:
            raise ValueError("cannot fit a classifier on an empty table")
        if len(counts) < 2:
            raise ValueError(f"need at least two classes to fit, found only {[c for c, _ in counts]}")
        if any(c is None for c, _ in counts):
            raise ValueError(f"label column {label_col!r} has nulls")
        indexer = fx.label_index_from_counts(counts, label_col, fx.LABEL_COL)
        idf = None
        if any(spec.get("use_idf", True) for spec in specs.values()):
            idf = fx.fit_idf(data, fx.RAW_COL, fx.FEATURES_COL)
        decoder = IndexToString(inputCol=PREDICTION_COL, outputCol=PREDICTED_LABEL_COL, labels=list(indexer.labels))
        out = {}
        for name, spec in specs.items():
            use_idf = spec.get("use_idf", True)
            head: list[Transformer] = ([idf] if use_idf else []) + [indexer]
            features_col = fx.FEATURES_COL if use_idf else fx.RAW_COL
            clf = _classifier(
                spec["kind"],
                features_col,
                spec.get("max_iter", MAX_ITER),
                spec.get("reg_param", REG_PARAM),
                spec.get("smoothing", SMOOTHING),
                spec.get("tol", TOL),
            ).fit(PipelineModel(head).transform(data))
            out[name] = PipelineModel(list(stages) + head + [clf, decoder])
    finally:
        data.unpersist()
    return out


def fit_on_features(
    train_features: DataFrame,
    kind: str,
    stages: Sequence[Transformer],
    label_col: str = "gender",
    use_idf: bool = True,
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
    smoothing: float = SMOOTHING,
    materialize_input: bool = True,
    tol: float = TOL,
) -> PipelineModel:
    """Fit one model on rows that already carry ``raw_features`` and the label."""
    spec = dict(kind=kind, use_idf=use_idf, max_iter=max_iter, reg_param=reg_param, smoothing=smoothing, tol=tol)
    return fit_models(train_features, {"model": spec}, stages, label_col, materialize_input)["model"]


def fit_text_classifier(
    train: DataFrame,
    kind: str,
    text_col: str = "name",
    label_col: str = "gender",
    num_features: int = fx.NUM_FEATURES,
    use_idf: bool = True,
    stop_words: Sequence[str] | None = None,
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
    smoothing: float = SMOOTHING,
    tol: float = TOL,
) -> PipelineModel:
    """Fit on a text table ``(text_col, label_col, ...)``."""
    stages = fx.feature_stages(text_col, num_features, stop_words)
    feats = PipelineModel(stages).transform(train.select(text_col, label_col))
    return fit_on_features(feats, kind, stages, label_col, use_idf, max_iter, reg_param, smoothing, tol=tol)


def train_logistic_regression(train: DataFrame, **kw) -> PipelineModel:
    """L2 logistic regression, 10 iterations, regParam 0.1 (reference defaults)."""
    return fit_text_classifier(train, "logistic_regression", **kw)


def train_naive_bayes(train: DataFrame, **kw) -> PipelineModel:
    """Multinomial Naive Bayes, smoothing 1.0 (reference defaults)."""
    return fit_text_classifier(train, "naive_bayes", **kw)


# --- model anatomy ------------------------------------------------------------


def feature_part(model: PipelineModel) -> list[Transformer]:
    return list(model.stages[:_N_FEATURE_STAGES])


def head_part(model: PipelineModel) -> list[Transformer]:
    return list(model.stages[_N_FEATURE_STAGES:])


def heads(model: PipelineModel) -> PipelineModel:
    """The fitted part only: scores rows that already have ``raw_features``."""
    return PipelineModel(head_part(model))


def text_col(model: PipelineModel) -> str:
    """The text column that the model's cleaning stage reads."""
    return _SQL_TEXT.search(model.stages[0].getStatement())[1]


def label_indexer(model: PipelineModel) -> StringIndexerModel:
    return next(s for s in model.stages if isinstance(s, StringIndexerModel))


def idf_model(model: PipelineModel) -> IDFModel | None:
    return next((s for s in model.stages if isinstance(s, IDFModel)), None)


def classifier(model: PipelineModel):
    return model.stages[-2]


def kind_of(model: PipelineModel) -> str:
    name = type(classifier(model)).__name__
    return {"LogisticRegressionModel": "logistic_regression", "NaiveBayesModel": "naive_bayes"}[name]


def output_cols(model: PipelineModel) -> dict[str, str]:
    """Names of the per-model output columns."""
    clf = classifier(model)
    return {
        "label": label_indexer(model).getOutputCol(),
        "prediction": clf.getPredictionCol(),
        "probability": clf.getProbabilityCol(),
        "predicted_label": model.stages[-1].getOutputCol(),
    }


def _feature_signature(model: PipelineModel) -> tuple:
    return _stages_signature(feature_part(model))


def _stages_signature(stages: Sequence[Transformer]) -> tuple:
    clean, tok, rem, htf = stages
    assert isinstance(clean, SQLTransformer) and isinstance(tok, Tokenizer)
    assert isinstance(rem, StopWordsRemover) and isinstance(htf, HashingTF)
    return (
        clean.getStatement(),
        tuple(rem.getStopWords()),
        rem.getCaseSensitive(),
        htf.getNumFeatures(),
        htf.getBinary(),
    )


def same_features(a: PipelineModel, b: PipelineModel) -> bool:
    return _feature_signature(a) == _feature_signature(b)


_COL_PARAMS = ("inputCol", "outputCol", "featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol")


_OUT_PARAMS = ("outputCol", "predictionCol", "probabilityCol", "rawPredictionCol")
_SQL_TEXT = re.compile(r"coalesce\(`([^`]+)`")
_SQL_ALIAS = re.compile(r"AS `([^`]+)` FROM __THIS__")


def prefixed_stages(stages: Sequence[Transformer], prefix: str) -> list[Transformer]:
    """Copies of ``stages`` whose own output columns carry ``prefix``; inputs
    produced by earlier stages in the list are renamed to match, inputs from
    outside (the text column, or ``raw_features`` for a head) keep their names.

    Used to run two models in one pass without column clashes.
    """
    rename: dict[str, str] = {}
    out = []
    for st in stages:
        if isinstance(st, SQLTransformer):
            stmt = st.getStatement()
            produced = _SQL_ALIAS.findall(stmt)
            for c in produced:
                stmt = stmt.replace(f"AS `{c}` FROM", f"AS `{prefix}{c}` FROM")
                rename[c] = f"{prefix}{c}"
            out.append(SQLTransformer(statement=stmt))
            continue
        extra = {}
        for p in _COL_PARAMS:
            if st.hasParam(p) and st.isDefined(st.getParam(p)):
                v = st.getOrDefault(st.getParam(p))
                if p in _OUT_PARAMS:
                    rename[v] = f"{prefix}{v}"
                if v in rename:
                    extra[st.getParam(p)] = rename[v]
        out.append(st.copy(extra))
    return out


def scoring_head(model: PipelineModel) -> list[Transformer]:
    """The fitted head with a label index that gives a label the model has not
    seen (or none) an index after all others, so that such a row is scored
    like any other and never counts as right."""
    return [s.copy({s.handleInvalid: "keep"}) if isinstance(s, StringIndexerModel) else s for s in head_part(model)]


def prefixed_head(model: PipelineModel, prefix: str) -> list[Transformer]:
    """The scoring head with prefixed outputs; reads the shared ``raw_features``."""
    return prefixed_stages(scoring_head(model), prefix)


# --- persistence -------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the whole model (features, IDF, label index, classifier), overwriting."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession | None, kind: str, path: str) -> PipelineModel:
    """Load a saved model and check that it is of the expected kind."""
    if kind not in KINDS:
        raise ValueError(f"Unknown model type: {kind!r}; expected one of {KINDS}")
    model = PipelineModel.load(path)
    if kind_of(model) != kind:
        raise ValueError(f"model at {path} is {kind_of(model)}, not {kind}")
    return model


def _is_missing_path(err: Exception) -> bool:
    text = str(err)
    return "PATH_NOT_FOUND" in text or "does not exist" in text or "FileNotFoundException" in text


def fingerprint(train: DataFrame, label_col: str, content_col: str, params: dict) -> str:
    """Effective parameters, row count and an order-independent hash of the
    labels and contents of the training table: one aggregate, one row."""
    row = F.xxhash64(label_col, content_col)
    sums = [F.sum(F.xxhash64(row, F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
    found = train.agg(F.count(F.lit(1)), *sums).first()
    return repr((sorted((k, repr(v)) for k, v in params.items()), [str(x) for x in found]))


def load_or_train(
    spark: SparkSession,
    train: DataFrame,
    paths: dict[str, str],
    label_col: str = "gender",
    stages: Sequence[Transformer] | None = None,
    **fit_kw,
) -> tuple[dict[str, PipelineModel], bool]:
    """Load every model in ``paths`` ({kind: path}); train and save the missing
    or stale ones.  Returns ``(models, all_loaded)``.

    ``train`` is a text table (``name``, label; its features are written
    once before fitting), or - with ``stages`` - rows that already carry
    ``raw_features`` made by those stages and are already materialized
    (``Prepared.train``), which avoids another pass over the text.

    Only a missing or stale model leads to training: a model is missing when
    no fingerprint is stored at its path, stale when the stored fingerprint
    (parameters + contents of its training table) differs.  When the
    fingerprint matches, any error loading the model (corrupt files, wrong
    class) surfaces instead of being trained over.
    """
    text_col = fit_kw.get("text_col", "name")
    from_text = stages is None
    if from_text:
        stages = fx.feature_stages(text_col, fit_kw.get("num_features", fx.NUM_FEATURES), fit_kw.get("stop_words"))
    defaults = dict(use_idf=True, max_iter=MAX_ITER, reg_param=REG_PARAM, smoothing=SMOOTHING, tol=TOL)
    spec_kw = defaults | {k: v for k, v in fit_kw.items() if k not in ("text_col", "num_features", "stop_words")}
    params = spec_kw | {"label_col": label_col, "features": _stages_signature(stages)}
    fp = fingerprint(train, label_col, text_col if from_text else fx.RAW_COL, params)
    models: dict[str, PipelineModel | None] = {}
    for kind, path in paths.items():
        stored = None
        try:
            stored = spark.read.text(f"{path}/fingerprint").first()
        except AnalysisException as err:  # no fingerprint: nothing saved here yet
            if not _is_missing_path(err):
                raise
        # A matching fingerprint means a model was saved here for this data:
        # any error loading it (corrupt files, wrong class) surfaces.
        models[kind] = load_model(spark, kind, f"{path}/model") if stored is not None and stored[0] == fp else None
    missing = [kind for kind, m in models.items() if m is None]
    if missing:
        # All missing models in one fit: shared rows, label index and IDF.
        if from_text:
            train = PipelineModel(stages).transform(train.select(text_col, label_col))
        fitted = fit_models(
            train, {k: dict(kind=k, **spec_kw) for k in missing}, stages, label_col, materialize_input=from_text
        )
        for kind in missing:
            # An interrupted save leaves a model without a fingerprint: missing.
            remove(spark, f"{paths[kind]}/fingerprint")
            save_model(fitted[kind], f"{paths[kind]}/model")
            spark.createDataFrame([(fp,)], "value string").coalesce(1).write.mode("overwrite").text(
                f"{paths[kind]}/fingerprint"
            )
            models[kind] = fitted[kind]
    return models, not missing
