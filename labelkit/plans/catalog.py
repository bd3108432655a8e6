"""Registered queries: one per operator of the reference, each with the DuckDB
SQL that must give the same rows (``ORACLE``).  Queries read the driver
tables in ``sf_dir`` whole; the derived fixtures are:

* ``lines``: names-file lines derived from ``part`` (see ``oracle.LINES_SQL``),
  written as text to the shared folder and read back;
* labelled documents: ``documents`` joined with ``labels`` (``quality`` 1 ->
  ``M``, else ``F``), split 80/20 by a hash of ``doc_id``; models are fitted
  on the train side and score the test side or all of ``documents``;
* role-labelled conversation turns (``user`` / ``assistant``).

Doubles are rounded to 6 places (metric tables to 3, as displayed).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions import text as tx
from labelkit.operators import compare as cx
from labelkit.operators import evaluate as ev
from labelkit.operators import features as fx
from labelkit.operators import limits as lx
from labelkit.operators import models as mx
from labelkit.operators import score as sx
from labelkit.operators import summary as su
from labelkit.operators.split import is_train
from labelkit.plans import oracle as oq
from labelkit.plans import training as tr
from labelkit.session import scratch_path
from labelkit.sources import lines as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

EXAMPLE_NAMES = ("Mohamed", "Fatima", "Ahmed")  # the reference's example inputs (fixed values)


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def r6(c):
    return F.round(c, 6)


# --- shared Spark fixtures ---------------------------------------------------------


def lines_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``lines`` fixture as a DataFrame (same rule as ``oracle.LINES_SQL``)."""
    p = tr.table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 11
    name = F.col("p_name")
    label = F.when(F.col("p_size") % 2 == 0, F.lit("F")).otherwise(F.lit("M"))
    value = (
        F.when(k == 0, F.lit(tx.HEADER_TOKEN))
        .when(k == 1, name)
        .when(k == 2, F.concat(name, F.lit(";m")))
        .when(k == 3, F.concat(name, F.lit(";F;extra")))
        .when(k == 4, F.lit(";M"))
        .when(k == 5, F.concat(name, F.lit("; F")))
        .otherwise(F.concat(name, F.lit(";"), label))
    )
    return p.select(value.alias("value"))


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ``lines`` fixture as a text file in the shared folder, read it back."""
    path = src.write_lines(lines_frame(spark, sf_dir), scratch_path(spark, "lines"))
    return src.read_lines(spark, path)


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.load_labelled(spark, written_lines(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str) -> tr.Prepared:
    return tr.prepare_training_data(tr.doc_texts(spark, sf_dir), tr.doc_labels(spark, sf_dir), ["doc_id"])


def fitted(spark: SparkSession, sf_dir: str, kind: str = "naive_bayes", use_idf: bool = True):
    prep = prepared(spark, sf_dir)
    return prep, tr.fit(prep, kind, use_idf=use_idf)


def whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, name)``: whole documents, spread over the cores before
    tokenizing (a no-op for large scans)."""
    return tr.spread(tr.doc_texts(spark, sf_dir))


def predictions(df: DataFrame) -> DataFrame:
    """Round the confidence of a ``predict_names`` output."""
    return df.withColumn("confidence", r6(F.col("confidence")))


# --- shared SQL fixtures --------------------------------------------------------

LABELLED_SQL = oq.labelled_docs_sql()
TRAIN_SQL = f"SELECT * FROM ({LABELLED_SQL}) WHERE {oq.is_train_sql('doc_id')}"
TEST_SQL = f"SELECT * FROM ({LABELLED_SQL}) WHERE NOT {oq.is_train_sql('doc_id')}"
DOCS_SQL = "SELECT doc_id, text AS name FROM documents"
FIRST_SQL = f"SELECT doc_id, {oq.first_token_sql('text')} AS name FROM documents"
LOADED_SQL = oq.loaded_lines_sql()


def nb_sql(select: str, score_src: str = DOCS_SQL, use_idf: bool = True, prefix: str = "nb") -> str:
    return f"WITH {oq.nb_ctes(TRAIN_SQL, score_src, use_idf=use_idf, prefix=prefix)}\n{select}"


def nb_predict_sql(score_src: str, prefix: str = "nb") -> str:
    """Subquery ``(doc_id, name, predicted_label, confidence)`` of the scored source."""
    return (
        f"SELECT s.doc_id, s.name, w.predicted_label, w.confidence "
        f"FROM ({score_src}) s JOIN (SELECT DISTINCT k, predicted_label, confidence FROM {prefix}_pred) w "
        f"ON w.k = s.doc_id"
    )


def metrics_sql(pred: str, test: str, classes: str) -> str:
    """One row of accuracy / weighted precision / recall / F1 (unrounded)."""
    return f"""
SELECT sum(tp) / sum(sup) AS accuracy, sum(p * sup) / sum(sup) AS precision,
       sum(r * sup) / sum(sup) AS recall,
       sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * sup) / sum(sup) AS f1
FROM (
  SELECT cls, tp, sup, CASE WHEN pp > 0 THEN tp / pp ELSE 0 END AS p, CASE WHEN sup > 0 THEN tp / sup ELSE 0 END AS r
  FROM (
    SELECT cls, sum(tp) AS tp, sum(pp) AS pp, sum(sup) AS sup FROM (
      SELECT label AS cls, CASE WHEN label = prediction THEN n ELSE 0 END AS tp, 0.0 AS pp, n AS sup FROM cm
      UNION ALL SELECT prediction AS cls, 0.0, n, 0.0 FROM cm
    ) GROUP BY cls
  )
)""".replace(
        "FROM cm",
        f"""FROM (
        SELECT c.ci::DOUBLE AS label, w.prediction::DOUBLE AS prediction, count(*)::DOUBLE AS n
        FROM (SELECT DISTINCT k, prediction FROM {pred}) w JOIN ({test}) t ON t.doc_id = w.k
        JOIN {classes} c ON c.gender = t.gender GROUP BY ALL)""",
    )


def nb_metrics_sql(select: str = "accuracy, precision, recall, f1") -> str:
    cols = ", ".join(f"round({c}, 6) AS {c}" for c in select.split(", "))
    return nb_sql(f"SELECT {cols} FROM ({metrics_sql('nb_pred', TEST_SQL, 'nb_classes')})", TEST_SQL)


# ================================ 2.1 sources ======================================


@query("read_lines", f"SELECT value FROM ({oq.LINES_SQL})")
def q_read_lines(spark, sf_dir):
    return written_lines(spark, sf_dir)


@query("drop_header", f"SELECT value FROM ({oq.LINES_SQL}) WHERE NOT contains(value, 'NOMPL;SEXE')")
def q_drop_header(spark, sf_dir):
    return src.drop_header(written_lines(spark, sf_dir))


@query("parse_delimited", oq.parsed_lines_sql())
def q_parse_delimited(spark, sf_dir):
    return src.parse_delimited(src.drop_header(written_lines(spark, sf_dir)))


@query("load_labelled", LOADED_SQL)
def q_load_labelled(spark, sf_dir):
    return loaded(spark, sf_dir)


@query(
    "rows_from_values",
    nb_sql(
        "SELECT s.name, w.predicted_label, round(w.confidence, 6) AS confidence FROM (VALUES "
        + ", ".join(f"({oq.q(n)})" for n in EXAMPLE_NAMES)
        + ") s(name) JOIN (SELECT DISTINCT k, predicted_label, confidence FROM nb_pred) w ON w.k = s.name",
        "SELECT name AS doc_id, name FROM (VALUES " + ", ".join(f"({oq.q(n)})" for n in EXAMPLE_NAMES) + ") v(name)",
    ),
)
def q_rows_from_values(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    names = src.rows_from_values(spark, EXAMPLE_NAMES)
    return predictions(sx.predict_names(names, model))


NB_PARAMS_SQL = nb_sql(
    "SELECT p.ci AS class_index, p.gender AS label, round(p.pi, 6) AS pi, t.bucket, round(t.theta, 6) AS theta "
    "FROM nb_pi p JOIN nb_theta t ON t.ci = p.ci",
    TRAIN_SQL,
)


def nb_params(spark: SparkSession, model) -> DataFrame:
    """``(class_index, label, pi, bucket, theta)`` of a Naive Bayes pipeline
    (classes x buckets numbers, built on the driver from the model)."""
    nb = mx.classifier(model)
    labels = mx.label_indexer(model).labels
    pi, theta = nb.pi.toArray(), np.asarray(nb.theta.toArray())
    rows = [
        (c, labels[c], float(pi[c]), j, float(theta[c, j])) for c in range(theta.shape[0]) for j in range(theta.shape[1])
    ]
    out = spark.createDataFrame(rows, "class_index int, label string, pi double, bucket int, theta double")
    return out.withColumn("pi", r6(F.col("pi"))).withColumn("theta", r6(F.col("theta")))


@query("save_model", NB_PARAMS_SQL)
def q_save_model(spark, sf_dir):
    """Save the whole pipeline, load it back, and report the loaded model's
    parameters (they must equal the ones re-derived from the tables)."""
    _, model = fitted(spark, sf_dir)
    path = mx.save_model(model, scratch_path(spark, "nb-model"))
    return nb_params(spark, mx.load_model(spark, "naive_bayes", path))


@query(
    "load_model",
    nb_sql(
        "SELECT doc_id, name, predicted_label, round(confidence, 6) AS confidence FROM ("
        + nb_predict_sql(DOCS_SQL)
        + ")",
        DOCS_SQL,
    ),
)
def q_load_model(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    path = mx.save_model(model, scratch_path(spark, "nb-model"))
    reloaded = mx.load_model(spark, "naive_bayes", path)
    return predictions(sx.predict_names(whole_texts(spark, sf_dir), reloaded, ["doc_id"], use_first_token=False))


@query(
    "load_or_train",
    nb_sql(
        "SELECT doc_id, name, predicted_label, round(confidence, 6) AS confidence, true AS loaded FROM ("
        + nb_predict_sql(DOCS_SQL)
        + ")",
        DOCS_SQL,
    ),
)
def q_load_or_train(spark, sf_dir):
    """First call trains and saves both models, second call loads them."""
    prep = prepared(spark, sf_dir)
    root = scratch_path(spark, "models")
    paths = {"logistic_regression": f"{root}/lr", "naive_bayes": f"{root}/nb"}
    mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
    models, all_loaded = mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
    out = sx.predict_names(whole_texts(spark, sf_dir), models["naive_bayes"], ["doc_id"], use_first_token=False)
    out = predictions(out)
    return out.withColumn("loaded", F.lit(all_loaded))


# ========================= 2.2 projections, filters, scalars =========================


@query("filter_valid_labels", "SELECT conv_id, turn, role AS gender FROM conversations WHERE role IN ('user', 'assistant')")
def q_filter_valid_labels(spark, sf_dir):
    conv = tr.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("gender"))
    return conv.filter(tx.is_valid_label("gender", ("user", "assistant")))


@query("filter_not_null", f"SELECT name, gender FROM ({oq.parsed_lines_sql()}) WHERE gender IS NOT NULL")
def q_filter_not_null(spark, sf_dir):
    parsed = src.parse_delimited(src.drop_header(written_lines(spark, sf_dir)))
    return parsed.filter(tx.is_not_null("gender"))


@query("filter_non_empty", f"SELECT name, gender FROM ({LOADED_SQL}) WHERE name <> ''")
def q_filter_non_empty(spark, sf_dir):
    return loaded(spark, sf_dir).filter(tx.is_non_empty("name"))


@query("clean_text", f"SELECT doc_id, {oq.clean_sql('text')} AS clean_name FROM documents")
def q_clean_text(spark, sf_dir):
    docs = tr.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.clean_text("text").alias("clean_name"))


@query("first_token", f"SELECT doc_id, {oq.first_token_sql('text')} AS first_name FROM documents")
def q_first_token(spark, sf_dir):
    docs = tr.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.first_token("text").alias("first_name"))


@query("text_length", "SELECT doc_id, length(text)::INTEGER AS name_length FROM documents")
def q_text_length(spark, sf_dir):
    docs = tr.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.text_length("text").alias("name_length"))


@query(
    "array_item",
    "SELECT value, string_split(value, ';')[1] AS item0, string_split(value, ';')[2] AS item1, "
    f"string_split(value, ';')[3] AS item2 FROM ({oq.LINES_SQL})",
)
def q_array_item(spark, sf_dir):
    lines = written_lines(spark, sf_dir)
    arr = tx.split_fields("value")
    return lines.select("value", *[tx.array_item(arr, i).alias(f"item{i}") for i in range(3)])


@query("drop_rename", f"SELECT name, gender AS label FROM ({LOADED_SQL})")
def q_drop_rename(spark, sf_dir):
    return loaded(spark, sf_dir).withColumnRenamed("gender", "label")


@query(
    "label_display",
    nb_sql(
        "SELECT DISTINCT k AS doc_id, predicted_label, "
        "CASE WHEN predicted_label = 'F' THEN 'Female' ELSE 'Male' END AS gender_text FROM nb_pred",
        DOCS_SQL,
    ),
)
def q_label_display(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    pred = sx.predict_names(whole_texts(spark, sf_dir), model, ["doc_id"], use_first_token=False)
    return pred.select("doc_id", "predicted_label", tx.label_display("predicted_label").alias("gender_text"))


@query(
    "confidence_pct",
    nb_sql("SELECT DISTINCT k AS doc_id, round(confidence * 100.0, 1) AS confidence_pct FROM nb_pred", DOCS_SQL),
)
def q_confidence_pct(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    pred = sx.predict_names(whole_texts(spark, sf_dir), model, ["doc_id"], use_first_token=False)
    return pred.select("doc_id", tx.confidence_pct("confidence").alias("confidence_pct"))


# ================================ 2.3 text features =================================


def _doc_stage_frame(spark, sf_dir, upto: int) -> DataFrame:
    return PipelineModel(fx.feature_stages()[:upto]).transform(whole_texts(spark, sf_dir))


def _tok_sql(list_expr: str) -> str:
    return (
        "SELECT doc_id, unnest(range(len(toks)))::INTEGER AS pos, unnest(toks) AS token "
        f"FROM (SELECT doc_id, {list_expr} AS toks FROM documents)"
    )


@query("tokenize", _tok_sql(oq.tokens_list_sql(oq.clean_sql("coalesce(text, '')"))))
def q_tokenize(spark, sf_dir):
    df = _doc_stage_frame(spark, sf_dir, 2)
    return df.select("doc_id", F.posexplode(fx.TOKENS_COL).alias("pos", "token"))


@query("remove_stop_words", _tok_sql(oq.filtered_list_sql(oq.tokens_list_sql(oq.clean_sql("coalesce(text, '')")))))
def q_remove_stop_words(spark, sf_dir):
    df = _doc_stage_frame(spark, sf_dir, 3)
    return df.select("doc_id", F.posexplode(fx.FILTERED_COL).alias("pos", "token"))


@query(
    "hashed_tf",
    f"WITH {oq.token_rows_cte('h_tok', DOCS_SQL)},\n{oq.hash_ctes('h_tok', 20, 'h_hash')},\n"
    f"{oq.tf_cte('h_tf', 'h_tok', 'h_hash')}\nSELECT k AS doc_id, bucket, tf FROM h_tf",
)
def q_hashed_tf(spark, sf_dir):
    df = _doc_stage_frame(spark, sf_dir, 4)
    return fx.explode_vector(df, ["doc_id"], fx.RAW_COL, "bucket", "tf")


@query("idf_fit", nb_sql("SELECT bucket, df::BIGINT AS doc_freq, round(idf, 6) AS idf FROM nb_idf", TRAIN_SQL))
def q_idf_fit(spark, sf_dir):
    prep = prepared(spark, sf_dir)
    idf = fx.fit_idf(prep.train)
    rows = [(i, int(d), float(v)) for i, (d, v) in enumerate(zip(idf.docFreq, idf.idf.toArray()))]
    out = spark.createDataFrame(rows, "bucket int, doc_freq bigint, idf double")
    return out.withColumn("idf", r6(F.col("idf")))


@query("tf_idf", nb_sql("SELECT k AS doc_id, bucket, round(v, 6) AS value FROM nb_sv", DOCS_SQL))
def q_tf_idf(spark, sf_dir):
    prep, model = fitted(spark, sf_dir)
    scored = mx.idf_model(model).transform(_doc_stage_frame(spark, sf_dir, 4))
    return fx.explode_vector(scored, ["doc_id"], fx.FEATURES_COL).withColumn("value", r6(F.col("value")))


@query("label_index_fit", nb_sql("SELECT gender AS label, ci AS label_index FROM nb_classes", TRAIN_SQL))
def q_label_index_fit(spark, sf_dir):
    prep = prepared(spark, sf_dir)
    idx = fx.fit_label_index(prep.train)
    return spark.createDataFrame(list(zip(idx.labels, range(len(idx.labels)))), "label string, label_index int")


@query(
    "extract_features",
    nb_sql(
        "SELECT v.k AS doc_id, c.ci::DOUBLE AS label, v.bucket, round(v.v, 6) AS value "
        "FROM nb_v v JOIN nb_train t ON t.k = v.k JOIN nb_classes c ON c.gender = t.gender",
        TRAIN_SQL,
    ),
)
def q_extract_features(spark, sf_dir):
    prep, model = fitted(spark, sf_dir)
    feats = mx.heads(model).transform(prep.train)
    out = fx.explode_vector(feats, ["doc_id", fx.LABEL_COL], fx.FEATURES_COL)
    return out.withColumn("value", r6(F.col("value")))


@query("score_features", nb_sql("SELECT k AS doc_id, bucket, round(v, 6) AS value FROM nb_sv", DOCS_SQL))
def q_score_features(spark, sf_dir):
    """The model's own feature chain on all documents."""
    _, model = fitted(spark, sf_dir)
    docs = whole_texts(spark, sf_dir)
    feats = PipelineModel(mx.feature_part(model) + [mx.idf_model(model)]).transform(docs)
    return fx.explode_vector(feats, ["doc_id"], fx.FEATURES_COL).withColumn("value", r6(F.col("value")))


# ================================== 2.4 sampling =====================================


@query("split_train_test", f"SELECT doc_id, {oq.is_train_sql('doc_id')} AS is_train FROM ({LABELLED_SQL})")
def q_split_train_test(spark, sf_dir):
    return tr.labelled_docs(spark, sf_dir).select("doc_id", is_train(["doc_id"]).alias("is_train"))


@query(
    "prepare_training_data",
    f"SELECT CASE WHEN {oq.is_train_sql('doc_id')} THEN 'train' ELSE 'test' END AS split, count(*) AS rows, "
    "count(*) FILTER (WHERE gender = 'M') AS male_count, count(*) FILTER (WHERE gender = 'F') AS female_count "
    f"FROM ({LABELLED_SQL}) GROUP BY 1",
)
def q_prepare_training_data(spark, sf_dir):
    prep = prepared(spark, sf_dir)
    side = F.when(is_train(["doc_id"]), F.lit("train")).otherwise(F.lit("test"))
    return prep.labelled.groupBy(side.alias("split")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("gender") == "M").alias("male_count"),
        F.count_if(F.col("gender") == "F").alias("female_count"),
    )


# ============================== 2.5 models: fit and score ===============================


@query("train_logistic_regression")
def q_train_logistic_regression(spark, sf_dir):
    """Coefficients per bucket plus the intercept (iterative fit: row check only)."""
    _, model = fitted(spark, sf_dir, "logistic_regression")
    lr = mx.classifier(model)
    rows = [(f"b{i}", float(c)) for i, c in enumerate(lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "term string, coefficient double")


@query("train_naive_bayes", NB_PARAMS_SQL)
def q_train_naive_bayes(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    return nb_params(spark, model)


@query("score_logistic_regression")
def q_score_logistic_regression(spark, sf_dir):
    _, model = fitted(spark, sf_dir, "logistic_regression")
    scored = sx.decode_prediction(sx.score(whole_texts(spark, sf_dir), model), model)
    return scored.select("doc_id", "prediction", "predicted_label", r6(F.col("confidence")).alias("confidence"))


@query(
    "score_logistic_regression_checks",
    "SELECT count(*) AS rows_scored, 0::BIGINT AS low_confidence, 0::BIGINT AS unknown_label FROM documents",
)
def q_score_logistic_regression_checks(spark, sf_dir):
    """Invariants of LR scoring that SQL can check without re-running L-BFGS:
    every document is scored once, the arg-max probability of two classes is
    at least one half, and every predicted label is a training class."""
    _, model = fitted(spark, sf_dir, "logistic_regression")
    scored = sx.decode_prediction(sx.score(whole_texts(spark, sf_dir), model), model)
    labels = list(mx.label_indexer(model).labels)
    return scored.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("confidence") < 0.5).alias("low_confidence"),
        F.count_if(~F.col("predicted_label").isin(*labels)).alias("unknown_label"),
    )


@query(
    "score_naive_bayes",
    nb_sql(
        "SELECT k AS doc_id, ci AS class_index, round(prob, 6) AS probability, prediction::DOUBLE AS prediction "
        "FROM nb_pred"
    ),
)
def q_score_naive_bayes(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    scored = sx.score(whole_texts(spark, sf_dir), model)
    out = scored.select(
        "doc_id", "prediction", F.posexplode(vector_to_array(F.col("probability"))).alias("class_index", "probability")
    )
    return out.select("doc_id", "class_index", r6(F.col("probability")).alias("probability"), "prediction")


@query(
    "decode_prediction",
    nb_sql("SELECT DISTINCT k AS doc_id, predicted_label, round(confidence, 6) AS confidence FROM nb_pred"),
)
def q_decode_prediction(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    scored = sx.decode_prediction(sx.score(whole_texts(spark, sf_dir), model), model)
    return scored.select("doc_id", "predicted_label", r6(F.col("confidence")).alias("confidence"))


@query(
    "predict_names",
    nb_sql(
        "SELECT doc_id, name, predicted_label, round(confidence, 6) AS confidence FROM ("
        + nb_predict_sql(FIRST_SQL)
        + ")",
        FIRST_SQL,
    ),
)
def q_predict_names(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    return predictions(sx.predict_names(tr.doc_texts(spark, sf_dir), model, ["doc_id"]))


# ================================ 2.6 aggregations ==================================


@query("count_total", f"SELECT count(*) AS total_names FROM ({LOADED_SQL})")
def q_count_total(spark, sf_dir):
    return su.count_total(loaded(spark, sf_dir))


@query(
    "count_by_label",
    f"SELECT l.label, count(x.gender) AS n FROM (VALUES ('M'), ('F')) l(label) "
    f"LEFT JOIN ({LOADED_SQL}) x ON x.gender = l.label GROUP BY l.label",
)
def q_count_by_label(spark, sf_dir):
    return su.count_by_label(loaded(spark, sf_dir))


@query(
    "length_stats",
    "SELECT round(avg(length(name)), 6) AS avg_name_length, min(length(name))::INTEGER AS min_name_length, "
    f"max(length(name))::INTEGER AS max_name_length FROM ({LOADED_SQL})",
)
def q_length_stats(spark, sf_dir):
    return su.length_stats(loaded(spark, sf_dir)).withColumn("avg_name_length", r6(F.col("avg_name_length")))


@query(
    "data_summary",
    "SELECT count(*) AS total_names, count(*) FILTER (WHERE gender = 'M') AS male_count, "
    "count(*) FILTER (WHERE gender = 'F') AS female_count, round(avg(length(name)), 6) AS avg_name_length, "
    "min(length(name))::INTEGER AS min_name_length, max(length(name))::INTEGER AS max_name_length "
    f"FROM ({LOADED_SQL})",
)
def q_data_summary(spark, sf_dir):
    return su.data_summary(loaded(spark, sf_dir)).withColumn("avg_name_length", r6(F.col("avg_name_length")))


@query(
    "label_share",
    f"SELECT label, n, CASE WHEN sum(n) OVER () > 0 THEN round(n * 100.0::DOUBLE / sum(n) OVER (), 1) END AS share_pct "
    f"FROM (SELECT l.label, count(x.gender) AS n FROM (VALUES ('M'), ('F')) l(label) "
    f"LEFT JOIN ({LOADED_SQL}) x ON x.gender = l.label GROUP BY l.label)",
)
def q_label_share(spark, sf_dir):
    return su.label_share(loaded(spark, sf_dir))


@query(
    "length_distribution",
    f"SELECT length(name)::INTEGER AS name_length, gender AS label, count(*) AS n FROM ({oq.ROLE_TEXT_SQL}) GROUP BY 1, 2",
)
def q_length_distribution(spark, sf_dir):
    return su.length_distribution(tr.role_text(spark, sf_dir))


def histogram_sql(src_sql: str) -> str:
    """NumPy 'auto' bins on lengths, shared by labels."""
    return f"""
WITH x AS (SELECT length(name)::DOUBLE AS v, gender AS label FROM ({src_sql})),
st AS (
  SELECT count(v)::DOUBLE AS n, min(v) AS lo, max(v) AS hi,
         quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM x
),
w AS (
  SELECT *, least(greatest(2.0 * (q3 - q1) * pow(n, -1.0 / 3.0), ((hi - lo) / sqrt(n)) / 2.0),
                  (hi - lo) / (log2(n) + 1.0)) AS width,
         CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS first_e,
         CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END AS last_e
  FROM st
),
b AS (
  SELECT *, CASE WHEN width = 0 THEN 1
                 ELSE greatest(ceil((last_e - first_e) / greatest(width, 1.0)), 1) END::INTEGER AS bins
  FROM w
),
e AS (SELECT *, (last_e - first_e) / bins AS step FROM b),
g0 AS (
  SELECT x.v, x.label, e.bins, e.step, e.first_e, e.last_e,
         least(floor((x.v - e.first_e) * (e.bins / (e.last_e - e.first_e)))::INTEGER, e.bins - 1) AS g
  FROM x CROSS JOIN e
),
g1 AS (
  SELECT *, CASE WHEN v < (CASE WHEN g >= bins THEN last_e ELSE g * step + first_e END) THEN g - 1 ELSE g END AS g2
  FROM g0
),
g2 AS (
  SELECT *, CASE WHEN v >= (CASE WHEN g2 + 1 >= bins THEN last_e ELSE (g2 + 1) * step + first_e END)
                      AND g2 <> bins - 1 THEN g2 + 1 ELSE g2 END AS bin
  FROM g1
)
SELECT bin::INTEGER AS bin,
       CASE WHEN bin >= bins THEN last_e ELSE bin * step + first_e END AS bin_start,
       CASE WHEN bin + 1 >= bins THEN last_e ELSE (bin + 1) * step + first_e END AS bin_end,
       label, count(*) AS n
FROM g2 GROUP BY bin, bins, step, first_e, last_e, label"""


@query("length_histogram", histogram_sql(oq.ROLE_TEXT_SQL))
def q_length_histogram(spark, sf_dir):
    return su.length_histogram(tr.role_text(spark, sf_dir))


def _nb_test_metrics(spark, sf_dir, metric=ev.evaluate) -> DataFrame:
    """A metric function on the test side, labels compared as strings."""
    prep, model = fitted(spark, sf_dir)
    m = metric(tr.score_prepared(model, prep.test), "gender", mx.output_cols(model)["predicted_label"])
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


@query("accuracy", nb_metrics_sql("accuracy"))
def q_accuracy(spark, sf_dir):
    return _nb_test_metrics(spark, sf_dir, ev.accuracy)


@query("weighted_precision", nb_metrics_sql("precision"))
def q_weighted_precision(spark, sf_dir):
    return _nb_test_metrics(spark, sf_dir, ev.weighted_precision)


@query("weighted_recall", nb_metrics_sql("recall"))
def q_weighted_recall(spark, sf_dir):
    return _nb_test_metrics(spark, sf_dir, ev.weighted_recall)


@query("weighted_f1", nb_metrics_sql("f1"))
def q_weighted_f1(spark, sf_dir):
    return _nb_test_metrics(spark, sf_dir, ev.weighted_f1)


@query("evaluate_model", nb_metrics_sql())
def q_evaluate_model(spark, sf_dir):
    return _nb_test_metrics(spark, sf_dir)


# =================================== 2.7 limits =====================================


@query(
    "sample_rows",
    f"SELECT name, gender, length(name)::INTEGER AS name_length FROM ({LOADED_SQL}) ORDER BY name, gender LIMIT 10",
)
def q_sample_rows(spark, sf_dir):
    """The first 10 rows of the summary table (name, label, length), in a fixed order."""
    rows = loaded(spark, sf_dir).withColumn("name_length", tx.text_length("name"))
    return lx.sample_rows(rows, ["name", "gender"], 10)


@query("first_row", f"SELECT name, gender FROM ({LOADED_SQL}) ORDER BY name, gender LIMIT 1")
def q_first_row(spark, sf_dir):
    return lx.first_row(loaded(spark, sf_dir), ["name", "gender"])


# ============================= 2.8 comparison of models ==============================


def _two_models(spark, sf_dir, variants: bool):
    """LR vs NB (the reference's pair) or NB on TF-IDF vs NB on raw TF."""
    prep = prepared(spark, sf_dir)
    if variants:
        names = ("tfidf", "tf")
        specs = {"tfidf": {"kind": "naive_bayes", "use_idf": True}, "tf": {"kind": "naive_bayes", "use_idf": False}}
    else:
        names = ("lr", "nb")
        specs = {"lr": {"kind": "logistic_regression"}, "nb": {"kind": "naive_bayes"}}
    models = tr.fit_many(prep, specs)
    return prep, models[names[0]], models[names[1]], names


def _compare_metrics(spark, sf_dir, variants):
    """Both models evaluated in one pass over the test side."""
    prep, a, b, names = _two_models(spark, sf_dir, variants)
    both = ev.evaluate_models(prep.test, {names[0]: a, names[1]: b})
    return cx.compare_metrics(both, names=names)


def _compare_predictions(spark, sf_dir, variants):
    _, a, b, names = _two_models(spark, sf_dir, variants)
    out = cx.compare_predictions(tr.doc_texts(spark, sf_dir), a, b, ["doc_id"], names=names)
    return out.select(
        *[r6(F.col(c)).alias(c) if c.endswith("_confidence") else F.col(c) for c in out.columns]
    )


def _variants_sql(select: str) -> str:
    ctes = oq.nb_ctes(TRAIN_SQL, FIRST_SQL, use_idf=True, prefix="a")
    ctes2 = oq.nb_ctes(TRAIN_SQL, FIRST_SQL, use_idf=False, prefix="b")
    base = f"""
cmp0 AS (
  SELECT s.doc_id, s.name, x.predicted_label AS tfidf_label, x.confidence AS tfidf_confidence,
         y.predicted_label AS tf_label, y.confidence AS tf_confidence
  FROM ({FIRST_SQL}) s
  JOIN (SELECT DISTINCT k, predicted_label, confidence FROM a_pred) x ON x.k = s.doc_id
  JOIN (SELECT DISTINCT k, predicted_label, confidence FROM b_pred) y ON y.k = s.doc_id
),
cmp AS (
  SELECT doc_id, name, tfidf_label, round(tfidf_confidence, 6) AS tfidf_confidence, tf_label,
         round(tf_confidence, 6) AS tf_confidence, tfidf_label = tf_label AS models_agree,
         CASE WHEN tfidf_confidence >= tf_confidence THEN 'tfidf' ELSE 'tf' END AS more_confident_model,
         CASE WHEN tfidf_label = tf_label OR tfidf_confidence >= tf_confidence THEN tfidf_label ELSE tf_label END
           AS preferred_label
  FROM cmp0
)"""
    return f"WITH {ctes},\n{ctes2},\n{base}\n{select}"


def _variants_metrics_sql() -> str:
    a = oq.nb_ctes(TRAIN_SQL, TEST_SQL, use_idf=True, prefix="a")
    b = oq.nb_ctes(TRAIN_SQL, TEST_SQL, use_idf=False, prefix="b")
    ma = metrics_sql("a_pred", TEST_SQL, "a_classes")
    mb = metrics_sql("b_pred", TEST_SQL, "b_classes")
    rows = []
    for key, disp in cx.METRIC_NAMES.items():
        rows.append(
            f"SELECT '{disp}' AS metric, round((SELECT {key} FROM ma), 3) AS tfidf, round((SELECT {key} FROM mb), 3) AS tf"
        )
    return f"WITH {a},\n{b},\nma AS ({ma}),\nmb AS ({mb})\n" + "\nUNION ALL ".join(rows)


@query("compare_metrics")
def q_compare_metrics(spark, sf_dir):
    return _compare_metrics(spark, sf_dir, variants=False)


@query("compare_metrics_nb_variants", _variants_metrics_sql())
def q_compare_metrics_nb_variants(spark, sf_dir):
    return _compare_metrics(spark, sf_dir, variants=True)


@query("compare_predictions")
def q_compare_predictions(spark, sf_dir):
    return _compare_predictions(spark, sf_dir, variants=False)


@query("compare_predictions_nb_variants", _variants_sql("SELECT * FROM cmp"))
def q_compare_predictions_nb_variants(spark, sf_dir):
    return _compare_predictions(spark, sf_dir, variants=True)


@query("models_agree")
def q_models_agree(spark, sf_dir):
    return _compare_predictions(spark, sf_dir, False).select("doc_id", "lr_label", "nb_label", "models_agree")


@query("models_agree_nb_variants", _variants_sql("SELECT doc_id, tfidf_label, tf_label, models_agree FROM cmp"))
def q_models_agree_nb_variants(spark, sf_dir):
    return _compare_predictions(spark, sf_dir, True).select("doc_id", "tfidf_label", "tf_label", "models_agree")


@query("more_confident_model")
def q_more_confident_model(spark, sf_dir):
    return _compare_predictions(spark, sf_dir, False).select("doc_id", "more_confident_model", "preferred_label")


@query(
    "more_confident_model_nb_variants",
    _variants_sql("SELECT doc_id, more_confident_model, preferred_label FROM cmp"),
)
def q_more_confident_model_nb_variants(spark, sf_dir):
    return _compare_predictions(spark, sf_dir, True).select("doc_id", "more_confident_model", "preferred_label")


@query("agreement_rate")
def q_agreement_rate(spark, sf_dir):
    out = cx.agreement_rate(_compare_predictions(spark, sf_dir, False))
    return out.withColumn("agreement_rate", r6(F.col("agreement_rate")))


@query(
    "agreement_rate_nb_variants",
    _variants_sql("SELECT count(*) AS rows, round(avg(models_agree::DOUBLE), 6) AS agreement_rate FROM cmp"),
)
def q_agreement_rate_nb_variants(spark, sf_dir):
    out = cx.agreement_rate(_compare_predictions(spark, sf_dir, True))
    return out.withColumn("agreement_rate", r6(F.col("agreement_rate")))


# ================================ streaming variant ================================


@query(
    "predict_names_stream",
    nb_sql(
        "SELECT doc_id, name, predicted_label, round(confidence, 6) AS confidence FROM ("
        + nb_predict_sql(FIRST_SQL)
        + ")",
        FIRST_SQL,
    ),
)
def q_predict_names_stream(spark, sf_dir):
    """``predict_names`` with documents read as a stream (catch-up trigger),
    written to a parquet sink in the shared folder and read back."""
    from labelkit.streaming.scoring import start_scoring

    _, model = fitted(spark, sf_dir)
    docs = tr.table(spark, sf_dir, "documents")
    # A pattern names a table that is one file as well as one that is a folder of files.
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf_dir}/documents.parque[t]").select("doc_id", F.col("text").alias("name"))
    out = scratch_path(spark, "stream-out")
    q = start_scoring(stream, model, out, ["doc_id"], available_now=True)
    q.awaitTermination()
    return predictions(spark.read.parquet(out))


def doc_stream(spark: SparkSession, folder: str, like: DataFrame, glob: str = "*.parquet") -> DataFrame:
    stream = spark.readStream.schema(like.schema).option("pathGlobFilter", glob).parquet(folder)
    return stream.select("doc_id", F.col("text").alias("name"))


@query("predict_names_stream_restart", ORACLE["predict_names_stream"])
def q_predict_names_stream_restart(spark, sf_dir):
    """Documents that arrive in two parts; the scorer is started anew, on the same output, after each."""
    from labelkit.streaming.scoring import start_scoring

    _, model = fitted(spark, sf_dir)
    docs = tr.table(spark, sf_dir, "documents")
    arrived, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    early = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    for part in (docs.filter(early), docs.filter(~early)):
        part.write.mode("append").parquet(arrived)
        start_scoring(doc_stream(spark, arrived, docs), model, out, ["doc_id"], available_now=True).awaitTermination()
    return predictions(spark.read.parquet(out))


# ================================ the whole names-file flow ================================

_NAMES_ROWS_SQL = (
    "SELECT name || '|' || gender || '|' || copy AS doc_id, name, gender "
    f"FROM (SELECT *, row_number() OVER (PARTITION BY name, gender) - 1 AS copy FROM ({LOADED_SQL}))"
)
_NAMES_TRAIN_SQL = f"SELECT * FROM ({_NAMES_ROWS_SQL}) WHERE {oq.is_train_sql('doc_id')}"
_NAMES_TEST_SQL = f"SELECT * FROM ({_NAMES_ROWS_SQL}) WHERE NOT {oq.is_train_sql('doc_id')}"


@query(
    "names_file_metrics",
    f"WITH {oq.nb_ctes(_NAMES_TRAIN_SQL, _NAMES_TEST_SQL)},\nm AS ({metrics_sql('nb_pred', _NAMES_TEST_SQL, 'nb_classes')})\n"
    + "\nUNION ALL ".join(f"SELECT '{shown}' AS metric, round({k}, 3) AS naive_bayes FROM m" for k, shown in cx.METRIC_NAMES.items()),
)
def q_names_file_metrics(spark, sf_dir):
    """Load, summarise, split, fit and evaluate on a names file, as one call."""
    from labelkit.plans.names_file import train_and_evaluate

    return train_and_evaluate(spark, written_lines(spark, sf_dir), kinds=("naive_bayes",)).metrics


# ===================== logistic regression at its optimum, by Newton steps in SQL =====================

CONVERGED = {"use_idf": False, "max_iter": 500, "tol": 1e-13}


def converged(spark: SparkSession, sf_dir: str, *kinds: str):
    """Two raw term counts as features: the regularised optimum is unique, so SQL can find it, too."""
    prep = tr.prepare_training_data(tr.doc_texts(spark, sf_dir), tr.doc_labels(spark, sf_dir), ["doc_id"], num_features=2)
    return prep, tr.fit_many(prep, {k: {"kind": k, **CONVERGED} for k in kinds})


# The penalty is on standardized coefficients (z = x / sample deviation), the intercept is free.
def _newton_ctes(train: str, score: str) -> str:
    return f"""
{oq.nb_ctes(train, score, num_features=2, use_idf=False)},
tv AS (SELECT t.k, CASE WHEN c.ci = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS y, coalesce(sum(v.v) FILTER (v.bucket = 0), 0)::DOUBLE AS x0,
       coalesce(sum(v.v) FILTER (v.bucket = 1), 0)::DOUBLE AS x1
       FROM nb_train t JOIN nb_classes c ON c.gender = t.gender LEFT JOIN nb_v v ON v.k = t.k GROUP BY t.k, c.ci),
sd AS MATERIALIZED (SELECT stddev_samp(x0) AS s0, stddev_samp(x1) AS s1, avg(y) AS share FROM tv),
tz AS MATERIALIZED (SELECT y, x0 / s0 AS z0, x1 / s1 AS z1 FROM tv CROSS JOIN sd),
nt AS (
  SELECT 0 AS i, ln(share / (1 - share)) AS b, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1 FROM sd
  UNION ALL
  SELECT i + 1, b - (g * (h00 * h11 - h01 * h01) - g0 * (hb0 * h11 - hb1 * h01) + g1 * (hb0 * h01 - hb1 * h00)) / det,
         w0 - (hbb * (g0 * h11 - g1 * h01) - hb0 * (g * h11 - hb1 * g1) + hb1 * (g * h01 - hb1 * g0)) / det,
         w1 - (hbb * (h00 * g1 - h01 * g0) - hb0 * (hb0 * g1 - h01 * g) + hb1 * (hb0 * g0 - h00 * g)) / det
  FROM (SELECT *, hbb * (h00 * h11 - h01 * h01) - hb0 * (hb0 * h11 - hb1 * h01) + hb1 * (hb0 * h01 - hb1 * h00) AS det FROM (
    SELECT i, b, w0, w1, avg(p - y) AS g, avg((p - y) * z0) + 0.1 * w0 AS g0, avg((p - y) * z1) + 0.1 * w1 AS g1,
           avg(p * (1 - p)) AS hbb, avg(p * (1 - p) * z0) AS hb0, avg(p * (1 - p) * z1) AS hb1,
           avg(p * (1 - p) * z0 * z0) + 0.1 AS h00, avg(p * (1 - p) * z0 * z1) AS h01, avg(p * (1 - p) * z1 * z1) + 0.1 AS h11
    FROM (SELECT nt.*, tz.*, 1 / (1 + exp(-(b + w0 * z0 + w1 * z1))) AS p FROM nt CROSS JOIN tz WHERE i < 30) GROUP BY i, b, w0, w1))
),
lr AS MATERIALIZED (SELECT b, w0 / s0 AS c0, w1 / s1 AS c1 FROM nt CROSS JOIN sd WHERE i = 30),
lr_pred AS (
  SELECT s.doc_id, s.name, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, greatest(p, 1 - p) AS confidence,
         (SELECT gender FROM nb_classes WHERE ci = CASE WHEN p > 0.5 THEN 1 ELSE 0 END) AS predicted_label
  FROM (SELECT q.doc_id, any_value(q.name) AS name, 1 / (1 + exp(-(any_value(lr.b) + any_value(lr.c0) * coalesce(sum(v.v) FILTER (v.bucket = 0), 0)
        + any_value(lr.c1) * coalesce(sum(v.v) FILTER (v.bucket = 1), 0)))) AS p
        FROM ({score}) q CROSS JOIN lr LEFT JOIN nb_sv v ON v.k = q.doc_id GROUP BY q.doc_id) s
)"""


def _newton_sql(select: str, score: str = DOCS_SQL, train: str = TRAIN_SQL) -> str:
    return "WITH RECURSIVE " + _newton_ctes(train, score) + "\n" + select


@query(
    "train_logistic_regression_converged",
    _newton_sql(
        "SELECT 'b0' AS term, round(c0, 5) AS coefficient FROM lr UNION ALL SELECT 'b1', round(c1, 5) FROM lr "
        "UNION ALL SELECT 'intercept', round(b, 5) FROM lr",
        TRAIN_SQL,
    ),
)
def q_train_logistic_regression_converged(spark, sf_dir):
    _, models = converged(spark, sf_dir, "logistic_regression")
    lr = mx.classifier(models["logistic_regression"])
    rows = [(f"b{i}", float(c)) for i, c in enumerate(lr.coefficients.toArray())] + [("intercept", float(lr.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double").withColumn("coefficient", F.round("coefficient", 5))


@query(
    "score_logistic_regression_converged",
    _newton_sql("SELECT doc_id, prediction::DOUBLE AS prediction, predicted_label, round(confidence, 4) AS confidence FROM lr_pred"),
)
def q_score_logistic_regression_converged(spark, sf_dir):
    _, models = converged(spark, sf_dir, "logistic_regression")
    model = models["logistic_regression"]
    scored = sx.decode_prediction(sx.score(whole_texts(spark, sf_dir), model), model)
    return scored.select("doc_id", "prediction", "predicted_label", F.round("confidence", 4).alias("confidence"))


_COMPARED_SQL = f"""SELECT l.doc_id, l.name, l.predicted_label AS lr_label, round(l.confidence, 4) AS lr_confidence, n.predicted_label AS nb_label,
  round(n.confidence, 4) AS nb_confidence, l.predicted_label = n.predicted_label AS models_agree,
  CASE WHEN l.confidence >= n.confidence THEN 'lr' ELSE 'nb' END AS more_confident_model,
  CASE WHEN l.predicted_label = n.predicted_label OR l.confidence >= n.confidence THEN l.predicted_label ELSE n.predicted_label END AS preferred_label
FROM lr_pred l JOIN (SELECT DISTINCT k, predicted_label, confidence FROM nb_pred) n ON n.k = l.doc_id"""


def _compared_converged(spark, sf_dir) -> DataFrame:
    _, models = converged(spark, sf_dir, *mx.KINDS)
    out = cx.compare_predictions(tr.doc_texts(spark, sf_dir), models["logistic_regression"], models["naive_bayes"], ["doc_id"])
    return out.select(*[F.round(c, 4).alias(c) if c.endswith("_confidence") else F.col(c) for c in out.columns])


@query("compare_predictions_converged", _newton_sql(_COMPARED_SQL, FIRST_SQL))
def q_compare_predictions_converged(spark, sf_dir):
    return _compared_converged(spark, sf_dir)


@query("models_agree_converged", _newton_sql(f"SELECT doc_id, lr_label, nb_label, models_agree FROM ({_COMPARED_SQL})", FIRST_SQL))
def q_models_agree_converged(spark, sf_dir):
    return _compared_converged(spark, sf_dir).select("doc_id", "lr_label", "nb_label", "models_agree")


@query(
    "agreement_rate_converged",
    _newton_sql(f"SELECT count(*) AS rows, round(avg(models_agree::DOUBLE), 6) AS agreement_rate FROM ({_COMPARED_SQL})", FIRST_SQL),
)
def q_agreement_rate_converged(spark, sf_dir):
    return cx.agreement_rate(_compared_converged(spark, sf_dir)).withColumn("agreement_rate", r6(F.col("agreement_rate")))


_MATCHED_SQL = f"""SELECT '{{shown}}' AS metric, round((SELECT {{key}} FROM ml), 3) AS lr, round((SELECT {{key}} FROM mn), 3) AS nb"""


@query(
    "compare_metrics_converged",
    _newton_sql("", TEST_SQL).rstrip()
    + f""",
lr_k AS (SELECT doc_id AS k, prediction FROM lr_pred), ml AS ({metrics_sql('lr_k', TEST_SQL, 'nb_classes')}),
mn AS ({metrics_sql('nb_pred', TEST_SQL, 'nb_classes')})
"""
    + "\nUNION ALL ".join(_MATCHED_SQL.format(shown=shown, key=k) for k, shown in cx.METRIC_NAMES.items()),
)
def q_compare_metrics_converged(spark, sf_dir):
    prep, models = converged(spark, sf_dir, *mx.KINDS)
    both = ev.evaluate_models(prep.test, {"lr": models["logistic_regression"], "nb": models["naive_bayes"]})
    return cx.compare_metrics(both, names=("lr", "nb"))


_FLOW_MODELS = {"logistic_regression": "ml", "naive_bayes": "mn"}
_FLOW_SUMMARY = ("total_names", "male_count", "female_count", "avg_name_length", "min_name_length", "max_name_length")


@query(
    "names_file_flow",
    _newton_sql("", _NAMES_TEST_SQL, _NAMES_TRAIN_SQL).rstrip()
    + f""",
lr_k AS (SELECT doc_id AS k, prediction FROM lr_pred), ml AS ({metrics_sql('lr_k', _NAMES_TEST_SQL, 'nb_classes')}),
mn AS ({metrics_sql('nb_pred', _NAMES_TEST_SQL, 'nb_classes')}), su AS ({ORACLE['data_summary']})
"""
    + "\nUNION ALL ".join(
        [f"SELECT 'summary' AS step, '{c}' AS item, {c}::DOUBLE AS value FROM su" for c in _FLOW_SUMMARY]
        + [
            f"SELECT '{step} {model}', '{shown}', round({key}, 3) FROM {cte}"
            for step in ("trained", "loaded")
            for model, cte in _FLOW_MODELS.items()
            for key, shown in cx.METRIC_NAMES.items()
        ]
        + [f"SELECT '{step}', 'all models loaded', {found}::DOUBLE" for step, found in (("trained", 0), ("loaded", 1))]
    ),
)
def q_names_file_flow(spark, sf_dir):
    """The whole flow on a names file, twice: both models are trained, saved and
    evaluated, then loaded from where they were saved and evaluated again.

    Settings are those of ``converged``, at whose optimum SQL arrives, too.
    """
    from labelkit.plans.names_file import train_and_evaluate

    lines, models = written_lines(spark, sf_dir), scratch_path(spark, "flow-models")
    runs = {step: train_and_evaluate(spark, lines, model_dir=models, settings=CONVERGED, num_features=2) for step in ("trained", "loaded")}
    first = runs["trained"].summary.withColumn("avg_name_length", r6(F.col("avg_name_length")))
    out = first.select(F.lit("summary").alias("step"), *(F.col(c).cast("double") for c in _FLOW_SUMMARY)).unpivot("step", list(_FLOW_SUMMARY), "item", "value")
    for step, run in runs.items():
        names = list(_FLOW_MODELS)
        by_model = run.metrics.unpivot("metric", names, "model", "value")
        out = out.unionByName(by_model.select(F.concat(F.lit(f"{step} "), "model").alias("step"), F.col("metric").alias("item"), "value"))
    found = [(step, "all models loaded", float(run.loaded)) for step, run in runs.items()]
    return out.unionByName(spark.createDataFrame(found, "step string, item string, value double"))
