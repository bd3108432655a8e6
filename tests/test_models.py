"""Models: agreement with plain Spark ML fits, label decoding, persistence,
degenerate inputs, invariance under re-partitioning."""

import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, StringIndexer
from pyspark.sql import functions as F

from conftest import SF01
from labelkit.operators import compare as cx
from labelkit.operators import evaluate as ev
from labelkit.operators import models as mx
from labelkit.operators import score as sx
from labelkit.plans import catalog
from labelkit.plans import training as tr
from labelkit.session import scratch_path


def plain_fit(prep, estimator):
    """The reference's way: IDF and indexer fitted, then the classifier, as
    separate Spark ML calls on the train features."""
    train = prep.train
    idf = IDF(inputCol="raw_features", outputCol="features").fit(train)
    idx = StringIndexer(inputCol="gender", outputCol="label").fit(train)
    data = idx.transform(idf.transform(train))
    return idf, idx, estimator.fit(data)


def test_nb_matches_plain_spark_ml(spark, nb_setup):
    prep, model = nb_setup
    idf, idx, nb = plain_fit(prep, NaiveBayes(smoothing=1.0))
    ours = mx.classifier(model)
    assert np.allclose(ours.pi.toArray(), nb.pi.toArray())
    assert np.allclose(ours.theta.toArray(), nb.theta.toArray())
    assert list(mx.label_indexer(model).labels) == list(idx.labels)


def test_lr_matches_plain_spark_ml(spark, nb_setup, lr_model):
    prep, _ = nb_setup
    _, _, lr = plain_fit(prep, LogisticRegression(maxIter=10, regParam=0.1))
    ours = mx.classifier(lr_model)
    assert np.allclose(ours.coefficients.toArray(), lr.coefficients.toArray(), atol=1e-9)
    assert abs(ours.intercept - lr.intercept) < 1e-9


def test_decoding_uses_indexer_order_and_relabel_swaps(spark, nb_setup):
    """Majority class M gets index 0; the reference would have shown it as F."""
    prep, model = nb_setup
    assert list(mx.label_indexer(model).labels) == ["M", "F"]
    swapped = prep.train.withColumn("gender", F.when(F.col("gender") == "M", "F").otherwise("M"))
    model2 = mx.fit_on_features(swapped, "naive_bayes", prep.stages)
    docs = tr.doc_texts(spark, SF01)
    a = sx.predict_names(docs, model, ["doc_id"]).select("doc_id", "predicted_label")
    b = sx.predict_names(docs, model2, ["doc_id"]).select("doc_id", F.col("predicted_label").alias("p2"))
    j = a.join(b, "doc_id")
    assert j.count() == 1000
    assert j.filter(F.col("predicted_label") == F.col("p2")).count() == 0


def test_confidence_is_probability_of_predicted_class(spark, nb_setup):
    prep, model = nb_setup
    out = sx.decode_prediction(tr.score_prepared(model, prep.test), model)
    bad = out.filter(F.col("confidence") < 0.5).count()
    assert bad == 0  # two classes: the arg-max probability is at least one half


def test_metrics_equal_spark_evaluator(spark, nb_setup, lr_model):
    prep, model = nb_setup
    for m in (model, lr_model):
        scored = mx.heads(m).transform(prep.test).cache()
        ours = ev.evaluate(scored).first()
        strings = ev.evaluate(scored, "gender", "predicted_label").first()
        for name, metric in [("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")]:
            ref = MulticlassClassificationEvaluator(metricName=metric).evaluate(scored)
            assert abs(ours[name] - ref) < 1e-12, name
            assert abs(strings[name] - ref) < 1e-12, name
        scored.unpersist()


def test_metrics_with_class_never_predicted(spark):
    cm = spark.createDataFrame([(0.0, 0.0, 5), (1.0, 0.0, 3)], "label double, prediction double, n long")
    row = ev.metrics_from_confusion(cm).first()
    assert row["accuracy"] == pytest.approx(5 / 8)
    assert row["precision"] == pytest.approx((5 / 8) * (5 / 8) + 0.0)
    assert row["recall"] == pytest.approx(5 / 8)
    p, r = 5 / 8, 1.0
    assert row["f1"] == pytest.approx((2 * p * r / (p + r)) * 5 / 8)


def test_save_load_roundtrip_and_kind_check(spark, nb_setup):
    _, model = nb_setup
    path = mx.save_model(model, scratch_path(spark, "t-model"))
    mx.save_model(model, path)  # overwrite works
    again = mx.load_model(spark, "naive_bayes", path)
    # Saved and reloaded model side by side in one projection: no row differs.
    from labelkit.operators import compare as cx

    both = cx.compare_predictions(tr.doc_texts(spark, SF01), model, again, ["doc_id"], names=("saved", "loaded"))
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    differs = (F.col("saved_label") != F.col("loaded_label")) | (F.col("saved_confidence") != F.col("loaded_confidence"))
    row = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(differs).alias("bad")).first()
    assert (row["n"], row["bad"]) == (1000, 0)
    with pytest.raises(ValueError):
        mx.load_model(spark, "logistic_regression", path)
    with pytest.raises(ValueError):
        mx.load_model(spark, "svm", path)


def test_load_or_train(spark):
    train = tr.labelled_docs(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "t-lot")
    paths = {"naive_bayes": f"{root}/nb"}
    _, loaded1 = mx.load_or_train(spark, train, paths)
    _, loaded2 = mx.load_or_train(spark, train, paths)
    _, loaded3 = mx.load_or_train(spark, train, paths, num_features=32)  # stale: other params
    assert (loaded1, loaded2, loaded3) == (False, True, False)


def test_degenerate_fits_raise(spark, nb_setup):
    prep, _ = nb_setup
    empty = prep.train.limit(0)
    one = prep.train.filter(F.col("gender") == "M")
    for kind in mx.KINDS:
        with pytest.raises(ValueError):
            mx.fit_on_features(empty, kind, prep.stages)
        with pytest.raises(ValueError):
            mx.fit_on_features(one, kind, prep.stages)
    with pytest.raises(ValueError):
        mx.fit_on_features(prep.train, "svm", prep.stages)


def test_predictions_invariant_under_repartition(spark, nb_setup):
    _, model = nb_setup
    docs = tr.doc_texts(spark, SF01)
    a = sx.predict_names(docs, model, ["doc_id"])
    b = sx.predict_names(docs.repartition(7), model, ["doc_id"])
    assert a.exceptAll(b).count() == 0


def test_text_path_equals_feature_path(spark, nb_setup):
    """Fitting on a text table and on pre-featurized rows gives the same model."""
    prep, model = nb_setup
    train_text = tr.labelled_docs(spark, SF01).join(prep.train.select("doc_id"), "doc_id")
    m2 = mx.train_naive_bayes(train_text)
    assert np.allclose(mx.classifier(m2).theta.toArray(), mx.classifier(model).theta.toArray())


def test_use_idf_false_scores_raw_tf(spark, nb_setup):
    prep, _ = nb_setup
    m = tr.fit(prep, "naive_bayes", use_idf=False)
    assert mx.idf_model(m) is None
    assert mx.classifier(m).getFeaturesCol() == "raw_features"


def test_model_stages_are_one_pipeline(nb_setup):
    _, model = nb_setup
    assert isinstance(model, PipelineModel)
    names = [type(s).__name__ for s in model.stages]
    assert names == ["SQLTransformer", "Tokenizer", "StopWordsRemover", "HashingTF", "IDFModel",
                     "StringIndexerModel", "NaiveBayesModel", "IndexToString"]


def test_load_or_train_on_prepared_features(spark, nb_setup):
    prep, model = nb_setup
    root = scratch_path(spark, "t-lot-feat")
    paths = {"naive_bayes": f"{root}/nb", "logistic_regression": f"{root}/lr"}
    m1, loaded1 = mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
    m2, loaded2 = mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
    assert (loaded1, loaded2) == (False, True)
    assert np.allclose(mx.classifier(m2["naive_bayes"]).theta.toArray(), mx.classifier(model).theta.toArray())
    assert mx.kind_of(m2["logistic_regression"]) == "logistic_regression"


def test_null_text_is_scored_not_fatal(spark, nb_setup):
    _, model = nb_setup
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Fatima")], "id int, name string")
    out = {r["id"]: r for r in sx.predict_names(df, model, ["id"]).collect()}
    assert len(out) == 3
    assert out[1]["predicted_label"] == out[2]["predicted_label"]
    assert out[1]["confidence"] == out[2]["confidence"]


def test_evaluate_models_one_pass_equals_separate(spark, nb_setup, lr_model):
    prep, nb = nb_setup
    both = {r["model"]: r for r in ev.evaluate_models(prep.test, {"lr": lr_model, "nb": nb}).collect()}
    for name, m in (("lr", lr_model), ("nb", nb)):
        one = ev.evaluate(tr.score_prepared(m, prep.test)).first()
        for k in ev.METRICS:
            assert abs(both[name][k] - one[k]) < 1e-12


def test_second_label_toxic(spark):
    """The unbalanced toxic label (FIXTURES.md): minority class 'M' (toxic = 1)."""
    prep = tr.prepare_training_data(tr.doc_texts(spark, SF01), tr.doc_labels(spark, SF01, "toxic"), ["doc_id"])
    models = tr.fit_many(prep, {"nb": {"kind": "naive_bayes"}, "lr": {"kind": "logistic_regression"}})
    assert list(mx.label_indexer(models["nb"]).labels) == ["F", "M"]  # majority first
    rows = {r["model"]: r for r in ev.evaluate_models(prep.test, models).collect()}
    for r in rows.values():
        assert 0.0 <= r["precision"] <= 1.0 and 0.5 < r["accuracy"] <= 1.0
        assert r["accuracy"] == pytest.approx(r["recall"])
    assert prep.labelled.count() == 399


def test_evaluate_models_equals_single_evaluations(spark, nb_setup, lr_model):
    prep, nb = nb_setup
    both = {r["model"]: r for r in ev.evaluate_models(prep.test, {"lr": lr_model, "nb": nb}).collect()}
    for name, model in (("lr", lr_model), ("nb", nb)):
        one = ev.evaluate(tr.score_prepared(model, prep.test), "gender", "predicted_label").first()
        for k in ev.METRICS:
            assert abs(both[name][k] - one[k]) < 1e-12


def test_label_seen_in_test_only_is_an_error_row(spark, nb_setup):
    prep, nb = nb_setup
    n = prep.test.count()
    right = ev.accuracy(tr.score_prepared(nb, prep.test), "gender", "predicted_label").first()[0] * n
    more = prep.test.unionByName(prep.test.limit(5).withColumn("gender", F.lit("X")))
    for row in (ev.evaluate(tr.score_prepared(nb, more), "gender", "predicted_label").first(), ev.evaluate_models(more, {"nb": nb}).first()):
        assert row["accuracy"] == pytest.approx(right / (n + 5)) and row["recall"] == pytest.approx(right / (n + 5))


def test_fit_keeps_the_partitions_of_its_rows(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors, VectorUDT

    rows = spark.range(200_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, "F").otherwise("M").alias("gender"), (F.col("id") % 7).cast("double").alias("x"))
    vector = F.udf(lambda x: Vectors.dense([x, 1.0]), VectorUDT())
    data = rows.withColumn("raw_features", vector("x")).select("gender", "raw_features")
    seen = []
    real = mx.fx.fit_idf
    monkeypatch.setattr(mx.fx, "fit_idf", lambda df, *a: (seen.append(df.rdd.getNumPartitions()), real(df, *a))[1])
    mx.fit_on_features(data, "naive_bayes", [], materialize_input=False)
    assert seen == [4]


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mx, "MAX_CLASSES", 3)
    with pytest.raises(ValueError):
        mx.label_counts(spark.range(10).withColumn("gender", F.col("id").cast("string")), "gender")


def test_wide_label_keys_are_not_broadcast(spark):
    narrow = spark.range(100).select("id", F.lit("M").alias("gender"))
    wide = spark.range(100).select(F.repeat(F.lit("k"), 1_000_000).alias("id"), F.lit("M").alias("gender"))
    assert tr.table_bytes(narrow) < tr.BROADCAST_MAX_BYTES < tr.table_bytes(wide)
    texts = wide.select("id", F.lit("a b").alias("name"))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tr.labelled_features(texts, wide, ["id"], mx.fx.feature_stages())._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_load_or_train_sees_other_texts(spark):
    """Equal label counts and different texts: another model."""
    paths = {"naive_bayes": f"{scratch_path(spark, 't-lot-content')}/nb"}
    one = spark.createDataFrame([("ali", "M"), ("fatima", "F"), ("omar", "M")], "name string, gender string")
    two = spark.createDataFrame([("zed", "M"), ("ynes", "F"), ("xavier", "M")], "name string, gender string")
    assert not mx.load_or_train(spark, one, paths)[1]
    assert mx.load_or_train(spark, one.repartition(3), paths)[1]
    assert mx.load_or_train(spark, one, paths, smoothing=1.0)[1]  # the default
    assert not mx.load_or_train(spark, two, paths)[1]
    assert not mx.load_or_train(spark, two, paths, smoothing=2.0)[1]
    assert mx.load_or_train(spark, two, paths, smoothing=2.0)[1]


def test_release_deletes_the_features(spark):
    prep = tr.prepare_training_data(tr.doc_texts(spark, SF01), tr.doc_labels(spark, SF01), ["doc_id"])
    files = prep.labelled.inputFiles()
    prep.release()
    assert files and all(not os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in files)


def test_predict_from_a_column_of_another_name(spark, nb_setup):
    _, nb = nb_setup
    rows = spark.createDataFrame([(1, "Ali Baba", "other"), (2, "Fatima", "words")], "id long, text string, name string")
    want = [r[1:] for r in map(tuple, sx.predict_names(rows.select("id", F.col("text").alias("name")), nb, ["id"]).orderBy("id").collect())]
    got = sx.predict_names(rows, nb, ["id", "name"], text_col="text").orderBy("id")
    assert got.columns == ["id", "name", "text", "predicted_label", "confidence"]
    assert [(r[2], r[3], r[4]) for r in got.collect()] == want
    compared = cx.compare_predictions(rows, nb, nb, ["name"], text_col="text", names=("a", "b"))
    assert compared.filter("not models_agree").count() == 0 and compared.columns[:2] == ["name", "text"]


def test_load_or_train_surfaces_corrupt_model(spark, nb_setup):
    prep, _ = nb_setup
    root = scratch_path(spark, "t-lot-corrupt")
    paths = {"naive_bayes": f"{root}/nb"}
    mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
    # Replace the saved model with something that is not a model.
    spark.createDataFrame([("x",)], "value string").write.mode("overwrite").text(f"{root}/nb/model")
    with pytest.raises(Exception):
        mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
    # A model of the wrong class under a matching fingerprint surfaces too.
    lr = tr.fit(prep, "logistic_regression")
    mx.save_model(lr, f"{root}/nb/model")
    with pytest.raises(ValueError):
        mx.load_or_train(spark, prep.train, paths, stages=prep.stages)
