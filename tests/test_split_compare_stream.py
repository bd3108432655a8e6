"""Split stability, one-pass comparison, and the streaming scorer."""

from pyspark.sql import functions as F

from conftest import SF001, SF01
from labelkit.operators import compare as cx
from labelkit.operators import evaluate as ev
from labelkit.operators import score as sx
from labelkit.operators.split import is_train, split_train_test
from labelkit.plans import catalog
from labelkit.plans import training as tr
from labelkit.session import scratch_path
from labelkit.streaming.scoring import score_stream, start_scoring


def test_split_stable_under_repartition(spark):
    df = tr.labelled_docs(spark, SF01).select("doc_id", "gender")
    a, _ = split_train_test(df, ["doc_id"])
    b, _ = split_train_test(df.repartition(7), ["doc_id"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    n, t = df.count(), a.count()
    assert 0.7 < t / n < 0.9
    c, d = split_train_test(df, ["doc_id"], share=0.5, seed=7)
    assert c.count() + d.count() == n


def test_split_sides_are_disjoint_and_complete(spark):
    df = tr.labelled_docs(spark, SF01).select("doc_id")
    train, test = split_train_test(df, ["doc_id"])
    assert train.join(test, "doc_id").count() == 0
    assert train.count() + test.count() == df.count()
    assert df.filter(is_train(["doc_id"]).isNull()).count() == 0


def test_compare_predictions_one_pass_and_equal_to_separate(spark, nb_setup, lr_model):
    _, nb = nb_setup
    docs = tr.doc_texts(spark, SF01)
    cmp = cx.compare_predictions(docs, lr_model, nb, ["doc_id"])
    plan = cmp._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no shuffle, no join
    a = sx.predict_names(docs, lr_model, ["doc_id"]).select("doc_id", F.col("predicted_label").alias("lr_label"), F.col("confidence").alias("lr_confidence"))
    b = sx.predict_names(docs, nb, ["doc_id"]).select("doc_id", F.col("predicted_label").alias("nb_label"), F.col("confidence").alias("nb_confidence"))
    sep = cx.with_agreement(a.join(b, "doc_id"))
    cols = ["doc_id", "lr_label", "lr_confidence", "nb_label", "nb_confidence", "models_agree", "more_confident_model", "preferred_label"]
    assert cmp.select(cols).exceptAll(sep.select(cols)).count() == 0
    rate = cx.agreement_rate(cmp).first()
    assert rate["rows"] == 1000 and 0.0 <= rate["agreement_rate"] <= 1.0


def test_compare_metrics_table(spark, nb_setup, lr_model):
    prep, nb = nb_setup
    m = cx.compare_metrics({
        "lr": ev.evaluate(tr.score_prepared(lr_model, prep.test)),
        "nb": ev.evaluate(tr.score_prepared(nb, prep.test)),
    })
    rows = {r["metric"]: (r["lr"], r["nb"]) for r in m.collect()}
    assert set(rows) == {"Accuracy", "Precision", "Recall", "F1 Score"}
    assert rows["Accuracy"] == rows["Recall"]  # weighted recall equals accuracy


def test_agreement_more_confident(spark):
    df = spark.createDataFrame(
        [(1, "M", 0.9, "F", 0.6), (2, "M", 0.55, "F", 0.8), (3, "F", 0.7, "F", 0.7)],
        "id int, lr_label string, lr_confidence double, nb_label string, nb_confidence double",
    )
    got = sorted(tuple(r) for r in cx.with_agreement(df).select("id", "models_agree", "more_confident_model", "preferred_label").collect())
    assert got == [(1, False, "lr", "M"), (2, False, "nb", "F"), (3, True, "lr", "F")]


def test_stream_scoring_equals_batch(spark, nb_setup):
    _, nb = nb_setup
    docs = tr.table(spark, SF01, "documents")
    stream = (
        spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet").parquet(SF01)
        .select("doc_id", F.col("text").alias("name"))
    )
    assert score_stream(stream, nb, ["doc_id"]).isStreaming
    out = scratch_path(spark, "t-stream")
    q = start_scoring(stream, nb, out, ["doc_id"], available_now=True)
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = sx.predict_names(tr.doc_texts(spark, SF01), nb, ["doc_id"])
    assert streamed.count() == 1000
    assert streamed.exceptAll(batch).count() == 0


def test_labelled_features_paths_agree(spark):
    from labelkit.operators import features as fx
    from labelkit.operators.features import explode_vector

    texts, labels = tr.doc_texts(spark, SF01), tr.doc_labels(spark, SF01)
    stages = fx.feature_stages()

    def rows(df):
        return explode_vector(df, ["doc_id", "gender"], "raw_features")

    a = rows(tr.labelled_features(texts, labels, ["doc_id"], stages))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = tr.labelled_features(texts, labels, ["doc_id"], stages, broadcast_max_bytes=0)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        b = rows(shuffled)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_composite_keys_role_model(spark):
    """Train and evaluate on conversation turns keyed by (conv_id, turn)."""
    roles = tr.role_text(spark, SF01)
    prep = tr.prepare_training_data(roles.select("conv_id", "turn", "name"), roles.select("conv_id", "turn", "gender"), ["conv_id", "turn"])
    model = tr.fit(prep, "naive_bayes")
    m = ev.evaluate(tr.score_prepared(model, prep.test)).first()
    assert prep.train.count() + prep.test.count() == roles.count()
    assert 0.5 < m["accuracy"] <= 1.0
    assert set(mx_labels(model)) == {"user", "assistant"}


def mx_labels(model):
    from labelkit.operators import models as mx

    return list(mx.label_indexer(model).labels)


def test_score_stream_rejects_batch(spark, nb_setup):
    import pytest

    _, nb = nb_setup
    with pytest.raises(ValueError):
        score_stream(tr.doc_texts(spark, SF01), nb, ["doc_id"])


def test_stream_restart_resumes_exactly_once(spark, nb_setup, tmp_path):
    _, nb = nb_setup
    docs = tr.table(spark, SF01, "documents").select("doc_id", F.col("text").alias("name"))
    src = str(tmp_path / "incoming")
    docs.filter(F.col("doc_id") < 500).write.parquet(f"{src}/part1")
    stream = spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    start_scoring(stream, nb, out, ["doc_id"], checkpoint_path=ckpt, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 500
    docs.filter(F.col("doc_id") >= 500).write.parquet(f"{src}/part2")
    start_scoring(stream, nb, out, ["doc_id"], checkpoint_path=ckpt, available_now=True).awaitTermination()
    result = spark.read.parquet(out)
    assert result.count() == 1000 and result.select("doc_id").distinct().count() == 1000


def test_stream_restart_without_a_checkpoint_argument(spark, nb_setup, tmp_path):
    _, nb = nb_setup
    docs = tr.table(spark, SF01, "documents").select("doc_id", F.col("text").alias("name"))
    src, out = str(tmp_path / "incoming"), str(tmp_path / "out")
    docs.filter("doc_id < 100").write.parquet(f"{src}/part1")
    stream = spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(src)
    start_scoring(stream, nb, out, ["doc_id"], available_now=True, use_first_token=False).awaitTermination()
    docs.filter("doc_id >= 100 and doc_id < 250").write.parquet(f"{src}/part2")
    start_scoring(stream, nb, out, ["doc_id"], available_now=True, use_first_token=False).awaitTermination()
    result = spark.read.parquet(out)
    assert result.count() == 250 and result.select("doc_id").distinct().count() == 250
    whole = sx.predict_names(docs.filter("doc_id < 250"), nb, ["doc_id"], use_first_token=False)
    assert result.exceptAll(whole).count() == 0


def test_stream_query_reads_tables_that_are_folders(spark, tmp_path):
    for name in ("documents", "labels"):
        tr.table(spark, SF001, name).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    run = catalog.QUERIES["predict_names_stream"]
    got, want = run(spark, str(tmp_path)), run(spark, SF001)
    assert got.count() == want.count() == 200
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_plan_is_map_only_and_pruned(spark, nb_setup):
    _, nb = nb_setup
    plan = _plan(sx.predict_names(tr.doc_texts(spark, SF01), nb, ["doc_id"]))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan  # lang, source, n_chars not read


def test_loader_and_split_filters_reach_the_scan(spark):
    from labelkit.plans import catalog

    load_plan = _plan(catalog.loaded(spark, SF01))
    assert "PushedFilters: [IsNotNull(value), Not(StringContains(value,NOMPL;SEXE))]" in load_plan
    prep = catalog.prepared(spark, SF01)
    test_plan = _plan(prep.test)
    assert "DataFilters: [(pmod(" in test_plan  # the hash split is evaluated inside the parquet scan
