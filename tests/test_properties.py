"""Property tests: the SQL used by the checks agrees with Spark ML on random
inputs (tokens, hash buckets), and plan-level helpers behave as documented."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel

from labelkit.operators import compare as cx
from labelkit.operators import features as fx
from labelkit.plans import oracle
from labelkit.plans import training as tr

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def java_split_tokens(clean: str) -> list[str]:
    """``clean.split("\\s")`` in Java: trailing empty strings removed."""
    if clean == "":
        return [""]  # no separator found: the input itself
    parts = clean.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


texts = st.lists(st.text(alphabet="abcAB é-'\t\n", max_size=12), min_size=1, max_size=40)


@SETTINGS
@given(texts)
def test_tokens_spark_python_and_sql_agree(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, name string")
    rows = PipelineModel(fx.feature_stages()[:3]).transform(df).orderBy("id").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t(id INTEGER, name VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(xs)))
    toks_sql = oracle.tokens_list_sql(oracle.clean_sql("name"))
    sql = f"SELECT id, {oracle.clean_sql('name')}, {toks_sql}, {oracle.filtered_list_sql(toks_sql)} FROM t ORDER BY id"
    for r, (_, clean, toks, filt) in zip(rows, con.execute(sql).fetchall()):
        assert r["clean_name"] == clean
        assert list(r["name_tokens"]) == toks == java_split_tokens(clean)
        assert list(r["filtered_tokens"]) == filt


@SETTINGS
@given(st.lists(st.text(alphabet="abcdefghijklmnopqrstuvwxyz", max_size=23), min_size=1, max_size=60, unique=True),
       st.sampled_from([20, 7, 1 << 18]))
def test_sql_murmur3_equals_hashing_tf(spark, tokens, width):
    df = spark.createDataFrame([([t],) for t in tokens], "filtered_tokens array<string>")
    got = {r[0][0]: int(r[1].indices[0]) for r in fx.hashing_tf(num_features=width).transform(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE v(t VARCHAR)")
    con.executemany("INSERT INTO v VALUES (?)", [(t,) for t in tokens])
    sql = f"WITH {oracle.hash_ctes('v', width, 'hh')} SELECT t, bucket FROM hh"
    assert dict(con.execute(sql).fetchall()) == got


def test_first_token_sql_equals_spark(spark):
    samples = ["  Ali  Baba ", "   ", "", "Ali", "\tX\nY", "a b", "　z w"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "id int, s string")
    from labelkit.functions.text import first_token

    spark_out = [r[0] for r in df.orderBy("id").select(first_token("s")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(id INTEGER, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(samples)))
    sql_out = [r[0] for r in con.execute(f"SELECT {oracle.first_token_sql('s')} FROM t ORDER BY id").fetchall()]
    assert spark_out == sql_out


def test_spread_only_small_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    small = spark.range(0, 100, numPartitions=1)
    assert tr.is_small_scan(small)
    assert tr.spread(small).rdd.getNumPartitions() == cores
    big = spark.range(0, 100, numPartitions=cores * 4)
    assert not tr.is_small_scan(big)
    assert tr.spread(big) is big
    half = spark.range(0, 100, numPartitions=cores // 2 + 1)
    assert not tr.is_small_scan(half)  # less than a 2x gain: leave it
    assert tr._bytes("134217728b") == 128 << 20 and tr._bytes("64m") == 64 << 20 and tr._bytes("1g") == 1 << 30


def test_compare_with_different_feature_chains(spark, nb_setup):
    from pyspark.sql import functions as F

    from labelkit.operators import models as mx
    from labelkit.operators import score as sx

    prep, nb = nb_setup
    other = mx.train_naive_bayes(tr.labelled_docs(spark, "/root/testdata/sf0.001"), num_features=32, stop_words=["x"])
    assert not mx.same_features(nb, other)
    docs = tr.doc_texts(spark, "/root/testdata/sf0.01")
    cmp = cx.compare_predictions(docs, nb, other, ["doc_id"], names=("a", "b"))
    assert "Exchange" not in cmp._jdf.queryExecution().executedPlan().toString()
    sep_b = sx.predict_names(docs, other, ["doc_id"]).select(
        "doc_id", F.col("predicted_label").alias("b_label"), F.col("confidence").alias("b_confidence")
    )
    assert cmp.select("doc_id", "b_label", "b_confidence").exceptAll(sep_b).count() == 0
    assert cmp.count() == 1000


def test_shared_dir_is_set(spark):
    from labelkit.session import scratch_path, shared_dir

    root = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def python_metrics(cm):
    """Weighted metrics exactly as MulticlassMetrics defines them."""
    labels = {l for l, _, _ in cm}
    sup = {c: sum(n for l, _, n in cm if l == c) for c in labels}
    total = sum(sup.values())
    tp = {c: sum(n for l, p, n in cm if l == c and p == c) for c in labels}
    pp = {c: sum(n for _, p, n in cm if p == c) for c in labels}
    prec = {c: tp[c] / pp[c] if pp[c] else 0.0 for c in labels}
    rec = {c: tp[c] / sup[c] for c in labels}
    f1 = {c: 2 * prec[c] * rec[c] / (prec[c] + rec[c]) if prec[c] + rec[c] else 0.0 for c in labels}
    return (
        sum(tp.values()) / total,
        sum(prec[c] * sup[c] for c in labels) / total,
        sum(rec[c] * sup[c] for c in labels) / total,
        sum(f1[c] * sup[c] for c in labels) / total,
    )


cells = st.dictionaries(
    st.tuples(st.integers(0, 3), st.integers(0, 3)), st.integers(1, 1000), min_size=1, max_size=16
)


@SETTINGS
@given(cells)
def test_metrics_equal_python_definition(spark, table):
    from labelkit.operators import evaluate as ev

    cm = [(float(l), float(p), n) for (l, p), n in table.items()]
    df = spark.createDataFrame(cm, "label double, prediction double, n long")
    row = ev.metrics_from_confusion(df).first()
    for got, want in zip((row["accuracy"], row["precision"], row["recall"], row["f1"]), python_metrics(cm)):
        assert abs(got - want) < 1e-12


small_cells = st.dictionaries(
    st.tuples(st.integers(0, 3), st.integers(0, 3)), st.integers(1, 30), min_size=1, max_size=16
)


@SETTINGS
@given(small_cells)
def test_evaluation_equals_python_definition(spark, table):
    from labelkit.operators import evaluate as ev

    rows = [(float(l), float(p)) for (l, p), n in table.items() for _ in range(n)]
    scored = spark.createDataFrame(rows, "label double, prediction double")
    a = ev.evaluate(scored).first()
    want = python_metrics([(float(l), float(p), n) for (l, p), n in table.items()])
    for k, w in zip(ev.METRICS, want):
        assert abs(a[k] - w) < 1e-12


class _FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _FakeContext:
    def __init__(self, master, conf=None, ckpt=None):
        self.master, self._conf, self._ckpt = master, _FakeConf(conf or {}), ckpt

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _FakeSession:
    def __init__(self, sc):
        self.sparkContext = sc


def test_shared_dir_never_local_on_a_cluster():
    from labelkit.session import shared_dir

    with __import__("pytest").raises(RuntimeError):
        shared_dir(_FakeSession(_FakeContext("yarn")))
    assert shared_dir(_FakeSession(_FakeContext("yarn", {"spark.checkpoint.dir": "hdfs:///ckpt"}))) == "hdfs:///ckpt"
    sc = _FakeContext("k8s://x", ckpt="s3a://bucket/ckpt/app-123")
    assert shared_dir(_FakeSession(sc)) == "s3a://bucket/ckpt"
