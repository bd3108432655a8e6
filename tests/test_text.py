"""Column functions and the feature chain on edge values (expected values are
the reference pipeline's own outputs on Spark, see FIXTURES.md section 4)."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StopWordsRemover

from labelkit.functions import text as tx
from labelkit.operators import features as fx
from labelkit.plans import oracle

EDGES = [
    # input, clean, tokens, filtered, non-zero buckets
    ("", "", [""], [""], [12]),
    ("   ", "   ", [], [], []),
    (" ali", " ali", ["", "ali"], ["", "ali"], [12, 15]),
    ("a  b", "a  b", ["a", "", "b"], ["", "b"], [5, 12]),
    ("Mohamed Ould", "mohamed ould", ["mohamed", "ould"], ["mohamed", "ould"], [3, 18]),
    ("José", "jos", ["jos"], ["jos"], [18]),
    ("محمد", "", [""], [""], [12]),
    ("Will Don Can", "will don can", ["will", "don", "can"], [], []),
    ("Jean-Pierre", "jeanpierre", ["jeanpierre"], ["jeanpierre"], [14]),
    ("Mariem Mint Sidi", "mariem mint sidi", ["mariem", "mint", "sidi"], ["mariem", "mint", "sidi"], [10, 13, 15]),
    ("O'Neil", "oneil", ["oneil"], ["oneil"], [10]),
]


def test_feature_chain_edges(spark):
    df = spark.createDataFrame([(i, e[0]) for i, e in enumerate(EDGES)], "id int, name string")
    out = PipelineModel(fx.feature_stages()).transform(df).orderBy("id").collect()
    for row, (inp, clean, toks, filt, buckets) in zip(out, EDGES):
        assert row["clean_name"] == clean, inp
        assert list(row["name_tokens"]) == toks, inp
        assert list(row["filtered_tokens"]) == filt, inp
        assert sorted(row["raw_features"].indices.tolist()) == buckets, inp
        assert row["raw_features"].size == 20


def test_term_counts_not_binary(spark):
    df = spark.createDataFrame([("ali ali x",)], "name string")
    v = PipelineModel(fx.feature_stages()).transform(df).first()["raw_features"]
    assert v[15] == 2.0 and v[2] == 1.0 and v.values.sum() == 3.0


def py_first_token(s):
    parts = s.strip().split()
    return parts[0] if parts else s


def test_first_token_matches_python_rule(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", "Z", "é", " ", "\t", "\n", " ", " ", "　", "\x1c", "-", "'"]
    samples = ["  Ali  Baba ", "   ", "", "Ali", " Ali Baba"]
    samples += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "id int, s string")
    got = {r["id"]: r["f"] for r in df.select("id", tx.first_token("s").alias("f")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == py_first_token(s), repr(s)


def test_clean_length_and_display(spark):
    df = spark.createDataFrame([("José Ü", "F", 0.98765), ("a\tb", "M", 0.5)], "n string, g string, c double")
    rows = df.select(
        tx.clean_text("n").alias("c"),
        tx.text_length("n").alias("l"),
        tx.label_display("g").alias("d"),
        tx.confidence_pct("c").alias("p"),
    ).collect()
    assert [tuple(r) for r in rows] == [("jos ", 6, "Female", 98.8), ("ab", 3, "Male", 50.0)]


def test_array_item_is_null_safe_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", None, "True")
    df = spark.createDataFrame([("x",), ("a;b;c",), ("a;",)], "v string")
    arr = tx.split_fields("v")
    got = [tuple(r) for r in df.select(tx.array_item(arr, 0), tx.array_item(arr, 1)).collect()]
    assert got == [("x", None), ("a", "b"), ("a", "")]


def test_stop_words_fixed_list_equals_spark_default(spark):
    assert list(oracle.STOP_WORDS) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_custom_stop_words_and_width(spark):
    df = spark.createDataFrame([("ali bob",)], "name string")
    stages = fx.feature_stages(num_features=1 << 18, stop_words=["bob"])
    row = PipelineModel(stages).transform(df).first()
    assert list(row["filtered_tokens"]) == ["ali"]
    assert row["raw_features"].size == 1 << 18


@pytest.mark.parametrize("token,bucket", [("ali", 15), ("mohamed", 3), ("fatima", 4), ("abcd", 0), ("abcdefgh", 5), ("", 12), ("x", 2)])
def test_bucket_check_values(spark, token, bucket):
    df = spark.createDataFrame([([token],)], "filtered_tokens array<string>")
    v = fx.hashing_tf().transform(df).first()["raw_features"]
    assert v.indices.tolist() == [bucket]


def test_vector_entries_explode(spark):
    df = spark.createDataFrame([(1, "ali ali x")], "doc_id int, name string")
    feats = PipelineModel(fx.feature_stages()).transform(df)
    got = sorted(tuple(r) for r in fx.explode_vector(feats, ["doc_id"], "raw_features").collect())
    assert got == [(1, 2, 1.0), (1, 15, 2.0)]


def test_label_index_from_counts_equals_fitted_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    rows = [("b",)] * 3 + [("a",)] * 3 + [("c",)] * 5 + [("d",)]
    df = spark.createDataFrame(rows, "gender string")
    fitted = StringIndexer(inputCol="gender", outputCol="label", stringOrderType="frequencyDesc").fit(df)
    counts = [(r[0], r[1]) for r in df.groupBy("gender").count().collect()]
    assert list(fx.label_index_from_counts(counts).labels) == list(fitted.labels) == ["c", "a", "b", "d"]
