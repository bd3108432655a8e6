"""Summaries against brute force in pandas / NumPy on the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from labelkit.operators import limits as lx
from labelkit.operators import summary as su
from labelkit.plans import catalog
from labelkit.plans import training as tr


def numpy_hist(lengths, labels):
    lengths = np.asarray(lengths, dtype=np.int64)
    edges = np.histogram_bin_edges(lengths, bins="auto")
    out = {}
    for lab in sorted(set(labels)):
        counts, _ = np.histogram(lengths[np.asarray(labels) == lab], bins=edges)
        for i, c in enumerate(counts):
            if c:
                out[(i, lab)] = (float(edges[i]), float(edges[i + 1]), int(c))
    return out


def spark_hist(df):
    return {(r["bin"], r["label"]): (r["bin_start"], r["bin_end"], r["n"]) for r in su.length_histogram(df).collect()}


@pytest.mark.parametrize("which", ["roles", "parts", "docs"])
def test_histogram_equals_numpy(spark, which):
    if which == "roles":
        df = tr.role_text(spark, SF01)
    elif which == "parts":
        df = catalog.loaded(spark, SF01)
    else:
        df = tr.labelled_docs(spark, SF01)
    pdf = df.select(F.length("name").alias("l"), F.col("gender").alias("g")).toPandas()
    assert spark_hist(df) == numpy_hist(pdf["l"].tolist(), pdf["g"].tolist())


def test_histogram_edge_shapes(spark):
    rng = np.random.default_rng(3)
    for values in ([5, 5, 5], [1, 2], list(rng.integers(0, 1000, 333)), list(rng.integers(0, 3, 50)), [0, 10**5]):
        labels = ["M" if i % 3 else "F" for i in range(len(values))]
        df = spark.createDataFrame([("x" * int(v), lab) for v, lab in zip(values, labels)], "name string, gender string")
        assert spark_hist(df) == numpy_hist(values, labels), values


def test_histogram_empty(spark):
    df = spark.createDataFrame([], "name string, gender string")
    assert su.length_histogram(df).count() == 0


def test_data_summary_equals_pandas(spark):
    df = catalog.loaded(spark, SF01)
    pdf = df.toPandas()
    lens = pdf["name"].map(len)
    row = su.data_summary(df).first()
    vc = pdf["gender"].value_counts()
    assert row["total_names"] == len(pdf)
    assert row["male_count"] == vc.get("M", 0) and row["female_count"] == vc.get("F", 0)
    assert row["avg_name_length"] == pytest.approx(lens.mean())
    assert (row["min_name_length"], row["max_name_length"]) == (lens.min(), lens.max())


def test_counts_with_missing_label(spark):
    df = spark.createDataFrame([("a", "M"), ("bb", "M")], "name string, gender string")
    assert sorted(tuple(r) for r in su.count_by_label(df).collect()) == [("F", 0), ("M", 2)]
    assert sorted(tuple(r) for r in su.label_share(df).collect()) == [("F", 0, 0.0), ("M", 2, 100.0)]
    empty = df.limit(0)
    assert sorted(tuple(r) for r in su.label_share(empty).collect()) == [("F", 0, None), ("M", 0, None)]
    assert su.count_total(df).first()[0] == 2


def test_length_distribution(spark):
    df = spark.createDataFrame([("ab", "M"), ("cd", "M"), ("e", "F")], "name string, gender string")
    got = sorted(tuple(r) for r in su.length_distribution(df).collect())
    assert got == [(1, "F", 1), (2, "M", 2)]


def test_limits_are_ordered(spark):
    df = spark.createDataFrame(pd.DataFrame({"name": list("zyxwvutsrqponm"), "gender": ["M"] * 14}))
    assert [r[0] for r in lx.sample_rows(df, ["name"], 3).collect()] == ["m", "n", "o"]
    assert lx.first_row(df).first()[0] == "m"


def test_histogram_reads_the_text_once(spark, monkeypatch):
    reads = []
    real = su.materialize
    monkeypatch.setattr(su, "materialize", lambda df, name: (reads.append(df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1])
    plan = su.length_histogram(tr.role_text(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert [r.count("FileScan") for r in reads] == [1] and "text" in reads[0]
    assert "conversations" not in plan and plan.count("FileScan") == 1  # lengths and counts only
