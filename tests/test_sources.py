"""Loader on hand-made files with the edge cases of FIXTURES.md."""

from labelkit.sources import lines as src


def write(tmp_path, name, data: bytes) -> str:
    p = tmp_path / name
    p.write_bytes(data)
    return str(p)


def loaded(spark, path):
    return sorted(tuple(r) for r in src.load_labelled(spark, path).collect())


def test_header_bom_crlf_blank_quoted(spark, tmp_path):
    data = (
        "﻿NOMPL;SEXE\r\n"
        "Mohamed;M\r\n"
        "\r\n"
        "Fatima;F\r\n"
        "NOMPL;SEXE\r\n"
        "\"q;M\";F\r\n"
        "Aicha;F;extra\r\n"
        ";M\r\n"
        "lower;m\r\n"
        "spaced; F\r\n"
        "nodelim\r\n"
    ).encode("utf-8")
    path = write(tmp_path, "names.csv", data)
    assert loaded(spark, path) == [("", "M"), ("Aicha", "F"), ("Fatima", "F"), ("Mohamed", "M")]


def test_empty_file_gives_empty_table(spark, tmp_path):
    path = write(tmp_path, "empty.csv", b"")
    df = src.load_labelled(spark, path)
    assert df.columns == ["name", "gender"]
    assert df.count() == 0


def test_header_only_when_first_line_is_not_header(spark, tmp_path):
    path = write(tmp_path, "h.csv", b"Ali;M\nNOMPL;SEXE\n")
    assert loaded(spark, path) == [("Ali", "M")]


def test_no_header_no_line_lost(spark, tmp_path):
    path = write(tmp_path, "n.csv", b"Zed;F\nAli;M;NOMPL;SEXE\n")
    assert loaded(spark, path) == [("Ali", "M"), ("Zed", "F")]
    path = write(tmp_path, "y.csv", b"NOMPL;SEXE\nAli;M;NOMPL;SEXE\nZed;F\n")
    assert loaded(spark, path) == [("Zed", "F")]


def test_parse_keeps_nulls_until_filter(spark, tmp_path):
    path = write(tmp_path, "p.csv", b"a;M\nb\n")
    parsed = sorted(
        (tuple(r) for r in src.parse_delimited(src.read_lines(spark, path)).collect()), key=lambda t: t[0]
    )
    assert parsed == [("a", "M"), ("b", None)]


def test_custom_separator_and_labels(spark, tmp_path):
    path = write(tmp_path, "s.txt", b"x|user\ny|assistant\nz|system\n")
    df = src.load_labelled(spark, path, sep="|", labels=("user", "assistant"))
    assert sorted(tuple(r) for r in df.collect()) == [("x", "user"), ("y", "assistant")]


def test_write_then_read_lines_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a;M",), ("b;F",)], "value string")
    path = src.write_lines(df, str(tmp_path / "out"))
    assert sorted(r[0] for r in src.read_lines(spark, path).collect()) == ["a;M", "b;F"]


def test_rows_from_values(spark):
    df = src.rows_from_values(spark, ["Mohamed", "Fatima"])
    assert df.columns == ["name"] and df.count() == 2


def test_names_file_end_to_end(spark, tmp_path):
    """The reference app's flow on a names file (lines derived from part)."""
    from labelkit.plans import catalog
    from labelkit.plans.names_file import train_and_evaluate
    from labelkit.sources.lines import write_lines

    path = write_lines(catalog.lines_frame(spark, "/root/testdata/sf0.01"), str(tmp_path / "names"))
    run = train_and_evaluate(spark, path)
    s = run.summary.first()
    assert s["total_names"] == 1272 and s["male_count"] + s["female_count"] == 1272
    assert run.prepared.train.count() + run.prepared.test.count() == 1272
    rows = {r["metric"]: r for r in run.metrics.collect()}
    assert set(rows) == {"Accuracy", "Precision", "Recall", "F1 Score"}
    assert set(run.models) == {"logistic_regression", "naive_bayes"}
    assert not run.loaded


def test_names_file_models_are_loaded_or_trained(spark, tmp_path):
    """Saved models are loaded for the same lines and settings, and trained anew for others."""
    from labelkit.plans.names_file import train_and_evaluate

    lines = spark.createDataFrame([(f"name{k} x;{'M' if k % 3 else 'F'}",) for k in range(200)], "value string")
    models, settings = str(tmp_path / "models"), {"use_idf": False}
    first, again, other = (train_and_evaluate(spark, df, model_dir=models, settings=kw) for df, kw in ((lines, settings), (lines.repartition(3), settings), (lines, {"use_idf": True})))
    assert (first.loaded, again.loaded, other.loaded) == (False, True, False)
    assert sorted(map(tuple, first.metrics.collect())) == sorted(map(tuple, again.metrics.collect()))


def test_names_file_split_spreads_copies(spark):
    """A line repeated for a third of the file is split like any other rows."""
    from pyspark.sql import functions as F

    from labelkit.plans.names_file import prepare_labelled_text

    rows = [("Mohamed", "M")] * 600 + [(f"name{i}", "F" if i % 2 else "M") for i in range(1200)]
    df = spark.createDataFrame(rows, "name string, gender string")
    prep = prepare_labelled_text(df)
    n_train, n_test = prep.train.count(), prep.test.count()
    assert n_train + n_test == 1800
    hot_train = prep.train.filter(F.col("name") == "Mohamed").count()
    hot_test = prep.test.filter(F.col("name") == "Mohamed").count()
    assert hot_train + hot_test == 600
    assert 0.7 < hot_train / 600 < 0.9 and 0.7 < n_train / 1800 < 0.9


def test_names_file_split_does_not_depend_on_layout(spark, monkeypatch):
    from labelkit.plans import names_file

    rows = [("Mohamed", "M")] * 600 + [(f"name{i % 700}", "F" if i % 2 else "M") for i in range(1400)]
    df = spark.createDataFrame(rows, "name string, gender string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = None
    try:
        for parts, size, chunk in ((2, "4k", 10_000), (3, "128m", 7), (8, "64k", 50)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            monkeypatch.setattr(names_file, "COPIES_PER_CHUNK", chunk)
            prep = names_file.prepare_labelled_text(df.repartition(parts))
            got = sorted(tuple(r) for r in prep.train.select("name", "gender", "copy").collect())
            want = want or got
            assert got == want and prep.test.count() == 2000 - len(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_directory_and_gzip_inputs(spark, tmp_path):
    import gzip

    d = tmp_path / "many"
    d.mkdir()
    (d / "a.csv").write_bytes(b"NOMPL;SEXE\nAli;M\n")
    (d / "b.csv.gz").write_bytes(gzip.compress(b"Mariem;F\nbad\n"))
    assert loaded(spark, str(d)) == [("Ali", "M"), ("Mariem", "F")]
    assert loaded(spark, [str(d / "a.csv")]) == [("Ali", "M")]


def test_cli_train_and_predict(spark, tmp_path, capsys):
    """The command line runs in-process on the test session."""
    from labelkit.__main__ import main
    from labelkit.plans import catalog
    from labelkit.sources.lines import write_lines

    names = write_lines(catalog.lines_frame(spark, "/root/testdata/sf0.001"), str(tmp_path / "names"))
    models = str(tmp_path / "models")
    assert main(["train", names, models]) == 0
    assert main(["train", names, models]) == 0  # loads what it saved
    assert main(["predict", models, "Mohamed Ould", "Fatima"]) == 0
    assert main(["compare", models, "Aicha"]) == 0
    out = capsys.readouterr().out
    assert "more_confident_model" in out and "Aicha" in out
    assert "Accuracy" in out and "Mohamed" in out and "Fatima" in out
    docs = "/root/testdata/sf0.001/documents.parquet"
    dest = str(tmp_path / "scored")
    assert main(["predict", models, "--kind", "logistic_regression", "--table", docs, "--text-col", "text",
                 "--key", "doc_id", "--out", dest]) == 0
    assert spark.read.parquet(dest).count() == 200
