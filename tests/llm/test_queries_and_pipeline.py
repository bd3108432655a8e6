"""Registered queries against their SQL, and the pipeline's stages."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelkit.llm import sentencepiece_codec, toxicity
from labelkit.llm.common import documents
from labelkit.llm.queries import ORACLE, QUERIES

from .test_pairs_and_repeats import brute_classes, brute_lines

SF001 = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF001).select(columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_queries_without_sql(spark):
    n = documents(spark, SF001).count()
    assert QUERIES["op6_sentencepiece_codec"](spark, SF001).filter("lossless").count() == n
    assert QUERIES["op9_toxicity"](spark, SF001).filter("score between 0 and 1 and predicted = int(score >= 0.3)").count() == n
    assert QUERIES["op10_quality_rules"](spark, SF001).filter("not (base_failed and kept)").count() == n
    assert QUERIES["op7_exact_search"](spark, SF001).filter("rank = 1").count() == documents(spark, SF001).filter("doc_id % 50 = 0").count()


def one_of_each(rows):
    """(id, text) of the row that stays of each class: the smallest id (null last), then, for equal ids, any one."""
    numbered = [(k, t) for k, (_, t, *_) in enumerate(rows)]
    classes = {}
    for k, size, root in brute_classes(numbered, 5, 80):
        if size:
            classes.setdefault(root, []).append(k)
    kept = [min((rows[k][0] is None, rows[k][0] or 0, k) for k in own)[2] for own in classes.values()]
    kept += [k for k, size, _ in brute_classes(numbered, 5, 80) if not size]
    return [(rows[k][0], rows[k][1] or "") for k in kept]


def test_pipeline_stages(spark, docs, rows, tmp_path):
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    marks = [(k, int(k % 2)) for k in range(60)]
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_copies", "source_mix", "sentencepiece"]
    columns = docs.columns
    lines = corpus_pipeline.drop_lines(spark, docs, sf)
    assert lines.columns == columns
    assert sorted([(r.doc_id, r.text or "") for r in lines.collect()], key=str) == sorted([(r[0], r[3]) for r in brute_lines(rows)], key=str)
    assert lines.filter(~F.col("n_chars").eqNullSafe(F.length("text"))).count() == 0
    alone = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert alone.columns == columns and sorted([(r.doc_id, r.text or "") for r in alone.collect()], key=str) == sorted(one_of_each(rows), key=str)
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().filter("count > 4").count() == 0
    coded = corpus_pipeline.to_pieces(spark, docs, sf)
    assert coded.filter("lossless").count() == len(rows)


def test_pieces_are_made_by_one_python_step_at_a_time(spark, docs):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "64m")
        coded = dict(corpus_pipeline.STAGES)["sentencepiece"](spark, docs, SF001)
        assert int(spark.conf.get(limit)) == corpus_pipeline.STAGE_BATCH_BYTES
        # A task of both steps has two workers with a model each.
        assert coded._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
        want = sentencepiece_codec.encode(docs.select("doc_id", "text"))
        assert sorted((r.doc_id, r.ids) for r in coded.filter("doc_id is not null").collect()) == sorted((r.doc_id, r.ids) for r in want.filter("doc_id is not null").collect())
        spark.conf.set(limit, "4096")
        corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
        assert spark.conf.get(limit) == "4096"
    finally:
        spark.conf.set(limit, before)


def test_pipeline_drops_what_the_score_rejects(spark):
    docs = documents(spark, SF001)
    kept = corpus_pipeline.drop_toxic(spark, docs, SF001)
    lexicon = toxicity.fit(docs, toxicity.training_labels(spark.read.parquet(f"{SF001}/labels.parquet")))
    clean = toxicity.score(docs, lexicon).filter("score < 0.3")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in clean.collect())


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.count() > 0 and out.filter("not lossless").count() == 0


def test_pipeline_on_empty_tables(spark, empty, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_entry_without_the_subpackage(tmp_path):
    """A copy of the repository without both folders and the pipeline has the other queries only."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = tmp_path / "copy"
    shutil.copytree(here, copy, ignore=lambda d, names: [n for n in names if n in ("llm", ".git", "corpus_pipeline.py", "__pycache__")])
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') and n[2:3].isdigit() for n in q), set(e.oracle_sql()) <= set(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    n, *rest = said.stdout.split()
    assert rest == ["False", "False", "True"] and int(n) > 50, said.stderr
    import __spark_entry__

    assert len(__spark_entry__.queries()) == int(n) + len(QUERIES) + 1
    assert "except" not in open(os.path.join(here, "__spark_entry__.py")).read()
