"""Command line: the reference app's flow without the web page.

    python -m labelkit train NAMES_FILE MODEL_DIR [--master local[8]]
    python -m labelkit predict MODEL_DIR NAME [NAME ...]
    python -m labelkit predict MODEL_DIR --table PARQUET --text-col text --key doc_id --out OUT_DIR
    python -m labelkit compare MODEL_DIR NAME [NAME ...]

``train`` loads the file, prints the summary and the metrics table of both
models, and saves them (whole pipelines) under MODEL_DIR; models saved there
from the same rows are loaded instead.  ``predict`` scores names given on the
command line (one small table) or a whole parquet table, written as parquet
(nothing table-sized comes to the driver).  ``compare`` shows both models'
answers for given names.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from labelkit.operators import compare as cx
from labelkit.operators import models as mx
from labelkit.operators import score as sx
from labelkit.sources.lines import rows_from_values


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("labelkit").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m labelkit")
    p.add_argument("--master", default=None, help="Spark master (default: the session's)")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("names_file")
    t.add_argument("model_dir")
    q = sub.add_parser("predict")
    q.add_argument("model_dir")
    q.add_argument("names", nargs="*")
    q.add_argument("--kind", default="naive_bayes", choices=mx.KINDS)
    q.add_argument("--table")
    q.add_argument("--text-col", default="name")
    q.add_argument("--key", action="append", default=[])
    q.add_argument("--out")
    c = sub.add_parser("compare")
    c.add_argument("model_dir")
    c.add_argument("names", nargs="+")
    args = p.parse_args(argv)
    spark = _session(args.master)

    if args.cmd == "train":
        from labelkit.plans.names_file import train_and_evaluate

        run = train_and_evaluate(spark, args.names_file, model_dir=args.model_dir)
        run.summary.show(truncate=False)
        run.metrics.show(truncate=False)
        run.prepared.release()
        return 0

    def load(kind):
        return mx.load_model(spark, kind, f"{args.model_dir.rstrip('/')}/{kind}/model")

    if args.cmd == "compare":
        both = cx.compare_predictions(rows_from_values(spark, args.names), *(load(k) for k in mx.KINDS))
        shown = [F.round(c, 3).alias(c) if c.endswith("_confidence") else F.col(c) for c in both.columns]
        both.select(*shown).show(truncate=False)
        return 0

    model = load(args.kind)
    if args.table:
        if not args.out:
            p.error("--table needs --out")
        df = spark.read.parquet(args.table)
        out = sx.predict_names(df, model, args.key, args.text_col)
        out.write.mode("overwrite").parquet(args.out)
        return 0
    if not args.names:
        p.error("give names or --table")
    out = sx.predict_names(rows_from_values(spark, args.names), model)
    out.select("name", "predicted_label", F.round(F.col("confidence") * 100, 1).alias("confidence_pct")).show(
        truncate=False
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
