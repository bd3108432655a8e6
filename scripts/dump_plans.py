"""Write the physical plans of the main queries to PLANS.md.

    python scripts/dump_plans.py [sf_dir]

Fits run eagerly while the query is built; the plan shown is the lazy part
that the caller executes (scoring, aggregation, ...).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelkit.operators import features as fx  # noqa: E402
from labelkit.plans import catalog  # noqa: E402
from labelkit.plans import training as tr  # noqa: E402
from labelkit.session import local_session  # noqa: E402

KEYS = {
    "load_labelled": "one codegen stage; header/label filters pushed to the text scan; each line split once",
    "data_summary": "one partial + final aggregate; length computed once per row",
    "length_histogram": "after the one-row stats pass: length once per row, bins by expression, partial count per (bin, label)",
    "hashed_tf": "small scan spread round-robin (bounded), then one projection of the feature chain and an explode",
    "evaluate_model": "split filter pushed into the parquet scan of the materialized features; one partial aggregate of per-class counts, one exchange",
    "predict_names": "scan -> one codegen stage (first word, features, model, decode); no exchange",
    "compare_predictions": "both models in one projection over one feature chain; no exchange, no join",
    "compare_metrics": "one scan of the test rows and one aggregate of per-class counts for both models; the pivot after it moves 8 rows",
    "sample_rows": "TakeOrderedAndProject: per-task top-k, no full sort",
}


def plan_text(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    text = buf.getvalue()
    text = re.sub(r"file:/\S+", "<path>", text)
    text = re.sub(r"#\d+L?", "", text)
    return text.strip()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, "labelkit-plans")
    out = ["# Physical plans", "", f"Generated by `scripts/dump_plans.py` on `{sf_dir}` (local[8]).", ""]
    texts, labels = tr.doc_texts(spark, sf_dir), tr.doc_labels(spark, sf_dir)
    stages = fx.feature_stages()
    extra = [
        ("labelled features, label side within the broadcast bound", tr.labelled_features(texts, labels, ["doc_id"], stages)),
        (
            "labelled features, label side above the bound (tokenize first, then join vectors)",
            tr.labelled_features(texts, labels, ["doc_id"], stages, broadcast_max_bytes=0),
        ),
    ]
    sc = spark.sparkContext
    counts = []
    for key in KEYS:
        # Build and run the query in its own job group: Spark's status tracker
        # then tells how many jobs and stages it took, fits included.
        sc.setJobGroup(f"plans-{key}", key)
        catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        jobs = sc.statusTracker().getJobIdsForGroup(f"plans-{key}")
        stages = sum(len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs if sc.statusTracker().getJobInfo(j))
        counts.append(f"| {key} | {len(jobs)} | {stages} |")
    sc.setJobGroup("plans", "plans")
    out += [
        "## Jobs and stages per query",
        "",
        "Counted with Spark's status tracker (each query in its own job group, run to the `noop` sink),",
        "including the model fits a query performs. Adaptive execution runs each shuffle stage as its",
        "own job, and skipped stages are included in the stage count.",
        "",
        "| query | jobs | stages |",
        "| --- | --- | --- |",
        *counts,
        "",
    ]
    for key, note in KEYS.items():
        out += [f"## {key}", "", f"What to look for: {note}.", "", "```", plan_text(catalog.QUERIES[key](spark, sf_dir)), "```", ""]
    for title, df in extra:
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
