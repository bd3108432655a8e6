"""Table summaries: counts, label shares, length statistics and histograms.

The reference copied the whole table into pandas on the driver to compute
six numbers.  Everything here is a Spark aggregate: partial aggregation in
every task, a final merge of at most a few rows per group, nothing
table-sized on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.functions.text import LABELS, text_length
from labelkit.operators.models import materialize

# Reference names of the per-label counts (fixed values).
LABEL_COUNT_NAMES = {"M": "male_count", "F": "female_count"}


def count_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_names"))


def count_by_label(df: DataFrame, label_col: str = "gender", labels: Sequence[str] = LABELS) -> DataFrame:
    """``(label, n)`` for every expected label, 0 when absent: one pass, no join."""
    counts = df.agg(*[F.count_if(F.col(label_col) == F.lit(v)).alias(f"n{i}") for i, v in enumerate(labels)])
    rows = F.array(*[F.struct(F.lit(v).alias("label"), F.col(f"n{i}").alias("n")) for i, v in enumerate(labels)])
    return counts.select(F.explode(rows).alias("r")).select("r.label", "r.n")


def length_stats(df: DataFrame, name_col: str = "name") -> DataFrame:
    n = F.col("_n")
    return df.select(text_length(name_col).alias("_n")).agg(
        F.avg(n).alias("avg_name_length"), F.min(n).alias("min_name_length"), F.max(n).alias("max_name_length")
    )


def data_summary(
    df: DataFrame,
    name_col: str = "name",
    label_col: str = "gender",
    label_names: dict[str, str] | None = None,
) -> DataFrame:
    """``total_names, male_count, female_count, avg/min/max_name_length`` in one aggregate."""
    label_names = LABEL_COUNT_NAMES if label_names is None else label_names
    n = F.col("_n")  # length computed once per row, read by three aggregates
    return df.select(text_length(name_col).alias("_n"), F.col(label_col).alias("_l")).agg(
        F.count(F.lit(1)).alias("total_names"),
        *[F.count_if(F.col("_l") == F.lit(v)).alias(name) for v, name in label_names.items()],
        F.avg(n).alias("avg_name_length"),
        F.min(n).alias("min_name_length"),
        F.max(n).alias("max_name_length"),
    )


def label_share(df: DataFrame, label_col: str = "gender", labels: Sequence[str] = LABELS) -> DataFrame:
    """``(label, n, share_pct)``: percent of the listed labels, one decimal."""
    aggs = [F.count_if(F.col(label_col) == F.lit(v)).alias(f"n{i}") for i, v in enumerate(labels)]
    counts = df.agg(*aggs)
    total = sum((F.col(f"n{i}") for i in range(len(labels))), F.lit(0))
    share = lambda i: F.when(total > 0, F.round(F.col(f"n{i}") * 100.0 / total, 1))
    rows = F.array(
        *[
            F.struct(F.lit(v).alias("label"), F.col(f"n{i}").alias("n"), share(i).alias("share_pct"))
            for i, v in enumerate(labels)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.label", "r.n", "r.share_pct")


def length_distribution(df: DataFrame, name_col: str = "name", label_col: str = "gender") -> DataFrame:
    """``(name_length, label, n)``: the data behind a stacked length chart."""
    return df.groupBy(text_length(name_col).alias("name_length"), F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def auto_bins(n: int, lo: float, hi: float, q1: float, q3: float, integer: bool = True) -> tuple[int, float, float]:
    """NumPy's ``bins='auto'`` rule on summary numbers: ``(bins, first, last)``.

    width = min(max(Freedman-Diaconis, sqrt-rule/2), Sturges), at least 1 for
    integer data; an empty range is widened to +-0.5 and gets one bin.
    """
    ptp = hi - lo
    fd = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    sturges = ptp / (math.log2(n) + 1.0)
    sq = ptp / math.sqrt(n)
    width = min(max(fd, sq / 2.0), sturges)
    first, last = float(lo), float(hi)
    if first == last:
        first, last = first - 0.5, last + 0.5
    if not width:
        return 1, first, last
    if integer and width < 1:
        width = 1.0
    return max(int(math.ceil((last - first) / width)), 1), first, last


def length_histogram(df: DataFrame, name_col: str = "name", label_col: str = "gender") -> DataFrame:
    """``(bin, bin_start, bin_end, label, n)`` with bins shared by all labels.

    The text is read once: ``length_distribution`` (a row per length and label,
    combined in every task) is written to the shared folder, and count, range,
    exact quartiles and bins all come from that small table.  Five numbers
    reach the driver, which derives the bin edges.  Bins and edges follow
    NumPy's histogram (right edge of the last bin is closed).
    """
    lens = materialize(length_distribution(df, name_col, label_col), "length-distribution")
    lens = lens.select(F.col("name_length").alias("_n"), "label", F.col("n").alias("_count")).filter("_n is not null")
    stats = lens.agg(
        F.sum("_count").alias("n"),
        F.min("_n").alias("lo"),
        F.max("_n").alias("hi"),
        F.percentile("_n", [0.25, 0.75], F.col("_count")).alias("q"),
    ).first()
    schema = "bin int, bin_start double, bin_end double, label string, n bigint"
    if stats is None or not stats["n"]:
        return df.sparkSession.createDataFrame([], schema)
    bins, first, last = auto_bins(stats["n"], stats["lo"], stats["hi"], stats["q"][0], stats["q"][1])
    step = (last - first) / bins

    def edge(i):
        # NumPy's linspace: i*step + first, and the last edge is exactly `last`.
        return F.when(i >= F.lit(bins), F.lit(last)).otherwise(i.cast("double") * F.lit(step) + F.lit(first))

    x, g = F.col("_x"), F.col("_g")
    guess = lens.select(
        "label", "_count", F.col("_n").cast("double").alias("_x")
    ).select(
        "label", "_count", "_x", F.least(F.floor((x - F.lit(first)) * F.lit(bins / (last - first))).cast("int"), F.lit(bins - 1)).alias("_g")
    )
    # NumPy's corrections against the edges it actually uses.
    guess = guess.select("label", "_count", "_x", F.when(x < edge(g), g - 1).otherwise(g).alias("_g"))
    binned = guess.select(
        "label", "_count", F.when((x >= edge(g + 1)) & (g != F.lit(bins - 1)), g + 1).otherwise(g).alias("bin")
    )
    counts = binned.groupBy("bin", "label").agg(F.sum("_count").alias("n"))
    return counts.select(
        "bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"), "label", "n"
    )
