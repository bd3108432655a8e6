"""Mixing sources to target weights: Efraimidis-Spirakis sampling with whole epochs first. DataFrame functions only.

Sources, by code point with null last, have the weights given, in turn.  They
share ``share`` times all words by weight; none gets more than ``cap`` times its
own words, and what it leaves is shared again among the others, by weight.

A source's target is taken as whole epochs of all its documents first, then a
part of one: documents in the order of -ln(u) / quality, u a keyed hash of the
document's id, until the target is met.  The document that crosses it is taken
if that comes nearer to the target.  Documents are taken whole.

The order is never sorted as a whole.  Documents go to key ranges of some
thousand rows, whose sums give the range in which each source's target lies;
rows are sorted within ranges, so a source with a third of all rows is spread
over as many tasks as its size asks for.  What is left is one border per source:
taking is a comparison with it, in a map over the documents.  Tables of sources
are broadcast up to ``MAX_BROADCAST_SOURCES`` rows; beyond, they are joined.

Quality: a document's weight is 1 less five times its share of the characters
``#*$%&|<>``, at least 0.05.

Defined results: a null text has size 0; a document of size 0 is never taken;
null ids have one key; rows equal in id and text share one place in the order
(they are taken or left together).  Sources without words have target 0.
Extra columns pass through; columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelkit.llm.common import fresh, lookup, without, written

WEIGHTS, SHARE, CAP, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, 17
RANGE_ROWS = 4096
MAX_BROADCAST_SOURCES = 100_000
SYMBOLS = "#*$%&|<>"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality(text: str) -> Column:
    size = F.length(text)
    symbols = size - F.length(F.translate(F.col(text), SYMBOLS, ""))
    return F.coalesce(F.greatest(F.lit(0.05), 1.0 - 5.0 * symbols / F.greatest(size, F.lit(1))), F.lit(0.05))


def order_key(id_col: str, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, u from the first 52 bits of an md5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(u) / weight


def _sources(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source: key, n, words, mean weight, target.  Windows run over sources, not documents."""
    per = sizes.groupBy("key", "name").agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.avg("weight").alias("mean"))
    by_name = Window.orderBy(F.col("name").asc_nulls_last())
    rank = F.row_number().over(by_name)
    per = per.withColumn("rank", rank).withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    # Sources that reach their cap come first in the order of cap / weight; the level of the others is the
    # largest of what is left, per weight left, at any place in this order.
    per = per.withColumn("most", cap * F.col("words"))
    order = Window.orderBy(F.col("most") / F.col("w"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    zero = F.lit(0.0)
    level = (share * F.sum("words").over(whole) - F.coalesce(F.sum("most").over(before), zero)) / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), zero))
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max("level").over(whole))
    return per.withColumn("target", F.least("most", F.col("level") * F.col("w"))).select("key", "n", "words", "mean", "target")


def _with_sources(rows: DataFrame, sources: DataFrame, columns: Sequence[str], many: bool, total: int) -> DataFrame:
    found = sources.select("key", "n", *columns)
    return lookup(rows, found.withColumn("_n", F.col("n")), "key", "_n", total) if many else rows.join(F.broadcast(found), "key")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target (of the source) and taken (words, repeats counted) for each row."""
    if not 0 <= share <= cap:
        raise ValueError("share must be between 0 and cap")
    key = F.when(F.col(source_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source_col)))
    measured = docs.select(
        F.col(id_col).cast("string").alias("id"), key.alias("key"), F.col(source_col).alias("name"), word_count(text_col).alias("size"), quality(text_col).alias("weight"),
        order_key(id_col, quality(text_col), seed).alias("at"), F.xxhash64(text_col).alias("tie"),
    )
    sizes = written(measured, "mix-sizes")
    sources = written(_sources(sizes, weights, share, cap), "mix-sources")
    total, many = sizes.count(), sources.count() > MAX_BROADCAST_SOURCES

    rows = _with_sources(sizes.select("id", "key", "size", "weight", "at", "tie"), sources, ["words", "mean", "target"], many, total)
    epochs = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0)
    rows = rows.withColumn("part", F.col("target") - epochs * F.col("words")).filter("part > 0 and size > 0")
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    rows = rows.withColumn("range", F.floor((1.0 - F.exp(-F.col("at") * F.col("mean"))) * ranges).cast("long")).select("id", "key", "range", "at", "tie", "size", "part")
    # Rows equal in id and text have one place together.
    rows = rows.groupBy("key", "range", "at", "id", "tie", "part").agg(F.sum("size").alias("size"))
    sums = rows.groupBy("key", "range").agg(F.sum("size").alias("sum"))
    sums = sums.withColumn("before", F.sum("sum").over(Window.partitionBy("key").orderBy("range")) - F.col("sum")).drop("sum")
    within = Window.partitionBy("key", "range").orderBy("at", "id", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(sums.filter("before >= 0"), ["key", "range"]).filter("before < part").withColumn("before", F.col("before") + F.sum("size").over(within) - F.col("size"))
    border = placed.filter("part - before >= size / 2").groupBy("key").agg(F.max(F.struct("at", "id", "tie")).alias("border"))
    sources = written(sources.join(border, "key", "left"), "mix-borders")

    own, at, n, words, target, border = fresh(docs, "_key", "_at", "_n", "_words", "_target", "_border")
    place = F.struct(order_key(id_col, quality(text_col), seed).alias("at"), F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("tie"))
    marked = docs.withColumns({own: key, at: place})
    found = sources.select(F.col("key").alias(own), F.col("n").alias(n), F.col("words").alias(words), F.col("target").alias(target), F.col("border").alias(border))
    joined = lookup(marked, found, own, n, total) if many else marked.join(F.broadcast(found.drop(n)), own)
    times = F.when(F.col(words) > 0, F.floor(F.col(target) / F.col(words))).otherwise(0) + F.when(F.col(at) <= F.col(border), 1).otherwise(0)
    size = word_count(text_col)
    made = {"size": size, "source_size": F.col(words), "target": F.col(target), "taken": (size * times).cast("long")}
    return joined.select(*(F.col(f.name) for f in without(docs, made)), *(c.alias(k) for k, c in made.items()))
