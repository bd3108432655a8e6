"""A corpus pipeline of five stages; each calls one operator of labelkit.llm and works on all that the stage before kept.

    toxic documents go -> repeated lines go -> one document of each group of near copies stays
    -> sources are mixed to their targets -> texts become SentencePiece ids

All but the last return the columns of ``documents``; ``n_chars``, where there
is one, follows the text.  Rows with the same id stay or go together.  Rows with
null ids are kept by the first two stages unless their text is toxic."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm import jaccard_join, line_dedup, sentencepiece_codec, source_mix, toxicity
from labelkit.llm.common import documents, fresh, labels, small_batches, written

#: Near copies: sets of 5-word shingles that overlap by 80 % or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Bytes of a batch that Spark hands to Python: executors go through all stages, and what one needs at its peak is kept from there on.
STAGE_BATCH_BYTES = 1 << 19


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.fit(docs, toxicity.training_labels(labels(spark, sf_dir)))
    (score,) = fresh(docs, "_score")
    return toxicity.score(docs, lexicon, out=score).filter(F.col(score) < toxicity.THRESHOLD).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A column of the input that is named as a count of the operator keeps its values under another name meanwhile.
    names = dict(zip(("n_lines", "n_dropped"), fresh(docs, "_n_lines", "_n_dropped"), strict=True))
    kept = line_dedup.dedup_lines(docs.withColumnsRenamed(names)).drop(*names).withColumnsRenamed({v: k for k, v in names.items()}).select(docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, n=NEAR_WORDS, percent=NEAR_PERCENT).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = ("size", "source_size", "target", "taken")
    names = dict(zip(made, fresh(docs, *(f"_{c}" for c in made)), strict=True))
    mixed = source_mix.mix(docs.withColumnsRenamed(names)).filter("taken > 0")
    (copy,) = fresh(mixed, "_copy")
    copies = mixed.withColumn(copy, F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))))
    return copies.drop(*made).withColumnsRenamed({v: k for k, v in names.items()}).select(docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Written between the two: a task of both would have two Python workers, and an executor four that hold models and caches.
    coded = written(sentencepiece_codec.encode(docs.select("doc_id", "lang", "source", "text")), "piece-ids")
    back = sentencepiece_codec.decode(coded, out="decoded")
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark, STAGE_BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _bounded(drop_toxic)),
    ("line_dedup", _bounded(drop_lines)),
    ("near_copies", _bounded(drop_near_copies)),
    ("source_mix", _bounded(mix_sources)),
    ("sentencepiece", _bounded(to_pieces)),
]

#: The lexicon is learned and the merges are an agenda: no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
