"""End-to-end training plans over the driver tables.

Scale notes (documents ~100 TB, labels a few percent of them):

* ``labelled_features`` joins text with labels.  When the label table is
  provably small (its bytes are measured) it is broadcast and
  the join filters documents map-side, so only labelled documents are
  tokenized.  Otherwise the documents are featurized FIRST (map-only) and the
  shuffle join moves ``(key, 20-bucket sparse vector)`` - about 100 bytes a
  row - instead of whole texts of up to hundreds of KB.  Document keys are
  unique, so the join has no hot key; should a key repeat in a caller's
  data, AQE's skew-join handling splits its partition.
* The split is a hash of the key: map-only, repeatable.
* ``prepare_training_data`` writes ``(key, label, raw_features)`` of all
  labelled rows once to the shared folder; fits and evaluations of any
  number of models read those files (a lost executor re-reads them too).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions.text import is_valid_label
from labelkit.operators import features as fx
from labelkit.operators import models as mx
from labelkit.operators.split import SEED, TRAIN_SHARE, split_train_test
from labelkit.session import remove

# Broadcast the label side only below this many bytes of keys and labels, with
# ROW_BYTES for each row besides.
BROADCAST_MAX_BYTES = 64 << 20
ROW_BYTES = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Spread a scan only when its splits add up to at most this many bytes.
SPREAD_MAX_BYTES = 8 << 30

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _bytes(text: str) -> int:
    t = text.strip().lower()
    num = t.rstrip("kmgtb")
    return int(float(num) * _UNITS.get(t[len(num):] or "b", 1))


def is_small_scan(df: DataFrame) -> bool:
    """True when ``df`` (normally a plain file scan) is small and poorly
    spread: at most half as many partitions as cores, and at most
    ``SPREAD_MAX_BYTES`` in total (each split holds at most
    ``spark.sql.files.maxPartitionBytes``).  Call it on a scan, not on a
    plan with joins or aggregates: adaptive execution would run their
    stages to answer."""
    spark = df.sparkSession
    parts = df.rdd.getNumPartitions()
    split_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    return 2 * parts <= spark.sparkContext.defaultParallelism and parts * split_bytes <= SPREAD_MAX_BYTES


def spread(df: DataFrame, small: bool | None = None) -> DataFrame:
    """Give CPU-heavy text work at least one partition per core.

    A scan with few partitions and at most ``SPREAD_MAX_BYTES`` of splits is
    re-partitioned: a bounded shuffle that buys full parallelism for
    tokenizing.  Any larger scan is left alone: no shuffle of big text
    tables.  Rows are dealt round-robin, so a key that
    holds many rows cannot pile them into one task (Spark sorts each input
    partition first, which keeps the deal repeatable when a task is
    retried).  ``small`` may be decided beforehand on the source scan (see
    ``is_small_scan``).
    """
    if small is None:
        small = is_small_scan(df)
    if small:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return df


def table_bytes(df: DataFrame) -> int:
    """Bytes of all values as text, and ROW_BYTES a row: one aggregate over a narrow table."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(ROW_BYTES))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, name)``: every document, text as the name column."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("name"))


def doc_labels(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``(doc_id, gender)``: ``M`` when the 0/1 label is 1, else ``F``."""
    lab = table(spark, sf_dir, "labels")
    return lab.select("doc_id", F.when(F.col(label) == 1, F.lit("M")).otherwise(F.lit("F")).alias("gender"))


def labelled_docs(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``(doc_id, name, gender)``: documents joined with their labels (the
    label side is broadcast only when its bytes are within bounds)."""
    labels = doc_labels(spark, sf_dir, label)
    if table_bytes(labels) <= BROADCAST_MAX_BYTES:
        labels = F.broadcast(labels)
    return doc_texts(spark, sf_dir).join(labels, "doc_id")


def role_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, name, gender)``: conversation turns labelled by role,
    ``system`` turns dropped."""
    conv = table(spark, sf_dir, "conversations")
    out = conv.select("conv_id", "turn", F.col("text").alias("name"), F.col("role").alias("gender"))
    return out.filter(is_valid_label("gender", ("user", "assistant")))


def labelled_features(
    texts: DataFrame,
    labels: DataFrame,
    keys: Sequence[str],
    stages: Sequence[Transformer],
    text_col: str = "name",
    label_col: str = "gender",
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``(keys..., label_col, raw_features)`` for every labelled text."""
    keys = list(keys)
    labels = labels.select(*keys, label_col)
    featurize = PipelineModel(list(stages))
    texts = texts.select(*keys, text_col)
    small = is_small_scan(texts)
    if table_bytes(labels) <= broadcast_max_bytes:
        joined = spread(texts.join(F.broadcast(labels), keys), small)
        return featurize.transform(joined).select(*keys, label_col, fx.RAW_COL)
    feats = featurize.transform(spread(texts, small)).select(*keys, fx.RAW_COL)
    return feats.join(labels, keys)


@dataclass
class Prepared:
    stages: list
    labelled: DataFrame
    train: DataFrame
    test: DataFrame

    def release(self) -> None:
        """Delete the written features (``train`` and ``test`` can't be read afterwards)."""
        for path in {f.rsplit("/", 1)[0] for f in self.labelled.inputFiles()}:
            remove(self.labelled.sparkSession, path)


def prepare_training_data(
    texts: DataFrame,
    labels: DataFrame,
    keys: Sequence[str],
    text_col: str = "name",
    label_col: str = "gender",
    num_features: int = fx.NUM_FEATURES,
    stop_words: Sequence[str] | None = None,
    share: float = TRAIN_SHARE,
    seed: int = SEED,
    materialize: bool = True,
) -> Prepared:
    """Featurize, join labels, split.  Nothing is fitted before the split, so
    no test row leaks into IDF or the label index."""
    stages = fx.feature_stages(text_col, num_features, stop_words)
    labelled = labelled_features(texts, labels, keys, stages, text_col, label_col)
    if materialize:
        # One pass over the text for everything that follows: every fit and
        # every evaluation reads these (key, label, vector) files.
        labelled = mx.materialize(labelled, "labelled-features")
    train, test = split_train_test(labelled, keys, share, seed)
    return Prepared(stages, labelled, train, test)


def fit(prepared: Prepared, kind: str, label_col: str = "gender", use_idf: bool = True, **kw) -> PipelineModel:
    """Fit one model on the (already materialized) train side."""
    return mx.fit_on_features(
        prepared.train, kind, prepared.stages, label_col, use_idf, materialize_input=False, **kw
    )


def fit_many(prepared: Prepared, specs: dict[str, dict], label_col: str = "gender") -> dict[str, PipelineModel]:
    """Fit several models on the train side, sharing the label index, the IDF
    and the persisted rows (see ``models.fit_models``)."""
    return mx.fit_models(prepared.train, specs, prepared.stages, label_col, materialize_input=False)


def score_prepared(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Apply only the scoring head to rows that already carry ``raw_features``."""
    return PipelineModel(mx.scoring_head(model)).transform(rows)
