"""Repeatable train / test split.

``randomSplit`` draws per partition, so the same rows land in different sides
when the input is re-partitioned (or re-read with other split sizes).  Here
the side is a pure function of the row key and the seed: map-only, no
shuffle, stable across runs, partitionings and cluster sizes, and the same
rule can be written in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_SHARE = 0.8
SEED = 42
BUCKETS = 10000


def split_bucket(keys: Sequence[str], seed: int = SEED) -> Column:
    """``int(md5(seed|key...)[:8], 16) % 10000``: a stable bucket in [0, 10000)."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(BUCKETS))


def is_train(keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SEED) -> Column:
    return split_bucket(keys, seed) < F.lit(int(round(share * BUCKETS)))


def split_train_test(
    df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Two lazy filters over one stable hash of the key columns."""
    flag = is_train(keys, share, seed)
    return df.filter(flag), df.filter(~flag)
