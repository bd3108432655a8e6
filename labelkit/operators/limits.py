"""Row limits for display.  Always ordered, so the rows are repeatable;
Spark plans ``orderBy(...).limit(k)`` as a per-task top-k plus a final merge
of ``k x tasks`` rows (TakeOrderedAndProject), never a full sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def sample_rows(df: DataFrame, order_by: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """First ``k`` rows in a fixed order (all columns when none given)."""
    return df.orderBy(*(order_by or df.columns)).limit(k)


def first_row(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    return sample_rows(df, order_by, 1)
