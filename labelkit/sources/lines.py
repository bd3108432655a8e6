"""Delimited ``name;label`` text files.

The loader is one narrow chain (text scan -> filter -> project -> filter):
no shuffle, and every file split is read by its own task.  The first line is
looked at (a job that reads one row): lines with the header text go only if it
has it, so a file without a header loses no line; an empty file stays empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from labelkit.functions.text import (
    HEADER_TOKEN,
    LABELS,
    SEPARATOR,
    array_item,
    contains_header,
    is_not_null,
    is_valid_label,
    split_fields,
)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``.  Spark strips CR and the BOM."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def write_lines(df: DataFrame, path: str, col: str | Column = "value") -> str:
    """Write one string column as text lines (the loader's input format)."""
    c = F.col(col) if isinstance(col, str) else col
    df.select(c.alias("value")).write.mode("overwrite").text(path)
    return path


def drop_header(lines: DataFrame, token: str = HEADER_TOKEN, col: str = "value") -> DataFrame:
    """Drop every line that carries the header text, if the first line does."""
    first = lines.select(contains_header(col, token)).first()
    return lines.filter(~contains_header(col, token)) if first is not None and first[0] else lines


def parse_delimited(
    lines: DataFrame,
    sep: str = SEPARATOR,
    name_col: str = "name",
    label_col: str = "gender",
    col: str = "value",
) -> DataFrame:
    """Field 0 -> name, field 1 -> label (null when missing); extra fields ignored.

    The line is split once; both fields read that array.
    """
    fields = lines.select(split_fields(col, sep).alias("_fields"))
    return fields.select(array_item("_fields", 0).alias(name_col), array_item("_fields", 1).alias(label_col))


def load_labelled(
    spark: SparkSession,
    path: str | Sequence[str] | DataFrame,
    sep: str = SEPARATOR,
    header_token: str = HEADER_TOKEN,
    labels: Iterable[str] = LABELS,
    name_col: str = "name",
    label_col: str = "gender",
) -> DataFrame:
    """The whole loader: read, drop header, parse, keep valid labels and names.

    ``path`` may also be a DataFrame of lines (column ``value``).
    """
    lines = path if isinstance(path, DataFrame) else read_lines(spark, path)
    parsed = parse_delimited(drop_header(lines, header_token), sep, name_col, label_col)
    return parsed.filter(is_valid_label(label_col, labels) & is_not_null(name_col))


def rows_from_values(spark: SparkSession, values: Iterable[str], col: str = "name") -> DataFrame:
    """A one-column string table from given values (e.g. names typed by a user).

    Meant for a handful of values; tables belong in files or DataFrames.
    """
    schema = StructType([StructField(col, StringType(), True)])
    return spark.createDataFrame([(v,) for v in values], schema)
