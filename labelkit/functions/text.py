"""Column -> Column functions.  All are built-in Spark expressions, so they
stay inside whole-stage codegen and are pushed wherever Catalyst can push them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) ---------------------
# Cleaning keeps only these characters after lower-casing.
CLEAN_PATTERN = "[^a-z ]"
# Header line of the names file, field separator, and the accepted labels.
HEADER_TOKEN = "NOMPL;SEXE"
SEPARATOR = ";"
LABELS = ("M", "F")
# Display names of labels: "F" is Female, anything else is Male.
FEMALE_LABEL = "F"
FEMALE_TEXT = "Female"
MALE_TEXT = "Male"
# Whitespace as Python's str.split() / str.strip() see it (the reference cuts
# the first name with them): tab, LF, VT, FF, CR, FS, GS, RS, US, space, NEL,
# NBSP, ogham space, U+2000..U+200A, line and paragraph separators, narrow
# NBSP, medium math space, ideographic space.  Written as a regex class body
# that both Java regex and RE2 read the same way.
WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
FIRST_TOKEN_PATTERN = f"^[{WHITESPACE_CLASS}]*([^{WHITESPACE_CLASS}]+)"
# ------------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col: Column | str) -> Column:
    """Lower-case, then delete every character outside ``a-z`` and space."""
    return F.regexp_replace(F.lower(_c(col)), CLEAN_PATTERN, "")


def first_token(col: Column | str) -> Column:
    """First whitespace-separated word; the input unchanged if it has none."""
    c = _c(col)
    return F.coalesce(F.nullif(F.regexp_extract(c, FIRST_TOKEN_PATTERN, 1), F.lit("")), c)


def text_length(col: Column | str) -> Column:
    """Number of characters (code points)."""
    return F.length(_c(col))


def array_item(arr: Column | str, index: int) -> Column:
    """Element ``index`` (0-based) of an array, null when out of range.

    ``F.get`` instead of ``getItem``: with ANSI mode on, ``getItem`` raises on
    a short array, and a line without the separator must be dropped, not fail.
    """
    return F.get(_c(arr), index)


def split_fields(col: Column | str, sep: str = SEPARATOR) -> Column:
    """Split on a literal separator, keeping empty fields (trailing too)."""
    return F.split(_c(col), _regex_quote(sep), -1)


def is_valid_label(col: Column | str, labels: Iterable[str] = LABELS) -> Column:
    """Exact match against a fixed label set: no trimming, no case folding."""
    return _c(col).isin(*labels)


def is_not_null(col: Column | str) -> Column:
    return _c(col).isNotNull()


def is_non_empty(col: Column | str) -> Column:
    """Reject null and empty text."""
    return _c(col).isNotNull() & (_c(col) != "")


def contains_header(col: Column | str, token: str = HEADER_TOKEN) -> Column:
    return _c(col).contains(token)


def label_display(col: Column | str) -> Column:
    """``F`` -> ``Female``, anything else -> ``Male``."""
    return F.when(_c(col) == F.lit(FEMALE_LABEL), F.lit(FEMALE_TEXT)).otherwise(F.lit(MALE_TEXT))


def confidence_pct(col: Column | str) -> Column:
    """Confidence as a percentage with one decimal."""
    return F.round(_c(col) * 100.0, 1)


def _regex_quote(text: str) -> str:
    specials = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in specials else ch for ch in text)
