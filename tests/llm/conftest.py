import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(n, seed, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus():
    """Copies, near copies, repeated lines and passages, nulls, empty, long and wordless texts, repeated rows."""
    rows, at = [], 0

    def add(text, source="a", doc_id=...):
        nonlocal at
        rows.append((at if doc_id is ... else doc_id, text, "en", source, None if text is None else len(text)))
        at += 1

    base = words(120, 1)
    for k in range(8):  # near copies: a chain in which far ends do not link
        near = list(base)
        for j in range(k):
            near[10 * j + 5] = f"X{j}"
        add(" ".join(near), "a")
    for _ in range(4):
        add(" ".join(base), "b")  # copies
    line = "This very line is found again and again in many documents, word for word"
    for k in range(7):
        add(f"{' '.join(words(30, 50 + k))}\n  {line.upper() if k % 2 else line}\t\nshort line\n{' '.join(words(9, 90 + k))}", "a" if k % 2 else None)
    passage = " ".join(words(45, 7, 10**6))
    for k in range(5):
        add(f"{' '.join(words(25, 200 + k))} {passage} {' '.join(words(10 * k, 300 + k))}", "c")
    add(f"{passage}  {passage}\n{passage}", "c")
    for text in (None, "", "   \t\n ", "one", "One two", "ONE TWO", "\n\n", "é ñ ▁ ▁▁ x", "a\x00b c 　 d"):
        add(text, "d")
    add(" ".join(words(6000, 11, 3000)), "e")
    add("x" * 70_000, "e")
    add("same row here for the third time " * 4, "f", 900)
    add("same row here for the third time " * 4, "f", 900)
    add("no id, but words enough to count as a text", "f", None)
    add(f"no id either\n{line}", "f", None)
    for k in range(30):
        add(" ".join(words(20 + 7 * k, 1000 + k)), "g")
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
