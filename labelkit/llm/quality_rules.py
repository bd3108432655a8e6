"""Quality rules: gradient-boosted trees over document statistics, flattened to numpy node arrays.

Statistics are counted on the UTF-8 bytes of a whole batch of texts, without a
loop over words.  The trees are fitted with a logistic loss on binned features;
chosen features are monotone: more symbols, repeated words or repeated lines
never raise a score.  A split that would break this is not made, and both sides
of a monotone split are bounded by its middle.  For scoring, all trees lie in
flat arrays (feature, border, left child, value), and a batch of rows goes down
one level of a tree at a time.

Bounded sample: the trees are fitted on ``fit_rows`` labelled rows at most (those
with the smallest hash of their id); only their statistics come to the driver.
Statistics and scores cover every row and whole texts, in a map without shuffle.

Defined results: null, empty and wordless texts have all counts 0.  Nulls in
labels are unlabelled rows; without labels of both kinds every document that
passes the base rule is kept.  Rows that share an id are judged each by its own text;
for the fit, the one with the least statistics stands for them, and a good label wins.  Extra columns pass through; columns named as
results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import Words, chunks, mix, released

FIT_ROWS, ROUNDS, DEPTH, RATE, BINS, LEAST_ROWS = 20_000, 60, 3, 0.2, 64, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "distinct")
#: -1: a larger value never raises the score.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1}

_SYMBOL, _UPPER, _DIGIT, _MARK = (np.isin(np.arange(256), list(x)) for x in (b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58)), b"!?"))
_BLANK = " \t\n\x0b\x0c\r"


def _sums(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[borders[1:]] - total[borders[:-1]]


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal hashes of one owner: each element's group, and the groups' sizes."""
    with np.errstate(over="ignore"):
        _, group, size = np.unique(mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    return group, size


def counts(texts: pa.Array) -> np.ndarray:
    """A row of COUNTS for each text."""
    words = Words(texts)
    rows, raw, m = len(texts), words.raw, len(words.hashes)
    out = np.zeros((rows, len(COUNTS)), dtype=np.int64)
    n_words = np.diff(words.first)
    owner = np.repeat(np.arange(rows), n_words)
    out[:, 0] = n_words
    lead = (raw & 0xC0) != 0x80
    heads = np.concatenate(([0], np.cumsum(lead, dtype=np.int64)))
    out[:, 1] = _sums(heads[words.ends] - heads[words.starts], words.first)
    for k, table in ((2, _SYMBOL), (7, _UPPER), (8, _DIGIT), (9, _MARK)):
        out[:, k] = _sums(table[raw], words.borders)
    out[:, 5] = _sums(lead, words.borders)
    if m:
        group, _ = _distinct(owner, words.hashes)
        first = np.zeros(m, dtype=bool)
        first[np.unique(group, return_index=True)[1]] = True
        out[:, 10] = _sums(first, words.first)
        inside = words.inside(3)
        group, size = _distinct(owner[inside], words.windows(3)[inside])
        again = np.zeros(m + 2, dtype=bool)
        again[np.flatnonzero(inside)[size[group] > 1]] = True
        cover = again.copy()
        cover[1:] |= again[:-1]
        cover[2:] |= again[:-2]
        out[:, 4] = _sums(cover[:m], words.first)
    for i, text in enumerate(texts.to_pylist()):
        lines = (text or "").split("\n")
        out[i, 6] = len(lines)
        if len(lines) > 1:
            solid = [line for line in lines if line.strip(_BLANK)]
            out[i, 3] = len(solid) - len(set(solid))
    return out


def features(c: np.ndarray) -> np.ndarray:
    c = c.astype(np.float64)
    words, chars = np.maximum(c[:, 0], 1), np.maximum(c[:, 5], 1)
    return np.stack([np.log1p(c[:, 0]), c[:, 1] / words, c[:, 2] / chars, c[:, 3] / np.maximum(c[:, 6], 1), c[:, 4] / words, c[:, 7] / chars, c[:, 8] / chars, c[:, 9] / chars, c[:, 10] / words], axis=1)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the statistics of each whole text."""
    schema = T.StructType([f for f in docs.schema if f.name not in COUNTS] + [T.StructField(c, T.LongType()) for c in COUNTS])
    kept = [f.name for f in schema if f.name not in COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                made = counts(part.column(text_col))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(pa.array(made[:, k]) for k in range(len(COUNTS)))], names=schema.names)

    return docs.mapInArrow(released(run), schema)


@dataclass
class Trees:
    """Nodes of all trees in flat arrays; a leaf has feature -1; the right child follows the left one."""

    feature: np.ndarray
    border: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                inner = self.feature[at] >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(self.feature[at], 0)] > self.border[at]
                at = np.where(inner, self.left[at] + right, at)
            total += self.value[at]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    borders = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(b, x[:, k], "left") for k, b in enumerate(borders)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    feature, border, left, value, roots = [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, -1), (border, 0.0), (left, -1), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        roots.append(node())
        todo = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            at, rows, level, low, high = todo.pop()
            whole_g, whole_h = g[rows].sum(), h[rows].sum()
            own = float(np.clip(whole_g / (whole_h + 1), low, high))
            best = (1e-6, None, None, None)
            for k, b in enumerate(borders) if level < depth else ():
                if not len(b):
                    continue
                gs, hs, ns = (np.cumsum(np.bincount(binned[rows, k], weights=w, minlength=len(b) + 1))[:-1] for w in (g[rows], h[rows], None))
                vl, vr = np.clip(gs / (hs + 1), low, high), np.clip((whole_g - gs) / (whole_h - hs + 1), low, high)
                gain = gs**2 / (hs + 1) + (whole_g - gs) ** 2 / (whole_h - hs + 1) - whole_g**2 / (whole_h + 1)
                gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS) | (monotone[k] * (vr - vl) < 0)] = 0
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (gain[j], k, j, float(vl[j] + vr[j]) / 2)
            if best[1] is None:
                value[at] = rate * own
                margin[rows] += value[at]
                continue
            _, k, j, middle = best
            feature[at], border[at], left[at] = k, float(borders[k][j]), node()
            node()
            right = binned[rows, k] > j
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(monotone[k])]
            todo += [(left[at], rows[~right], level + 1, *bounds[0]), (left[at] + 1, rows[right], level + 1, *bounds[1])]
    return Trees(np.array(feature), np.array(border), np.array(left), np.array(value), np.array(roots, dtype=np.int64), base)


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Trees | None:
    """Trees from the statistics of labelled rows; None if the labels are not of both kinds."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    # Of rows that share an id, the one with the least statistics.
    rows = measured.select(F.col(id_col).alias("id"), F.struct(*COUNTS).alias("counts")).join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("counts").alias("counts"), F.max("label").alias("label")).select("id", "counts.*", "label")
    table = rows.orderBy("id").limit(fit_rows).select(*COUNTS, "label").toPandas().to_numpy(dtype=np.int64)
    y = table[:, -1].astype(float) if len(table) else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return None
    return fit_trees(features(table[:, :-1]), y, np.array([MONOTONE.get(f, 0) for f in FEATURES]))


def base_failed(n_words: str = "n_words", repeats: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < 50) | (100 * F.col(repeats) > 50 * F.col(n_words))


def judge(measured: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """``measured`` with base_failed, quality (the trees' score) and kept."""
    made = {"base_failed": T.BooleanType(), "quality": T.DoubleType(), "kept": T.BooleanType()}
    base = measured.withColumn("base_failed", base_failed())
    schema = T.StructType([f for f in base.schema if f.name not in ("quality", "kept")] + [T.StructField(c, made[c]) for c in ("quality", "kept")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1))
            score = trees.score(x) if trees else np.ones(len(x))
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-2]), pa.array(score), pa.array(~failed & (score >= threshold))], names=schema.names)

    return base.mapInArrow(released(run), schema)
