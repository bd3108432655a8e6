"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text, normalised by length.

Folding: lower case, accents off, look-alike letters of other scripts, digits
and signs that stand for letters (``1d10t``, ``$cum``), zero-width characters
out; l and i fold together, since 1, ! and | stand for both.

The lexicon is learned from labelled rows.  Terms are whole words and beginnings
of words of four letters or more, matched where a word begins, and shorter words, matched
whole.  A term is kept if it is at least ``ODDS`` times as frequent in toxic texts as in clean
ones and if chance alone would hardly make it so (the log-likelihood ratio of its share of
toxic texts exceeds the logarithm of the number of terms by ``SURE``); a least
number of texts is not asked for.  Texts whose words have the same three smallest
hashes (copies, near copies) count once, as the one with the least hash of its text.  A
term's weight is the smoothed log-odds.  Exception phrases (a term with the word
before or after it) are phrases that clean texts hold and toxic ones don't; further
ones can be given.  A term inside one does not count.

Score: 1 - exp(-k * sum of weights / log2(2 + words)); k is set so that all but
the weakest thousandth of the toxic texts in the sample get one half or more.

Bounded sample: the lexicon is fitted on ``fit_rows`` labelled rows (those with
the smallest hash of their id); the driver gets terms and counts only, at most
``max_terms`` terms (those of most weight) and ``max_phrases`` phrases (the most frequent
ones): both bound the automaton that every task builds.  Every row is scored, by its whole text, in a map without shuffle.

Defined results: a null, empty or wordless text scores 0; nulls in labels are
unlabelled rows; without toxic labels the lexicon is empty and all scores are 0.
Rows that share an id are scored each by its own text; if labels share an id, toxic wins.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import released, written

FIT_ROWS, MAX_TERMS, MAX_PHRASES, THRESHOLD = 20_000, 2_000, 10_000, 0.3
PREFIXES = (4, 5, 6, 7, 8)
#: Least ratio of a term's frequencies in toxic and clean texts; least log-likelihood ratio beyond the logarithm of the number of terms.
ODDS, SURE = 20, 0.0

# Look-alikes of Latin letters (Cyrillic, Greek), and signs used for letters.
_LOOKALIKES = dict(zip("аеорсухкмтнвіјѕԁԛԝһɡαβερτυχικνοσϲ", "aeopcyxkmthbijsdqwhgabeptuxiknosc", strict=True))
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_SIGN_RUN = re.compile(r"[01345780@$!|]+(?=[a-z])|(?<=[a-z])[013457@$]+(?![\w@$])")
_WORD = re.compile(r"[^\W\d_]+")
_SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for cp in [*range(0x41, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)]:
        low = chr(cp).lower()
        base = "".join(x for x in unicodedata.normalize("NFKD", low) if not unicodedata.combining(x))
        base = "".join(_LOOKALIKES.get(x, x) for x in base) or low
        base = base.replace("l", "i")
        if base != chr(cp):
            table[cp] = base
    for cp in range(0xFF21, 0xFF5B):  # full-width forms
        table[cp] = unicodedata.normalize("NFKC", chr(cp)).lower().replace("l", "i")
    for cp in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)):
        table[cp] = None
    return table


_FOLD = _table()
_FOLD_ASCII = bytes(ord("i") if chr(b).lower() == "l" else ord(chr(b).lower()) if b < 128 else b for b in range(256))


def fold(text: str) -> str:
    text = text.encode().translate(_FOLD_ASCII).decode() if text.isascii() else text.translate(_FOLD)
    return _SIGN_RUN.sub(lambda m: "".join(_SIGNS.get(x, x) for x in m[0]), text)


@dataclass
class Lexicon:
    """Folded terms with weights, folded exception phrases, and the scale of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    scale: float = 1.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            if phrase not in self.weights:
                found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found


def raw_score(text: str | None, automaton: ahocorasick.Automaton) -> float:
    """Sum of the weights of the terms in the text, per log2 of its words."""
    if not text or not len(automaton):
        return 0.0
    folded, hits, spared = fold(text), {}, []
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if start and folded[start - 1].isalnum():
            continue
        if weight is None:
            if end + 1 == len(folded) or not folded[end + 1].isalnum():
                spared.append((start, end))
        elif size >= PREFIXES[0] or end + 1 == len(folded) or not folded[end + 1].isalnum():  # short words count as a whole
            if size > hits.get(start, (0, 0))[0]:
                hits[start] = (size, weight)
    for a, b in spared:
        for start in [s for s, (size, _) in hits.items() if a <= s and s + size - 1 <= b]:
            del hits[start]
    if not hits:
        return 0.0
    return sum(w for _, w in hits.values()) / math.log2(2 + len(_SOLID.findall(text)))


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(fold(text)))
    return {w[:k] for w in words for k in PREFIXES if len(w) >= k} | words


def _phrases(text: str, terms: tuple[str, ...]) -> set[str]:
    words, found = _WORD.findall(fold(text)), set()
    for i, w in enumerate(words):
        if w in terms or w.startswith(tuple(t for t in terms if len(t) >= PREFIXES[0])):
            found |= {f"{words[i - 1]} {w}"} if i else set()
            found |= {f"{w} {words[i + 1]}"} if i + 1 < len(words) else set()
    return found


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS, max_terms: int = MAX_TERMS, max_phrases: int = MAX_PHRASES, exceptions: Sequence[str] = ()) -> Lexicon:
    """The lexicon of the labelled rows given; the caller leaves out rows held back for tests."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna().join(F.broadcast(chosen), "id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, terms = [], []
            for text in batch.column("text"):
                own = _terms(text.as_py())
                kinds.append(",".join(str(x) for x in sorted(xxhash.xxh32_intdigest(t) for t in own)[:3]))
                terms.append(sorted(own))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("text"), pa.array(kinds, pa.string()), pa.array(terms, pa.list_(pa.string()))], names=["label", "text", "kind", "terms"])

    sample = written(rows.mapInArrow(released(describe), "label int, text string, kind string, terms array<string>"), "toxicity-sample")
    distinct = written(sample.groupBy("label", "kind").agg(F.min_by("terms", F.struct(F.xxhash64("text"), "text")).alias("terms")), "toxicity-texts")
    sizes = {r.label: r["count"] for r in distinct.groupBy("label").count().collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos:
        return Lexicon(exceptions=tuple(fold(x) for x in exceptions))
    counted = distinct.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    counted = written(counted, "toxicity-terms")
    rate, share = n_pos / (n_pos + n_neg), F.col("pos") / (F.col("pos") + F.col("neg"))
    # Of a term's texts, how much likelier their labels are by its own share than by the sample's.
    unlike = F.col("pos") * F.log(share / rate) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / max(1 - rate, 1e-12))).otherwise(0.0)
    sure = math.log(max(1, counted.count())) + SURE
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    found = counted.filter("pos > 0").withColumn("odds", odds).filter(unlike >= sure)
    found = found.filter(F.col("neg") * n_pos * ODDS <= F.col("pos") * n_neg).orderBy(F.desc(F.col("odds") * F.col("pos")), "term").limit(max_terms).collect()

    counts, weights = {r.term: r.pos for r in found}, {}
    for r in sorted(found, key=lambda r: (len(r.term), r.term)):
        if len(r.term) < PREFIXES[0]:
            weights[r.term] = float(r.odds)
            continue
        if any(r.term[:k] in weights for k in range(PREFIXES[0], len(r.term))):
            continue
        # The longest beginning that (nearly) all words of this beginning share.
        longer = [t for t in counts if t.startswith(r.term) and counts[t] >= 0.95 * r.pos]
        weights[max(longer, key=lambda t: (len(t), t))] = float(r.odds)
    lexicon = Lexicon(weights, tuple(dict.fromkeys(fold(x) for x in exceptions)))
    if weights:
        lexicon = _with_exceptions(sample, lexicon, max_phrases)
        lexicon.scale = _scale(sample, lexicon)
    return lexicon


def _with_exceptions(sample: DataFrame, lexicon: Lexicon, most: int) -> Lexicon:
    terms = tuple(sorted(lexicon.weights))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(label.as_py(), p) for label, text in zip(batch.column("label"), batch.column("text"), strict=True) for p in _phrases(text.as_py(), terms)]
            yield pa.RecordBatch.from_pydict({"label": pa.array([x for x, _ in found], pa.int32()), "phrase": pa.array([x for _, x in found], pa.string())})

    counts = sample.select("label", "text").mapInArrow(released(phrases), "label int, phrase string").groupBy("phrase").agg(F.sum(F.col("label")).alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    clean = counts.filter("pos = 0 and neg >= 3").orderBy(F.desc("neg"), "phrase").limit(most).collect()
    return Lexicon(lexicon.weights, (*lexicon.exceptions, *(r.phrase for r in clean)), lexicon.scale)


def _scale(sample: DataFrame, lexicon: Lexicon) -> float:
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"x": pa.array([raw_score(t.as_py(), automaton) for t in batch.column("text")], pa.float64())})

    low = sample.filter("label = 1").select("text").mapInArrow(released(scores), "x double").filter("x > 0").select(F.percentile("x", F.lit(0.001)).alias("x")).first().x
    return math.log(2) / low if low else 1.0


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every text in column ``out`` (replacing one of that name)."""
    schema = T.StructType([f for f in docs.schema if f.name != out] + [T.StructField(out, T.DoubleType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            raw = np.array([raw_score(t.as_py(), automaton) for t in batch.column(text_col)], dtype=float)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(-np.expm1(-lexicon.scale * raw), pa.float64())], names=schema.names)

    return docs.mapInArrow(released(run), schema)


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels that may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return labels.filter(F.crc32(F.col(id_col).cast("string")) % 4 != 2)
