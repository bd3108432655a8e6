"""Line dedup: two Bloom filters find suspected repeats, only these shuffle for exact confirmation.

1. Every task adds the keys of its lines to a filter of keys seen once and, on
   meeting one again, to a filter of keys seen twice.  The tasks' filters are
   merged block by block and in levels (seen twice: in a task's second filter, or in
   the first filters of two tasks).  Both have a fixed width, so the merged second
   filter has a proven size and is broadcast.
2. Keys that the second filter holds are suspected.  Only their 128-bit digests
   travel, with the document's id, and are counted exactly.
3. Confirmed keys go back to the lines that hold them (very common keys by
   broadcast, see ``common.lookup``), then to their documents.  Only documents
   that a bit table of ids does not prove to be whole are shuffled for that.

Beyond some hundred million lines the filters fill up and suspect more lines;
the result stays exact, and more digests (24 bytes a line) are shuffled.

Defined results: a null or empty text is one empty line.  Rows with the same id
are one document for counting, as are all rows with a null id, which sorts
before every other id; each row keeps its own text.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import SKETCH_SCHEMA, bit_rows, chunks, fresh, lookup, merged_flags, parted, released, without, written

SPACES = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
FILTER_BITS = 26
HASHES = 4


def keys_of(text: str | None, min_chars: int) -> list[bytes | None]:
    """Each line's key, or None where the line is too short to count."""
    out = []
    for line in (text or "").split("\n"):
        key = line.strip(SPACES)
        out.append(key.encode("utf-8", "surrogatepass").lower() if len(key) >= min_chars else None)
    return out


def digests_of(text: str | None, min_chars: int) -> list[bytes | None]:
    return [None if k is None else xxhash.xxh3_128_digest(k) for k in keys_of(text, min_chars)]


class Bloom:
    """Bits at HASHES places derived from the two halves of a 128-bit digest."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.mask = np.uint64((1 << bits) - 1)
        self.data = np.zeros(max(1, (1 << bits) // 8), dtype=np.uint8) if data is None else data

    def places(self, digests: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.stack([(digests[:, 0] + np.uint64(k) * (digests[:, 1] | np.uint64(1))) & self.mask for k in range(HASHES)])

    def add(self, digests: np.ndarray) -> None:
        at = self.places(digests).ravel()
        np.bitwise_or.at(self.data, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))

    def holds(self, digests: np.ndarray) -> np.ndarray:
        at = self.places(digests)
        return ((self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)


def twice_seen(docs: DataFrame, min_chars: int, bits: int) -> np.ndarray:
    """The merged filter of keys that two texts, at least, may hold."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bloom(bits), Bloom(bits)
        for batch in batches:
            for part in chunks(batch):
                found = [d for text in part.column("text") for d in {d for d in digests_of(text.as_py(), min_chars) if d}]
                if found:
                    new, count = np.unique(_pairs(found), axis=0, return_counts=True)
                    again = once.holds(new) | (count > 1)
                    twice.add(new[again])
                    once.add(new)
        yield from bit_rows(once.data, twice.data)

    return merged_flags(docs.mapInArrow(released(fill), SKETCH_SCHEMA), 8 * len(Bloom(bits).data))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without repeated lines, plus n_lines (before) and n_dropped.

    A line's key is the line stripped of white space and with A-Z lower-cased.
    Keys of ``min_chars`` code points or more in ``min_docs`` documents or more
    lose all lines but those of the largest id that holds them.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    filter_ = docs.sparkSession.sparkContext.broadcast(twice_seen(narrow.select("text"), min_chars, filter_bits))
    id_type = narrow.schema["id"].dataType

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = Bloom(filter_bits, filter_.value)
        for batch in batches:
            for part in chunks(batch):
                rows, found = [], []
                for i, text in enumerate(part.column("text")):
                    own = {d for d in digests_of(text.as_py(), min_chars) if d}
                    found += own
                    rows += [i] * len(own)
                if found:
                    hit = np.flatnonzero(bloom.holds(_pairs(found)))
                    yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(np.array(rows)[hit])), pa.array([found[k] for k in hit], pa.binary())], names=["id", "digest"])

    suspects = written(narrow.mapInArrow(released(suspect), T.StructType([T.StructField("id", id_type), T.StructField("digest", T.BinaryType())])), "line-suspects")
    common = written(
        suspects.distinct().groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("keep")).filter(F.col("n") >= min_docs), "line-repeats"
    )
    total = suspects.count()
    drops = lookup(suspects.distinct(), common, "digest", "n", total).filter(~F.col("id").eqNullSafe(F.col("keep")))
    own, drop_id, drop = fresh(docs, "_id", "_drop_id", "_drop")
    drops = written(drops.groupBy(F.col("id").alias(drop_id)).agg(F.collect_set("digest").alias(drop)), "line-drops")
    cut, whole = parted(docs, id_col, drops.select(drop_id))
    # A merge join at every size, whose hot ids AQE splits: a broadcast of the drops would grow with the table.
    cut = cut.withColumn(own, F.col(id_col)).join(drops.hint("merge"), F.col(own).eqNullSafe(F.col(drop_id)), "left").drop(own, drop_id)
    joined = cut.unionByName(whole.withColumn(drop, F.lit(None).cast("array<binary>")))

    out_type = T.StructType([*without(docs, ("n_lines", "n_dropped")), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = out_type.names

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, text_col)):
            texts, lines, dropped = [], [], []
            for text, digests in zip(batch.column(text_col), batch.column(drop), strict=True):
                text, gone = text.as_py(), set(digests.as_py() or ())
                split = (text or "").split("\n")
                kept = [line for line, d in zip(split, digests_of(text, min_chars), strict=True) if d not in gone] if gone else split
                lines.append(len(split))
                dropped.append(len(split) - len(kept))
                texts.append(text if len(kept) == len(split) else "\n".join(kept))
            made = {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()), text_col: pa.array(texts, batch.schema.field(text_col).type)}
            yield pa.RecordBatch.from_arrays([made.get(c, None) if c in made else batch.column(c) for c in names], names=names)

    return joined.mapInArrow(released(rebuild), out_type)
