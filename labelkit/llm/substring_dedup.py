"""Substring dedup: repeated windows of words, found by level-wise doubling.

A window is ``size`` consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged) of one
document.  Every word goes that is covered by a window whose words also start
earlier: in a document with a smaller id, or earlier in the same one.

1. Levels: short windows (size halved until at most 5 words), then twice that
   length, up to ``size``.  A window of the full length is stood for by the least hash
   of its parts of a level's length: equal windows have equal least parts.  At each level the
   least parts of all documents' windows are counted, of those windows alone whose least
   parts all repeat at the levels below.  Some 2 of size - length + 2 parts are least ones; their
   hashes are shuffled, 4 bytes each, and counted exactly.  A count of one proves that
   a window is alone.  One bit for each place of a table (2**sketch_bits bits for the full
   length, a quarter of them below it) says which repeat, and is broadcast: what is
   alone takes no place in it.  A level at which nothing repeats is the last one.
2. Windows of the full length that survive form runs of neighbours.  Equal runs
   (128-bit hash, length) are copies: all but the first are covered whole.  A run has its
   words' hashes, or its windows' hashes if these are fewer bytes.
   First runs alone are spread into windows; those that a last count does not
   prove to be in one run are grouped exactly (by 128-bit hashes) to find each
   window's first place.  Minima combine before the shuffle; windows with many
   places are looked up by broadcast.
3. Covered word ranges go back to their documents.  Only documents that a bit
   table of ids does not prove to be whole are shuffled for that.

With far more distinct repeated parts than places the tables let more windows through, which
the exact step then groups: more shuffle, same result.

Defined results: null or empty texts have no words and become empty texts.  Rows
with the same id are one document: equal starts in them are not earlier than one
another, and each row (known by its id and its text's hash) loses its own windows.
Rows that are equal in both share one list of ranges, however many they are.
Null ids are one document before all others.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import DEALT_SCHEMA, Words, chunks, dealt, drop, flagged, fresh, lookup, mix, parted, released, repeated_flags, swept, window_hashes, without, written

SIZE, SKETCH_BITS = 20, 28


def levels(size: int) -> list[int]:
    """Window lengths from short to ``size``, each at most twice the one before."""
    out = [size]
    while out[0] > 5:
        out.insert(0, -(-out[0] // 2))
    return out


def _extreme(which: np.ufunc, values: np.ndarray, n: int) -> np.ndarray:
    """The least or largest of n neighbours from each place on (of fewer at the end)."""
    out, have = values.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[:-step] = which(out[:-step], out[step:])
        have += step
    return out


def _fewer(bits: int) -> int:
    """Bits of the width of the tables of which a quarter is enough; a byte is the least."""
    return max(3, bits - 2)


def _marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return flagged(table, hashes & np.uint64(8 * len(table) - 1))


def _survivors(words: Words, lengths: Sequence[int], tables: Sequence[np.ndarray]) -> np.ndarray:
    """Whether the window of the last length from each word on may repeat: its least parts of the tables' lengths do."""
    size = lengths[-1]
    ok = words.inside(size)
    for n, table in zip(lengths, tables, strict=False):
        at = np.flatnonzero(ok)
        ok[at] = _marked(table, _extreme(np.minimum, words.windows(n), size - n + 1)[at])
    return ok


def _least_parts(words: Words, n: int, size: int, ok: np.ndarray) -> np.ndarray:
    """Hashes of all places where n words have the least hash of a window of ``size`` words that is ok."""
    hashes, parts = words.windows(n), size - n + 1
    least = np.where(ok, _extreme(np.minimum, hashes, parts), np.uint64(0))
    # No window has a least part that is more than any of its parts: a part is least in one if it is the largest least part of those around it.
    return hashes[words.inside(n) & (hashes == _extreme(np.maximum, least[::-1], parts)[::-1])]


def _counts(docs: DataFrame, lengths: Sequence[int], below: Sequence, bits: int) -> np.ndarray:
    """Bits of the hash values that the next level's least parts of surviving windows have more than once."""
    n, size = lengths[len(below)], lengths[-1]
    bits = max(3, bits) if n == size else _fewer(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b.value for b in below]
        texts = (Words(part.column("text")) for batch in batches for part in chunks(batch))
        yield from dealt((_least_parts(words, n, size, _survivors(words, lengths, tables)) for words in texts), bits)

    return repeated_flags(docs.select("text").mapInArrow(released(count), DEALT_SCHEMA), bits)


def _runs(docs: DataFrame, size: int, tables: Sequence, id_type: str) -> DataFrame:
    """(h1, h2, n, id, tie, start, words): runs of n neighbouring survivors, with the hashes of their words, or of their windows if they are few."""
    lengths = levels(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [t.value for t in tables]
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"))
                ok = np.concatenate(([False], _survivors(words, lengths, data), [False]))
                # Neighbours in two texts are never one run: the last size - 1 words of a text begin no window.
                starts, ends = np.flatnonzero(ok[1:] & ~ok[:-1]), np.flatnonzero(ok[:-1] & ~ok[1:])
                if size == 1:
                    cut = words.first[1:-1]
                    inner = cut[(cut > 0) & (cut < len(ok) - 2)]
                    inner = inner[ok[1:-1][inner] & ok[1:-1][inner - 1]]
                    starts, ends = np.union1d(starts, inner), np.union1d(ends, inner)
                if not len(starts):
                    continue
                a, b = words.windows(size), window_hashes(words.hashes, size, other=True)
                owner = np.searchsorted(words.first, starts, "right") - 1
                n = ends - starts
                first = np.cumsum(n) - n
                number = np.arange(n.sum()) - np.repeat(first, n)
                # Of a run: the sums of its windows' hashes, weighted by their places.
                weight = mix(number.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
                at = np.repeat(starts, n) + number
                with np.errstate(over="ignore"):
                    h1, h2 = (pa.array(np.add.reduceat(h[at] * weight, first).view(np.int64)) for h in (a, b))
                width = _width(n, size)
                place = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                few, own = np.repeat(n < size - 1, width), np.repeat(n, width)
                # Places in the words' hashes, the windows' first and then their second ones.
                place += np.repeat(starts, width) + np.where(few, np.where(place < own, len(a), 2 * len(a) - own), 0)
                offsets = pa.py_buffer((np.append(0, np.cumsum(width)) * 8).astype(np.int64).tobytes())
                held = pa.Array.from_buffers(pa.large_binary(), len(n), [None, offsets, pa.py_buffer(np.concatenate((words.hashes, a, b))[place].tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [h1, h2, pa.array(n.astype(np.int32)), part.column("id").take(pa.array(owner)), part.column("tie").take(pa.array(owner)), pa.array((starts - words.first[owner]).astype(np.int32)), held],
                    names=["h1", "h2", "n", "id", "tie", "start", "words"],
                )

    return docs.mapInArrow(released(run), f"h1 long, h2 long, n int, id {id_type}, tie long, start int, words binary")


def _width(n: np.ndarray, size: int) -> np.ndarray:
    """Hashes that runs of n windows have: one for each word, or two for each window if there are fewer than size - 1."""
    return np.where(n < size - 1, 2 * n, n + size - 1)


def _run_windows(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Some runs at a time: the runs, and for each window its hashes, its run and its number in the run."""
    # Of long runs few, of short ones many.
    for part in chunks(batch, "words"):
        n = part.column("n").to_numpy().astype(np.int64)
        held = np.frombuffer(b"".join(part.column("words").to_pylist()), dtype=np.uint64)
        run = np.repeat(np.arange(len(n)), n)
        number = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        width = _width(n, size)
        at = np.repeat(np.cumsum(width) - width, n) + number
        a, b = window_hashes(held, size)[at], window_hashes(held, size, other=True)[at]
        few = (n < size - 1)[run]
        a[few], b[few] = held[at[few]], held[at[few] + n[run[few]]]
        yield part, a, b, run, number


def _spread(runs: DataFrame, size: int, id_type: str, bits: int) -> DataFrame:
    """(h1, h2, id, tie, start) of the windows that may be in more than one of the runs."""
    bits = _fewer(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt((a for batch in batches for _, a, _, _, _ in _run_windows(batch, size)), bits)

    again = runs.sparkSession.sparkContext.broadcast(repeated_flags(runs.select("n", "words").mapInArrow(released(count), DEALT_SCHEMA), bits))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, a, b, run, number in _run_windows(batch, size):
                may = _marked(again.value, a)
                start = number[may] + part.column("start").to_numpy()[run[may]]
                yield pa.RecordBatch.from_arrays([pa.array(a[may].view(np.int64)), pa.array(b[may].view(np.int64)), part.column("id").take(pa.array(run[may])), part.column("tie").take(pa.array(run[may])), pa.array(start.astype(np.int32))], names=["h1", "h2", "id", "tie", "start"])

    return runs.mapInArrow(released(spread), f"h1 long, h2 long, id {id_type}, tie long, start int")


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """(id, tie, start, n): n windows from word ``start`` on of the row with this id and hash of its text, each of which also starts earlier."""
    if size < 1:
        raise ValueError("size must be 1 or more")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    id_type = docs.schema["id"].dataType.simpleString()
    lengths, tables = levels(size), []
    for _ in lengths:
        bits = _counts(docs, lengths, tables, sketch_bits)
        if not bits.any():  # no window of this length repeats, so no longer one does
            return docs.sparkSession.createDataFrame([], f"id {id_type}, tie long, start int, n int")
        tables.append(docs.sparkSession.sparkContext.broadcast(bits))
        swept(docs.sparkSession)
    runs = written(_runs(docs, size, tables, id_type), "runs")
    place = F.struct("id", "start")
    row = F.struct("id", "start", "tie")
    for table in tables:
        table.unpersist()
    firsts = runs.groupBy("h1", "h2", "n").agg(F.min(row).alias("first"), F.count("*").alias("times"), F.min_by("words", row).alias("words"))
    firsts = written(firsts.select("h1", "h2", "n", "times", "first.id", "first.tie", "first.start", "words"), "first-runs")
    swept(docs.sparkSession)
    total = runs.count()
    many = firsts.filter("times > 1").select(F.struct("h1", "h2", "n").alias("key"), "times", F.struct("id", "start").alias("first"))
    copies = lookup(runs.select(F.struct("h1", "h2", "n").alias("key"), "id", "tie", "start"), many, "key", "times", total)
    copies = copies.filter(~F.struct("id", "start").eqNullSafe(F.col("first"))).select("id", "tie", "start", F.col("key.n").alias("n"))
    # What is read no more goes, so that the disk holds one form of the runs at a time.
    copies = written(copies, "copies")
    drop(runs)

    windows = written(_spread(firsts, size, id_type, sketch_bits), "windows")
    drop(firsts)
    swept(docs.sparkSession)
    begin = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("times")).filter("times > 1")
    begin = written(begin.select(F.struct("h1", "h2").alias("key"), "times", "first"), "first-windows")
    swept(docs.sparkSession)
    later = lookup(windows.select(F.struct("h1", "h2").alias("key"), "id", "tie", "start"), begin, "key", "times", windows.count())
    later = later.filter(~F.struct("id", "start").eqNullSafe(F.col("first"))).select("id", "tie", "start", F.lit(1).alias("n"))
    return copies.unionByName(later)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``docs`` with the kept words, joined by one space, as text, plus n_words (before) and n_removed."""
    own, tie, cut_id, cut_tie, cut, start_, n_ = fresh(docs, "_id", "_tie", "_cut_id", "_cut_tie", "_cut", "_start", "_n")
    ranges = covered(docs, id_col, text_col, size, sketch_bits).groupBy(F.col("id").alias(cut_id), F.col("tie").alias(cut_tie)).agg(F.collect_set(F.struct("start", "n")).alias(cut))
    ranges = written(ranges.select(cut_id, cut_tie, F.col(f"{cut}.start").alias(start_), F.col(f"{cut}.n").alias(n_)), "cuts")
    swept(docs.sparkSession)
    some, whole = parted(docs, id_col, ranges.select(cut_id))
    some = some.withColumns({own: F.col(id_col), tie: F.xxhash64(text_col)})
    some = some.join(ranges, F.col(own).eqNullSafe(F.col(cut_id)) & (F.col(tie) == F.col(cut_tie)), "left").drop(own, tie, cut_id, cut_tie)
    joined = some.unionByName(whole.withColumns({c: F.lit(None).cast("array<int>") for c in (start_, n_)}))
    schema = T.StructType([*without(docs, ("n_words", "n_removed")), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = schema.names

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                words = Words(part.column(text_col))
                raw = words.raw.tobytes()
                texts, removed = [], []
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                    gone = np.zeros(b - a + 1, dtype=np.int64)
                    if part.column(start_)[i].is_valid:
                        start, n = (part.column(c)[i].values.to_numpy() for c in (start_, n_))
                        np.add.at(gone, start, 1)
                        np.add.at(gone, np.minimum(start + n + size - 1, b - a), -1)
                    stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0) + a
                    removed.append(b - a - len(stay))
                    texts.append(b" ".join([raw[s:e] for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist(), strict=True)]).decode())
                made = {"n_words": pa.array(np.diff(words.first).astype(np.int64)), "n_removed": pa.array(removed, pa.int64()), text_col: pa.array(texts, pa.string())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in names], names=names)

    return joined.mapInArrow(released(rebuild), schema)
