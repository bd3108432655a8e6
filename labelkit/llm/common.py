"""Shared helpers: vectorised word hashing, bounded sketches, components, skew-safe lookups.

Words are ``[^\\x20\\x09-\\x0D]+``.  All six separators are ASCII, so word
borders and A-Z folding are found on the UTF-8 bytes of a whole Arrow batch,
without decoding and without a loop over words.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.session import remove, scratch_path

#: Text bytes handled at once by the numpy kernels; a longer text is a batch of its own.
CHUNK_BYTES = 500_000
#: Bytes of a batch that Spark hands to Python.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Keys holding at least 1/HEAVY_SHARE of all rows are looked up by broadcast (there are at most HEAVY_SHARE of them).
HEAVY_SHARE = 512
#: Width of the bit tables of ids: 2**24 bits are 2 MB.
ID_BITS = 24

_SEED = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _SEED.integers(1, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def written(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends at files that all executors see.

    ``file_rows``: most rows of a file, for very wide rows (0: no limit); readers hold a file's rows together.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let Spark hand texts to Python in batches of 8 MB, or of ``most`` bytes, at most (its own limit is 64 MB): it bounds the workers' memory."""
    size, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(_BATCH_CONF).lower()).groups()
    if int(size) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit] > most:
        spark.conf.set(_BATCH_CONF, str(most))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, then free memory goes back to the system: Spark keeps its Python workers for later tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def swept(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of steps that are done: it does so when the driver collects their plans as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


# ---------------------------------------------------------------- numpy kernels


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, self.base, dtype=np.uint64))), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, self.inverse, dtype=np.uint64))), dtype=np.uint64)
        return self.up, self.down


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and text borders of an Arrow string array; a null is an empty text."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def window_hashes(hashes: np.ndarray, n: int, other: bool = False) -> np.ndarray:
    """Hash of the n words from each word on (0 at the end); ``other``: a second, independent one."""
    m = len(hashes)
    hashes = mix(hashes ^ np.uint64(0xA0761D6478BD642F)) if other else hashes
    out = np.zeros(m, dtype=np.uint64)
    if m >= n:
        up, down = _WORDS.get(m + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:m], dtype=np.uint64)))
            out[: m - n + 1] = mix((total[n:] - total[:-n]) * down[: m - n + 1] + np.uint64(n))
    return out


class Words:
    """Words of a batch of texts: byte borders, the texts' first words, and 64-bit hashes.

    ``gaps`` says which of the 256 bytes (after folding) are in no word; all others must be whole characters or not ASCII.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, gaps: np.ndarray = _SPACE):
        self.raw, self.borders = text_bytes(texts)
        raw = _LOWER[self.raw] if lower else self.raw
        solid = ~gaps[raw]
        before, after = np.empty_like(solid), np.empty_like(solid)
        if len(solid):
            before[0], before[1:] = False, solid[:-1]
            after[-1], after[:-1] = False, solid[1:]
            cuts = self.borders[1:-1]
            before[cuts[cuts < len(solid)]] = False
            after[cuts[cuts > 0] - 1] = False
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        #: word range of text i: first[i] .. first[i + 1]
        self.first = np.searchsorted(self.starts, self.borders)
        up, down = _BYTES.get(len(raw) + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)))
            self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def windows(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on (those that leave the batch: 0)."""
        return window_hashes(self.hashes, n)

    def inside(self, n: int) -> np.ndarray:
        """Whether the n words from each word on lie in one text."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        return np.arange(len(self.hashes)) + n <= last


def shingle_sets(texts: pa.Array, n: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles; a shorter text is one shingle, an empty one none."""
    words = Words(texts, lower)
    hashes, whole = words.windows(n), {}
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(hashes[a : b - n + 1])
        elif b > a:
            k = b - a
            if k not in whole:
                whole[k] = words.windows(k)
            yield whole[k][a : a + 1]
        else:
            yield hashes[:0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about this many bytes of text, whole rows each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + size, "right")))
        yield batch.slice(at, to - at)
        at = to


# ------------------------------------------------------------------- sketches

_BLOCK = 1 << 18
#: Tables of tasks that one group merges; three levels of groups take in FAN**2 times as many tasks as the last group has tables.
FAN = 64
SKETCH_SCHEMA = "block int, task long, data binary"


def _blob(block: int, task: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "task": pa.array([task], pa.int64()), "data": pa.array([zlib.compress(data, 1)], pa.binary())})


def _merged(rows: DataFrame, add: Callable[[np.ndarray, np.ndarray], np.ndarray], dtype: str) -> Iterator[tuple[int, np.ndarray]]:
    """Each block's tables of all tasks, added up in levels, so that no group reads the tables of all tasks.

    A group holds two tables at a time.  Only the last level's sums come to the driver.
    """

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("data"):
                part = np.frombuffer(zlib.decompress(data.as_py()), dtype=dtype)
                total = part if total is None else add(total, part)
        yield _blob(key[0].as_py(), key[1].as_py(), total.tobytes())

    for fan in (FAN, FAN, 2**62):
        rows = rows.withColumn("task", F.floor(F.col("task") / fan)).groupBy("block", "task").applyInArrow(merge, SKETCH_SCHEMA)
    for row in rows.collect():
        yield row.block, np.frombuffer(zlib.decompress(row.data), dtype=dtype)


def sketch_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's counters as compressed blocks, for ``merged_sketch``."""
    task = TaskContext.get().partitionId()
    for k in range(0, len(counts), _BLOCK):
        part = counts[k : k + _BLOCK]
        if part.any():
            yield _blob(k // _BLOCK, task, part.astype(np.uint32).tobytes())


def merged_sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Sums (at most 2**32 - 1) of all tasks' counters: ``width`` numbers, whatever the input's size."""

    def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(a.astype(np.uint64) + b, 2**32 - 1).astype(np.uint32)

    out = np.zeros(width, dtype=np.uint32)
    for block, part in _merged(rows, add, "uint32"):
        out[block * _BLOCK : block * _BLOCK + len(part)] = part
    return out


def bit_rows(seen: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's bits (seen; seen twice), packed, as compressed blocks, for ``merged_flags``."""
    task = TaskContext.get().partitionId()
    for k in range(0, len(seen), _BLOCK):
        if seen[k : k + _BLOCK].any():
            yield _blob(k // _BLOCK, task, seen[k : k + _BLOCK].tobytes() + twice[k : k + _BLOCK].tobytes())


def flag_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The same for a task's counters of 0, 1 or 2."""
    return bit_rows(np.packbits(counts > 0), np.packbits(counts > 1))


def merged_flags(rows: DataFrame, width: int) -> np.ndarray:
    """Bits of the places that tasks have seen twice or more in all: ``width`` bits, whatever the input's size."""

    def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        (seen, twice), (more, again) = a.reshape(2, -1), b.reshape(2, -1)
        return np.concatenate((seen | more, twice | again | (seen & more)))

    out = np.zeros(-(-width // 8), dtype=np.uint8)
    for block, part in _merged(rows, add, "uint8"):
        out[block * _BLOCK : block * _BLOCK + len(part) // 2] = part[len(part) // 2 :]
    return out


def flagged(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The bits at these places, as booleans."""
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0


def count_two(table: np.ndarray, at: np.ndarray) -> None:
    """Add to counters that stop at 2."""
    at, number = np.unique(at, return_counts=True)
    table[at] = np.minimum(table[at] + np.minimum(number, 2), 2)


#: Hash values that a task holds before it deals them out; bits of a value by which a block's values are dealt to several groups.
HELD_VALUES, GROUP_BITS = 1 << 21, 2
DEALT_SCHEMA = "part int, data binary"
_BLOCK_BITS = _BLOCK.bit_length() + 2


def dealt(values: Iterable[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's hash values as 4 bytes each, by the part of a table of 2**bits bits that they belong to, for ``repeated_flags``.

    The 4 bytes are the place in the block and, in what is left, bits of the value that the place has not; so
    values differ by bits + 13 bits (34 for small tables).  Of equal values two are enough.
    """
    inner = min(bits, _BLOCK_BITS)
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        value = np.concatenate(held)
        place = value & np.uint64((1 << bits) - 1)
        more = value >> np.uint64(bits)
        part = (place >> np.uint64(inner)) << np.uint64(GROUP_BITS) | (more >> np.uint64(32 - inner)) & np.uint64((1 << GROUP_BITS) - 1)
        keys = part << np.uint64(32) | (place & np.uint64((1 << inner) - 1)) << np.uint64(32 - inner) | more & np.uint64((1 << (32 - inner)) - 1)
        keys.sort()
        some = np.ones(len(keys), dtype=bool)
        some[2:] = keys[2:] != keys[:-2]
        keys = keys[some]
        part = (keys >> np.uint64(32)).astype(np.int32)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(part)), bool), part[1:] != part[:-1])))
        offsets = pa.py_buffer((np.append(first, len(part)) * 4).astype(np.int32).tobytes())
        data = pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(keys.astype(np.uint32).tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(part[first]), data], names=["part", "data"])

    for value in values:
        held.append(value)
        size += len(value)
        if size > HELD_VALUES:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def repeated_flags(rows: DataFrame, bits: int) -> np.ndarray:
    """Bits of the places of values that tasks have dealt twice or more in all: values that are alone set none, however many they are."""
    inner = min(bits, _BLOCK_BITS)

    def mark(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.concatenate([np.frombuffer(data.as_buffer(), dtype=np.uint32) for batch in batches for data in batch.column("data")])
        values.sort()
        again = np.zeros(1 << inner, dtype=bool)
        again[values[1:][values[1:] == values[:-1]] >> np.uint32(32 - inner)] = True
        part, found = key[0].as_py(), np.packbits(again).tobytes()
        yield _blob(part >> GROUP_BITS, part & ((1 << GROUP_BITS) - 1), found + found)

    return merged_flags(rows.groupBy("part").applyInArrow(mark, SKETCH_SCHEMA), 1 << bits)


# ------------------------------------------------------------- joins and links


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores before those that ``df`` has already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Iterable[str]) -> list[T.StructField]:
    """The fields of ``df`` but for columns that results of these names replace."""
    gone = {n.lower() for n in names}
    return [f for f in df.schema if f.name.lower() not in gone]


def place(column: Column | str, bits: int) -> Column:
    """A value's bit in the tables of ``marked``; nulls have one, too."""
    return F.pmod(F.xxhash64(column), F.lit(1 << bits))


def mark_places(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bits of the places in the first column, for ``merged_flags``; a task holds them packed."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(-(-(1 << bits) // 8), dtype=np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy()
            np.bitwise_or.at(table, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
        yield from bit_rows(table, table)

    return mark


def marked(ids: DataFrame, bits: int) -> Broadcast:
    """The bits of all values in the only column of ``ids``, broadcast."""
    places = ids.select(place(ids.columns[0], bits).alias("place"))
    return ids.sparkSession.sparkContext.broadcast(merged_flags(places.mapInArrow(released(mark_places(bits)), SKETCH_SCHEMA), 1 << bits))


def parted(rows: DataFrame, id_col: str, ids: DataFrame, bits: int = ID_BITS) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose id may be among the only column of ``ids`` (nulls match), and the rows whose id is not.

    A table of 2**bits bits, broadcast, tells them apart, so that a join has to
    shuffle the first part only.  With far more ids than bits all rows are in it.
    """
    marks = marked(ids, bits)
    (at,) = fresh(rows, "_place")
    named = rows.withColumn(at, place(id_col, bits))

    def only(inside: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(flagged(marks.value, batch.column(at).to_numpy().astype(np.uint64)) == inside))

        return named.mapInArrow(released(run), named.schema).drop(at)

    return only(True), only(False)


def lookup(rows: DataFrame, found: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``found`` for the same ``key`` (one row each), inner.

    ``weight`` is the number of rows that hold the key, ``total`` their sum or
    more.  Keys with total/HEAVY_SHARE rows or more, of which there can be no
    more than HEAVY_SHARE, are broadcast, so that their rows stay where they
    are; the others are shuffled, and none of them is hot.
    """
    heavy = F.col(weight) * HEAVY_SHARE >= max(total, HEAVY_SHARE * 64)
    hot, cold = found.filter(heavy).drop(weight), found.filter(~heavy).drop(weight)
    near = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return near.unionByName(rest)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over the edges, for every node on an edge.

    Alternates large-star and small-star steps; each round's edges are written,
    so a lost executor repeats one round at most.  Both steps group by node
    with a minimum that combines before the shuffle.
    """
    work = written(
        edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter("x <> y").distinct(), "links"
    )
    for _ in range(max_rounds):
        # Settled: every node has one smaller neighbour, and none of these has one itself.
        ends = F.array(*(F.struct(F.col(c).alias("node"), F.lit(int(c == "x")).alias("up"), F.lit(int(c == "y")).alias("down")) for c in ("x", "y")))
        nodes = work.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
        if nodes.filter("up > 1 or up = 1 and down = 1").isEmpty():
            break
        both = work.unionByName(work.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("m", "x"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.filter("x > y").distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").select(F.explode(F.array(F.struct(F.col("y").alias("x"), F.col("m").alias("y")), F.struct(F.col("x"), F.col("m").alias("y")))).alias("e")).select("e.*")
        work = written(small.filter("x > y").distinct(), "links")
    else:
        raise RuntimeError(f"links have not settled in {max_rounds} rounds")
    return work.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(
        work.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    )
