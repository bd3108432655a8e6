"""Conversation prefix trie by composable fingerprints.

Every conversation c is rebuilt: the first h turns of its base (c - c % ``block``), then
its own turns after its first h; h = crc32(c as text) % ``heads``.  A node of the trie
is a distinct sequence of first d rebuilt turns.

A sequence of n turns has the fingerprint sum(t[k] * B**k, k < n) modulo 2**64, twice (for
two independent t).  These form a monoid: (n, f) (m, g) = (n + m, f + B**n * g), and since
B is odd a known head can be taken off again.  So:

1. Turns are reduced to a 120-bit digest and a number of words.  They are dealt by ranges
   of (conversation, turn, digest) and scanned in that order, which gives each turn the
   product of its conversation's turns so far.  A conversation that goes on in
   the next part takes the products of its earlier parts from a broadcast table of the
   conversations at the parts' borders (two a part at most), so that a long conversation
   is spread over many tasks.
2. Rebuilt prefixes are products of a base head and an own suffix, combined from the
   fingerprints alone; no rebuilt text is ever made.
3. Prefixes group by (depth, fingerprint), with counts and minima that combine before the
   shuffle.  A group refers to its last turn's digest: all members must agree on it (by
   least and greatest), and equal digests make the groups of the parents equal, too, so
   agreement at all depths proves the sequences equal.  Should two sequences share a
   fingerprint, all is done again with other t.
4. Sums over subtrees need no walk.  A node's first member carries it; s(c, d) are the words
   of c from depth d on.  Words of all members below a node: the sum of s over its
   members.  Words of the distinct nodes below it: each member c adds s from the depth on
   at which c begins to be a first member, or from the node on if that is deeper.
   Leaves: the members that are the first ones of a childless node.
5. Ids that end at a node are sorted by ranges of (node, id), joined within the tasks to
   pieces, and a node's pieces are hashed in order, as a stream.

Defined results: null turns come first, ties go by digest; null roles and texts are empty;
rows with a null conversation id belong to no conversation.  Equal rows are turns of their
own.  Conversations without turns after the rebuilding are members of the root.  An empty
table has no nodes.  Very long texts are hashed whole.  Other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import lookup, mix, released, written

BLOCK, HEADS, SEEDS = 20, 4, 5
PIECE_BYTES = 1 << 16
_BASE = 0xD1342543DE82EF95
_NODE = ["depth", "f1", "f2"]


def _powers(k: np.ndarray) -> np.ndarray:
    """_BASE ** k modulo 2**64, also for negative k."""
    out = np.ones(len(k), dtype=np.uint64)
    for sign, base in ((1, _BASE), (-1, pow(_BASE, -1, 2**64))):
        left = np.where(k * sign > 0, k * sign, 0)
        while left.any():
            with np.errstate(over="ignore"):
                out = np.where(left & 1, out * np.uint64(base), out)
            left, base = left >> 1, base * base % 2**64
    return out


#: Gives the two t of turns from the halves of their digests and a seed.
Lanes = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def mixed(d1: np.ndarray, d2: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(mix(d.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)) for d in (d1, d2))


def _longs(batch: pa.RecordBatch, *columns: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]


def turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, d1, d2, words, row): each turn's digest and number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(F.col("_d"), at, 15), 16, 10).cast("long")
    named = rows.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("_d"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")).filter("conv is not null")
    return written(named.select("conv", "turn", half(1).alias("d1"), half(16).alias("d2"), "words", F.monotonically_increasing_id().alias("row")), "trie-turns")


def _scanned(placed: DataFrame, seed: int, lanes: Lanes) -> DataFrame:
    """(conv, part, k, f1, f2, total, d1, d2, words): products of turns so far, within each part."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, k, sums = None, 0, (np.uint64(0), np.uint64(0), 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, d1, d2, words = _longs(batch, "conv", "d1", "d2", "words")
            begin = np.flatnonzero(np.concatenate(([own[0] != conv], own[1:] != own[:-1])))
            run = np.searchsorted(begin, np.arange(len(own)), "right")  # 0: goes on from the batch before
            place = np.arange(len(own)) - np.concatenate(([-k], begin))[run]
            power, out = _powers(place), []
            for values, before in zip((*lanes(d1, d2, seed), words), sums, strict=True):
                with np.errstate(over="ignore"):
                    total = np.cumsum(values * power if values.dtype == np.uint64 else values, dtype=values.dtype)
                    start = np.concatenate((np.zeros(1, values.dtype) - values.dtype.type(before), np.concatenate((np.zeros(1, values.dtype), total))[begin]))
                    out.append(total - start[run])
            conv, k, sums = own[-1], int(place[-1]) + 1, tuple(x[-1] for x in out)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("part"), pa.array(place + 1), pa.array(out[0].view(np.int64)), pa.array(out[1].view(np.int64)), pa.array(out[2]), batch.column("d1"), batch.column("d2"), batch.column("words")], names=["conv", "part", "k", "f1", "f2", "total", "d1", "d2", "words"])

    return placed.mapInArrow(released(scan), "conv long, part int, k long, f1 long, f2 long, total long, d1 long, d2 long, words long")


def products(turn_rows: DataFrame, seed: int, lanes: Lanes) -> DataFrame:
    """(conv, k, f1, f2, total, d1, d2, words): the product of each conversation's first k turns, k from 1."""
    order = ["conv", F.col("turn").asc_nulls_first(), "d1", "d2", "row"]
    placed = turn_rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", F.spark_partition_id().alias("part"), "d1", "d2", "words")
    scanned = written(_scanned(placed, seed, lanes), "trie-products")
    # Conversations in more than one part lie across borders of parts: their number is bounded by that of the parts.
    ends = scanned.groupBy("conv", "part").agg(F.max("k").alias("n"), F.max_by("f1", "k").alias("f1"), F.max_by("f2", "k").alias("f2"), F.max("total").alias("total"))
    across = ends.groupBy("conv").agg(F.count("*").alias("_n")).filter("_n > 1").select("conv")
    ahead: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    so_far, last = (0, 0, 0, 0), None
    for r in ends.join(across, "conv", "left_semi").orderBy("conv", "part").collect():
        so_far = so_far if r.conv == last else (0, 0, 0, 0)
        ahead[r.conv, r.part] = so_far
        power = pow(_BASE, so_far[0], 2**64)
        so_far, last = (so_far[0] + r.n, (so_far[1] + power * r.f1) % 2**64, (so_far[2] + power * r.f2) % 2**64, so_far[3] + r.total), r.conv
    held = turn_rows.sparkSession.sparkContext.broadcast({k: v for k, v in ahead.items() if v[0]})
    names = ["conv", "k", "f1", "f2", "total", "d1", "d2", "words"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, k, f1, f2, total = (x.copy() for x in _longs(batch, "conv", "part", "k", "f1", "f2", "total"))
            f1, f2 = f1.view(np.uint64), f2.view(np.uint64)
            for (c, p), (n, a, b, t) in held.value.items():
                at = (conv == c) & (part == p)
                if at.any():
                    with np.errstate(over="ignore"):
                        power = np.uint64(pow(_BASE, n, 2**64))
                        f1[at], f2[at] = f1[at] * power + np.uint64(a), f2[at] * power + np.uint64(b)
                    k[at], total[at] = k[at] + n, total[at] + t
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(k), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(total), *(batch.column(c) for c in names[5:])], names=names)

    return scanned.mapInArrow(released(whole), ", ".join(f"{c} long" for c in names)) if held.value else scanned.select(names)


def paths(turn_rows: DataFrame, block: int, heads: int, seed: int, lanes: Lanes) -> DataFrame:
    """(conv, depth, f1, f2, d1, d2, words, below, ends) of every prefix of every rebuilt conversation.

    d1, d2 and words are of its last turn; below: words from this turn on; ends: it is the whole.
    """
    rows = products(turn_rows, seed, lanes)
    own = (F.crc32(F.col("conv").cast("string")) % heads).alias("h")
    rows = rows.select("*", own)
    cut = lambda c: F.coalesce(F.max(F.when(F.col("k") == F.col("h"), F.col(c))), F.lit(0).cast("long"))
    convs = rows.groupBy("conv", "h").agg(F.max("k").alias("n"), F.max("total").alias("all"), cut("f1").alias("c1"), cut("f2").alias("c2"), cut("total").alias("c"))
    turn = F.struct("k", "f1", "f2", "total", "d1", "d2", "words")
    bases = rows.filter((F.col("conv") % block == 0) & (F.col("k") < heads)).groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("head"))
    frames = convs.withColumn("base", F.col("conv") - F.col("conv") % block).join(bases.withColumnRenamed("conv", "base"), "base", "left")
    frames = frames.withColumn("head", F.slice(F.coalesce("head", F.array().cast(bases.schema["head"].dataType)), 1, F.col("h").cast("int")) if heads > 1 else F.array().cast(bases.schema["head"].dataType))
    last = F.try_element_at("head", F.lit(-1))
    zero = F.lit(0).cast("long")
    frames = frames.select("conv", "n", "h", "c1", "c2", "c", "head", F.size("head").cast("long").alias("hb"), *(F.coalesce(last[x], zero).alias(y) for x, y in (("f1", "b1"), ("f2", "b2"), ("total", "b"))), F.greatest(F.col("n") - F.col("h"), zero).alias("left"), F.when(F.col("n") > F.col("h"), F.col("all") - F.col("c")).otherwise(zero).alias("rest"))
    frames = written(frames, "trie-frames")
    total = frames.agg(F.sum("n")).first()[0] or 0
    ours = lookup(rows.filter("k > h").drop("h"), frames.drop("head"), "conv", "n", total)

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h, hb, whole, cut, base, rest, words, left = _longs(batch, "k", "h", "hb", "total", "c", "b", "rest", "words", "left")
            f = []
            for x, y, z in (("f1", "c1", "b1"), ("f2", "c2", "b2")):
                mine, off, on = (v.view(np.uint64) for v in _longs(batch, x, y, z))
                with np.errstate(over="ignore"):
                    f.append(pa.array((on + _powers(hb - h) * (mine - off)).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(k - h + hb), *f, batch.column("d1"), batch.column("d2"), batch.column("words"), pa.array(rest - (whole - cut) + words), pa.array(k - h == left)], names=["conv", *_NODE, "d1", "d2", "words", "below", "ends"])

    schema = "conv long, depth long, f1 long, f2 long, d1 long, d2 long, words long, below long, ends boolean"
    suffixes = ours.select("conv", "k", "h", "hb", "f1", "f2", "total", "c1", "c2", "c", "b1", "b2", "b", "rest", "left", "d1", "d2", "words").mapInArrow(released(shift), schema)
    every = frames.select("conv", "hb", "left", (F.col("b") + F.col("rest")).alias("all"), F.explode(F.concat(F.array(F.struct(*(zero.alias(c) for c in ("k", "f1", "f2", "total", "d1", "d2", "words")))), "head")).alias("t"))
    prefixes = every.select("conv", F.col("t.k").alias("depth"), "t.f1", "t.f2", "t.d1", "t.d2", "t.words", (F.col("all") - F.col("t.total") + F.col("t.words")).alias("below"), ((F.col("t.k") == F.col("hb")) & (F.col("left") == 0)).alias("ends"))
    return suffixes.unionByName(prefixes)


def _parents(nodes: DataFrame, seed: int, lanes: Lanes) -> DataFrame:
    """``nodes`` with the fingerprint of each one's parent (g1, g2): the last turn taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, f1, f2, d1, d2 = _longs(batch, *_NODE, "d1", "d2")
            power = _powers(depth - 1)
            with np.errstate(over="ignore"):
                g = [pa.array((f.view(np.uint64) - t * power).view(np.int64)) for f, t in zip((f1, f2), lanes(d1, d2, seed), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *g], names=[*batch.schema.names, "g1", "g2"])

    return nodes.mapInArrow(released(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", g1 long, g2 long")


def _ends(path_rows: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of nodes at which conversations end."""
    ids = written(path_rows.filter("ends").select(*_NODE, "conv"), "trie-ends")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_NODE, "first", "ids"]
        for batch in batches:
            node = np.stack(_longs(batch, *_NODE))
            conv = batch.column("conv").to_pylist()
            cuts = np.flatnonzero(np.concatenate(([True], (node[:, 1:] != node[:, :-1]).any(axis=0), [True])))
            step = PIECE_BYTES // 20
            spans = [(a, min(a + step, e)) for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) for a in range(s, e, step)]
            if spans:
                at = pa.array([a for a, _ in spans])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in [*_NODE, "conv"]), pa.array([",".join(map(str, conv[a:b])) for a, b in spans])], names=names)

    pieces = ids.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv").mapInArrow(released(join), "depth long, f1 long, f2 long, first long, ids string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def made(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k, _ in found], pa.int64()) for i in range(3)), pa.array([h for _, h in found])], names=[*_NODE, "ends_sha256"])

        for batch in batches:
            found = []
            for *key, ids_ in zip(*(batch.column(c).to_pylist() for c in [*_NODE, "ids"]), strict=True):
                if key == now:
                    state.update(b",")
                else:
                    found += [(now, state.hexdigest())] if state else []
                    now, state = key, hashlib.sha256()
                state.update(ids_.encode())
            if found:
                yield made(found)
        if state:
            yield made([(now, state.hexdigest())])

    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(released(digest), "depth long, f1 long, f2 long, ends_sha256 string")


def trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK, heads: int = HEADS, lanes: Lanes = mixed) -> DataFrame:
    """A row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``lanes`` gives the fingerprint's t; another seed is used when two turns in one place share theirs.
    """
    if block < 1 or heads < 1:
        raise ValueError("block and heads must be 1 or more")
    kept = turns(rows, conv_col, turn_col, role_col, text_col)
    for seed in range(SEEDS):
        path_rows = written(paths(kept, block, heads, seed, lanes), "trie-paths")
        found = path_rows.groupBy(*_NODE).agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.sum("below").alias("below"), F.min_by("below", "conv").alias("first_below"),
            F.min("d1").alias("d1"), F.min("d2").alias("d2"), (F.min("d1") != F.max("d1")).alias("_x"), (F.min("d2") != F.max("d2")).alias("_y"),
        )
        found = written(_parents(found, seed, lanes), "trie-nodes")
        if found.filter("_x or _y").isEmpty():
            break
    else:
        raise RuntimeError(f"different turns have equal fingerprints for {SEEDS} seeds")
    key = F.struct(*_NODE)
    children = found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(F.count("*").alias("n_children"))
    nodes = written(found.join(children, _NODE, "left").fillna(0, ["n_children"]), "trie-tree")
    # Of conversations that come first in a node: their words from the first such node on, whether they name a leaf, their rows.
    firsts = written(nodes.groupBy("conv").agg(F.max("first_below").alias("from_first"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"), (F.max("depth") + 1).alias("n")), "trie-firsts")
    members = lookup(path_rows.select("conv", *_NODE, "below"), firsts, "conv", "n", path_rows.count())
    sums = members.groupBy(*_NODE).agg(F.sum(F.least("below", "from_first")).alias("distinct_below"), F.sum("leaf").alias("n_leaves"))
    # A node with very many children is looked up by broadcast.
    parent = nodes.filter("n_children > 0").select(key.alias("key"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("n"))
    up = nodes.filter("depth > 0").select(*_NODE, F.struct((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")).alias("key"))
    up = lookup(up, parent, "key", "n", nodes.count()).drop("key")
    out = nodes.join(sums, _NODE).join(up, _NODE, "left").join(_ends(path_rows), _NODE, "left")
    return out.select(
        F.col("conv").alias(conv_col), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("below") - F.col("distinct_below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
