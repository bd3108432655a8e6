"""N-gram Jaccard join: rare-first prefix, length, positional and suffix filters; each pair verified once.

A document's set holds the distinct n-word shingles of its lower-cased text.
Two documents link when 100 * |intersection| >= percent * |union|.

1. Frequencies of shingles over all documents, in a table of fixed width
   (2**sketch_bits counters on a scale of logarithms): any fixed total order gives
   right results, frequencies make the first shingles rare ones.
2. Equal sets become one set ``sid``, with members.  Each set's rare-first prefix,
   size - ceil(percent * size) + 1 shingles, is spread over rows (token, sid, size,
   position).  These are dealt by ranges of (token, sid), so that a token of many sets
   spreads over tasks, and tokens of one set alone are dropped as they stream by.
3. Candidates share a prefix token and pass the length filter (percent * larger <=
   100 * smaller), the positional one (what can follow in both is enough) and
   the suffix filter: sets have a signature of about a bit for each shingle (bit k: parity
   of the shingles that hash to k), and the Hamming distance of two signatures
   is a lower bound of that of the sets, whatever their size.
4. A pair that passes is verified once, on the whole sets, which are made again
   for the sets in such pairs only.  Pairs judged before are left out.

Classes need no pair within what is already linked.  Rounds of hubs compare
one set of each token with its others, then some members of its largest class, and
one outsider, with the sets outside; linked sets get a common class.  Then every pair
of classes that share a token is decided.  Jaccard distances obey the triangle
inequality: if the first set of a class has distance r at most to its members, and the
signatures prove a distance over r + (100 - percent) / 100 to another set, that one
links with no member, and no pair of it is listed.  What is left is listed
token by token, lists being cut to pieces of ``CHUNK`` rows, and verified.  So
classes are exact, a group of k near copies costs about k pairs, and two groups
of k and m sets that share tokens cost about k + m.  No round caps partners or candidates.

Sets are known by 64-bit hashes of shingles and of sets.

Defined results: null or empty texts and texts without words have no shingle
and link with nothing; fewer than n words are one shingle, the whole sequence.
Rows with the same id keep a row each, with the smallest root of their texts'
classes; null ids keep a row and never name a class.  Of other columns none is
used or returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import SKETCH_SCHEMA, chunks, components, drop, flagged, fresh, lookup, marked, merged_sketch, mix, parted, place, released, shingle_sets, sketch_rows, written

SKETCH_BITS = 24
#: Rounds of hubs; members of a class that are hubs after the first round; rows of a token (or of a class in it) that one task compares with as many others; wanted documents that are broadcast; of more, 2**REF_BITS bits are.
HUB_ROUNDS, HUBS, CHUNK, FEW_REFS, REF_BITS = 2, 8, 1000, 50_000, 27


def _sid(shingles: np.ndarray) -> int:
    """64-bit name of a set; the order of the sum does not matter."""
    with np.errstate(over="ignore"):
        return int(mix(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)[None] + np.uint64(len(shingles)))[0].astype(np.int64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of the shingles by hash; as many as the next power of two from 64 and their number."""
    width = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(9)) & np.uint64(width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the number of shingles that are in one of the two sets only.

    The longer signature is folded to the shorter one's width: parities add up.
    """
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def frequencies(docs: DataFrame, n: int, bits: int) -> np.ndarray:
    """How many documents hold a shingle of each of 2**bits hash values, over all documents: 1024 * log2(1 + n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, mask = np.zeros(1 << bits, dtype=np.uint16), np.uint64((1 << bits) - 1)
        for batch in batches:
            for part in chunks(batch):
                sets = [s for s in shingle_sets(part.column("text"), n) if len(s)]
                if sets:
                    at, number = np.unique((np.concatenate(sets) & mask).astype(np.uint32), return_counts=True)
                    table[at] = np.minimum(table[at] + number, 65_535)
        yield from sketch_rows(table)

    # Sums on a scale of logarithms: 16 bits tell frequent shingles from rare ones at any size of the corpus.
    return np.round(np.log2(merged_sketch(docs.mapInArrow(released(count), SKETCH_SCHEMA), 1 << bits) + 1.0) * 1024).astype(np.uint16)


def _prefix_size(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _described(docs: DataFrame, n: int) -> DataFrame:
    """(id, ref, n_shingles, sid, signature) of every row; ref names the row by its id and text."""
    rows = docs.select("id", "text", F.xxhash64("id", "text").alias("ref"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = list(shingle_sets(part.column("text"), n))
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([_sid(s) if len(s) else None for s in sets], pa.int64()), pa.array([signature(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ref"), *columns], names=["id", "ref", "n_shingles", "sid", "signature"])

    return rows.mapInArrow(released(run), f"id {id_type}, ref long, n_shingles long, sid long, signature array<long>")


def _prefix_rows(docs: DataFrame, table, n: int, percent: int) -> DataFrame:
    """(token, sid, size, at) of all prefix tokens of the sets, each set once in a task at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = table.value, set()
        mask = np.uint64(len(counts) - 1)
        for batch in batches:
            for part in chunks(batch):
                tokens, heads, sizes = [], [], []
                for s in shingle_sets(part.column("text"), n):
                    if not len(s) or (sid := _sid(s)) in seen:
                        continue
                    seen.add(sid)
                    k = _prefix_size(len(s), percent)
                    # Rare first, ties by hash: sets come sorted by hash.
                    tokens.append(s[np.argsort(counts[s & mask], kind="stable")[:k]])
                    heads.append((sid, len(s)))
                    sizes.append(k)
                if tokens:
                    head = np.repeat(np.array(heads, dtype=np.int64), sizes, axis=0)
                    at = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).astype(np.int64)), pa.array(head[:, 0]), pa.array(head[:, 1].astype(np.int32)), pa.array(at)], names=["token", "sid", "size", "at"])

    return docs.select("text").mapInArrow(released(run), "token long, sid long, size int, at int")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows of tokens that more than one set holds, each once; the first and last token of a part may be in one set alone.

    Ranges of (token, sid) split a token of many sets, and a part streams by in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True  # the last row, whose next one is not known; whether its token is the part's first or that of the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
            token, sid = (table.column(c).to_numpy() for c in ("token", "sid"))
            new = np.concatenate(([True], (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])))
            table, token = table.filter(pa.array(new)), token[new]
            same = token[1:] == token[:-1]
            keep = np.concatenate(([first], same)) | np.concatenate((same, [False]))
            held, first = table.slice(table.num_rows - 1), bool(keep[-1])
            yield table.slice(0, table.num_rows - 1).filter(pa.array(keep[:-1]))
        if held is not None:
            yield held

    return rows.repartitionByRange("token", "sid").sortWithinPartitions("token", "sid").mapInArrow(released(run), rows.schema)


# ---------------------------------------------------------------------- filters


def _least(percent: int, sizes) -> Column:
    """Shingles that sets of these sizes (their sum) must share."""
    return F.ceil(percent * sizes / (100 + percent) - 1e-9)


def _may_link(percent: int, a, b) -> Column:
    """Length and positional filter of two rows (structs) that share a token."""
    ahead = F.least(a["size"] - a["at"], b["size"] - b["at"])
    length = percent * F.greatest(a["size"], b["size"]) <= 100 * F.least(a["size"], b["size"])
    return length & (ahead >= _least(percent, a["size"] + b["size"]))


def _may_be_near(percent: int, a, b) -> Column:
    """Suffix filter of two rows (structs) with signatures of one width; others pass here and are compared by ``apart``."""
    sizes = a["size"] + b["size"]
    bits = F.aggregate(F.zip_with(a["signature"], b["signature"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    return (F.size(a["signature"]) != F.size(b["signature"])) | (bits <= sizes - 2 * _least(percent, sizes))


def _unordered(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) once, whichever way round, as (lo, hi, a, b)."""
    found = pairs.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.min("a").alias("a"))
    return found.select("lo", "hi", "a", F.when(F.col("a") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b"))


def _with_apart(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b and more) with sizes sa, sb and ``apart``: signatures are fetched for this alone."""
    side = lambda c, size, sig: sets.select(F.col("sid").alias(c), F.col("n_shingles").alias(size), F.col("signature").alias(sig))
    both = pairs.join(side("a", "sa", "_x"), "a").join(side("b", "sb", "_y"), "b")
    names = [*pairs.columns, "sa", "sb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [apart(*(v.values.to_numpy().view(np.uint64) for v in pair)) for pair in zip(batch.column("_x"), batch.column("_y"), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.int64())], names=[*names, "apart"])

    return both.select(*names, "_x", "_y").mapInArrow(released(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.select(*names).schema) + ", apart long")


# ----------------------------------------------------------------- verification


def _sets(docs: DataFrame, sets: DataFrame, pairs: DataFrame, n: int, name: str) -> DataFrame:
    """(sid, shingles, is_a, is_b) of the sets in these pairs (and maybe of others), made from one row of each."""
    side = lambda c: F.struct(F.col(c).alias("sid"), F.lit(c == "a").alias("is_a"), F.lit(c == "b").alias("is_b"))
    asked = pairs.select(F.explode(F.array(side("a"), side("b"))).alias("x")).select("x.*")
    asked = asked.groupBy("sid").agg(F.max("is_a").alias("is_a"), F.max("is_b").alias("is_b"))
    refs = sets.select("sid", "ref").join(asked, "sid")
    refs = written(refs.groupBy("ref").agg(F.max("is_a").alias("is_a"), F.max("is_b").alias("is_b")), "set-rows")
    rows = docs.select("text", F.xxhash64("id", "text").alias("ref"))
    few = refs.count() <= FEW_REFS
    marks = None if few else marked(refs.select("ref"), REF_BITS)
    if few:
        rows = rows.join(F.broadcast(refs), "ref").select("text", "is_a", "is_b")
    else:
        rows = rows.select("text", F.lit(True).alias("is_a"), F.lit(True).alias("is_b"), place("ref", REF_BITS).alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            # Here and not in a step before this one, which would have Python workers of its own.
            if marks is not None:
                batch = batch.filter(pa.array(flagged(marks.value, batch.column("place").to_numpy().astype(np.uint64))))
            for part in chunks(batch):
                at, sids, found = [], [], []
                for i, s in enumerate(shingle_sets(part.column("text"), n)):
                    if len(s) and (sid := _sid(s)) not in seen:
                        seen.add(sid)
                        at.append(i)
                        sids.append(sid)
                        found.append(s.astype(np.int64))
                if sids:
                    ends = np.cumsum([0, *map(len, found)])
                    flags = [part.column(c).take(pa.array(at)) for c in ("is_a", "is_b")]
                    yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found))), *flags], names=["sid", "shingles", "is_a", "is_b"])

    whole = written(rows.mapInArrow(released(run), "sid long, shingles array<long>, is_a boolean, is_b boolean"), f"sets-{name}")
    if marks is not None:
        marks.unpersist()
    return whole


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, n: int, name: str) -> DataFrame:
    """``pairs`` (a, b) with sizes sa, sb and the number of shingles they share (common)."""
    whole = _sets(docs, sets, pairs, n, name)
    left = pairs.select("a", "b").join(whole.filter("is_b").select(F.col("sid").alias("b"), F.col("shingles").alias("_y")), "b")
    both = left.join(whole.filter("is_a").select(F.col("sid").alias("a"), F.col("shingles").alias("_x")), "a")
    return written(both.select("a", "b", F.size("_x").alias("sa"), F.size("_y").alias("sb"), F.size(F.array_intersect("_x", "_y")).alias("common")).distinct(), f"verified-{name}")


def _linking(verified: DataFrame, percent: int) -> DataFrame:
    return verified.filter((100 + percent) * F.col("common") >= percent * (F.col("sa") + F.col("sb"))).select("a", "b")


# ----------------------------------------------------------------------- rounds


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("sid"))
    return rows.join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node")


def _dealt(left: DataFrame, right: DataFrame, keys: list[str], condition: Callable) -> DataFrame:
    """The pairs (l, r) of rows with equal keys for which the condition holds.

    The rows of a key (``n_left``, ``n_right`` of them, in both tables) are cut to pieces of about CHUNK
    on either side, and each piece of one side meets each of the other in a task of their own.
    """
    pieces = lambda c: F.ceil(F.col(c) / CHUNK).cast("long")
    sides = []
    for rows, own, other in ((left, "n_left", "n_right"), (right, "n_right", "n_left")):
        mine = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in ("n_left", "n_right")]), pieces(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), pieces(other) - 1))
        pair = (mine.alias("_p"), every.alias("_q")) if own == "n_left" else (every.alias("_p"), mine.alias("_q"))
        sides.append(rows.select(*keys, F.struct(*[c for c in rows.columns if c not in ("n_left", "n_right")]).alias("l" if own == "n_left" else "r"), *pair))
    return sides[0].join(sides[1], [*keys, "_p", "_q"]).filter(condition(F.col("l"), F.col("r"))).select("l", "r")


def _hub_pairs(rows: DataFrame, step: int, percent: int, total: int) -> DataFrame:
    """Pairs (a, b) of a token's sets outside its largest class with HUBS members of that class and with one of their own."""
    own = F.struct("sid", "size", "at", "root")
    order = F.struct(F.xxhash64("sid", F.lit(step)), "sid")
    kind = F.when(F.col("root") == F.col("top"), F.pmod(F.xxhash64("sid", F.lit(-step)), F.lit(HUBS))).otherwise(-1)
    hubs = rows.groupBy("token", kind.alias("_kind")).agg(F.min_by(own, order).alias("hub")).groupBy("token").agg(F.collect_list("hub").alias("hubs"))
    counts = rows.groupBy("token").agg(F.count("*").alias("times"))
    outside = lookup(rows.filter("root <> top"), written(hubs.join(counts, "token"), f"hubs-{step}"), "token", "times", total)
    mine = {c: F.col(c) for c in ("size", "at")}
    fit = F.filter("hubs", lambda h: (h["root"] != F.col("root")) & _may_link(percent, mine, h))
    return outside.select(F.col("sid").alias("b"), F.explode(F.transform(fit, lambda h: h["sid"])).alias("a")).select("a", "b")


def _class_pairs(rows: DataFrame, roots: DataFrame, sets: DataFrame, docs: DataFrame, verified: DataFrame, n: int, percent: int, total: int) -> DataFrame:
    """Pairs (a, b) of sets in different classes that may link; ``rows`` have the token's number of rows and of classes."""
    far = (100 - percent) / 100 + 1e-9
    classes = rows.groupBy("token", "root").agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.max(F.col("size") - F.col("at")).alias("ahead"), F.count("*").alias("k"), F.any_value("n").alias("n"), F.any_value("classes").alias("classes"))
    classes = written(classes, "token-classes")
    counts = (F.col("classes").alias("n_left"), F.col("n").alias("n_right"))
    key = F.struct("token", "root").alias("key")
    # Each row with its class's number of rows in the token: of two classes, the rows of the smaller one meet the larger one.
    own = lookup(rows.withColumn("key", key), classes.select(key, "k", F.col("k").alias("times")), "key", "times", total).drop("key")

    def near(c, y):
        length = (percent * c["lo"] <= 100 * y["size"]) & (percent * y["size"] <= 100 * c["hi"])
        larger = (c["k"] > y["k"]) | ((c["k"] == y["k"]) & (c["root"] < y["root"]))
        return larger & (c["root"] != y["root"]) & length & (F.least(c["ahead"], y["size"] - y["at"]) >= _least(percent, c["lo"] + y["size"]))

    probes = _dealt(classes.select("token", "root", "k", "lo", "hi", "ahead", *counts), own.select("token", "sid", "size", "at", "root", "k", *counts), ["token"], near)
    probes = written(probes.select(F.col("l.root").alias("a"), F.col("r.sid").alias("b")).distinct(), "class-probes")
    # The radius of each class of more than one set among them: distances of all its members from its first set.
    many = probes.select(F.col("a").alias("root")).distinct().join(roots, "root").filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    known = verified.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sa", "sb", "common")
    known = many.join(known, ["a", "b"])
    lacking = written(many.join(known.select("a", "b"), ["a", "b"], "left_anti"), "radius-pairs")
    radius = known
    if not lacking.isEmpty():
        radius = known.unionByName(_verified(lacking, docs, sets, n, "radius"))
    radius = radius.groupBy("a").agg(F.max(1 - F.col("common") / (F.col("sa") + F.col("sb") - F.col("common"))).alias("r"))
    bound = 2 * F.col("apart") / (F.col("sa") + F.col("sb") + F.col("apart"))
    kept = _with_apart(probes, sets).select("a", "b", bound.alias("d")).join(radius, "a", "left").withColumn("single", F.col("r").isNull())
    kept = written(kept.filter(F.col("d") <= far + F.coalesce("r", F.lit(0.0))).select("a", "b", "single"), "class-near")
    alone = kept.filter("single").select("a", "b")
    signed = sets.select("sid", "signature")
    outer = kept.filter("not single").select(F.col("a").alias("root"), F.col("b").alias("sid")).join(rows.select("token", "sid", "size", "at"), "sid")
    sizes = outer.groupBy("token", "root").agg(F.count("*").alias("n_left")).join(classes.select("token", "root", F.col("k").alias("n_right")), ["token", "root"])
    sizes = written(sizes, "class-sizes")
    inner = rows.select("token", "root", "sid", "size", "at").join(sizes, ["token", "root"]).join(signed, "sid")
    members = _dealt(outer.join(sizes, ["token", "root"]).join(signed, "sid"), inner, ["token", "root"], lambda x, y: _may_link(percent, x, y) & _may_be_near(percent, x, y))
    return alone.unionByName(members.select(F.col("l.sid").alias("a"), F.col("r.sid").alias("b")))


def links(docs: DataFrame, text_col: str = "text", n: int = 3, percent: int = 90, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """(node, root) over sets that link with another one: root is the class's smallest sid."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    docs = docs.select(F.lit(None).cast("long").alias("id"), F.col(text_col).alias("text"))
    return _links(docs, written(_described(docs, n), "set-members"), n, percent, sketch_bits)[0]


def _links(docs: DataFrame, described: DataFrame, n: int, percent: int, sketch_bits: int) -> tuple[DataFrame, DataFrame]:
    """(node, root), and the ledger (lo, hi, round) of all pairs that were judged."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequencies(docs, n, sketch_bits))
    rows = written(_prefix_rows(docs, table, n, percent), "prefix-rows")
    table.unpersist()
    shared = written(_shared(rows), "shared-rows")
    drop(rows)
    sets = written(described.filter("sid is not null").groupBy("sid").agg(F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature"), F.min("ref").alias("ref")), "signatures")
    hub = F.min_by(F.struct("sid", "size", "at"), F.struct(F.xxhash64("sid"), "sid")).alias("hub")
    tokens = written(shared.groupBy("token").agg(F.count("*").alias("n"), hub).filter("n > 1").withColumn("times", F.col("n")), "prefix-tokens")
    joined = written(lookup(shared, tokens, "token", "times", shared.count()), "token-rows")
    drop(shared)
    crowd = joined.filter("n > 2").select("token", "sid", "size", "at", "n")
    ledger = spark.createDataFrame([], "lo long, hi long, round int")
    verified = edges = roots = None
    more = joined.filter(F.col("sid") != F.col("hub.sid")).filter(_may_link(percent, {c: F.col(c) for c in ("size", "at")}, F.col("hub"))).select(F.col("hub.sid").alias("a"), F.col("sid").alias("b"))
    for step in range(HUB_ROUNDS + 1):
        if step:
            now = _rooted(crowd, roots)
            kinds = now.groupBy("token", "root").agg(F.count("*").alias("_k"))
            top = kinds.groupBy("token").agg(F.max_by("root", F.struct("_k", "root")).alias("top"), F.count("*").alias("classes"), F.sum("_k").alias("times")).filter("classes > 1")
            now = written(lookup(now, written(top, f"classes-{step}"), "token", "times", joined.count()), f"class-rows-{step}")
            if now.isEmpty():
                break
            if step < HUB_ROUNDS:
                more = _hub_pairs(now, step, percent, joined.count())
            else:
                more = _class_pairs(now, roots if roots is not None else spark.createDataFrame([], "node long, root long"), sets, docs, verified if verified is not None else spark.createDataFrame([], "a long, b long, sa int, sb int, common int"), n, percent, joined.count())
        pairs = written(_unordered(more).join(ledger.select("lo", "hi"), ["lo", "hi"], "left_anti"), f"candidates-{step}")
        if pairs.isEmpty():
            continue
        ledger = ledger.unionByName(pairs.select("lo", "hi", F.lit(step).alias("round")))
        near = _with_apart(pairs.select("a", "b"), sets)
        near = written(near.filter(F.col("apart") <= F.col("sa") + F.col("sb") - 2 * _least(percent, F.col("sa") + F.col("sb"))).select("a", "b"), f"near-{step}")
        if near.isEmpty():
            continue
        found = _verified(near, docs, sets, n, str(step))
        verified = found if verified is None else verified.unionByName(found)
        edges = _linking(verified, percent)
        roots = components(edges)
    return (roots if roots is not None else spark.createDataFrame([], "node long, root long")), ledger


def _classes(docs: DataFrame, n: int, percent: int, sketch_bits: int) -> DataFrame:
    """(id, ref, n_shingles, sid, root) of every row of ``docs`` (id and text): the first sid of its class."""
    described = written(_described(docs, n), "set-members")
    roots, _ = _links(docs, described, n, percent, sketch_bits)
    times = described.filter("sid is not null").groupBy("sid").agg(F.count("*").alias("n"))
    bysid = written(times.join(roots, F.col("sid") == F.col("node"), "left").select("sid", "n", F.coalesce("root", "sid").alias("root")), "set-classes")
    own = described.drop("signature")
    linked = lookup(own.filter("sid is not null"), bysid, "sid", "n", own.count())
    return written(linked.select("id", "ref", "n_shingles", "sid", "root").unionByName(own.filter("sid is null").select("id", "ref", "n_shingles", "sid", F.col("sid").alias("root"))), "row-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (the smallest id reachable over links, its own included)."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    rows = _classes(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), n, percent, sketch_bits)
    named = rows.filter("root is not null").groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    linked = lookup(rows.filter("root is not null"), written(named, "class-names"), "root", "n", rows.count()).select("id", "n_shingles", "component_id")
    alone = rows.filter("root is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row of each class of near copies: that of the smallest id (nulls last), then of the least hash of id and text.

    Rows are told apart by id and text; of rows that are equal in both, the one with the least hash
    of all its columns stays.  Rows without words are in no class and all stay.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _classes(narrow, n, percent, sketch_bits).filter("root is not null")
    best = F.struct(F.col("id").isNull().alias("none"), "id", "ref")
    first = rows.groupBy("root").agg(F.min(best).alias("first"), F.count("*").alias("n"))
    marked = lookup(rows, written(first, "class-firsts"), "root", "n", rows.count())
    (ref,) = fresh(docs, "_ref")
    # Rows that go, and rows that stay in place of equal ones: only documents that may be either are shuffled.
    changed = marked.groupBy("ref").agg(F.max(F.col("ref") != F.col("first.ref")).alias("goes"), F.count("*").alias("n")).filter("goes or n > 1").select(F.col("ref").alias(ref), "goes")
    changed = written(changed, "near-copies")
    some, rest = parted(docs.withColumn(ref, F.xxhash64(id_col, text_col)), ref, changed.select(ref))
    goes = fresh(some, "_goes")[0]
    some = some.join(changed.withColumnRenamed("goes", goes).hint("merge"), ref, "left")
    row = F.struct(*docs.columns)
    again = some.filter(F.col(goes) == F.lit(False)).groupBy(ref).agg(F.min_by(row, F.xxhash64(*docs.columns)).alias(goes)).select(f"{goes}.*")
    return rest.select(docs.columns).unionByName(some.filter(F.col(goes).isNull()).select(docs.columns)).unionByName(again)
