"""Jaccard join, line dedup and substring dedup against brute force."""

import hashlib
import itertools
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelkit.llm import common, jaccard_join, line_dedup, substring_dedup

from .conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORD.findall((text or "").translate(UPPER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_classes(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t, *_ in rows]
    parent = {k: k for k in range(len(sets))}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
    out = []
    for k, (doc_id, s) in enumerate(sets):
        ids = [sets[j][0] for j in parent if root(j) == root(k) and sets[j][0] is not None]
        out.append((doc_id, len(s), None if doc_id is None else min(ids)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_jaccard_join(docs, rows, n, percent):
    got = jaccard_join.near_duplicates(docs, n=n, percent=percent, sketch_bits=12)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(rows, n, percent)


def test_jaccard_join_does_not_depend_on_the_order_of_tokens(docs, rows):
    # One counter: no frequencies at all, ties by hash.
    got = jaccard_join.near_duplicates(docs.repartition(2), n=3, percent=90, sketch_bits=0)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(rows, 3, 90)


def test_jaccard_join_large_group(spark):
    # A group in which every document shares its tokens with all others, some without a link to most of them.
    base = [f"t{k}" for k in range(80)]
    texts = []
    for k in range(60):
        w = list(base)
        w[k] = f"u{k}"
        if k % 3 == 0:
            w[(k + 30) % 80] = f"v{k}"
        texts.append((k, " ".join(w)))
    got = jaccard_join.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), n=3, percent=90, sketch_bits=10)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(texts, 3, 90)


def test_jaccard_join_empty(empty):
    assert jaccard_join.near_duplicates(empty, sketch_bits=4).count() == 0
    with pytest.raises(ValueError):
        jaccard_join.links(empty, percent=0)


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(500, 400), (400, 450), (7, 7)], "a long, b long"))
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert got == {**{k: 0 for k in range(301)}, 500: 400, 400: 400, 450: 400}


def brute_lines(rows, min_chars=40, min_docs=5):
    held = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
            if len(key) >= min_chars:
                held.setdefault(key, set()).add(-1 if i is None else i)
    drop = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if drop.get(x.strip(" \t\n\x0b\x0c\r").translate(UPPER), -1 if i is None else i) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [6, 20])
def test_line_dedup(docs, rows, bits):
    got = line_dedup.dedup_lines(docs.withColumn("n_lines", F.lit(-1)).withColumn("digest", F.lit("own")), filter_bits=bits)
    assert {"digest", "lang"} <= set(got.columns)
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()], key=str) == brute_lines(rows)


def test_line_dedup_limits(docs, empty):
    assert line_dedup.dedup_lines(empty, filter_bits=8).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs, min_docs=1)


def brute_cut(rows, size):
    seen, gone = {}, {}
    ordered = sorted(range(len(rows)), key=lambda k: -1 if rows[k][0] is None else rows[k][0])
    split = [WORD.findall(t or "") for _, t, *_ in rows]
    for k in ordered:
        for i in range(len(split[k]) - size + 1):
            seen.setdefault(tuple(split[k][i : i + size]), []).append((-1 if rows[k][0] is None else rows[k][0], i))
    first = {w: min(v) for w, v in seen.items()}
    out = []
    for k, (doc_id, *_) in enumerate(rows):
        own = -1 if doc_id is None else doc_id
        gone = {i + j for i in range(len(split[k]) - size + 1) if first[tuple(split[k][i : i + size])] < (own, i) for j in range(size)}
        out.append((doc_id, len(split[k]), len(gone), " ".join(w for i, w in enumerate(split[k]) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "bits"), [(20, 18), (20, 5), (3, 16), (1, 12), (7, 4)])
def test_substring_dedup(docs, rows, size, bits):
    got = substring_dedup.remove_repeats(docs.withColumn("n_words", F.lit("own")), size=size, sketch_bits=bits)
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()], key=str) == brute_cut(rows, size)


def test_repeated_rows_share_their_ranges(spark):
    text = " ".join(f"w{k % 90}" for k in range(300))
    rows = [(5, text)] * 200 + [(6, text), (3, "no window of this one is found again " * 1), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substring_dedup.remove_repeats(docs, size=20, sketch_bits=12)
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()], key=str) == brute_cut(rows, 20)
    ranges = substring_dedup.covered(docs, size=20, sketch_bits=12).distinct().groupBy("id", "tie").count().collect()
    assert len(ranges) == 2 and max(r["count"] for r in ranges) <= 300


def test_levels_end_when_nothing_repeats(spark, monkeypatch):
    seen = []
    count = substring_dedup._counts
    monkeypatch.setattr(substring_dedup, "_counts", lambda docs, lengths, below, bits: seen.append(len(below)) or count(docs, lengths, below, bits))
    alone = spark.createDataFrame([(k, " ".join(f"w{k}.{j}" for j in range(60))) for k in range(5)], "doc_id long, text string")
    assert substring_dedup.remove_repeats(alone, size=20, sketch_bits=24).filter("n_removed > 0 or n_words <> 60").isEmpty() and seen == [0]


def test_what_is_alone_fills_no_table(spark):
    # 30,000 words against tables of 1,024 bits: only the passage found twice sets any.
    alone = [(k, " ".join(f"w{k}.{j}" for j in range(600))) for k in range(50)]
    docs = spark.createDataFrame(alone, "id long, text string").repartition(3)
    assert not substring_dedup._counts(docs, [5, 10, 20], [], 10).any()
    passage = " ".join(f"p{j}" for j in range(25))
    both = docs.unionByName(spark.createDataFrame([(100, f"a {passage} b"), (101, f"c d {passage} e")], docs.schema))
    tables = []
    for _ in range(3):
        tables.append(spark.sparkContext.broadcast(substring_dedup._counts(both, [5, 10, 20], tables, 10)))
    assert np.unpackbits(tables[-1].value).sum() == 6
    runs = substring_dedup._runs(both.withColumn("tie", F.xxhash64("text")), 20, tables, "bigint").collect()
    assert sorted((r.id, r.start, r.n, len(r.words)) for r in runs if r.id >= 100) == [(100, 1, 6, 96), (101, 2, 6, 96)] and len(runs) < 30
    got = substring_dedup.remove_repeats(both, id_col="id", sketch_bits=10).filter("n_removed > 0").collect()
    assert [(r.id, r.n_removed, r.text) for r in got] == [(101, 25, "c d e")]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16])
def test_least_parts_of_all_windows(n):
    text = " ".join(f"w{(k * k) % 23 if k < 200 else k % 3}" for k in range(300))
    words = common.Words(pa.array([text, "", "a b", text[40:]]))
    ok = words.inside(20) & (np.arange(len(words.hashes)) % 7 != 3)
    hashes, want = words.windows(n), set()
    for i in np.flatnonzero(ok).tolist():
        parts = hashes[i : i + 20 - n + 1]
        want |= {i + j for j in np.flatnonzero(parts == parts.min()).tolist()}
    assert substring_dedup._least_parts(words, n, 20, ok).tolist() == hashes[sorted(want)].tolist()


def test_substring_dedup_limits(empty, docs):
    assert substring_dedup.remove_repeats(empty, sketch_bits=8).count() == 0
    assert substring_dedup.levels(20) == [5, 10, 20]
    with pytest.raises(ValueError):
        substring_dedup.covered(docs, size=0)


def test_lookup_splits_heavy_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"), "id")
    found = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    got = common.lookup(rows, found, "key", "n", 3000)
    assert got.count() == 3000
    assert hashlib.md5(str(sorted(got.select("id", "low").collect())).encode()).hexdigest() == hashlib.md5(str(sorted(rows.join(found, "key").select("id", "low").collect())).encode()).hexdigest()


def two_groups(size=70):
    """Two groups of near copies that share many tokens but do not link with each other."""
    base = [f"t{k}" for k in range(120)]
    other = base[:70] + [f"o{k}" for k in range(50)]
    rows = []
    for k in range(size):
        for g, words_ in enumerate((base, other)):
            w = list(words_)
            w[k % 120] = f"x{g}.{k}"
            rows.append((2 * k + g, " ".join(w)))
    return rows


def test_each_pair_is_judged_once_and_groups_cost_no_squares(spark):
    rows = two_groups()
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    for bits in (4, 20):
        described = common.written(jaccard_join._described(docs, 3), "members")
        _, ledger = jaccard_join._links(docs, described, 3, 90, bits)
        assert ledger.groupBy("lo", "hi").count().filter("count > 1").isEmpty()
        assert ledger.count() < 3000  # of 9,730 pairs
        got = jaccard_join.near_duplicates(docs, id_col="id", n=3, percent=90, sketch_bits=bits)
        assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(rows, 3, 90)


@pytest.mark.parametrize("chunk", [1, 7])
def test_jaccard_join_with_lists_cut_to_pieces(spark, docs, rows, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "HUB_ROUNDS", 1)  # more is left to the classes
    monkeypatch.setattr(jaccard_join, "FEW_REFS", 0)
    got = jaccard_join.near_duplicates(docs, n=1, percent=60, sketch_bits=6)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(rows, 1, 60)
    texts = [(k, " ".join(w if (k * 7 + j) % (11 + k % 5) else f"y{k}.{j}" for j, w in enumerate(f"t{i}" for i in range(90)))) for k in range(50)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), n=1, percent=80, sketch_bits=0)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(texts, 1, 80)


def test_signatures_tell_long_sets_apart():
    rng = np.random.default_rng(3)
    for size, shared in ((5, 2), (400, 180), (1000, 460), (30_000, 13_800)):
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        b = np.concatenate((a[:shared], rng.integers(0, 2**64, size + size // 12 - shared, dtype=np.uint64)))
        bound = jaccard_join.apart(jaccard_join.signature(a), jaccard_join.signature(b))
        assert bound <= len(a) + len(b) - 2 * shared
        if size > 100:  # Jaccard similarity 0.3: rejected at a limit of 90 %
            assert bound > (len(a) + len(b)) * (1 - 2 * 90 / 190)
        near = np.concatenate((a[size // 50 :], b[shared : shared + 1]))
        assert jaccard_join.apart(jaccard_join.signature(a), jaccard_join.signature(near)) <= size // 50 + 1


def test_one_row_of_each_class_stays(spark):
    x, y = " ".join(words(200, 1)), " ".join(words(200, 2))
    rows = [(1, x, "a"), (2, f"{x} z", "a"), (2, y, "a"), (3, f"{y} q r", "a"), (None, x, "a"), (None, "no copy of this", "a"), (4, "", "a"), (4, "", "b"), (4, None, "a"), (None, " ", "c")]
    rows += [(7, "equal in id and text", "a"), (7, "equal in id and text", "b"), (7, "equal in id and text", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, goes string").repartition(3)
    kept = jaccard_join.keep_one(docs, n=5, percent=80)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([rows[0], rows[2], *rows[5:10], got[[g[0] for g in got].index(7)]], key=str)


def test_marks_are_packed(monkeypatch):
    monkeypatch.setattr(common, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("One", (), {"partitionId": lambda self: 0})())}))
    places = np.random.default_rng(1).integers(0, 1 << 24, 5000)
    tracemalloc.start()
    try:
        blobs = [b for b in common.mark_places(24)(iter([pa.RecordBatch.from_pydict({"place": pa.array(places)})]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12 << 20  # a byte for each bit, and a boolean of it, would be 32 MB
    bits = np.concatenate([np.frombuffer(zlib.decompress(b.column("data")[0].as_py()), np.uint8).reshape(2, -1)[1] for b in blobs])
    assert np.flatnonzero(np.unpackbits(bits)).tolist() == np.unique(places).tolist()


def test_sets_of_many_pairs_take_one_python_step(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW_REFS", 0)
    made, write = {}, jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name, *more: made.setdefault(name, df) is None or write(df, name, *more))
    got = jaccard_join.near_duplicates(docs, n=3, percent=90, sketch_bits=12)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_classes(rows, 3, 90)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for name, df in made.items() if re.match(r"sets-\d", name)]
    assert plans and all(p.count("MapInArrow") == 1 for p in plans)


def test_tables_merge_in_levels(spark, monkeypatch):
    monkeypatch.setattr(common, "FAN", 3)

    def mark(batches):
        table = np.zeros(64, dtype=np.uint8)
        for batch in batches:
            common.count_two(table, batch.column("id").to_numpy() % 64)
        yield from common.flag_rows(table)

    def count(batches):
        table = np.zeros(64, dtype=np.int64)
        for batch in batches:
            np.add.at(table, batch.column("id").to_numpy() % 64, 1)
        yield from common.sketch_rows(table)

    ids = spark.range(0, 100, 1, 40).union(spark.createDataFrame([(7,)] * 5, "id long"))
    assert common.merged_sketch(ids.mapInArrow(count, common.SKETCH_SCHEMA), 64).tolist() == [2 + 5 * (k == 7) if k < 36 else 1 for k in range(64)]
    bits = common.merged_flags(ids.mapInArrow(mark, common.SKETCH_SCHEMA), 64)
    assert common.flagged(bits, np.arange(64, dtype=np.uint64)).tolist() == [k < 36 for k in range(64)]
    # No group of any level reads more tables than the fan has, while there are fewer than its cube of tasks.
    read = []
    monkeypatch.setattr(common.DataFrame, "collect", lambda self, f=common.DataFrame.collect: read.append(self) or f(self))
    common.merged_sketch(ids.mapInArrow(count, common.SKETCH_SCHEMA), 64)
    assert read[0]._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInArrow") == 3
