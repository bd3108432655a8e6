"""SentencePiece codec, exact search, WARC archives, URL filters."""

import base64
import gzip
import hashlib
import io
import json
import math
import random
import struct
import zipfile
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from labelkit.llm import bm25, common, sentencepiece_codec as sp, url_filter, warc_zip
from labelkit.session import scratch_path

from .test_pairs_and_repeats import UPPER, WORD

SF001 = "/root/testdata/sf0.001"
MODEL = open(sp.MODEL, "rb").read()
PIECES = sp.Pieces(MODEL)
HARD = ["", " ", "   ", "a", "\n\n\t", "  a\n\tb  c", "ﬁ x½ é ñ", "▁x ▁▁ y▁", "a\x00b  ", "日本語 テスト 🙂", "\r\n x\r", "!!!!!!!!!!", "word" * 60, "aaaa" * 40, "İstanbul ǅ"]


def test_codec_equals_the_library_without_dropout():
    lib = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    codec = sp.Codec(PIECES)
    for text in HARD:
        if sp.SPACE not in text:
            assert codec.encode(text) == lib.encode(text), text


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 0.99])
def test_codec_round_trip(dropout):
    lib = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    codec = sp.Codec(PIECES, dropout)
    for k, text in enumerate(HARD):
        ids = codec.encode(text, str(k))
        assert codec.decode(ids) == text and lib.decode(ids) == text


LIB = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def brute_merges(unit, key, bound):
    """The best-scored, then leftmost pair of neighbours that forms a piece and is not skipped merges, until none is left."""
    symbols, skipped = [(i, c) for i, c in enumerate(unit)], set()
    while True:
        pairs = [(-LIB.get_score(PIECES.ids[x + y]), i, k, PIECES.ids[x + y]) for k, ((i, x), (_, y)) in enumerate(zip(symbols, symbols[1:])) if x + y in PIECES.ids and x in PIECES.ids and y in PIECES.ids]
        pairs = [p for p in pairs if (p[1], p[3]) not in skipped]
        if not pairs:
            return [x for _, s in symbols for x in ([PIECES.ids[s]] if s in PIECES.ids else [PIECES.byte_ids[b] for b in s.encode()])]
        _, i, k, piece = min(pairs)
        if bound and sp._skipped(np.array([key], np.uint64), sp._codes(np.array([i]), np.array([piece])), bound)[0]:
            skipped.add((i, piece))
        else:
            symbols[k : k + 2] = [(i, symbols[k][1] + symbols[k + 1][1])]


def test_codec_of_long_and_foreign_texts(spark):
    texts = ["word " * 120_000, "x" * 50_000, "日" * 3000, None, ""]
    docs = spark.createDataFrame([(k % 3, t) for k, t in enumerate(texts)] * 2, "doc_id long, text string")
    back = sp.decode(sp.encode(docs, dropout=0.2), out="decoded").collect()
    assert all(r.decoded == r.text for r in back) and len(back) == 10
    rows = spark.createDataFrame([([PIECES.byte_ids[0xC3]],), ([],), (None,)], "ids array<int>")  # bytes that no text gives
    assert [r.text for r in sp.decode(rows).collect()] == ["\ufffd", "", None]


def test_codec_heap_and_side_by_side_agree():
    rng = random.Random(2)
    units = ["▁" * rng.randrange(3) + "".join(rng.choice("abcdethion é🙂") for _ in range(rng.randrange(1, 40))).replace(" ", "x") for _ in range(400)]
    for dropout in (0.0, 0.3):
        codec = sp.Codec(PIECES, dropout)
        ids, sizes = codec._agendas(units, 1)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [codec._agenda(u, 1).tolist() for u in units] == [brute_merges(u, 1, codec.bound) for u in units]


def test_codec_varies_and_repeats(docs, rows, empty):
    got = {str(r.doc_id): r.ids for r in sp.encode(docs, dropout=0.3).collect()}
    assert got == {str(r.doc_id): r.ids for r in sp.encode(docs.repartition(2), dropout=0.3).collect()}
    assert len({tuple(got[str(k)]) for k in (8, 9, 10, 11)}) > 1  # copies with other ids
    other = {str(r.doc_id): r.ids for r in sp.encode(docs, dropout=0.3, seed=5).collect()}
    assert other != got
    back = sp.decode(sp.encode(docs.withColumn("ids", F.lit("own")), dropout=0.3), out="decoded").collect()
    assert all(r.decoded == r.text for r in back) and len(back) == len(rows)
    assert sp.encode(empty).count() == 0
    with pytest.raises(ValueError):
        sp.Codec(PIECES, 1.0)


def test_codec_full_cache(monkeypatch):
    monkeypatch.setattr(sp, "CACHE_UNITS", 5)
    codec = sp.Codec(PIECES, 0.2)
    texts = [" ".join(f"word{k}{j}" for j in range(20)) for k in range(10)]
    assert [codec.encode(t, "k") for t in texts] == [sp.Codec(PIECES, 0.2).encode(t, "k") for t in texts]


def test_codec_draws_for_every_occurrence():
    codec = sp.Codec(PIECES, 0.1)
    whole = sp.Codec(PIECES).encode("word")
    assert len(whole) == 1
    got = Counter(tuple(codec.encode("word", str(k))) for k in range(800))
    assert len(got) > 4 and 0.05 < 1 - got[tuple(whole)] / 800 < 0.5
    # One text: all its occurrences draw, too, and every word with a merge varies somewhere.
    units = [f" {w}" for w in ("of", "word", "house", "segmentation")]
    for unit in units:
        plain = codec._agendas([unit.replace(" ", sp.SPACE)], 0, np.empty((1, 0), np.uint64))
        made = codec.encode_all([unit * 500], ["k"])[0]
        assert made.tobytes() != plain[0].tobytes() * 500


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.4])
def test_codec_remembers_without_changing_results(monkeypatch, dropout):
    rng = random.Random(3)
    words = ["of", "house", "segmentation", "x", "日本語", "unforgettable" * 2, "y" * 60, "▁", "Ω½"]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(4)] + HARD
    keys = [str(k) for k in range(len(texts))]
    codec = sp.Codec(PIECES, dropout)
    want = [x.tolist() for x in codec.encode_all(texts, keys)]
    assert [x.tolist() for x in codec.encode_all(texts, keys)] == want
    assert [sp.Codec(PIECES, dropout).encode(t, k) for t, k in zip(texts, keys, strict=True)] == want
    for name, value in (("SLICE_UNITS", 7), ("LONG_UNIT", 0), ("DEPTH", 0)):  # LONG_UNIT 0: no unit is remembered
        monkeypatch.setattr(sp, name, value)
        assert [x.tolist() for x in sp.Codec(PIECES, dropout).encode_all(texts, keys)] == want


def brute_search(rows, asked, k=10):
    docs = [(i, Counter(WORD.findall((t or "").translate(UPPER)))) for i, t in rows if i is not None]
    mean = sum(sum(c.values()) for _, c in docs) / len(docs)
    df = Counter(w for _, c in docs for w in c)
    out = {}
    for q in asked:
        terms = next(c for i, c in docs if i == q)
        scores = []
        for i, c in docs:
            n = sum(c.values())
            s = sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * x * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * n / mean)) for w, x in terms.items() if w in c)
            if s:
                scores.append((-s, i))
        out[q] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize("block_docs", [2, 64])
def test_search(spark, monkeypatch, block_docs):
    monkeypatch.setattr(bm25, "BLOCK_DOCS", block_docs)
    docs = common.documents(spark, SF001).select("doc_id", "text")
    asked = docs.filter("doc_id % 20 = 0")
    want = brute_search([tuple(r) for r in docs.collect()], [r.doc_id for r in asked.collect()])
    for given in (docs.repartition(3), docs.coalesce(1)):
        got = {}
        for r in bm25.search(given, asked, block_terms=1500).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.score, r.doc_id))
        assert got.keys() == {q for q, hits in want.items() if hits}
        for q, hits in got.items():
            hits.sort()
            assert [h[0] for h in hits] == list(range(1, len(want[q]) + 1))
            assert [h[1] for h in hits] == pytest.approx([-s for s, _ in want[q]])
            assert all(abs(h[1] + s) < 1e-6 for h, (s, _) in zip(hits, want[q], strict=True))
            assert {h[2] for h in hits if h[1] > -want[q][-1][0] + 1e-9} == {i for s, i in want[q] if -s > -want[q][-1][0] + 1e-9}


def random_shard(n=6400, seed=1):
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(n), 5)
    term = rng.integers(0, 50, len(doc)).astype(np.uint64)
    term[:5] = 99
    pair = np.unique(np.stack((doc.astype(np.uint64), term)), axis=1)
    return bm25.Shard(pair[0].astype(np.int64), pair[1], rng.integers(1, 4, pair.shape[1]), np.full(n, 5), 5.0)


def test_search_skips_postings():
    terms, weights = np.array([3, 99], dtype=np.uint64), np.array([0.1, 9.0])
    shard = random_shard()
    best, _ = shard.search(terms, weights, 1)
    assert best.tolist() == [0] and shard.held > 500 and shard.scored < 100
    # A threshold leaves out terms that can't reach it, blocks, or the whole shard; what reaches it is found.
    rng = np.random.default_rng(4)
    for _ in range(30):
        terms = np.unique(rng.integers(0, 50, 12).astype(np.uint64))
        weights = rng.exponential(1, len(terms)) ** 3
        whole, scores = random_shard().search(terms, weights, 10)
        for threshold in (scores[-1], scores[3], scores[0], scores[0] + 1):
            other = random_shard()
            docs, found = other.search(terms, weights, 10, threshold)
            keep = scores >= threshold
            assert docs[found >= threshold].tolist() == whole[keep].tolist() and found[found >= threshold].tolist() == scores[keep].tolist()
            assert other.scored <= other.held
            other.whole = 1  # without bounds
            docs, found = other.search(terms, weights, 10, threshold)
            assert docs.tolist() == whole[keep].tolist() and found.tolist() == scores[keep].tolist()


def query_block(queries):
    """Queries (terms, weights), as a block of ``search_all``."""
    vocab, code = np.unique(np.concatenate([t for t, _ in queries]), return_inverse=True)
    return {"numbers": np.arange(len(queries)), "ends": np.cumsum([len(t) for t, _ in queries]), "vocab": vocab, "code": code.astype(np.int32), "weights": np.concatenate([w for _, w in queries])}


@pytest.mark.parametrize("slice_size", [1, 30_000, 1_000_000])
def test_search_side_by_side(monkeypatch, slice_size):
    """Queries side by side find what each finds alone, to the last bit; pairs of query and block are left out by bounds."""
    monkeypatch.setattr(bm25, "SLICE", slice_size)
    rng = np.random.default_rng(8)
    n = 1500
    term = (rng.zipf(1.3, 40 * n) % 3000).astype(np.uint64) + np.repeat(np.arange(n) // 500 * 2000, 40).astype(np.uint64)
    pair = np.unique(np.stack((np.repeat(np.arange(n, dtype=np.uint64), 40), term)), axis=1)
    pair = np.concatenate((pair, [[n, n + 1], [7000, 7000]], pair[:, pair[0] == 3] + [[n - 1], [0]]), axis=1).astype(np.uint64)  # documents 3 and n + 2 are equal
    times, length = rng.integers(1, 4, pair.shape[1]), np.full(n + 3, 45)
    times[pair[0] == n + 2] = times[pair[0] == 3]
    make = lambda: bm25.Shard(pair[0].astype(np.int64), pair[1], times, length, 45.0)
    queries = [(t := pair[1][pair[0] == d], rng.exponential(1, len(t)) ** 2) for d in (*range(0, n, 60), 3, n)]
    queries += [(np.array([99_999], dtype=np.uint64), np.ones(1)), (np.arange(90_000, 90_050, dtype=np.uint64), np.ones(50)), (np.zeros(0, np.uint64), np.zeros(0))]
    alone = [make().search(t, w, 10) for t, w in queries]
    for thresholds in (np.zeros(len(queries)), np.array([s[-1] if len(s) else 0.0 for _, s in alone]), np.array([s[2] if len(s) > 2 else 1.0 for _, s in alone])):
        shard, got = make(), {}
        for q, d, s in shard.search_all(query_block(queries), thresholds, 10):
            for x, y, z in zip(q.tolist(), d.tolist(), s.tolist(), strict=True):
                got.setdefault(x, []).append((y, z))
        for q, (d, s) in enumerate(alone):
            keep = s >= thresholds[q]
            assert [h for h in got.get(q, []) if h[1] >= thresholds[q]] == list(zip(d[keep].tolist(), s[keep].tolist(), strict=True))
        assert (shard.dense[0] >= 0).any() and (shard.dense[0] < 0).any()
    assert shard.pivots < shard.pairs / 2


def test_search_waves_and_blocks(spark, monkeypatch):
    """Hits do not grow with the number of shards, nor blocks of queries with the number of parts."""
    monkeypatch.setattr(bm25, "SHARD_POSTINGS", 60)
    made, write = {}, bm25.written
    monkeypatch.setattr(bm25, "written", lambda df, name, *more, **options: made.setdefault(name, []).append(out := write(df, name, *more, **options)) or out)
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{int(x)}" for x in rng.integers(0, 400, 30))) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(400)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        asked = docs.filter("doc_id % 50 = 0")
        assert bm25.search(docs, asked, k=5).groupBy("query_id").count().filter("count = 5").count() == 30
    finally:
        spark.conf.set(conf, before)
    shards, hits = made["bm25-shards"][0].count(), sum(df.count() for df in made["bm25-hits"])
    assert shards > 300 and made["bm25-queries"][0].count() == 1
    assert hits < 30 * 5 * 40  # an eighth of the shards, with five each, would be more


def test_search_over_many_shards(spark, monkeypatch):
    """Ties, ids that are no numbers, very long and repeated texts, clashing columns; a shard for every few documents."""
    monkeypatch.setattr(bm25, "SHARD_POSTINGS", 40)
    monkeypatch.setattr(bm25, "FIRST_WAVE", 3)
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, rng.integers(1, 30)) % 60) for _ in range(150)] + ["w1 w2 w3"] * 6 + ["w7 " * 30_000, "", None, "W1 w2 W3"]
    rows = [(f"id-{k:03d}", t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id string, text string, shard int, ids string").repartition(3)
    asked = docs.filter("doc_id like '%0' or doc_id in ('id-151', 'id-156')")
    want = brute_search(rows, [r.doc_id for r in asked.collect()], 5)
    got = {}
    for r in bm25.search(docs, asked, k=5, block_terms=30).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    assert {q: [i for _, i in w] for q, w in want.items() if w} == {q: [i for _, i, _ in sorted(hits)] for q, hits in got.items()}
    assert all(abs(h[2] + s) < 1e-6 for q, hits in got.items() for h, (s, _) in zip(sorted(hits), want[q], strict=True))


def test_search_corners(spark, docs, empty):
    assert bm25.search(empty, empty).count() == 0
    assert bm25.search(docs, empty).count() == 0
    got = bm25.search(docs, docs.filter("doc_id is null or doc_id in (900, 33, 34)"), k=3).collect()
    assert all(r.doc_id is not None and r.query_id is not None for r in got)


def page_rows():
    big, rows = "<p>" + "é text " * 200, []
    for k, html in enumerate([big, "small", big, None, "", "small", big + "x", "x" * 999, "x" * 999, "y" * 1000, "y" * 1000, "\r\n\r\nWARC/1.0\r\n\r\n" * 90]):
        rows.append((k, f"http://host{k}.org/a b\r\nX: 1/é" if k % 3 else None, html))
    return [*rows, (0, "http://twice.org/", big), (6, "u", big + "x"), (None, None, big), (None, "v", "y" * 1000), (30, "z", "long " * 400_000), (31, "z", "long " * 400_000), (9, "twice", big), (9, "twice", big + "x"), (40, "w", big)]


def brute_pages(rows):
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            best[h] = max(best.get(h, i), i)
    out = []
    for i, _, h in rows:
        data, to = (h or "").encode(), best.get(h)
        revisit = i is not None and to is not None and to != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 8_000_000])
def test_archives(spark, size, monkeypatch):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("own")).repartition(3)
    path = scratch_path(spark, "warc-test")
    warc_zip.write_archives(pages, path, archive_bytes=size)
    got = warc_zip.read_archives(spark, path).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute_pages(rows)
    assert Counter(bytes(r.payload) for r in got if r.record_type == "response") <= Counter((h or "").encode() for _, _, h in rows)
    files = spark.read.format("binaryFile").load(path).collect()
    ids = [fields["warc-record-id"] for f in files for fields, _ in warc_zip.Archive.of_bytes(f.content).records()]
    assert len(ids) == len(set(ids)) == len(rows)
    monkeypatch.setattr(warc_zip, "opened", lambda path: None)  # a store that only Spark reads
    assert sorted(map(str, warc_zip.read_archives(spark, path).collect())) == sorted(map(str, got))
    assert (len(files) == len(rows)) == (size == 1)
    for f in files:  # other programs read them too
        with zipfile.ZipFile(io.BytesIO(f.content)) as z:
            assert z.testzip() is None and set(z.namelist()) == {warc_zip.WARC, warc_zip.INDEX, warc_zip.PACKAGE}


def test_no_pages(spark):
    path = scratch_path(spark, "warc-test")
    warc_zip.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc_zip.read_archives(spark, path).count() == 0


def test_zip_directories(tmp_path):
    plain = tmp_path / "a.zip"
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("x/é.txt", b"0123456789")
        z.writestr("deflated", b"0" * 100, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("wide"), "w", force_zip64=True) as f:
            f.write(b"wide member")
        z.comment = b"a comment with PK\x05\x06 in it"
    with plain.open("rb") as f:
        reads = []
        archive = warc_zip.Archive.of_file(f)
        read, archive.read = archive.read, lambda at, n: (reads.append(n), read(at, n))[1]
        assert archive.member("x/é.txt", 3, 4) == b"3456" and max(reads) <= 30
        assert archive.member("wide") == b"wide member"
        for name, at, n in (("deflated", 0, 1), ("x/é.txt", 8, 3), ("x/é.txt", -1, 1)):
            with pytest.raises(ValueError):
                archive.member(name, at, n)
    many = tmp_path / "many.zip"
    with zipfile.ZipFile(many, "w") as z:
        for k in range(66_000):  # more than the plain directory can count
            z.writestr(f"m{k}", b"%d" % k)
    archive = warc_zip.Archive.of_bytes(many.read_bytes())
    assert len(archive.members) == 66_000 and archive.member("m65999") == b"65999"
    # ZIP64 fields in the directory: the sizes and the offset of the only member, as for one beyond 4 GiB.
    name, body = b"big", b"the body"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 8, 8, 3, 0) + name + body
    extra = struct.pack("<HHQQQ", 1, 24, 8, 8, 0)
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, 3, len(extra), 0, 0, 0, 0, 2**32 - 1) + name + extra
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(local) + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 2**32 - 1, 2**32 - 1, 0)
    assert warc_zip.Archive.of_bytes(local + entry + end64 + locator + end).member("big") == body
    with pytest.raises(ValueError):
        warc_zip.Archive.of_bytes(b"no archive")


def test_records():
    fields, payload = warc_zip.parse_record(warc_zip.make_record(5, "http://a/\r\nWARC-Type: x", b"body\r\n\r\n", None))
    assert payload == b"body\r\n\r\n" and fields["warc-type"] == "response" and "\r" not in fields["warc-target-uri"]
    assert base64.b32decode(fields["warc-payload-digest"][5:]) == hashlib.sha1(payload).digest()
    fields, payload = warc_zip.parse_record(warc_zip.make_record(5, None, b"body", 9, "http://b/ c"))
    assert payload == b"" and fields["warc-refers-to-target-uri"] == "http://b/%20c" and fields["x-refers-to-page-id"] == "9" and fields["http-length"] == "4"


def foreign(tmp_path, index, indexed, gzipped=True, pad=0):
    """An archive of two WARC members, as other programs write them; after ``pad`` bytes of a hole."""
    path = tmp_path / "foreign.wacz"
    records = {name: [warc_zip.make_record(k, f"http://{name}/{k}", b"payload %d " % k * 50, None, name=name) for k in range(b, b + 3)] for name, b in (("one", 0), ("two", 3))}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        if pad:
            info = zipfile.ZipInfo("pages/pad.bin")
            with z.open(info, "w", force_zip64=True) as f:
                f.write(b"x")
        lines = []
        for name, own in records.items():
            bodies = [gzip.compress(r) if gzipped else r for r in own]
            member = f"archive/{name}.warc{'.gz' if gzipped else ''}"
            z.writestr(member, b"".join(bodies))
            at = 0
            for k, body in enumerate(bodies):
                file = member.split("/")[1]
                lines.append(f'org,{name})/{k} 20200101 {json.dumps({"url": "u", "offset": str(at), "length": str(len(body)), "filename": file})}' if index != "cdx" else f"org,{name})/{k} 2020 {len(body)} {at} {file}")
                at += len(body)
        text = "\n".join((["!CDXJ-1.0 meta"] if index != "cdx" else [" CDX N b S V g"]) + lines) + "\n"
        if indexed:
            z.writestr("indexes/index.cdx.gz" if index == "gz" else f"indexes/index.{index}", gzip.compress(text[:100].encode()) + gzip.compress(text[100:].encode()) if index == "gz" else text)
        z.writestr("datapackage.json", "{}")
    return path


@pytest.mark.parametrize(("index", "indexed", "gzipped"), [("cdxj", True, True), ("gz", True, True), ("cdx", True, False), ("cdxj", False, True), ("cdxj", False, False)])
def test_archives_of_other_programs(spark, tmp_path, monkeypatch, index, indexed, gzipped):
    path = foreign(tmp_path, index, indexed, gzipped)
    with path.open("rb") as f:
        assert sorted(p for _, p in warc_zip.Archive.of_file(f).records()) == sorted(b"payload %d " % k * 50 for k in range(6))
    monkeypatch.setattr(warc_zip, "STEP_BYTES", 37)
    with path.open("rb") as f:
        assert len([*warc_zip.Archive.of_file(f).records()]) == 6
    got = warc_zip.read_archives(spark, f"file://{path}").collect()
    assert sorted((r.page_id, r.url) for r in got) == [(k, f"http://{'one' if k < 3 else 'two'}/{k}") for k in range(6)]


def shifted(path, to, by):
    """Copy an archive with a hole of ``by`` bytes at its front: a sparse file beyond what one read or a plain directory can hold."""
    data = path.read_bytes()
    archive = warc_zip.Archive.of_bytes(data)
    entries = b""
    for name, (method, stored, size, local) in archive.members.items():
        raw = name.encode()
        extra = struct.pack("<HHQQQ", 1, 24, size, stored, local + by)
        entries += b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, method, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(raw), len(extra), 0, 0, 0, 0, 2**32 - 1) + raw + extra
    n, at = len(archive.members), by + len(data)
    with to.open("wb") as f:
        f.seek(by)
        f.write(data + entries)
        f.write(b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(entries), at))
        f.write(b"PK\x06\x07" + struct.pack("<IQI", 0, at + len(entries), 1) + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 2**32 - 1, 2**32 - 1, 0))


def test_archive_beyond_two_gigabytes(spark, tmp_path):
    big = tmp_path / "big" / "big.wacz"
    big.parent.mkdir()
    shifted(foreign(tmp_path, "gz", True), big, 5 * 2**30)
    read, close = warc_zip._reader(f"file://{big}")
    sizes = []
    archive = warc_zip.Archive(lambda at, n: (sizes.append(n), read(at, n))[1], big.stat().st_size)
    assert len([*archive.records()]) == 6 and sum(sizes) < 100_000
    close()
    got = warc_zip.read_archives(spark, f"file://{big.parent}").collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(k, b"payload %d " % k * 50) for k in range(6)]


def test_neighbouring_ranges_are_read_together(monkeypatch):
    monkeypatch.setattr(warc_zip, "READ_BYTES", 100)
    ranges = [("a", 0, 40), ("a", 40, 50), ("a", 90, 20), ("a", 120, 5), ("b", 125, 500), ("b", 625, 1)]
    assert [*warc_zip._neighbours(iter(ranges))] == [("a", [(0, 40), (40, 50)]), ("a", [(90, 20)]), ("a", [(120, 5)]), ("b", [(125, 500)]), ("b", [(625, 1)])]


def test_broken_indexes(tmp_path):
    with pytest.raises(ValueError):
        [*warc_zip.index_lines(iter(["no json here"]))]
    path = tmp_path / "x.zip"
    for line in ('a {"offset": 5, "length": 50}', 'a {"offset": 0, "length": 1, "filename": "other"}'):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("archive/a.warc", b"short")
            z.writestr("indexes/index.cdxj", line)
        with pytest.raises(ValueError):
            [*warc_zip.Archive.of_bytes(path.read_bytes()).ranges()]


def brute_rule(rules, host, path):
    fits = [(len(h.split(".")), len(p), v == "block", v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else None


def test_url_trie():
    rng = random.Random(4)
    labels, segments = ["a", "b", "net", "org", ""], ["x", "xy", "", "é"]
    for _ in range(300):
        rules = [(rng.choice(["allow", "block"]), ".".join(rng.choices(labels, k=rng.randrange(1, 4))), "/".join(["", *rng.choices(segments, k=rng.randrange(3))])) for _ in range(6)]
        trie = url_filter.UrlTrie(rules)
        for _ in range(30):
            host, path = ".".join(rng.choices(labels, k=rng.randrange(1, 5))), "/".join(["", *rng.choices(segments, k=rng.randrange(4))]) * rng.randrange(2)
            assert trie.find(host, path) == brute_rule(rules, host, path), (rules, host, path)


def test_judge(spark):
    from labelkit.llm.queries import URL_RULES

    urls = [None, "", "no scheme", "http://", "http://X.NET", "http://x.net/", "https://www.Example.net/en/a?b#c", "http://example.net/en", "x://example.com/de/?q", "http://notexample.com/de/", "http://a.org/fr/#x", "http://org?/fr/", "http://Éa.net/é", "://net/", "http://a.net#/x", "http://a://b.net/"]
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit("own"))
    for r in url_filter.judge(rows, URL_RULES).collect():
        verdict, rule = brute_rule(URL_RULES, r.host, r.path) or ("allow", None)
        assert (r.verdict, r.rule) == (verdict, rule)
    got = {urls[r.page_id]: (r.host, r.path, r.rule) for r in url_filter.judge(rows, URL_RULES).collect()}
    assert got["http://X.NET"] == ("x.net", "", None) and got["https://www.Example.net/en/a?b#c"] == ("www.example.net", "/en/a", "example.net/en/")
    assert got["http://example.net/en"] == ("example.net", "/en", "net/") and got["no scheme"] == got[None] == ("", "", None)
    assert url_filter.judge(rows.limit(0), URL_RULES).count() == 0
    for bad in ([("deny", "a", "/")], [("allow", "a" * 70_000_000, "/")]):
        with pytest.raises(ValueError):
            url_filter.UrlTrie(bad)
