"""Registered queries of the operators in this subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm import bm25, conversation_repair, conversation_trie, jaccard_join, license_scan, line_dedup, quality_rules, sentencepiece_codec, source_mix, substring_dedup, toxicity, url_filter, warc_zip
from labelkit.llm.common import conversations, documents, labels, pages, small_batches, written
from labelkit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Words and A-Z folding as the contracts define them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """SQL: the unsigned CRC-32 of an ASCII text."""
    byte = "list_reduce(range(8), lambda a, k: xor(a >> 1, (a & 1) * 3988292384), xor(h, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda h, b: {byte}, 4294967295::BIGINT), 4294967295)"


def _query(sql: str | None = None):
    def register(f):
        @functools.wraps(f)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = query
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@_query(rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
ids AS MATERIALIZED (SELECT doc_id, g, n FROM s JOIN n USING (doc_id)),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM ids a JOIN ids b ON a.g = b.g AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
          GROUP BY 1, 2, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id
""")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 3-word shingles overlap by 90 % or more."""
    return jaccard_join.near_duplicates(documents(spark, sf_dir), n=3, percent=90)


@_query(rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, length(text) AS chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS symbols,
  ((('0x' || substr(md5('17|' || doc_id), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
k AS (SELECT *, -ln(u) / coalesce(greatest(0.05::DOUBLE, 1.0::DOUBLE - 5.0::DOUBLE * symbols / greatest(chars, 1)), 0.05) AS at FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS words, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY 1),
w AS (SELECT *, ([5.0, 2.0, 1.0][((r - 1) % 3 + 1)::INT])::DOUBLE AS w, 2.0::DOUBLE * words AS most FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(words) OVER () - coalesce(sum(most) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level FROM w
      WINDOW o AS (ORDER BY most / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, words, least(most, max(level) OVER () * w) AS target FROM l),
e AS (SELECT k.*, t.words, t.target, CASE WHEN t.words > 0 THEN floor(t.target / t.words) ELSE 0 END AS times,
      sum(k.size) OVER (PARTITION BY k.source ORDER BY k.at, k.doc_id::VARCHAR ROWS UNBOUNDED PRECEDING) - k.size AS before
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, words::BIGINT AS source_size, target,
  (size * (times + CASE WHEN size > 0 AND before < target - times * words AND target - times * words - before >= size / 2 THEN 1 ELSE 0 END))::BIGINT AS taken FROM e
""")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words each document gives to a mix of the sources by weights 5, 2, 1 in turn."""
    return source_mix.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@_query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.key IS NOT NULL AND doc_id <> keep) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE r.key IS NULL OR doc_id = keep), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more documents hold, but for the largest id's."""
    kept = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query()
def op6_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document with merge-dropout, and whether they decode to its text."""
    coded = sentencepiece_codec.encode(documents(spark, sf_dir).select("doc_id", "text"))
    back = sentencepiece_codec.decode(coded, out="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@_query(rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
x AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM p),
f AS (SELECT h, min(struct_pack(d := doc_id, i := i)) AS first FROM x GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM x JOIN f USING (h) WHERE first <> struct_pack(d := doc_id, i := i)),
a AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT a.doc_id, count(*) AS n, count(c.i) AS gone, string_agg(word, ' ' ORDER BY a.i) FILTER (WHERE c.i IS NULL) AS kept
      FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.i GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that also start earlier."""
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), size=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a lexicon learned from labels outside the held-out quarter."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lexicon = toxicity.fit(docs, toxicity.training_labels(labels(spark, sf_dir)))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return toxicity.score(docs, lexicon).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@_query(r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s FROM p), m AS (SELECT s, max(page_id) AS keep FROM d GROUP BY 1)
SELECT page_id, n::BIGINT AS payload_bytes, s AS payload_digest, CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to FROM d JOIN m USING (s)
""")
def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records in ZIP archives, and read back from these."""
    path = scratch_path(spark, "warc")
    warc_zip.write_archives(pages(spark, sf_dir), path)
    return warc_zip.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@_query(rf"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS host FROM r),
u AS (SELECT page_id, {_LOWER.format("host")} AS host, regexp_extract(substr(coalesce(rest, ''), length(host) + 1), '^[^?#]*') AS path FROM h),
f AS (SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM f
""")
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page addresses by four nested rules."""
    return url_filter.judge(pages(spark, sf_dir).select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@_query()
def op7_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents by BM25 for every document whose id is divisible by 50."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bm25.search(docs, docs.filter("doc_id % 50 = 0"))


@_query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents, the base rule, and the trees' verdict."""
    measured = written(quality_rules.measure(documents(spark, sf_dir).select("doc_id", "text")).drop("text"), "quality-counts")
    judged = quality_rules.judge(measured, quality_rules.fit(measured, labels(spark, sf_dir)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def _edit(cost: str, letter: str, line: str, to: int) -> str:
    """SQL: what is left to do after an edit that leads to a state (of the row before), with the edit."""
    return f"{{'c': p.v{to}.c + {cost}, 'a': '{letter}' || p.v{to}.a, 't': {line}p.v{to}.t}}"


def _edits(state: int) -> str:
    """SQL: the cheapest, then least, way to go on with the next row from a state, without an insertion before it."""
    after = 3 if state == 2 else 2
    ways = [f"[{_edit('2', 'D', '', state)}]", f"CASE WHEN NOT gone THEN [{_edit('1 + cut', 'R', f"'{'user' if after == 2 else 'assistant'}:' || text || chr(10) || ", after)}] ELSE [] END"]
    for initial, to in ((("s", 1), ("u", 2)) if state == 0 else (("a" if state == 2 else "u", after),)):
        ways.append(f"CASE WHEN NOT gone AND ini = '{initial}' THEN [{_edit('cut', 'K', "role || ':' || text || chr(10) || ", to)}] ELSE [] END")
    return f"list_sort({' || '.join(ways)})[1]"


def _inserted(own: str, other: str, role: str) -> str:
    return f"list_sort([{own}, {{'c': {other}.c + 5, 'a': 'I' || {other}.a, 't': '{role}:' || chr(10) || {other}.t}}])[1]"


_REPAIR_SQL = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER w AS i, lag(substr(role, 1, 1)) OVER w || substr(role, 1, 1) AS pair,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS MATERIALIZED (SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS ini, pair, solid = '' AS blank, solid <> '' AND again AS dup,
  solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS cut_off FROM o),
r AS MATERIALIZED (SELECT conv_id, i, role, text, ini, blank OR dup AS gone, CASE WHEN cut_off THEN 5 ELSE 0 END AS cut FROM f),
ends AS (SELECT {{'c': 0::BIGINT, 'a': '', 't': ''}} AS z, {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS never),
lattice AS (
  SELECT conv_id, max(i) AS i, any_value(z) AS v0, any_value({{'c': 10::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}}) AS v1,
    any_value({{'c': 5::BIGINT, 'a': 'I', 't': 'assistant:' || chr(10)}}) AS v2, any_value(z) AS v3 FROM r CROSS JOIN ends GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, {_inserted('b0', 'w2', 'user')}, {_inserted('b1', 'w2', 'user')}, w2, w3 FROM (
    SELECT *, {_inserted('b2', 'b3', 'assistant')} AS w2, {_inserted('b3', 'b2', 'user')} AS w3 FROM (
      SELECT p.conv_id, p.i - 1 AS i, {_edits(0)} AS b0, {_edits(1)} AS b1, {_edits(2)} AS b2, {_edits(3)} AS b3
      FROM lattice p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i))),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
  count(*) FILTER (cut_off) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0) AS cost, coalesce(v0.a, '') AS audit, sha256(coalesce(left(v0.t, length(v0.t) - 1), '')) AS repaired_sha256
FROM c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN (SELECT * FROM lattice WHERE i = 0) l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@_query(_REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all (damaged) conversations, the cheapest edits that make them legal, and the repaired texts' hash."""
    damaged = conversation_repair.damage(conversations(spark, sf_dir))
    return conversation_repair.digests(conversation_repair.repair(damaged, absent="absent"))


@_query(rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM t),
r AS (SELECT c.conv_id, 0 AS part, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, role, text FROM c JOIN t USING (conv_id) WHERE k > h),
p AS (SELECT conv_id, list([role, text] ORDER BY part, k) AS turns FROM r GROUP BY 1),
a AS (SELECT c.conv_id, coalesce(turns, []) AS turns FROM c LEFT JOIN p USING (conv_id)),
x AS (SELECT conv_id AS c, unnest(range(len(turns) + 1)) AS depth, turns FROM a),
n AS MATERIALIZED (SELECT depth, turns[1:depth] AS key, min(c) AS conv_id, count(*) AS n_convs, list(c ORDER BY c) FILTER (len(turns) = depth) AS ends,
  len(regexp_extract_all(coalesce(any_value(turns[depth][2]), ''), '[^\x20\x09-\x0D]+')) AS words FROM x GROUP BY 1, 2),
k AS (SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, key)),
below AS (SELECT u.depth, u.key, sum((v.n_convs - 1) * v.words) AS saved, count(*) FILTER (v.n_children = 0) AS n_leaves FROM m u JOIN m v ON v.depth >= u.depth AND v.key[1:u.depth] = u.key GROUP BY 1, 2)
SELECT m.conv_id, m.depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(array_to_string(m.ends, ','), '')) AS ends_sha256
FROM m JOIN below USING (depth, key) LEFT JOIN n o ON o.depth = m.depth - 1 AND o.key = m.key[1:m.depth - 1] AND m.depth > 0
""")
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations' prefixes, with what sharing them saves."""
    return conversation_trie.trie(conversations(spark, sf_dir))


LICENSE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@_query()
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and license texts in all documents."""
    found = license_scan.scan(documents(spark, sf_dir).select("doc_id", "text"), LICENSE_PHRASES)
    base = F.filter("spans", lambda s: s["phrase"])
    labels_of = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels_of(base).alias("base_labels"), labels_of(F.col("spans")).alias("labels"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
