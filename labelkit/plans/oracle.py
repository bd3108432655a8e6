"""DuckDB SQL for checking the Spark queries (used only by ``oracle_sql()`` and
tests).  The SQL re-derives every result from the raw tables with set
operations: cleaning and tokenizing with string functions, murmur3 term
hashing with integer arithmetic, IDF / Naive Bayes / metrics with joins and
aggregates.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

# --- fixed values --------------------------------------------------------------
# Spark's default English stop words (StopWordsRemover.loadDefaultStopWords
# ("english")), in the order of Spark's list.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't "
    "wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would"
).split()
# murmur3 x86-32 constants and the seed Spark's HashingTF uses.
MURMUR_C1 = 0xCC9E2D51
MURMUR_C2 = 0x1B873593
MURMUR_N = 0xE6546B64
MURMUR_F1 = 0x85EBCA6B
MURMUR_F2 = 0xC2B2AE35
MURMUR_SEED = 42
# Python str.split() whitespace, as an RE2 class body (same as functions.text).
WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# ------------------------------------------------------------------------------

M32 = 4294967296


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def stop_list_sql() -> str:
    return "[" + ", ".join(q(w) for w in STOP_WORDS) + "]"


def clean_sql(expr: str) -> str:
    return f"regexp_replace(lower({expr}), '[^a-z ]', '', 'g')"


def first_token_sql(expr: str) -> str:
    pat = f"^[{WHITESPACE_CLASS}]*([^{WHITESPACE_CLASS}]+)"
    return f"coalesce(nullif(regexp_extract({expr}, {q(pat)}, 1), ''), {expr})"


def tokens_list_sql(clean_expr: str) -> str:
    """Java ``split("\\s")`` on cleaned text: trailing empties dropped, an
    all-space text gives no token, the empty text one empty token."""
    return (
        f"CASE WHEN {clean_expr} <> '' AND rtrim({clean_expr}, ' ') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({clean_expr}, ' '), ' ') END"
    )


def filtered_list_sql(tokens_expr: str) -> str:
    return f"list_filter({tokens_expr}, lambda w: NOT list_contains({stop_list_sql()}, w))"


def is_train_sql(key_expr: str, share: float = 0.8, seed: int = 42) -> str:
    return (
        f"((('0x' || substr(md5('{seed}|' || CAST({key_expr} AS VARCHAR)), 1, 8))::BIGINT % 10000) "
        f"< {int(round(share * 10000))})"
    )


# --- murmur3 -------------------------------------------------------------------


def _mul(a: str, k: int) -> str:
    return f"((({a})::HUGEINT * {k}) % {M32})::BIGINT"


def _rotl(e: str, r: int) -> str:
    return f"(((({e}) << {r}) % {M32}) | (({e}) >> {32 - r}))"


def _k1(x: str) -> str:
    return _mul(_rotl(_mul(x, MURMUR_C1), 15), MURMUR_C2)


def _byte(pos: str) -> str:
    return f"ascii(substr(t, ({pos})::BIGINT, 1))::BIGINT"


def hash_ctes(vocab: str, num_features: int, out: str = "q_hash") -> str:
    """CTEs mapping each distinct token ``t`` of ``vocab`` to its HashingTF
    bucket.  Tokens are ASCII after cleaning, so characters are bytes."""
    blk = " + ".join(f"{_byte(f'i * 4 + {j + 1}')} * {256 ** j}" for j in range(4))
    step = f"(({_mul(_rotl('xor(h, k)', 13), 5)}) + {MURMUR_N}) % {M32}"
    tail = " + ".join(
        f"(CASE WHEN n % 4 > {j} THEN {_byte(f'(n // 4) * 4 + {j + 1}')} ELSE 0 END) * {256 ** j}" for j in range(3)
    )
    return f"""
{out}_0 AS (
  SELECT t, strlen(t)::BIGINT AS n,
         list_reduce(list_transform(range(0, strlen(t) // 4), lambda i: {_k1(blk)}),
                     lambda h, k: {step}, {MURMUR_SEED}::BIGINT) AS h
  FROM (SELECT DISTINCT t FROM {vocab})
),
{out}_1 AS (SELECT t, n, xor(xor(h, {_k1(f'({tail})')}), n) AS h FROM {out}_0),
{out}_2 AS (SELECT t, {_mul('xor(h, h >> 16)', MURMUR_F1)} AS h FROM {out}_1),
{out}_3 AS (SELECT t, {_mul('xor(h, h >> 13)', MURMUR_F2)} AS h FROM {out}_2),
{out}_4 AS (SELECT t, xor(h, h >> 16) AS h FROM {out}_3),
{out} AS (
  SELECT t, ((((CASE WHEN h >= 2147483648 THEN h - {M32} ELSE h END) % {num_features}) + {num_features})
             % {num_features})::INTEGER AS bucket
  FROM {out}_4
)"""


# --- sources -------------------------------------------------------------------

# The ``lines`` fixture: names-file lines derived from ``part``, covering
# header, missing separator, lower-case label, extra field, blank name and
# spaced label.
LINES_SQL = """
SELECT CASE p_partkey % 11
         WHEN 0 THEN 'NOMPL;SEXE'
         WHEN 1 THEN p_name
         WHEN 2 THEN p_name || ';m'
         WHEN 3 THEN p_name || ';F;extra'
         WHEN 4 THEN ';M'
         WHEN 5 THEN p_name || '; F'
         ELSE p_name || ';' || CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'M' END
       END AS value
FROM part"""


def parsed_lines_sql() -> str:
    return (
        "SELECT string_split(value, ';')[1] AS name, string_split(value, ';')[2] AS gender "
        f"FROM ({LINES_SQL}) WHERE NOT contains(value, 'NOMPL;SEXE')"
    )


def loaded_lines_sql() -> str:
    return f"SELECT name, gender FROM ({parsed_lines_sql()}) WHERE gender IN ('M', 'F') AND name IS NOT NULL"


def labelled_docs_sql(label: str = "quality") -> str:
    """documents joined with labels; ``M`` when the label is 1, else ``F``."""
    return (
        "SELECT d.doc_id AS doc_id, d.text AS name, "
        f"CASE WHEN l.{label} = 1 THEN 'M' ELSE 'F' END AS gender "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
    )


ROLE_TEXT_SQL = (
    "SELECT conv_id, turn, text AS name, role AS gender FROM conversations WHERE role IN ('user', 'assistant')"
)


# --- token / feature CTEs --------------------------------------------------------


def token_rows_cte(name: str, src: str, key: str = "doc_id", text: str = "name", stop_words: bool = True) -> str:
    """``name(key, t)``: one row per (filtered) token of each source row
    (a null text is cleaned as the empty text, as in the model's stage)."""
    toks = tokens_list_sql(clean_sql(f"coalesce({text}, '')"))
    if stop_words:
        toks = filtered_list_sql(toks)
    return f"{name} AS (SELECT {key} AS k, unnest({toks}) AS t FROM ({src}))"


def tf_cte(name: str, tokens: str, hashed: str) -> str:
    return (
        f"{name} AS (SELECT x.k, hh.bucket, count(*)::DOUBLE AS tf "
        f"FROM {tokens} x JOIN {hashed} hh ON x.t = hh.t GROUP BY x.k, hh.bucket)"
    )


def nb_ctes(
    train_src: str,
    score_src: str,
    num_features: int = 20,
    use_idf: bool = True,
    smoothing: float = 1.0,
    prefix: str = "nb",
    key: str = "doc_id",
    text: str = "name",
) -> str:
    """CTEs for Naive Bayes fitted on ``train_src (key, name, gender)`` and
    applied to ``score_src (key, name)``.

    Produces ``{prefix}_classes(gender, ci, nc)``, ``{prefix}_idf(bucket, df, idf)``,
    ``{prefix}_theta(ci, bucket, theta)``, ``{prefix}_pi(ci, gender, pi)``,
    ``{prefix}_v(k, bucket, v)`` (train feature values),
    ``{prefix}_sv(k, bucket, v)`` (scored feature values) and
    ``{prefix}_pred(k, ci, prediction, gender, prob, confidence)`` (one row per
    scored key and class; ``prediction`` is the arg-max class of that key).
    """
    p = prefix
    idf_expr = f"ln(({p}_m.m + 1) / (coalesce(d.df, 0) + 1))" if use_idf else "1.0"
    return f"""
{p}_train AS (SELECT {key} AS k, gender FROM ({train_src})),
{token_rows_cte(f'{p}_ttok', train_src, key, text)},
{token_rows_cte(f'{p}_stok', score_src, key, text)},
{p}_vocab AS (SELECT t FROM {p}_ttok UNION SELECT t FROM {p}_stok),
{hash_ctes(f'{p}_vocab', num_features, f'{p}_hash')},
{tf_cte(f'{p}_ttf', f'{p}_ttok', f'{p}_hash')},
{tf_cte(f'{p}_stf', f'{p}_stok', f'{p}_hash')},
{p}_m AS (SELECT count(*)::DOUBLE AS m FROM {p}_train),
{p}_buckets AS (SELECT range::INTEGER AS bucket FROM range(0, {num_features})),
{p}_df AS (SELECT bucket, count(*) AS df FROM {p}_ttf GROUP BY bucket),
{p}_idf AS (
  SELECT b.bucket, coalesce(d.df, 0) AS df, {idf_expr} AS idf
  FROM {p}_buckets b CROSS JOIN {p}_m LEFT JOIN {p}_df d ON d.bucket = b.bucket
),
{p}_v AS (SELECT x.k, x.bucket, x.tf * i.idf AS v FROM {p}_ttf x JOIN {p}_idf i ON x.bucket = i.bucket),
{p}_sv AS (SELECT x.k, x.bucket, x.tf * i.idf AS v FROM {p}_stf x JOIN {p}_idf i ON x.bucket = i.bucket),
{p}_classes AS (
  SELECT gender, count(*) AS nc, (row_number() OVER (ORDER BY count(*) DESC, gender) - 1)::INTEGER AS ci
  FROM {p}_train GROUP BY gender
),
{p}_pi AS (
  SELECT ci, gender, ln(nc + {smoothing}) - ln((SELECT m FROM {p}_m) + (SELECT count(*) FROM {p}_classes) * {smoothing}) AS pi
  FROM {p}_classes
),
{p}_s AS (
  SELECT c.ci, b.bucket, coalesce(sum(v.v), 0) AS s
  FROM {p}_classes c CROSS JOIN {p}_buckets b
  LEFT JOIN {p}_train tr ON tr.gender = c.gender
  LEFT JOIN {p}_v v ON v.k = tr.k AND v.bucket = b.bucket
  GROUP BY c.ci, b.bucket
),
{p}_theta AS (
  SELECT ci, bucket, ln(s + {smoothing}) - ln(sum(s) OVER (PARTITION BY ci) + {num_features} * {smoothing}) AS theta
  FROM {p}_s
),
{p}_dot AS (
  SELECT x.k, th.ci, sum(x.v * th.theta) AS dot FROM {p}_sv x JOIN {p}_theta th ON x.bucket = th.bucket
  GROUP BY x.k, th.ci
),
{p}_ll AS (
  SELECT s.k, c.ci, c.gender, c.pi + coalesce(d.dot, 0) AS ll
  FROM (SELECT DISTINCT {key} AS k FROM ({score_src})) s CROSS JOIN {p}_pi c
  LEFT JOIN {p}_dot d ON d.k = s.k AND d.ci = c.ci
),
{p}_e AS (SELECT k, ci, gender, exp(ll - max(ll) OVER (PARTITION BY k)) AS e FROM {p}_ll),
{p}_prob AS (SELECT k, ci, gender, e / sum(e) OVER (PARTITION BY k) AS prob FROM {p}_e),
{p}_pred AS (
  SELECT r.k, r.ci, r.gender, r.prob, w.prediction, w.predicted_label, w.confidence
  FROM {p}_prob r JOIN (
    SELECT k, min(ci) AS prediction, arg_min(gender, ci) AS predicted_label, max(prob) AS confidence
    FROM (SELECT *, max(prob) OVER (PARTITION BY k) AS mx FROM {p}_prob) WHERE prob = mx GROUP BY k
  ) w ON w.k = r.k
)"""


def r6(expr: str) -> str:
    return f"round({expr}, 6)"
