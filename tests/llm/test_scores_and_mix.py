"""Toxicity, quality rules and source mix."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelkit.llm import common, quality_rules, source_mix, toxicity

from .test_pairs_and_repeats import WORD

SF01 = "/root/testdata/sf0.01"


def test_fold():
    assert toxicity.fold("L0SER!") == toxicity.fold("loser!")
    assert toxicity.fold("ѕтuріd") == "stupid"
    assert toxicity.fold("1d10t") == toxicity.fold("idiot")
    assert toxicity.fold("​Été") == "ete"
    assert toxicity.fold("ｌoser") == toxicity.fold("loser")
    assert toxicity.fold("the!! 1999") == "the!! 1999"


def test_raw_score():
    lexicon = toxicity.Lexicon({"ioser": 4.0, "ciown": 2.0}, exceptions=("ciown fish",))
    a = lexicon.automaton()
    assert toxicity.raw_score("a Loser here", a) == pytest.approx(4 / math.log2(5))
    assert toxicity.raw_score("a closer one", a) == 0  # not where a word begins
    assert toxicity.raw_score("a clown fish and a cl0wns", a) == pytest.approx(2 / math.log2(8))
    assert toxicity.raw_score("clown fishes", a) > 0
    for text in (None, "", "  \n"):
        assert toxicity.raw_score(text, a) == 0
    assert toxicity.raw_score("loser " * 50_000, a) > toxicity.raw_score("x " * 50_000 + "loser", a) > 0
    assert toxicity.raw_score("loser", toxicity.Lexicon().automaton()) == 0


def brute_raw_score(text, lexicon):
    """The longest term at every beginning of a word, but for those within an exception phrase."""
    folded = toxicity.fold(text)
    begins = [i for i in range(len(folded)) if not i or not folded[i - 1].isalnum()]
    ends = lambda i: i == len(folded) or not folded[i].isalnum()
    spared = [(i, i + len(p)) for p in lexicon.exceptions for i in begins if folded.startswith(p, i) and ends(i + len(p))]
    total = 0
    for i in begins:
        fits = [t for t in lexicon.weights if folded.startswith(t, i) and (len(t) >= 4 or ends(i + len(t)))]
        longest = max(fits, key=len, default=None)
        if longest and not any(a <= i and i + len(longest) <= b for a, b in spared):
            total += lexicon.weights[longest]
    return total / math.log2(2 + len(WORD.findall(text))) if total else 0.0


def test_scores_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    lexicon = toxicity.Lexicon({"ioser": 4.0, "ioserdom": 5.0, "ciown": 2.0, "oi": 1.5, "tra": 0.5}, ("ciown fish", "oi ioser", "fine ioser"), 0.7)
    parts = ["loser", "L0SERS", "loserdom", "closer", "clown", "cl0wn", "fish", "oi", "oil", "OI!", "tra", "train", "fine", "wort", "é", "loser.", "\n", "ⅼ", "1oser"]
    texts = [" ".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(400)]
    automaton = lexicon.automaton()
    for text in texts:
        assert toxicity.raw_score(text, automaton) == pytest.approx(brute_raw_score(text, lexicon)), text
    got = toxicity.score(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"), lexicon).collect()
    assert all(r.score == pytest.approx(1 - math.exp(-0.7 * brute_raw_score(r.text, lexicon))) for r in got)


def test_lexicon_is_a_function_of_the_rows(spark):
    data = planted(spark)
    # Near copies (the same rare words) with other texts, repeated rows and repeated labels.
    more = data.filter("doc_id % 5 = 0").select((F.col("doc_id") + 1000).alias("doc_id"), F.concat("text", F.lit(" wort7")).alias("text"), "toxic")
    data = data.unionByName(more).unionByName(data.filter("doc_id < 40"))
    made = [toxicity.fit(d.select("doc_id", "text"), d.select("doc_id", "toxic")) for d in (data.coalesce(1), data.repartition(7), data.orderBy(F.desc("text")))]
    assert made[0].weights and made[0] == made[1] == made[2]
    trees = [quality_rules.fit(quality_rules.measure(d.select("doc_id", "text")), d.select("doc_id", F.col("toxic").alias("quality"))) for d in (data.coalesce(1), data.repartition(7))]
    assert all(np.array_equal(getattr(trees[0], f), getattr(trees[1], f)) for f in ("feature", "border", "left", "value", "roots"))


def test_toxicity_short_and_rare_terms_and_exceptions(spark):
    rows = []
    for k in range(1500):
        w = [f"wort{(k * 7 + j * 13) % 500}" for j in range(30)]
        if k % 10 == 0:
            w[k % 29] = "zq" if k % 20 else "glimfor"
        elif k % 50 == 3:
            w[4:6] = ["glimfor", "haus"]  # clean within this phrase
        rows.append((k, " ".join(w), int(k % 10 == 0)))
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.fit(data.select("doc_id", "text"), data.select("doc_id", "toxic"))
    assert "zq" in lexicon.weights
    a = lexicon.automaton()
    assert toxicity.raw_score("ein zq hier", a) > 0 == toxicity.raw_score("ein zqx hier", a)
    some = toxicity.Lexicon({"giimfor": 3.0})
    spared = toxicity._with_exceptions(data.select(F.col("toxic").alias("label"), "text"), some, 10)
    assert "giimfor haus" in spared.exceptions and toxicity.raw_score("der glimfor haus", spared.automaton()) == 0


def planted(spark, n=400):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(n):
        w = [f"wort{x}" for x in rng.integers(0, 300, 40)]
        toxic = k % 8 == 0
        if toxic:
            w[int(rng.integers(40))] = ["blorgish", "Blorg", "BL0RGA", "zwixen"][k // 8 % 4]
        rows.append((k, " ".join(w), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns_terms(spark):
    data = planted(spark)
    lexicon = toxicity.fit(data.select("doc_id", "text"), data.select("doc_id", "toxic"))
    assert any(t.startswith("biorg") for t in lexicon.weights)
    new = spark.createDataFrame([(1, "ein blorg ist hier"), (2, "ein wort1 ist hier"), (3, None), (4, "bl0rgs " + "wort2 " * 900)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(new.withColumn("score", F.lit("old")), lexicon).collect()}
    assert got[1] >= 0.3 and got[4] > 0.2 and got[2] == got[3] == 0


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([(None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, none)
    assert lexicon.weights == {} and {r.score for r in toxicity.score(docs, lexicon).collect()} == {0.0}
    assert toxicity.score(empty, lexicon).count() == 0


def test_toxicity_held_out(spark):
    docs, marks = common.documents(spark, SF01), common.labels(spark, SF01)
    lexicon = toxicity.fit(docs, toxicity.training_labels(marks))
    held = toxicity.score(docs, lexicon).join(marks, "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    rows = held.select("toxic", "score").collect()
    right = sum((r.score >= 0.3) == bool(r.toxic) for r in rows)
    assert right / len(rows) > 0.88


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    cover = {i + j for i, t in enumerate(triples) if triples.count(t) > 1 for j in range(3)} if len(triples) < 2000 else None
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, None if cover is None else len(cover)


def test_counts(rows):
    texts = [t for _, t, *_ in rows] + ["a b c a b c a b c\na b c\n\n \n#|<é> ñ\né"]
    for text, got in zip(texts, quality_rules.counts(pa.array(texts, pa.string())).tolist(), strict=True):
        want = brute_counts(text)
        assert [g for g, x in zip(got[:5], want, strict=True) if x is not None] == [x for x in want if x is not None], text


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.6) | (rng.random(3000) < 0.1)).astype(float)
    free = quality_rules.fit_trees(x, y, np.array([0, 0, 0]))
    assert ((free.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
    y = np.where(x[:, 1] < 0.5, 1.0, np.where(x[:, 1] < 0.8, 0.0, 1.0))
    down = quality_rules.fit_trees(x, y, np.array([0, -1, 0]))
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 1] = np.tile(np.linspace(0, 1, 40), 50)
    steps = np.diff(down.margin(grid).reshape(50, 40), axis=1)
    assert (steps <= 1e-12).all() and (steps < -0.1).any()


def walked(trees, row):
    total = trees.base
    for node in trees.roots:
        while trees.feature[node] >= 0:
            node = trees.left[node] + (row[trees.feature[node]] > trees.border[node])
        total += trees.value[node]
    return 1 / (1 + math.exp(-total))


def test_verdicts_equal_a_walk_through_the_trees(spark):
    marks = common.labels(spark, SF01)
    measured = quality_rules.measure(common.documents(spark, SF01).select("doc_id", "text"))
    trees = quality_rules.fit(measured, marks)
    for r in quality_rules.judge(measured, trees).collect():
        row = quality_rules.features(np.array([[r[c] for c in quality_rules.COUNTS]], dtype=np.int64))[0]
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.quality == pytest.approx(walked(trees, row)) and r.kept == (not failed and r.quality >= 0.5)


def test_quality_rules(spark, docs, empty):
    marks = common.labels(spark, SF01)
    train = quality_rules.measure(common.documents(spark, SF01).select("doc_id", "text"))
    trees = quality_rules.fit(train, toxicity.training_labels(marks))
    judged = quality_rules.judge(train, trees).join(marks.select("doc_id"), "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).select("kept", "quality").collect()
    assert len(judged) > 50
    rows = quality_rules.judge(quality_rules.measure(docs), trees).collect()
    assert all(not r.kept for r in rows if r.base_failed) and all(r.base_failed for r in rows if r.n_words < 50)
    assert quality_rules.judge(quality_rules.measure(empty), trees).count() == 0
    assert quality_rules.fit(train, marks.filter("quality = 1")) is None
    assert all(r.kept != r.base_failed for r in quality_rules.judge(quality_rules.measure(docs), None).collect())


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] >= cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over


def test_mix(docs, rows):
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    targets = brute_targets(sizes)
    got = source_mix.mix(docs.withColumn("key", F.lit("own")).withColumn("n", F.lit(1))).collect()
    again = source_mix.mix(docs.withColumn("key", F.lit("own")).withColumn("n", F.lit(1)).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and got[0].key == "own"
    taken, longest = {}, {}
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and r.source_size == sizes[r.source] and r.taken in (0, r.size, 2 * r.size)
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= longest[s]  # a repeated row counts with its twin


def test_mix_ranges_do_not_change_the_choice(spark, monkeypatch):
    docs = common.documents(spark, SF01)
    want = sorted((r.doc_id, r.taken) for r in source_mix.mix(docs).select("doc_id", "taken").collect())
    monkeypatch.setattr(source_mix, "RANGE_ROWS", 3)
    assert sorted((r.doc_id, r.taken) for r in source_mix.mix(docs).select("doc_id", "taken").collect()) == want
    monkeypatch.setattr(source_mix, "MAX_BROADCAST_SOURCES", 0)
    assert sorted((r.doc_id, r.taken) for r in source_mix.mix(docs).select("doc_id", "taken").collect()) == want


def test_mix_limits(spark, empty, docs):
    assert source_mix.mix(empty).count() == 0
    wordless = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in source_mix.mix(wordless).collect()] == [(0.0, 0)] * 2
    with pytest.raises(ValueError):
        source_mix.mix(docs, share=3, cap=2)
