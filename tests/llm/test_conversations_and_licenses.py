"""Conversation repair, conversation trie and license scans against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkit.llm import conversation_repair, conversation_trie, license_scan

SPACES = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string, audit string"


def turn_rows():
    """Conversations with null turns, roles, texts and ids, ties, repeated rows, blank, cut off and very long texts, a long one."""
    rng, rows = random.Random(5), []
    texts = ["Yes.", "No", "Well, then!", " ", "", "Why?\n", "ok . ", "same text.", None, "end. x", "ü."]
    for c in [*range(0, 90), 400, 401, 439]:
        for k in range(rng.randrange(0, 7)):
            rows.append((c, k + rng.randrange(2), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rng.choice(texts), "x"))
    for c in (40, 41, 45, 60):  # equal conversations
        rows += [(c, 10 + k, "user" if k % 2 == 0 else "assistant", f"turn {k} of the same talk.", "x") for k in range(6)]
    rows += [(100, k, "user" if k % 3 else "assistant", f"text {k % 90}" + ". " * (k % 4), "x") for k in range(700)]
    rows += [(7, 3, "user", "x" * 40_000 + ".", "x")] * 3
    rows += [(None, 1, "user", "no id.", "x"), (None, None, "assistant", "no turn.", "x"), (8, None, "system", "first.", "x"), (8, None, "system", "first.", "x"), (9, None, None, None, "x")]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame(turn_rows(), TURNS).repartition(6)


# ------------------------------------------------------------------------ repair


def brute_edits(rows):
    """Plain Dijkstra over (cost, audit) from the start; rows are (initial, must go, cut off)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, q, roles = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit, list(roles)
        if (i, q) in done:
            continue
        done.add((i, q))
        to = 3 if q == 2 else 2
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*roles, to)))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, (*roles, q)))
            if not gone:
                heapq.heappush(heap, (cost + 1 + 5 * cut, audit + "R", i + 1, to, (*roles, to)))
                own = {"s": 1, "u": 2, "a": 3}.get(initial)
                if own == to or own == 1 and q == 0:
                    heapq.heappush(heap, (cost + 5 * cut, audit + "K", i + 1, own, (*roles, own)))


def test_least_audits_of_random_rows():
    rng = random.Random(1)
    for _ in range(4000):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.4) for _ in range(rng.randrange(9))]
        codes = bytes({"s": 1, "u": 2, "a": 3}.get(i, 0) | 4 * gone | 8 * (cut and not gone) for i, gone, cut in rows)
        rows = [(i, gone, cut and not gone) for i, gone, cut in rows]
        assert conversation_repair.cheapest_edits(codes) == brute_edits(rows), rows


def test_long_conversations_take_time_in_proportion():
    codes = bytes(random.Random(2).choice((1, 2, 3, 6, 10, 11)) for _ in range(20_000))
    cost, audit, states = conversation_repair.cheapest_edits(codes)
    spent, at = 0, 0
    for letter in audit:
        spent += {"D": 2, "I": 5, "K": 0, "R": 1}[letter] + (5 if letter in "KR" and codes[at] & 8 else 0)
        at += letter != "I"
    assert (spent, at, states[-1]) == (cost, len(codes), 3)


def brute_repair(rows):
    sp = lambda x: " " if x is None else x
    convs = {}
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        own = convs.setdefault(conv, [])
        role, text = sp(role), sp(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, states, faults = set(), [], [0, 0, 0]
        for _, role, text in own:
            blank = not text.strip(SPACES)
            again = not blank and (role, text) in seen
            cut = not blank and not again and text.strip(SPACES)[-1] not in ".!?"
            for i, x in enumerate((blank, again, cut)):
                faults[i] += x
            seen.add((role, text))
            states.append((role[:1], blank or again, cut))
        turns = [t for t, *_ in own if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, roles = brute_edits(states)
        left, lines = list(own), []
        for letter, q in zip(audit, roles):
            row = None if letter == "I" else left.pop(0)
            if letter != "D":
                role = row[1] if letter == "K" else {2: "user", 3: "assistant"}[q]
                lines.append(f"{role}:{row[2] if row else ''}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def test_conversation_repair(talks):
    damaged = conversation_repair.damage(talks)
    got = conversation_repair.digests(conversation_repair.repair(damaged, absent="absent"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_repair(turn_rows())


def test_repaired_rows_and_spooled_texts(spark, monkeypatch):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("system", "Be kind."), ("tool", "Hello."), ("assistant", "x" * 9_000_000 + "."), ("user", ""), ("user", "Bye.")])]
    got = conversation_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    first, *edits = [r.asDict() for r in got.collect()]
    assert (first["audit"], first["cost"], first["blank"], first["number"]) == ("KRKDD", 5, 1, 0)
    assert [(e["edit"], e["role"], len(e["text"] or "")) for e in edits] == [("K", "system", 8), ("R", "user", 6), ("K", "assistant", 9_000_001), ("D", None, 0), ("D", None, 0)]


def test_conversation_repair_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversation_repair.digests(conversation_repair.repair(conversation_repair.damage(none), absent="absent")).count() == 0


# -------------------------------------------------------------------------- trie


def brute_trie(rows, block=20, heads=4):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    for own in convs.values():
        own.sort()
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole = tuple((r[3], r[4]) for r in convs.get(c - c % block, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            node = nodes.setdefault(whole[:d], {"members": [], "ends": [], "children": 0})
            node["members"].append(c)
            if d == len(whole):
                node["ends"].append(c)
    for key in nodes:
        if key:
            nodes[key[:-1]]["children"] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for key, node in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += node["children"] == 0
            saved[key[:d]] += (len(node["members"]) - 1) * words
    out = []
    for key, node in nodes.items():
        up = min(nodes[key[:-1]]["members"]) if key else None
        out.append((min(node["members"]), len(key), up, len(node["members"]), node["children"], leaves[key], saved[key], hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "heads"), [(20, 4), (7, 2), (1, 1)])
def test_trie(spark, talks, block, heads):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # conversations lie across borders of parts
    try:
        got = conversation_trie.trie(talks, block=block, heads=heads).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, got), key=str) == brute_trie(turn_rows(), block, heads)


def test_trie_takes_other_fingerprints_when_two_are_equal(talks):
    def lanes(d1, d2, seed):
        return (np.ones(len(d1), np.uint64),) * 2 if seed == 0 else conversation_trie.mixed(d1, d2, seed)

    assert sorted(map(tuple, conversation_trie.trie(talks, lanes=lanes).collect()), key=str) == brute_trie(turn_rows())
    with pytest.raises(RuntimeError):
        conversation_trie.trie(talks, lanes=lambda d1, d2, seed: (np.ones(len(d1), np.uint64),) * 2)


def test_trie_pieces_of_ids(spark, monkeypatch):
    rows = [(c, 0, "user", "hello there", "x") for c in range(20_000)]
    got = {r.depth: r for r in conversation_trie.trie(spark.createDataFrame(rows, TURNS), block=1, heads=1).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()
    assert (got[0].n_convs, got[0].n_leaves, got[0].saved_tokens, got[1].saved_tokens) == (20_000, 1, 2 * 19_999, 2 * 19_999)


def test_trie_of_nothing(spark):
    assert conversation_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert conversation_trie.trie(spark.createDataFrame([(None, 0, "user", "x", "x")], TURNS)).count() == 0
    with pytest.raises(ValueError):
        conversation_trie.trie(spark.createDataFrame([], TURNS), block=0)


# ---------------------------------------------------------------------- licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def split(text):
    return WORD.findall((text or "").translate(UPPER))


def license_texts():
    mit = next(t.text for t in license_scan.TEMPLATES if t.label == "mit" and "hereby" in t.text)
    gpl = next(t.text for t in license_scan.TEMPLATES if t.label == "gpl-2.0")
    filler = "Some words that stand before, after and between the notices of this very file. " * 30
    return [
        None, "", " \n", "CC", "CC BY", "cc-by, CC by; cc\nby cc_by ccby", "All rights reserved. all RIGHTS reserved all rights  reserved", "Éall rights reserved", "general public license",
        f"{filler}{mit}.{filler}", f"{filler}{mit.replace('free of charge', 'for a fee')}", f"x {mit[40:]}", gpl, gpl.replace("version 2", "version 9"), gpl.replace("GNU", "the GNU"), "Licensed under CC BY-NC 4.0.",
        "Licensed under the Apache License, Version 2.0." * 3, "license " * 5000 + "mit license", "apache license version 2 0", "Released under the MIT Licence", f"{mit} {gpl} Licensed under CC BY 4.0", "x" * 100_000 + " all rights reserved",
    ]


def brute_scan(texts):
    docs = [split(t) for t in texts]
    found = []
    every = {w for t in license_scan.TEMPLATES for w in split(t.text)} | {w for p in PHRASES for w in split(p)}
    idf = {w: np.log((len(docs) + 1) / (sum(w in set(d) for d in docs) + 1)) for w in every}
    order = {w: int(license_scan.hashes(w)[0]) for w in every}
    for d in docs:
        spans = [(label, i) for p, label in PHRASES.items() for i in range(len(d)) if d[i : i + len(split(p))] == split(p)]
        labels = {x for x, _ in spans}
        for t in license_scan.TEMPLATES:
            words = split(t.text)
            ranked = sorted(set(words), key=lambda w: (-idf[w], order[w]))
            rare = [w for k, w in enumerate(ranked) if k < 2 or idf[w] >= np.log(10) - 1e-12]
            own = [w for w in rare if w in d][:8]
            votes = {}
            for p, w in enumerate(d):
                if w in own:
                    for q in (q for q, x in enumerate(words) if x == w):
                        votes.setdefault(p - q, set()).add(w)
            for begin, spoken in votes.items():
                places = []
                for phrase in map(split, t.phrases):
                    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase) + begin
                    places.append(any(d[i : i + len(phrase)] == phrase for i in range(max(0, at - 8), min(len(d) - 1, at + 8) + 1)))
                if len(spoken) >= 2 and all(places):
                    labels.add(t.label)
        found.append((len(d), len(spans), min((i for _, i in spans), default=None), ",".join(sorted(labels))))
    return found


def test_license_scan(spark):
    texts = license_texts()
    docs = spark.createDataFrame([(i, t, "own", i) for i, t in enumerate(texts)], "id long, text string, spans string, doc_id long").repartition(3)
    got = {r.id: r for r in license_scan.scan(docs, PHRASES).collect()}
    want = brute_scan(texts)
    for i in range(len(texts)):
        base = [s for s in got[i].spans if s.phrase]
        assert (got[i].n_words, len(base), min((s.start for s in base), default=None), ",".join(sorted({s.label for s in got[i].spans}))) == want[i], texts[i]
        assert all(0 <= s.share <= 1 for s in got[i].spans)
    labels = [x[-1] for x in want]
    assert labels[9:11] == ["mit", ""] and labels[12].startswith("gpl") and labels[15] == "cc-by,cc-by-nc-4.0"


def test_license_scan_of_nothing(spark, empty):
    assert license_scan.scan(empty, PHRASES).count() == 0
    assert license_scan.scan(spark.createDataFrame([(1, "mit license")], "doc_id long, text string"), None, templates=()).first().spans == []
    with pytest.raises(ValueError):
        license_scan.scan(empty, {"-": "x"})
