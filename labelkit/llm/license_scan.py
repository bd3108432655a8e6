"""License scans: a positional index of rare words finds where license texts stand.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.

1. Document frequencies of the templates' words, over all documents (one map with
   sums that combine before the shuffle; a number for each template word).
2. The index, a broadcast of the templates' size: postings (template, position) of each
   template's words that are in at most a tenth of the documents, and in any case of its
   two rarest words.
3. Of each template's indexed words that a file holds, the ``RARE`` with the highest IDF are
   looked up.  A word at place p whose posting is at position q speaks for a beginning
   at p - q; places of different words are intersected by that: a beginning needs
   ``AGREE`` different words.
4. It is verified: every mandatory key phrase of the template must stand, word by word, within
   ``SLACK`` words of its place from there.  The span's share is the part of the
   template's IDF that is in its place.

Phrases that are to be found wherever they stand are templates without slack: every
occurrence of their rarest word is looked up, and all their words must be in place.

A map without shuffle but for the frequencies.  Words are known by 64-bit hashes.

Defined results: null, empty and wordless texts have no spans.  Rows with the same id are
scanned each for itself; extra columns pass through, columns named as results are
replaced.  The frequencies of an empty table are zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import Words, chunks, released, without

RARE, AGREE, SLACK, COMMON = 8, 2, 8, 0.1

_GAPS = np.ones(256, dtype=bool)
_GAPS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass(frozen=True)
class Template:
    """A license's label, a text by which it is told, and phrases of this text that must be there."""

    label: str
    text: str
    phrases: tuple[str, ...]


# Notices and openings of public licenses.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", ("gnu general public license", "version 2 of the license")),
    Template("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", ("gnu general public license", "version 3 of the license")),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0", ("cc by nd 4 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def hashes(text: str) -> np.ndarray:
    return words_of(pa.array([text])).hashes


def words_of(texts: pa.Array) -> Words:
    return Words(texts, lower=True, gaps=_GAPS)


class _Entry:
    """A word sequence: hashes, and its rarest word's position."""

    def __init__(self, words: np.ndarray, idf: Mapping[int, float]):
        self.words = words
        self.anchor = min(range(len(words)), key=lambda i: (-idf[int(words[i])], int(words[i]), i))

    def starts(self, words: Words, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Every place where it stands within one text; ``first`` and ``end``: word range of each word's text."""
        at = np.flatnonzero(words.hashes == self.words[self.anchor])
        at = at[(at - self.anchor >= first[at]) & (at - self.anchor + len(self.words) <= end[at])] - self.anchor
        for j, h in enumerate(self.words):
            at = at[words.hashes[at + j] == h]
        return at


class _Indexed(_Entry):
    """A template: its indexed words, rarest first, with their positions, and its key phrases with theirs."""

    def __init__(self, template: Template, idf: Mapping[int, float], least: float):
        super().__init__(hashes(template.text), idf)
        self.label = template.label
        ranked = sorted({int(w) for w in self.words}, key=lambda w: (-idf[w], w))
        self.rare = np.array([w for i, w in enumerate(ranked) if i < AGREE or idf[w] >= least], dtype=np.uint64)
        self.positions = [np.flatnonzero(self.words == w) for w in self.rare]
        self.weight = np.array([idf[int(w)] for w in self.words])
        self.phrases = []
        for phrase in template.phrases:
            entry = _Entry(hashes(phrase), idf)
            n = len(entry.words)
            place = [i for i in range(len(self.words) - n + 1) if (self.words[i : i + n] == entry.words).all()]
            if not n or not place:
                raise ValueError(f"{phrase!r} is not in the template of {template.label}")
            self.phrases.append((entry, place[0]))

    def spans(self, words: Words, text: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Verified beginnings (word numbers; they may lie outside the text by SLACK) and a word of the text of each."""
        order = np.argsort(self.rare)
        at = np.searchsorted(self.rare[order], words.hashes)
        at = np.minimum(at, len(order) - 1)
        place = np.flatnonzero(self.rare[order][at] == words.hashes)
        rank = order[at[place]]
        # Of each text, the RARE first ranks that it holds.
        held = np.unique(text[place] * len(order) + rank)
        number = np.arange(len(held)) - np.searchsorted(held // len(order), held // len(order))
        held = held[number < RARE]
        asked = np.isin(text[place] * len(order) + rank, held)
        place, rank = place[asked], rank[asked]
        begins, ranks, owners = [], [], []
        for r in range(len(order)):
            mine = place[rank == r]
            for q in self.positions[r].tolist():
                begins.append(mine - q)
                ranks.append(np.full(len(mine), r))
                owners.append(mine)
        begin, rank, owner = (np.concatenate(x) for x in (begins, ranks, owners))
        if not len(begin):
            return begin, owner
        # The number of different words that speak for one beginning in one text.
        order = np.lexsort((rank, begin, text[owner]))
        begin, rank, owner = begin[order], rank[order], owner[order]
        new = np.concatenate(([True], (begin[1:] != begin[:-1]) | (text[owner][1:] != text[owner][:-1])))
        other = new | np.concatenate(([True], rank[1:] != rank[:-1]))
        group = np.cumsum(new) - 1
        enough = np.bincount(group, other) >= min(AGREE, len(self.rare))
        begin, owner = begin[new][enough], owner[new][enough]
        for entry, offset in self.phrases:
            starts = entry.starts(words, first, end)
            low = np.searchsorted(starts, np.maximum(begin + offset - SLACK, first[owner]))
            high = np.searchsorted(starts, np.minimum(begin + offset + SLACK, end[owner] - 1), "right")
            begin, owner = begin[high > low], owner[high > low]
        return begin, owner

    def share(self, words: Words, begin: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The part of the template's weight that is in place."""
        got = np.zeros(len(begin))
        for j, h in enumerate(self.words):
            at = begin + j
            inside = (at >= first) & (at < end)
            got[inside] += self.weight[j] * (words.hashes[at[inside]] == h)
        total = self.weight.sum()
        return np.minimum(got / total, 1.0) if total > 0 else np.ones(len(begin))


def frequencies(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> tuple[int, dict[int, int]]:
    """The number of documents, and of those that hold each word of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for part in chunks(batch):
                words = words_of(part.column("text"))
                at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
                held = vocabulary[at] == words.hashes
                text = np.repeat(np.arange(part.num_rows), np.diff(words.first))
                df += np.bincount(np.unique(text[held] * len(vocabulary) + at[held]) % len(vocabulary), minlength=len(vocabulary))
                n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(df))], pa.int32()), pa.array([n, *df.tolist()], pa.int64())], names=["word", "df"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(released(count), "word int, df long").groupBy("word").agg(F.sum("df").alias("df")).collect()
    found = {r.word: r.df for r in rows}
    return found.get(-1, 0), {int(w): found.get(i, 0) for i, w in enumerate(vocabulary)}


def scan(docs: DataFrame, phrases: Mapping[str, str] | None = None, text_col: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """``docs`` with n_words and spans: an array of (label, start, n, share, phrase), by start.

    ``phrases`` maps phrases to labels: every place where one stands is a span (phrase: true).
    A template's span begins at the word where its text would (not before the text's first one).
    """
    phrases = dict(phrases or {})
    sequences = [hashes(x) for x in (*phrases, *(t.text for t in templates))]
    if not all(len(s) for s in sequences):
        raise ValueError("a phrase or template has no word")
    vocabulary = np.unique(np.concatenate(sequences)) if sequences else np.zeros(1, np.uint64)
    n, df = frequencies(docs, text_col, vocabulary)
    idf = {w: math.log((n + 1) / (k + 1)) for w, k in df.items()}
    index = docs.sparkSession.sparkContext.broadcast(
        ([(label, _Entry(hashes(x), idf)) for x, label in phrases.items()], [_Indexed(t, idf, -math.log(COMMON)) for t in templates])
    )
    span = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("n", T.LongType()), T.StructField("share", T.DoubleType()), T.StructField("phrase", T.BooleanType())])
    schema = T.StructType([*without(docs, ("n_words", "spans")), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(span))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, indexed = index.value
        for batch in batches:
            for part in chunks(batch, text_col):
                words = words_of(part.column(text_col))
                text = np.repeat(np.arange(part.num_rows), np.diff(words.first))
                first, end = words.first[text], words.first[text + 1]
                owners, columns = [np.zeros(0, np.int64)], []
                for label, entry in entries:
                    at = entry.starts(words, first, end)
                    owners.append(text[at])
                    columns.append((np.full(len(at), label, dtype=object), at - first[at], np.full(len(at), len(entry.words)), np.ones(len(at)), np.ones(len(at), bool)))
                for template in indexed:
                    begin, word = template.spans(words, text, first, end)
                    owners.append(text[word])
                    columns.append((np.full(len(begin), template.label, dtype=object), np.maximum(begin - first[word], 0), np.full(len(begin), len(template.words)), template.share(words, begin, first[word], end[word]), np.zeros(len(begin), bool)))
                owner = np.concatenate(owners)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                values = [np.concatenate([c[i] for c in columns]) if columns else np.zeros(0, dtype=object) for i in range(5)]
                order = np.lexsort((values[1], owner)) if len(owner) else owner
                ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=part.num_rows)))).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(v[order], k) for v, k in zip(values, kinds, strict=True)], fields=[pa.field(f.name, k) for f, k in zip(span, kinds, strict=True)])
                made = {"n_words": pa.array(np.diff(words.first).astype(np.int64)), "spans": pa.ListArray.from_arrays(pa.array(ends), structs)}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in names], names=names)

    return docs.mapInArrow(released(run), schema)
