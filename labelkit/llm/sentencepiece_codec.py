"""SentencePiece encoding and decoding with seeded merge-dropout.

A merge-type (BPE) SentencePiece model is read with the public library on the
driver; its pieces travel to the tasks as a broadcast of fixed size.  Encoding
is an agenda per unit: adjacent symbols that form a piece are candidates,
the best-scored (then leftmost) one is merged next.  With dropout, a candidate is
skipped when its turn comes if a keyed hash of (seed, document's id, the unit's
number in the document, place, piece) falls below the rate: every occurrence of a
word has draws of its own.  Symbols that are no piece become byte pieces.

A unit is a stretch that no merge can leave: white space and the letters after
it; no piece goes on beyond a letter followed by white space, and line breaks
and tabs are in no piece.  A unit's segmentation is a function of its text and of
the candidates that are skipped, so tasks remember those that they need twice or more
within a slice (a bounded number) as a tree for each unit: its root is the agenda without
skips, the child of a candidate is the agenda in which this one is skipped as well.  An
occurrence draws for all candidates of a node at once and goes to the child of the first one
skipped, or has the node's pieces; where no node is remembered, and after ``DEPTH``
skips, it gets an agenda of its own.  Agendas of a slice run side by side.  What is
remembered changes no result: the same document gets the same pieces on every run and partitioning.

Decoding turns pieces into text: byte pieces into bytes, the space sign into a
space, less the one set before the text.  decode(encode(text)) is the text; a
space sign that a text has itself is encoded as bytes.

Defined results: null text, null ids; empty text, no ids; null ids count as id
"null" in the key.  Extra columns pass through, columns named as results are
replaced.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelkit.llm.common import chunks, mix, released

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 17
#: Remembered segmentations; longest unit that has any; skips after which none are remembered; units, and bytes of text, handled at once.
CACHE_UNITS, LONG_UNIT, DEPTH, SLICE_UNITS, SLICE_BYTES = 200_000, 48, 2, 150_000, 1_000_000
SPACE = "▁"

_UNIT = re.compile("▁*[^▁\n\t\x00]+|▁+|[\n\t\x00]")


class Pieces:
    """The pieces of a merge-type model: symbols, the merges of two symbols, scores, bytes."""

    def __init__(self, model: bytes):
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.content: list[bytes] = []
        scores = []
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            scores.append(-lib.get_score(i))
            if lib.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.content.append(bytes([int(piece[3:-1], 16)]))
            elif lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i):
                self.content.append(b"")
            else:
                self.ids[piece] = i
                self.content.append(piece.replace(SPACE, " ").encode())
        self.flat = np.frombuffer(b"".join(self.content), dtype=np.uint8)
        self.sizes = np.array([len(x) for x in self.content], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces: texts would not decode to themselves")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or any(c in p for p in self.ids if len(p) > 1 for c in "\n\t\x00"):
            raise ValueError("a piece of the model crosses the borders of units")
        self.byte_table = np.array([self.byte_ids[b] for b in range(256)], dtype=np.int32)
        # Symbols: pieces, then characters that are none; the latter end as bytes and merge with nothing.
        self.size = len(scores)
        merges = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                if piece[:k] in self.ids and piece[k:] in self.ids:
                    merges[(self.ids[piece[:k]] << 32) | self.ids[piece[k:]]] = i
        keys = np.array(sorted(merges), dtype=np.int64)
        self.keys = np.append(keys, np.int64(2**62))
        self.made = np.append(np.array([merges[k] for k in keys.tolist()], dtype=np.int32), np.int32(-1))
        # The order of scores; of merge -1: never.
        order = np.unique(np.array(scores, dtype=np.float64), return_inverse=True)[1]
        self.cost = np.append(order, 2**30).astype(np.int32)
        # The symbol of a character: its piece, or below -2 a code that names the character.
        self.first = (-3 - np.arange(0x110000)).astype(np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.first[ord(piece)] = i
        self.codecs: dict[tuple, Codec] = {}  # of this process, with the units they know

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that pairs of symbols form, or -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)

    def spelled(self, symbols: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols of ``count`` units, characters without a piece spelled in bytes, and each unit's number of ids."""
        point = -3 - symbols
        plain = symbols >= 0
        if plain.all():
            return symbols.astype(np.int32), np.bincount(owner, minlength=count)
        n = np.where(plain, 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), dtype=np.int32)
        out[at[plain]] = symbols[plain]
        for j in range(4):
            some = ~plain & (n > j)
            size, code = n[some], point[some]
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size] | (code >> (6 * (size - 1)))
            byte = lead if j == 0 else 0x80 | ((code >> (6 * (size - 1 - j))) & 0x3F)
            out[at[some] + j] = self.byte_table[byte]
        return out, np.bincount(owner, n, count).astype(np.int64)

    def codec(self, *options) -> Codec:
        return self.codecs.setdefault(options, Codec(self, *options))


def _codes(place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """A number for each candidate: where it starts in the unit, and what it forms (never 0)."""
    with np.errstate(over="ignore"):
        return place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + piece.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)


def _skipped(keys: np.ndarray, codes: np.ndarray, bound: int) -> np.ndarray:
    """The keyed hash of candidates: whether their turn is skipped."""
    with np.errstate(over="ignore"):
        return (mix(keys + codes) >> np.uint64(32)) < np.uint64(bound)


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one range after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


class _Flat:
    """An array that grows."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.data):
            self.data = np.concatenate((self.data[: self.n], np.empty(max(end, self.n * 3 // 2) - self.n, self.data.dtype)))
        self.data[self.n : end] = values
        self.n = end


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, pieces: Pieces, dropout: float = 0.0, seed: int = SEED):
        if not 0 <= dropout < 1:
            raise ValueError("dropout must be in [0, 1)")
        self.pieces, self.bound, self.seed = pieces, int(dropout * 2**32), seed
        self.room = CACHE_UNITS
        self._forget()

    def _forget(self) -> None:
        """No node but the space sign of a text, in bytes."""
        sign = np.array([self.pieces.byte_ids[b] for b in SPACE.encode()], dtype=np.int32)
        self.roots: dict[str | None, int] = {}
        self.units: list[str | None] = []
        # Of each node the number of its unit, the codes of the candidates skipped (DEPTH, unused ones 0), and the ranges
        # of its ids and of its candidates after the last skip; of these candidates their codes and children.
        self.unit, self.gone = _Flat(np.int32), _Flat(np.uint64)
        self.ids, self.codes, self.child = _Flat(np.int32), _Flat(np.uint64), _Flat(np.int32)
        self.ids_at, self.ids_n, self.codes_at, self.codes_n = (_Flat(np.int32) for _ in range(4))
        self.roots[None] = 0
        self.units.append(None)
        self._add(np.zeros(1, np.int32), np.zeros((1, DEPTH), np.uint64), sign, np.array([len(sign)]), np.empty(0, np.uint64), np.array([0]))

    def _add(self, unit: np.ndarray, gone: np.ndarray, ids: np.ndarray, ids_n: np.ndarray, codes: np.ndarray, codes_n: np.ndarray) -> None:
        self.unit.add(unit)
        self.gone.add(gone.reshape(-1))
        for flat, values, at, n, sizes in ((self.ids, ids, self.ids_at, self.ids_n, ids_n), (self.codes, codes, self.codes_at, self.codes_n, codes_n)):
            at.add(flat.n + np.cumsum(sizes) - sizes)
            n.add(sizes)
            flat.add(values)
        self.child.add(np.full(len(codes), -1, np.int32))

    def _agendas(self, units: Sequence[str], keys: np.ndarray | int, gone: np.ndarray | None = None, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The units' ids, one after another, and the number of each, the agendas side by side: a step takes every unit's best candidate.

        Candidates are skipped by the occurrences' keys, or else just those whose
        codes are in the unit's row of ``gone``.  ``trace`` gets each step's units, codes and skips.
        """
        count, width = len(units), max(map(len, units))
        points = np.frombuffer("".join([u.ljust(width, "\0") for u in units]).encode("utf-32-le"), dtype=np.uint32).reshape(-1, width)
        full = width + 1  # the last column stands for what is beyond both ends
        grid = np.full((count, full), -1, dtype=np.int32)
        grid[:, :-1] = self.pieces.first[points]
        grid[:, :-1][np.arange(width) >= np.array([len(u) for u in units])[:, None]] = -1
        pairs = np.full((count, full), -1, dtype=np.int32)  # what the symbol at a place forms with the next one
        pairs[:, :-2] = self.pieces.merge(grid[:, :-2], grid[:, 1:-1])
        costs, never = self.pieces.cost[pairs], self.pieces.cost[-1]
        symbols, made, cost = grid.reshape(-1), pairs.reshape(-1), costs.reshape(-1)
        right = np.tile(np.append(np.arange(1, full), width).astype(np.int32), count)
        left = np.tile(np.append(width, np.arange(width)).astype(np.int32), count)
        keys = np.broadcast_to(np.asarray(keys, dtype=np.uint64), count)
        rows = np.arange(count)
        while True:
            place = costs[rows].argmin(axis=1)
            at = rows * full + place
            piece = made[at]
            on = piece >= 0
            if not on.all():
                rows, place, at, piece = rows[on], place[on], at[on], piece[on]
            if not len(rows):
                break
            if gone is not None or self.bound:
                code = _codes(place, piece)
                skip = _skipped(keys[rows], code, self.bound) if gone is None else (gone[rows] == code[:, None]).any(axis=1)
                if trace is not None:
                    trace.append((rows, code, skip))
                made[at[skip]], cost[at[skip]] = -1, never
                place, at, piece = place[~skip], at[~skip], piece[~skip]
            start = at - place
            joined = start + right[at]
            after, before = start + right[joined], start + left[at]
            symbols[at], symbols[joined], made[joined], cost[joined] = piece, -1, -1, never
            right[at], left[after] = right[joined], place
            made[at], made[before] = self.pieces.merge(piece, symbols[after]), self.pieces.merge(symbols[before], piece)
            cost[at], cost[before] = self.pieces.cost[made[at]], self.pieces.cost[made[before]]
        stays = grid != -1
        return self.pieces.spelled(grid[stays], np.nonzero(stays)[0], count)

    def _agenda(self, unit: str, key: int) -> np.ndarray:
        """The same for one long unit: a heap, so that the time grows with n log n."""
        pieces, n = self.pieces, len(unit)
        text = pieces.first[[ord(c) for c in unit]].tolist()
        gone, left, right = [False] * n, list(range(-1, n - 1)), list(range(1, n + 1))
        made = pieces.merge(np.array(text[:-1]), np.array(text[1:])).tolist() if n > 1 else []
        agenda = [(pieces.cost[p], i, i + 1, p) for i, p in enumerate(made) if p >= 0]
        heapq.heapify(agenda)
        pair = dict(enumerate(made))
        keys, known = np.array([key], dtype=np.uint64), {}

        def candidate(i: int, j: int) -> None:
            sides = (text[i], text[j])
            if sides not in known:
                known[sides] = int(pieces.merge(np.array([sides[0]]), np.array([sides[1]]))[0])
            pair[i] = known[sides]
            if pair[i] >= 0:
                heapq.heappush(agenda, (pieces.cost[pair[i]], i, j, pair[i]))

        while agenda:
            _, i, j, piece = heapq.heappop(agenda)
            if gone[i] or right[i] != j or pair.get(i) != piece:
                continue  # one side has merged with another neighbour
            if self.bound and _skipped(keys, _codes(np.array([i]), np.array([piece])), self.bound)[0]:
                pair[i] = -1
                continue
            text[i], gone[j] = piece, True
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                candidate(i, k)
            else:
                pair[i] = -1
            if left[i] >= 0:
                candidate(left[i], i)
        symbols = np.array([text[i] for i in range(n) if not gone[i]], dtype=np.int32)
        return pieces.spelled(symbols, np.zeros(len(symbols), np.int64), 1)[0]

    def encode_all(self, texts: Sequence[str], keys: Sequence[str]) -> list[np.ndarray]:
        """Piece ids of each text; its key and a unit's number in it pick the skips of this unit."""
        units: list[str | None] = []
        counts = []
        for text in texts:
            before = len(units)
            for k, part in enumerate(text.split(SPACE)) if text else ():
                units += [None] if k else []  # a space sign of the text itself
                units += _UNIT.findall(("" if k else SPACE) + part.replace(" ", SPACE))
            counts.append(len(units) - before)
        states = np.array([xxhash.xxh64_intdigest(f"{self.seed}|{key}") for key in keys], dtype=np.uint64)
        numbers = _ranges(np.zeros(len(counts), np.int64), np.array(counts, dtype=np.int64)).astype(np.uint64)
        with np.errstate(over="ignore"):
            draws = mix(np.repeat(states, counts) + numbers)
        parts = [self._encode_units(units[k : k + SLICE_UNITS], draws[k : k + SLICE_UNITS]) for k in range(0, len(units), SLICE_UNITS)]
        ids, sizes = (np.concatenate([*x]) for x in zip((np.empty(0, np.int32), np.empty(0, np.int64)), *parts, strict=True))
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0, *counts])]
        return [ids[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _encode_units(self, units: Sequence[str | None], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of occurrences with these keys, one after another, and the number of ids of each."""
        if self.unit.n >= self.room:
            self._forget()
        new = [u for u, n in Counter(units).items() if n > 1 and u not in self.roots and len(u) <= LONG_UNIT]
        self.units += new
        made = self._grow(np.arange(len(self.units) - len(new), len(self.units)), np.zeros((len(new), DEPTH), np.uint64))
        self.roots.update(zip(new, made.tolist(), strict=True))
        node = np.fromiter(map(self.roots.get, units, repeat(-1)), dtype=np.int64, count=len(units))
        live = np.flatnonzero(node >= 0)
        for depth in range(DEPTH + 1 if self.bound else 0):
            size = self.codes_n.data[node[live]]
            at = _ranges(self.codes_at.data[node[live]], size)
            hit = np.flatnonzero(_skipped(np.repeat(draws[live], size), self.codes.data[at], self.bound))
            row, first = np.unique(np.repeat(live, size)[hit], return_index=True)
            live, at = row, at[hit[first]]
            node[live] = -1  # an agenda of its own, unless there is a child
            if depth == DEPTH:
                break
            lacking, asked = np.unique(at[self.child.data[at] < 0], return_counts=True)
            lacking = lacking[asked > 1]
            parent = np.searchsorted(self.codes_at.data[: self.codes_at.n], lacking, "right") - 1
            gone = self.gone.data[: self.gone.n].reshape(-1, DEPTH)[parent]
            gone[:, depth] = self.codes.data[lacking]
            made = self._grow(self.unit.data[parent], gone)  # before the children are set: their array may grow
            self.child.data[lacking] = made
            node[live] = self.child.data[at]
            live = live[node[live] >= 0]
        held = node >= 0
        single = np.flatnonzero(~held)
        sizes, begin = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        sizes[held], begin[held] = self.ids_n.data[node[held]], self.ids_at.data[node[held]]
        content, begin[single], sizes[single] = self._own([units[i] for i in single.tolist()], draws[single])
        begin[single] += self.ids.n
        return np.concatenate((self.ids.data[: self.ids.n], content))[_ranges(begin, sizes)], sizes

    def _groups(self, units: Sequence[str]) -> Iterator[np.ndarray]:
        """The numbers of units of about the same length."""
        kind = (np.fromiter(map(len, units), dtype=np.int64, count=len(units)) + 1) // 2
        order = np.argsort(kind, kind="stable")
        cuts = np.flatnonzero(np.diff(kind[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield from (order[k : min(k + 10_000, b)] for k in range(a, b, 10_000))

    def _own(self, units: Sequence[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of occurrences by agendas of their own: all ids, where each occurrence's begin, and their number."""
        begin, sizes = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        flat, end = [np.empty(0, np.int32)], 0
        for group in self._groups(units) if units else ():
            if len(units[group[0]]) > LONG_UNIT - LONG_UNIT % 2:
                parts = [self._agenda(units[i], int(draws[i])) for i in group.tolist()]
                ids, n = np.concatenate(parts), np.array([len(x) for x in parts])
            else:
                ids, n = self._agendas([units[i] for i in group.tolist()], draws[group])
            begin[group], sizes[group] = end + np.cumsum(n) - n, n
            flat.append(ids)
            end += len(ids)
        return np.concatenate(flat), begin, sizes

    def _grow(self, unit: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """New nodes of units (numbers), in which just the candidates with the codes ``gone`` are skipped."""
        out, units = np.empty(len(unit), dtype=np.int64), [self.units[i] for i in unit.tolist()]
        for group in self._groups(units) if units else ():
            trace: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            ids, n = self._agendas([units[i] for i in group.tolist()], 0, gone[group], trace)
            none = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))
            rows, codes, skip = (np.concatenate(x) for x in zip(none, *(trace if self.bound else ()), strict=True))
            order = np.argsort(rows, kind="stable")
            rows, codes, skip = rows[order], codes[order], skip[order]
            last = np.full(len(group), -1)
            last[rows[skip]] = np.flatnonzero(skip)  # of several, the last one stays
            after = np.arange(len(rows)) > last[rows]
            out[group] = np.arange(len(group)) + self.unit.n
            self._add(unit[group], gone[group], ids, n, codes[after], np.bincount(rows[after], minlength=len(group)))
        return out

    def encode(self, text: str, key: str = "") -> list[int]:
        return self.encode_all([text], [key])[0].tolist()

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_all(np.asarray(ids, dtype=np.int64), np.array([0, len(ids)]))[0].as_py()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of runs of ids: one gather of the pieces' bytes."""
        size = self.pieces.sizes[ids]
        flat = self.pieces.flat[_ranges(self.pieces.begins[ids], size)]
        borders = np.concatenate(([0], np.cumsum(size)))[ends]
        # The space sign set before each text goes.
        full = borders[1:] > borders[:-1]
        lead = borders[:-1][full][flat[borders[:-1][full]] == 0x20]
        keep = np.ones(len(flat), dtype=bool)
        keep[lead] = False
        borders = borders - np.searchsorted(lead, borders)
        data = flat[keep].tobytes()
        try:
            texts = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(data))
            texts.validate(full=True)
        except pa.ArrowInvalid:  # ids that no text gave: bytes that are no UTF-8
            texts = pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)], pa.large_string())
        return texts.cast(pa.string())


def _broadcast(df: DataFrame, model_path: str):
    # Read by Spark, so that the model may lie in any store; the file has a fixed size.
    row = df.sparkSession.read.format("binaryFile").load(model_path if "://" in model_path else f"file://{model_path}").select("content").first()
    return df.sparkSession.sparkContext.broadcast(Pieces(bytes(row.content)))


def _with(df: DataFrame, columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in columns] + [T.StructField(k, t) for k, t in columns.items()])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "ids", model_path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``docs`` with the piece ids of each whole text in ``out``; a map without shuffle."""
    pieces = _broadcast(docs, model_path)
    schema = _with(docs, {out: T.ArrayType(T.IntegerType())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pieces.value.codec(dropout, seed)
        for part in (x for batch in batches for x in chunks(batch, text_col, SLICE_BYTES)):
            texts = part.column(text_col)
            ids = codec.encode_all([t or "" for t in texts.to_pylist()], ["null" if i is None else str(i) for i in part.column(id_col).to_pylist()])
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)), mask=texts.is_null())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in schema.names[:-1]), listed], names=schema.names)

    return docs.mapInArrow(released(run), schema)


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "text", model_path: str = MODEL) -> DataFrame:
    """``rows`` with the text of the piece ids in ``out``; a map without shuffle."""
    pieces = _broadcast(rows, model_path)
    schema = _with(rows, {out: T.StringType()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(pieces.value)
        for batch in batches:
            # Slices by number of ids, whole rows each.
            listed = batch.column(ids_col)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
                part = batch.slice(at, to - at)
                own = part.column(ids_col)
                flat = pc.list_flatten(own).to_numpy().astype(np.int64)
                texts = codec.decode_all(flat, np.concatenate(([0], ends[at:to] - (ends[at - 1] if at else 0))))
                texts = pc.if_else(own.is_null(), pa.scalar(None, pa.string()), texts)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in schema.names[:-1]), texts], names=schema.names)
                at = to

    return rows.mapInArrow(released(run), schema)
