"""Conversation structure repair: the cheapest edits, by bidirectional Dijkstra over the edit lattice.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``.  Edits:
Keep a row (0), Rerole it to user or assistant (1), Delete it (2; the only one for
blank and duplicate rows), Insert an empty turn of user or assistant anywhere (5).
Rows that are cut off and not deleted cost 5 more.

The lattice's nodes are (rows read, state); states say what may follow: 0 nothing
kept yet, 1 a system turn, 2 a user turn, 3 an assistant turn.  One heap of
distances starts at the first row, one at both legal ends; the smaller one is
advanced until the sum of their tops exceeds the best crossing, so that every
cheapest path has an edge from a node settled forward to one settled in reverse.
Of all these crossings the least concatenation of edits by their initials (ASCII)
is read off letter by letter: an initial leaves a node by one edge at most, and a
node is on a cheapest path if it is settled in reverse with the rest of the cost or
leads forward to a crossing.

Rows of a conversation are put together by one shuffle and sorted by turn (nulls
first, ties by role and text) by Spark, which spills.  A task reads them as a stream:
of a conversation it holds some numbers a row and a digest of each distinct turn; its
texts wait in a temporary file that is gone when they have been read (in memory up to
``SPOOL_BYTES``).  A conversation is never split, since its edits depend on each
other from end to end.

Defined results: null turns come first and count for no gap; null roles and texts are
one space, so such rows are blank or have a role that can't be kept; null conversation
ids are one conversation.  Equal rows are duplicates of the first.  Conversations
without rows have no edits.  Very long texts stay whole.  Other columns are not used.
"""

from __future__ import annotations

import heapq
import re
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.llm.common import fresh, released

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
SPOOL_BYTES, OUT_ROWS, OUT_BYTES = 8_000_000, 2_000, 4_000_000

#: Codes of rows for the lattice: the state that the role leads to when it is kept (0: none), must go, is cut off.
_INITIAL = {"s": 1, "u": 2, "a": 3}
_GONE, _CUT = 4, 8
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_ROLES = {2: "user", 3: "assistant"}
_LEGAL = {"su", "ua", "au"}


# ------------------------------------------------------------------ edit lattice


def _next(rows: bytes, n: int, i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits that leave a node, least initial first: initial, cost, and the node (rows read, state) they lead to."""
    after = 3 if q == 2 else 2
    if i < n:
        yield "D", DELETE, i + 1, q
    yield "I", INSERT, i, after
    if i < n and not rows[i] & _GONE:
        own, more = rows[i] & 3, CUT_OFF if rows[i] & _CUT else 0
        if own == after or own == 1 and q == 0:
            yield "K", KEEP + more, i + 1, own
        yield "R", REROLE + more, i + 1, after


def _before(rows: bytes, i: int, q: int) -> Iterator[tuple[int, int, int]]:
    """The same edges from their heads: cost and the node they come from."""
    froms = () if q in (0, 1) else (0, 1, 3) if q == 2 else (2,)
    for p in froms:
        yield INSERT, i, p
    if i:
        row = rows[i - 1]
        yield DELETE, i - 1, q
        if not row & _GONE:
            own, more = row & 3, CUT_OFF if row & _CUT else 0
            for p in froms:
                if own == q:
                    yield KEEP + more, i - 1, p
                yield REROLE + more, i - 1, p
            if q == 1 and own == 1:
                yield KEEP + more, i - 1, 0


def cheapest_edits(rows: bytes) -> tuple[int, str, list[int]]:
    """Cost, least audit, and the state after each edit, for the rows' codes."""
    n = len(rows)
    if not n:
        return 0, "", []
    far = 2**31 - 1
    ahead, back = array("i", [far]) * (4 * n + 4), array("i", [far]) * (4 * n + 4)  # settled or not, by node 4 * i + q
    done_ahead, done_back = bytearray(4 * n + 4), bytearray(4 * n + 4)
    ahead[0] = back[4 * n] = back[4 * n + 3] = 0
    heap_ahead, heap_back = [(0, 0)], [(0, 4 * n), (0, 4 * n + 3)]
    best = far
    while heap_ahead and heap_back and heap_ahead[0][0] + heap_back[0][0] <= best:
        if heap_back[0][0] <= heap_ahead[0][0]:
            d, x = heapq.heappop(heap_back)
            if done_back[x]:
                continue
            done_back[x] = 1
            best = min(best, d + ahead[x]) if ahead[x] < far else best
            for cost, i, q in _before(rows, x >> 2, x & 3):
                y = 4 * i + q
                if d + cost < back[y]:
                    back[y] = d + cost
                    heapq.heappush(heap_back, (d + cost, y))
        else:
            d, x = heapq.heappop(heap_ahead)
            if done_ahead[x]:
                continue
            done_ahead[x] = 1
            best = min(best, d + back[x]) if back[x] < far else best
            for _, cost, i, q in _next(rows, n, x >> 2, x & 3):
                y = 4 * i + q
                if d + cost < ahead[y]:
                    ahead[y] = d + cost
                    heapq.heappush(heap_ahead, (d + cost, y))
    # Nodes settled forward that lead to a crossing at the least cost.
    on = bytearray(4 * n + 4)
    todo = []
    for x in range(4 * n + 4):
        if done_ahead[x] and any(done_back[4 * i + q] and ahead[x] + cost + back[4 * i + q] == best for _, cost, i, q in _next(rows, n, x >> 2, x & 3)):
            on[x] = 1
            todo.append(x)
    while todo:
        x = todo.pop()
        for cost, i, q in _before(rows, x >> 2, x & 3):
            y = 4 * i + q
            if done_ahead[y] and not on[y] and ahead[y] + cost == ahead[x]:
                on[y] = 1
                todo.append(y)
    i = q = spent = 0
    audit, states = [], []
    while i < n or q not in (0, 3):
        for letter, cost, j, p in _next(rows, n, i, q):
            y, total = 4 * j + p, spent + cost
            if done_back[y] and total + back[y] == best or on[y] and total == ahead[y]:
                break
        else:
            raise AssertionError("no cheapest path goes on from here")
        audit.append(letter)
        states.append(p)
        i, q, spent = j, p, total
    return best, "".join(audit), states


# ------------------------------------------------------------------ conversations


class _Conversation:
    """Rows of one conversation, added by turn."""

    def __init__(self, conv):
        self.conv, self.codes, self.seen = conv, bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.low = self.high = self.last = None
        self.texts = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)  # noqa: SIM115  closed with the conversation

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            self.n_turns += turn != self.high  # they come sorted
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        self.illegal += self.last is not None and self.last + initial not in _LEGAL
        self.last = initial
        code = _INITIAL.get(initial, 0)
        key = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"))
        solid = _SOLID.search(text)
        if not solid:
            self.blank += 1
            code |= _GONE
        elif key in self.seen:
            self.duplicate += 1
            code |= _GONE
        else:
            if text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                self.truncated += 1
                code |= _CUT
            for part in (role, text):
                data = part.encode("utf-8", "surrogatepass")
                self.texts.write(len(data).to_bytes(8, "little"))
                self.texts.write(data)
        self.seen.add(key)
        self.codes.append(code)

    def _text(self) -> str:
        return self.texts.read(int.from_bytes(self.texts.read(8), "little")).decode("utf-8", "surrogatepass")

    def rows(self) -> Iterator[tuple]:
        """The summary, then a row for each edit: number, initial, role and text after it (null if deleted)."""
        cost, audit, states = cheapest_edits(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n_turns
        yield (self.conv, 0, None, None, None, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)
        self.texts.seek(0)
        at = 0
        for number, (letter, state) in enumerate(zip(audit, states, strict=True), 1):
            role = text = None
            if letter == "I":
                role, text = _ROLES[state], ""
            else:
                if not self.codes[at] & _GONE:
                    role, text = self._text(), self._text()
                    role = _ROLES[state] if letter == "R" else role
                if letter == "D":
                    role = text = None
                at += 1
            yield (self.conv, number, letter, role, text, *[None] * 7)
        self.texts.close()


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", absent: str | None = None) -> DataFrame:
    """The repaired conversations, each as neighbouring rows of one part.

    A conversation's first row (``number`` 0) has its faults, the cost and the audit; a row
    for each edit follows: its initial, and the role and text that it leaves (null: deleted).
    ``absent`` may name a boolean column: rows in which it is true only name a conversation.
    """
    spark_type = rows.schema[conv_col].dataType
    own = F.lit(False) if absent is None else F.coalesce(F.col(absent), F.lit(False))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    narrow = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"), own.alias("absent"))
    placed = narrow.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    schema = T.StructType([T.StructField(conv_col, spark_type), *(T.StructField(c, t) for c, t in (("number", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("text", T.StringType()))), *(T.StructField(c, T.LongType()) for c in _SUMMARY), T.StructField("audit", T.StringType())])
    arrow = [None, pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(_SUMMARY), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kind = [], 0, None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(zip(*held, strict=True), arrow, strict=True)], names=schema.names)

        now = None
        for part in batches:
            kind = part.schema.field("conv").type
            for k in range(0, part.num_rows, 256):
                piece = part.slice(k, 256)
                for conv, turn, role, text_, gone in zip(*(piece.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "absent")), strict=True):
                    if now is None or conv != now.conv:
                        for row in now.rows() if now else ():
                            held.append(row)
                            size += len(row[4] or "") + len(row[-1] or "")
                            if len(held) >= OUT_ROWS or size > OUT_BYTES:
                                yield batch()
                                held, size = [], 0
                        now = _Conversation(conv)
                    if not gone:
                        now.add(turn, role, text_)
        for row in now.rows() if now else ():
            held.append(row)
            size += len(row[4] or "") + len(row[-1] or "")
            if len(held) >= OUT_ROWS or size > OUT_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    return placed.mapInArrow(released(run), schema)


def digests(repaired: DataFrame, conv_col: str = "conv_id", out: str = "repaired_sha256") -> DataFrame:
    """A row per conversation of ``repair``'s result: its summary, and the SHA-256 of its ``role:text`` lines.

    Reads a conversation's rows as the stream that ``repair`` gives, without a shuffle.
    """
    import hashlib

    columns = [conv_col, *_SUMMARY, "audit"]
    schema = T.StructType([*(repaired.schema[c] for c in columns), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = first = head = None

        def done(heads: list, ends: list) -> pa.RecordBatch:
            table = pa.Table.from_batches(heads).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([*table.columns, pa.array(ends, pa.string())], names=schema.names)

        for batch in batches:
            heads, ends = [], []
            for k, (number, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("number", "role", "text")), strict=True)):
                if number == 0:
                    if head is not None:
                        heads.append(head)
                        ends.append(state.hexdigest())
                    head, state, first = batch.slice(k, 1).select(columns), hashlib.sha256(), True
                elif role is not None:
                    state.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                    first = False
            if heads:
                yield done(heads, ends)
        if head is not None:
            yield done([head], [state.hexdigest()])

    return repaired.mapInArrow(released(run), schema)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", absent: str = "absent") -> DataFrame:
    """Conversations with faults, by crc32 of ``conv:turn`` (nulls: one space) modulo 20.

    0 drops a row (it stays, with ``absent`` true, to name its conversation), 1 empties its
    text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 gives it to user.
    """
    conv, turn, role, text, kind = fresh(rows, "_conv", "_turn", "_role", "_text", "_kind")
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(F.col(conv_col).alias(conv), F.col(turn_col).alias(turn), part(role_col).alias(role), part(text_col).alias(text), (F.crc32(F.concat_ws(":", part(conv_col), part(turn_col))) % 20).alias(kind))
    changed = F.when(F.col(kind) == 1, "").when(F.col(kind) == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    copies = F.explode(F.when(F.col(kind) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return named.select(F.col(conv).alias(conv_col), F.col(turn).alias(turn_col), F.when(F.col(kind) == 4, "user").otherwise(F.col(role)).alias(role_col), changed.alias(text_col), (F.col(kind) == 0).alias(absent), copies.alias("copy")).drop("copy")
