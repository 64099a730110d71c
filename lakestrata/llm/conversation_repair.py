"""Repair of the turn structure of conversations by a shortest path over their rows, with block tables.

A row can be kept, given another role or deleted, and rows without text can be inserted, each at a cost, so that the initials of the
roles read ``(s?(ua)+)?``. For the path only nine kinds of rows matter, and four states (nothing yet, after a system, a user,
an assistant row). The cost of going on from each state, less the smallest of the four, takes few different values, the
*vectors*. For every vector and every block of ``BLOCK`` kinds a table has the vector before the block and what it adds to
the cost. Conversations are read from the end, a lookup for each block; the vectors at the ends of chunks are kept. Tracing goes
through the blocks the other way, from the first row on: each block is expanded row by row between its two vectors, and the
edit with the smallest letter among the cheapest is taken, which gives the least of all cheapest edit strings since a letter leads
to one state only. An expanded block is kept for the next time it is met.

Rows are sorted by range of conversation, turn, role and text, so that a conversation which holds much of the table is dealt over
many tasks. Each task cuts its rows into chunks, and only chunks' symbols, one byte a row, go by conversation through the two passes,
as streams that hold one chunk. Texts meet their edits by chunk. Only the digest of a whole conversation reads its
texts in order; it too holds one chunk. Equal rows are counted before they are sorted, and duplicates found by a first
turn of each role and text, so no key is worked on by one task as a group.

Results: a null id is a conversation of its own, with rows like any other. Null roles and texts must be replaced before (the query takes one
space). Rows of one turn, null turns first, come in the order of role and text; an equal row is a duplicate of the first.
Texts of any length are kept whole; bytes that are not UTF-8 become replacement characters. An empty table gives no rows. A number of turns that does not fit a long is
null. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import documents, ship, stored

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLOCK = 4
CHUNK_ROWS, CHUNK_BYTES = 4096, 1 << 20

# A row's symbol: initial (s, u, a, other) times 4, plus fault (none, truncated, blank, duplicate).
INITIALS, OTHER = "sua", 3
CLEAN, CUT, BLANK, DUPLICATE = range(4)
ROLE = {2: "user", 3: "assistant"}  # by the state it leads to
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ADVANCE = (_USER, _USER, _ASSISTANT, _USER)  # by a rerole or an insertion
_KEEP = {(_START, 0): _SYSTEM, (_START, 1): _USER, (_SYSTEM, 1): _USER, (_USER, 2): _ASSISTANT, (_ASSISTANT, 1): _USER}
_KINDS, _PAD = 10, 9
# Kind of a symbol: 0 must go, else 1 + 2 * initial + truncated.
_KIND = bytes(0 if s % 4 >= BLANK else 1 + 2 * (s // 4) + s % 4 for s in range(16)).ljust(256, b"\0")
_FAR = 1 << 20


def _edits(state: int, kind: int, after: tuple) -> Iterator[tuple[str, int, int]]:
    """(edit, cost of it and of all that follows, next state) of the ways to use up a row; ``after``: costs behind it."""
    yield "D", DELETE + after[state], state
    if kind:
        initial, cut = (kind - 1) // 2, TRUNCATED * ((kind - 1) % 2)
        kept = _KEEP.get((state, initial))
        if kept is not None:
            yield "K", cut + after[kept], kept
        yield "R", cut + REROLE + after[_ADVANCE[state]], _ADVANCE[state]


def _with_inserts(costs: list[int]) -> tuple:
    """Costs when up to two rows are inserted first; more than two lead back to the same state."""
    out = []
    for state in range(4):
        once = _ADVANCE[state]
        out.append(min(costs[state], INSERT + costs[once], 2 * INSERT + costs[_ADVANCE[once]]))
    return tuple(out)


def step(after: tuple, kind: int) -> tuple:
    """Costs from each state before a row, given those behind it."""
    if kind == _PAD:
        return after
    return _with_inserts([min(cost for _, cost, _ in _edits(state, kind, after)) for state in range(4)])


END = _with_inserts([0, _FAR, _FAR, 0])


class BlockTables:
    """Vectors, and for each vector behind a block and each block the vector before it and the cost added."""

    def __init__(self):
        def normal(costs):
            return tuple(c - min(costs) for c in costs)

        self.vectors, self.number = [normal(END)], {normal(END): 0}
        before, added = [], []
        for vector in self.vectors:  # grows until no new vector is met
            ways = [step(vector, kind) for kind in range(_KINDS)]
            for costs in ways:
                if normal(costs) not in self.number:
                    self.number[normal(costs)] = len(self.vectors)
                    self.vectors.append(normal(costs))
            before.append([self.number[normal(costs)] for costs in ways])
            added.append([min(costs) for costs in ways])
        one, cost = np.array(before), np.array(added)
        n = _KINDS**BLOCK
        self.before = np.repeat(np.arange(len(self.vectors))[:, None], n, 1)
        self.added = np.zeros_like(self.before)
        for place in range(BLOCK):  # the last kind of the block first
            kind = np.arange(n) // _KINDS**place % _KINDS
            self.added += cost[self.before, kind]
            self.before = one[self.before, kind]
        self.before, self.added = self.before.tolist(), self.added.tolist()
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    @staticmethod
    def blocks(symbols: bytes) -> list[int]:
        """The blocks of a chunk; the first is filled up in front with rows that change nothing."""
        kinds = symbols.translate(_KIND)
        kinds = bytes([_PAD]) * (-len(kinds) % BLOCK) + kinds
        return (np.frombuffer(kinds, np.uint8).reshape(-1, BLOCK) @ (_KINDS ** np.arange(BLOCK - 1, -1, -1))).tolist()

    def back(self, blocks: list[int], vector: int) -> tuple[list[int], int, int]:
        """(vector behind each block, vector before the first, cost of all) of blocks before a vector."""
        behind, cost = [], 0
        for block in reversed(blocks):
            behind.append(vector)
            cost += self.added[vector][block]
            vector = self.before[vector][block]
        return behind[::-1], vector, cost

    def expand(self, state: int, block: int, vector: int) -> tuple[str, int]:
        """(edits, state behind it) of a block entered in a state, with a vector behind it."""
        key = state, block, vector
        if key not in self.expanded:
            kinds = [block // _KINDS**place % _KINDS for place in range(BLOCK - 1, -1, -1)]
            costs = [self.vectors[vector]]
            for kind in reversed(kinds):
                costs.append(step(costs[-1], kind))
            costs.reverse()
            out = []
            for kind, here, after in zip(kinds, costs, costs[1:]):
                while kind != _PAD:
                    ways = [*_edits(state, kind, after), ("I", INSERT + here[_ADVANCE[state]], _ADVANCE[state])]
                    edit, _, state = min(way for way in ways if way[1] == here[state])
                    out.append(edit)
                    if edit != "I":
                        break
            self.expanded[key] = "".join(out), state
        return self.expanded[key]


@cache
def block_tables() -> BlockTables:
    return BlockTables()


def trailing(state: int) -> str:
    """Insertions behind the last row."""
    return {_START: "", _ASSISTANT: "", _USER: "I", _SYSTEM: "II"}[state]


def outcome(edits: str, state: int, live: Iterator[tuple[str, str]]) -> tuple[list[str], int]:
    """(``role:text`` of the rows that edits leave, state behind them); ``live`` has the rows that are neither blank nor duplicate.

    A deleted row that was not live has a symbol of its own in the edits: ``d``.
    """
    lines = []
    for edit in edits:
        role, text = next(live) if edit in "DKR" else ("", "")
        if edit == "K":
            state = _KEEP[state, INITIALS.index(role[0])]
            lines.append(f"{role}:{text}")
        elif edit in "RI":
            state = _ADVANCE[state]
            lines.append(f"{ROLE[state]}:{text}")
    return lines, state


def faulted(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, symbol, n`` of the different rows: initial and first fault, and the number of equal rows."""
    white = F.lit(" \t\n\x0b\x0c\r")
    rows = rows.select("conv_id", "turn", *[F.make_valid_utf8(c).alias(c) for c in ("role", "text")])
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # a null turn is the first
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("conv_id", "role", "text").agg(F.min(turn).alias("first"))
    first = first.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text")], "first")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role", "text")]
    trimmed = F.rtrim("text", white)
    fault = (
        F.when(trimmed == "", BLANK)
        .when(turn != F.col("first"), DUPLICATE)
        .when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), CLEAN)
        .otherwise(CUT)
    )
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(OTHER)
    marked = counted.join(first, same).withColumn("symbol", initial * 4 + fault)
    return marked.select("conv_id", "turn", "role", "text", "symbol", "n")


def chunked(rows: DataFrame) -> DataFrame:
    """``conv_id, part, chunk, symbols, live``: conversations in order, cut into chunks, stored.

    ``part`` and ``chunk`` put the chunks of all conversations in order; no other chunk has the same pair.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, part int, chunk long, symbols binary, live array<struct<role: string, text: string>>"
    pair = pa.struct([("role", pa.string()), ("text", pa.string())])

    def cut(batches):
        part, chunk = TaskContext.get().partitionId(), 0
        out, conv, symbols, live, size, started = [], None, bytearray(), [], 0, False

        def close():
            nonlocal symbols, live, size, chunk
            if symbols:
                out.append((conv, part, chunk, bytes(symbols), live))
                chunk += 1
                symbols, live, size = bytearray(), [], 0

        def full(id_type):
            nonlocal out
            kinds = [id_type, pa.int32(), pa.int64(), pa.binary(), pa.list_(pair)]
            names = ["conv_id", "part", "chunk", "symbols", "live"]
            columns = list(zip(*out)) or [[]] * 5
            out = []
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for first in range(0, batch.num_rows, 256):
                for id_, role, text, symbol, n in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns)):
                    if not started or id_ != conv:
                        close()
                        conv, started = id_, True
                    fault = symbol % 4
                    if fault < BLANK:
                        live.append({"role": role, "text": text})
                        size += len(text)
                    symbols.append(symbol)
                    more, again = n - 1, symbol - fault + max(fault, DUPLICATE if fault < BLANK else fault)
                    while more or len(symbols) >= CHUNK_ROWS or size >= CHUNK_BYTES:
                        take = min(more, CHUNK_ROWS)
                        symbols += bytes([again]) * take
                        more -= take
                        if len(symbols) >= CHUNK_ROWS or size >= CHUNK_BYTES:
                            close()
                            if out and len(out) >= 8:
                                yield full(id_type)
                if len(out) >= 256 or sum(len(o[3]) for o in out) > CHUNK_BYTES:
                    yield full(id_type)
        close()
        yield full(id_type)

    return stored(placed.select("conv_id", "role", "text", "symbol", "n").mapInArrow(cut, schema), "conversation-chunks")


def _by_conversation(df: DataFrame, back: bool = False) -> DataFrame:
    """All chunks of a conversation in one task, in order: a stream, of which the task holds one chunk."""
    places = [F.col(c).desc() if back else F.col(c).asc() for c in ("part", "chunk")]
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *places)


def edits(chunks: DataFrame) -> DataFrame:
    """``conv_id, part, chunk, state, edits, cost, blank, duplicate, truncated, illegal`` of each chunk, stored.

    ``state`` is the one a chunk is entered in, ``cost`` that of the conversation from this chunk on. A row that had to be
    deleted is ``d`` in the edits. Insertions behind the last row are part of the last chunk.
    """
    kind = chunks.schema["conv_id"].dataType.simpleString()

    def behind(batches):
        tables, conv, started, vector, cost = block_tables(), None, False, 0, 0
        for batch in batches:
            found = []
            ids, symbols = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for id_, row in zip(ids, symbols):
                last = not started or id_ != conv
                if last:
                    conv, started, vector, cost = id_, True, 0, 0
                after = vector
                _, vector, more = tables.back(tables.blocks(row), vector)
                cost += more
                found.append((after, cost + tables.vectors[vector][_START], last))
            columns = list(zip(*found)) or [[], [], []]
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], ["conv_id", "part", "chunk", "symbols", "behind", "cost", "last"])

    schema = f"conv_id {kind}, part int, chunk long, symbols binary, behind int, cost long, last boolean"
    known = _by_conversation(chunks.select("conv_id", "part", "chunk", "symbols"), back=True).mapInArrow(behind, schema)

    fine = {(0, 1), (1, 2), (2, 1)}
    counts = ("blank", "duplicate", "truncated", "illegal")

    def trace(batches):
        tables, conv, started, state, previous = block_tables(), None, False, _START, None
        for batch in batches:
            found = []
            for id_, row, vector, last in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 6))):
                if not started or id_ != conv:
                    conv, started, state, previous = id_, True, _START, None
                entered, pieces, blocks = state, [], tables.blocks(row)
                for block, after in zip(blocks, tables.back(blocks, vector)[0]):
                    piece, state = tables.expand(state, block, after)
                    pieces.append(piece)
                text = "".join(pieces)
                gone = [s % 4 >= BLANK for s in row]
                if any(gone):  # rows that had to go have no text to be looked up
                    flags, marked = iter(gone), []
                    for edit in text:
                        marked.append("d" if edit != "I" and next(flags) else edit)
                    text = "".join(marked)
                if last:
                    text += trailing(state)
                initials = [s // 4 for s in row]
                pairs = zip(initials if previous is None else [previous, *initials], initials[1:] if previous is None else initials)
                faults = [s % 4 for s in row]
                numbers = [faults.count(f) for f in (BLANK, DUPLICATE, CUT)] + [sum(p not in fine for p in pairs)]
                previous = initials[-1]
                found.append((entered, text, *numbers))
            columns = list(zip(*found)) or [[]] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.string(), *[pa.int64()] * 4))]
            head = [batch.column(i) for i in (0, 1, 2, 5)]
            yield pa.RecordBatch.from_arrays([*head, *arrays], ["conv_id", "part", "chunk", "cost", "state", "edits", *counts])

    schema = f"conv_id {kind}, part int, chunk long, cost long, state int, edits string, " + ", ".join(f"{c} long" for c in counts)
    return stored(_by_conversation(known).mapInArrow(trace, schema), "conversation-edits")


def repaired(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``edits`` and ``lines``, the repaired rows of each chunk as ``role:text``, joined by newlines."""
    both = chunks.select("part", "chunk", "live").join(found, ["part", "chunk"])

    def write(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                lines = []
                for live, state, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    rows = outcome(text, state, ((r["role"], r["text"]) for r in live))[0]
                    lines.append("\n".join(rows).encode())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(lines, pa.binary())], [*names, "lines"])

    kept = [c for c in found.columns if c not in ("state", "edits")]
    names = ["state", "edits", *kept]
    schema = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in names) + ", lines binary"
    return both.select("live", *names).mapInArrow(write, schema)


def digests(pieces: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, repaired_sha256`` and the counts of each conversation, from its chunks in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    counts = ("blank", "duplicate", "truncated", "illegal")
    names = ["conv_id", "cost", *counts, "audit", "repaired_sha256"]

    def add_up(batches):
        conv, started, numbers, audit, digest, lines, cost, out = None, False, [0] * 4, [], None, False, 0, []
        id_type = pa.int64()

        def close():
            if started:
                out.append((conv, cost, *numbers, "".join(audit).upper(), digest.hexdigest()))

        def full():
            kinds = [id_type, *[pa.int64()] * 5, pa.string(), pa.string()]
            columns = list(zip(*out)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            id_type = batch.column(0).type
            for id_, more, text, piece, *some in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if not started or id_ != conv:
                    close()
                    conv, started, numbers, audit, digest, lines, cost = id_, True, [0] * 4, [], hashlib.sha256(), False, more
                numbers = [a + b for a, b in zip(numbers, some)]
                audit.append(text)
                if piece:
                    digest.update(b"\n" + piece if lines else piece)
                    lines = True
            yield full()
        close()
        yield full()

    schema = f"conv_id {kind}, cost long, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string"
    ordered = _by_conversation(pieces.select("conv_id", "cost", "edits", "lines", *counts, "part", "chunk"))
    return ordered.select("conv_id", "cost", "edits", "lines", *counts).mapInArrow(add_up, schema)


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, cost, blank, duplicate, truncated, illegal, audit, repaired_sha256`` of conversations of ``conv_id, turn, role, text``."""
    ship(rows.sparkSession)
    chunks = chunked(faulted(rows))
    return digests(repaired(chunks, edits(chunks)))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the checksum of ``conv_id:turn`` calls for."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(text["role"])
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text["text"], "[.!?]", "")).otherwise(text["text"])
    rows = conversations.select("conv_id", "turn", role.alias("role"), said.alias("text"), kind.alias("kind")).filter("kind <> 0")
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), times)).alias("_")).drop("_")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired rows of every conversation, after damage."""
    conversations = documents(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    span = F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1).cast("long"))
    gaps = rows.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.try_subtract(span, F.count("turn")).alias("gaps"), F.count("turn").alias("_turns")
    )
    gaps = gaps.select(F.col("conv_id").alias("_conv"), F.when(F.col("_turns") == 0, 0).otherwise(F.col("gaps")).alias("gaps"))
    all_ = conversations.select("conv_id").distinct()
    found = all_.join(gaps, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    done = repair(rows).withColumnRenamed("conv_id", "_conv")
    found = found.join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    absent = F.col("repaired_sha256").isNull()
    numbers = [F.when(absent, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")
    )


def _oracle() -> str:
    keep = ", ".join(f"({q}, {i}, 'K', {q2}, 0)" for (q, i), q2 in _KEEP.items())
    rerole = ", ".join(f"({q}, NULL, 'R', {q2}, {REROLE})" for q, q2 in enumerate(_ADVANCE))
    delete = ", ".join(f"({q}, NULL, 'D', {q}, {DELETE})" for q in range(4))
    inserts = []
    for q in range(4):
        once = _ADVANCE[q]
        for q2, s in {q: "", once: "I", _ADVANCE[once]: "II"}.items() if q < _USER else {q: "", once: "I"}.items():
            inserts.append(f"({q}, {q2}, {INSERT * len(s)}, '{s}')")
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""WITH RECURSIVE
    crc AS (SELECT list(v ORDER BY n) AS tab FROM (SELECT n, list_reduce(range(8),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, n) AS v FROM range(256) AS t(n))),
    keyed AS (SELECT c.*, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
      FROM conversations AS c),
    hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)),
        lambda c, b: xor(tab[xor(c, b) % 256 + 1], c // 256), 4294967295), 4294967295) % 20 AS kind FROM keyed, crc),
    damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE kind <> 0),
    placed AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) AS grp,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
    faulted AS (SELECT *, CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS ini,
      CASE WHEN rtrim(text, {white}) = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY grp, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(rtrim(text, {white}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
    edit(q, ini, edit, q2, c) AS (VALUES {keep}, {rerole}, {delete}),
    ins(q, q2, c, s) AS (VALUES {", ".join(inserts)}),
    path(grp, i, q, cost, audit) AS (
      SELECT DISTINCT grp, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '' FROM placed
      UNION ALL SELECT grp, i, q, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit FROM (
        SELECT r.grp, r.i, e.q2 AS q, p.audit || n.s || e.edit AS audit,
          p.cost + n.c + e.c + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN {TRUNCATED} ELSE 0 END AS cost
        FROM path AS p JOIN faulted AS r ON r.grp = p.grp AND r.i = p.i + 1 JOIN ins AS n ON n.q = p.q
        JOIN edit AS e ON e.q = n.q2 AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
          AND (e.ini IS NULL OR e.ini = r.ini)) GROUP BY grp, i, q),
    lasts AS (SELECT grp, max(i) AS i FROM placed GROUP BY grp),
    best AS (SELECT grp, min(p.cost + n.c) AS cost, arg_min(p.audit || n.s, (p.cost + n.c, p.audit || n.s)) AS audit
      FROM path AS p JOIN lasts USING (grp, i) JOIN ins AS n ON n.q = p.q WHERE n.q2 IN (0, 3) GROUP BY grp),
    letters AS (SELECT grp, unnest(string_split(audit, '')) AS e, unnest(range(length(audit))) AS p FROM best WHERE audit <> ''),
    counted AS (SELECT *, sum(CAST(e <> 'I' AS INTEGER)) OVER (PARTITION BY grp ORDER BY p) AS i FROM letters),
    left_over AS (SELECT c.grp, p, e, role, text, row_number() OVER (PARTITION BY c.grp ORDER BY p) AS n,
      first_value(CASE WHEN e = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.grp ORDER BY p) AS sys
      FROM counted AS c LEFT JOIN faulted AS f ON f.grp = c.grp AND f.i = c.i AND c.e <> 'I' WHERE e <> 'D'),
    texts AS (SELECT grp, string_agg(CASE WHEN e = 'K' THEN role WHEN (n - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS text FROM left_over GROUP BY grp),
    pairs AS (SELECT grp, ini, fault, lag(ini) OVER (PARTITION BY grp ORDER BY i) AS before FROM faulted),
    sums AS (SELECT grp, CAST(count(*) FILTER (WHERE fault = 'blank') AS BIGINT) AS blank,
      CAST(count(*) FILTER (WHERE fault = 'duplicate') AS BIGINT) AS duplicate,
      CAST(count(*) FILTER (WHERE fault = 'truncated') AS BIGINT) AS truncated,
      CAST(count(*) FILTER (WHERE before IS NOT NULL AND (before, ini) NOT IN ((0, 1), (1, 2), (2, 1))) AS BIGINT) AS illegal
      FROM pairs GROUP BY grp),
    turns AS (SELECT grp, any_value(conv_id) AS conv_id, CAST(CASE WHEN count(turn) = 0 THEN 0
      ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS BIGINT) AS gaps FROM placed GROUP BY grp),
    done AS (SELECT t.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(coalesce(x.text, '')) AS sha
      FROM turns AS t JOIN sums USING (grp) JOIN best USING (grp) LEFT JOIN texts AS x USING (grp))
    SELECT a.conv_id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
      coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
      FROM (SELECT DISTINCT conv_id FROM conversations) AS a LEFT JOIN done AS d ON d.conv_id IS NOT DISTINCT FROM a.conv_id"""


ORACLE = _oracle()
