"""Conversation repair next to its SQL and to a plain search over all edits."""

import hashlib
import heapq
import random

import duckdb
import pytest
from oracle_check import difference

from lakestrata.llm import conversation_repair
from lakestrata.llm.conversation_repair import block_tables, outcome, repair, trailing

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, least audit, repaired lines) of [(role, text, fault)], by uniform-cost search over all edits."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        after, name = NEXT[state], {"u": "user", "a": "assistant"}[NEXT[state]]
        heapq.heappush(heap, (cost + 5, audit + "I", i, after, (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                cut = 5 * (fault == "truncated")
                heapq.heappush(heap, (cost + 1 + cut, audit + "R", i + 1, after, (*lines, f"{name}:{text}")))
                if role[:1] == after or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))


def with_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        fault = "" if text.rstrip(" \t\n\x0b\x0c\r")[-1:] in (".", "!", "?") else "truncated"
        fault = "blank" if not text.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else fault
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def some_rows(r, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "unit", "User"]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Fine. ", "a\x1c", "é.", "x " * 50 + "."]
    return [(r.choice(roles), r.choice(texts) + (f" {i}." if r.random() < 0.6 else "")) for i in range(n)]


def test_tables_equal_a_plain_search():
    r, tables = random.Random(1), block_tables()
    assert len(tables.vectors) < 100
    for n in [*range(14)] * 40:
        rows = with_faults(some_rows(r, n))
        codes = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
        symbols = bytes("sua".find(role[0]) % 4 * 4 + codes[f] if role else 12 + codes[f] for role, _, f in rows)
        blocks, state, audit = tables.blocks(symbols), 0, ""
        behind, vector, cost = tables.back(blocks, 0)
        for block, after in zip(blocks, behind):
            piece, state = tables.expand(state, block, after)
            audit += piece
        audit += trailing(state)
        flags = iter(s % 4 >= 2 for s in symbols)
        marked = "".join("d" if e != "I" and next(flags) else e for e in audit)
        lines = outcome(marked, 0, ((a, b) for a, b, f in rows if f not in ("blank", "duplicate")))[0]
        assert (cost + tables.vectors[vector][0], audit, "\n".join(lines)) == cheapest(rows)


def conversations(r):
    out = []
    for c in range(150):
        rows = some_rows(r, r.randrange(1, 12))
        turns = sorted(r.sample(range(30), len(rows)))
        out += [(c - 3, t, role, text) for t, (role, text) in zip(turns, rows)]
    out += [(None, t, "user", "No id.") for t in (1, 2, None)] + [(500, None, None, None), (500, 3, "user", None)]
    out += [(501, 4, "user", "Same."), (501, 4, "user", "Same."), (501, 4, "assistant", "Same."), (501, 9, None, "Hm.")]
    return out + [(502, t, "user" if t % 2 else "assistant", f"Long {t}." if t % 7 else "Again.") for t in range(400)]


def query(spark, rows, monkeypatch):
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], "conv_id long, turn long, role string, text string, part int, `a.b` string")
    monkeypatch.setattr(conversation_repair, "documents", lambda *_: df.repartition(3))
    return conversation_repair.op11_conversation_repair(spark, "").toPandas().astype({"conv_id": "Int64"})


@pytest.mark.parametrize("chunk", [conversation_repair.CHUNK_ROWS, 3])
def test_query_equals_the_sql(spark, monkeypatch, chunk):
    """With chunks of three rows most conversations go through the passes in pieces."""
    monkeypatch.setattr(conversation_repair, "CHUNK_ROWS", chunk)
    rows = conversations(random.Random(2))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    ours = query(spark, rows, monkeypatch)
    assert difference(ours, con.sql(conversation_repair.ORACLE).df()) is None
    # An insertion costs more than the deletion that would do as well, so the cheapest edits have none.
    assert set("".join(ours.audit)) == set("DKR") and ours.truncated.sum() and ours.duplicate.sum() and ours.illegal.sum()


def test_one_conversation_over_many_tasks(spark):
    r = random.Random(4)
    rows = [(role, f"{text}{i % 9000}") for i, (role, text) in enumerate(some_rows(r, 20_000))] + [("user", "end.")] * 9000
    df = spark.createDataFrame([(1, i, *row) for i, row in enumerate(rows)], "conv_id long, turn long, role string, text string")
    marked = df.unionByName(df.filter("turn > 28000").withColumn("turn", df.turn))  # equal rows twice
    wanted = sorted([(i, *row) for i, row in enumerate(rows)] + [(i, *row) for i, row in enumerate(rows) if i > 28000])
    cost, audit, text = cheapest(with_faults([row[1:] for row in wanted]))
    (found,) = repair(marked).collect()
    assert (found.cost, found.audit) == (cost, audit)
    assert found.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, CAST(X'FF612E' AS STRING) AS text UNION ALL SELECT 1, 1, 'assistant', 'b.'")
    (found,) = repair(df).collect()
    assert (found.cost, found.audit) == (0, "KK")
    assert found.repaired_sha256 == hashlib.sha256("user:\ufffda.\nassistant:b.".encode()).hexdigest()


def test_empty_table_and_a_conversation_without_rows(spark, monkeypatch):
    gone = next(i for i in range(100) if __import__("zlib").crc32(f"{i}:0".encode()) % 20 == 0)
    found = query(spark, [(gone, 0, "user", "Hi.")], monkeypatch)
    assert found.values.tolist() == [[gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()]]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(conversation_repair, "documents", lambda *_: none)
    assert conversation_repair.op11_conversation_repair(spark, "").count() == 0
