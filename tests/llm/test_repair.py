"""Repair of conversations against a uniform-cost search."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from reviewloom.llm import queries as q
from reviewloom.llm import repair as R

SF = "/root/testdata/sf0.01"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def plain_repair(rows):
    """(faults, cost, audit, repaired) of [(role, text)], with a queue over (cost, audit)."""
    seen, faults = set(), []
    for role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        faults.append(
            "blank" if not stripped
            else "duplicate" if (role, text) in seen
            else "truncated" if stripped[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return faults, cost, audit, out
        if (i, state) in done:
            continue
        done.add((i, state))
        follow = NEXT[state]
        for name in ("user", "assistant"):
            if name[0] in follow:
                heapq.heappush(heap, (cost + 3, audit + "I", i, follow[name[0]], (*out, (name, ""))))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        role, text = rows[i]
        more = cost + 3 * (faults[i] == "truncated")
        if role[:1] in follow:
            heapq.heappush(heap, (more, audit + "K", i + 1, follow[role[:1]], (*out, (role, text))))
        for name in ("user", "assistant"):
            if name[0] in follow:
                heapq.heappush(heap, (more + 3, audit + "R", i + 1, follow[name[0]], (*out, (name, text))))


def plain_row(rows):
    """What the query returns of one conversation, from its (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, cost, audit, out = plain_repair([r[1:] for r in rows])
    turns = [r[0] for r in rows if r[0] is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{role}:{said}" for role, said in out)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(x) for x in ("blank", "duplicate", "truncated")],
        illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    )


def plain_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        told = ":".join(" " if x is None else str(x) for x in (conv, turn))
        case = zlib.crc32(told.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        kept += [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return found


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def test_query(spark):
    rows = [tuple(r) for r in q._conversations(spark, SF).where("conv_id <> -7").collect()]
    expected = {conv: plain_row(turns) for conv, turns in plain_damage(rows).items()}
    found = q.op12_structure_repair(spark, SF)
    assert found.columns == ["conv_id", *COLUMNS]
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == expected


KINDS = ["ua", "uasx", "suaoxSUAO", "ux", "so", "sS", "x", "s"]


def test_search_against_a_queue():
    random.seed(1)
    for _ in range(1500):
        codes = "".join(random.choice(random.choice(KINDS)) for _ in range(random.randint(0, 12)))
        rows = [
            ({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool"),
             "" if c == "x" else f"{i}" + "." * c.islower())
            for i, c in enumerate(codes)
        ]
        _, cost, audit, out = plain_repair(rows)
        assert R.cheapest(codes) == (cost, audit), codes
        size = random.randint(1, 5)
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        if parts:
            made = [
                R.options(p, i == 0 and random.random() < 0.5, i + 1 == len(parts) and random.random() < 0.5)
                for i, p in enumerate(parts)
            ]
            chosen, tail = R.join_segments(made)
            taken = [next(o for o in os if (o.entry, o.exit) == c) for os, c in zip(made, chosen)]
            assert sum(o.cost for o in taken) + R.INSERT * len(tail) == cost
            assert "".join(o.audit for o in taken) + tail == audit, codes
            roles = [
                role
                for p, o, end in zip(parts, taken, [""] * (len(parts) - 1) + [tail])
                for i, (before, letter, role) in enumerate(R.edits(p, o.entry, o.audit + end))
                for role in [*before, *([role or "kept"] if letter in ("K", "R") and letter else [])]
            ]
            assert len(roles) == len(out)
            assert all(r in ("kept", name) for r, (name, _) in zip(roles, out))


@pytest.mark.parametrize("segment", [1, 3, 1024])
def test_long_conversations_over_many_tasks(spark, segment):
    random.seed(segment)
    roles = ["user", "assistant", "system", "tool", "", " "]
    rows = []
    for i in range(900):
        conv = random.choice([1, 1, 1, 1, 1, 2, 3, None, random.randint(10, 60)])
        text = random.choice(["Yes.", "No", " \t", "", "same.", f"said {i}!", f"cut {i}"])
        rows.append((conv, random.choice([None, i // 2, i]), random.choice(roles), text))
    rows += [(4, 0, "user", "Hot.")] * 300  # copies of one row
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = R.repair(turns.repartition(5), segment=segment)
    expected = {}
    for conv, *row in rows:
        expected.setdefault(conv, []).append(tuple(row))
    digests = {r.conv_id: r.repaired_sha256 for r in q.digest_turns(found.turns).collect()}
    told = found.conversations.collect()
    assert len(told) == len(expected)
    nothing = hashlib.sha256(b"").hexdigest()
    for r in told:
        digest = digests.get(r.conv_id, nothing)
        row = tuple(r[c] for c in COLUMNS[:-1])
        assert (*row, digest) == plain_row(expected[r.conv_id]), r.conv_id


def test_awkward_rows_and_other_types(spark, tmp_path):
    rows = [
        ("a", 0, "user", "Hi.", 1), ("a", 1, None, None, 2), (None, None, None, "x", 3),
        (None, 3, "assistant", "Long. " * 30_000, 4), ("b", None, "", "Empty role.", 5),
        ("c", 0, "user", "one", 6), ("c", 0, "user", "one", 7),
    ]
    schema = "conv_id string, turn int, role string, text string, n int"
    frame = spark.createDataFrame(rows, schema).withColumnRenamed("n", "edit")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    expected = {c: plain_row(t) for c, t in plain_damage([r[:4] for r in rows]).items()}
    found = q.op12_structure_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected
    empty = R.repair(frame.limit(0))
    assert empty.conversations.count() == 0 and empty.turns.count() == 0


def test_no_conversation_is_one_task(spark):
    """What the search gets is spread by ranges of turns, whatever conversation they are of."""
    rows = [(1, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(4000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = R._segments(R._coded(R.ordered(turns.repartition(4))), 1024).select("n").rdd
        assert sum(bool(x) for x in made.glom().collect()) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
