"""Repair of the turns of conversations by cheapest edits, depth-first branch and bound.

A repaired conversation's roles, by their first letters, read ``(s?(ua)+)?``. Each turn is
kept (0), given the role user or assistant (``R``, 3) or deleted (4); an empty turn of
either role may be inserted anywhere (3). A blank turn and one whose role and text came
before must be deleted; a truncated one that stays adds 3. Of the cheapest edits those win
whose letters ``D I K R``, in order, are first in ASCII order.

The search keeps an explicit stack of prefixes, the most promising on top. A suffix lower
bound, the least cost from a state of the grammar whatever the letters, cuts prefixes
that cannot beat the incumbent (cost, letters); a table per node (turns done, state)
eliminates those dominated by a cheaper or smaller prefix there. When the stack is empty
the incumbent is proved optimal. Looser bounds were tried first: on runs of system turns
the search then took exponential time.

A conversation of any length is solved in segments of at most ``SEGMENT`` turns, by all
tasks: turns are spread by ranges of their order, not by conversation. An open segment
is solved from every state of the grammar to every other; what follows an insertion
belongs to the same segment, so letters of one segment are never a prefix of others of
it and whole conversations compare segment by segment. Joining segments needs their
costs and ranks alone: 16 numbers per segment.

Defined results: turns go by (turn, role, text), NULL turns first; a NULL conv_id is a
conversation of its own; a NULL role or text is one space; a role without a first letter
``s``, ``u`` or ``a`` (as one that is empty) cannot be kept; copies of a row are
duplicates of the first; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import columns, written

SEGMENT = 1024  # turns solved together
SPACES = " \t\n\x0b\x0c\r"

# What edits cost, and a kept turn that is truncated.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# States of the grammar: nothing yet, behind a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT, END = range(5)
NEEDED = "uuau"  # whom a state waits for, and where that leads
LEADS = (USER, USER, ASSISTANT, USER)
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLES = {"u": "user", "a": "assistant"}
IMPOSSIBLE = 1 << 60


def lower_bounds(codes: str, goal: int) -> list[list[int]]:
    """For every suffix of turns and every state before it: the least cost to the goal."""
    if goal == END:
        bound = [0, 2 * INSERT, INSERT, 0]
    else:
        bound = [0 if state == goal else IMPOSSIBLE for state in range(END)]
    found = [bound]
    for code in reversed(codes):
        kind, spoilt = code.lower(), TRUNCATED if code.isupper() else 0
        costs = []
        for state, keeps in enumerate(KEEPS):
            best = DELETE + bound[state]
            if kind != "x":
                best = min(best, REROLE + spoilt + bound[LEADS[state]])
                if kind in keeps:
                    best = min(best, spoilt + bound[keeps[kind]])
            costs.append(best)
        # Up to two turns inserted before this one; a third is a pair too many.
        for _ in range(2):
            costs = [min(c, INSERT + costs[LEADS[state]]) for state, c in enumerate(costs)]
        bound = costs
        found.append(bound)
    return found[::-1]


@lru_cache(maxsize=20_000)
def cheapest(codes: str, entry: int = START, goal: int = END) -> tuple[int, str] | None:
    """Least cost and letters of the edits that lead from ``entry`` to ``goal``.

    ``codes``: a letter per turn, its role's (``o`` for any other), a capital if it is
    truncated, ``x`` if it must go. At the goal ``END`` the conversation is over and
    turns may be inserted behind its last; other goals are states behind the last turn.
    """
    n = len(codes)
    bounds = lower_bounds(codes, goal)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if table[i, state] != (cost, audit):
            continue  # a better prefix has come here since
        least = cost + bounds[i][state]
        if least >= IMPOSSIBLE:
            continue
        if best and (least > best[0] or least == best[0] and audit > best[1][: len(audit)]):
            continue
        if i == n and (state in (START, ASSISTANT) if goal == END else state == goal):
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        moves = []
        if i < n or goal == END:
            moves.append((i, LEADS[state], cost + INSERT, audit + "I"))
        if i < n:
            kind, spoilt = codes[i].lower(), TRUNCATED if codes[i].isupper() else 0
            moves.append((i + 1, state, cost + DELETE, audit + "D"))
            if kind in KEEPS[state]:
                moves.append((i + 1, KEEPS[state][kind], cost + spoilt, audit + "K"))
            if kind not in ("x", NEEDED[state]):
                moves.append((i + 1, LEADS[state], cost + REROLE + spoilt, audit + "R"))
        # The most promising move is on top of the stack, of equal ones the first letter.
        moves.sort(key=lambda m: (m[2] + bounds[m[0]][m[1]], m[3]), reverse=True)
        for move in moves:
            node, label = move[:2], move[2:]
            if node not in table or label < table[node]:
                table[node] = label
                stack.append(move)
    return best


class Option(NamedTuple):
    entry: int
    exit: int
    cost: int
    audit: str
    rank: int


def options(codes: str, begins: bool, ends: bool) -> list[Option]:
    """Best edits of a segment from every entry to every exit it may have."""
    found = []
    for entry in [START] if begins else [START, SYSTEM, USER, ASSISTANT]:
        for goal in [END] if ends else [START, SYSTEM, USER, ASSISTANT]:
            if best := cheapest(codes, entry, goal):
                found.append((entry, goal, *best))
    ranks = {audit: rank for rank, audit in enumerate(sorted({o[3] for o in found}))}
    return [Option(*o, ranks[o[3]]) for o in found]


def edits(codes: str, state: int, audit: str) -> Iterator[tuple[list[str], str, str | None]]:
    """Per turn: roles inserted before it, its letter, and its new role if it has one.

    One more, with an empty letter, for turns inserted behind the last.
    """
    before: list[str] = []
    at = 0
    for letter in audit:
        if letter == "I":
            before.append(ROLES[NEEDED[state]])
            state = LEADS[state]
            continue
        yield before, letter, ROLES[NEEDED[state]] if letter == "R" else None
        if letter == "R":
            state = LEADS[state]
        elif letter == "K":
            state = KEEPS[state][codes[at].lower()]
        before = []
        at += 1
    yield before, "", None


def join_segments(segments: list[list[Option]]) -> tuple[list[tuple[int, int]], str]:
    """Entry and exit of each segment of a conversation, and the letters behind the last.

    The bounds of suffixes are exact here, so the first descent is the best one.
    """
    tail = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0, END: 0}
    bounds = [tail]
    for segment in reversed(segments):
        bound: dict[int, int] = {}
        for o in segment:
            if o.exit in bounds[-1]:
                cost = o.cost + bounds[-1][o.exit]
                bound[o.entry] = min(cost, bound.get(o.entry, cost))
        bounds.append(bound)
    bounds.reverse()
    state, chosen = START, []
    for segment, here, behind in zip(segments, bounds, bounds[1:]):
        best = min(
            (o for o in segment
             if o.entry == state and o.exit in behind and o.cost + behind[o.exit] == here[state]),
            key=lambda o: o.rank,
        )
        chosen.append((state, best.exit))
        state = best.exit
    return chosen, "I" * (tail[state] // INSERT)


class Repaired(NamedTuple):
    """``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit``. ``turns``: ``conv_id, n, place, edit, role, text``, a row per turn that stays
    or was inserted (``I``), in the order of (n, place)."""

    conversations: DataFrame
    turns: DataFrame


def ordered(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """All turns, written, numbered (``n``) in their order.

    Ranges are cut by the turns' order, and by the number of their row among copies, so
    neither a long conversation nor a row that repeats fills a task.
    """
    turns = columns(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    order = ["conv_id", "turn", "role", "text", "copy"]
    return written(
        turns.withColumns({c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")})
        .withColumn("copy", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("copy")
        .withColumn("n", F.monotonically_increasing_id()),
        "turns",
    )


def _coded(turns: DataFrame) -> DataFrame:
    """``n, conv_id, turn, initial, fault``: what the search needs of a turn. No texts."""
    stripped = F.rtrim("text", F.lit(SPACES))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    told = turns.select(
        "n",
        "conv_id",
        "turn",
        "role",
        F.left("role", F.lit(1)).alias("initial"),
        (stripped == "").alias("blank"),
        F.right(stripped, F.lit(1)).isin(*".!?").alias("whole"),
        digest.alias("digest"),
    )
    # Copies meet by digest, combined before they are moved; first rows come back by number.
    firsts = told.groupBy("conv_id", "role", "digest").agg(F.min("n").alias("n"))
    firsts = firsts.select("n", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("whole"), "truncated")
    )
    return told.join(firsts, "n", "left").select(
        "n", "conv_id", "turn", "initial", fault.alias("fault")
    )


_SEGMENT = """n bigint, codes string, begins boolean, ends boolean, first string, last string,
  illegal bigint, options array<struct<entry:int,exit:int,cost:bigint,audit:string,rank:int>>"""
_LEGAL = {"su", "ua", "au"}


def _code(initial: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    code = initial if initial in ("s", "u", "a") else "o"
    return code.upper() if fault else code


def _keyed(turns: DataFrame, ddl: str) -> T.StructType:
    return T.StructType([turns.schema["conv_id"], *T.StructType.fromDDL(ddl).fields])


def _segments(coded: DataFrame, size: int) -> DataFrame:
    """Runs of consecutive turns of a conversation, with their best edits.

    ``begins`` and ``ends``: the run is known to be its conversation's first, or last.
    """
    schema = _keyed(coded, _SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current: tuple | None = None  # key, first n, initials, codes, begins
        previous, seen = object(), False

        def closed(ends: bool) -> tuple:
            key, n, initials, codes, begins = current
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
            code = "".join(codes)
            found = [o._asdict() for o in options(code, begins, ends)]
            return key, n, code, begins, ends, initials[0], initials[-1], illegal, found

        def result() -> pa.RecordBatch:
            arrays = [
                pa.array(values, kind)
                for values, kind in zip(zip(*rows), to_arrow_types(schema))
            ]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            for n, key, initial, fault in zip(*[c.to_pylist() for c in batch.columns]):
                same = seen and key == previous
                if current is not None and (
                    not same or n != current[1] + len(current[3]) or len(current[3]) >= size
                ):
                    rows.append(closed(not same))
                    current = None
                if current is None:
                    current = (key, n, [], [], seen and not same)
                current[2].append(initial)
                current[3].append(_code(initial, fault))
                previous, seen = key, True
                if len(rows) >= 256:
                    yield result()
                    rows = []
        if current is not None:
            rows.append(closed(False))
            yield result()

    narrow = coded.select("n", "conv_id", "initial", "fault")
    return narrow.repartitionByRange("n").sortWithinPartitions("n").mapInArrow(run, schema)


def to_arrow_types(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(field.dataType) for field in schema.fields]


def _joined(segments: DataFrame) -> DataFrame:
    """``n, entry, exit, tail, crossing`` of the segments that are no whole conversation;
    ``crossing``: illegal with the turn before it, in another segment."""
    schema = "n bigint, entry int, exit int, tail string, crossing bigint"
    numbers = F.transform(
        "options",
        lambda o: F.struct(*[o[name].alias(name) for name in ("entry", "exit", "cost", "rank")]),
    )
    narrow = segments.where(~(F.col("begins") & F.col("ends"))).select(
        "conv_id", "n", "first", "last", numbers.alias("options")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def result() -> pa.RecordBatch:
            found = [[Option(audit="", **o) for o in h[3]] for h in held]
            chosen, tail = join_segments(found)
            before = [None, *[h[2] for h in held]]
            rows = [
                (h[0], *c, "", int(b is not None and b + h[1] not in _LEGAL))
                for h, c, b in zip(held, chosen, before)
            ]
            rows[-1] = (*rows[-1][:3], tail, rows[-1][4])
            names = ["n", "entry", "exit", "tail", "crossing"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names
            )

        previous = object()
        for batch in batches:
            for key, *segment in zip(*[c.to_pylist() for c in batch.columns]):
                if held and key != previous:
                    yield result()
                    held = []
                previous = key
                held.append(tuple(segment))
        if held:
            yield result()

    return (
        narrow.repartition("conv_id").sortWithinPartitions("conv_id", "n").mapInArrow(run, schema)
    )


def _solved(segments: DataFrame) -> DataFrame:
    """``conv_id, n, codes, entry, audit, cost, illegal`` of every segment."""
    whole = segments.where(F.col("begins") & F.col("ends")).select(
        "conv_id", "n", "codes", "illegal", F.lit("").alias("tail"), F.col("options")[0].alias("o")
    )
    picked = F.filter(
        "options", lambda o: (o["entry"] == F.col("c.entry")) & (o["exit"] == F.col("c.exit"))
    )[0]
    parts = segments.join(_joined(segments).select("n", F.struct("*").alias("c")), "n").select(
        "conv_id",
        "n",
        "codes",
        (F.col("illegal") + F.col("c.crossing")).alias("illegal"),
        F.col("c.tail").alias("tail"),
        picked.alias("o"),
    )
    return whole.unionByName(parts).select(
        "conv_id",
        "n",
        "codes",
        F.col("o.entry").alias("entry"),
        F.concat("o.audit", "tail").alias("audit"),
        (F.col("o.cost") + INSERT * F.length("tail")).alias("cost"),
        "illegal",
    )


def _changes(solved: DataFrame) -> DataFrame:
    """``n, before, edit, new_role, after`` of every turn that is not simply kept."""
    schema = "n bigint, before array<string>, edit string, new_role string, after array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, codes, entry, audit in zip(*[c.to_pylist() for c in batch.columns]):
                *turns, (after, _, _) = edits(codes, entry, audit)
                for i, (before, letter, role) in enumerate(turns):
                    last = after if i + 1 == len(turns) else []
                    if before or last or letter != "K":
                        rows.append((n + i, before, letter, role, last))
            texts = pa.list_(pa.string())
            kinds = [pa.int64(), texts, pa.string(), pa.string(), texts]
            values = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)],
                ["n", "before", "edit", "new_role", "after"],
            )

    changed = solved.where(F.col("audit").rlike("[^K]"))
    return changed.select("n", "codes", "entry", "audit").mapInArrow(run, schema)


def _inserted(roles: str) -> Column:
    none = F.array().cast("array<string>")
    return F.transform(
        F.coalesce(F.col(roles), none),
        lambda role: F.struct(F.lit("I").alias("edit"), role.alias("role"), F.lit("").alias("text")),
    )


def repair(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment: int = SEGMENT,
) -> Repaired:
    """Faults of every conversation and its turns after the cheapest repair.

    ``turn`` is a whole number. ``gaps`` are numbers that no turn has between the least
    and the greatest; ``illegal`` counts neighbours other than su, ua and au as they
    came in.
    """
    turns = ordered(conversations, id_col, turn_col, role_col, text_col)
    coded = written(_coded(turns), "turn_codes")
    solved = written(_solved(written(_segments(coded, segment), "segments")), "solved")
    faults = ("blank", "duplicate", "truncated")
    per_turn = coded.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("fault") == name).alias(name) for name in faults]
    )
    number = F.col("turn").cast("bigint")
    counts = per_turn.groupBy("conv_id").agg(
        F.coalesce(F.max(number) - F.min(number) + 1 - F.count(number), F.lit(0)).alias("gaps"),
        *[F.sum(name).alias(name) for name in faults],
    )
    by_place = F.sort_array(F.collect_list(F.struct("n", "audit")))
    costs = solved.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(by_place, lambda s: s["audit"]), "").alias("audit"),
    )
    same = counts["conv_id"].eqNullSafe(costs["conv_id"])
    found = counts.join(costs, same).select(
        counts["conv_id"], "gaps", *faults, "illegal", "cost", "audit"
    )
    own = F.struct(
        F.coalesce("edit", F.lit("K")).alias("edit"),
        F.coalesce("new_role", "role").alias("role"),
        F.col("text"),
    )
    kept = F.when(F.col("edit").eqNullSafe("D"), F.filter(F.array(own), lambda _: F.lit(False)))
    places = F.concat(_inserted("before"), kept.otherwise(F.array(own)), _inserted("after"))
    repaired = (
        turns.join(_changes(solved), "n", "left")
        .select("conv_id", "n", F.posexplode(places).alias("place", "turn"))
        .select("conv_id", "n", "place", "turn.*")
    )
    return Repaired(found, repaired)
