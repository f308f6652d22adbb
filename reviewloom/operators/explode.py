"""Rows that hold several merged reviews -> one row per review."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT, RECOVERED, AMBIGUOUS, UNEQUAL = "exact", "recovered", "ambiguous", "unequal"

# What speaks for a delimiter between two parts being the end of a review: the next part
# starts at once or after white space, with a capital or digit, or in lower case; the part
# before ends like a sentence. And what speaks against a review that is blank.
AT_ONCE, SPACED, CAPITAL, SMALL, STOP, BLANK = 2, -2, 1, -1, 1, -6

# Fixed value: what str.isspace() says yes to.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _literal(delimiter: str) -> str:
    return r"\Q" + delimiter.replace(r"\E", r"\E\\E\Q") + r"\E"


def explode_merged(
    df: DataFrame,
    columns: Sequence[str],
    delimiter: str,
    free_text: str | None = None,
    item: str = "item",
    aligned: str = "aligned",
    alignment: str = "alignment",
) -> DataFrame:
    """Split the parallel lists in ``columns`` and emit one row per position.

    Adds ``item`` (position from 0) and ``aligned``. When the lists of a row
    differ in length, or one is NULL, nothing can be paired: the row passes
    through whole, with ``item`` NULL and ``aligned`` false. The delimiter is
    taken literally. Narrow: no shuffle, memory bounded by one row.

    ``free_text`` is the one of ``columns`` whose values may hold the delimiter
    themselves, as a comma in a review. If it has more parts than the other lists, parts
    are joined to as many reviews by ``best_cuts``. A column ``alignment`` is added:
    ``exact``, ``recovered``, ``ambiguous`` (two ways are equally good) or ``unequal``;
    rows of the last two pass through whole.

    The added columns need names that the frame does not have.
    """
    added = [item, aligned] + ([alignment] if free_text else [])
    if clash := {c.lower() for c in added} & {c.lower() for c in df.columns}:
        raise ValueError(f"the frame has columns {sorted(clash)}: give other names")
    if free_text and (free_text not in columns or len(columns) < 2):
        raise ValueError("free_text needs to be one of several columns")
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    own = "merged"
    while any(c.lower().startswith(own) for c in df.columns):
        own = f"_{own}"
    # Lists are columns of their own, so that each text is split once.
    names = {c: f"{own}_{i}" for i, c in enumerate(columns)}
    staged = df.withColumns({names[c]: F.split(F.col(f"`{c}`"), _literal(delimiter)) for c in columns})
    lists = {c: F.col(name) for c, name in names.items()}
    sizes = {c: F.array_size(lists[c]) for c in columns}
    first = sizes[columns[0]]
    equal = F.coalesce(reduce(and_, [s == first for s in sizes.values()]), F.lit(False))
    how = F.when(equal, EXACT).otherwise(UNEQUAL)
    if free_text:
        keys = [sizes[c] for c in columns if c != free_text]
        more = reduce(and_, [s == keys[0] for s in keys]) & (sizes[free_text] > keys[0])
        wanted = F.when(F.coalesce(more, F.lit(False)), keys[0])
        cuts = best_cuts(F.when(wanted.isNotNull(), lists[free_text]), wanted, F.lit(delimiter))
        staged = staged.withColumn(f"{own}_found", cuts)
        found = F.col(f"{own}_found")
        how = (
            F.when(found.isNull(), how).when(found["ways"] > 1, AMBIGUOUS).otherwise(RECOVERED)
        )
        lists[free_text] = F.coalesce(found["parts"], lists[free_text])
    staged = staged.withColumn(own, how)
    paired = F.arrays_zip(*[lists[c].alias(c) for c in columns])
    whole = F.array(F.struct(*[F.col(f"`{c}`") for c in columns]))
    good = F.col(own).isin(EXACT, RECOVERED)
    items = F.when(good, paired).otherwise(whole)
    # The arrays are never empty. "outer" only keeps Catalyst from testing that
    # beforehand, which would split every text again below the scan.
    position, value = f"{own}_at", f"{own}_item"
    return staged.select(
        *rest, own, F.posexplode_outer(items).alias(position, value)
    ).select(
        *rest,
        F.when(good, F.col(position)).alias(item),
        *[F.col(f"{value}.`{c}`").alias(c) for c in columns],
        good.alias(aligned),
        *([F.col(own).alias(alignment)] if free_text else []),
    )


def cut_parts(parts: Sequence[str], wanted: int) -> tuple[list[int], int]:
    """Where to end reviews so that ``parts`` become ``wanted`` of them, and in how many ways
    that can be done equally well (2 stands for more).

    Dynamic programming over the parts: for every number of reviews so far, and for
    whether the last is blank as yet, the best score, its ways and its cuts.
    """
    scores = []
    for before, after in zip(parts, parts[1:]):
        text = after.lstrip()
        score = SPACED if after[:1].isspace() else AT_ONCE
        score += CAPITAL if text[:1].isupper() or text[:1].isdigit() else SMALL * text[:1].islower()
        scores.append(score + STOP * (before.rstrip()[-1:] in tuple(".!?")))
    # (reviews, blank) -> score, ways, last cut as a chain of (part, chain before)
    best: dict[tuple[int, bool], tuple[int, int, tuple | None]] = {
        (1, not parts[0].strip()): (0, 1, None)
    }
    for number, (part, score) in enumerate(zip(parts[1:], scores), 1):
        after: dict[tuple[int, bool], tuple[int, int, tuple | None]] = {}
        empty = not part.strip()
        left = len(parts) - 1 - number
        for (count, blank), (total, ways, cuts) in best.items():
            for cut in (False, True):
                key = (count + 1, empty) if cut else (count, blank and empty)
                if not wanted - left <= key[0] <= wanted:
                    continue
                new = total + (score + BLANK * blank if cut else 0)
                kept = after.get(key)
                if kept is None or new > kept[0]:
                    after[key] = (new, ways, (number, cuts) if cut else cuts)
                elif new == kept[0]:
                    after[key] = (new, min(2, ways + kept[1]), kept[2])
        best = after
    ends = [
        (total + BLANK * blank, ways, cuts)
        for (count, blank), (total, ways, cuts) in best.items()
        if count == wanted
    ]
    top = max(total for total, _, _ in ends)
    ways = min(2, sum(ways for total, ways, _ in ends if total == top))
    chain = next(cuts for total, _, cuts in ends if total == top)
    found = []
    while chain:
        found.append(chain[0])
        chain = chain[1]
    return found[::-1], ways


def _ends(parts: Column) -> Column:
    """All that ``cut_parts`` looks at, as one short string: of each part whether it starts
    with white space, its first other character and its last, a line per part."""

    def short(part: Column) -> Column:
        spaced = F.btrim(F.substring(part, 1, 1), F.lit(WHITE)) != F.substring(part, 1, 1)
        text = F.btrim(part, F.lit(WHITE))
        start = F.when(spaced, " ").otherwise("")
        return F.concat(start, F.substring(text, 1, 1), F.substring(text, -1, 1))

    return F.array_join(F.transform(parts, short), "\n")


def best_cuts(parts: Column, wanted: Column, delimiter: Column) -> Column:
    """``cut_parts`` of a list: struct of ``parts``, joined to ``wanted`` ones, and ``ways``.

    NULL where ``wanted`` is. Arrow batches of the parts' ends: texts stay in the JVM, so a
    batch takes a few bytes a part however long they are. A row takes parts x wanted steps.
    """

    @F.pandas_udf("cuts array<int>, ways int")
    def cut(ends: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        rows = []
        for own, count in zip(ends, wanted):
            known = own is not None and not pd.isna(count)
            rows.append(cut_parts(own.split("\n"), int(count)) if known else (None, None))
        return pd.DataFrame(rows, columns=["cuts", "ways"]).astype({"ways": "Int32"})

    found = cut(_ends(parts), wanted)
    starts = F.concat(F.array(F.lit(0)), found["cuts"])
    stops = F.concat(found["cuts"], F.array(F.size(parts)))
    joined = F.transform(
        F.arrays_zip(starts.alias("start"), stops.alias("stop")),
        lambda cut: F.call_function(
            "array_join", F.slice(parts, cut["start"] + 1, cut["stop"] - cut["start"]), delimiter
        ),
    )
    return F.when(wanted.isNotNull(), F.struct(joined.alias("parts"), found["ways"].alias("ways")))
