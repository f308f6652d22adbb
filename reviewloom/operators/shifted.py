"""Rows of the right number of fields whose values have moved by one column.

A stray delimiter in one field and a lost one elsewhere leave a row that parses: nothing
but its values tells that they are in the wrong columns. ``learn`` counts, per column of
sound rows, what values look like: the pattern of their first characters, their length,
and how they begin. ``with_shift`` compares for every row the evidence that its values
belong where they are with that for each shift: to the right from a column on (there a
value is inserted, the last is lost), or to the left (one is lost, the last is anything).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FEATURES = 1000  # kept per column and kind, the most frequent ones
SMOOTHING = 0.5  # rows that every feature, and all others together, are taken to have
# Log odds. On the derived reviews sound rows reach 1.8 and moved ones begin at 4.0.
THRESHOLD = 3.0
MOST = 4.0  # log odds that one kind of feature in one column can add

KINDS = ("pattern", "length", "begin")


def _features(value: Column) -> list[Column]:
    text = F.left(value, F.lit(64))
    pattern = F.regexp_replace(text, r"\p{L}+", "a")
    pattern = F.regexp_replace(pattern, r"[0-9]+", "9")
    pattern = F.regexp_replace(pattern, r"\s+", " ")
    size = F.floor(F.log2(F.length(value) + 1)).cast("string")
    features = [F.left(pattern, F.lit(5)), size, F.lower(F.left(value, F.lit(12)))]
    return [F.coalesce(f, F.lit("\0")) for f in features]  # NULL is a feature too


def _arrays(columns: Sequence[str]) -> list[Column]:
    made = [_features(F.col(f"`{c}`").cast("string")) for c in columns]
    return [F.array(*features) for features in zip(*made)]


class Evidence:
    """Log probabilities of features by column; what ``learn`` returns.

    Holds ``FEATURES`` rows per column and kind at most, whatever it was learnt from.
    """

    def __init__(self, columns: Sequence[str], counts: pd.DataFrame):
        self.columns = list(columns)
        self.kinds: list[tuple[dict[str, int], np.ndarray]] = []
        for kind in range(len(KINDS)):
            own = counts[counts.kind == kind]
            names = {f: i for i, f in enumerate(sorted(set(own.feature.dropna())))}
            # A row per feature, the last for all others; a column per column.
            table = np.zeros((len(names) + 1, len(self.columns)))
            at = own.feature.map(names).fillna(len(names)).astype(int)
            np.add.at(table, (at, own.place.astype(int)), own.rows)
            table += SMOOTHING
            table /= table.sum(axis=0)
            # Behind them what a value of any column looks like.
            table = np.column_stack([table, table.mean(axis=1)])
            self.kinds.append((names, np.log(table)))

    def shifts(self, *features: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of the likeliest shift of each row, and ``1 + column`` it starts at, with
        a minus sign for one to the left."""
        n = len(self.columns)
        right, left = (np.zeros((len(features[0]), n)) for _ in range(2))
        strange = np.zeros((len(features[0]), n))
        for (names, table), column in zip(self.kinds, features):
            values = pd.Series(np.concatenate([np.asarray(v) for v in column]))
            at = values.map(names).fillna(len(names)).astype(int).to_numpy().reshape(-1, n)
            own = table[at, np.arange(n)]
            bound = lambda odds: np.clip(odds, -MOST, MOST)
            right[:, 1:] += bound(table[at[:, 1:], np.arange(n - 1)] - own[:, 1:])
            left[:, :-1] += bound(table[at[:, :-1], np.arange(1, n)] - own[:, :-1])
            strange += bound(table[at, n] - own)
        # To the right from a column: that one is strange, all behind are the one before's.
        behind = np.cumsum(right[:, ::-1], axis=1)[:, ::-1]
        to_right = strange + np.column_stack([behind[:, 1:], np.zeros(len(right))])
        # To the left: all from there on are the next one's, and the last is strange.
        to_left = np.cumsum(left[:, ::-1], axis=1)[:, ::-1] + strange[:, -1:]
        to_left[:, -1] = strange[:, -1]
        odds = np.concatenate([to_right, to_left], axis=1)
        best = odds.argmax(axis=1)
        return odds.max(axis=1), np.where(best < n, best + 1, n - 1 - best)


def learn(sound: DataFrame, columns: Sequence[str], features: int = FEATURES) -> Evidence:
    """Count what the values of each column look like, in one pass.

    Features are short, so tasks combine them before the shuffle; the most frequent ones
    of each column go to the driver, the others as one number.
    """
    entries = [
        F.struct(F.lit(kind).alias("kind"), F.lit(place).alias("place"), feature.alias("feature"))
        for place, column in enumerate(columns)
        for kind, feature in enumerate(_features(F.col(f"`{column}`").cast("string")))
    ]
    counted = (
        sound.select(F.explode(F.array(*entries)).alias("f"))
        .groupBy("f.kind", "f.place", "f.feature")
        .agg(F.count("*").alias("rows"))
    )
    order = Window.partitionBy("kind", "place").orderBy(F.desc("rows"), "feature")
    ranked = counted.withColumn("rank", F.row_number().over(order))
    kept = F.when(F.col("rank") <= features, F.col("feature"))
    table = ranked.groupBy("kind", "place", kept.alias("feature")).agg(F.sum("rows").alias("rows"))
    return Evidence(columns, table.toPandas())


def with_shift(
    df: DataFrame,
    evidence: Evidence,
    threshold: float = THRESHOLD,
    odds: str = "shift_odds",
    start: str = "shift_start",
) -> DataFrame:
    """Add ``shift_odds``, the log odds of the likeliest shift, and ``shift_start``: the number
    of the first moved column, from 1, negative if values moved to the left, and NULL if
    the odds are below ``threshold``. Narrow; scored by Arrow batches.
    """
    if clash := {c.lower() for c in (odds, start)} & {c.lower() for c in df.columns}:
        raise ValueError(f"the frame has columns {sorted(clash)}: give other names")
    known = df.sparkSession.sparkContext.broadcast(evidence)

    @F.pandas_udf("odds double, start int")
    def score(pattern: pd.Series, length: pd.Series, begin: pd.Series) -> pd.DataFrame:
        if not len(pattern):
            return pd.DataFrame({"odds": np.zeros(0), "start": np.zeros(0, np.int32)})
        found, at = known.value.shifts(pattern, length, begin)
        return pd.DataFrame({"odds": found, "start": at.astype(np.int32)})

    own = "shift"
    while own.lower() in {c.lower() for c in df.columns}:
        own = f"_{own}"
    rows = df.withColumn(own, score(*_arrays(evidence.columns)))
    return rows.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col(f"{own}.odds").alias(odds),
        F.when(F.col(f"{own}.odds") >= threshold, F.col(f"{own}.start")).alias(start),
    )


def flag_shifted(flagged: DataFrame, evidence: Evidence, threshold: float = THRESHOLD) -> DataFrame:
    """Give rows of ``csv.scan_flagged`` that have no ``reason`` yet, and whose values have
    moved, the reason ``shifted``: ``keysplit.split_by_reason`` then sets them aside."""
    found = with_shift(flagged, evidence, threshold, "_shift_odds", "_shift_start")
    moved = F.when(F.col("_shift_start").isNotNull(), F.lit("shifted"))
    return found.withColumn("reason", F.coalesce("reason", moved)).drop("_shift_odds", "_shift_start")
