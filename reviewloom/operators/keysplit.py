"""Split rows by a list, or a table, of keys.

Lists become an ``IN`` set that reaches the scan. Key tables become semi / anti
joins without a broadcast hint: Catalyst broadcasts a side only when its size
is known to be under ``spark.sql.autoBroadcastJoinThreshold``. Above that both
sides shuffle on the key; a key held by a large share of the rows is split by
adaptive execution, or up front, row by row, with ``salts``: all keys, or those that
``hot_keys`` finds.

A row whose own key is NULL is neither listed nor unlisted in SQL. ``drop_*``
therefore loses it by default; ``null_key="keep"`` keeps it, and such rows are
spread over all reducers instead of meeting in one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEPT = "kept"
QUARANTINE = "quarantine"
CORRUPT = "corrupt"
SIDES = (KEPT, QUARANTINE, CORRUPT)
NULL_SALTS = 1 << 16  # rows with a NULL key match nothing, so they may go anywhere


def _check(null_key: str) -> None:
    if null_key not in ("drop", "keep"):
        raise ValueError(f"null_key must be 'drop' or 'keep', not {null_key!r}")


def is_listed(key: str, ids: Iterable[str]) -> Column:
    return F.col(key).isin(sorted(set(ids)))


def keep_listed(df: DataFrame, key: str, ids: Iterable[str]) -> DataFrame:
    return df.where(is_listed(key, ids))


def drop_listed(
    df: DataFrame, key: str, ids: Iterable[str], null_key: str = "drop"
) -> DataFrame:
    _check(null_key)
    unlisted = ~is_listed(key, ids)
    if null_key == "keep":
        unlisted = unlisted | F.col(key).isNull()
    return df.where(unlisted)


def _free(name: str, *frames: DataFrame) -> str:
    """A column name that no frame has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that may hold ``share`` of the rows or more: all that do, and some that nearly do.

    One pass over the key column; each task sends a sketch of frequent items, of a size
    that follows from ``share`` alone. At most ``1 / share`` keys come back.
    """
    most = max(1, int(1 / share))
    tracked = 1 << max(4, (8 * most - 1).bit_length())
    rows = df.where(F.col(key).isNotNull())
    found = rows.agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top"), F.count("*").alias("rows")
    ).first()
    return [x["item"] for x in found["top"] or [] if x["count"] >= share * found["rows"]]


def _join(
    df: DataFrame, keys: DataFrame, key: str, how: str, salts: int, hot: Iterable | None
) -> DataFrame:
    """Rows of one key go to ``salts`` reducers, each with its own copy of the key.

    With ``hot`` only those keys are spread and copied. The salt is a row's number, so
    rows of one input partition spread too; any number a retried task might give finds
    the same keys.
    """
    name = _free("salt", df, keys)
    number = F.monotonically_increasing_id()
    spread = F.lit(True) if hot is None else F.col(key).isin(list(hot))
    salt = (
        F.when(F.col(key).isNull(), number % NULL_SALTS)
        .when(spread, number % salts)
        .otherwise(0)
    )
    last = F.when(spread, F.lit(salts - 1)).otherwise(0).cast("bigint")
    copies = keys.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return df.withColumn(name, salt).join(copies, [key, name], how).drop(name)


def keep_matching(
    df: DataFrame, keys: DataFrame, key: str, salts: int = 1, hot: Iterable | None = None
) -> DataFrame:
    """``salts`` spreads the rows of every key, or of the ``hot`` ones alone (``hot_keys``):
    the key table then grows by copies of those."""
    keys = keys.select(key)
    if salts <= 1:
        return df.join(keys, key, "left_semi")
    rows = df.where(F.col(key).isNotNull())
    return _join(rows, keys.distinct(), key, "left_semi", salts, hot).select(*_all(df))


def drop_matching(
    df: DataFrame,
    keys: DataFrame,
    key: str,
    null_key: str = "drop",
    salts: int = 1,
    hot: Iterable | None = None,
) -> DataFrame:
    """See ``keep_matching`` for ``salts`` and ``hot``."""
    _check(null_key)
    keys = keys.select(key)
    if null_key == "drop":
        df = df.where(F.col(key).isNotNull())
        if salts <= 1:
            return df.join(keys, key, "left_anti")
    joined = _join(df, keys.distinct(), key, "left_anti", max(1, salts), hot)
    return joined.select(*_all(df))


def _all(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def with_split(
    df: DataFrame,
    key: str,
    ids: Iterable[str] | DataFrame,
    null_key: str = "drop",
    salts: int = 1,
    hot: Iterable | None = None,
    name: str = "split",
) -> DataFrame:
    """Add a column ``name`` so both sides can be written in one pass.

    ``ids`` is a list, or a table with the column ``key``. A frame that has a column
    ``name`` already needs another name.
    """
    _check(null_key)
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the frame has a column {name!r}: give another name")
    if null_key == "drop":
        df = df.where(F.col(key).isNotNull())
    if isinstance(ids, DataFrame):
        mark = _free("listed", df, ids)
        marked = ids.select(key).distinct().withColumn(mark, F.lit(True))
        rows = _join(df, marked, key, "left", max(1, salts), hot)
        listed = F.coalesce(F.col(mark), F.lit(False))
    else:
        rows, listed = df, F.coalesce(is_listed(key, ids), F.lit(False))
    split = F.when(listed, QUARANTINE).otherwise(KEPT).alias(name)
    return rows.select(*_all(df), split)


def split_by_reason(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows that have a ``reason`` go to the corrupt side, others stay on their side."""
    side = F.col("split") if "split" in df.columns else F.lit(KEPT)
    return df.withColumn("split", F.when(F.col(reason).isNotNull(), CORRUPT).otherwise(side))
