"""Reports: rows per label, class balance, sizes of the two splits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.operators.keysplit import is_listed


def sentiment_counts(df: DataFrame, label: str = "sentiment") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("reviews"))


def sentiment_balance(counts: DataFrame) -> DataFrame:
    """Add each label's share of all rows to a result of ``sentiment_counts``.

    The un-partitioned window is over that table: one row per label, at most five,
    whatever the size of the data. Do not give it a table that is not counted.
    """
    total = F.sum("reviews").over(Window.partitionBy())
    return counts.withColumn("share", F.col("reviews") / total)


def split_counts(df: DataFrame, key: str, ids: Iterable[str]) -> DataFrame:
    """Sizes of both splits, and of the rows in neither (NULL key), in one pass."""
    listed = is_listed(key, ids)
    return df.agg(
        F.count_if(listed).alias("quarantined"),
        F.count_if(~listed).alias("kept"),
        F.count_if(listed.isNull()).alias("no_key"),
    )
