"""Exact histogram of encoded lengths, and what its suffix sums answer.

Each task counts its documents by length, so what is shuffled is one row per
length and task. Suffix sums run in two steps, within ranges of lengths and over
the ranges, so no task sees more than a range or the list of ranges.

Defined results: a NULL or empty text has length 0; ids are not used; repeated
rows count each time; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import as_bytes, columns, map_batches, written
from reviewloom.llm.tokens import encoder, text_groups

RANGE = 64  # lengths per range


def encoded_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``length, docs``: documents of each length, counted batch by batch."""

    def make():
        tokens = encoder(tokenizer)

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            groups = [tokens.encode(part.column(0))[1] for part in text_groups(batch, 0)]
            sizes = np.concatenate([np.diff(at) for at in groups])
            length, docs = np.unique(sizes.astype(np.int64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(length), pa.array(docs)], ["length", "docs"])

        return count

    texts = as_bytes(columns(docs, text=text_col), "text")
    return map_batches(texts, "length bigint, docs bigint", make, rows=None)


def length_table(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs.

    ``docs``, ``tokens``: of that length. ``docs_at_least``, ``tokens_at_least``:
    of that length or more. ``docs_at_most``: of that length or less.
    ``tokens_cut``: all tokens left if every document is cut to that length.
    """
    counted = lengths.groupBy("length").agg(F.sum("docs").alias("docs"))
    # Written, as it is read twice and texts should be encoded once.
    table = (
        written(counted, "lengths")
        .withColumn("tokens", F.col("length") * F.col("docs"))
        .withColumn("part", F.floor(F.col("length") / RANGE))
    )
    # One row per range of 64 lengths that occurs.
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    parts = (
        table.groupBy("part")
        .agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
        .select(
            "part",
            F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("tokens_above"),
            F.sum("_docs").over(everything).alias("all_docs"),
            F.sum("_tokens").over(everything).alias("all_tokens"),
        )
    )
    upward = Window.partitionBy("part").orderBy(F.desc("length"))
    return (
        table.join(parts, "part")
        .withColumn("docs_at_least", F.col("docs_above") + F.sum("docs").over(upward))
        .withColumn("tokens_at_least", F.col("tokens_above") + F.sum("tokens").over(upward))
        .select(
            "length",
            "docs",
            "tokens",
            "docs_at_least",
            "tokens_at_least",
            (F.col("all_docs") - F.col("docs_at_least") + F.col("docs")).alias("docs_at_most"),
            (
                F.col("all_tokens")
                - F.col("tokens_at_least")
                + F.col("length") * F.col("docs_at_least")
            ).alias("tokens_cut"),
        )
    )


def cut_total(table: DataFrame, limit: int) -> DataFrame:
    """``tokens_cut`` at any limit, whether a document has that length or not."""
    left = F.sum(F.least(F.col("length"), F.lit(limit)) * F.col("docs"))
    return table.agg(F.coalesce(left, F.lit(0)).alias("tokens_cut"))


def quantile(table: DataFrame, share: Decimal | float | str) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed.

    ``share`` counts as the decimal number it is written as: 0.07 is 7 of 100.
    """
    everyone = F.col("docs_at_most") + F.col("docs_at_least") - F.col("docs")
    wanted = everyone.cast("decimal(20,0)") * F.lit(Decimal(str(share)))
    return table.where(F.col("docs_at_most") >= wanted).agg(F.min("length").alias("length"))
