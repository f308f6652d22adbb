"""Bronze -> silver -> gold.

Order of the gold plan: cheap row filters (they reach the scan), one cleaning
pass, the gate, the ratings if they are a table of their own, one hash aggregate
on the body, the label, two columns. Raw text is never shuffled; cleaned text is
once, for the aggregate, after map-side combining, and once more to meet a table
of ratings.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.gates import passes_quality
from reviewloom.functions.labels import sentiment
from reviewloom.functions.text import clean_review_once
from reviewloom.operators.counts import sentiment_counts
from reviewloom.operators.dedup import best_rating_per, digest_of, distinct_on
from reviewloom.operators.keysplit import KEPT, drop_listed, split_by_reason, with_split
from reviewloom.sources import csv, sinks
from reviewloom.sources.schema import REVIEW_COLUMNS

# Cleaned bodies hold no line breaks and no quotes: the table is read by lines.
GOLD_SCHEMA = "review_body string, sentiment string"


def cleaned(
    reviews: DataFrame,
    corrupt_ids: Iterable[str] | None = None,
    null_key: str = "drop",
    where: Column | str | None = None,
) -> DataFrame:
    """Rows with cleaned, worthwhile ``review_content``; other columns as they are.

    Filters put on the result do not pass the cleaner. Give those on other
    columns as ``where``: they are applied before and reach the scan.
    """
    rows = reviews.where(F.col("review_content").isNotNull())
    if where is not None:
        rows = rows.where(where)
    if corrupt_ids is not None:
        rows = drop_listed(rows, "product_id", corrupt_ids, null_key)
    text = clean_review_once(F.col("review_content"))
    return rows.withColumn("review_content", text).where(
        passes_quality(F.col("review_content"))
    )


def _rated(rows: DataFrame, ratings: DataFrame | None, key: str) -> DataFrame:
    """Add ``rating`` from a table of its own, if it is one.

    The hash side is built from the narrow table whatever its size, so cleaned
    text is moved but not sorted.
    """
    if ratings is None:
        return rows
    return rows.join(ratings.select(key, "rating").hint("shuffle_hash"), key, "left")


def silver(
    reviews: DataFrame,
    corrupt_ids: Iterable[str] | None = None,
    null_key: str = "drop",
    ratings: DataFrame | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Distinct (user, product, cleaned review, rating)."""
    own = ["user_id", "product_id", "review_content", "rating" if ratings is None else key]
    return distinct_on(_rated(cleaned(reviews.select(*own), corrupt_ids, null_key), ratings, key))


def _bodies(
    reviews: DataFrame, corrupt_ids: Iterable[str] | None, null_key: str, last: str
) -> DataFrame:
    """``review_body`` and the column ``last``: the rating, or the key of its table."""
    rows = cleaned(reviews.select("product_id", "review_content", last), corrupt_ids, null_key)
    return rows.select(F.col("review_content").alias("review_body"), last)


def gold(
    reviews: DataFrame,
    corrupt_ids: Iterable[str] | None = None,
    null_key: str = "drop",
    ratings: DataFrame | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """The training set: one row per cleaned body, ``(review_body, sentiment)``.

    Copies with different ratings: the highest known one gives the label, so
    two runs agree whatever the partitioning. The four-key dedup is implied by
    the body dedup and is not repeated here. ``ratings`` (``key, rating``) are
    joined after cleaning; without it ``reviews`` has the rating.
    """
    bodies = _bodies(reviews, corrupt_ids, null_key, "rating" if ratings is None else key)
    best = best_rating_per(_rated(bodies, ratings, key), ["review_body"])
    return best.select("review_body", sentiment("rating").alias("sentiment"))


def gold_counts(
    reviews: DataFrame,
    corrupt_ids: Iterable[str] | None = None,
    null_key: str = "drop",
    ratings: DataFrame | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """``sentiment_counts(gold(...))`` without moving any text."""
    last = "rating" if ratings is None else key
    digests = digest_of(_bodies(reviews, corrupt_ids, null_key, last), "review_body", last)
    best = best_rating_per(_rated(digests, ratings, key), ["digest"])
    return sentiment_counts(best.select(sentiment("rating").alias("sentiment")))


def bronze_to_silver(
    spark: SparkSession,
    source: str,
    target: str,
    corrupt_ids: Iterable[str] | DataFrame = (),
    null_key: str = "drop",
    corrupt_aside: bool = False,
    header: bool = True,
    salts: int = 1,
) -> dict[str, int]:
    """Messy CSV files to a Parquet table with a kept and a quarantined side.

    ``corrupt_ids`` is a list of products or a table with ``product_id``, whose hot keys
    ``salts`` spreads. With any, fields are trimmed before they are compared, as such
    files are padded; without, they are read as they are. ``corrupt_aside`` puts rows
    that do not parse on a side of their own, with their ``reason``, in the same pass. A
    file larger than a split is read by several tasks.

    Returns how many ``rows`` came in, how many each side got, and how many had
    ``no_key`` and are on none. They are counted by the tasks that write the rows.
    """
    any_ids = isinstance(corrupt_ids, DataFrame) or bool(corrupt_ids := list(corrupt_ids))
    how = {"header": header, "trimmed": any_ids, "split_files": True}
    if corrupt_aside:
        rows = csv.scan_flagged(spark, source, list(REVIEW_COLUMNS), **how)
    else:
        rows = csv.scan_schema(spark, source, multi_line=True, **how)
    split = with_split(rows, "product_id", corrupt_ids, "keep", salts)
    if null_key == "drop":
        on_a_side = F.col("product_id").isNotNull()
        split = split.withColumn("split", F.when(on_a_side, F.col("split")))
    if corrupt_aside:
        split = split_by_reason(split)
    return sinks.write_counted_split(split, target, "parquet")


def silver_to_gold(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "csv",
    max_records: int = sinks.MAX_RECORDS,
    file_bytes: int | None = None,
) -> None:
    """Kept silver rows to the published training set and its label report.

    ``file_bytes`` gives files of about that size instead of ``max_records`` rows.
    """
    reviews = csv.scan_side(spark, source, KEPT, fmt="parquet")
    table = sinks.publish(
        gold(reviews), f"{target}/training_dataset", fmt, max_records, file_bytes=file_bytes
    )
    if fmt == "csv":
        published = csv.scan_lossless(spark, table, GOLD_SCHEMA, multi_line=False)
    else:
        published = spark.read.format(fmt).load(table)
    sinks.write_report(sentiment_counts(published), f"{target}/sentiment_counts")
