"""CSV scans.

A quoted field may hold newlines, so such files need ``multiLine``, and Spark
then reads each file in one task. With ``split_files`` files larger than a split are
read by as many tasks as they have splits (``multiline.py``), row for row the same.
Tables between layers are Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.sources.multiline import scan_large_split
from reviewloom.sources.schema import REVIEW_SCHEMA

CORRUPT = "_corrupt_record"

# Quotes are doubled inside quoted fields.
QUOTING = {"header": True, "quote": '"', "escape": '"'}

# Fixed values. As received: padded fields are trimmed, damaged rows become NULLs.
MESSY = {
    **QUOTING,
    "multiLine": True,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "mode": "PERMISSIVE",
}

# Shared by writer and reader: padding, '' and NULL all survive a round trip.
LOSSLESS = {
    **QUOTING,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": r"\N",
}


def scan_strings(spark: SparkSession, path: str) -> DataFrame:
    """One record per line; names from the header; every column a string."""
    return spark.read.option("header", True).csv(path)


def scan_messy(spark: SparkSession, path: str) -> DataFrame:
    """Quoted multi-line records, trimmed; every column a string."""
    return spark.read.options(**MESSY).csv(path)


def scan_schema(
    spark: SparkSession,
    path: str,
    schema: str = REVIEW_SCHEMA,
    multi_line: bool = False,
    trimmed: bool = False,
    header: bool = True,
    split_files: bool = False,
) -> DataFrame:
    """Declared schema; a value that does not parse becomes NULL.

    ``path`` is a file or a directory. ``multi_line`` reads newlines inside
    quoted fields; without it records are lines and files stay splittable.
    ``trimmed`` also takes padding off, before and after quotes. ``split_files``
    reads large multi-line files in several tasks; it writes their lines to the
    scratch folder once.
    """
    options = {**QUOTING, "multiLine": True} if multi_line else {}
    if trimmed:
        options = {**MESSY, "multiLine": multi_line}
    options["header"] = header
    if multi_line and split_files:
        return scan_large_split(spark, path, schema, options)
    return spark.read.options(**options).schema(schema).csv(path)


def scan_lossless(
    spark: SparkSession, path: str, schema: str, multi_line: bool = True
) -> DataFrame:
    """Read back what ``sinks.write_csv`` wrote, value for value.

    Where no value can hold a line break, ``multi_line=False`` reads by lines and
    keeps files splittable.
    """
    return spark.read.options(**LOSSLESS, multiLine=multi_line).schema(schema).csv(path)


def scan_side(
    spark: SparkSession, path: str, side: str, schema: str = REVIEW_SCHEMA, fmt: str = "csv"
) -> DataFrame:
    """One side of what ``sinks.write_split`` wrote; the other side is not read.

    A side without rows has no directory and comes back empty.
    """
    reader = spark.read.schema(f"{schema}, split string").format(fmt)
    if fmt == "csv":
        reader = reader.options(**LOSSLESS, multiLine=True)
    return reader.load(path).where(F.col("split") == side).drop("split")


def parse_rating(c: Column) -> Column:
    """Text to double; NULL where it is no number."""
    return c.try_cast("double")


def scan_flagged(
    spark: SparkSession,
    path: str,
    columns: list[str],
    rating: str = "rating",
    header: bool = True,
    trimmed: bool = True,
    split_files: bool = False,
) -> DataFrame:
    """Scan in one pass and say what is wrong with each row.

    ``reason`` is ``arity`` (too few or too many fields), ``rating`` (text that
    is no number) or NULL. ``rating`` comes back as a double. The raw record of
    an ``arity`` row stays in ``_corrupt_record``. Files with columns of either name
    need others in ``columns``.
    """
    if {"reason", CORRUPT} & set(columns):
        raise ValueError(f"'reason' and {CORRUPT!r} are added and cannot be read as columns")
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    padding = {f"ignore{side}WhiteSpace": trimmed for side in ("Leading", "Trailing")}
    options = {**MESSY, "header": header, **padding, "columnNameOfCorruptRecord": CORRUPT}
    if split_files:
        rows = scan_large_split(spark, path, schema, options)
    else:
        rows = spark.read.options(**options).schema(schema).csv(path)
    number = parse_rating(F.col(rating))
    reason = F.when(F.col(CORRUPT).isNotNull(), "arity").when(
        F.col(rating).isNotNull() & number.isNull(), "rating"
    )
    return rows.withColumn("reason", reason).withColumn(rating, number)


def split_corrupt(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sound, corrupt)`` halves of a ``scan_flagged`` result.

    Each half scans the source. To have both, write them in one pass with
    ``keysplit.split_by_reason`` and ``sinks.write_split``.
    """
    sound = flagged.where(F.col("reason").isNull()).drop("reason", CORRUPT)
    return sound, flagged.where(F.col("reason").isNotNull())
