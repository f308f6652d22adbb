"""Deduplication.

Every form is one hash aggregate: copies collapse inside each map task before
the shuffle, so a text that makes up a third of all rows reaches its reducer as
one row per task. Which copy survives is never left to chance: either the row
is its keys, or the highest rating wins (NULL loses to any rating).

Where most texts occur once and are long, ``repeats_first`` saves moving those: hashes of
8 bytes are counted, and only rows whose hash may be that of another row meet in the
aggregate. The others stay where they were read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.sources.scratch import written

REVIEW_KEYS = ("user_id", "product_id", "review_content", "rating")
BITMAP_BITS = 1 << 15  # of one value of bitmap_construct_agg
BITS_PER_REPEAT = 16  # one row in 16 that has no copy is moved for nothing
MAX_BITS = 1 << 29  # 64 MB in all


def distinct_on(
    df: DataFrame, keys: Sequence[str] = REVIEW_KEYS, repeats_first: bool = False
) -> DataFrame:
    """One row per key combination; NULL keys count as equal."""
    rows = df.select(*keys)
    if repeats_first:
        single, others = split_repeats(rows, keys)
        return single.unionAll(others.distinct())
    return rows.distinct()


def best_rating_per(
    df: DataFrame, keys: Sequence[str], rating: str = "rating", repeats_first: bool = False
) -> DataFrame:
    """One row per key combination, with its highest rating.

    Carry the number and label it afterwards: a string payload would turn the
    hash aggregate into a sort aggregate.
    """
    if repeats_first:
        single, others = split_repeats(df.select(*keys, rating), keys)
        return single.unionAll(best_rating_per(others, keys, rating))
    return df.groupBy(*keys).agg(F.max(rating).alias(rating))


def split_repeats(
    df: DataFrame, keys: Sequence[str], max_bits: int = MAX_BITS
) -> tuple[DataFrame, DataFrame]:
    """Rows that surely have no copy, and all others: every row is in one of the two.

    Hashes that occur twice are written to the scratch folder and set bits in a filter
    of at most ``max_bits``, which is broadcast. A row whose bit is not set is single. A
    set bit is a suspicion: a full filter makes the second frame larger, never wrong.
    Equal keys (NULL, NaN and signed zeros as in ``groupBy``) have equal hashes.

    ``df`` is read three times, so it has to give the same rows every time: write it
    first where it is costly or depends on the run.
    """
    hashed = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("hash"))
    repeated = hashed.groupBy("hash").count().where("count > 1").select("hash")
    repeated = written(repeated, "repeated")
    bits = min(max_bits, BITMAP_BITS)
    while bits < max_bits and bits < BITS_PER_REPEAT * repeated.count():
        bits *= 2
    filters = _bitmaps(repeated, bits)

    taken = {c.lower() for c in df.columns}
    place, bitmap = "place", "bitmap"
    while taken & {place, bitmap, f"{place}_segment"}:
        place, bitmap = f"_{place}", f"_{bitmap}"
    segment = f"{place}_segment"
    at = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(bits))
    rows = df.withColumn(place, at).withColumn(segment, _segment(F.col(place)))
    filters = filters.select(F.col("segment").alias(segment), F.col("bitmap").alias(bitmap))
    tested = rows.join(F.broadcast(filters), segment, "left")
    suspected = F.coalesce(_bit(F.col(bitmap), F.col(place)), F.lit(False))
    own = [F.col(f"`{c}`") for c in df.columns]
    return tested.where(~suspected).select(*own), tested.where(suspected).select(*own)


def _segment(place: Column) -> Column:
    return F.floor(place / F.lit(BITMAP_BITS)).cast("bigint")


def _bitmaps(hashes: DataFrame, bits: int) -> DataFrame:
    """``segment, bitmap``: segments of 2^15 bits, those of the given hashes set."""
    place = F.pmod("hash", F.lit(bits)).alias("place")
    return (
        hashes.select(place)
        .groupBy(_segment(F.col("place")).alias("segment"))
        .agg(F.bitmap_construct_agg(F.col("place") % BITMAP_BITS).alias("bitmap"))
    )


def _bit(bitmap: Column, place: Column) -> Column:
    """Whether the bit of ``place`` is set: bit n is bit n % 8 of byte n / 8."""
    bit = (place % BITMAP_BITS).cast("int")
    byte = F.substring(bitmap, (F.shiftright(bit, 3) + 1), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit % 8) == 1


def digest_of(df: DataFrame, text: str, *others: str) -> DataFrame:
    """``digest`` in place of a text that is not wanted itself, and other columns.

    What is shuffled by it is a 32-byte SHA-256, not the text.
    """
    return df.select(F.unhex(F.sha2(F.col(text), 256)).alias("digest"), *others)


def best_rating_per_digest(df: DataFrame, text: str, rating: str = "rating") -> DataFrame:
    """As ``best_rating_per(df, [text])``, by digest."""
    return best_rating_per(digest_of(df, text, rating), ["digest"], rating)
