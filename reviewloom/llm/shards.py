"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters whole records over buckets by a seeded hash of their row number, so
neither copies nor a hot key can fill a bucket. There are as many buckets as it takes for
each to fit in memory, by bytes and by rows. Pass two runs Spark's ``shuffle``
(Fisher-Yates) over the records of each bucket and writes them. The buckets one after the
other are one random order of all records; dealing that order round-robin gives shards
whose counts differ by one at most.

Records move once. One of more than ``GIANT_BYTES`` would not sit well in an array: such
records are written first and dealt by number, and come back to their places in a join.

Shards and slots are told of what was written, so they stay the same when tasks run
again. Project records to what is needed before: every column moves.

Defined results: records are rows, so NULLs, empty texts, ties and repeated rows
are all dealt like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import written

SHARDS = 24
SEED = 42
BUCKET_BYTES = 16 << 20  # of records in one array, by their strings
BUCKET_ROWS = 16_384
GIANT_BYTES = 1 << 20
BLOCK = 1024  # buckets whose offsets are summed together
MAX_TASKS = 100_000  # of the second pass; beyond, a task takes several buckets
SENT_BUCKETS = 1_000_000  # offsets that are broadcast, 16 bytes each


def _size(schema: T.StructType) -> Column:
    """Bytes of a record's strings, and eight for every other column."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
        else F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.lit(8)
        for f in schema.fields
    ]
    return sum(sizes, F.lit(0)).cast("bigint")


def shuffle_into_shards(
    records: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    bucket_bytes: int = BUCKET_BYTES,
    giant_bytes: int = GIANT_BYTES,
) -> DataFrame:
    """``record`` (all columns, as a struct), ``shard`` (from 0) and ``slot`` in it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    rows = records.select(whole.alias("record"), _size(records.schema).alias("size"))
    giant = F.col("size") > giant_bytes
    light = F.when(giant, 8).otherwise(F.col("size"))
    total = rows.agg(
        F.count("*").alias("rows"), F.sum(light).alias("bytes"), F.count_if(giant).alias("giants")
    ).first()
    buckets = max(1, -(-total.rows // bucket_rows), -(-(total.bytes or 0) // bucket_bytes))

    number = F.monotonically_increasing_id()
    none = F.lit(None).cast("bigint").alias("giant")
    dealt = rows.where(~giant).select(number.alias("row"), none, "record")
    if total.giants:
        giants = written(rows.where(giant).select(number.alias("giant"), "record"), "giants")
        # Numbers below zero: no other row has them.
        own = (-1 - F.col("giant")).alias("row")
        nothing = F.lit(None).cast(dealt.schema["record"].dataType).alias("record")
        dealt = dealt.union(giants.select(own, "giant", nothing))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col("row")), F.lit(buckets)).alias("bucket")
    scattered = dealt.select(bucket, F.struct("row", "giant", "record").alias("entry"))

    # In order first, as that of arrival in a bucket is not repeatable; and buckets in
    # order, as a task draws its random numbers from one sequence for all of its own.
    by_row = lambda a, b: F.when(a["row"] < b["row"], -1).otherwise(1)
    shuffled = (
        scattered.repartition(min(buckets, MAX_TASKS), "bucket")
        .groupBy("bucket")
        .agg(F.collect_list("entry").alias("members"))
        .sortWithinPartitions("bucket")
        .withColumn("members", F.array_sort("members", by_row))
        .select("bucket", F.posexplode(F.shuffle("members", F.lit(seed))).alias("at", "entry"))
        .select("bucket", "at", "entry.giant", "entry.record")
    )
    shuffled = written(shuffled, "buckets")
    offsets = _offsets(shuffled.groupBy("bucket").agg(F.count("*").alias("rows")))
    if buckets <= SENT_BUCKETS:  # else records move again, to meet them
        offsets = F.broadcast(offsets)
    rank = F.col("offset") + F.col("at")
    placed = shuffled.join(offsets, "bucket").select(
        "record",
        (rank % shards).cast("int").alias("shard"),
        F.floor(rank / F.lit(shards)).alias("slot"),
        "giant",
    )
    if not total.giants:
        return placed.drop("giant")
    back = placed.where("giant IS NOT NULL").drop("record").join(giants, "giant")
    return placed.where("giant IS NULL").drop("giant").unionByName(back.drop("giant"))


def _offsets(sizes: DataFrame) -> DataFrame:
    """``bucket, offset``: the rows of all buckets before, within blocks of buckets
    and over the blocks, so that no task sees more than a block or a row per block."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    blocks = (
        sizes.groupBy("block")
        .agg(F.sum("rows").alias("all_rows"))
        .select("block", F.sum("all_rows").over(before.orderBy("block")).alias("above"))
    )
    inside = F.sum("rows").over(before.partitionBy("block").orderBy("bucket"))
    offset = F.coalesce(F.col("above"), F.lit(0)) + F.coalesce(F.col("inside"), F.lit(0))
    return (
        sizes.withColumn("inside", inside)
        .join(blocks, "block")
        .select("bucket", offset.alias("offset"))
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One directory per shard, with rows in slot order inside a file.

    Without another shuffle: buckets were written in their random order, and a task
    deals the ones it reads to all shards.
    """
    rows = sharded.select("shard", "slot", "record.*") if "record" in sharded.columns else sharded
    ordered = rows.sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)
