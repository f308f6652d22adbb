"""Sinks. Every write replaces the target directory as one Spark job.

``max_records`` bounds the rows of a CSV file, and with them the work of the one
task that reads a file with line breaks inside fields. It drops nothing. ``file_bytes``
gives files of about that many bytes, however long the texts are.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.keysplit import SIDES
from reviewloom.sources.csv import LOSSLESS
from reviewloom.sources.scratch import scratch_path

MAX_RECORDS = 100_000


def write_csv(
    df: DataFrame,
    path: str,
    max_records: int = MAX_RECORDS,
    null_value: str = LOSSLESS["nullValue"],
    file_bytes: int | None = None,
) -> None:
    """Lossless CSV, as many part files as there are partitions or more.

    With ``null_value=""`` other programs need no convention for NULL, but ''
    reads back as NULL. With ``file_bytes`` files have about that size
    (``sized``) and ``max_records`` is not used.
    """
    options = {**LOSSLESS, "nullValue": null_value}
    if file_bytes is None:
        options["maxRecordsPerFile"] = max_records
    else:
        df = sized(df, file_bytes, "csv", options)
    df.write.mode("overwrite").options(**options).csv(path)


def write_plain_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and otherwise default options."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, file_bytes: int | None = None) -> None:
    """Parquet; with ``file_bytes`` in files of about that size (``sized``)."""
    if file_bytes is not None:
        df = sized(df, file_bytes, "parquet")
    df.write.mode("overwrite").parquet(path)


def sized(
    df: DataFrame, file_bytes: int, fmt: str = "csv", options: dict | None = None
) -> DataFrame:
    """The rows, dealt to as many tasks as there are ``file_bytes`` in the files they fill.

    Rows are written to the scratch folder, once, and measured meanwhile: for CSV each
    row as the line it will be, for Parquet by the files. Dealing them in turn gives files
    of equal numbers of rows, so sizes are within a factor of two of the wanted one if
    that is many times the longest row and there is as much to write. The advisory size of
    a ``REBALANCE`` would count compressed shuffle blocks: text shrinks there by a factor
    that depends on the text. Parquet files of rows that compress well because like stands
    next to like get larger than measured, as dealing parts them.

    No rows give no task but an empty one; a row longer than a file has one of its own size.
    """
    if file_bytes < 1:
        raise ValueError(f"file_bytes must be positive, not {file_bytes}")
    spark = df.sparkSession
    path = scratch_path(spark, "sized")
    if fmt == "csv":
        seen = Observation("sized")
        line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options or LOSSLESS)
        measured = df.observe(seen, F.sum(F.octet_length(line) + 1).alias("bytes"))
        measured.write.parquet(path)
        total = seen.get["bytes"] or 0
    else:
        df.write.parquet(path)
        files, root = _files(spark, path)
        total = files.getContentSummary(root).getLength()
    rows = spark.read.schema(df.schema).parquet(path)
    return rows.repartition(max(1, math.floor(total / file_bytes + 0.5)))


def write_split(
    df: DataFrame, path: str, fmt: str = "csv", max_records: int = MAX_RECORDS
) -> None:
    """Write a ``keysplit.with_split`` frame: one directory per side, one scan.

    A task keeps one file per side open, so rows need no sort by side. Read a
    side back with ``csv.scan_side``.
    """
    writer = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer = writer.options(**LOSSLESS).option("maxRecordsPerFile", max_records)
    with _setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "8"):
        writer.format(fmt).save(path)


def write_counted_split(
    df: DataFrame, path: str, fmt: str = "csv", max_records: int = MAX_RECORDS
) -> dict[str, int]:
    """``write_split``, and the number of all ``rows``, of the rows of each side and of those
    with ``no_key``, whose ``split`` is NULL: they are counted and not written.

    The tasks that write count as they go (``Observation``): no second scan, and a task
    that runs again counts once.
    """
    seen = Observation("split")
    side = F.col("split")
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(side == name).alias(name) for name in SIDES],
        F.count_if(side.isNull()).alias("no_key"),
    )
    write_split(counted.where(side.isNotNull()), path, fmt, max_records)
    return {name: int(count) for name, count in seen.get.items()}


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of one write."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file. For reports of a few rows, never for a data set.

    ``repartition`` rather than ``coalesce``: the plan above keeps its
    parallelism and only the finished rows meet in one task.
    """
    df.repartition(1).write.mode("overwrite").options(**LOSSLESS).csv(path)


def publish(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    max_records: int = MAX_RECORDS,
    abandoned_after: float = 24.0,
    file_bytes: int | None = None,
) -> str:
    """Make ``df`` the published rows of the table at ``path``; the path of the new version.

    Every version has a directory of its own, ``v-<name>``, written in full before an empty
    file ``_current-<number>-<name>`` makes it the published one: the greatest number counts
    (``current``). Creating that file is the only step readers see, and needs no rename, so
    there is no moment without a table, on object stores either. A job that stops at any
    step leaves the table as it was or as it should be.

    The version before stays for readers that are under way; older ones go, and so do
    directories that never became a version, ``abandoned_after`` hours after their last
    change. One job at a time should publish a table: of two the last to finish counts.
    """
    files, root = _files(df.sparkSession, path)
    name = uuid.uuid4().hex
    version = f"{path.rstrip('/')}/{VERSION}{name}"
    if fmt == "csv":
        write_csv(df, version, max_records, file_bytes=file_bytes)
    elif file_bytes is not None:
        sized(df, file_bytes, fmt).write.format(fmt).save(version)
    else:
        df.write.format(fmt).save(version)
    versions = _versions(files, root)
    number = versions[-1][0] + 1 if versions else 1
    files.create(_child(df.sparkSession, root, f"{CURRENT}{number}-{name}"), False).close()
    _clean(df.sparkSession, files, root, abandoned_after)
    return version


VERSION, CURRENT = "v-", "_current-"


def current(spark: SparkSession, path: str) -> str:
    """The directory of the published version of the table at ``path``."""
    files, root = _files(spark, path)
    versions = _versions(files, root)
    if not versions:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{path.rstrip('/')}/{VERSION}{versions[-1][1]}"


def _files(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _child(spark: SparkSession, root, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(root, name)


def _versions(files, root) -> list[tuple[int, str]]:
    """Number and name of every version that was published and is still there, in order."""
    found = []
    for entry in files.listStatus(root) if files.exists(root) else []:
        if (file := entry.getPath().getName()).startswith(CURRENT):
            number, name = file.removeprefix(CURRENT).split("-", 1)
            found.append((int(number), name))
    return sorted(found)


def _clean(spark: SparkSession, files, root, abandoned_after: float) -> None:
    """Keep the published version and the one before. A version's file goes before its
    rows, so what is left of a clean-up that stops is an abandoned directory."""
    versions = _versions(files, root)
    for number, name in versions[:-2]:
        files.delete(_child(spark, root, f"{CURRENT}{number}-{name}"), False)
        files.delete(_child(spark, root, VERSION + name), True)
    known = {VERSION + name for _, name in versions}
    for entry in files.listStatus(root):
        old = time.time() - entry.getModificationTime() / 1000 >= abandoned_after * 3600
        name = entry.getPath().getName()
        if name.startswith(VERSION) and name not in known and old:
            files.delete(entry.getPath(), True)
