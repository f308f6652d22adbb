"""Where intermediate files go."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """This package's folder in ``spark.checkpoint.dir``, else in the warehouse.

    Executors need to share it. The warehouse is a folder of the driver's machine unless
    the session says otherwise: on a cluster that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        own_disk = root.startswith(("file:", "/")) or "://" not in root
        if own_disk and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(
                f"executors do not share {root}: set spark.checkpoint.dir to a folder they share"
            )
    return f"{root.rstrip('/')}/reviewloom"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all intermediate files of this package; true if there were any.

    Call it when no result that reads them is in use any more, by any session
    that shares the folder.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the scratch folder and read back: what follows is cut off from ``df``."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
