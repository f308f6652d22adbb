"""Helpers shared by the operators.

Operators read their columns once, at the start, under names of their own, so
extra columns of any name do no harm. Text reaches Python as UTF-8 bytes: a
text that is no valid UTF-8 cannot stop a task, and ASCII rules need no decoding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.sources.scratch import scratch_path

# Bytes that the contracts treat as word bytes in code text: all but these.
_ALNUM = bytes(b for b in range(128) if chr(b).isalnum())
_FOLD = bytes(
    (b | 0x20 if 65 <= b <= 90 else b) if b >= 128 or b in _ALNUM else 0x20 for b in range(256)
)

UTF8_CONTINUATION = bytes(range(0x80, 0xC0))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


def columns(df: DataFrame, **names: str) -> DataFrame:
    """``columns(df, doc_id="id", text="body")``: these columns, under these names."""
    return df.select(*[F.col(source).alias(name) for name, source in names.items()])


def as_bytes(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("binary") for name in names})


def keyed_schema(docs: DataFrame, ddl: str) -> T.StructType:
    """``doc_id`` as it comes in, of any type, and the columns of ``ddl``."""
    return T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(ddl).fields])


def map_batches(
    df: DataFrame,
    schema: T.StructType | str,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    rows: int | None = 512,
) -> DataFrame:
    """Apply to every Arrow batch the function that ``make`` builds once per task.

    It gets ``rows`` rows at a time, so that what it builds stays small next to the
    batch, or the whole batch with ``rows=None``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                yield step(batch.slice(start, rows))

    return df.mapInArrow(run, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    Cuts the lineage: what follows reads files that every executor sees, so rows
    and row numbers stay the same whatever is lost and computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


HOT = 1000


def join_counted(rows: DataFrame, known: DataFrame, key: str, counted: str, how: str) -> DataFrame:
    """``rows.join(known, key, how)`` where ``known`` has a key once and says in ``counted``
    how many of the rows hold it.

    Keys that one row in ``HOT`` holds, ``HOT`` keys at most, are broadcast, so a key of a
    third of all rows is met where its rows are; only rows of the other keys are shuffled.
    Both frames are read twice: they should be written.
    """
    often = F.col(counted) * HOT >= rows.count()
    hot = F.broadcast(known.where(often).drop(counted))
    others = rows.join(F.broadcast(known.where(often).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(
        others.join(known.where(~often).drop(counted), key, how)
    )
