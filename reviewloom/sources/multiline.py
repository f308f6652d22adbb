"""CSV files with line breaks inside quotes, each read by as many tasks as it has splits.

Spark reads such a file in one task, as nobody knows at the start of a split whether it
lies inside quotes. Here files are read by lines. What a line does to that state, from
outside and from inside of quotes, is told by its quotes alone: it leaves the state as
it is, swaps it, or sets it. The effects are combined by prefix sums of the swaps since
the last line that sets it, first over the lines of a split, then over the splits of a
file (a row each). Every line then knows the record it belongs to. Records are put
together inside their split. Lines of records over a border between splits are told from
the row of their split: they alone meet in a second shuffle. Spark's own ``from_csv``
parses the records.

The lines go to the scratch folder first: splits follow the number of cores at the time,
and line numbers must not change between the steps.

A file that is not plain in this sense is read whole by Spark's reader, so that rows are
the same in every case: carriage returns, an empty first line, text between a closing quote
and the next comma, quotes still open at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.sources.scratch import written

# States within a line: in an unquoted field, in quotes, behind a closing quote, not
# plain, and at the start of a line outside of quotes.
OPEN, QUOTED, CLOSED, ODD, NEW = range(5)


def _blank(text: Column, trimmed: bool) -> Column:
    return text.rlike(r"\A[\x00-\x20]*\z") if trimmed else text == ""


def _end_state(line: Column, begin: int, trimmed: bool) -> Column:
    """``OPEN``, ``QUOTED`` or ``ODD``: where a line ends that starts in state ``begin``."""
    parts = F.split(line, '"', -1)

    def quote(state: Column, before: Column) -> Column:
        comma = F.contains(before, F.lit(","))
        ended = _blank(F.substring_index(before, ",", 1), trimmed)
        starts = _blank(F.substring_index(before, ",", -1), trimmed)
        opened = F.when(starts, QUOTED).otherwise(OPEN)
        return (
            F.when(state == ODD, ODD)
            .when(state == QUOTED, CLOSED)
            .when(state == NEW, opened)
            .when((state == CLOSED) & (before == ""), QUOTED)  # a doubled quote
            .when((state == CLOSED) & ~(comma & ended), ODD)
            .when(comma, opened)
            .otherwise(OPEN)
        )

    state = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), F.lit(begin), quote)
    rest = F.element_at(parts, -1)
    plain = _blank(F.substring_index(rest, ",", 1), trimmed)
    # Most lines inside a long text have no quote: nothing to split, no state changes.
    return (
        F.when(~F.contains(line, F.lit('"')), QUOTED if begin == QUOTED else OPEN)
        .when(state.isin(QUOTED, ODD), state)
        .when((state == CLOSED) & ~plain, ODD)
        .otherwise(OPEN)
    )


def _text(spark: SparkSession, path: str | list[str], above: int | None) -> DataFrame:
    """The lines of all files, or of those of more than ``above`` bytes."""
    lines = spark.read.text(path, lineSep="\n")
    return lines if above is None else lines.where(F.col("_metadata.file_size") > above)


def _lines(text: DataFrame, trimmed: bool) -> DataFrame:
    """Every line of every file, numbered in its split, and what it does to the state."""
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    return lines.select(
        "*",
        _end_state(F.col("value"), NEW, trimmed).alias("outside"),
        _end_state(F.col("value"), QUOTED, trimmed).alias("inside"),
        F.contains("value", F.lit("\r")).alias("odd"),
    )


def _ends(rows: DataFrame, own: Window, before: Window) -> DataFrame:
    """Add ``swaps`` and ``set`` over all rows up to each: the state behind a row is that at
    the start, swapped ``swaps`` times, or the value of ``set``, swapped since.

    ``outside`` and ``inside``: whether a row ends in quotes that starts out of, or in them.
    """
    swap = F.col("outside") & ~F.col("inside")
    sets = F.col("outside") == F.col("inside")
    rows = rows.withColumn("swaps", F.sum(swap.cast("bigint")).over(own))
    last = F.struct(F.col("outside").alias("value"), F.col("swaps").alias("at"))
    rows = rows.withColumn("set", F.last(F.when(sets, last), ignorenulls=True).over(own))
    return rows.withColumns(
        {
            "swaps_before": F.coalesce(F.lag("swaps").over(before), F.lit(0)),
            "set_before": F.lag("set").over(before),
        }
    )


def _state(begin: Column, swaps: str, last: str) -> Column:
    """Whether quotes are open, after ``swaps`` and the value last set, if any."""
    start = F.coalesce(F.col(f"{last}.value"), begin)
    count = F.col(swaps) - F.coalesce(F.col(f"{last}.at"), F.lit(0))
    return start != (F.pmod(count, F.lit(2)) == 1)


def _within(lines: DataFrame) -> DataFrame:
    in_split = Window.partitionBy("file", "block").orderBy("id")
    quoted = {name: F.col(name) == QUOTED for name in ("outside", "inside")}
    odd = {f"odd_{name}": F.col(name) == ODD for name in ("outside", "inside")}
    rows = lines.withColumns({**odd, **quoted})
    return _ends(rows, in_split.rowsBetween(Window.unboundedPreceding, 0), in_split)


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: ``finish`` (does it end inside of quotes), ``begun`` (the first line
    of the first record that starts in it, if any), ``key`` (of its last record), ``carried``
    (of the record it goes on with), ``header`` (the first line of its file) and ``odd`` (is
    its file not plain)."""
    rows = _within(lines.drop("value"))
    told = []
    for name, inside in (("outside", False), ("inside", True)):
        starts = _state(F.lit(inside), "swaps_before", "set_before")
        ends = _state(F.lit(inside), "swaps", "set")
        odd = F.when(starts, F.col("odd_inside")).otherwise(F.col("odd_outside"))
        told += [
            F.max_by(ends, "id").alias(name),
            F.min(F.when(~starts, F.col("id"))).alias(f"begun_{name}"),
            F.max(F.when(~starts, F.col("id"))).alias(f"key_{name}"),
            F.bool_or(odd | F.col("odd")).alias(f"odd_{name}"),
        ]
    blank = F.min_by(F.col("empty"), "id") & (F.col("block") == 0)
    rows = rows.groupBy("file", "block").agg(*told, F.min("id").alias("first"), blank.alias("blank"))
    in_file = Window.partitionBy("file").orderBy("block")
    whole = Window.partitionBy("file")
    rows = _ends(rows, in_file.rowsBetween(Window.unboundedPreceding, 0), in_file)
    begin = _state(F.lit(False), "swaps_before", "set_before")
    finish = _state(F.lit(False), "swaps", "set")
    by_begin = lambda name: F.when(
        begin, F.col(f"{name}_inside")
    ).otherwise(F.col(f"{name}_outside"))
    rows = rows.select(
        "file", "block", "first", "blank", finish.alias("finish"),
        by_begin("begun").alias("begun"), by_begin("key").alias("key"), by_begin("odd").alias("odd"),
    )
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.max_by("finish", "block").over(whole)
    return rows.select(
        "file",
        "block",
        "finish",
        "begun",
        F.last("key", ignorenulls=True).over(before).alias("carried"),
        F.coalesce("key", F.last("key", ignorenulls=True).over(before)).alias("key"),
        F.min_by("first", "block").over(whole).alias("header"),
        (F.bool_or(F.col("odd") | F.col("blank")).over(whole) | open_end).alias("odd"),
    )


def records(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    trimmed: bool = False,
    above: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """``record``: the text of every record of the plain files; and the other files.

    ``above`` leaves out files of that many bytes or fewer. Names of files go through
    the driver, as they do when Spark lists them.
    """
    lines = _lines(_text(spark, path, above), trimmed).withColumn("empty", F.col("value") == "")
    lines = written(lines, "csv_lines")
    splits = written(_splits(lines), "csv_splits")
    odd = [r.file for r in splits.where("odd").select("file").distinct().collect()]
    own = F.broadcast(splits) if _small(splits) else splits
    known = lines.join(own.where("NOT odd"), ["file", "block"])
    # The record of a line that goes over a border: it was begun before the split, or is the
    # last one of a split that ends in quotes. From here on the first line stands for its
    # file: a number is shorter to move and sort than a path.
    edge = F.when(F.col("begun").isNull() | (F.col("id") < F.col("begun")), F.col("carried"))
    edge = edge.when(F.col("finish") & (F.col("id") >= F.col("key")), F.col("key"))
    known = known.select(
        F.col("header").alias("file"), "block", "id", "value", "outside", "inside",
        edge.alias("edge"),
    )
    # What is left of a split starts outside of quotes.
    inner = _within(known.where("edge IS NULL"))
    starts = ~_state(F.lit(False), "swaps_before", "set_before")
    so_far = Window.partitionBy("file", "block").orderBy("id")
    key = F.last(F.when(starts, F.col("id")), ignorenulls=True).over(
        so_far.rowsBetween(Window.unboundedPreceding, 0)
    )
    # Grouped where the window left them: no shuffle.
    whole = _record(inner.select("file", "block", "id", "value", key.alias("key")), header)
    pieces = known.where("edge IS NOT NULL").withColumn("key", F.col("edge"))
    pieces = _record(pieces, header)
    over_borders = pieces.groupBy("file", "key").agg(_joined("block", "record").alias("record"))
    found = whole.select("record").union(over_borders.select("record"))
    return found.where(F.col("record") != ""), odd


def _record(rows: DataFrame, header: bool) -> DataFrame:
    """The lines of every record in a split, joined; not those of the header."""
    if header:
        rows = rows.where(F.col("key") != F.col("file"))
    return rows.groupBy("file", "block", "key").agg(_joined("id", "value").alias("record"))


def _joined(order: str, text: str) -> Column:
    pieces = F.sort_array(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(pieces, lambda piece: piece[text]), "\n")


def _small(splits: DataFrame, most: int = 10_000) -> bool:
    """A row is some 300 bytes: beyond this many splits both sides are shuffled."""
    return splits.count() <= most


def scan_split(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    options: dict[str, object],
    above: int | None = None,
) -> DataFrame:
    """As ``spark.read.options(**options, multiLine=True).schema(schema).csv(path)``, by
    records instead of files. The delimiter is a comma, the quote doubled inside quotes."""
    options = {**options, "multiLine": True}
    trimmed = bool(options.get("ignoreLeadingWhiteSpace"))
    found, odd = records(spark, path, bool(options.get("header")), trimmed, above)
    how = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    parsed = F.from_csv("record", _ddl(schema), {**how, "header": "false"})
    rows = found.select(parsed.alias("row")).select("row.*")
    return rows.union(spark.read.options(**options).schema(schema).csv(odd)) if odd else rows


def scan_large_split(
    spark: SparkSession, path: str | list[str], schema: str, options: dict[str, object]
) -> DataFrame:
    """Files larger than a split by ``scan_split``, the others by Spark's reader, whose one
    task per file is then no larger than any other task of a scan."""
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)
    rows = spark.read.options(**{**options, "multiLine": True}).schema(schema).csv(path)
    if _text(spark, path, split).isEmpty():
        return rows
    small = rows.where(F.col("_metadata.file_size") <= split)
    return scan_split(spark, path, schema, options, above=split).union(small)


def _ddl(schema: str) -> str:
    fields = T.StructType.fromDDL(schema).fields
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
