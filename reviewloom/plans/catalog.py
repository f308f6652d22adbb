"""Every registered query with the SQL it is checked against.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
File queries write a view to a new scratch path and read it back, so their SQL
is the view itself as the scan should see it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import gates, text
from reviewloom.functions.labels import sentiment
from reviewloom.operators import counts, dedup, keysplit, shifted
from reviewloom.operators.explode import explode_merged
from reviewloom.plans import layers, views
from reviewloom.plans.views import (
    CORRUPT_IDS,
    CORRUPT_IDS_SQL,
    MERGED_SQL,
    REVIEW_FILE_SQL,
    REVIEWS_SQL,
)
from reviewloom.sources import csv, multiline, sinks
from reviewloom.sources.schema import REVIEW_COLUMNS, REVIEW_SCHEMA
from reviewloom.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        CATALOG[name] = Entry(run, sql)
        return run

    return add


# --- SQL pieces ----------------------------------------------------------

REVIEW_COLUMNS_SQL = "doc_id, product_id, user_id, review_content, rating"


def _sql_sub(expr: str, pattern: str, replacement: str = " ") -> str:
    return f"regexp_replace({expr}, '{pattern}', '{replacement}', 'g')"


# Fixed values in the next functions: band edges, patterns, placeholders.


def _sql_label(rating: str) -> str:
    return (
        f"CASE WHEN {rating} IS NULL THEN 'unknown' "
        f"WHEN {rating} >= 1.0 AND {rating} < 3.0 THEN 'negative' "
        f"WHEN {rating} >= 3.0 AND {rating} < 4.0 THEN 'neutral' "
        f"WHEN {rating} >= 4.0 THEN 'positive' END"
    )


def _sql_fold(expr: str) -> str:
    return _sql_sub(f"strip_accents({expr})", r"[^\x00-\x7F]+", "")


def _sql_clean(expr: str) -> str:
    expr = _sql_sub(_sql_fold(expr), r"<[^\n]*?>")
    expr = _sql_sub(expr, r"http[^\s\x0B\x1C-\x1F]+|www\.[^\s\x0B\x1C-\x1F]+")
    expr = _sql_sub(expr, "([a-z])([A-Z])", r"\1. \2")
    expr = _sql_sub(expr, "[^a-zA-Z]", " ")
    expr = _sql_sub(expr, r"\b[a-zA-Z]\b")
    expr = _sql_sub(_sql_sub(expr, " +"), "x{3,}")
    return f"lower(trim({_sql_sub(expr, ' +')}))"


def _sql_one_line(expr: str) -> str:
    return f"trim({_sql_sub(expr, r'[\s\x0B\x1C-\x1F]+')})"


def _sql_gate(expr: str) -> str:
    return (
        f"{expr} IS NOT NULL AND length(trim({expr})) > 0 "
        f"AND lower(trim({expr})) NOT IN ('null', 'none', 'nan', 'n/a')"
    )


def _sql_gold(filtered: bool) -> str:
    keep = f"WHERE product_id NOT IN {CORRUPT_IDS_SQL}" if filtered else ""
    return f"""{REVIEWS_SQL},
bodies AS (
  SELECT {_sql_clean('review_content')} AS review_body, rating FROM reviews {keep}),
best AS (
  SELECT review_body, max(rating) AS rating FROM bodies
  WHERE {_sql_gate('review_body')} GROUP BY review_body),
gold AS (SELECT review_body, {_sql_label('rating')} AS sentiment FROM best)"""


# --- Scans ---------------------------------------------------------------


def _one_line(df: DataFrame) -> DataFrame:
    content = text.collapse_whitespace(F.col("review_content"))
    return df.withColumn("review_content", content)


@query(
    "scan_csv_strings",
    f"""WITH {REVIEWS_SQL}
SELECT CAST(doc_id AS VARCHAR) AS doc_id, product_id, user_id,
  nullif({_sql_one_line('review_content')}, '') AS review_content,
  CAST(rating AS VARCHAR) AS rating
FROM reviews""",
)
def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv_strings")
    sinks.write_plain_csv(_one_line(views.reviews(spark, sf_dir)), path)
    return csv.scan_strings(spark, path)


@query(
    "scan_csv_messy",
    f"""WITH {REVIEWS_SQL}
SELECT CAST(doc_id AS VARCHAR) AS doc_id, product_id, user_id,
  CASE WHEN regexp_matches(review_content, '[,"\\n\\r]') THEN review_content
       ELSE nullif(trim(review_content), '') END AS review_content,
  CAST(rating AS VARCHAR) AS rating
FROM reviews""",
)
def scan_csv_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv_messy")
    padded = views.reviews(spark, sf_dir).withColumns(
        {
            "product_id": F.concat(F.lit("  "), "product_id", F.lit(" ")),
            "rating": F.concat(F.lit(" "), F.col("rating").cast("string"), F.lit("  ")),
        }
    )
    sinks.write_csv(padded, path, null_value="")
    return csv.scan_messy(spark, path)


NARROW_SCHEMA = (
    "doc_id bigint, product_id string, user_id string, review_content string, rating double"
)


@query(
    "scan_csv_schema",
    f"""WITH {REVIEWS_SQL}
SELECT doc_id, product_id, user_id,
  nullif({_sql_one_line('review_content')}, '') AS review_content, rating
FROM reviews""",
)
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv_schema")
    sinks.write_plain_csv(_one_line(views.reviews(spark, sf_dir)), path)
    return csv.scan_schema(spark, path, NARROW_SCHEMA)


@query("scan_csv_schema_multiline", f"WITH {REVIEW_FILE_SQL} SELECT * FROM review_file")
def scan_csv_schema_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv_schema_multiline")
    sinks.write_csv(views.review_file(spark, sf_dir), path, null_value="")
    return csv.scan_schema(spark, path, multi_line=True)


@query("scan_csv_multiline_split", CATALOG["scan_csv_schema_multiline"].sql)
def scan_csv_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, every file read by as many tasks as it has splits."""
    path = scratch_path(spark, "scan_csv_multiline_split")
    sinks.write_csv(views.review_file(spark, sf_dir), path, null_value="")
    options = {**csv.QUOTING, "mode": "PERMISSIVE"}
    return multiline.scan_split(spark, path, REVIEW_SCHEMA, options)


@query(
    "scan_csv_dir",
    f"""WITH {REVIEW_FILE_SQL}
SELECT * REPLACE (nullif({_sql_one_line('review_content')}, '') AS review_content)
FROM review_file""",
)
def scan_csv_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv_dir")
    sinks.write_plain_csv(_one_line(views.review_file(spark, sf_dir)), path)
    return csv.scan_schema(spark, path)


_RATING_TEXT_SQL = """CASE WHEN doc_id % 13 = 3 THEN '|' WHEN doc_id % 13 = 4 THEN 'n.a.'
  ELSE CAST(rating AS {string}) END AS rating_text"""


@query(
    "parse_rating",
    f"""WITH {REVIEWS_SQL},
t AS (SELECT doc_id, {_RATING_TEXT_SQL.format(string='VARCHAR')} FROM reviews)
SELECT doc_id, rating_text, TRY_CAST(rating_text AS DOUBLE) AS rating FROM t""",
)
def parse_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.reviews(spark, sf_dir).selectExpr(
        "doc_id", _RATING_TEXT_SQL.format(string="string")
    )
    return rows.withColumn("rating", csv.parse_rating(F.col("rating_text")))


@query(
    "split_corrupt_rows",
    f"""WITH {REVIEWS_SQL}
SELECT doc_id,
  CASE WHEN doc_id % 13 = 1 THEN 'short' ELSE review_content END AS body,
  CASE WHEN doc_id % 13 IN (1, 3) THEN NULL WHEN doc_id % 13 = 2 THEN CAST(3.0 AS DOUBLE)
    ELSE rating END AS rating,
  CASE WHEN doc_id % 13 IN (1, 2) THEN 'arity' WHEN doc_id % 13 = 3 THEN 'rating'
    END AS reason
FROM reviews""",
)
def split_corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("doc_id", "body", "rating", "reason")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with missing fields, extra fields and ratings that are no number."""
    path = scratch_path(spark, "split_corrupt_rows")
    body = r"""coalesce('"' || replace(review_content, '"', '""') || '"', '')"""
    views.reviews(spark, sf_dir).selectExpr(
        f"""CASE doc_id % 13
              WHEN 1 THEN doc_id || ',short'
              WHEN 2 THEN doc_id || ',' || {body} || ',3.0,extra'
              WHEN 3 THEN doc_id || ',' || {body} || ',|'
              ELSE doc_id || ',' || {body} || ',' || coalesce(string(rating), '')
            END AS value"""
    ).write.text(path)
    flagged = csv.scan_flagged(spark, path, ["doc_id", "body", "rating"], header=False)
    return flagged.withColumn("doc_id", F.col("doc_id").cast("bigint"))


_SPLIT_CORRUPT_SQL = CATALOG["split_corrupt_rows"].sql


@query(
    "split_corrupt_written",
    f"""SELECT *, CASE WHEN reason IS NULL THEN 'kept' ELSE 'corrupt' END AS side
FROM ({_SPLIT_CORRUPT_SQL})""",
)
def split_corrupt_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves, written in one pass over the source and read back one by one."""
    path = scratch_path(spark, "split_corrupt_written")
    split = keysplit.split_by_reason(_flagged(spark, sf_dir))
    sinks.write_split(split, path, "parquet")
    schema = "doc_id bigint, body string, rating double, reason string"
    kept, corrupt = (
        csv.scan_side(spark, path, side, schema, "parquet").withColumn("side", F.lit(side))
        for side in (keysplit.KEPT, keysplit.CORRUPT)
    )
    return kept.union(corrupt)


@query(
    "find_shifted_rows",
    f"""WITH {REVIEWS_SQL},
twice AS (
  SELECT doc_id, CASE WHEN copy = 0 THEN 0 WHEN (doc_id // 11) % 31 < 16
    THEN (doc_id // 11) % 31 + 1 ELSE 15 - (doc_id // 11) % 31 END AS moved
  FROM reviews JOIN (SELECT unnest([0, 1]) AS copy) ON copy = 0 OR doc_id % 11 = 5)
SELECT doc_id, CAST(moved AS INTEGER) AS moved, moved <> 0 AS shifted FROM twice""",
)
def find_shifted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sound files look like finds the rows of another whose values have moved."""
    evidence = shifted.learn(views.review_file(spark, sf_dir), REVIEW_COLUMNS)
    found = shifted.with_shift(views.shifted_reviews(spark, sf_dir), evidence)
    return found.select("doc_id", "moved", F.col("shift_start").isNotNull().alias("shifted"))


# --- Sinks ---------------------------------------------------------------


@query("sink_csv_roundtrip", f"WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sink_csv_roundtrip")
    sinks.write_csv(views.reviews(spark, sf_dir), path)
    return csv.scan_lossless(spark, path, NARROW_SCHEMA)


@query("sink_csv_sized", CATALOG["sink_csv_roundtrip"].sql)
def sink_csv_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, in files bounded in bytes."""
    path = scratch_path(spark, "sink_csv_sized")
    sinks.write_csv(views.reviews(spark, sf_dir), path, file_bytes=32 << 20)
    return csv.scan_lossless(spark, path, NARROW_SCHEMA)


def _written_side(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    path = scratch_path(spark, f"sink_{side}")
    split = keysplit.with_split(views.reviews(spark, sf_dir), "product_id", CORRUPT_IDS)
    sinks.write_split(split, path)
    return csv.scan_side(spark, path, side, NARROW_SCHEMA)


@query(
    "sink_quarantine",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE product_id IN {CORRUPT_IDS_SQL}""",
)
def sink_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_side(spark, sf_dir, keysplit.QUARANTINE)


@query(
    "sink_kept",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE product_id NOT IN {CORRUPT_IDS_SQL}""",
)
def sink_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_side(spark, sf_dir, keysplit.KEPT)


@query(
    "sink_single_file",
    f"""WITH {_sql_gold(True)}
SELECT sentiment, count(*) AS reviews FROM gold GROUP BY sentiment""",
)
def sink_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sink_single_file")
    report = sentiment_counts(spark, sf_dir)
    sinks.write_report(report, path)
    return csv.scan_lossless(spark, path, "sentiment string, reviews bigint")


@query("publish_gold", f"WITH {_sql_gold(True)} SELECT review_body, sentiment FROM gold")
def publish_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "training_dataset")
    sinks.publish(gold_training_set(spark, sf_dir), path)
    table = sinks.current(spark, path)
    return csv.scan_lossless(spark, table, layers.GOLD_SCHEMA, multi_line=False)


# --- Projections ---------------------------------------------------------


@query(
    "project_replace",
    f"""WITH {REVIEWS_SQL}
SELECT doc_id, product_id, user_id, lower(trim(review_content)) AS review_content, rating
FROM reviews""",
)
def project_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reviews(spark, sf_dir).withColumn(
        "review_content", text.lower_trim(F.col("review_content"))
    )


@query(
    "project_rename",
    f"""WITH {REVIEWS_SQL}
SELECT doc_id, product_id, user_id, review_content AS review_body, rating FROM reviews""",
)
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reviews(spark, sf_dir).withColumnRenamed("review_content", "review_body")


@query(
    "project_select",
    f"""WITH {REVIEWS_SQL}
SELECT review_content AS review_body, {_sql_label('rating')} AS sentiment FROM reviews""",
)
def project_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reviews(spark, sf_dir).select(
        F.col("review_content").alias("review_body"), sentiment("rating").alias("sentiment")
    )


# --- Filters and gates ---------------------------------------------------


@query(
    "filter_in_list",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE product_id IN {CORRUPT_IDS_SQL}""",
)
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keysplit.keep_listed(views.reviews(spark, sf_dir), "product_id", CORRUPT_IDS)


@query(
    "filter_not_in_list",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE product_id NOT IN {CORRUPT_IDS_SQL}""",
)
def filter_not_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keysplit.drop_listed(views.reviews(spark, sf_dir), "product_id", CORRUPT_IDS)


@query(
    "filter_not_in_list_keep_null",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE product_id IS NULL OR product_id NOT IN {CORRUPT_IDS_SQL}""",
)
def filter_not_in_list_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keysplit.drop_listed(
        views.reviews(spark, sf_dir), "product_id", CORRUPT_IDS, null_key="keep"
    )


@query(
    "quarantine_semi",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def quarantine_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.toxic_documents(spark, sf_dir)
    return keysplit.keep_matching(views.reviews(spark, sf_dir), keys, "doc_id")


@query(
    "keep_anti",
    f"""WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def keep_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.toxic_documents(spark, sf_dir)
    return keysplit.drop_matching(views.reviews(spark, sf_dir), keys, "doc_id")


@query("quarantine_semi_salted", CATALOG["quarantine_semi"].sql)
def quarantine_semi_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.toxic_documents(spark, sf_dir)
    return keysplit.keep_matching(views.reviews(spark, sf_dir), keys, "doc_id", salts=8)


@query("keep_anti_salted", CATALOG["keep_anti"].sql)
def keep_anti_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.toxic_documents(spark, sf_dir)
    return keysplit.drop_matching(views.reviews(spark, sf_dir), keys, "doc_id", salts=8)


_DOC_KEY = "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id END AS doc_key"


@query(
    "quarantine_semi_hot",
    f"""WITH {REVIEWS_SQL}
SELECT {REVIEW_COLUMNS_SQL} FROM reviews
WHERE user_id IN (SELECT lang FROM documents WHERE source IN ('src1', 'src2'))""",
)
def quarantine_semi_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only keys that hold a tenth of the rows or more are spread."""
    rows = views.reviews(spark, sf_dir)
    docs = views.table(spark, sf_dir, "documents").where("source IN ('src1', 'src2')")
    hot = keysplit.hot_keys(rows, "user_id", 0.1)
    return keysplit.keep_matching(
        rows, docs.select(F.col("lang").alias("user_id")), "user_id", salts=8, hot=hot
    )


@query(
    "keep_anti_keep_null",
    f"""WITH {REVIEWS_SQL}, keyed AS (SELECT *, {_DOC_KEY} FROM reviews)
SELECT {REVIEW_COLUMNS_SQL}, doc_key FROM keyed
WHERE doc_key IS NULL OR doc_key NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def keep_anti_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows has no key and stays."""
    keys = views.toxic_documents(spark, sf_dir).withColumnRenamed("doc_id", "doc_key")
    rows = views.reviews(spark, sf_dir).selectExpr("*", _DOC_KEY)
    return keysplit.drop_matching(rows, keys, "doc_key", null_key="keep")


@query(
    "split_by_key_table",
    f"""WITH {REVIEWS_SQL}, keyed AS (SELECT *, {_DOC_KEY} FROM reviews)
SELECT {REVIEW_COLUMNS_SQL}, doc_key, CASE WHEN doc_key IN (
    SELECT doc_id FROM labels WHERE toxic = 1) THEN 'quarantine' ELSE 'kept' END AS split
FROM keyed""",
)
def split_by_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.toxic_documents(spark, sf_dir).withColumnRenamed("doc_id", "doc_key")
    rows = views.reviews(spark, sf_dir).selectExpr("*", _DOC_KEY)
    return keysplit.with_split(rows, "doc_key", keys, null_key="keep", salts=4)


def _register_gate(name: str, predicate: Callable[[Column], Column], condition: str) -> None:
    @query(
        name,
        f"WITH {REVIEWS_SQL} SELECT {REVIEW_COLUMNS_SQL} FROM reviews WHERE {condition}",
    )
    def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
        return views.reviews(spark, sf_dir).where(predicate(F.col("review_content")))


_register_gate("gate_not_null", gates.is_present, "review_content IS NOT NULL")
_register_gate("gate_not_blank", gates.is_not_blank, "length(trim(review_content)) > 0")
_register_gate(
    "gate_placeholder",
    gates.is_not_placeholder,
    "lower(trim(review_content)) NOT IN ('null', 'none', 'nan', 'n/a')",
)
_register_gate("gate_quality", gates.passes_quality, _sql_gate("review_content"))


# --- Labels --------------------------------------------------------------


@query(
    "label_sentiment",
    f"""SELECT l_orderkey, l_linenumber, l_quantity / 10 AS rating,
  {_sql_label('(l_quantity / 10)')} AS sentiment
FROM lineitem""",
)
def label_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 10).alias("rating")
    )
    return rows.withColumn("sentiment", sentiment("rating"))


_EDGE_RATING_SQL = """CASE l_linenumber
  WHEN 1 THEN NULL
  WHEN 2 THEN CAST('NaN' AS DOUBLE)
  WHEN 3 THEN -l_quantity
  WHEN 4 THEN l_discount
  WHEN 5 THEN l_quantity
  WHEN 6 THEN CAST(floor(l_quantity / 10) AS DOUBLE)
  ELSE l_quantity / 10 END"""


@query(
    "label_edges",
    f"""WITH e AS (SELECT l_linenumber, {_EDGE_RATING_SQL} AS rating FROM lineitem)
SELECT l_linenumber, {_sql_label('rating')} AS sentiment, count(*) AS reviews
FROM e GROUP BY ALL""",
)
def label_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, NaN, negative, tiny, too large and exact-boundary ratings."""
    rows = views.table(spark, sf_dir, "lineitem").selectExpr(
        "l_linenumber", f"{_EDGE_RATING_SQL} AS rating"
    )
    return (
        rows.groupBy("l_linenumber", sentiment("rating").alias("sentiment"))
        .agg(F.count("*").alias("reviews"))
    )


# --- Deduplication -------------------------------------------------------


@query(
    "dedup_four_key",
    f"""WITH {REVIEWS_SQL}
SELECT DISTINCT user_id, product_id, review_content, rating FROM reviews""",
)
def dedup_four_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_on(views.reviews(spark, sf_dir))


@query(
    "dedup_three_key",
    f"""WITH {REVIEWS_SQL}
SELECT user_id, product_id, review_content, max(rating) AS rating
FROM reviews GROUP BY ALL""",
)
def dedup_three_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.best_rating_per(
        views.reviews(spark, sf_dir), ["user_id", "product_id", "review_content"]
    )


@query(
    "dedup_body",
    f"""WITH {REVIEWS_SQL}
SELECT review_content, max(rating) AS rating FROM reviews GROUP BY review_content""",
)
def dedup_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.best_rating_per(views.reviews(spark, sf_dir), ["review_content"])


@query("dedup_body_repeats_first", CATALOG["dedup_body"].sql)
def dedup_body_repeats_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same; texts that occur once are not moved for it."""
    return dedup.best_rating_per(
        views.reviews(spark, sf_dir), ["review_content"], repeats_first=True
    )


@query("dedup_four_key_repeats_first", CATALOG["dedup_four_key"].sql)
def dedup_four_key_repeats_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_on(views.reviews(spark, sf_dir), repeats_first=True)


# --- Text stages ---------------------------------------------------------


def _register_stage(
    name: str,
    stage: Callable[[Column], Column],
    source: str,
    ids: tuple[str, ...],
    column: str,
    expr: str,
) -> None:
    with_views = f"WITH {REVIEWS_SQL}" if source == "reviews" else ""

    @query(name, f"{with_views} SELECT {', '.join(ids)}, {expr} AS cleaned FROM {source}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if source == "reviews":
            rows = views.reviews(spark, sf_dir)
        else:
            rows = views.texts(spark, sf_dir, source, *ids, column)
        return rows.select(*ids, stage(F.col(column)).alias("cleaned"))


_DOCS = ("documents", ("doc_id",), "text")
_PAGES = ("pages", ("page_id",), "html")
_TALKS = ("conversations", ("conv_id", "turn"), "text")
_REVIEWS = ("reviews", ("doc_id", "rating"), "review_content")

_register_stage("clean_ascii_fold", text.ascii_fold, *_DOCS, _sql_fold("text"))
_register_stage("clean_html", text.strip_html, *_PAGES, _sql_sub("html", r"<[^\n]*?>"))
_register_stage(
    "clean_url",
    text.strip_urls,
    *_PAGES,
    _sql_sub("html", r"http[^\s\x0B\x1C-\x1F]+|www\.[^\s\x0B\x1C-\x1F]+"),
)
_register_stage(
    "clean_punct_runs",
    text.strip_punct_runs,
    *_PAGES,
    _sql_sub(_sql_sub("html", "[-_=]{2,}"), r"[.,;:?/\\]{2,}"),
)
_register_stage(
    "clean_hyphens",
    text.strip_hyphens,
    *_PAGES,
    _sql_sub("html", r"[\s\x0B\x1C-\x1F]*-+[\s\x0B\x1C-\x1F]*"),
)
_register_stage("clean_digits", text.strip_digits, *_PAGES, _sql_sub("html", r"\b\d+\b"))
_register_stage(
    "clean_camel", text.split_camel, *_PAGES, _sql_sub("html", "([a-z])([A-Z])", r"\1 \2")
)
_register_stage(
    "clean_non_alpha",
    text.strip_non_alpha,
    *_DOCS,
    _sql_sub("text", r"[^a-zA-Z\s\x0B\x1C-\x1F]"),
)
_register_stage(
    "clean_single_letters",
    text.strip_single_letters,
    *_DOCS,
    _sql_sub("text", r"\b[a-zA-Z]\b"),
)
_register_stage(
    "clean_whitespace", text.collapse_whitespace, *_DOCS, _sql_one_line("text")
)
_CHAR_RUN_SQL = "x{3,}|-{3,}|_{3,}|:{3,}|;{3,}|={3,}|~{3,}"
_register_stage(
    "clean_char_runs", text.strip_char_runs, *_REVIEWS, _sql_sub("review_content", _CHAR_RUN_SQL)
)
_register_stage(
    "clean_char_runs_pages", text.strip_char_runs, *_PAGES, _sql_sub("html", _CHAR_RUN_SQL)
)
_register_stage("clean_lower", text.lower_trim, *_DOCS, "lower(trim(text))")
_register_stage("clean_full", text.clean_review, *_DOCS, _sql_clean("text"))
_register_stage("clean_full_pages", text.clean_review, *_PAGES, _sql_clean("html"))
_register_stage("clean_full_conversations", text.clean_review, *_TALKS, _sql_clean("text"))
_register_stage(
    "clean_full_reviews", text.clean_review, *_REVIEWS, _sql_clean("review_content")
)
_register_stage("clean_full_native", text.clean_review_native, *_DOCS, _sql_clean("text"))


def _stage_by_stage(c: Column) -> Column:
    """The single stages in a row, without those that change nothing in the end."""
    c = text.split_camel(text.strip_urls(text.strip_html(text.ascii_fold(c))))
    c = text.strip_single_letters(text.strip_non_alpha(c))
    c = text.strip_char_runs(text.collapse_whitespace(c))
    return text.lower_trim(text.collapse_whitespace(c))


_register_stage("clean_full_staged", _stage_by_stage, *_PAGES, _sql_clean("html"))


@query(
    "clean_full_sql",
    f"SELECT doc_id, {_sql_clean('text')} AS cleaned FROM documents",
)
def clean_full_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered function, called from SQL text."""
    text.register_functions(spark)
    docs = views.texts(spark, sf_dir, "documents", "doc_id", "text")
    return spark.sql("SELECT doc_id, clean_review(text) AS cleaned FROM {docs}", docs=docs)


@query(
    "clean_sql_aggregate",
    f"""SELECT count(DISTINCT {_sql_clean('text')}) AS bodies,
  max(length({_sql_clean('text')})) AS longest FROM documents""",
)
def clean_sql_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    text.register_functions(spark)
    docs = views.table(spark, sf_dir, "documents")
    return spark.sql(
        """SELECT count(DISTINCT clean_review(text)) AS bodies,
             CAST(max(length(clean_review(text))) AS bigint) AS longest FROM {docs}""",
        docs=docs,
    )


@query(
    "clean_sql_join",
    f"""WITH cleaned AS (SELECT doc_id, {_sql_clean('text')} AS body FROM documents),
firsts AS (SELECT body, min(doc_id) AS first_id FROM cleaned GROUP BY body)
SELECT doc_id, first_id FROM cleaned JOIN firsts USING (body)""",
)
def clean_sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and the first one with the same cleaned text."""
    text.register_functions(spark)
    docs = views.table(spark, sf_dir, "documents")
    return spark.sql(
        # Digests of cleaned texts meet, not the texts.
        """WITH keys AS (SELECT doc_id, unhex(sha2(clean_review(text), 256)) AS body FROM {docs}),
           firsts AS (SELECT body, min(doc_id) AS first_id FROM keys GROUP BY body)
           SELECT doc_id, first_id FROM keys JOIN firsts USING (body)""",
        docs=docs,
    )


@query(
    "repair_mojibake",
    "SELECT doc_id, '₹' || n_chars || ' ' || text || ' ₹' AS repaired FROM documents",
)
def repair_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.concat(F.lit("â‚¹"), "n_chars", F.lit(" "), "text", F.lit(" â‚¹"))
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.repair_mojibake(broken).alias("repaired"))


@query(
    "explode_merged",
    f"""WITH {MERGED_SQL},
lists AS (
  SELECT doc_id, review_content, shape,
    string_split(review_content, chr(10)) AS a, string_split(shape, chr(10)) AS b
  FROM merged),
flagged AS (SELECT *, coalesce(len(a) = len(b), false) AS aligned FROM lists),
items AS (
  SELECT doc_id, unnest(a) AS review_content, unnest(b) AS shape,
    unnest(range(len(a))) AS item
  FROM flagged WHERE aligned)
SELECT doc_id, CAST(item AS INTEGER) AS item, review_content, shape, true AS aligned
FROM items
UNION ALL
SELECT doc_id, NULL, review_content, shape, false FROM flagged WHERE NOT aligned""",
)
def explode_merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_merged(views.merged(spark, sf_dir), ["review_content", "shape"], "\n")


@query(
    "explode_merged_text",
    r"""SELECT doc_id // 8 AS row_id, CAST(doc_id AS VARCHAR) AS review_id,
  CAST(row_number() OVER (PARTITION BY doc_id // 8 ORDER BY doc_id) - 1 AS INTEGER) AS item,
  'Document ' || doc_id || ': ' || regexp_replace(text, ',([^ \t\n\r\f\v])', ', \1', 'g')
    AS review_content, true AS aligned
FROM documents WHERE text IS NOT NULL""",
)
def explode_merged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with commas inside, merged by commas: as many as there are ids come out."""
    rows = views.merged_reviews(spark, sf_dir)
    found = explode_merged(rows, ["review_id", "review_content"], ",", "review_content")
    return found.drop("alignment")


# --- Reports -------------------------------------------------------------


@query(
    "sentiment_counts",
    f"""WITH {_sql_gold(True)}
SELECT sentiment, count(*) AS reviews FROM gold GROUP BY sentiment""",
)
def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, ratings = views.review_texts(spark, sf_dir), views.ratings(spark, sf_dir)
    return layers.gold_counts(texts, CORRUPT_IDS, ratings=ratings)


@query(
    "sentiment_counts_lineitem",
    f"""SELECT {_sql_label('(l_quantity / 10)')} AS sentiment, count(*) AS reviews
FROM lineitem GROUP BY ALL""",
)
def sentiment_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.col("l_quantity") / 10
    lineitem = views.table(spark, sf_dir, "lineitem")
    return counts.sentiment_counts(lineitem.select(sentiment(rating).alias("sentiment")))


@query(
    "sentiment_balance",
    f"""WITH {_sql_gold(True)},
c AS (SELECT sentiment, count(*) AS reviews FROM gold GROUP BY sentiment)
SELECT sentiment, reviews,
  CAST(reviews AS DOUBLE) / CAST((SELECT sum(reviews) FROM c) AS DOUBLE) AS share
FROM c""",
)
def sentiment_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.sentiment_balance(sentiment_counts(spark, sf_dir))


@query(
    "split_counts",
    f"""WITH {REVIEWS_SQL}
SELECT count(*) FILTER (product_id IN {CORRUPT_IDS_SQL}) AS quarantined,
  count(*) FILTER (product_id NOT IN {CORRUPT_IDS_SQL}) AS kept,
  count(*) FILTER (product_id IS NULL) AS no_key
FROM reviews""",
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.split_counts(views.reviews(spark, sf_dir), "product_id", CORRUPT_IDS)


# --- Whole flows ---------------------------------------------------------


@query(
    "silver_reviews",
    f"""WITH {REVIEWS_SQL},
s AS (SELECT user_id, product_id, {_sql_clean('review_content')} AS review_content, rating
  FROM reviews WHERE product_id NOT IN {CORRUPT_IDS_SQL})
SELECT DISTINCT user_id, product_id, review_content, rating
FROM s WHERE {_sql_gate('review_content')}""",
)
def silver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, ratings = views.review_texts(spark, sf_dir), views.ratings(spark, sf_dir)
    return layers.silver(texts, CORRUPT_IDS, ratings=ratings)


@query("gold_training_set", f"WITH {_sql_gold(True)} SELECT review_body, sentiment FROM gold")
def gold_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, ratings = views.review_texts(spark, sf_dir), views.ratings(spark, sf_dir)
    return layers.gold(texts, CORRUPT_IDS, ratings=ratings)


@query(
    "gold_training_set_unfiltered",
    f"WITH {_sql_gold(False)} SELECT review_body, sentiment FROM gold",
)
def gold_training_set_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, ratings = views.review_texts(spark, sf_dir), views.ratings(spark, sf_dir)
    return layers.gold(texts, ratings=ratings)


def _published(
    spark: SparkSession, sf_dir: str, ids: list[str], null_key: str, fmt: str
) -> str:
    """Run both scheduled steps from a sixteen-column CSV source; the gold path."""
    source, silver, gold = (scratch_path(spark, n) for n in ("source", "silver", "gold"))
    sinks.write_csv(views.review_file(spark, sf_dir), source, null_value="")
    layers.bronze_to_silver(spark, source, silver, ids, null_key)
    layers.silver_to_gold(spark, silver, gold, fmt)
    return gold


def _training_set(spark: SparkSession, gold: str) -> str:
    return sinks.current(spark, f"{gold}/training_dataset")


@query("files_to_gold", f"WITH {_sql_gold(True)} SELECT review_body, sentiment FROM gold")
def files_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _published(spark, sf_dir, CORRUPT_IDS, "drop", "csv")
    table = _training_set(spark, gold)
    return csv.scan_lossless(spark, table, layers.GOLD_SCHEMA, multi_line=False)


@query("files_to_gold_padded", f"WITH {_sql_gold(True)} SELECT review_body, sentiment FROM gold")
def files_to_gold_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a file with padded ids, and quoted texts after a space, by the key filter."""
    source, silver, gold = (scratch_path(spark, n) for n in ("source", "silver", "gold"))
    rows = views.review_file(spark, sf_dir)
    quoted = {c: F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')) for c in rows.columns}
    cells = [
        F.coalesce(F.concat(F.lit('  "'), q, F.lit('"')), F.lit("  "))
        if c != "product_id" else F.concat(F.lit("  "), F.coalesce(c, F.lit("")), F.lit(" "))
        for c, q in quoted.items()
    ]
    lines = rows.select(F.concat_ws(",", *cells).alias("value"))
    lines.write.text(source)
    layers.bronze_to_silver(spark, source, silver, CORRUPT_IDS, header=False)
    layers.silver_to_gold(spark, silver, gold)
    table = _training_set(spark, gold)
    return csv.scan_lossless(spark, table, layers.GOLD_SCHEMA, multi_line=False)


@query(
    "files_to_gold_unfiltered",
    f"WITH {_sql_gold(False)} SELECT review_body, sentiment FROM gold",
)
def files_to_gold_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _published(spark, sf_dir, [], "keep", "parquet")
    return spark.read.parquet(_training_set(spark, gold))


@query(
    "files_to_report",
    f"""WITH {_sql_gold(True)}
SELECT sentiment, count(*) AS reviews FROM gold GROUP BY sentiment""",
)
def files_to_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _published(spark, sf_dir, CORRUPT_IDS, "drop", "parquet")
    return csv.scan_lossless(
        spark, f"{gold}/sentiment_counts", "sentiment string, reviews bigint"
    )
