"""Review-shaped inputs derived from the given tables.

Each view covers its whole source table. The matching ``*_SQL`` text is the
same view for the SQL checks, written apart from the DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Products taken as corrupt in the derived reviews.
CORRUPT_IDS = ["P1", "P4"]
CORRUPT_IDS_SQL = "('P1', 'P4')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, name).select(*columns)


def review_texts(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Every document as a review without its rating, every tenth twice.

    Faults are extra rows: copies 2 of some documents have a missing, blank,
    placeholder or decorated text. One scan; copies come from an explode.
    """
    copies = """explode(array_compact(array(0, IF(doc_id % 10 = 0, 1, NULL),
      IF(doc_id % 50 BETWEEN 7 AND 13, 2, NULL)))) AS copy"""
    docs = table(spark, sf_dir, "documents")
    return docs.selectExpr("doc_id", "lang", "text", *extra, copies).selectExpr(
        "doc_id",
        "CASE WHEN doc_id % 41 = 3 THEN NULL ELSE 'P' || (doc_id % 7) END AS product_id",
        "lang AS user_id",
        """CASE WHEN copy < 2 THEN text ELSE CASE doc_id % 50
             WHEN 7 THEN NULL
             WHEN 8 THEN '   '
             WHEN 9 THEN 'N/A'
             WHEN 10 THEN ' None '
             WHEN 11 THEN '12345'
             WHEN 12 THEN 'fooXXX axxxb ' || text
             ELSE '<p>helloWorld</p> http://example.com/x ' || text END END AS review_content""",
        *extra,
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, rating``: a narrow table of its own."""
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id",
        """CASE WHEN quality IS NULL THEN NULL
             WHEN doc_id % 29 = 5 THEN 7.0D
             WHEN quality = 1 AND toxic = 0 THEN 4.5D
             WHEN quality = 1 THEN 3.5D
             WHEN toxic = 0 THEN 2.0D
             ELSE 0.5D END AS rating""",
    )


def reviews(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """``review_texts`` with their ratings."""
    rated = review_texts(spark, sf_dir, *extra).join(ratings(spark, sf_dir), "doc_id", "left")
    return rated.select("doc_id", "product_id", "user_id", "review_content", "rating", *extra)


REVIEWS_SQL = """
base AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, d.text, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
copies AS (SELECT * FROM (VALUES (0), (1), (2)) AS v(copy)),
reviews AS (
  SELECT doc_id,
    CASE WHEN doc_id % 41 = 3 THEN NULL ELSE concat('P', doc_id % 7) END AS product_id,
    lang AS user_id,
    CASE WHEN copy < 2 THEN text ELSE CASE doc_id % 50
      WHEN 7 THEN NULL WHEN 8 THEN '   ' WHEN 9 THEN 'N/A'
      WHEN 10 THEN ' None ' WHEN 11 THEN '12345'
      WHEN 12 THEN concat('fooXXX axxxb ', text)
      ELSE concat('<p>helloWorld</p> http://example.com/x ', text) END END AS review_content,
    CAST(CASE WHEN quality IS NULL THEN NULL WHEN doc_id % 29 = 5 THEN 7.0
      WHEN quality = 1 AND toxic = 0 THEN 4.5 WHEN quality = 1 THEN 3.5
      WHEN toxic = 0 THEN 2.0 ELSE 0.5 END AS DOUBLE) AS rating,
    source, n_chars
  FROM base JOIN copies ON copy = 0 OR (copy = 1 AND doc_id % 10 = 0)
    OR (copy = 2 AND doc_id % 50 BETWEEN 7 AND 13))"""


def review_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived reviews in the full sixteen-column review schema."""
    return reviews(spark, sf_dir, "source", "n_chars").selectExpr(
        "product_id",
        "'item ' || doc_id AS product_name",
        "source AS category",
        "'₹' || n_chars AS discounted_price",
        "'₹' || (2 * n_chars) AS actual_price",
        "'50%' AS discount_percentage",
        "rating",
        "CAST(n_chars AS string) AS rating_count",
        """'about, "' || source || '"' AS about_product""",
        "user_id",
        "'user ' || user_id AS user_name",
        "'R' || doc_id AS review_id",
        "source || ' / ' || user_id AS review_title",
        "review_content",
        "'https://img.example/' || doc_id AS img_link",
        "'https://shop.example/' || product_id AS product_link",
    )


REVIEW_FILE_SQL = (
    REVIEWS_SQL
    + """,
review_file AS (
  SELECT product_id,
    'item ' || doc_id AS product_name,
    source AS category,
    '₹' || n_chars AS discounted_price,
    '₹' || (2 * n_chars) AS actual_price,
    '50%' AS discount_percentage,
    rating,
    CAST(n_chars AS VARCHAR) AS rating_count,
    'about, "' || source || '"' AS about_product,
    user_id,
    'user ' || user_id AS user_name,
    'R' || doc_id AS review_id,
    source || ' / ' || user_id AS review_title,
    review_content,
    'https://img.example/' || doc_id AS img_link,
    'https://shop.example/' || product_id AS product_link
  FROM reviews)"""
)


def shifted_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review file as strings, and copies of every eleventh row whose values moved by
    one column: ``moved`` is the first one, from 1, negative if they moved to the left,
    else 0. All columns and both ways come up in turn."""
    names = review_file(spark, sf_dir).columns
    cells = [f"coalesce(string({c}), '')" for c in names]
    rows = review_file(spark, sf_dir).selectExpr(
        "review_id", "CAST(substr(review_id, 2) AS bigint) AS doc_id",
        f"array({', '.join(cells)}) AS cells",
    )
    last = len(names)
    start = f"(doc_id DIV 11) % {2 * last - 1}"
    moved = f"""CASE WHEN copy = 0 THEN 0 WHEN {start} < {last} THEN {start} + 1
      ELSE {last - 1} - {start} END"""
    copies = rows.selectExpr("*", "explode(IF(doc_id % 11 = 5, array(0, 1), array(0))) AS copy")
    copies = copies.selectExpr("doc_id", "cells", f"CAST({moved} AS int) AS moved")
    values = f"""CASE WHEN moved > 0 THEN concat(slice(cells, 1, moved - 1), array(' and, so on'),
        slice(cells, moved, {last} - moved))
      WHEN moved < 0 THEN concat(slice(cells, 1, -moved - 1), slice(cells, 1 - moved, {last}),
        array(''))
      ELSE cells END"""
    copies = copies.selectExpr("doc_id", "moved", f"{values} AS cells")
    return copies.selectExpr(
        "doc_id", "moved", *[f"nullif(cells[{i}], '') AS {c}" for i, c in enumerate(names)]
    )


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key table that grows with the data: ids of documents labelled toxic."""
    return table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews whose lines are merged in one field, with a parallel list.

    ``shape`` has one entry per line, but one too many where the length of the
    document is a multiple of five; missing reviews stay missing.
    """
    extra_line = F.when(F.col("n_chars") % 5 == 0, "\n").otherwise("")
    shape = F.regexp_replace("review_content", r"[^\n ]+", "w")
    return review_texts(spark, sf_dir, "n_chars").select(
        "doc_id", "review_content", F.concat(shape, extra_line).alias("shape")
    )


def merged_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of eight neighbouring ids in one row: lists of ids and of texts, joined by
    commas. Texts hold commas of their own, each with a space behind it."""
    text = r"""concat('Document ', doc_id, ': ', regexp_replace(text, ',(?=\\S)', ', '))"""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    rows = docs.selectExpr("doc_id DIV 8 AS row_id", f"struct(doc_id, {text} AS text) AS doc")
    lists = rows.groupBy("row_id").agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    return lists.selectExpr(
        "row_id",
        "array_join(transform(docs, d -> string(d.doc_id)), ',') AS review_id",
        "array_join(docs.text, ',') AS review_content",
    )


MERGED_SQL = (
    REVIEWS_SQL
    + r""",
merged AS (
  SELECT doc_id, review_content,
    regexp_replace(review_content, '[^\n ]+', 'w', 'g')
      || CASE WHEN n_chars % 5 = 0 THEN chr(10) ELSE '' END AS shape
  FROM reviews)"""
)
