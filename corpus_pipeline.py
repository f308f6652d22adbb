"""Documents to packed token sequences, in five stages.

Every stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``; a changed text brings its
``n_chars`` with it. Rows are told apart by number, so ids may be NULL or repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import decontaminate, lines, packing, quality, simhash
from reviewloom.llm.common import written
from reviewloom.llm.queries import TOKENIZER, table
from reviewloom.llm.tokens import vocabulary_path

A_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]|[A-Z]"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rest_of_row() -> F.Column:
    """All columns but the text, to go through an operator as its id."""
    return F.struct(*[c for c in COLUMNS if c != "text"]).alias("row")


def _with_text(found: DataFrame, text: str) -> DataFrame:
    changed = found.select("row.*", F.col(text).alias("text"))
    return changed.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    judged = quality.judge(
        docs.select(_rest_of_row(), "text", "lang"), id_col="row", with_text=True
    )
    return judged.where("kept").select("doc_id.*", "text").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go; a document stays, with an empty text at worst."""
    found = lines.drop_repeated_lines(docs.select(_rest_of_row(), "text"), id_col="row")
    return _with_text(found.withColumnRenamed("doc_id", "row"), "kept")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays, of equal ids the first row.

    Rows are written with their numbers, which are used twice: a number depends on how
    the scan was split, and that on the cores there are at the time.
    """
    numbered = docs.select(
        *COLUMNS, F.struct("doc_id", F.monotonically_increasing_id().alias("n")).alias("row")
    )
    numbered = written(numbered, "numbered")
    classes = simhash.near_duplicates(numbered, id_col="row")
    kept = classes.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id.n").alias("n")
    )
    return numbered.withColumn("n", F.col("row.n")).join(kept, "n", "left_semi").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document of nothing else goes."""
    found = decontaminate.remove_passages(
        docs.select(_rest_of_row(), "text"), table(spark, sf_dir, "benchmark"), id_col="row"
    )
    found = found.where((F.col("n_removed") == 0) | F.col("text").rlike(A_WORD))
    return _with_text(found.withColumnRenamed("doc_id", "row"), "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4,096 ids, with their ids."""
    return packing.pack_documents(docs, vocabulary_path(TOKENIZER), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

# Tokenizers, SimHash and its components have no SQL form; the tests run the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
