"""Every registered query against DuckDB, plus the shape of the main plans."""

import os

import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as contract
from reviewloom.functions.gates import passes_quality
from reviewloom.functions.text import clean_review
from reviewloom.plans import layers, views
from reviewloom.plans.catalog import CATALOG

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_sql(spark, con, name):
    assert difference(CATALOG[name].run(spark, SF_DIR), con, CATALOG[name].sql) is None


def test_contract(spark):
    assert set(CATALOG) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["review_body", "sentiment"]


# Known values of the derived reviews, computed in DuckDB.
KNOWN = {
    "sf0.001": (248, 5, 4, 160, 145, 140, [7, 4, 49, 79, 1]),
    "sf0.01": (1240, 30, 20, 794, 717, 683, [34, 28, 227, 385, 9]),
}


@pytest.mark.parametrize("sf", sorted(KNOWN))
def test_known_values(spark, sf):
    rows, no_product, no_content, gated, four_key, bodies, labels = KNOWN[sf]
    reviews = views.reviews(spark, f"/root/testdata/{sf}")
    assert reviews.count() == rows
    assert reviews.where("product_id IS NULL").count() == no_product
    assert reviews.where("review_content IS NULL").count() == no_content
    assert layers.cleaned(reviews, views.CORRUPT_IDS).count() == gated
    assert layers.silver(reviews, views.CORRUPT_IDS).count() == four_key
    gold = layers.gold(reviews, views.CORRUPT_IDS)
    assert gold.count() == bodies
    counts = {r.sentiment: r.reviews for r in
              layers.gold_counts(reviews, views.CORRUPT_IDS).collect()}
    names = ["negative", "neutral", "positive", "unknown", None]
    assert [counts[n] for n in names] == labels


def test_gold_does_not_depend_on_partitioning(spark):
    reviews = views.reviews(spark, SF_DIR)
    results = {
        frozenset(map(tuple, layers.gold(reviews.repartition(n)).collect())) for n in (1, 5, 13)
    }
    assert len(results) == 1


def test_gate_and_rejects_make_up_the_input(spark):
    rows = views.reviews(spark, SF_DIR).select(
        clean_review(F.col("review_content")).alias("body")
    )
    keep = F.coalesce(passes_quality(F.col("body")), F.lit(False))
    assert rows.where(keep).count() + rows.where(~keep).count() == rows.count()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables beyond the broadcast threshold."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", ["gold_training_set", "gold_training_set_unfiltered"])
def test_gold_plan(spark, plan, no_broadcast, name):
    text = plan(CATALOG[name].run(spark, SF_DIR))
    # Narrow ratings, cleaned texts to meet them, cleaned bodies: no raw text, no sort.
    assert text.count("hashpartitioning") == text.count("Exchange") == 3
    assert "Sort" not in text and "RoundRobin" not in text and "ShuffledHashJoin" in text
    assert text.count("ArrowEvalPython") == 1
    below = text[text.index("ArrowEvalPython") :]
    assert "hashpartitioning" not in below[: below.index("FileScan")]
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_merged_lists_need_no_ratings(spark, plan):
    assert "labels" not in plan(CATALOG["explode_merged"].run(spark, SF_DIR))


def test_a_filter_given_to_the_cleaner_reaches_the_scan(spark, plan):
    docs = views.table(spark, SF_DIR, "documents").withColumnRenamed("text", "review_content")
    text = plan(layers.cleaned(docs, where="doc_id = 7"))
    assert text.count("ArrowEvalPython") == 1
    assert "EqualTo(doc_id,7)" in text


def test_counts_never_shuffle_text(spark, plan):
    texts, ratings = views.review_texts(spark, SF_DIR), views.ratings(spark, SF_DIR)
    text = plan(layers.gold_counts(texts, views.CORRUPT_IDS, ratings=ratings))
    keys = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert len(keys) == 4
    assert "sentiment" in keys[0] and "digest" in keys[1] and "doc_id" in keys[2] + keys[3]
    # The body is digested before rows meet their ratings.
    assert text.index("ShuffledHashJoin") < text.index("sha2")


def test_no_query_crosses_or_collapses(spark, plan):
    for name, entry in CATALOG.items():
        text = plan(entry.run(spark, SF_DIR))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        # Only the label report, five rows at most, may meet in one partition.
        assert "SinglePartition" not in text or name in (
            "sentiment_balance", "split_counts", "clean_sql_aggregate"
        ), name
