import pytest
from pyspark.sql import functions as F

from reviewloom.functions import gates
from reviewloom.functions.labels import sentiment
from reviewloom.operators import counts, keysplit


@pytest.mark.parametrize(
    "rating, label",
    [
        (None, "unknown"),
        (-1.0, None),
        (0.5, None),
        (1.0, "negative"),
        (1.5, "negative"),
        (2.95, "negative"),
        (3.0, "neutral"),
        (3.5, "neutral"),
        (3.99, "neutral"),
        (4.0, "positive"),
        (4.5, "positive"),
        (7.0, "positive"),
        (float("nan"), "positive"),
    ],
)
def test_sentiment_edges(spark, rating, label):
    df = spark.createDataFrame([(rating,)], "rating double")
    assert df.select(sentiment("rating")).first()[0] == label


def test_sentiment_cut_points_are_parameters(spark):
    df = spark.createDataFrame([(5.0,), (7.0,), (9.0,)], "rating double")
    out = df.select(sentiment("rating", 2.0, 6.0, 8.0)).collect()
    assert [r[0] for r in out] == ["negative", "neutral", "positive"]


@pytest.mark.parametrize(
    "value, present, not_blank, not_placeholder, passes",
    [
        (None, False, None, None, False),
        ("", True, False, True, False),
        ("   ", True, False, True, False),
        ("\t", True, True, True, True),
        (" NuLL ", True, True, False, False),
        ("none", True, True, False, False),
        ("NaN", True, True, False, False),
        ("N/A", True, True, False, False),
        ("nothing", True, True, True, True),
    ],
)
def test_gates(spark, value, present, not_blank, not_placeholder, passes):
    c = F.col("c")
    row = (
        spark.createDataFrame([(value,)], "c string")
        .select(
            gates.is_present(c),
            gates.is_not_blank(c),
            gates.is_not_placeholder(c),
            F.coalesce(gates.passes_quality(c), F.lit(False)),
        )
        .first()
    )
    assert tuple(row) == (present, not_blank, not_placeholder, passes)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [("P1", 1), ("P2", 2), (None, 3), ("P3", 4)], "product_id string, n int"
    )


def numbers(df):
    return sorted(r.n for r in df.collect())


def test_split_by_list(products):
    assert numbers(keysplit.keep_listed(products, "product_id", ["P1", "P1"])) == [1]
    assert numbers(keysplit.drop_listed(products, "product_id", ["P1"])) == [2, 4]
    keep = keysplit.drop_listed(products, "product_id", ["P1"], null_key="keep")
    assert numbers(keep) == [2, 3, 4]


def test_split_by_empty_list(products):
    assert numbers(keysplit.keep_listed(products, "product_id", [])) == []
    assert numbers(keysplit.drop_listed(products, "product_id", [], "keep")) == [1, 2, 3, 4]
    tagged = keysplit.with_split(products, "product_id", [], null_key="keep")
    assert {r.split for r in tagged.collect()} == {"kept"}


def test_split_by_table(spark, products):
    keys = spark.createDataFrame([("P1",), ("P1",), (None,), ("P9",)], "product_id string")
    assert numbers(keysplit.keep_matching(products, keys, "product_id")) == [1]
    assert numbers(keysplit.drop_matching(products, keys, "product_id")) == [2, 4]
    keep = keysplit.drop_matching(products, keys, "product_id", null_key="keep")
    assert numbers(keep) == [2, 3, 4]


def test_salted_split_of_a_hot_key(spark):
    rows = spark.range(0, 3000, 1, 12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE 'k' || id % 40 END AS k",
        "id AS n",
    )
    for listed in ("hot", "k7"):
        keys = spark.createDataFrame([(listed,), (listed,), (None,)], "k string")
        for salts in (4, 32):
            for null_key in ("drop", "keep"):
                plain = keysplit.drop_matching(rows, keys, "k", null_key)
                salted = keysplit.drop_matching(rows, keys, "k", null_key, salts)
                assert salted.columns == plain.columns
                assert numbers(salted) == numbers(plain)
            assert numbers(keysplit.keep_matching(rows, keys, "k", salts)) == numbers(
                keysplit.keep_matching(rows, keys, "k")
            )


def reducers(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_rows_of_one_input_partition_reach_several_reducers(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = spark.range(0, 4000, 1, 1).selectExpr("IF(id < 0, 'x', 'hot') AS k", "id AS n")
        keys = spark.createDataFrame([("hot",), ("other",)], "k string")
        assert reducers(keysplit.keep_matching(hot, keys, "k", salts=8)) > 2
        others = spark.createDataFrame([("other",), ("x",)], "k string")
        assert reducers(keysplit.drop_matching(hot, others, "k", salts=8)) > 2
        none = hot.withColumn("k", F.expr("nullif(k, 'hot')"))
        assert reducers(keysplit.drop_matching(none, keys, "k", null_key="keep")) > 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_split_by_a_table_is_split_by_its_list(spark, products):
    keys = spark.createDataFrame([("P1",), ("P1",), (None,)], "product_id string")
    for null_key in ("drop", "keep"):
        for salts in (1, 5):
            by_table = keysplit.with_split(products, "product_id", keys, null_key, salts)
            by_list = keysplit.with_split(products, "product_id", ["P1"], null_key)
            assert by_table.columns == by_list.columns
            assert sorted(map(str, by_table.collect())) == sorted(map(str, by_list.collect()))


def test_with_split_covers_every_row(products):
    tagged = keysplit.with_split(products, "product_id", ["P1"], null_key="keep")
    assert {r.n: r.split for r in tagged.collect()} == {
        1: "quarantine", 2: "kept", 3: "kept", 4: "kept",
    }
    dropped = keysplit.with_split(products, "product_id", ["P1"])
    assert numbers(dropped) == [1, 2, 4]


def test_null_key_is_checked(products):
    with pytest.raises(ValueError):
        keysplit.drop_listed(products, "product_id", ["P1"], null_key="maybe")


def test_key_table_is_broadcast_only_below_the_threshold(spark, plan, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(1000).write.parquet(path)
    rows, keys = spark.range(10_000), spark.read.parquet(path)
    assert "BroadcastHashJoin" in plan(keysplit.drop_matching(rows, keys, "id"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        text = plan(keysplit.drop_matching(rows, keys, "id"))
        assert "Broadcast" not in text and "LeftAnti" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_split_counts_and_balance(spark, products):
    row = counts.split_counts(products, "product_id", ["P1"]).first()
    assert (row.quarantined, row.kept, row.no_key) == (1, 2, 1)
    labels = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "sentiment string")
    balance = counts.sentiment_balance(counts.sentiment_counts(labels))
    assert {r.sentiment: (r.reviews, r.share) for r in balance.collect()} == {
        "a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25),
    }
