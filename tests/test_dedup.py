import random
from collections import Counter

from pyspark.sql import functions as F

from reviewloom.operators import dedup
from reviewloom.operators.explode import explode_merged

SCHEMA = "user_id string, product_id string, review_content string, rating double"


def test_distinct_treats_null_and_nan_as_equal(spark):
    nan = float("nan")
    rows = [("u", None, "t", None)] * 3 + [("u", "p", "t", nan)] * 2 + [("u", "p", "t", 1.0)]
    assert dedup.distinct_on(spark.createDataFrame(rows, SCHEMA)).count() == 3


def test_best_rating_wins(spark):
    rows = [("u", "p", "a", 2.0), ("v", "q", "a", None), ("w", "p", "a", 4.5),
            ("u", "p", "b", None), ("u", "p", None, 1.0), ("v", "p", None, 3.0)]
    out = dedup.best_rating_per(spark.createDataFrame(rows, SCHEMA), ["review_content"])
    assert {r.review_content: r.rating for r in out.collect()} == {
        "a": 4.5, "b": None, None: 3.0,
    }


def test_hot_text_against_brute_force(spark):
    """A third of all rows are copies of one text, over any partitioning."""
    rng = random.Random(3)
    rows = []
    for _ in range(6000):
        body = "hot" if rng.random() < 1 / 3 else f"t{rng.randint(0, 900)}"
        rating = rng.choice([None, 0.5, 2.0, 3.5, 4.5])
        rows.append((rng.choice("uv"), rng.choice("pq"), body, rating))
    best: dict = {}
    for _, _, body, rating in rows:
        known = [r for r in (best.get(body), rating) if r is not None]
        best[body] = max(known) if known else None
    for parts in (1, 3, 16):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        out = dedup.best_rating_per(df, ["review_content"])
        assert {r.review_content: r.rating for r in out.collect()} == best
        digests = dedup.best_rating_per_digest(df, "review_content")
        assert sorted(str(r.rating) for r in digests.collect()) == sorted(
            str(r) for r in best.values()
        )
        assert dedup.distinct_on(df).count() == len(set(rows))


def test_plans_stay_hash_aggregates(spark, plan):
    df = spark.createDataFrame([("u", "p", "a", 1.0)], SCHEMA)
    for out in (
        dedup.distinct_on(df),
        dedup.best_rating_per(df, ["review_content"]),
        dedup.best_rating_per_digest(df, "review_content"),
    ):
        text = plan(out)
        assert "SortAggregate" not in text and "Sort " not in text
        assert text.count("hashpartitioning") == 1


def brute(rows, keys):
    best = {}
    for row in rows:
        key, rating = tuple(str(row[k]) for k in keys), row["rating"]
        known = [r for r in (best.get(key), rating) if r is not None]
        best[key] = max(known) if known else None
    return best


def mixed_rows(n=3000, seed=5):
    """A third copies of one text, a third single texts, the rest in small groups."""
    rng = random.Random(seed)
    for i in range(n):
        body = rng.choice(["hot", f"single {i}", rng.choice([None, "", f"t{i % 200}"])])
        rating = rng.choice([None, 0.5, 2.0, 4.5, 0.0])
        yield {"user_id": rng.choice("uv"), "product_id": rng.choice(["p", None]),
               "review_content": body, "rating": rating}


def test_repeats_first_against_brute_force(spark):
    rows = list(mixed_rows())
    for parts in (1, 7):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        for keys in (["review_content"], ["user_id", "product_id", "review_content"]):
            out = dedup.best_rating_per(df, keys, repeats_first=True).collect()
            assert len(out) == len(brute(rows, keys))
            assert {tuple(str(r[k]) for k in keys): r.rating for r in out} == brute(rows, keys)
        out = dedup.distinct_on(df, repeats_first=True).collect()
        assert len(out) == len({tuple(r.values()) for r in rows})


def test_repeats_first_moves_no_single_text(spark):
    rows = list(mixed_rows())
    df = spark.createDataFrame(rows, SCHEMA)
    single, others = dedup.split_repeats(df, ["review_content"])
    copies = Counter(r["review_content"] for r in rows)
    singles = {text for text, n in copies.items() if n == 1}
    stay = {r.review_content for r in single.collect()}
    assert stay <= singles and len(stay) > 0.9 * len(singles)
    assert single.count() + others.count() == len(rows)


def test_a_full_filter_is_still_exact(spark):
    rows = list(mixed_rows())
    bodies = spark.createDataFrame(rows, SCHEMA).select("review_content", "rating")
    single, others = dedup.split_repeats(bodies, ["review_content"], max_bits=64)
    assert others.count() > len(rows) / 2
    out = single.unionAll(dedup.best_rating_per(others, ["review_content"])).collect()
    assert {(str(r.review_content),): r.rating for r in out} == brute(rows, ["review_content"])
    assert len(out) == len(brute(rows, ["review_content"]))


def test_repeats_first_zeros_nan_and_empty(spark):
    nan = float("nan")
    numbers = [(0.0,), (-0.0,), (nan,), (nan,), (None,), (None,), (1.0,)]
    df = spark.createDataFrame(numbers, "x double").repartition(3)
    assert dedup.distinct_on(df, ["x"], repeats_first=True).count() == 4
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup.distinct_on(empty, repeats_first=True).count() == 0


def test_repeats_first_keeps_clashing_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, 3), ("a", 1, 2, 3), ("b", 4, 5, 6)],
        "Place string, bitmap int, place_segment int, segment int",
    )
    out = dedup.distinct_on(df, df.columns, repeats_first=True)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [("a", 1, 2, 3), ("b", 4, 5, 6)]


def test_only_the_repeats_are_exchanged(spark, plan):
    df = spark.createDataFrame([("u", "p", "a", 1.0)] * 2, SCHEMA)
    out = dedup.best_rating_per(df, ["review_content"], repeats_first=True)
    text = plan(out)
    assert text.count("hashpartitioning(review_content") == 1
    assert "SortAggregate(key=[review_content" not in text


def explode_rows(spark, rows, delimiter):
    df = spark.createDataFrame(rows, "id int, a string, b string")
    out = explode_merged(df, ["a", "b"], delimiter).collect()
    return sorted(
        ((r.id, r.item, r.a, r.b, r.aligned) for r in out),
        key=lambda r: (r[0], -1 if r[1] is None else r[1]),
    )


def test_explode_merged(spark):
    rows = [(1, "x|y|", "1|2|3"), (2, "x|y", "1"), (3, None, "1|2"), (4, "solo", "1"),
            (5, None, None), (6, "", "")]
    assert explode_rows(spark, rows, "|") == [
        (1, 0, "x", "1", True), (1, 1, "y", "2", True), (1, 2, "", "3", True),
        (2, None, "x|y", "1", False),
        (3, None, None, "1|2", False),
        (4, 0, "solo", "1", True),
        (5, None, None, None, False),
        (6, 0, "", "", True),
    ]


def test_explode_delimiter_is_literal(spark):
    for delimiter in (".", "\\E", "||", "\x1f", "a*"):
        got = explode_rows(spark, [(1, f"p{delimiter}q", f"r{delimiter}s")], delimiter)
        assert got == [(1, 0, "p", "r", True), (1, 1, "q", "s", True)], repr(delimiter)


def test_explode_splits_each_text_once(spark, plan):
    df = spark.range(3).select("id", F.concat(F.lit("a,"), F.col("id").cast("string")).alias("a"),
                               F.lit("1,2").alias("b")).repartition(2)
    assert plan(explode_merged(df, ["a", "b"], ",")).count("split(a") == 1
