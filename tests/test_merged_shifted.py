"""Merged rows with delimiters inside texts, moved values, and names that clash."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import explode, keysplit, shifted
from reviewloom.operators.explode import cut_parts, explode_merged
from reviewloom.plans import views
from reviewloom.sources import csv
from reviewloom.sources.schema import REVIEW_COLUMNS

SF = "/root/testdata/sf0.01"


def plain_cuts(parts, wanted):
    """Every way to cut, scored as a whole."""
    best = []
    for cuts in itertools.combinations(range(1, len(parts)), wanted - 1):
        score = 0
        for at in cuts:
            before, after = parts[at - 1], parts[at]
            text = after.lstrip()
            score += explode.SPACED if after[:1].isspace() else explode.AT_ONCE
            if text[:1].isupper() or text[:1].isdigit():
                score += explode.CAPITAL
            elif text[:1].islower():
                score += explode.SMALL
            score += explode.STOP * before.rstrip().endswith((".", "!", "?"))
        borders = [0, *cuts, len(parts)]
        for a, b in zip(borders, borders[1:]):
            score += explode.BLANK * (not any(p.strip() for p in parts[a:b]))
        best.append((score, list(cuts)))
    top = max(score for score, _ in best)
    return top, [cuts for score, cuts in best if score == top]


def test_cuts_against_every_way():
    rand = random.Random(5)
    pieces = ["Good.", " bad", "", "  ", "fine", " Great!", "9 of 10", "ok?", "the end", "A"]
    for _ in range(400):
        parts = [rand.choice(pieces) for _ in range(rand.randint(1, 8))]
        wanted = rand.randint(1, len(parts))
        _, expected = plain_cuts(parts, wanted)
        cuts, ways = cut_parts(parts, wanted)
        assert cuts in expected and ways == min(2, len(expected)), (parts, wanted)


REVIEWS = ["Good, solid cable.", "I like it, my wife too, and the cat.", "Ok", "No, never again!",
           "Fits well.", "Blue, as shown.", "Works, mostly.", "Broke, sadly."]


def test_planted_commas_come_out_in_eight_reviews(spark):
    users = ",".join(f"u{i}" for i in range(8))
    rows = [
        (1, users, ",".join(REVIEWS)),
        (2, "u1,u2", "same,same,same"),  # two ways
        (3, "u1,u2,u3", "one,two"),  # too few
        (4, None, "a,b"), (5, "u1", None), (6, "u1", "All, of it, is one."), (7, "a,b", "x,y"),
    ]
    df = spark.createDataFrame(rows, "item int, user_id string, review_content string")
    with pytest.raises(ValueError):
        explode_merged(df, ["user_id", "review_content"], ",", "review_content")
    found = explode_merged(df, ["user_id", "review_content"], ",", "review_content", item="place")
    by = {}
    for r in found.collect():
        by.setdefault(r.item, []).append(r)
    assert [r.review_content for r in sorted(by[1], key=lambda r: r.place)] == REVIEWS
    assert [r.user_id for r in sorted(by[1], key=lambda r: r.place)] == users.split(",")
    how = {k: {r.alignment for r in v} for k, v in by.items()}
    assert how == {1: {"recovered"}, 2: {"ambiguous"}, 3: {"unequal"}, 4: {"unequal"},
                   5: {"unequal"}, 6: {"recovered"}, 7: {"exact"}}
    assert [(r.place, r.aligned, r.review_content) for r in by[2]] == [(None, False, "same,same,same")]
    assert by[6][0].review_content == "All, of it, is one."


def test_planted_shifts_are_found_and_sound_rows_left_alone(spark):
    evidence = shifted.learn(views.review_file(spark, SF), REVIEW_COLUMNS)
    found = shifted.with_shift(views.shifted_reviews(spark, SF), evidence).collect()
    sound = [r for r in found if r.moved == 0]
    assert sum(r.shift_start is None for r in sound) >= 0.999 * len(sound)
    moved = [r for r in found if r.moved]
    assert {r.moved for r in moved} >= set(range(1, 17)) | set(range(-15, 0))
    assert sum(r.shift_start is not None for r in moved) >= 0.95 * len(moved)
    # Where neighbours look alike the first moved column may be off by some.
    assert sum(r.shift_start == r.moved for r in moved) >= 0.8 * len(moved)


def test_shifts_on_other_tables_and_on_nothing(spark):
    rows = spark.range(3000).selectExpr(
        "CAST(id AS string) AS id", "CONCAT('name ', id) AS name",
        "date_add(DATE'2024-01-01', CAST(id % 300 AS int)) AS day", "id / 7.0 AS share", "id AS odds",
    )
    names = ["id", "name", "day", "share"]
    evidence = shifted.learn(rows, names, features=50)
    assert all(len(known) <= 50 * len(names) for known, _ in evidence.kinds)
    good = shifted.with_shift(rows, evidence)
    assert good.where("shift_start IS NOT NULL").count() == 0 and good.columns[:5] == rows.columns
    moved = rows.selectExpr("'x, y' AS id", "id AS name", "name AS day", "string(day) AS share")
    assert shifted.with_shift(moved, evidence).where("shift_start > 0").count() == 3000
    nothing = shifted.learn(rows.limit(0), names)
    assert shifted.with_shift(rows, nothing).where("shift_start IS NOT NULL").count() == 0
    assert shifted.with_shift(rows.limit(0), evidence).count() == 0
    with pytest.raises(ValueError):
        shifted.with_shift(rows, evidence, odds="Odds")


def test_shifted_rows_go_aside(spark):
    names = list(REVIEW_COLUMNS)
    evidence = shifted.learn(views.review_file(spark, SF), names)
    rows = views.shifted_reviews(spark, SF).withColumn(
        "reason", F.when(F.col("doc_id") % 5 == 0, "arity")
    )
    sides = keysplit.split_by_reason(shifted.flag_shifted(rows, evidence))
    found = {(r.split, r.reason, r.moved != 0) for r in sides.collect()}
    assert ("corrupt", "shifted", True) in found and ("kept", None, False) in found
    assert not {("corrupt", "shifted", False), ("kept", None, True)} & found
    assert {split for split, reason, _ in found if reason == "arity"} == {"corrupt"}


CLASHING = "k string, _salt bigint, salt bigint, _listed boolean, listed int, n bigint"


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize("hot", [None, ["a"]])
def test_columns_of_any_name(spark, salts, hot):
    rows = [("a", 1, 2, True, 3, 1), ("b", 4, 5, False, 6, 2), (None, 7, 8, None, 9, 3)] * 3
    df = spark.createDataFrame(rows, CLASHING)
    keys = spark.createDataFrame([("a", 1)] * 2, "k string, salt int")
    got = lambda found: sorted(map(tuple, found.collect()), key=str)
    assert got(keysplit.keep_matching(df, keys, "k", salts, hot)) == sorted(rows[::3], key=str)
    kept = keysplit.drop_matching(df, keys, "k", "keep", salts, hot)
    assert kept.columns == df.columns
    assert got(kept) == sorted(rows[1::3] + rows[2::3], key=str)
    split = keysplit.with_split(df, "k", keys, "keep", salts, hot)
    assert {r.k: r.split for r in split.collect()} == {"a": "quarantine", "b": "kept", None: "kept"}
    with pytest.raises(ValueError):
        keysplit.with_split(split, "k", keys)
    again = keysplit.with_split(split, "k", ["b"], name="side")
    assert {(r.k, r.split, r.side) for r in again.collect()} == {
        ("a", "quarantine", "kept"), ("b", "kept", "quarantine"),
    }


def test_added_columns_do_not_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "b")], "aligned int, x string, y string")
    with pytest.raises(ValueError):
        explode_merged(df, ["x", "y"], ",")
    assert explode_merged(df, ["x", "y"], ",", aligned="paired").first().paired
    with pytest.raises(ValueError):
        csv.scan_flagged(spark, str(tmp_path), ["id", "reason", "rating"])


def test_hot_keys_alone_are_spread(spark):
    rows = spark.range(0, 30_000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE string(id) END AS k", "id AS n"
    )
    hot = keysplit.hot_keys(rows, "k", 0.1)
    assert hot == ["hot"] and keysplit.hot_keys(rows.limit(0), "k") == []
    keys = rows.select("k").distinct()
    joined = keysplit._join(rows, keys, "k", "left_semi", 16, hot)
    assert joined.count() == rows.where("k IS NOT NULL").count()
    limit, adaptive = (spark.conf.get(f"spark.sql.{x}") for x in ("autoBroadcastJoinThreshold", "adaptive.enabled"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = keysplit.keep_matching(rows, keys, "k", 64, hot).where("k = 'hot'")
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 5 and max(r["count"] for r in sizes) < 5000
        found = keysplit.keep_matching(rows, keys, "k", 64, hot).where("k = '4'")
        assert found.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_texts_of_any_length_are_cut_by_their_ends(spark, plan):
    """What goes to Python is three characters a part, and says as much as the parts."""
    rand = random.Random(9)
    marks = ["", " ", "\n", " ", "　", "\x1c", "a", "Z", "É", "ß", "7", "²", "𝒳", ".", "?", "-"]
    rows = []
    for n in range(200):
        parts = ["".join(rand.choices(marks, k=rand.randint(0, 6))) for _ in range(rand.randint(3, 9))]
        rows.append((n, ",".join("ab"), ",".join(parts)))
    rows.append((200, "a,b", ",".join(["x" * 300_000, " y" * 200_000, "Z" * 300_000])))
    df = spark.createDataFrame(rows, "n int, user_id string, review_content string")
    ends = explode._ends(F.split("review_content", ","))
    for r in df.select("review_content", ends.alias("ends")).collect():
        parts, short = r.review_content.split(","), r.ends.split("\n")
        assert len(r.ends) <= 4 * len(parts)
        assert cut_parts(short, 2) == cut_parts(parts, 2), r
    found = explode_merged(df, ["user_id", "review_content"], ",", "review_content")
    sent = [line for line in plan(found).split("\n") if "ArrowEvalPython" in line]
    assert len(sent) == 1 and "array_join(" in sent[0]
    by = {}
    for r in found.where("alignment = 'recovered'").orderBy("item").collect():
        by.setdefault(r.n, []).append(r.review_content)
    for n, _, content in rows:
        cuts, ways = cut_parts(content.split(","), 2)
        whole = [",".join(content.split(",")[: cuts[0]]), ",".join(content.split(",")[cuts[0] :])]
        assert by.get(n) == (whole if ways == 1 else None)
