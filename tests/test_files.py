import math
from types import SimpleNamespace

import pytest

from reviewloom.functions.gates import PLACEHOLDERS
from reviewloom.operators import keysplit
from reviewloom.plans import jobs, layers
from reviewloom.sources import csv, scratch, sinks
from reviewloom.sources.schema import CORRUPT_PRODUCT_IDS, REVIEW_COLUMNS

NASTY = [
    (1, "  padded ", 'two\nlines, "quoted"', 4.5),
    (2, None, "   ", None),
    (3, "", "", 2.0),
    (4, "lead", " \r\n cr", 7.0),
    (5, "back\\slash", 'a \\" b\\', float("inf")),
    (6, "#hash", '"', 1.0),
    (7, "null", "\t", 0.1),
    (8, "é₹👍", " ", -0.5),
]
NASTY_SCHEMA = "id int, p string, body string, rating double"


def test_lossless_round_trip(spark, tmp_path):
    df = spark.createDataFrame(NASTY, NASTY_SCHEMA).repartition(3)
    path = str(tmp_path / "t")
    sinks.write_csv(df, path)
    sinks.write_csv(df, path)  # overwrites
    back = csv.scan_lossless(spark, path, NASTY_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(NASTY)


def test_writer_bounds_file_size(spark, tmp_path):
    path = tmp_path / "t"
    sinks.write_csv(spark.range(1000).coalesce(1), str(path), max_records=100)
    assert len(list(path.glob("part-*"))) == 10


@pytest.mark.parametrize("words", [2, 300])
@pytest.mark.parametrize("parts", [1, 40])
def test_files_are_bounded_in_bytes(spark, tmp_path, words, parts):
    text = f"concat_ws(' ', transform(sequence(1, 1 + id % {words}), x -> sha1(x || '-' || id)))"
    df = spark.range(0, 1_200_000 // words, 1, parts).selectExpr("id", f"{text} AS body")
    for fmt, write in (("csv", sinks.write_csv), ("parquet", sinks.write_parquet)):
        path = tmp_path / fmt
        write(df, str(path), file_bytes=1 << 20)
        sizes = [f.stat().st_size for f in path.glob("part-*")]
        assert len(sizes) > 10 and min(sizes) > 1 << 19 and max(sizes) < 1 << 21, fmt
    back = csv.scan_lossless(spark, str(tmp_path / "csv"), "id bigint, body string")
    assert back.exceptAll(df).count() == 0 and back.count() == df.count()


def test_sized_files_of_nasty_few_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame(NASTY, NASTY_SCHEMA).repartition(3)
    for rows in (df, df.limit(0)):
        path = tmp_path / f"t{rows.count()}"
        sinks.write_csv(rows, str(path), file_bytes=1 << 20)
        assert len(list(path.glob("part-*"))) == 1
        back = csv.scan_lossless(spark, str(path), NASTY_SCHEMA)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    sinks.write_csv(df, str(tmp_path / "each"), file_bytes=1)  # no file is smaller than a row
    back = csv.scan_lossless(spark, str(tmp_path / "each"), NASTY_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(NASTY)
    with pytest.raises(ValueError):
        sinks.write_csv(df, str(tmp_path / "none"), file_bytes=0)


def test_measured_lines_are_the_lines_of_the_file(spark, tmp_path):
    df = spark.createDataFrame([r for r in NASTY if r[0] != 4], NASTY_SCHEMA).coalesce(1)
    sinks.write_csv(df, str(tmp_path / "t"))
    [part] = (tmp_path / "t").glob("part-*")
    lines = df.select(sinks.F.to_csv(sinks.F.struct("*"), csv.LOSSLESS).alias("line")).collect()
    header = len(",".join(df.columns)) + 1
    assert sum(len(r.line.encode()) + 1 for r in lines) + header == part.stat().st_size


def test_messy_scan_trims_and_keeps_newlines(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n  x ,"1\n""2"", 3"\n,   \n')
    rows = csv.scan_messy(spark, str(tmp_path / "m.csv")).collect()
    assert [tuple(r) for r in rows] == [("x", '1\n"2", 3'), (None, None)]


def test_declared_schema_turns_bad_ratings_into_null(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,body,rating\n1,ok,4.1\n2,bad,|\n3,short\n")
    rows = csv.scan_schema(spark, str(tmp_path), "id int, body string, rating double")
    assert [tuple(r) for r in rows.collect()] == [(1, "ok", 4.1), (2, "bad", None),
                                                  (3, "short", None)]


def test_split_corrupt(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        'id,body,rating\n1,ok,4.1\n2,bad,|\n3,short\n4,long,3.0,extra\n5,nan,NaN\n6,"a\nb",\n'
    )
    flagged = csv.scan_flagged(spark, str(tmp_path), ["id", "body", "rating"])
    got = {r.id: (r.body, r.rating, r.reason) for r in flagged.collect()}
    assert math.isnan(got.pop("5")[1])
    assert got == {
        "1": ("ok", 4.1, None),
        "2": ("bad", None, "rating"),
        "3": ("short", None, "arity"),
        "4": ("long", 3.0, "arity"),
        "6": ("a\nb", None, None),
    }
    sound, corrupt = csv.split_corrupt(flagged)
    assert sorted(r.id for r in sound.collect()) == ["1", "5", "6"]
    assert sorted(r.id for r in corrupt.collect()) == ["2", "3", "4"]


def test_split_is_written_in_one_pass(spark, tmp_path, plan):
    df = spark.createDataFrame(
        [("P1", 1), ("P2", 2), (None, 3)], "product_id string, n int"
    )
    path = str(tmp_path / "s")
    sinks.write_split(keysplit.with_split(df, "product_id", ["P1"]), path)
    schema = "product_id string, n int"
    for side, n in ((keysplit.QUARANTINE, [1]), (keysplit.KEPT, [2])):
        assert [r.n for r in csv.scan_side(spark, path, side, schema).collect()] == n
    text = plan(csv.scan_side(spark, path, keysplit.KEPT, schema))
    assert "PartitionFilters: [isnotnull(split" in text


@pytest.mark.parametrize("ids", [[], ["P1", "P2"]])
def test_a_side_without_rows_reads_as_empty(spark, tmp_path, ids):
    df = spark.createDataFrame([("P1", 1), ("P2", 2)], "product_id string, n int")
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        sinks.write_split(keysplit.with_split(df, "product_id", ids), path, fmt)
        sizes = [
            csv.scan_side(spark, path, side, "product_id string, n int", fmt).count()
            for side in (keysplit.KEPT, keysplit.QUARANTINE)
        ]
        assert sizes == ([0, 2] if ids else [2, 0])


def test_jobs_on_a_source_where_nothing_is_kept(spark, tmp_path):
    source, silver, gold = (str(tmp_path / n) for n in ("src", "silver", "gold"))
    (tmp_path / "src").mkdir()
    lines = [",".join(REVIEW_COLUMNS), review_line("B088Z1YWBC", "4.0", "u", "fine cable")]
    (tmp_path / "src" / "r.csv").write_text("\n".join(lines) + "\n")
    layers.bronze_to_silver(spark, source, silver, CORRUPT_PRODUCT_IDS)
    layers.silver_to_gold(spark, silver, gold, "csv")
    table = csv.scan_lossless(
        spark, sinks.current(spark, f"{gold}/training_dataset"), layers.GOLD_SCHEMA
    )
    assert table.count() == 0


def test_report_is_one_file(spark, tmp_path):
    path = tmp_path / "r"
    sinks.write_report(spark.range(50).repartition(8), str(path))
    assert len(list(path.glob("part-*"))) == 1


def fake_session(**conf):
    return SimpleNamespace(conf={k.replace("_", "."): v for k, v in conf.items()})


def test_scratch_follows_the_session(tmp_path):
    shared = fake_session(spark_checkpoint_dir=f"{tmp_path}/", spark_sql_warehouse_dir="x")
    first, second = (scratch.scratch_path(shared, "x") for _ in range(2))
    assert first.startswith(f"{tmp_path}/reviewloom/x-") and first != second
    unset = fake_session(spark_sql_warehouse_dir="hdfs://host/warehouse")
    assert scratch.scratch_path(unset, "x").startswith("hdfs://host/warehouse/reviewloom/x-")


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "local[4]", "local"])
@pytest.mark.parametrize("folder", ["file:/tmp/w", "/tmp/w", "spark-warehouse"])
def test_no_scratch_on_the_drivers_own_disk_of_a_cluster(master, folder):
    session = fake_session(spark_sql_warehouse_dir=folder)
    session.sparkContext = SimpleNamespace(master=master)
    if master in ("local", "local[4]"):
        assert scratch.scratch_root(session) == f"{folder}/reviewloom"
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.scratch_root(session)


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda _: f"{tmp_path}/reviewloom")
    spark.range(3).write.parquet(scratch.scratch_path(spark, "x"))
    assert list(tmp_path.glob("reviewloom/x-*"))
    assert scratch.clear_scratch(spark) and not list(tmp_path.glob("reviewloom"))
    assert not scratch.clear_scratch(spark)


def test_both_sides_are_written_without_a_sort(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    df = spark.range(100).selectExpr("id AS n", "IF(id % 2 = 0, 'kept', 'quarantine') AS split")
    table = str(tmp_path / "t")
    spark.sql(f"CREATE TABLE both_sides (n bigint, split string) USING parquet "
              f"PARTITIONED BY (split) LOCATION '{table}'")
    df.createOrReplaceTempView("both_rows")
    insert = "EXPLAIN EXTENDED INSERT INTO both_sides SELECT n, split FROM both_rows"
    try:
        assert "Sort" in spark.sql(insert).first()[0]
        with sinks._setting(spark, name, "8"):
            assert "Sort" not in spark.sql(insert).first()[0]
    finally:
        spark.sql("DROP TABLE both_sides")
    used = []
    real = sinks._setting
    sinks._setting = lambda spark, key, value: used.append((key, value)) or real(spark, key, value)
    try:
        sinks.write_split(df, str(tmp_path / "s"), "parquet")
    finally:
        sinks._setting = real
    assert used == [(name, "8")] and spark.conf.get(name) == "0"
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100


def test_padded_source_with_listed_products(spark, tmp_path):
    cells = dict.fromkeys(REVIEW_COLUMNS, "")
    lines = [",".join(REVIEW_COLUMNS)]
    for product, content in (("  B088Z1YWBC ", ' "good, cable"'), (" X1", ' "so, so" ')):
        row = {**cells, "product_id": product, "review_content": content, "rating": " 4.0 "}
        lines.append(",".join(row.values()))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "r.csv").write_text("\n".join(lines) + "\n")
    silver = str(tmp_path / "silver")
    keys = spark.createDataFrame([("B088Z1YWBC",)], "product_id string")
    for ids in (CORRUPT_PRODUCT_IDS, keys):
        layers.bronze_to_silver(spark, str(tmp_path / "src"), silver, ids)
        sides = [csv.scan_side(spark, silver, s, fmt="parquet").collect()
                 for s in (keysplit.QUARANTINE, keysplit.KEPT)]
        assert [[(r.product_id, r.review_content, r.rating) for r in s] for s in sides] == [
            [("B088Z1YWBC", "good, cable", 4.0)], [("X1", "so, so", 4.0)],
        ]


@pytest.mark.parametrize("salts", ["1", "4"])
def test_job_with_a_key_table_and_corrupt_rows_aside(spark, source, tmp_path, capsys, salts):
    silver, keys = str(tmp_path / "silver"), str(tmp_path / "keys")
    spark.createDataFrame([("X2",), ("X2",)], "product_id string").write.parquet(keys)
    (tmp_path / "src" / "more.csv").write_text(",".join(REVIEW_COLUMNS) + "\nshort,row\n")
    jobs.main(["bronze-to-silver", source, silver, "--corrupt-keys", keys, "--corrupt-aside",
               "--salts", salts])
    assert "rows: 9, kept: 5, quarantine: 1, corrupt: 2, no_key: 1" in capsys.readouterr().out
    side = lambda s: {r.product_id for r in csv.scan_side(spark, silver, s, fmt="parquet").collect()}
    assert side(keysplit.QUARANTINE) == {"X2"}
    assert side(keysplit.CORRUPT) == {"X3", "short"}
    assert side(keysplit.KEPT) == {"B088Z1YWBC", "X1", "X4", "X5", "X6"}


def test_fixed_lists():
    assert len(CORRUPT_PRODUCT_IDS) == 59 and len(set(CORRUPT_PRODUCT_IDS)) == 52
    assert len(REVIEW_COLUMNS) == 16
    assert PLACEHOLDERS == ("null", "none", "nan", "n/a")


def review_line(product, rating, user, content):
    cells = dict.fromkeys(REVIEW_COLUMNS, "")
    cells.update(product_id=product, rating=rating, user_id=user, review_content=content,
                 product_name="cable, 1m", discounted_price="â‚¹399")
    return ",".join('"' + cells[c].replace('"', '""') + '"' for c in REVIEW_COLUMNS)


@pytest.fixture
def source(tmp_path):
    lines = [
        review_line("B088Z1YWBC", "4.0", "u0", "corrupt row"),
        review_line("X1", "4.5", "u1", "Great\ncable!!! http://x.y"),
        review_line("X2", "2.0", "u2", "great CABLE"),
        review_line("X3", "|", "u3", "no \"idea\""),
        review_line("X4", "3.0", "u4", "N/A"),
        review_line("X5", "3.0", "u5", ""),
        review_line("X6", "1.0", "u6", "<b>bad</b> one"),
        review_line("", "5.0", "u7", "no product"),
    ]
    path = tmp_path / "src"
    path.mkdir()
    (path / "reviews.csv").write_text(",".join(REVIEW_COLUMNS) + "\n" + "\n".join(lines) + "\n")
    return str(path)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_source_to_gold(spark, source, tmp_path, fmt):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    counts = layers.bronze_to_silver(spark, source, silver, CORRUPT_PRODUCT_IDS)
    assert counts == {"rows": 8, "kept": 6, "quarantine": 1, "corrupt": 0, "no_key": 1}
    layers.silver_to_gold(spark, silver, gold, fmt)
    table = sinks.current(spark, f"{gold}/training_dataset")
    if fmt == "csv":
        rows = csv.scan_lossless(spark, table, "review_body string, sentiment string")
    else:
        rows = spark.read.parquet(table)
    assert {r.review_body: r.sentiment for r in rows.collect()} == {
        "great cable": "positive", "no idea": "unknown", "bad one": "negative",
    }
    report = csv.scan_lossless(spark, f"{gold}/sentiment_counts",
                               "sentiment string, reviews bigint")
    assert {r.sentiment: r.reviews for r in report.collect()} == {
        "positive": 1, "unknown": 1, "negative": 1,
    }
    quarantined = csv.scan_side(spark, silver, keysplit.QUARANTINE, fmt="parquet")
    assert [r.product_id for r in quarantined.collect()] == ["B088Z1YWBC"]


def test_jobs_without_key_filter(spark, source, tmp_path, monkeypatch):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    jobs.main(["bronze-to-silver", source, silver])
    jobs.main(["silver-to-gold", silver, gold, "--format", "parquet"])
    table = sinks.current(spark, f"{gold}/training_dataset")
    bodies = {r.review_body for r in spark.read.parquet(table).collect()}
    assert bodies == {"corrupt row", "great cable", "no idea", "bad one", "no product"}
