"""Multi-line CSV files read by many tasks, row for row as Spark's one-task reader does."""

import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.keysplit import CORRUPT, KEPT
from reviewloom.plans import layers
from reviewloom.sources import csv, multiline
from reviewloom.sources.schema import REVIEW_COLUMNS

SCHEMA = "a string, b string, c double"


@contextmanager
def splits(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture
def kept_here(spark, monkeypatch):
    """Intermediate rows stay here: read from files by splits of a few bytes they would be
    hundreds of tasks."""
    keep = lambda df, _: spark.createDataFrame(df.collect(), df.schema)
    monkeypatch.setattr(multiline, "written", keep)


def options(trimmed):
    padding = {f"ignore{side}WhiteSpace": trimmed for side in ("Leading", "Trailing")}
    return {**csv.QUOTING, **padding, "mode": "PERMISSIVE"}


def whole(spark, path, trimmed, schema=SCHEMA):
    rows = spark.read.options(**options(trimmed), multiLine=True).schema(schema).csv(path)
    return Counter(map(tuple, rows.collect()))


PLAIN = ["", "x", "a b", "1.5", '5" x', 'it""s', 'q"', "é"]
PADDED = [" x ", '  "a, b" ', ' "" ', '\t"\n"']


def cell(rand, cells):
    if rand.random() < 0.4:
        return rand.choice(cells)
    inside = ["x", ",", "\n", '""', " ", "é", "\n\n", '""""', "\n,", ',""\n']
    return '"' + "".join(rand.choice(inside) for _ in range(rand.randint(0, 6))) + '"'


@pytest.mark.parametrize("trimmed", [False, True])
def test_rows_are_those_of_the_reader(spark, tmp_path, kept_here, trimmed):
    rand = random.Random(trimmed)
    for n in range(4):
        lines = ['a,"b\nb",c' if n % 2 else "a,b,c"]
        for _ in range(30):
            fields = [cell(rand, PLAIN + PADDED * trimmed) for _ in range(rand.choice([3, 3, 3, 2, 4]))]
            lines.append(",".join(fields) + "\n" * (rand.random() < 0.1))
        (tmp_path / f"{n}.csv").write_text("\n".join(lines) + "\n" * (n % 3 > 0))
    for size in (101, 10_000):
        with splits(spark, size):
            _, odd = multiline.records(spark, str(tmp_path), True, trimmed)
            found = multiline.scan_split(spark, str(tmp_path), SCHEMA, options(trimmed))
            assert odd == []
            assert Counter(map(tuple, found.collect())) == whole(spark, str(tmp_path), trimmed)


CASES = {
    "plain": 'a,b,c\n1,"x\ny",2\n3,z,4\n',
    "no end": 'a,b,c\n1,"x\ny",2\n3,z,"4"',
    "quoted header": '"a\n""",b,c\n1,"x\ny",2\n',
    "quotes in a field": 'a,b,c\n5" wide,x,1\na "b" c,"y\n",2\n',
    "empty lines": 'a,b,c\n\n1,"x\n\n\ny",2\n\n\n3,z,4\n',
    "only a header": "a,b,c\n",
    "nothing": "",
    "byte order mark": '﻿a,b,c\n1,"x\ny",2\n',
    "short and long": 'a,b,c\n"1\n"\n1,2,3,"4\n"\n',
    "long": 'a,b,c\n1,"' + "x\n" * 3000 + '",2\n3,z,4\n',
}
ODD = {
    "carriage returns": 'a,b,c\r\n1,"x\r\ny",2\r\n',
    "open at the end": 'a,b,c\n1,"x\ny,2\n',
    "behind a quote": 'a,b,c\n1,"x"y,"\n"\n',
    "empty first": '\na,b,c\n1,"x\ny",2\n',
}


@pytest.mark.parametrize("name", [*CASES, *ODD])
def test_cases(spark, tmp_path, kept_here, name):
    path = tmp_path / "f.csv"
    path.write_text((CASES | ODD)[name], newline="")
    with splits(spark, 9 if len(path.read_text()) < 500 else 2000):
        _, odd = multiline.records(spark, str(path))
        assert bool(odd) == (name in ODD)
        found = multiline.scan_split(spark, str(path), SCHEMA, options(False))
        assert Counter(map(tuple, found.collect())) == whole(spark, str(path), False)


def test_breaks_and_quotes_at_every_position_of_a_split(spark, tmp_path, kept_here):
    """The same records, pushed by one byte a file: borders fall on every character."""
    body = 'k,"a ""b"",\n\n""\n",1\nm,"",2\n"n\n",",\n",3\n' * 2
    for n in range(13):
        (tmp_path / f"{n:02}.csv").write_text("a,b,c\n" + "x" * n + ",,\n" + body)
    with splits(spark, 13):
        found = multiline.scan_split(spark, str(tmp_path), SCHEMA, options(False))
        assert Counter(map(tuple, found.collect())) == whole(spark, str(tmp_path), False)


def test_one_file_is_many_tasks_and_small_files_are_left_to_the_reader(spark, tmp_path, plan):
    rows = "".join(f'{i},"line\n{i}",{i}\n' for i in range(2000))
    (tmp_path / "large.csv").write_text("a,b,c\n" + rows)
    (tmp_path / "small.csv").write_text('a,b,c\ns,"t\nu",1\n')
    with splits(spark, 4000):
        lines = multiline._text(spark, str(tmp_path), 4000)
        assert lines.rdd.getNumPartitions() > 8
        found = multiline.scan_large_split(spark, str(tmp_path), SCHEMA, options(False))
        assert Counter(map(tuple, found.collect())) == whole(spark, str(tmp_path), False)
        assert len(found.where("a = 's'").collect()) == 1
    with splits(spark, 1 << 20):
        found = multiline.scan_large_split(spark, str(tmp_path), SCHEMA, options(False))
        assert "from_csv" not in plan(found) and found.count() == 2001


def test_records_stay_in_their_split_without_a_shuffle(spark, tmp_path, plan):
    (tmp_path / "f.csv").write_text("a,b,c\n" + '1,"x\ny",2\n' * 500)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with splits(spark, 1000):
            found, _ = multiline.records(spark, str(tmp_path))
            branch = plan(found).split("Union", 1)[1]
            # Per branch: texts move once, to their split; the second branch has the
            # pieces that meet over borders move again.
            assert branch.count("Exchange hashpartitioning(file") == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_only_lines_over_borders_move_twice(spark, tmp_path, plan):
    """Texts are sorted once, by numbers: the branch of the borders filters lines first."""
    (tmp_path / "f.csv").write_text("a,b,c\n" + '1,"x\ny",2\n' * 500 + '2,"' + "z\n" * 900 + '",3\n')
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with splits(spark, 1000):
            found, _ = multiline.records(spark, str(tmp_path))
            inside, pieces, lines = plan(found).split("Exchange hashpartitioning(file")[-3:]
            assert "Window" not in pieces + lines and "isnotnull" in lines
            assert "file_path" not in inside + pieces + lines
            assert sorted(len(r.record) for r in found.collect()) == [9] * 500 + [1806]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("trimmed", [False, True])
def test_lines_without_quotes_are_not_split(spark, trimmed, plan):
    states = [multiline._end_state(F.col("value"), n, trimmed) for n in (multiline.NEW, multiline.QUOTED)]
    for state in states:
        text = plan(spark.range(1).selectExpr("string(id) AS value").select(state)).lower()
        assert text.index("contains(") < text.index("aggregate(")
    lines = spark.createDataFrame([(v,) for v in ["", "x", " a, b ", ",,", "1,2,"]], "value string")
    for row in lines.select(*states).collect():
        assert tuple(row) == (multiline.OPEN, multiline.QUOTED)


def test_flagged_and_job_by_splits(spark, tmp_path):
    cells = lambda i, rating: ",".join(
        f'"{v}"' for v in [f"P{i % 3}", *[f"v{i}\nw"] * 5, rating, *["z"] * 9]
    )
    source = tmp_path / "src"
    source.mkdir()
    lines = [cells(i, "|" if i % 10 == 7 else "4.0") for i in range(300)] + ["short,row"]
    (source / "r.csv").write_text(",".join(REVIEW_COLUMNS) + "\n" + "\n".join(lines) + "\n")
    expected = csv.scan_flagged(spark, str(source), list(REVIEW_COLUMNS))
    with splits(spark, 700):
        found = csv.scan_flagged(spark, str(source), list(REVIEW_COLUMNS), split_files=True)
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
        silver = str(tmp_path / "silver")
        counts = layers.bronze_to_silver(spark, str(source), silver, ["P1"], corrupt_aside=True)
    assert counts["rows"] == 301 and counts["corrupt"] == 31 and counts["no_key"] == 0
    for side in (KEPT, CORRUPT):
        written = spark.read.parquet(silver).where(F.col("split") == side).count()
        assert written == counts[side]
