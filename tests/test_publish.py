"""A published table is whole at every moment, whatever step a job stops at."""

import shutil

import pytest

from reviewloom.sources import sinks

METHODS = ("exists", "listStatus", "create", "delete")


def rows(spark, path, fmt="parquet"):
    table = spark.read.format(fmt).schema("a string").option("header", True)
    return sorted(r.a for r in table.load(sinks.current(spark, path)).collect())


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a string")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_publish_leaves_the_old_rows(spark, tmp_path, fmt):
    path = str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError):
        sinks.current(spark, path)
    sinks.publish(frame(spark, "x", "y"), path, fmt)
    assert rows(spark, path, fmt) == ["x", "y"]
    bad = spark.range(0, 100, 1, 4).selectExpr("IF(id = 99, raise_error('no'), string(id)) AS a")
    with pytest.raises(Exception, match="no"):
        sinks.publish(bad, path, fmt)
    assert rows(spark, path, fmt) == ["x", "y"]
    sinks.publish(frame(spark, "z"), path, fmt)
    assert rows(spark, path, fmt) == ["z"]


class Stopping:
    """A file system that fails at one call, before it or after it has taken effect."""

    def __init__(self, files, at, after):
        self._files, self._left, self._after = files, at, after
        self.calls = 0

    def __getattr__(self, name):
        real = getattr(self._files, name)
        if name not in METHODS:
            return real

        def call(*args):
            self.calls += 1
            stop = self.calls == self._left
            if stop and not self._after:
                raise OSError("stopped")
            found = real(*args)
            if stop:
                raise OSError("stopped")
            return found

        return call


@pytest.mark.parametrize("after", [False, True])
def test_a_stop_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch, after):
    real = sinks._files
    start = str(tmp_path / "start")
    for values in (("old",), ("older", "two"), ("x", "y")):
        sinks.publish(frame(spark, *values), start, "parquet", abandoned_after=0)
    step = 0
    while True:
        step += 1
        path = str(tmp_path / f"t{step}")
        shutil.copytree(start, path)
        made = []

        def stopping(spark, where):
            files, root = real(spark, where)
            made.append(Stopping(files, step, after))
            return made[0], root

        monkeypatch.setattr(sinks, "_files", stopping)
        try:
            sinks.publish(frame(spark, "z"), path, "parquet", abandoned_after=0)
            finished = True
        except OSError:
            finished = False
        monkeypatch.setattr(sinks, "_files", real)
        assert rows(spark, path) in (["x", "y"], ["z"])
        # The next publish works and clears what was left.
        sinks.publish(frame(spark, "next"), path, "parquet", abandoned_after=0)
        assert rows(spark, path) == ["next"]
        names = [p.name for p in (tmp_path / f"t{step}").iterdir() if not p.name.endswith(".crc")]
        assert sum(n.startswith(sinks.VERSION) for n in names) == 2
        assert sum(n.startswith(sinks.CURRENT) for n in names) == 2
        if finished:
            assert step > 6
            break


def test_readers_of_the_version_before_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(frame(spark, "x"), path, "parquet")
    under_way = spark.read.parquet(sinks.current(spark, path))
    sinks.publish(frame(spark, "y"), path, "parquet")
    assert [r.a for r in under_way.collect()] == ["x"] and rows(spark, path) == ["y"]


def test_young_directories_of_other_jobs_stay(spark, tmp_path):
    path = tmp_path / "t"
    frame(spark, "half").write.parquet(str(path / f"{sinks.VERSION}other"))
    sinks.publish(frame(spark, "x"), str(path), "parquet")
    assert (path / f"{sinks.VERSION}other").exists()
    sinks.publish(frame(spark, "y"), str(path), "parquet", abandoned_after=0)
    assert not (path / f"{sinks.VERSION}other").exists()


def test_counts_are_those_of_what_was_written(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).selectExpr(
        "id", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 < 4 THEN 'quarantine' ELSE 'kept' END AS split"
    )
    path = str(tmp_path / "s")
    counts = sinks.write_counted_split(df, path, "parquet")
    assert counts == {"rows": 1000, "kept": 600, "quarantine": 300, "corrupt": 0, "no_key": 100}
    found = {r.split: r["count"] for r in spark.read.parquet(path).groupBy("split").count().collect()}
    assert found == {"kept": 600, "quarantine": 300}
    empty = sinks.write_counted_split(df.limit(0), str(tmp_path / "e"), "parquet")
    assert set(empty.values()) == {0}
