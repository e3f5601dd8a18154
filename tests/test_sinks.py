from __future__ import annotations

from datetime import date
from pathlib import Path

from conftest import rows

from loanlens.operators import sinks as K
from loanlens.session import forget, written


def test_upsert_replaces_keeps_and_adds(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, v int, kept string")
    batch = spark.createDataFrame([("a", 10), ("c", 30), (None, 33)], "k string, v int")
    once = K.upsert(target, batch, ["k"])
    assert rows(once) == [("a", 10, "x"), ("b", 2, "y"), ("c", 30, None), (None, 33, "z")]
    assert rows(K.upsert(once, batch, ["k"])) == rows(once)


def test_last_per_key(spark):
    batch = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("b", 5, "r")], "k string, d int, v string")
    assert rows(K.last_per_key(batch, ["k"], ["d"])) == [("a", 2, "q"), ("b", 5, "r")]


def test_deletes(spark):
    facts = spark.createDataFrame(
        [("Due", date(2001, 5, 31)), ("Due", date(2001, 6, 1)), ("Due", None), ("New", date(2001, 6, 1))],
        "Status string, Ref_Date date",
    )
    assert K.delete_status_window(facts, ["Due"], date(2001, 5, 31)).count() == 3
    metrics = spark.createDataFrame([("New Proj",), ("New",), ("Proj rate",)], "Metric string")
    assert rows(K.delete_projections(metrics)) == [("New",), ("Proj rate",)]
    left = K.delete_by_key(spark.range(4).withColumnRenamed("id", "n"), spark.range(2).withColumnRenamed("id", "n"), "n")
    assert rows(left) == [(2,), (3,)]


def test_rejects_name_the_first_missing_column(spark):
    table = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None)], "k string, v int")
    good, bad = K.split_rejects(table, ["k", "v"])
    assert rows(good) == [("a", 1)]
    assert [r[3] for r in rows(bad)].count("column k must not be null") == 2
    assert {r[2] for r in rows(bad)} == {"KEY_NULL"}


def test_versions_are_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "v1")
    K.write_version(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    try:
        K.write_version(spark.range(1), path)
    except Exception as error:
        assert "PATH_ALREADY_EXISTS" in str(error)
    else:
        raise AssertionError("a second version went to the same path")


def test_extract_as_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    K.write_extract(spark.createDataFrame([("", "a")], "x string, y string"), path)
    assert spark.read.option("header", "true").csv(path).columns == ["x", "y"]


def test_a_written_table_can_be_removed(spark):
    table = written(spark.range(5), "gone")
    folder = Path(table.inputFiles()[0].replace("file:", "").replace("///", "/")).parent
    assert folder.exists() and table.count() == 5
    forget(table)
    assert not folder.exists()
