import datetime as dt

import pytest
from pyspark.sql import functions as F

from fadecast.operators import clean, splits
from fadecast.operators.ordered import file_positions
from fadecast.sources import files

A, B = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
LOG = "row_id long, datetime timestamp_ntz, value int"


@pytest.mark.parametrize("size", [1, 2, 100])
@pytest.mark.parametrize("parts", [1, 3])
def test_repair_restarts_for_a_value_that_comes_back(spark, size, parts):
    rows = [(0, A, 1), (1, A, 2), (2, B, 3), (3, A, 4), (4, A, 5), (5, A, 6)]
    df = spark.createDataFrame(rows, LOG).repartition(parts)
    got = clean.repair_timestamps(df, [], "row_id", size=size, ordinals=size).orderBy("row_id").collect()
    add = [(r["repaired"] - r["datetime"]).total_seconds() for r in got]
    assert add == [0, 15, 0, 0, 15, 30]


def test_keep_first(spark):
    rows = [(3, A, 4), (0, A, 1), (2, B, 3), (1, A, 2)]
    got = clean.keep_first(spark.createDataFrame(rows, LOG), ["datetime"], "row_id").collect()
    assert sorted((r["row_id"], r["value"]) for r in got) == [(0, 1), (2, 3)]


def test_rows_at_counts_from_both_ends(spark):
    df = spark.createDataFrame([(i * 7, A, i) for i in range(5)], LOG)
    got = clean.rows_at(df, [], "row_id", {"first": 0, "last": -1, "second_last": -2, "none": 9}, size=3)
    assert sorted((r["label"], r["value"]) for r in got.collect()) == [("first", 0), ("last", 4), ("second_last", 3)]


def test_one_row_may_carry_several_labels(spark):
    df = spark.createDataFrame([(1, A, 1)], LOG)
    got = clean.rows_at(df, [], "row_id", {"first": 0, "last": -1}).collect()
    assert sorted(r["label"] for r in got) == ["first", "last"]


def test_parse_time(spark):
    df = spark.createDataFrame([("12/31/2016 0:00",), ("1/2/2017 13:00",), (None,)], "ds string")
    got = [r[0] for r in df.select(files.parse_time("ds", [files.US_DATES])).collect()]
    assert got == [dt.datetime(2016, 12, 31), dt.datetime(2017, 1, 2, 13), None]
    bad = spark.createDataFrame([("soon",)], "ds string")
    assert bad.select(files.parse_time("ds", [files.US_DATES], strict=False)).collect()[0][0] is None
    with pytest.raises(Exception, match="not a timestamp"):
        bad.select(files.parse_time("ds", [files.US_DATES])).collect()


def test_partial_date(spark):
    df = spark.createDataFrame([(1, dt.datetime(2017, 11, 30, 23)), (2, dt.datetime(2017, 12, 1))], "i int, ds timestamp_ntz")
    assert [r["i"] for r in df.filter(clean.time_from("ds", "2017-12")).collect()] == [2]
    assert df.filter(clean.time_from("ds", "2017")).count() == 2


def test_csv_keeps_types_and_line_order(spark, tmp_path):
    path = str(tmp_path / "elec")
    rows = [("DE", A, 1.5, 1.0, None), ("DE", B, None, 2.0, 3.0)]
    df = spark.createDataFrame(rows, files.ELECTRICITY_SCHEMA).coalesce(1)
    files.write_csv(df, path)
    back = files.read_csv(spark, path, files.ELECTRICITY_SCHEMA, file_order=True)
    got = file_positions(back).orderBy("pos").select(*df.columns, "pos").collect()
    assert [tuple(r)[:5] for r in got] == rows and [r["pos"] for r in got] == [0, 1]


@pytest.mark.parametrize("n, sizes", [(10, (8, 1, 1)), (11, (8, 1, 2)), (19, (15, 1, 3))])
@pytest.mark.parametrize("gap", [0, 1])
def test_split_sizes(spark, n, sizes, gap):
    df = spark.createDataFrame([(i, A, i) for i in range(n)], LOG).repartition(3)
    got = splits.split_by_position(df, [], "row_id", gap=gap, size=4)
    count = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert count.get("train") == sizes[0] and count.get("test") == sizes[2]
    assert count.get("val", 0) == sizes[1] - gap
    assert sum(count.values()) == n - gap
    if gap:
        assert got.filter(F.col("pos") == sizes[0]).count() == 0


def test_split_per_key_and_by_time(spark):
    rows = [(k, i, A + dt.timedelta(hours=20 - i)) for k in "ab" for i in range(10)]
    df = spark.createDataFrame(rows, "k string, row_id long, ts timestamp_ntz")
    by_file = splits.split_by_position(df, ["k"], "row_id")
    assert {r["row_id"] for r in by_file.filter("split = 'test'").collect()} == {9}
    by_time = splits.split_by_position(df, ["k"], "row_id", by_time="ts")
    assert {r["row_id"] for r in by_time.filter("split = 'test'").collect()} == {0}


def test_split_boundaries(spark):
    rows = [(i, A + dt.timedelta(days=i), i) for i in range(20)]
    s = splits.split_by_position(spark.createDataFrame(rows, LOG), [], "row_id", gap=1)
    r = splits.split_boundaries(s, [], "datetime").collect()[0]
    assert (r["n_train"], r["n_val"], r["n_test"]) == (16, 1, 2)
    assert r["second_last_train"] == A + dt.timedelta(days=14)
    assert r["first_val"] == r["min_val"] == A + dt.timedelta(days=17)
