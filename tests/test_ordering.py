import pytest
from pyspark.sql import functions as F

from shelfwatch.operators.ordering import with_positions, write_ordered


def test_positions_are_those_of_one_sort(rows):
    values = [(i * 37 % 101, None if i % 5 == 0 else i % 7) for i in range(400)]
    df = rows("a int, b int", *values).repartition(6)
    got = {(r.a, r.b, r.position) for r in with_positions(df, ["a", F.desc_nulls_last("b")]).collect()}
    want = sorted(values, key=lambda v: (v[0], v[1] is None, -(v[1] or 0)))
    assert sorted(got, key=lambda r: r[2]) == [(a, b, i) for i, (a, b) in enumerate(want, 1)]


def test_equal_rows_share_no_position_and_are_spread(rows, spark):
    df = spark.range(5000).selectExpr("1 AS a")
    placed = with_positions(df, ["a"])
    assert placed.agg(F.count_distinct("position"), F.min("position"), F.max("position")).first() == (5000, 1, 5000)


def test_files_follow_each_other(rows, spark, tmp_path):
    df = rows("a int", *[(i * 7919 % 1000,) for i in range(1000)])
    write_ordered(df, [F.desc("a")], str(tmp_path / "out"))
    spans = spark.read.parquet(str(tmp_path / "out")).groupBy(F.input_file_name().alias("file")).agg(
        F.min("position").alias("low"), F.max("position").alias("high"), F.count("*").alias("n")
    ).orderBy("low").collect()
    assert [s.file for s in spans] == sorted(s.file for s in spans)
    assert all(s.high - s.low + 1 == s.n for s in spans) and spans[-1].high == 1000


def test_awkward_tables(rows, spark):
    assert with_positions(spark.createDataFrame([], "a int"), ["a"]).count() == 0
    assert with_positions(rows("a int", (None,), (1,)), [F.asc_nulls_last("a")]).where("position = 2").first().a is None
    with pytest.raises(ValueError):
        with_positions(rows("position int", (1,)), ["position"])
