from shelfwatch.operators import dedup
from shelfwatch.session import materialise


def test_near_newest_keeps_every_newest_row(spark):
    df = spark.range(0, 6000).selectExpr(
        "nullif(id % 300, 7) AS k", "CASE WHEN id % 11 <> 0 THEN id div 900 END AS t", "CAST(id AS STRING) AS text"
    )
    for nulls in ("last", "first"):
        near = dedup.near_newest(df, ["k"], "t", nulls)
        got = {tuple(r) for r in dedup.latest_per_key(near, ["k"], "t", nulls=nulls).collect()}
        assert got == {tuple(r) for r in dedup.latest_per_key(df, ["k"], "t", nulls=nulls).collect()}
        assert near.count() < 2500  # the wide rows that go on


def test_keys_without_any_time_stay(rows):
    df = rows("k long, t long, text string", (1, None, "a"), (1, None, "b"), (None, None, "c"), (2, 5, "d"), (2, 4, "e"))
    got = sorted((tuple(r) for r in dedup.near_newest(df, ["k"], "t").collect()), key=str)
    assert got == [(1, None, "a"), (1, None, "b"), (2, 5, "d"), (None, None, "c")]


def test_newest_distinct_equals_both_steps(spark, rows):
    df = rows(
        "k long, t long, a string, b string",
        (1, 1, "A", None), (1, 2, "B", None), (1, 3, "A", None),  # A, B, A: B is newest
        (1, 2, None, "B"),  # no copy of B: another column is NULL
        (2, None, "A", "x"), (2, 4, "A", "x"), (2, None, "C", "x"),
        (None, 7, "n", None), (None, 7, "n", None), (None, 7, None, "n"),
        (3, None, "a", "a"), (3, None, "b", "a"),
    )
    many = spark.range(0, 4000).selectExpr("id % 200 AS k", "id % 37 AS t", "CAST(id % 9 AS STRING) AS a", "nullif(CAST(id % 5 AS STRING), '3') AS b")
    for given in (df, many):
        for nulls in ("last", "first"):
            seen = []
            got = dedup.newest_distinct(given, ["k"], "t", nulls, watch=lambda sets: seen.append(sets.count()) or sets)
            want = dedup.latest_per_key(dedup.exact_dedup(given, "t"), ["k"], "t", nulls=nulls)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            assert seen == [dedup.exact_dedup(given, "t").count()]
    assert got.columns == df.columns


def test_no_wide_row_is_shuffled_before_the_newest_are_known(spark):
    staged = []

    def stage(df, label):
        staged.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label)

    wide = spark.range(0, 100).selectExpr("id % 10 AS k", "id AS t", *[f"CAST(id AS STRING) AS c{i}" for i in range(9)])
    dedup.newest_distinct(wide, ["k"], "t", stage=stage)
    aggregates = [line for line in staged[0].splitlines() if "Aggregate(keys" in line]
    assert aggregates and all("HashAggregate" in line and "c8" not in line for line in aggregates)
