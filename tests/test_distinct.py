import random

from pyspark.sql import functions as F

from shelfwatch.functions.distinct import count_bitmaps, count_distinct, distinct_bitmaps, merge_bitmaps


def test_counts_are_exact_and_merge_over_days(rows):
    r = random.Random(2)
    ids = [-40000, -1, 0, 1, 32767, 32768, 32769, 10**9, None]
    values = [(f"g{i % 3}" if i % 11 else None, i % 4, r.choice(ids)) for i in range(500)]
    df = rows("g string, day int, id bigint", *values)
    daily = distinct_bitmaps(df, ["g", "day"], "id")
    merged = {x.g: x.n for x in count_bitmaps(merge_bitmaps(daily, ["g"]), ["g"], "n").collect()}
    assert merged == {g: len({v[2] for v in values if v[0] == g and v[2] is not None}) for g in {v[0] for v in values}}
    per_day = {(x.g, x.day): x.n for x in count_bitmaps(daily, ["g", "day"], "n").collect()}
    assert per_day == {k: len({v[2] for v in values if v[:2] == k and v[2] is not None}) for k in {v[:2] for v in values}}
    assert sorted(x.distinct_count for x in count_distinct(df, ["g"], "id").collect()) == sorted(merged.values())
    assert count_distinct(df.where("id IS NULL"), ["g"], "id").count() == 0


def test_one_bitmap_per_group_reaches_the_shuffle(rows):
    df = rows("g string, id bigint", ("a", 1)).withColumn("id", F.col("id"))
    plan = distinct_bitmaps(df, ["g"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
