"""What the plans of the registered queries may and may not contain."""

import os
import re

import pytest

import __spark_entry__ as entry
from shelfwatch.functions.quantiles import grouped_quantile
from shelfwatch.operators import dedup, listing, outliers
from shelfwatch.plans import analytics
from shelfwatch.sources import retail_tables

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
PAGES = {"pages_listing", "pages_detail", "collect_records"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_no_all_pairs_join_and_no_python(spark, name):
    text = plan(entry.own_queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert text.count("ArrowEvalPython") == (name in PAGES)


def test_latest_shrinks_before_the_shuffle_and_before_the_joins(spark):
    text = plan(retail_tables.latest_products(spark, FOLDER))
    scan, first_join = text.index("lineitem.parquet"), text.rindex("Join")
    assert text.rindex("partial_max(struct(") < scan
    assert first_join < text.rindex("partial_max(struct(")
    assert "l_returnflag" not in text
    unnamed = plan(retail_tables.latest_products(spark, FOLDER).drop("name"))
    assert "p_name" not in unnamed


def test_a_key_filter_reaches_the_scan(spark):
    lines = retail_tables.table(spark, FOLDER, "lineitem")
    text = plan(retail_tables.latest_lines(lines).where("l_partkey = 7"))
    assert "EqualTo(l_partkey,7)" in text


def test_date_filter_prunes_columns_and_rows(spark):
    rows = retail_tables.snapshots(spark, FOLDER).where("scraped_at >= TIMESTAMP_NTZ'2000-01-01'").select("product_id", "rating_stars")
    text = plan(rows)
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "l_extendedprice" not in text


def test_ranking_is_pruned_in_each_task(spark):
    orders = retail_tables.table(spark, FOLDER, "orders")
    text = plan(entry.listing_cap(orders))
    assert text.count("WindowGroupLimit") == 4


def test_limits_are_broadcast_by_size_and_rows_stay(spark):
    rows = retail_tables.snapshots(spark, FOLDER)
    text = plan(outliers.flag_outliers(rows))
    assert "SortMergeJoin" not in text and "hashpartitioning(category" not in text


def test_hot_group_is_counted_per_value_first(spark):
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', 'cold') AS g", "CAST(id % 97 AS DOUBLE) AS v")
    text = plan(grouped_quantile(rows, ["g"], "v", 0.5))
    first_shuffle = text.rindex("Exchange hashpartitioning(")
    assert re.match(r"Exchange hashpartitioning\(g#\d+, \S+#\d+,", text[first_shuffle:])


def test_rows_without_url_do_not_meet_in_one_task(spark):
    rows = spark.range(4000).selectExpr("id", "IF(id % 3 = 0, '', CONCAT('u', id)) AS product_url")
    details = rows.where("product_url <> ''").selectExpr("product_url", "'x' AS rating_stars")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = listing.enrich(rows, details, fields=["rating_stars"])
        sizes = [r["count"] for r in joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 4000 and max(sizes) < 1300


def test_hot_key_gives_one_row_per_task(spark):
    rows = spark.range(0, 9000, 1, 6).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS t")
    out = dedup.latest_per_key(rows, ["k"], "t")
    assert out.count() == rows.select("k").distinct().count()
    assert out.where("k = 7").first().t == 8997


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_null_profile_is_compiled_whatever_the_session(spark, capsys, threshold):
    """The JVM interprets a method beyond 8,000 bytes, row by row."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": threshold}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        entry.queries()["null_profile"](spark, FOLDER).explain("codegen")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
