import math

import numpy as np
import pytest
from conftest import column
from pyspark.sql import functions as F

from shelfwatch.operators import dedup, features, normalise, outliers, parsing, quality
from shelfwatch.plans import cleaning
from shelfwatch.schema import CLEAN_COLUMNS, RAW_COLUMNS


# -- row-level rules -----------------------------------------------------------------------


def test_missing_tokens(rows):
    texts = ["  Oban\t", "Undefined", " NaN", "   ", "nan value", "Null", None]
    df = rows("i int, brand string", *enumerate(texts))
    assert column(normalise.standardize_missing(df), "brand", "i") == ["Oban", None, None, None, "nan value", None, None]


def test_missing_tokens_of_ones_own(rows):
    df = rows("i int, brand string", *enumerate([" TBC ", "nan", "", None]))
    assert column(normalise.standardize_missing(df, tokens=["tbc"]), "brand", "i") == [None, "nan", "", None]
    assert column(normalise.standardize_missing(df, tokens=[]), "brand", "i") == ["TBC", "nan", "", None]


def test_brands(rows):
    texts = ["CHIVAS", "chivas   REGAL", "Secret distillery ", "Talisker  Bay", "chivas extra", None]
    out = normalise.standardize_brands(rows("i int, brand string", *enumerate(texts)))
    assert column(out, "brand", "i") == ["Chivas Regal", "Chivas Regal", "Independent/Unknown", "Talisker Bay", "chivas extra", None]
    assert column(out, "is_brand_placeholder", "i") == [False, False, True, False, False, None]


REGIONS = "i int, category string, region string, fact_region string"


def test_invalid_regions(rows):
    df = rows(REGIONS, (0, "single malt", " CAMPBELTOWN", None), (1, "Single Malt", "Wales", None), (2, "BLENDED", "Lowland", None), (3, "Grain", "Wales", None))
    out = normalise.clean_regions(df)
    assert column(out, "region", "i") == ["Campbeltown", None, None, "Wales"]
    assert "fact_region" not in out.columns


def test_region_fallback(rows):
    df = rows(
        REGIONS,
        (0, "Single Malt", None, "speyside"),
        (1, "Blended", "Islay", "the islands"),
        (2, None, " The Islands", None),
        (3, "Single Malt", "ISLANDS", "x"),
        (4, "Single Malt", "nowhere", "anything goes"),
    )
    assert column(normalise.clean_regions(df), "region", "i") == ["Speyside", "Island", "Island", "Island", "Anything goes"]


def test_vat_fallback(rows):
    df = rows("i int, price_ex_vat_gbp double, price_inc_vat_gbp double", (0, 37.5, None), (1, 12.34, 99.0), (2, None, None), (3, None, 8.0))
    assert column(parsing.vat_fallback(df), "price_inc_vat_gbp", "i") == [45.0, 99.0, None, 8.0]
    assert df.agg(parsing.vat_filled().alias("n")).first().n == 1


def test_bottle_and_abv(rows):
    texts = ["35cl / 57.1%", "1.75l / 37.5%", "50ml / 62%", "70CL / 40%", "12 large 70cl", "0.7 litre", "n/a", None]
    out = parsing.parse_bottle_and_abv(rows("i int, variant string", *enumerate(texts)))
    assert column(out, "bottle_size_cl", "i") == [35.0, 175.0, 5.0, None, 1200.0, 70.0, None, None]
    assert column(out, "abv_percent", "i") == [57.1, 37.5, 62.0, 40.0, None, None, None, None]
    assert set(out.columns) == {"i", "variant", "abv_percent", "bottle_size_l", "bottle_size_cl"}


def test_unit_price(rows):
    texts = ["£64.20/ltr", "£14.00 per 35cl", "(£1,012.50 per litre)", "£9 per 0cl", "£8 per cl", "£30 per 2 litre", "£5 / 500 ml", "POA", None]
    out = parsing.parse_unit_price(rows("i int, unit_price_raw string", *enumerate(texts)))
    assert column(out, "unit_price_gbp_per_litre", "i") == [64.2, 40.0, 1012.5, None, 8.0, 15.0, 10.0, None, None]


def test_unit_price_fallback(rows):
    df = rows("i int, unit_price_gbp_per_litre double, price_inc_vat_gbp double, bottle_size_l double",
              (0, None, 50.0, 0.7), (1, 9.0, 50.0, 0.7), (2, None, 50.0, 0.0), (3, None, 50.0, None))
    assert column(parsing.unit_price_fallback(df), "unit_price_gbp_per_litre", "i") == [71.43, 9.0, None, None]


PRICES = "i int, price_before_discount_gbp double, price_inc_vat_gbp double, bottle_size_l double, abv_percent double"


def test_price_features(rows):
    df = rows(PRICES, (0, 100.0, 90.0, 0.7, 40.0), (1, 200.0, 200.0, 0.7, 40.0), (2, None, 30.0, 0.0, 40.0),
              (3, 1000.0, 999.96, 0.7, None), (4, 10.0, 12.0, 0.7, 40.0))
    out = features.discount_features(features.price_features(df))
    assert column(out, "is_discounted", "i") == [True, False, False, True, False]
    assert column(out, "price_tier", "i") == ["Premium", "Luxury", "Budget", "Luxury", "Budget"]
    assert column(out, "discount_percent", "i") == [10.0, 0.0, 0.0, 0.0, 0.0]
    assert column(out, "discount_band", "i") == ["Low (≤10%)"] + ["No Discount"] * 4
    assert column(out, "alcohol_units", "i") == [28.0, 28.0, None, None, 28.0]
    assert column(out, "price_per_alcohol_unit_gbp", "i") == [3.57, 7.14, None, None, 0.36]


def test_age_and_cask(rows):
    df = rows("i int, name string, bottle_size_l double, abv_percent double",
              (0, "Oban 14 years old", 0.7, 43.0), (1, "Talisker 8yo", 0.35, 45.8), (2, "Nameless Malt", 0.75, 57.0),
              (3, "0 years old", None, None), (4, "1812 Years", 0.34, 50.0))
    out = features.band_features(features.age_feature(df))
    assert column(out, "age_years", "i") == [14, 8, None, 0, None]
    assert column(out, "is_age_stated", "i") == [True, True, False, True, False]
    assert column(out, "age_band", "i") == ["11–15", "≤10", None, None, None]
    assert column(out, "is_cask_strength", "i") == [False, False, True, False, True]
    assert column(out, "is_standard_bottle", "i") == [True, False, True, False, False]
    assert column(out, "is_comparable_bottle", "i") == [True, True, True, False, False]


def test_no_break_blanks_in_texts(rows):
    out = parsing.parse_bottle_and_abv(rows("i int, variant string", (0, "70\xa0cl / 40\xa0%")))
    assert (column(out, "bottle_size_cl"), column(out, "abv_percent")) == ([70.0], [40.0])
    assert column(features.age_feature(rows("name string", ("Glen 12\xa0Year Old",))), "age_years") == [12]


def test_infinities_become_null(rows):
    df = rows("i int, a double, b string", (0, float("inf"), "x"), (1, float("-inf"), "x"), (2, float("nan"), "x"), (3, 1.5, "x"))
    assert column(normalise.null_infinities(df), "a", "i") == [None, None, None, 1.5]


# -- dedup ----------------------------------------------------------------------------------

SNAP = "product_id bigint, price double, scraped_at timestamp_ntz"


def at(day):
    import datetime

    return None if day is None else datetime.datetime(2026, 1, day)


def test_exact_dedup_keeps_the_earliest_and_treats_null_as_equal(rows):
    df = rows(SNAP, (1, 5.0, at(2)), (1, 5.0, at(1)), (1, None, at(3)), (1, None, at(4)), (2, 5.0, None), (2, 5.0, at(9)))
    got = sorted((r.product_id, r.price or 0, r.scraped_at.day) for r in dedup.exact_dedup(df).collect())
    assert got == [(1, 0, 3), (1, 5.0, 1), (2, 5.0, 9)]


def test_price_going_back_to_an_old_value(rows):
    df = rows(SNAP, (1, 10.0, at(1)), (1, 12.0, at(2)), (1, 10.0, at(3)))
    assert column(dedup.dedup_snapshots(df, exact=True), "price") == [12.0]
    assert column(dedup.dedup_snapshots(df, exact=False), "price") == [10.0]


def test_latest_null_rules(rows):
    df = rows(SNAP, (1, 1.0, at(5)), (1, 2.0, None), (None, 3.0, at(1)), (None, 4.0, at(2)))
    last = dedup.latest_per_key(df, ["product_id"], "scraped_at")
    first = dedup.latest_per_key(df, ["product_id"], "scraped_at", nulls="first")
    assert {r.product_id: r.price for r in last.collect()} == {1: 1.0, None: 4.0}
    assert {r.product_id: r.price for r in first.collect()} == {1: 2.0, None: 4.0}
    assert last.columns == df.columns
    with pytest.raises(ValueError):
        dedup.latest_per_key(df, ["product_id"], "scraped_at", nulls="middle")


def test_latest_breaks_ties_the_same_way_in_any_order(spark, rows):
    values = [(k % 7, float(k % 13), at(1 + k % 3)) for k in range(300)]
    forward = dedup.latest_per_key(rows(SNAP, *values), ["product_id"], "scraped_at")
    backward = dedup.latest_per_key(rows(SNAP, *values[::-1]).repartition(7), ["product_id"], "scraped_at")
    assert sorted(forward.collect()) == sorted(backward.collect())
    assert forward.count() == 7


def test_top_per_group(rows):
    df = rows("g string, v int", *[("a", i) for i in range(9)], ("b", 1))
    out = dedup.top_per_group(df, ["g"], [F.desc("v")], 3)
    assert sorted((r.g, r.v) for r in out.collect()) == [("a", 6), ("a", 7), ("a", 8), ("b", 1)]


# -- typing, profiles, outliers --------------------------------------------------------------


def raw_row(**cells):
    defaults = dict.fromkeys(RAW_COLUMNS, "")
    defaults |= {
        "scraped_at": "2026-01-16 09:00:00", "category": "Single Malt", "product_id": "1", "name": "Glen 12 Year Old",
        "brand": "Glen", "variant": "70cl / 43%", "price_ex_vat_gbp": "50", "unit_price_raw": "£85.71 per litre",
        "region": "Islay", "status": "In Stock", "rating_stars": "4.5", "review_count": "10",
    }
    defaults |= cells
    return tuple(defaults[c] for c in RAW_COLUMNS)


@pytest.fixture
def raw(rows):
    def make(*cells):
        return rows(", ".join(f"{c} string" for c in RAW_COLUMNS), *[raw_row(**c) for c in cells])

    return make


def test_enforce_schema_and_rejects(raw):
    df = raw({}, {"product_id": "2.0", "review_count": "12.5", "rating_stars": "n/a", "scraped_at": "soon"}, {"price_ex_vat_gbp": "5d"})
    typed = normalise.enforce_schema(df)
    assert dict(typed.dtypes)["scraped_at"] == "timestamp_ntz"
    assert dict(typed.dtypes)["product_id"] == "bigint"
    assert dict(typed.dtypes)["price_ex_vat_gbp"] == "double"
    assert sorted(column(typed, "product_id")) == [1, 1, 2]
    rejected = {r.column_name: r.rejected for r in normalise.rejected_cells(df).collect() if r.rejected}
    assert rejected == {"scraped_at": 1, "review_count": 1, "price_ex_vat_gbp": 1}


def test_constant_columns(rows):
    df = rows("a int, b int, c int, d int", (1, None, 1, 1), (1, None, None, 2))
    assert quality.constant_columns(df, df.columns) == ["a", "b"]
    assert quality.drop_constant_columns(df, ["a", "c", "zz"]).columns == ["b", "c", "d"]


def test_profiles_and_audits(rows):
    df = rows("k int, v string", (1, "x"), (1, None), (2, None), (None, "x"))
    assert [(r.column_name, r.null_count) for r in quality.null_profile(df).collect()] == [("v", 2), ("k", 1)]
    assert [(r.v, r.row_count) for r in quality.value_counts(df, "v").collect()] == [(None, 2), ("x", 2)]
    assert [(r.k, r.row_count) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert tuple(quality.uniqueness(df, ["k"]).first()) == (False, 3, 1)
    parent = rows("k int", (1,))
    assert [(r.k, r.row_count) for r in quality.orphan_keys(df, "k", parent).collect()] == [(2, 1)]
    assert quality.leftover_helpers(rows("a_raw int, b int, x_calc_y int", (1, 1, 1))) == ["a_raw", "x_calc_y"]
    count, preview = quality.load_check(df, 2)
    assert (count, preview.count()) == (4, 2)


def test_outlier_flags(spark):
    many = spark.range(100).selectExpr("'a' AS category", "CAST(id AS DOUBLE) AS price_inc_vat_gbp", "1.0D AS price_per_alcohol_unit_gbp")
    few = spark.range(29).selectExpr("'b'", "CAST(id * 1000 AS DOUBLE)", "CAST(id AS DOUBLE)")
    none = spark.range(40).selectExpr("CAST(NULL AS STRING)", "CAST(id AS DOUBLE)", "CAST(id AS DOUBLE)")
    out = outliers.flag_outliers(many.union(few).union(none))
    assert out.count() == 169
    flagged = out.where("is_outlier").collect()
    assert [(r.category, r.price_inc_vat_gbp, r.is_price_outlier, r.is_value_outlier) for r in flagged] == [("a", 99.0, True, False)]
    assert out.where("is_price_outlier IS NULL OR is_value_outlier IS NULL OR is_outlier IS NULL").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_outlier_limits_against_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {"a": rng.lognormal(3, 1, 997).round(2), "b": rng.normal(0, 50, 250), "c": np.repeat(rng.uniform(0, 9, 5), 40), "d": np.array([7.0])}
    data = [(g, float(v), float(v) / 2 if i % 3 else None) for g, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "category string, price_inc_vat_gbp double, price_per_alcohol_unit_gbp double").repartition(5)
    got = {r.category: r for r in outliers.outlier_limits(df, q=0.9, min_values=0).collect()}
    for g, vs in groups.items():
        halves = [v / 2 for i, v in enumerate(vs) if i % 3]
        assert math.isclose(got[g]["_limit_price_inc_vat_gbp"], np.quantile(vs, 0.9), rel_tol=1e-12, abs_tol=1e-12)
        if halves:
            assert math.isclose(got[g]["_limit_price_per_alcohol_unit_gbp"], np.quantile(halves, 0.9), rel_tol=1e-12, abs_tol=1e-12)


# -- the whole job ---------------------------------------------------------------------------


def test_clean_products(raw):
    df = raw(
        {"scraped_at": "2026-01-15", "price_ex_vat_gbp": "40"},
        {"scraped_at": "2026-01-16", "price_before_discount_gbp": "75"},
        {"scraped_at": "2026-01-17", "price_before_discount_gbp": "75"},
        {"product_id": "2", "category": "Blended", "brand": "secret distillery", "variant": "", "unit_price_raw": "", "name": "Old Blend",
         "character_notes": " Malt | Peat|", "fact_region": "N/A"},
    )
    out = cleaning.clean_products(df)
    assert out.columns == [*CLEAN_COLUMNS, "status"]
    one, two = out.orderBy("product_id").collect()
    # The copy of the 16th is the same row, so the time stays the earlier one.
    assert str(one.scraped_at) == "2026-01-16 00:00:00"
    assert (one.price_inc_vat_gbp, one.reference_price_gbp, one.discount_amount_gbp, one.discount_percent) == (60.0, 75.0, 15.0, 20.0)
    assert (one.discount_band, one.price_tier, one.age_band, one.abv_band) == ("Medium (10–20%)", "Premium", "11–15", "40–43%")
    assert (one.bottle_size_l, one.alcohol_units, one.price_per_alcohol_unit_gbp, one.unit_price_gbp_per_litre) == (0.7, 30.1, 2.49, 85.71)
    assert (two.brand, two.is_brand_placeholder, two.region, two.character_notes) == ("Independent/Unknown", True, None, "Malt|Peat")
    assert (two.bottle_size_l, two.unit_price_gbp_per_litre, two.is_comparable_bottle, two.is_cask_strength) == (None, None, False, False)
    assert not one.is_outlier and not two.is_outlier


def test_run_cleaning_drops_a_constant_status_and_counts(raw):
    result, summary = cleaning.run_cleaning(
        raw({}, {}, {"scraped_at": "2026-01-15", "brand": "x"},
            {"product_id": "2", "price_inc_vat_gbp": "80", "price_before_discount_gbp": "90", "region": "", "fact_region": "islay", "unit_price_raw": ""})
    )
    assert result.columns == CLEAN_COLUMNS
    assert summary == {
        "rows_read": 4, "rows_without_copies": 3, "region_filled": 1, "vat_filled": 1, "unit_price_filled": 1,
        "rows": 2, "discounted": 1, "without_price": 0, "outliers": 0,
    }
    kept, _ = cleaning.run_cleaning(raw({}, {"product_id": "2", "status": "Sold Out"}))
    assert kept.columns == [*CLEAN_COLUMNS, "status"]


def test_cleaning_time_rules(raw):
    df = raw({"scraped_at": "soon", "price_ex_vat_gbp": "1"}, {"price_ex_vat_gbp": "2"})
    assert column(cleaning.clean_products(df), "price_ex_vat_gbp") == [2.0]
    assert column(cleaning.clean_products(df, nulls="first"), "price_ex_vat_gbp") == [1.0]
