import pytest
from pyspark.sql import functions as F

from shelfwatch.plans import warehouse
from shelfwatch.schema import CLEAN_COLUMNS, FACT_DECIMALS, PRODUCT_FLAGS, SNAPSHOT_COLUMNS
from shelfwatch.sources import catalog

TIERS = ["Budget", "Premium", "Luxury"]
BANDS = ["No Discount", "Low (≤10%)", "Medium (10–20%)", "High (20–40%)", "Very High (>40%)", None]


def landing_cells():
    """40 snapshots of 9 products: every tier and band, gaps, odd ids and times, same-day scrapes."""
    out = []
    for i in range(36):
        product = i % 9
        out.append(
            {
                "scraped_at": f"2026-01-{1 + i // 9:02d} {8 + i % 2:02d}:00:00",
                "product_id": f"{product}.0" if i % 4 == 3 else str(product),
                "name": f"Glen {product}",
                "brand": "Glen",
                "category": "Single Malt" if product else None,
                "region": f"R{i // 9}",
                "price_inc_vat_gbp": f"{20 + 7 * i}.505",
                "rating_stars": "4.25",
                "review_count": "123456789012" if i == 0 else "12.0",
                "is_discounted": ["True", "f", "perhaps"][i % 3],
                "is_standard_bottle": "YES",
                "price_tier": TIERS[i % 3],
                "discount_band": BANDS[i % 6],
                "bottle_size_l": "0.7",
                "age_years": str(product),
            }
        )
    out.append({"scraped_at": "2026-01-09 10:00:00", "product_id": "3", "name": "Glen 3 early", "price_inc_vat_gbp": "1"})
    out.append({"scraped_at": "2026-01-09 18:00:00", "product_id": "3", "name": "Glen 3 late", "price_inc_vat_gbp": "2"})
    out.append({"scraped_at": "soon", "product_id": "4", "name": "Glen 4 unread"})
    out.append({"scraped_at": "2026-01-02", "product_id": "abc", "name": "no id"})
    return out


@pytest.fixture(scope="module")
def raw(spark):
    cells = landing_cells()
    values = [tuple(c.get(n) for n in CLEAN_COLUMNS) for c in cells]
    return spark.createDataFrame(values, ", ".join(f"{n} string" for n in CLEAN_COLUMNS))


@pytest.fixture(scope="module")
def star(spark, raw):
    catalog.create_layers(spark)
    return catalog.write_star(spark, raw)


def test_dimensions(star):
    days = {r.date_key: r for r in star["dim_date"].collect()}
    assert sorted(days) == [20260101, 20260102, 20260103, 20260104, 20260109]
    assert days[20260109].day_name == "Fri" and days[20260109].week == 2
    assert [tuple(r) for r in star["dim_price_tier"].orderBy("price_tier_key").collect()] == [(1, "Budget"), (2, "Luxury"), (3, "Premium")]
    assert star["dim_discount_band"].count() == 5
    products = {r.product_id: r for r in star["dim_product"].collect()}
    assert sorted(products) == list(range(9))
    assert products[3].name == "Glen 3 late"
    assert products[4].name == "Glen 4" and products[4].region == "R3"
    assert products[0].is_standard_bottle is True and str(products[0].bottle_size_l) == "0.700"


def test_fact(star):
    fact = star["fact_product_snapshot"]
    assert fact.count() == 38
    assert fact.select("snapshot_key").distinct().count() == 38
    first = fact.where("product_key = 0 AND date_key = 20260101").first()
    assert first.review_count is None
    assert str(first.price_inc_vat_gbp) == "20.51"
    assert {r.is_discounted for r in fact.where("price_tier_key IS NOT NULL").collect()} == {True, False, None}
    assert fact.where("discount_band_key IS NULL").count() == 6 + 2


def test_warehouse_types(star):
    fact = dict(star["fact_product_snapshot"].dtypes)
    assert (fact["date_key"], fact["product_key"], fact["snapshot_ts"]) == ("int", "bigint", "timestamp_ntz")
    assert {fact[c] for c in FACT_DECIMALS} == {"decimal(10,2)", "decimal(10,4)", "decimal(6,2)", "decimal(4,2)", "decimal(10,0)"}
    product = dict(star["dim_product"].dtypes)
    assert {product[c] for c in PRODUCT_FLAGS} == {"boolean"}
    assert (product["bottle_size_l"], product["age_years"], product["style_body"]) == ("decimal(10,3)", "decimal(5,0)", "decimal(2,0)")
    assert dict(star["dim_date"].dtypes)["full_date"] == "date"


def test_star_join_keeps_every_fact(star):
    snapshot = warehouse.product_snapshot(star)
    assert snapshot.columns == [*SNAPSHOT_COLUMNS, "snapshot_ts"]
    assert snapshot.count() == star["fact_product_snapshot"].count()


def test_latest_before_or_after_the_join_is_the_same(star):
    early = warehouse.product_latest(star)
    late = warehouse.latest_of(warehouse.product_snapshot(star))
    assert sorted(early.select(sorted(early.columns)).collect(), key=str) == sorted(late.select(sorted(early.columns)).collect(), key=str)
    assert early.count() == early.select("product_id").distinct().count() == 9
    # Two scrapes on one day: the later one is current.
    assert str(early.where("product_id = 3").first().price_inc_vat_gbp) == "2.00"


def test_audits_are_clean_and_find_damage(star):
    assert warehouse.audit_unique(star).where("NOT is_unique OR surplus_rows > 0").count() == 0
    assert warehouse.audit_foreign_keys(star).where("orphan_rows > 0").count() == 0
    assert warehouse.audit_not_null(star).where("null_count > 0").count() == 0
    damaged = dict(star)
    damaged["dim_product"] = star["dim_product"].where("product_id <> 5").withColumn("name", F.lit(None).cast("string"))
    damaged["dim_price_tier"] = star["dim_price_tier"].unionAll(star["dim_price_tier"].limit(1))
    assert {(r.dimension, r.orphan_rows) for r in warehouse.audit_foreign_keys(damaged).where("orphan_rows > 0").collect()} == {("dim_product", 4)}
    assert warehouse.audit_unique(damaged).where("NOT is_unique").count() == 2
    assert [(r.column_name, r.null_count) for r in warehouse.audit_not_null(damaged).where("null_count > 0").collect()] == [("name", 8)]


def test_fact_against_foreign_products(raw, star):
    some = star["dim_product"].where("product_id < 3")
    fact = warehouse.load_fact(raw, star["dim_price_tier"], star["dim_discount_band"], some)
    assert {r.product_key for r in fact.select("product_key").distinct().collect()} == {0, 1, 2}


def test_reload_replaces_and_views_work(spark, raw, star):
    again = catalog.write_star(spark, raw)
    assert again["fact_product_snapshot"].count() == 38
    published = catalog.publish_latest(spark, again)
    assert published.count() == 9
    catalog.create_views(again, published, "v_")
    assert spark.sql("SELECT count(*) FROM v_product_latest").first()[0] == 9
    assert spark.sql("SELECT count(*) FROM v_product_snapshot").first()[0] == 38
    assert spark.sql("SELECT count(*) FROM v_price_premium WHERE factor = 'Overall Baseline'").first()[0] == 1
    spark.sql("SELECT * FROM v_top_ratings").collect()
    spark.sql("SELECT * FROM v_age_roi").collect()
    pruned = spark.table("curated.fact_product_snapshot").where("date_key = 20260109")
    assert "PartitionFilters: [isnotnull(date_key" in pruned._jdf.queryExecution().toString()


def test_landing_matches_names_in_any_case(rows):
    out = warehouse.to_landing(rows("NAME string, Product_ID int, other int", ("x", 7, 1)))
    assert out.columns == CLEAN_COLUMNS
    row = out.first()
    assert (row["name"], row["product_id"], row["brand"]) == ("x", "7", None)


def test_small_dimensions_reach_the_fact_without_a_shuffle(star):
    plan = warehouse.product_snapshot(star)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_ties_in_time_are_settled_by_the_measures(spark, rows):
    def latest(*prices):
        landing = warehouse.to_landing(rows(
            "scraped_at string, product_id string, name string, price_inc_vat_gbp string, price_tier string, discount_band string",
            *[("2026-01-16 09:00:00", "1", "n", str(p), "Budget", "No Discount") for p in prices],
        ))
        return [float(r.price_inc_vat_gbp) for r in warehouse.product_latest(warehouse.build_star(landing)).collect()]

    assert latest(10, 20) == latest(20, 10) == [20.0]


def test_landing_rows_are_read_once(rows):
    landing = warehouse.to_landing(rows("scraped_at string, product_id string, name string", ("2026-01-16", "1", "n")))
    star = warehouse.build_star(landing)
    for name, table in star.items():
        assert all("landing" in f or "labels" in f or "dim-product" in f or "fact" in f for f in table.inputFiles()), name


def test_the_fact_is_counted_after_it_is_dealt(spark, rows):
    cells = [tuple(c.get(n) for n in CLEAN_COLUMNS) for c in landing_cells()]
    raw = rows(", ".join(f"{c} string" for c in CLEAN_COLUMNS), *cells)
    small = warehouse.small_dimensions(raw)
    fact = warehouse.load_fact(raw, small["dim_price_tier"], small["dim_discount_band"])
    plan = fact._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(date_key" in line]
    assert len(wide) == 1 and "REPARTITION_BY_COL" in wide[0]  # no second exchange, no count ahead of the first


def test_each_foreign_key_is_counted_alone(rows):
    star = {
        "fact_product_snapshot": rows(
            "date_key int, product_key long, price_tier_key long, discount_band_key long",
            (1, 1, 1, None), (2, 1, 1, 1), (2, 9, None, 1), (None, 9, 3, 1),
        ),
        "dim_date": rows("date_key int", (1,), (1,)),
        "dim_product": rows("product_key long", (1,), (2,)),
        "dim_price_tier": rows("price_tier_key long", (1,)),
        "dim_discount_band": rows("discount_band_key long", (1,)),
    }
    found = warehouse.audit_foreign_keys(star)
    assert [tuple(r) for r in found.collect()] == [("dim_date", 2), ("dim_product", 2), ("dim_price_tier", 1), ("dim_discount_band", 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "keys=[date_key" in plan and not [line for line in plan.splitlines() if "keys=[date_key" in line and "product_key" in line]


def test_a_fact_not_laid_out_by_date_is_written_as_it_was_dealt(spark, rows, monkeypatch):
    raw = rows(", ".join(f"{c} string" for c in CLEAN_COLUMNS), *[tuple(c.get(n) for n in CLEAN_COLUMNS) for c in landing_cells()])
    hints, hint = [], type(raw).hint
    monkeypatch.setattr(type(raw), "hint", lambda df, name, *rest: hints.append(name) or hint(df, name, *rest))
    catalog.create_layers(spark, ["dealt_once"])
    star = catalog.write_star(spark, raw, "dealt_once", by_date=False)
    assert star["fact_product_snapshot"].count() > 0 and hints == []


def test_a_full_reload_goes_in_slices_and_leaves_nothing_staged(spark, rows, monkeypatch):
    from shelfwatch import session

    raw = rows(", ".join(f"{c} string" for c in CLEAN_COLUMNS), *[tuple(c.get(n) for n in CLEAN_COLUMNS) for c in landing_cells()])
    want = warehouse.build_star(raw)
    monkeypatch.setattr(catalog, "ROWS_AT_ONCE", 10)
    catalog.create_layers(spark, ["in_slices"])
    before = list(session._stages.get(spark.sparkContext.applicationId, []))
    for by_date in (True, False):
        star = catalog.write_star(spark, raw, "in_slices", by_date)
        for name, table in star.items():
            assert sorted(map(str, table.select(want[name].columns).collect())) == sorted(map(str, want[name].collect())), name
    latest = catalog.publish_latest(spark, star, "in_slices.product_latest")
    assert sorted(map(str, latest.collect())) == sorted(map(str, warehouse.product_latest(want).collect()))
    assert session._stages[spark.sparkContext.applicationId] == before
