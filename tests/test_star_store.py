import pytest
from pyspark.sql import functions as F
from test_warehouse import landing_cells

from shelfwatch.plans import warehouse
from shelfwatch.schema import CLEAN_COLUMNS, STAR_TYPES
from shelfwatch.sources import star_store, versions


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "star")


def landing(spark, cells):
    values = [tuple(c.get(n) for n in CLEAN_COLUMNS) for c in cells]
    return spark.createDataFrame(values, ", ".join(f"{n} string" for n in CLEAN_COLUMNS))


def named():
    return [c for c in landing_cells() if c.get("name")]


def test_tables_have_the_declared_types_and_the_rows_of_the_staged_star(spark, root):
    raw = landing(spark, named())
    star, staged = star_store.reload_star(spark, raw, root, buckets=4), warehouse.build_star(raw)
    for name, types in STAR_TYPES.items():
        assert dict(star[name].dtypes) == types
        assert sorted(star[name].collect(), key=str) == sorted(staged[name].select(*types).collect(), key=str)


def test_a_reader_sees_all_old_or_all_new(spark, root):
    star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    reader = star_store.read_star(spark, root)
    star_store.reload_star(spark, landing(spark, named()[:9]), root, buckets=4)
    assert reader["fact_product_snapshot"].count() == 38 and reader["dim_date"].count() == 5
    now = star_store.read_star(spark, root)
    assert now["fact_product_snapshot"].count() == 9 and now["dim_date"].count() == 1
    assert star_store.read_star(spark, root, 1)["fact_product_snapshot"].count() == 38
    assert star_store.drop_old(spark, root, keep=1) == 1
    assert star_store.read_star(spark, root)["fact_product_snapshot"].count() == 9
    assert versions.numbers(spark, root) == [2]


def test_a_failed_reload_leaves_the_old_star(spark, root, monkeypatch):
    star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    unnamed = [*named(), {"scraped_at": "2026-02-01", "product_id": "77"}]
    with pytest.raises(star_store.StarRefused, match="dim_product.name"):
        star_store.reload_star(spark, landing(spark, unnamed), root, buckets=4)

    def breaks(df, name, *rest):
        if name == "fact_product_snapshot":
            raise RuntimeError("lost")
        return write(df, name, *rest)

    write = star_store._write
    monkeypatch.setattr(star_store, "_write", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        star_store.reload_star(spark, landing(spark, named()[:9]), root, buckets=4)
    assert versions.numbers(spark, root) == [1]
    assert star_store.read_star(spark, root)["fact_product_snapshot"].count() == 38


def test_a_number_is_published_once(spark, root):
    versions.publish(spark, root, {"a": "é"}, 1)
    with pytest.raises(versions.ConcurrentPublish):
        versions.publish(spark, root, {"a": "b"}, 1)
    assert versions.state(spark, root) == {"a": "é", "number": 1}
    assert versions.state(spark, root + "/none") is None
    with pytest.raises(FileNotFoundError):
        star_store.read_star(spark, root + "/none")
    with pytest.raises(ValueError):
        versions.forget(spark, root, 0)


def test_columns_must_be_the_declared_ones(spark, root):
    good = warehouse.small_dimensions(landing(spark, named()))["dim_date"]
    assert star_store.conform(good.select(*reversed(good.columns)), "dim_date").columns == list(STAR_TYPES["dim_date"])
    for wrong in (good.withColumn("year", F.col("year").cast("string")), good.drop("week"), good.withColumn("more", F.lit(1))):
        with pytest.raises(star_store.StarRefused):
            star_store.conform(wrong, "dim_date")


def test_the_fact_is_not_exchanged(spark, root):
    star = star_store.reload_star(spark, landing(spark, named()), root, buckets=4)

    def exchanges(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        fact = [line for line in text.splitlines() if "Exchange hashpartitioning(product_key" in line or "Exchange hashpartitioning(product_id" in line]
        return len(fact), text

    assert exchanges(warehouse.product_latest(star))[0] == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")  # labels and dates are smaller, products are not
    try:
        joined = star["fact_product_snapshot"].join(star["dim_product"], "product_key")
        count, text = exchanges(joined)
        assert count == 0 and "SortMergeJoin" in text
        assert exchanges(warehouse.product_snapshot(star))[0] == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_another_catalog_finds_the_star_by_its_pointer(spark, root):
    star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    state = versions.state(spark, root)
    want = sorted(star_store.read_star(spark, root)["dim_product"].collect(), key=str)
    for name in STAR_TYPES:
        spark.sql(f"DROP TABLE {star_store.table_name(state, name)}")  # external: the files stay
    again = star_store.read_star(spark, root)
    assert sorted(again["dim_product"].collect(), key=str) == want
    assert sum(r.row_count for r in star_store.bucket_rows(again, 4).collect()) == 38


def test_keys_are_the_same_in_any_order(spark, rows):
    cells = named() + named()[:3] + named()[:1]  # repeated rows
    raw = landing(spark, cells)
    shuffled = landing(spark, cells[::-1]).repartition(3)
    keys = [sorted(tuple(r) for r in warehouse.build_star(r)["fact_product_snapshot"].select("snapshot_key", "product_key").collect()) for r in (raw, shuffled)]
    assert keys[0] == keys[1]
    assert len({k for k, _ in keys[0]}) == len(keys[0]) == 38 + 4


def test_rows_that_repeat_often_are_counted_not_listed(rows, monkeypatch):
    monkeypatch.setattr(warehouse, "REPEATS_AT_ONCE", 4)
    made = warehouse._repeated(rows("a string, _n long", ("x", 1), ("y", 4), ("z", 11)))
    got = sorted((r.a, r._nth) for r in made.collect())
    assert got == [("x", 1), *[("y", i) for i in range(1, 5)], *[("z", i) for i in range(1, 12)]]


def test_views_resolve_in_another_session_and_follow_a_reload(spark, root):
    from shelfwatch.plans import analytics
    from shelfwatch.sources import views

    star = star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    names = views.publish_views(spark, root, "shelf_views")
    other = spark.newSession()
    assert {t.name for t in other.catalog.listTables("shelf_views")} == set(names) and not other.catalog.tableExists("product_latest")
    latest = warehouse.product_latest(star)
    for view, want in (("product_latest", latest), ("product_snapshot", warehouse.product_snapshot(star))):
        got = other.table(f"shelf_views.{view}").select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    def rounded(df):
        return sorted(str([float(c) if hasattr(c, "as_tuple") else c for c in r]) for r in df.collect())

    for view, report in (("top_ratings", analytics.top_ratings), ("price_premium", analytics.price_premium), ("age_roi", analytics.age_roi)):
        want = report(latest)
        assert rounded(other.table(f"shelf_views.{view}").select(want.columns)) == rounded(want), view
    star_store.reload_star(spark, landing(spark, named()[:9]), root, buckets=4)
    assert other.table("shelf_views.product_snapshot").count() == 38
    views.publish_views(spark, root, "shelf_views")
    assert other.table("shelf_views.product_snapshot").count() == 9


def test_buckets_grow_with_the_rows(spark, root, monkeypatch):
    monkeypatch.setattr(star_store, "ROWS_PER_BUCKET", 5)
    star = star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    state = versions.state(spark, root)
    assert state["buckets"] == 8  # 38 rows
    again = star_store.read_star(spark, root)["fact_product_snapshot"]
    assert again.count() == star["fact_product_snapshot"].count() == 38
    assert again.select(F.input_file_name()).distinct().count() <= 8
    assert warehouse.audit_unique(star).where("NOT is_unique").count() == 0


def test_the_fact_moves_once(spark, root, monkeypatch):
    plans = []
    write = star_store._write

    def seen(df, name, *rest):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, name, *rest)

    monkeypatch.setattr(star_store, "_write", seen)
    star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    plan = next(text for name, text in plans if name == "fact_product_snapshot")
    assert plan.count("RepartitionByExpression [product_key") == 1 and plan.index("Aggregate") < plan.index("RepartitionByExpression")


def test_an_audit_broadcasts_no_keys(spark, root):
    star = star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    found = warehouse.audit_foreign_keys(star)
    assert [r.orphan_rows for r in found.collect()] == [0, 0, 0, 0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(product_key" in line]


def test_products_are_merged_where_they_lie(spark, root):
    from shelfwatch.sources import views

    star = star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    views.publish_views(spark, root, "merged_views")
    other = spark.newSession()
    shown = [other.table(f"merged_views.{v}") for v in ("product_snapshot", "product_latest", "price_premium")]
    for df in [warehouse.product_latest(star), *shown]:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        assert [line for line in lines if "SortMergeJoin [product_key" in line]
        assert not [line for line in lines if "Join [product_key" in line and "Broadcast" in line]
        assert not [line for line in lines if "Exchange hashpartitioning(product_key" in line]


def test_the_fact_is_written_in_slices_of_whole_buckets(spark, root, monkeypatch):
    raw = landing(spark, named() + named()[:3])
    want = sorted(tuple(r) for r in warehouse.build_star(raw)["fact_product_snapshot"].select("snapshot_key", "product_key").collect())
    monkeypatch.setattr(star_store, "ROWS_AT_ONCE", 10)
    written, write = [], star_store._write
    monkeypatch.setattr(star_store, "_write", lambda df, name, *rest: written.append(name) or write(df, name, *rest))
    fact = star_store.reload_star(spark, raw, root, buckets=8)["fact_product_snapshot"]
    assert sorted(tuple(r) for r in fact.select("snapshot_key", "product_key").collect()) == want
    assert written.count("fact_product_snapshot") == 5
    files = [f.rsplit("_", 1)[1].split(".")[0] for f in fact.inputFiles()]
    assert len(files) == len(set(files)) <= 8  # no bucket in two files
    plan = fact.groupBy("product_key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_reload_leaves_nothing_staged(spark, root):
    from shelfwatch import session

    app = spark.sparkContext.applicationId
    before = list(session._stages.get(app, []))
    star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    assert session._stages[app] == before
    assert spark.conf.get(session.SHUFFLES_GO) == "false"


def test_landing_rows_in_files_are_not_copied(spark, root, monkeypatch):
    from shelfwatch.session import pack

    raw, labels = pack(landing(spark, named()), "landing"), []
    monkeypatch.setattr(star_store, "pack", lambda df, label: labels.append(label) or pack(df, label))
    star_store.reload_star(spark, raw, root, buckets=4, landed=True)
    assert "labels" in labels and "landing" not in labels


def test_long_keys_are_counted_by_hash(rows):
    from shelfwatch.operators import quality

    for cells in ([], [("a",)], [("a",), ("b",)], [("a",), ("b",), ("a",), ("a",), (None,), (None,), ("c",)]):
        df = rows("k string", *cells)
        assert quality.long_key_uniqueness(df, "k").first() == quality.uniqueness(df, ["k"]).first()


def test_two_loads_are_compared_without_a_shuffle(spark, root):
    star_store.reload_star(spark, landing(spark, named()), root, buckets=4)
    star_store.reload_star(spark, landing(spark, named()[::-1]), root, buckets=4)
    star_store.reload_star(spark, landing(spark, named()[:9]), root, buckets=2)
    for numbers, buckets in (([1, 2], 4), ([1, 3], 2)):
        both = star_store.loads_together(spark, root, "fact_product_snapshot", numbers)
        assert sorted((r.load, r["count"]) for r in both.groupBy("load").count().collect()) == [(1, 38), (numbers[1], 38 if buckets == 4 else 9)]
        keys = both.select("snapshot_key", "product_key").distinct()
        assert len(keys.collect()) == keys.count() == 38
        plan = both.select("snapshot_key", "product_key").distinct()._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (buckets != 4)
