import shutil

import pytest
from pyspark.sql import functions as F
from test_star_store import landing
from test_warehouse import landing_cells

from shelfwatch.plans import warehouse
from shelfwatch.schema import CLEAN_COLUMNS, FACT_MEASURES
from shelfwatch.sources import versions
from shelfwatch.streaming import intake, upsert


def arrivals():
    """The cells in three arrivals; the second brings older rows too, the last a product and labels of its own."""
    cells = landing_cells()
    late = [
        {"scraped_at": "2026-01-20 07:00:00", "product_id": "50", "name": "New", "price_tier": "Antique", "price_inc_vat_gbp": "9"},
        {"scraped_at": "2025-12-01", "product_id": "1", "name": "Old 1", "price_inc_vat_gbp": "5", "discount_band": "Other"},
    ]
    return [cells[10:], cells[:10], late]


def shown(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


VIEW = ["full_date", "product_id", "name", "region", "price_tier", "discount_band", "snapshot_ts", *FACT_MEASURES]


def compare(spark, root, cells):
    store, star = upsert.read_store(spark, root), warehouse.build_star(landing(spark, cells))
    assert shown(upsert.latest_snapshots(store), VIEW) == shown(warehouse.product_latest(star), VIEW)
    assert shown(warehouse.product_snapshot(store), VIEW) == shown(warehouse.product_snapshot(star), VIEW)
    assert shown(store["dim_product"], star["dim_product"].columns) == shown(star["dim_product"], star["dim_product"].columns)
    assert shown(store["dim_date"], star["dim_date"].columns) == shown(star["dim_date"], star["dim_date"].columns)
    assert warehouse.audit_unique(store).where("NOT is_unique").count() == 0
    assert warehouse.audit_foreign_keys(store).where("orphan_rows > 0").count() == 0
    return store


def test_three_arrivals_as_a_stream_equal_one_load(spark, tmp_path):
    folder, root, state = tmp_path / "in", str(tmp_path / "store"), tmp_path / "state"
    folder.mkdir()
    for number, cells in enumerate(arrivals()):
        landing(spark, cells).coalesce(1).write.option("header", True).csv(str(folder / "tmp"))
        next((folder / "tmp").glob("*.csv")).rename(folder / f"clean_{number}.csv")
        shutil.rmtree(folder / "tmp")
        stream = intake.csv_stream(spark, str(folder), columns=CLEAN_COLUMNS)
        upsert.run_upsert(stream, root, str(state), parts=3)
        if number == 1:  # the batch runs again, as after a driver that was lost before its commit
            for name in ("1", ".1.crc"):
                (state / "commits" / name).unlink()
            upsert.run_upsert(intake.csv_stream(spark, str(folder), columns=CLEAN_COLUMNS), root, str(state), parts=3)
    assert versions.numbers(spark, root) == [0, 1, 2]
    store = compare(spark, root, [c for part in arrivals() for c in part])
    assert store["fact_product_snapshot"].count() == 38 + 2


def test_a_batch_that_failed_half_way_runs_again(spark, tmp_path, monkeypatch):
    root, (first, second, third) = str(tmp_path / "store"), arrivals()
    assert upsert.upsert(spark, root, landing(spark, first), 0, parts=4)
    before = upsert.read_store(spark, root)
    want = shown(upsert.latest_snapshots(before), VIEW)

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(versions, "publish", broken)
        with pytest.raises(RuntimeError):
            upsert.upsert(spark, root, landing(spark, second + third), 1)
    assert shown(upsert.latest_snapshots(upsert.read_store(spark, root)), VIEW) == want
    assert upsert.read_store(spark, root)["fact_product_snapshot"].count() == before["fact_product_snapshot"].count()
    assert upsert.upsert(spark, root, landing(spark, second), 1)
    assert not upsert.upsert(spark, root, landing(spark, second), 1)
    assert upsert.upsert(spark, root, landing(spark, third), 2)
    compare(spark, root, first + second + third)


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "store")
    upsert.upsert(spark, root, landing(spark, landing_cells()), 0, parts=64)
    upsert.upsert(spark, root, landing(spark, arrivals()[2]), 1)
    state = versions.state(spark, root)
    rewritten = [p for p, batch in state["folders"]["latest"].items() if batch == 1]
    assert 1 <= len(rewritten) <= 2 < len(state["folders"]["latest"])
    files = spark.read.parquet(f"{root}/latest/batch_id=1").inputFiles()
    assert {int(f.split("part=")[1].split("/")[0]) for f in files} == {int(p) for p in rewritten}


def test_labels_keep_their_keys_and_empty_batches_pass(spark, tmp_path):
    root = str(tmp_path / "store")
    upsert.upsert(spark, root, landing(spark, []), 0)
    assert upsert.read_store(spark, root)["latest_fact"].count() == 0
    upsert.upsert(spark, root, landing(spark, arrivals()[2]), 1)
    upsert.upsert(spark, root, landing(spark, landing_cells()), 2)
    tiers = {r.price_tier: r.price_tier_key for r in upsert.read_store(spark, root)["dim_price_tier"].collect()}
    assert tiers == {"Antique": 1, "Budget": 2, "Luxury": 3, "Premium": 4}


def test_too_many_labels_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "MOST_LISTED", 2)
    raw = landing(spark, landing_cells()).withColumn("price_tier", F.col("product_id"))
    with pytest.raises(ValueError, match="price_tier"):
        upsert.upsert(spark, str(tmp_path / "store"), raw, 0)
    with pytest.raises(FileNotFoundError):
        upsert.read_store(spark, str(tmp_path / "store"))


def test_packed_arrivals_go_in_slices_and_leave_nothing_staged(spark, tmp_path, monkeypatch):
    from shelfwatch import session
    from shelfwatch.sources import files

    monkeypatch.setattr(upsert, "ROWS_AT_ONCE", 10)
    monkeypatch.setattr(files, "ROWS_PER_FILE", 7)
    before = list(session._stages.get(spark.sparkContext.applicationId, []))
    folder, root, state = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "state")
    for cells in arrivals():
        files.append_csv(landing(spark, cells), folder, packed=True)
        upsert.run_upsert(intake.csv_stream(spark, folder, "*.csv.gz", columns=CLEAN_COLUMNS), root, state, parts=3)
    assert session._stages.get(spark.sparkContext.applicationId, []) == before
    names = [p.name for p in (tmp_path / "in").glob("part-*")]
    assert len(names) >= 7 and all(n.endswith(".csv.gz") for n in names)
    compare(spark, root, [c for part in arrivals() for c in part])


def test_rows_of_a_batch_are_not_moved_by_label(spark, tmp_path, monkeypatch):
    plans, load = [], upsert.warehouse.load_fact

    def seen(*args, **options):
        out = load(*args, **options)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(upsert.warehouse, "load_fact", seen)
    upsert.upsert(spark, str(tmp_path / "store"), landing(spark, landing_cells()), 0)
    assert plans[0].count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(price_tier" not in plans[0]


def test_a_batch_that_fails_in_a_later_slice_replaces_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "ROWS_AT_ONCE", 10)
    root, cells = str(tmp_path / "store"), landing_cells()
    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_merge", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert.upsert(spark, root, landing(spark, cells + cells), 0)
    upsert.upsert(spark, root, landing(spark, cells), 0)
    compare(spark, root, cells)
