import shutil

from shelfwatch.operators import dedup
from shelfwatch.schema import RAW_COLUMNS
from shelfwatch.sources import files
from shelfwatch.streaming import intake


def snapshot(path, *cells):
    lines = [",".join(RAW_COLUMNS)]
    lines += [",".join(str(c.get(n, "")) for n in RAW_COLUMNS) for c in cells]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_two_runs_equal_one_batch(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    first = [{"product_id": i, "scraped_at": "2026-01-15", "price_ex_vat_gbp": 10 + i} for i in range(5)]
    second = [{"product_id": i, "scraped_at": "2026-01-16", "price_ex_vat_gbp": 10 + 2 * i} for i in range(6)]
    snapshot(folder / "raw_2026-01-15.csv", *first, first[0])
    intake.run_intake(intake.csv_stream(spark, str(folder)), out, state)
    assert intake.intake_rows(spark, out).count() == 5
    snapshot(folder / "raw_2026-01-16.csv", *second)
    intake.run_intake(intake.csv_stream(spark, str(folder)), out, state)
    intake.run_intake(intake.csv_stream(spark, str(folder)), out, state)

    batch = files.load_raw(spark, str(folder))
    want = sorted(map(str, dedup.exact_dedup(batch).collect()))
    assert sorted(map(str, intake.intake_rows(spark, out).collect())) == want
    latest = {r.product_id: r.price_ex_vat_gbp for r in intake.intake_latest(spark, out).collect()}
    # Product 0 did not change its price, so its second scrape is a copy of the first.
    assert latest == {str(i): str(10 + 2 * i) for i in range(6)}


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    folder.mkdir()
    snapshot(folder / "a.csv", {"product_id": 1, "scraped_at": "2026-01-15"})
    intake.run_intake(intake.csv_stream(spark, str(folder)), out, str(state))
    shutil.rmtree(state / "commits")
    intake.run_intake(intake.csv_stream(spark, str(folder)), out, str(state))
    assert spark.read.parquet(out).count() == 1
