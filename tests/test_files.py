import os
import shutil
import time
from types import SimpleNamespace

import pytest
from conftest import column

from shelfwatch.schema import CLEAN_COLUMNS, RAW_COLUMNS
from shelfwatch.session import drop_stages, fresh_path, materialise, shared_folder, stage_once
from shelfwatch.sources import catalog, files


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_load_raw_checks_and_trims_the_header(spark, tmp_path):
    header = ",".join(f" {c} " for c in RAW_COLUMNS)
    path = write(tmp_path / "a.csv", header + "\n" + ",".join("x" for _ in RAW_COLUMNS) + "\n")
    df = files.load_raw(spark, path)
    assert df.columns == RAW_COLUMNS and set(t for _, t in df.dtypes) == {"string"}
    bad = write(tmp_path / "b.csv", "name,brand\na,b\n")
    with pytest.raises(ValueError, match="scraped_at"):
        files.load_raw(spark, bad)


def test_another_column_order_raises_instead_of_shifting(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "1.csv", "a,b\n1,2\n")
    write(folder / "2.csv", "b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header|field"):
        files.read_text_csv(spark, str(folder)).collect()


def test_quotes_line_breaks_and_null_tokens(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'i,t\n1,"two ""quoted"", lines\nhere"\n2,NULL\n3,null\n4,""\n5,\n6,Null\n')
    out = files.null_csv_tokens(files.read_text_csv(spark, path, multiline=True))
    assert column(out, "t", "i") == ['two "quoted", lines\nhere', None, None, None, None, "Null"]


def test_round_trip(spark, rows, tmp_path):
    df = rows("i string, t string", ("1", 'a "b"\nc,d'), ("2", "  £5 – x "), ("3", None))
    files.write_csv(df, str(tmp_path / "out"))
    back = files.null_csv_tokens(files.read_text_csv(spark, str(tmp_path / "out"), multiline=True))
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_latest_file(spark, tmp_path):
    for n, name in enumerate(["raw_2026-01-16.csv", "raw_2026-01-15.csv", "other.csv"]):
        write(tmp_path / name, "x")
        stamp = time.time() - 1000 + 10 * n
        os.utime(tmp_path / name, (stamp, stamp))
    assert files.latest_file(spark, str(tmp_path), "raw*.csv").endswith("raw_2026-01-15.csv")
    with pytest.raises(FileNotFoundError):
        files.latest_file(spark, str(tmp_path), "none*.csv")


def test_dated_name(spark):
    assert files.dated_name(spark, "clean", "/data/raw_2026-01-16.csv") == "clean_2026-01-16"
    assert len(files.dated_name(spark, "clean", "/data/raw.csv")) == len("clean_2026-01-16")


def test_clean_sink_is_named_by_its_input(spark, rows, tmp_path):
    path = files.write_clean(rows("a int", (1,)), f"{tmp_path}/", "/data/raw_2026-01-16.csv")
    assert path == f"{tmp_path}/clean_2026-01-16"
    assert column(files.read_text_csv(spark, path), "a") == ["1"]


def test_copy_into_landing(spark, tmp_path):
    catalog.create_layers(spark)
    catalog.recreate_landing(spark)
    good = write(tmp_path / "good.csv", "NAME,Product_Id,extra\nGlen,7,zz\nNULL,8,zz\n")
    files.copy_into(spark, good, catalog.LANDING_TABLE)
    table = spark.table(catalog.LANDING_TABLE)
    assert table.columns == CLEAN_COLUMNS
    assert column(table, "name", "product_id") == ["Glen", None]
    bad = write(tmp_path / "bad.csv", "name,product_id\nGlen,7\nOld,8,9,10\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.copy_into(spark, bad, catalog.LANDING_TABLE)
    assert spark.table(catalog.LANDING_TABLE).count() == 2
    files.copy_into(spark, good, catalog.LANDING_TABLE)
    assert spark.table(catalog.LANDING_TABLE).count() == 4
    catalog.recreate_landing(spark)
    assert spark.table(catalog.LANDING_TABLE).count() == 0


def test_snapshot_folders(spark, rows, tmp_path):
    out = str(tmp_path / "snapshots")
    df = rows("product_id string, scrape_date string", ("1", "2026-01-16"), ("2", "2026-01-17"))
    files.write_snapshot(df, out)
    files.write_snapshot(df.where("scrape_date = '2026-01-17'"), out)
    assert sorted(n for n in os.listdir(out) if n.startswith("scrape")) == ["scrape_date=2026-01-16", "scrape_date=2026-01-17"]
    assert spark.read.csv(out, header=True).count() == 3


def test_materialise_uses_the_shared_folder(spark, rows):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared + "/x-")
    df = materialise(rows("a int, b string", (1, "x")))
    assert df.inputFiles()[0].startswith("file:") and shared in df.inputFiles()[0]
    assert [tuple(r) for r in df.collect()] == [(1, "x")]


def test_without_a_setting_the_warehouse_is_the_shared_folder():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))

    warehouse = {"spark.sql.warehouse.dir": "s3a://lake/warehouse/"}
    assert shared_folder(session(**warehouse, **{"spark.checkpoint.dir": "s3a://scratch/run/"})) == "s3a://scratch/run"
    assert shared_folder(session(**warehouse)) == "s3a://lake/warehouse/shelfwatch-stages"


def test_stages_are_dropped(spark, rows):
    drop_stages(spark)
    paths = [materialise(rows("a int", (i,))).inputFiles()[0].removeprefix("file://") for i in range(3)]
    assert all(os.path.exists(p) for p in paths)
    assert drop_stages(spark) == 3 and drop_stages(spark) == 0
    assert not any(os.path.exists(p) for p in paths)


def test_malformed_rows_are_found(spark, tmp_path):
    path = write(tmp_path / "ragged.csv", "a,b\n1,2\n3,4,5\n6\n7,8\n")
    assert sorted(r.line for r in files.malformed_rows(spark, path).collect()) == ["3,4,5", "6"]
    good = write(tmp_path / "good.csv", "a,b\n1,2\n")
    assert files.malformed_rows(spark, good).count() == 0


def test_large_files_are_split_unless_cells_hold_line_breaks(spark, tmp_path):
    path = write(tmp_path / "long.csv", "a,b\n" + "1,2\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert files.read_text_csv(spark, path).rdd.getNumPartitions() > 2
        assert files.read_text_csv(spark, path, multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_newest_rows_by_file_time_not_name(spark, rows, tmp_path):
    def write(name, seconds, *values):
        path = tmp_path / name
        path.write_text("category,size\n" + "".join(f"{c},{n}\n" for c, n in values), encoding="utf-8")
        os.utime(path, (seconds, seconds))

    write("raw_2026-01-15.csv", 3000, ("a", 1))
    write("x_2026-01-16.csv", 1000, ("a", 2), ("b", 3), ("", 9))
    write("b_2026-01-16.csv", 2000, ("a", 4), ("a", 5))
    write("c_2026-01-16.csv", 2000, ("c", 6))
    write("d_2026-01-16.csv", 2000, ("c", 7))
    got = files.newest_rows(spark, str(tmp_path / "*.csv"))
    assert got.columns == ["category", "size", "file_date"]
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [
        ("-", "9", "2026-01-16"), ("a", "1", "2026-01-15"), ("a", "4", "2026-01-16"), ("a", "5", "2026-01-16"),
        ("b", "3", "2026-01-16"), ("c", "7", "2026-01-16"),
    ]


def test_append_csv_adds_files(spark, rows, tmp_path):
    for value in ("x", "y"):
        files.append_csv(rows("a string", (value,)), str(tmp_path / "in"))
    assert sorted(r.a for r in files.read_text_csv(spark, str(tmp_path / "in")).collect()) == ["x", "y"]


def test_stage_once_builds_again_when_its_files_are_gone(spark, rows):
    built = []

    def build():
        built.append(1)
        return materialise(rows("a int", (len(built),)), "once")

    assert stage_once(spark, ("t", 1), build).first().a == 1 == stage_once(spark, ("t", 1), build).first().a
    folder = stage_once(spark, ("t", 1), build).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    shutil.rmtree(folder)
    assert stage_once(spark, ("t", 1), build).first().a == 2


def test_packed_csv_survives_a_round_trip(spark, rows, tmp_path):
    df = rows("a string, b string", ("x, \"y\"", " z "), (None, ""), ("é", "1"))
    files.write_csv(df, str(tmp_path / "out"), packed=True)
    assert list((tmp_path / "out").glob("*.csv.gz")) and not list((tmp_path / "out").glob("*.csv"))
    files.write_csv(df, str(tmp_path / "plain"))
    back = [sorted(map(str, files.read_text_csv(spark, str(tmp_path / p)).collect())) for p in ("out", "plain")]
    assert back[0] == back[1] and len(back[0]) == 3


def test_the_raw_file_of_the_main_chain_goes_when_it_is_cleaned(spark):
    import __spark_entry__
    from shelfwatch import session

    before = len(session._stages.get(spark.sparkContext.applicationId, []))
    clean = __spark_entry__.cleaned_landing(spark, "/root/testdata/sf0.001")
    left = [p.rsplit("/", 1)[1].rpartition("-")[0] for p in session._stages[spark.sparkContext.applicationId][before:]]
    assert left == ["clean"] and clean.count() > 0
