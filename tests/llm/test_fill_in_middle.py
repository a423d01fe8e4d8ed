import hashlib

import duckdb
from corpus import SCHEMA, awkward, document, prose
from pyspark.sql import functions as F

from shelfwatch.llm import fill_in_middle as fim
from shelfwatch.llm.fill_in_middle import capture_ends, cut_places, fill_in_middle, restored
from shelfwatch.llm.oracles import FILL_IN_MIDDLE
from shelfwatch.llm.queries import op13_fill_in_middle


def expected(doc_id, text):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(text), "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return doc_id, len(text), "spm", low, high - low, "<S>" + suffix + "<P>" + prefix + "<M>" + middle
    return doc_id, len(text), "psm", low, high - low, "<P>" + prefix + "<S>" + suffix + "<M>" + middle


ODD = ["<P>", "a <S> b", "<M", "<P", "S><", "<S", ">", "a" * 3, "🙂é\n\r\x00", " \x85", "é"]


def test_rows_and_round_trip(rows, spark):
    values = [*awkward(), *[document(50 + i, t) for i, t in enumerate(ODD * 9)], *[document(300 + i, prose(i, i)) for i in range(200)]]
    made = fill_in_middle(rows(SCHEMA, *values))
    got = made.withColumn("back", restored(F.col("form"), F.col("output"))).collect()
    want = [expected(v[0], v[1]) for v in values]
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in got) == sorted(v[1] or "" for v in values)
    assert fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql_on_awkward_rows(rows, tmp_path):
    rows(SCHEMA, *awkward()).write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_fill_in_middle(rows(SCHEMA, awkward()[0]).sparkSession, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(con.execute(FILL_IN_MIDDLE).fetchall(), key=str)


def test_long_texts_in_parts(monkeypatch):
    text = prose(1, 500) + "🙂"
    whole = cut_places(text, 10**9, 77)
    assert whole[0] == len(text)
    monkeypatch.setattr(fim, "MATCHED_POINTS", 10)
    assert cut_places(text, 10**9, 77) == whole
    assert cut_places(text[:20], 3, 20) == (20, 3, 20)


def test_other_units():
    assert capture_ends("ab cd  ef", r"\S+\s*") == [3, 7, 9]
    assert capture_ends("", r"\S+\s*") == []
    assert capture_ends(" x", r"\S+\s*") is None
    assert cut_places("ab cd  ef", 1, 2, r"\S+\s*") == (3, 3, 7)
    assert fim.transform(" x", "1:1", r"\S+\s*") == (None, "plain", None, None, " x")
