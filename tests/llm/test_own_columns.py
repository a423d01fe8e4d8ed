"""Documents' own columns come out of every step as they went in, whatever their names."""

import pytest
from corpus import prose

import corpus_pipeline
from shelfwatch.llm.common import unused
from shelfwatch.llm.decontaminate import drop_contaminated
from shelfwatch.llm.exact_dedup import drop_copies
from shelfwatch.llm.language_id import drop_unidentified
from shelfwatch.llm.line_spread import drop_spread_lines
from shelfwatch.llm.mixing import mixed_documents, systematic_mix
from shelfwatch.llm.near_join import drop_near

NAMES = [
    "_digest", "_keep", "_key", "_size", "_kept", "copy", "_row", "_a", "_b", "_id", "_stays", "_group", "_place", "_range", "_rank",
    "_s", "_r", "_n", "_shift", "_copies", "_target", "_source_size", "_lang_pred", "_score", "_tie", "_gone", "_of", "_Digest_", "a.b", "number",
]
SCHEMA = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in NAMES)
ITEMS = "item_id bigint, text string"


def documents():
    texts = [prose(i, 60) for i in range(30)]
    texts += [texts[0], texts[0].upper(), texts[1] + " more", "", None, " ".join(prose(77, 40).split()[5:30]), texts[2], "12 34"]
    return [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]


@pytest.fixture
def docs(rows):
    return rows(SCHEMA, *documents())


def unchanged(df, extra=0):
    """Rows that are the documents' own, in their column order, with so many columns behind."""
    own = {d[0]: d for d in documents()}
    names = [f.name for f in df.schema]
    assert names[: len(names) - extra] == ["doc_id", "text", "lang", "source", *NAMES]
    got = [tuple(r)[: len(names) - extra] for r in df.collect()]
    assert got and all(r == own[r[0]] for r in got)
    return [r[0] for r in got]


def test_dropping_stages(docs, rows):
    items = rows(ITEMS, (1, prose(77, 40)))
    assert set(unchanged(drop_copies(docs))) == set(range(38)) - {0, 2, 33}  # lowering leaves É as it is
    near = unchanged(drop_near(docs))
    assert 32 in near and 1 not in near
    assert set(unchanged(drop_contaminated(docs, items))) == set(range(38)) - {35}
    assert set(unchanged(drop_unidentified(docs))) == set(range(38)) - {33, 34, 37}


def test_added_columns_stand_beside_own_ones(docs):
    spread = drop_spread_lines(docs)
    assert spread.columns[-3:] == ["_kept_", "_n_lines", "_n_removed"]
    unchanged(spread, 3)
    mixed = systematic_mix(docs)
    assert mixed.columns[-4:] == ["_size_", "_source_size_", "_target_", "_copies_"]
    assert len(unchanged(mixed, 4)) == 38
    assert mixed_documents(docs).columns[-1] == "copy_"
    unchanged(mixed_documents(docs), 1)


def test_pipeline(docs, rows, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows(ITEMS, (1, prose(77, 40))).write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = unchanged(corpus_pipeline.run(docs.sparkSession, str(tmp_path)), 1)
    assert not {33, 34, 35, 37} & set(kept)


def test_pipeline_and_mixing_of_an_empty_table(spark, rows, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, copy int")
    assert corpus_pipeline.source_mix(spark, empty, str(tmp_path)).count() == 0
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    rows(ITEMS, (1, prose(77, 40))).write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == [*empty.columns, "copy_"]


def test_names(docs):
    assert unused(docs, "_A", "x", "x", "_digest") == ["_A_", "x", "x_", "_digest__"]
