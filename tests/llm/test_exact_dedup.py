import hashlib
from collections import defaultdict

import pytest
from corpus import SCHEMA, ascii_lower, awkward, document
from pyspark.sql import functions as F

from shelfwatch.llm.exact_dedup import SHARES, build_index, drop_copies, exact_dedup, to_owners, unequal_bytes


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[ascii_lower(row[1] or "")].append(row[0])
    ids = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(
        ((r[0], ids[t := ascii_lower(r[1] or "")], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for r in rows), key=str
    )


@pytest.mark.parametrize("digits", [5, 16])
def test_awkward_rows(rows, digits):
    data = awkward()
    got = exact_dedup(rows(SCHEMA, *data), capacity=2, key_digits=digits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(data)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_empty_table(rows, spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    assert drop_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_colliding_keys_form_chains(rows):
    data = [document(i, f"text {i % 3000}") for i in range(4000)]
    got = exact_dedup(rows(SCHEMA, *data), capacity=64, key_digits=5)
    assert got.where("chain_length > 1").count() > 0  # 3000 texts under 2**20 keys
    assert got.where("kept").count() == 3000
    assert got.where("group_size = 2").count() == 2000


def test_directory_splits_overfull_buckets_only(spark):
    # 40 entries under one prefix of 8 bits, 3 under another.
    keys = [f"00{i:014x}"[:2] + f"{i * 4:02x}" + "0" * 12 for i in range(40)] + [f"f{i}" + "0" * 14 for i in range(3)]
    made = spark.createDataFrame([(k, k, i, i) for i, k in enumerate(keys)], "key string, digest string, doc_id bigint, row_no bigint")
    index, buckets = build_index(made, capacity=8)
    assert {(r.depth, r.bucket) for r in buckets.collect()} == {(r.depth, r.bucket) for r in index.collect()}
    loads = index.groupBy("depth", "bucket").count().collect()
    assert max(r["count"] for r in loads) <= 8
    assert index.where("key LIKE 'f%'").select("depth").distinct().count() == 1
    assert index.where("key LIKE 'f%'").first().depth < index.agg(F.max("depth")).first()[0]


def test_documents_that_stay(rows):
    data = awkward()
    docs = rows(SCHEMA, *data)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    texts = [ascii_lower(r.text or "") for r in got.collect()]
    assert sorted(texts) == sorted({ascii_lower(r[1] or "") for r in data})
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted({t: i for _, i, _, t in expected(data)}.values(), key=str)


def test_a_hot_group_is_a_few_postings(rows, spark):
    made = spark.range(0, 50_000, 1, 40).selectExpr(
        "IF(id % 3 = 0, 'a', lpad(hex(id * 2654435761 % 4294967296), 8, '0')) AS k", "id AS doc_id"
    ).selectExpr("sha2(k, 256) AS digest", "doc_id").withColumn("row_no", F.monotonically_increasing_id())
    index, buckets = build_index(made.withColumn("key", F.substring("digest", 1, 16)), capacity=256)
    hot = index.orderBy(F.desc("group_size")).first()
    assert hot.group_size == 16_667 and hot.owner.doc_id == 49_998
    assert index.count() == 33_334 and buckets.count() > 100
    # The directory counts postings, so the hot group splits its bucket no further than SHARES others would.
    assert hot.depth <= index.agg(F.max("depth")).first()[0]
    assert index.groupBy("depth", "bucket").count().agg(F.max("count")).first()[0] <= 256
    assert SHARES < 256


def test_a_bucket_lies_in_one_task_and_texts_are_compared_there(spark):
    made = [(f"{i % 90:016x}", f"d{i}", f"text {i}", i << 33) for i in range(900)]
    texts = spark.createDataFrame(made, "key string, digest string, norm string, row_no bigint")
    index, buckets = build_index(texts.selectExpr("key", "digest", "row_no AS doc_id", "row_no"), capacity=32)
    sent = to_owners(texts, buckets)
    tasks = sent.withColumn("task", F.spark_partition_id()).groupBy("first_cell").agg(F.countDistinct("task").alias("n"))
    assert tasks.where("n > 1").count() == 0
    # Merging and chaining by bucket take place in the owner task, without another exchange.
    merged = sent.groupBy("first_cell", "key", "digest").count()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning(first_cell" not in plan
    assert index.where("chain_length = 10").count() == 900
    assert unequal_bytes(texts, index, buckets).count() == 0
    # A digest that stands for two texts, in one share and in two.
    for shift in (0, 1):
        twins = [("0" * 16, "same", "one", 0), ("0" * 16, "same", "two", shift << 33), ("0" * 16, "other", "x", 0), ("0" * 16, "other", "x", 5)]
        pair = spark.createDataFrame(twins, texts.schema)
        found, at = build_index(pair.selectExpr("key", "digest", "row_no AS doc_id", "row_no"))
        assert [r.digest for r in unequal_bytes(pair, found, at).collect()] == ["same"]
