"""Exact dedup with an extendible-hash index on shared files.

Every text gets a digest; its first bits are the index key. Rows are combined to
postings, at most ``SHARES`` per text, so a group with a third of all rows is a
handful of postings. The directory starts with one bucket and doubles: a bucket
with more than ``capacity`` postings is split by the next bit until every bucket
fits. The directory sends each posting to its bucket, and owner tasks take ranges
of buckets: what a task receives it merges to one entry per text, chains by key and
writes to the shared folder. Texts that have copies are sent to the owners of their
buckets in the same way and compared there, byte by byte.

Texts with the same key but different digests are links of one chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import ascii_lower, bit_filter, own_columns, passes, staged, unused

#: Bits of the digest that the directory may use at most.
MAX_DEPTH = 20
#: Postings of a bucket before it is split.
CAPACITY = 1 << 14
#: Postings, and texts to compare, that one group of copies may send to its owner.
SHARES = 8


def _cell(key: Column) -> Column:
    return F.conv(F.substring(key, 1, MAX_DEPTH // 4), 16, 10).cast("bigint")


def _share(row_no: Column) -> Column:
    """Which share of a group a row belongs to; rows of one task are in one share."""
    return F.pmod(F.shiftright(row_no, 33), F.lit(SHARES))


def directory(postings: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The buckets that hold anything, ``depth, bucket``, once doubling has ended.

    A bucket stays whole at the smallest depth at which it holds at most ``capacity``
    postings, which is where repeated doubling ends. One that no bit can split stays
    overfull at ``max_depth`` and its owner works through a longer range.
    """
    cells = postings.groupBy(_cell(F.col("key")).alias("cell")).agg(F.count("*").alias("held"))
    # One count per depth that a doubling could stop at.
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth))))
    levels = levels.withColumn("bucket", F.expr(f"shiftright(cell, {MAX_DEPTH} - depth)"))
    loads = levels.groupBy("depth", "bucket").agg(F.sum("held").alias("load"))
    overfull = (F.col("load") > capacity) & (F.col("depth") < max_depth)
    # Halves of a split bucket, whose own count does not call for another split.
    split = loads.where(overfull).select(
        (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("bucket") * 2, F.col("bucket") * 2 + 1)).alias("bucket")
    )
    whole = loads.where(~overfull).select("depth", "bucket")
    return whole.where("depth = 0").unionByName(whole.join(split, ["depth", "bucket"]))


def pointers(buckets: DataFrame) -> tuple[DataFrame, int]:
    """The directory's pointers, ``pointer, depth, bucket, first_cell``, and its depth, that of the deepest bucket."""
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    first = f"shiftleft(bucket, {depth} - depth)"
    spread = F.expr(f"explode(sequence({first}, {first} + shiftleft(1L, {depth} - depth) - 1))")
    return buckets.select(
        spread.alias("pointer"), "depth", "bucket", F.expr(f"shiftleft(bucket, {MAX_DEPTH} - depth)").alias("first_cell")
    ), depth


def to_owners(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` with ``depth, bucket, first_cell`` of their key's bucket, each range of buckets in one task.

    No bucket is cut, so what is grouped by ``first_cell`` and more needs no further exchange.
    """
    table, depth = pointers(buckets)
    found = rows.withColumn("pointer", F.shiftright(_cell(F.col("key")), MAX_DEPTH - depth)).join(table, "pointer")
    return found.drop("pointer").repartitionByRange("first_cell")


def build_index(rows: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The index over rows with ``key, digest, doc_id, row_no``, and its buckets, written and read back.

    One entry per (key, digest): ``group_size``, ``owner`` (doc_id and row_no of the row that
    stays), ``chain_length`` (different digests under the key) and the bucket's ``depth, bucket``.
    The row with the largest doc_id stays, a NULL doc_id losing against any other;
    among rows that repeat that doc_id, the last one read.
    """
    postings = staged(
        rows.groupBy("key", "digest", _share(F.col("row_no")).alias("share")).agg(
            F.count("*").alias("held"), F.max(F.struct("doc_id", "row_no")).alias("last")
        ),
        "postings",
    )
    buckets = staged(directory(postings, capacity), "directory")
    bucket = ["first_cell", "depth", "bucket"]
    merged = to_owners(postings, buckets).groupBy(*bucket, "key", "digest").agg(
        F.sum("held").alias("group_size"), F.max("last").alias("owner")
    )
    chain = Window.partitionBy("first_cell", "key")
    entries = merged.withColumn("chain_length", F.count("*").over(chain))
    return staged(entries.drop("first_cell"), "hash-index"), buckets


def unequal_bytes(texts: DataFrame, index: DataFrame, buckets: DataFrame) -> DataFrame:
    """Digests under which different texts lie; empty unless the digest itself collides.

    ``texts`` has ``key, digest, norm, row_no``. Only texts whose entry holds several rows are
    compared: a bitmap of fixed size keeps most others out of the shuffle. The least and the
    greatest text of a share go to the owner of the bucket; bytes are equal where these are.
    """
    several = index.where("group_size > 1").select("digest")
    kept = texts.where(passes(bit_filter(several, "digest"), F.col("digest")))
    shares = kept.groupBy("key", "digest", _share(F.col("row_no")).alias("share")).agg(
        F.min("norm").alias("least"), F.max("norm").alias("greatest")
    )
    # Equal ends go on as one text.
    ends = shares.withColumn("greatest", F.when(F.col("greatest") != F.col("least"), F.col("greatest")))
    met = to_owners(ends, buckets).groupBy("first_cell", "key", "digest").agg(
        F.min("least").alias("least"), F.greatest(F.max("least"), F.max("greatest")).alias("greatest")
    )
    return met.where("least != greatest").select("digest")


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, key_digits: int = 16
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, chain_length``.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty, so
    NULL and empty texts form one group. Of equal texts the row with the largest
    doc_id stays (NULL ids lose); exactly one row of a group is ``kept``, also when
    ids repeat. An empty table gives an empty result. Columns other than the id and
    the text are ignored. ``key_digits`` hex digits of the digest are the index key
    (at least 5); ``chain_length`` counts the different texts under that key.
    """
    norm = ascii_lower(F.col(text_column))
    rows = staged(
        docs.select(F.col(id_column).alias("doc_id"), F.sha2(norm, 256).alias("digest"))
        .withColumn("key", F.substring("digest", 1, key_digits))
        .withColumn("row_no", F.monotonically_increasing_id()),
        "digests",
    )
    index, buckets = build_index(rows, capacity)
    texts = docs.select(norm.alias("norm")).withColumn("digest", F.sha2("norm", 256)).select(
        F.substring("digest", 1, key_digits).alias("key"), "digest", "norm", F.monotonically_increasing_id().alias("row_no")
    )
    clash = unequal_bytes(texts, index, buckets).take(1)
    if clash:
        raise ValueError(f"two different texts have the digest {clash[0]['digest']}")
    entries = index.select("key", "digest", "group_size", "owner", "chain_length")
    return rows.join(entries, ["key", "digest"]).select(
        "doc_id",
        F.col("owner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("owner.row_no")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "chain_length",
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents that ``exact_dedup`` keeps, all columns as they were.

    Documents without a copy, by the bitmap of texts with copies, pass without a
    shuffle. Where rows repeat both id and text, the one whose columns hash highest stays.
    NULL counts as empty, so of NULL and empty texts one row stays; an empty table stays
    empty. Columns may have any names; none is read or changed but the id and the text.
    """
    found = exact_dedup(docs, id_column, text_column, **options)
    digest, keep, held = unused(docs, "_digest", "_keep", "_row")
    owners = staged(
        found.where("kept AND group_size > 1").select(F.col("text_sha256").alias(digest), F.col("keep_id").alias(keep)),
        "owners",
    )
    own = own_columns(docs)
    keyed = docs.withColumn(digest, F.sha2(ascii_lower(F.col(text_column)), 256))
    maybe = passes(bit_filter(owners, digest), F.col(digest))
    alone = keyed.where(~maybe).select(own)
    met = keyed.where(maybe).join(owners, digest, "left")
    stays = met.where(F.col(keep).isNull() | (F.col(id_column) == F.col(keep)))
    # Groups of NULL ids only, and rows that repeat the id: one row per digest; a lone row has its own digest.
    one = stays.groupBy(digest).agg(F.max_by(F.struct(*own), F.xxhash64(*own)).alias(held))
    return alone.unionByName(one.select(f"{held}.*"))
