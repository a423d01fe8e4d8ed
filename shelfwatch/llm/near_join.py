"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

Texts with the same set of word shingles are one class. Every class has a label of
``depth`` minimum hashes in each of ``trees`` trees. Classes that agree on a prefix of
their labels in some tree are neighbours in that tree's sorted trie. A task walks its
part of the tries from the full depth to the shortest prefix that the target recall
needs. Of the neighbours under a prefix it compares those that no longer prefix has
joined yet, by two bits of each of their minimum hashes, and joins those that look
alike; so classes that met by chance, or share boilerplate only, stay apart.

The joined are gathered into components, so that the shingles of a class travel once,
and components are verified exactly: intersections are counted by shingle, never by
listing pairs. A component too large for one task is cut into blocks, and every pair of
blocks is a task of its own, as are the classes under one prefix. What leaves a task is
one row per class: its number of links and the smallest class it is connected to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import bit_filter, own_columns, passes, staged, text_key, unused
from shelfwatch.llm.components import components
from shelfwatch.llm.decontaminate import _gram_hashes, word_classes
from shelfwatch.llm.text_batches import mix, prefix_hash, slices, span_hash, text_bytes, words
from shelfwatch.session import ship_package

SHINGLE = 5
THRESHOLD = (4, 5)  # as a fraction, so that verification counts in whole numbers
TREES = 32
DEPTH = 8
RECALL = 0.9999
#: Classes and shingles of one block; a task holds two blocks.
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1 << 21
#: Classes under one prefix that one block of the forest holds; a task compares two blocks.
FOREST_BLOCK = 4096
#: Similarity, as two bits of every minimum hash tell it, from which neighbours are joined.
#: A pair at the threshold lies almost seven standard errors above.
LOOKS_ALIKE = 0.6
_LABEL = 2  # bytes kept of each minimum hash


def prefix_depth(recall: float = RECALL, trees: int = TREES, depth: int = DEPTH, threshold: float = 0.8) -> int:
    """The longest prefix that finds a pair at the threshold with the wanted probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 32, (2, n), np.uint32)
    return random[0] | np.uint32(1), random[1]


def min_hashes(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The least value of every hash function over the shingles, its low bits."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for part in range(0, len(low), 512):
        values = low[part : part + 512, None] * factors
        values += shifts
        np.minimum(least, values.min(axis=0), out=least)
    # The minima crowd near 0; mixing spreads them over the bits that are kept.
    return mix(least.astype(np.uint64)).astype(np.uint16)


def sketch_bits(labels: np.ndarray) -> bytes:
    """Two bits of every minimum hash, packed."""
    two = (labels & np.uint16(3)).astype(np.uint8).reshape(-1, 4)
    return (two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6).tobytes()


def agreeing(bits: np.ndarray, ones: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many minimum hashes of the rows of ``bits`` (words of 64 bits) agree in both bits."""
    differ = bits[ones] ^ bits[others]
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return 32 * bits.shape[1] - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)


def _pairs(starts: np.ndarray, ends: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows inside each run, some ``most`` at a time."""
    sizes = ends - starts
    places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = np.repeat(starts, sizes) + places
    behind = np.repeat(sizes, sizes) - 1 - places
    parts = np.cumsum(behind) // most
    for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(parts)) + 1):
        many = behind[part]
        ones = np.repeat(rows[part], many)
        steps = np.arange(len(ones)) - np.repeat(np.cumsum(many) - many, many)
        yield ones, ones + 1 + steps


def _united(root: np.ndarray, ones: np.ndarray, others: np.ndarray) -> np.ndarray:
    while True:
        a, b = root[ones], root[others]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root = root[root]


def walk_tries(groups: np.ndarray, deep: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """For each row the first row it is joined to.

    Rows are sorted by their group, the shortest prefix, and by the labels ``deep`` that
    follow it. Runs under the longest prefix come first. Under a shorter one only rows
    that are not joined yet are compared, and runs that are one already are passed by.
    """
    root = np.arange(len(groups))
    least = int(32 * bits.shape[1] * (LOOKS_ALIKE + (1 - LOOKS_ALIKE) / 4))
    for kept in range(deep.shape[1], -1, -1):
        change = (groups[1:] != groups[:-1]).any(axis=1) | (deep[1:, :kept] != deep[:-1, :kept]).any(axis=1)
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        ends = np.append(starts[1:], len(groups))
        several = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
        for ones, others in _pairs(starts[several], ends[several]):
            apart = root[ones] != root[others]
            ones, others = ones[apart], others[apart]
            met = agreeing(bits, ones, others) >= least
            root = _united(root, ones[met], others[met])
    return root


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Per slice of a batch the sorted distinct shingle hashes of each text.

    A text of fewer words than a shingle has one, of all its words; one without words none.
    """
    classes = word_classes()
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part, local = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, counts = words(part, local, classes)
        hashes = span_hash(prefix_hash(classes[part]), starts, ends)
        grams = _gram_hashes(hashes, size, size).view(np.uint64)
        sets = []
        for low, high in zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True):
            if high - low >= size:
                sets.append(np.unique(grams[low : high - size + 1]))
            elif high > low:
                sets.append(_gram_hashes(hashes[low:high], high - low, high - low).view(np.uint64)[:1])
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, last, sets


def sketches(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """One row per document, written: ``row_no, id, text_key, set_a, set_b, n, labels, bits``."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_column).alias("id"),
        text_key(F.col(text_column)).alias("key"), F.col(text_column).cast("string").alias("text"),
    ).select("row_no", "id", "key.a", "key.b", "text")
    schema = f"row_no bigint, id {dict(rows.dtypes)['id']}, text_a bigint, text_b bigint, set_a bigint, set_b bigint, n bigint, labels binary, bits binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _seeds(TREES * DEPTH)
        for batch in batches:
            for first, last, sets in shingle_sets(batch.column(4), size):
                part = batch.slice(first, last - first)
                least = [min_hashes(s, factors, shifts) if len(s) else None for s in sets]
                labels = [None if h is None else h.tobytes() for h in least]
                bits = [None if h is None else sketch_bits(h) for h in least]
                sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                folds = np.array([np.bitwise_xor.reduce(mix(s)) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:4], pa.array(sums), pa.array(folds),
                        pa.array([len(s) for s in sets], pa.int64()), pa.array(labels, pa.binary()), pa.array(bits, pa.binary()),
                    ],
                    names=["row_no", "id", "text_a", "text_b", "set_a", "set_b", "n", "labels", "bits"],
                )

    return staged(rows.mapInArrow(run, schema), "sketches")


def _classes(rows: DataFrame) -> DataFrame:
    """One row per class: ``set_a, set_b, n, class_no, labels, bits, text_a, text_b`` of its first document."""
    own = rows.where("n > 0")
    first = F.min_by(F.struct("labels", "bits", "text_a", "text_b"), "row_no")
    return own.groupBy("set_a", "set_b", "n").agg(F.min("row_no").alias("class_no"), first.alias("first")).select(
        "set_a", "set_b", "n", "class_no", "first.*"
    )


def neighbours(classes: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges ``a, b``: classes that meet under a trie prefix and look alike, each with one it is joined to.

    The classes under a prefix are one group of rows, or, where they are many, one group
    for every pair of blocks.
    """
    depth = prefix_depth(recall)
    at = f"tree * {_LABEL * DEPTH}"
    labelled = classes.select("class_no", "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    prefix = F.expr(f"substring(labels, {at} + 1, {_LABEL * depth})")
    deep = F.expr(f"substring(labels, {at} + {_LABEL * depth + 1}, {_LABEL * (DEPTH - depth)})")
    placed = staged(labelled.select(F.xxhash64("tree", prefix).alias("prefix"), deep.alias("deep"), "class_no"), "forest")
    shared = placed.groupBy("prefix").agg(F.count("*").alias("held")).where("held > 1")
    met = placed.join(shared.select("prefix", F.ceil(F.col("held") / FOREST_BLOCK).alias("blocks")), "prefix")
    met = met.join(classes.select("class_no", "bits"), "class_no")
    block = F.pmod(F.xxhash64("class_no"), F.col("blocks"))
    dealt = met.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "prefix", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "deep", "bits", "class_no"
    )
    group = ["prefix", "low", "high"]
    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "deep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(groups: np.ndarray, deep: np.ndarray, bits: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
            root = walk_tries(groups, deep, bits)
            there = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(keys[there]), pa.array(keys[root[there]])], names=["a", "b"])

        held = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = (
                np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1),
                np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16).reshape(n, DEPTH - depth),
                np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(n, -1),
                batch.column(5).to_numpy(),
            )
            held = new if held is None else tuple(np.concatenate(pair) for pair in zip(held, new, strict=True))
            # The last group may go on in the next batch.
            inside = np.flatnonzero((held[0] != held[0][-1]).any(axis=1))
            whole = inside[-1] + 1 if len(inside) else 0
            if whole:
                yield joined(*[column[:whole] for column in held])
                held = tuple(column[whole:] for column in held)
        if held is not None:
            yield joined(*held)

    return ordered.mapInArrow(run, "a bigint, b bigint")


def count_links(keys: np.ndarray, sets: list[np.ndarray], blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every class of one group, and the smallest class each is connected to.

    Where the group is two blocks, only links between the blocks count.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    n = len(sets)
    common = np.zeros((n, n), np.float32)
    # Shingles that many classes have: as columns of a matrix.
    wide = np.flatnonzero(often > max(n // 16, 8))
    column = np.full(len(often), -1)
    column[wide] = np.arange(len(wide))
    for low in range(0, len(wide), 2048):
        here = (column[code] >= low) & (column[code] < low + 2048)
        block = np.zeros((n, min(2048, len(wide) - low)), np.float32)
        block[owner[here], column[code[here]] - low] = 1
        common += block @ block.T
    # Shingles of few classes: their classes paired, shingles with equally many at once.
    rare = (often[code] > 1) & (column[code] < 0)
    order = np.argsort(code[rare], kind="stable")
    held, many = owner[rare][order], often[code[rare]][order]
    flat = common.reshape(-1)
    for m in np.unique(many):
        each = held[many == m].reshape(-1, m)
        for part in np.array_split(each, len(each) * m * m // (1 << 22) + 1):
            pairs = (part[:, :, None] * n + part[:, None, :]).reshape(-1)
            flat += np.bincount(pairs, minlength=n * n).astype(np.float32) if len(pairs) > n * n // 8 else 0
            if len(pairs) <= n * n // 8:
                np.add.at(flat, pairs, 1)
    up, down = THRESHOLD
    linked = common * (up + down) >= up * (sizes[:, None] + sizes[None, :])
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(linked, False)
    least = keys.copy()
    while True:
        near = np.where(linked, least[None, :], np.iinfo(np.int64).max).min(axis=1)
        lower = np.minimum(least, near)
        if (lower == least).all():
            return linked.sum(axis=1), least
        least = lower


def verified(sets: DataFrame) -> DataFrame:
    """``class_no, links, least`` for rows ``comp, low, high, block, class_no, shingles`` grouped by the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            keys, blocks = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows])
            # A pair of blocks of which one is empty: its links are those of the other block's own group.
            if group[1] != group[2] and blocks.min() == blocks.max():
                return
            links, least = count_links(keys, [r[2] for r in rows], blocks)
            there = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[there]), pa.array(links[there].astype(np.int64)), pa.array(least[there])],
                names=["class_no", "links", "least"],
            )

        for batch in batches:
            comps, lows, highs, blocks, keys = (batch.column(i).to_numpy() for i in range(5))
            lists = batch.column(5)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            for i in range(batch.num_rows):
                here = (comps[i], lows[i], highs[i])
                if here != group:
                    yield from out()
                    group, rows = here, []
                rows.append((keys[i], blocks[i], values[ends[i] : ends[i + 1]].copy()))
        yield from out()

    return sets.mapInArrow(run, "class_no bigint, links bigint, least bigint")


def _candidate_sets(docs: DataFrame, wanted: DataFrame, text_column: str, size: int) -> DataFrame:
    """``class_no, comp, ..., shingles`` for the classes in ``wanted``, from one text of each."""
    key = text_key(F.col(text_column))
    texts = docs.select(key.alias("key"), F.col(text_column).cast("string").alias("text")).select("key.a", "key.b", "text")
    texts = texts.where(passes(bit_filter(wanted, "text_a"), F.col("a"))).dropDuplicates(["a", "b"])
    joined = wanted.join(texts, (F.col("text_a") == F.col("a")) & (F.col("text_b") == F.col("b")))
    rows = joined.select("class_no", "comp", "blocks", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, sets in shingle_sets(batch.column(3), size):
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, last - first).columns[:3], lists], names=["class_no", "comp", "blocks", "shingles"]
                )

    return rows.mapInArrow(run, "class_no bigint, comp bigint, blocks bigint, shingles array<bigint>")


def near_join(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE, recall: float = RECALL
) -> DataFrame:
    """One row per document: ``row_no, doc_id, text_a, text_b, group_no, class_no, n_links, group_size``.

    Documents with the same shingles share ``class_no``; ``n_links`` is the number of other
    classes at Jaccard similarity 0.8 or more; documents connected by links or by a class
    share ``group_no``, and ``group_size`` counts them. Texts without words (NULL, empty,
    signs only) are alone. Repeated rows are documents of one class. An empty table gives
    an empty result. Columns other than the id and the text are ignored.
    """
    rows = sketches(docs, id_column, text_column, size)
    classes = staged(_classes(rows), "classes")
    comps = components(neighbours(classes, recall))
    comps = staged(comps.select(F.col("node").alias("class_no"), F.col("root").alias("comp")), "candidates")
    # The blocks a component needs, by its classes and their shingles.
    members = comps.join(classes.select("class_no", "n", "text_a", "text_b"), "class_no")
    need = members.groupBy("comp").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    wanted = staged(members.join(need, "comp").select("class_no", "comp", "blocks", "text_a", "text_b"), "wanted")
    sets = _candidate_sets(docs, wanted, text_column, size)
    block = F.pmod(F.xxhash64("class_no"), F.col("blocks"))
    paired = sets.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = paired.select(
        "comp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class_no", "shingles"
    )
    grouped = dealt.repartition("comp", "low", "high").sortWithinPartitions("comp", "low", "high")
    found = staged(verified(grouped), "links")
    links = found.groupBy("class_no").agg(F.sum("links").alias("n_links"))
    groups = components(found.select(F.col("class_no").alias("a"), F.col("least").alias("b")))
    described = classes.select("set_a", "set_b", "n", "class_no").join(links, "class_no", "left").join(
        groups.select(F.col("node").alias("class_no"), F.col("root").alias("group_no")), "class_no", "left"
    )
    joined = rows.drop("labels", "bits").join(described, ["set_a", "set_b", "n"], "left").select(
        "row_no", F.col("id").alias("doc_id"), "text_a", "text_b",
        F.coalesce("group_no", "class_no", "row_no").alias("group_no"),
        F.coalesce("class_no", "row_no").alias("class_no"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )
    joined = staged(joined, "near-rows")
    sizes = joined.groupBy("group_no").agg(F.count("*").alias("group_size"))
    return joined.join(sizes, "group_no")


def drop_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Of each group the document with the largest id (NULL ids lose), all columns as they were.

    Documents whose text is in no group pass without a shuffle. Of rows that repeat both
    id and text of the one that stays, the one whose columns hash highest stays.
    Texts without words (NULL, empty) all stay; an empty table stays empty. Columns may
    have any names; none is read or changed but the id and the text.
    """
    a, b, same_id, stays, group, key, held = unused(docs, "_a", "_b", "_id", "_stays", "_group", "_key", "_row")
    found = near_join(docs, id_column, text_column, **options).where("group_size > 1")
    best = found.groupBy("group_no").agg(F.max(F.struct("doc_id", "row_no")).alias("best"))
    marked = found.join(best, "group_no").select(
        F.col("text_a").alias(a), F.col("text_b").alias(b), F.col("doc_id").alias(same_id), "group_no",
        (F.col("row_no") == F.col("best.row_no")).alias("stays"),
    )
    marked = staged(
        marked.groupBy(a, b, same_id).agg(F.max("stays").alias(stays), F.min("group_no").alias(group)), "near-marks"
    )
    own = own_columns(docs)
    keyed = docs.withColumn(key, text_key(F.col(text_column)))
    maybe = passes(bit_filter(marked, a), F.col(key)["a"])
    alone = keyed.where(~maybe).select(own)
    same = (F.col(key)["a"] == F.col(a)) & (F.col(key)["b"] == F.col(b)) & F.col(id_column).eqNullSafe(F.col(same_id))
    met = keyed.where(maybe).join(marked, same, "left")
    free = met.where(F.col(group).isNull()).select(own)
    one = met.where(F.col(stays)).groupBy(group).agg(F.max_by(F.struct(*own), F.xxhash64(*own)).alias(held))
    return alone.unionByName(free).unionByName(one.select(f"{held}.*"))
