"""Benchmark decontamination by winnowing.

Texts become words (digits, letters, everything beyond ASCII; A-Z lowered). Of every
window of consecutive k-grams the smallest hash is kept. A span of ``window`` words
that document and benchmark share holds a whole window of k-grams, so both sides keep
the same k-gram of it: no shared span is missed. The kept hashes are joined; each hit
is extended to the spans around it, which are compared word by word.

Benchmark items of fewer words than ``window`` are one span each; for their lengths the
k-gram is the whole span and every position is kept.

A bitmap of fixed size with the benchmark's hashes goes to the tasks, so that few
document hashes are shuffled. A larger benchmark fills the bitmap and it removes less;
the join decides in any case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import bit_filter, own_columns, passes, staged, text_key, unused
from shelfwatch.llm.text_batches import mix, prefix_hash, slices, span_hash, text_bytes, words
from shelfwatch.session import ship_package

WINDOW = 10
GRAM = 5
#: Bits of the bitmap that the tasks test hashes against: half a MiB.
BITMAP_BITS = 1 << 22

HITS = "array<struct<fp: bigint, size: int, spans: array<struct<at: int, words: string>>>>"


def word_classes() -> np.ndarray:
    """Byte to lowered byte, 0 for bytes that are no part of a word."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


def kept_grams(grams: np.ndarray, counts: np.ndarray, size: int, gram: int) -> np.ndarray:
    """Positions of the k-grams that winnowing keeps; ``grams[i]`` starts at word i, ``counts`` are words before each text."""
    span = size - gram + 1
    ends = np.repeat(counts[1:], np.diff(counts))
    starts = np.flatnonzero(np.arange(len(ends)) + size <= ends)
    if span == 1 or len(starts) == 0:
        return starts
    least = grams[starts]
    at = starts.copy()
    for step in range(1, span):
        nearer = grams[starts + step] <= least  # the rightmost of equal hashes
        least = np.where(nearer, grams[starts + step], least)
        at = np.where(nearer, starts + step, at)
    return np.unique(at)


def _gram_hashes(hashes: np.ndarray, gram: int, size: int) -> np.ndarray:
    """Hash of the ``gram`` words from each word on; the last few of a batch mean nothing."""
    total = np.zeros(len(hashes), np.uint64)
    for step in range(gram):
        total[: len(hashes) - step] += hashes[step:] * np.uint64(2 * step + 3)
        total = mix(total) if step + 1 < gram else total
    return mix(total + np.uint64(size)).view(np.int64)


def fingerprint_batch(
    column: pa.Array, sizes: list[int], window: int, gram: int, bitmap: np.ndarray | None
) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """Per slice of a batch: first row, last row, words per text, hits per text."""
    classes = word_classes()
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part, local = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, counts = words(part, local, classes)
        lowered = classes[part]
        hashes = span_hash(prefix_hash(lowered), starts, ends)
        raw = lowered.tobytes()
        hits: list[list] = [[] for _ in range(last - first)]
        for size in sizes:
            k = gram if size >= window else size
            grams = _gram_hashes(hashes, k, size)
            kept = kept_grams(grams, counts, size, k)
            if bitmap is not None:
                code = (grams[kept].view(np.uint64) % np.uint64(BITMAP_BITS)).astype(np.int64)
                kept = kept[(bitmap[code >> 6] >> (code & 63).astype(np.uint64)) & np.uint64(1) == 1]
            texts = np.searchsorted(counts, kept, "right") - 1
            for at, text in zip(kept.tolist(), texts.tolist(), strict=True):
                low, high = counts[text], counts[text + 1]
                spans = [
                    {"at": int(s - low), "words": b" ".join(raw[starts[i] : ends[i]] for i in range(s, s + size)).decode()}
                    for s in range(max(low, at - (size - k)), min(at, high - size) + 1)
                ]
                hits[text].append({"fp": int(grams[at]), "size": size, "spans": spans})
        yield first, last, np.diff(counts), hits


def fingerprints(
    texts: DataFrame, id_column: str, text_column: str, sizes: list[int], window: int, gram: int, bitmap: np.ndarray | None
) -> DataFrame:
    """One row per text, written: ``row_no, id, text_a, text_b, n_words, hits``."""
    spark = texts.sparkSession
    ship_package(spark)
    shared = None if bitmap is None else spark.sparkContext.broadcast(bitmap)
    rows = texts.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_column).alias("id"),
        text_key(F.col(text_column)).alias("key"), F.col(text_column).cast("string").alias("text"),
    ).select("row_no", "id", F.col("key.a").alias("text_a"), F.col("key.b").alias("text_b"), "text")
    schema = f"row_no bigint, id {dict(rows.dtypes)['id']}, text_a bigint, text_b bigint, n_words bigint, hits {HITS}"
    hits_type = pa.list_(
        pa.struct([
            ("fp", pa.int64()), ("size", pa.int32()),
            ("spans", pa.list_(pa.struct([("at", pa.int32()), ("words", pa.string())]))),
        ])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, counts, hits in fingerprint_batch(
                batch.column(4), sizes, window, gram, None if shared is None else shared.value
            ):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array(counts, pa.int64()), pa.array(hits, hits_type)],
                    names=["row_no", "id", "text_a", "text_b", "n_words", "hits"],
                )

    return staged(rows.mapInArrow(run, schema), "fingerprints")


def _bitmap(prints: DataFrame) -> np.ndarray:
    """The benchmark's hashes as a bitmap of fixed size; at most ``BITMAP_BITS / 64`` words reach the driver."""
    # The hash is taken as unsigned, as the tasks do.
    code = F.pmod(F.col("fp"), F.lit(BITMAP_BITS))
    filled = prints.select(code.alias("code")).selectExpr(
        "shiftright(code, 6) AS word", "shiftleft(1L, CAST(code & 63 AS INT)) AS bit"
    )
    found = np.zeros(BITMAP_BITS // 64, np.uint64)
    for row in filled.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        found[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return found


def benchmark_spans(benchmark: DataFrame, item_id: str, item_text: str, window: int, gram: int) -> DataFrame:
    """One row per item and span: ``item_no, item_id, fp, size, words``, written."""
    short = fingerprints(benchmark, item_id, item_text, [], window, gram, None)
    lengths = short.where((F.col("n_words") > 0) & (F.col("n_words") < window)).select("n_words").distinct()
    sizes = sorted(row["n_words"] for row in lengths.collect())  # fewer than ``window`` numbers
    prints = fingerprints(benchmark, item_id, item_text, [*sizes, window], window, gram, None)
    hits = prints.select(F.col("row_no").alias("item_no"), F.col("id").alias("item_id"), "n_words", F.explode("hits").alias("hit"))
    # A short item is one span; a span of that length inside a longer item is none.
    own = (F.col("hit.size") == window) | (F.col("hit.size") == F.col("n_words"))
    return staged(
        hits.where(own).select("item_no", "item_id", "hit.fp", "hit.size", F.explode("hit.spans").alias("span"))
        .select("item_no", "item_id", "fp", "size", "span.words"),
        "benchmark-spans",
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What documents share with the benchmark, in three frames that agree on ``row_no``.

    * one row per document: ``row_no, id, text_a, text_b, n_words``;
    * one row per shared span: ``row_no, at, size, words`` (position and length in words);
    * one row per document and item with a shared span: ``row_no, item_no, item_id``.

    NULL and empty texts have no words and share nothing; an empty table on either side
    gives no spans. Repeated items count one by one, also when their ids repeat or are NULL.
    """
    spans = benchmark_spans(benchmark, item_id, item_text, window, gram)
    prints = spans.select("fp", "size").distinct()
    sizes = sorted(row["size"] for row in spans.select("size").distinct().collect())
    rows = fingerprints(docs, id_column, text_column, sizes, window, gram, _bitmap(prints))
    hits = rows.select("row_no", F.explode("hits").alias("hit")).select("row_no", "hit.fp", "hit.size", "hit.spans")
    met = hits.join(prints, ["fp", "size"], "left_semi")
    around = met.select("row_no", "size", F.explode("spans").alias("span")).select("row_no", "span.at", "size", "span.words").distinct()
    known = spans.select("size", "words").distinct()
    found = staged(around.join(known, ["size", "words"], "left_semi").select("row_no", "at", "size", "words"), "shared-spans")
    holders = spans.select("size", "words", "item_no", "item_id").distinct()
    items = found.select("row_no", "size", "words").distinct().join(holders, ["size", "words"])
    return rows.drop("hits"), found, items.select("row_no", "item_no", "item_id").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: ``id, n_words, n_hit, n_items, items, contaminated``.

    ``n_hit`` counts words inside any shared span, ``items`` holds the item ids as
    sorted strings (a NULL id as an empty one).
    """
    rows, found, items = contamination(docs, benchmark, **options)
    in_order = Window.partitionBy("row_no").orderBy("at", "size")
    reached = F.max(F.col("at") + F.col("size")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("at") + F.col("size") - F.greatest(F.col("at"), F.coalesce(reached, F.lit(0)))
    hit = found.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("row_no").agg(F.sum("fresh").alias("n_hit"))
    held = items.groupBy("row_no").agg(
        F.count("*").alias("n_items"),
        F.sort_array(F.collect_list(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"),
    )
    joined = rows.join(hit.join(held, "row_no"), "row_no", "left")
    return joined.select(
        "id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The documents that share no span with the benchmark, all columns as they were.

    Whether a document is contaminated depends on its text alone, so texts are what is
    dropped; documents whose text is not among them by the bitmap pass without a shuffle.
    NULL and empty texts stay, rows with equal texts go or stay together, an empty table
    stays empty. Columns may have any names; none is read or changed but the text.
    """
    a, b, key = unused(docs, "_a", "_b", "_key")
    rows, found, _ = contamination(docs, benchmark, text_column=text_column, **options)
    hit = rows.join(found.select("row_no").distinct(), "row_no", "left_semi")
    hit = staged(hit.select(F.col("text_a").alias(a), F.col("text_b").alias(b)).distinct(), "contaminated")
    own = own_columns(docs)
    keyed = docs.withColumn(key, text_key(F.col(text_column)))
    maybe = passes(bit_filter(hit, a), F.col(key)["a"])
    clean = keyed.where(maybe).join(hit, (F.col(key)["a"] == F.col(a)) & (F.col(key)["b"] == F.col(b)), "left_anti")
    return keyed.where(~maybe).select(own).unionByName(clean.select(own))
