"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over ``GRAM`` bytes sets triggers: of every run of hashes the least one,
so that any string of ``LENGTH`` bytes holds a trigger. The string belongs to the first
trigger in it. A trigger with the bytes before it back to the last trigger and the
``LENGTH`` bytes after it is a phrase; the strings that belong to the trigger are the
strings of that phrase. Highly repetitive text has few different phrases.

The dictionary of phrases is put in order by what their strings have in common, coarse
to fine, and each step leaves only the part that is still open:

1. phrases by the bytes of their trigger: alone, all equal, or mixed;
2. mixed phrases in pieces of ``PIECE`` neighbouring strings, by the bytes that all
   strings of a piece share: alone, all equal, or mixed;
3. the strings of mixed pieces one by one.

That is the order of the corpus' suffixes, cut at ``LENGTH`` bytes, as far as it matters
here: which strings begin at more than one place. Each step is an aggregation with
partial sums inside the tasks, so a phrase in a third of all texts is one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import bit_filter, passes, staged, text_key
from shelfwatch.llm.text_batches import prefix_hash, slices, span_hash, text_bytes
from shelfwatch.session import ship_package

LENGTH = 200
GRAM = 50
PIECE = 16


def phrases(
    sums: np.ndarray, offsets: np.ndarray, gram: int, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per phrase of some texts: its first string's start, how many strings, and the trigger's position.

    The trigger of a string is the least gram hash in it, the first of equal ones, so
    equal strings have the same trigger whatever surrounds them.
    """
    total, run = int(offsets[-1]), length - gram + 1
    none = np.zeros(0, np.int64)
    if total < length:
        return none, none, none
    at = np.arange(total - gram + 1)
    rank = (span_hash(sums, at, at + gram) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    # Least of every run of ranks: doubling, then two overlapping stretches.
    least, width = rank, 1
    while width * 2 <= run:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    strings = total - length + 1
    least = np.minimum(least[:strings], least[run - width : run - width + strings])
    trigger = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:strings]
    trigger[at[:strings] + length > ends] = -1  # runs over the end of its text
    first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
    many = np.diff(np.append(first, strings))
    real = trigger[first] >= 0
    return first[real], many[real], trigger[first][real]


def parse(docs: DataFrame, id_column: str, text_column: str, gram: int, length: int) -> DataFrame:
    """One row per document, written, with its phrases as arrays.

    ``shapes`` packs the trigger's place in the phrase and the number of strings.
    """
    ship_package(docs.sparkSession)
    bare = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_column).alias("id"),
        text_key(F.col(text_column)).alias("key"),
        F.sha2(bare, 256).alias("sha"), F.octet_length(bare).cast("bigint").alias("n_bytes"), bare.alias("text"),
    ).select("row_no", "id", F.col("key.a").alias("text_a"), F.col("key.b").alias("text_b"), "sha", "n_bytes", "text")
    lists = {"grams": pa.int64(), "spans": pa.int64(), "starts": pa.int32(), "shapes": pa.int32()}
    schema = f"row_no bigint, id {dict(rows.dtypes)['id']}, text_a bigint, text_b bigint, sha string, n_bytes bigint, "
    schema += "grams array<bigint>, spans array<bigint>, starts array<int>, shapes array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(6))
            for first, last in slices(offsets):
                part, local = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                sums = prefix_hash(part)
                start, many, trigger = phrases(sums, local, gram, length)
                text = np.searchsorted(local, start, "right") - 1
                ends = pa.array(np.searchsorted(text, np.arange(last - first + 1)).astype(np.int32))
                values = (
                    span_hash(sums, trigger, trigger + gram).view(np.int64),
                    span_hash(sums, start, start + many - 1 + length).view(np.int64),
                    (start - local[text]).astype(np.int32),
                    ((trigger - start) << 12 | many).astype(np.int32),
                )
                arrays = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in values]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, last - first).columns[:6], *arrays],
                    names=["row_no", "id", "text_a", "text_b", "sha", "n_bytes", *lists],
                )

    return staged(rows.mapInArrow(run, schema), "parse")


def _repeated(places: DataFrame) -> DataFrame:
    """``gram, mixed`` for trigger bytes met more than once; mixed where their phrases differ."""
    met = places.groupBy("gram").agg(F.count("*").alias("met"), F.min("span").alias("low"), F.max("span").alias("high"))
    return met.where("met > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed"))


def piece_rows(text: bytes, starts: np.ndarray, shapes: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, ...]:
    """The pieces of some phrases of a text: core hash, span hash, first string, number of strings, phrase."""
    sums = prefix_hash(np.frombuffer(text, np.uint8))
    many, trigger = shapes & 0xFFF, starts + (shapes >> 12)
    # A string's piece is its distance to the trigger, rounded down.
    near, far = trigger - (starts + many - 1), trigger - starts
    count = far // piece - near // piece + 1
    which = np.repeat(np.arange(len(starts)), count)
    step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + near[which] // piece
    low = np.maximum(trigger[which] - (step + 1) * piece + 1, starts[which])
    high = np.minimum(trigger[which] - step * piece, starts[which] + many[which] - 1)
    core = span_hash(sums, trigger[which] - step * piece, trigger[which] - (step + 1) * piece + 1 + length)
    return core, span_hash(sums, low, high + length), low, high - low + 1, which


def pieces(affected: DataFrame, length: int, piece: int) -> DataFrame:
    """Rows ``row_no, weight, core, span, start, many`` of the mixed phrases of affected texts, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, mixed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = np.array([m["start"] for m in mixed], np.int64)
                shapes = np.array([m["shape"] for m in mixed], np.int64)
                core, span, low, many, phrase = piece_rows(text.encode(), starts, shapes, length, piece)
                weight = np.array([m["weight"] for m in mixed], np.int64)[phrase]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(core), row)), pa.array(weight), pa.array(core.view(np.int64)),
                        pa.array(span.view(np.int64)), pa.array(low.astype(np.int32)), pa.array(many.astype(np.int32)),
                    ],
                    names=["row_no", "weight", "core", "span", "start", "many"],
                )

    rows = affected.where(F.size("mixed") > 0).select("row_no", "text", "mixed")
    return staged(rows.mapInArrow(run, "row_no bigint, weight bigint, core bigint, span bigint, start int, many int"), "pieces")


def strings(affected: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Rows ``row_no, held, core, start, string``: every string of the pieces ``row_no, held, core, start, many``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums = prefix_hash(np.frombuffer(text.encode(), np.uint8))
                many = np.array([p["many"] for p in listed], np.int64)
                which = np.repeat(np.arange(len(listed)), many)
                start = np.array([p["start"] for p in listed], np.int64)[which]
                start = start + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(which), row)), pa.array(np.array([p["held"] for p in listed], np.int64)[which]),
                        pa.array(np.array([p["core"] for p in listed], np.int64)[which]), pa.array(start.astype(np.int32)),
                        pa.array(span_hash(sums, start, start + length).view(np.int64)),
                    ],
                    names=["row_no", "held", "core", "start", "string"],
                )

    listed = wanted.groupBy("row_no").agg(F.collect_list(F.struct("held", "core", "start", "many")).alias("pieces"))
    rows = affected.select("row_no", "text").join(listed, "row_no").select("row_no", "text", "pieces")
    return staged(rows.mapInArrow(run, "row_no bigint, held bigint, core bigint, start int, string bigint"), "strings")


def cut(text: bytes, runs: list[tuple[int, int]], length: int) -> tuple[list[tuple[int, int]], bytes]:
    """The removed stretches of a text, and what is left, for runs of (first string, strings)."""
    spans: list[list[int]] = []
    for start, many in sorted(runs):
        end = start + many - 1 + length
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    edges = [0, *[e for s in spans for e in s], len(text)]
    return [(a, b) for a, b in spans], b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _cut_texts(affected: DataFrame, runs: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    listed = runs.groupBy("row_no").agg(F.collect_list(F.struct("start", "many")).alias("runs"))
    rows = affected.select("row_no", "text_a", "text_b", "text").join(listed, "row_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, runs in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                spans, left = cut(text.encode(), [(r["start"], r["many"]) for r in runs], length)
                found.append({
                    "spans": [{"start": a, "end": b} for a, b in spans],
                    "n_removed": sum(b - a for a, b in spans),
                    "kept_sha256": hashlib.sha256(left).hexdigest(),
                    "kept": left if with_bytes else None,
                })
            result = pa.array(found, pa.struct([
                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()),
            ]))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), result], names=["text_a", "text_b", "cut"])

    return rows.mapInArrow(
        run,
        "text_a bigint, text_b bigint, "
        "cut struct<spans: array<struct<start: bigint, end: bigint>>, n_removed: bigint, kept_sha256: string, kept: binary>",
    )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    piece: int = PIECE,
    with_bytes: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept``.

    Removes every byte that a string of ``length`` bytes covers which begins at another
    place too, in the same document or another; matches do not run over the end of a
    text. ``spans`` are the maximal removed stretches in bytes; ``kept`` holds the
    remaining bytes of documents that lose some, if ``with_bytes``. NULL counts as empty;
    shorter texts lose nothing; of repeated rows every one is a place of its own, so all
    lose everything. An empty table gives an empty result. Other columns are ignored.
    """
    parsed = parse(docs, id_column, text_column, gram, length)
    listed = F.arrays_zip("grams", "spans", "starts", "shapes")
    placed = parsed.select("row_no", F.explode(listed).alias("p")).select(
        "row_no", F.col("p.grams").alias("gram"), F.col("p.spans").alias("span"),
        F.col("p.starts").alias("start"), F.col("p.shapes").alias("shape"),
    )
    repeated = staged(_repeated(placed), "repeated")
    slots = 1 << 24
    met = staged(placed.where(passes(bit_filter(repeated, "gram", slots), F.col("gram"), slots)).join(repeated, "gram"), "met")
    mixed = met.where("mixed")
    # Of equal phrases the first takes part in the next step, for all of them. Its row is the first of its text.
    kinds = staged(
        mixed.groupBy("gram", "span").agg(F.count("*").alias("weight"), F.min(F.struct("row_no", "start", "shape")).alias("first")),
        "kinds",
    )
    again = mixed.join(kinds.where("weight > 1").select("gram", "span"), ["gram", "span"], "left_semi")
    sure = met.where(~F.col("mixed")).unionByName(again.select(met.columns)).select(
        "row_no", F.struct("start", F.col("shape").bitwiseAND(0xFFF).alias("many")).alias("sure"),
        F.lit(None).cast("struct<start: int, shape: int, weight: bigint>").alias("mixed"),
    )
    still = kinds.select(
        "first.row_no", F.lit(None).cast("struct<start: int, many: int>").alias("sure"),
        F.struct("first.start", "first.shape", "weight").alias("mixed"),
    )
    # The first document of every text stands for its copies.
    firsts = parsed.where(F.size("grams") > 0).groupBy("text_a", "text_b").agg(F.min("row_no").alias("row_no"))
    listed = sure.unionByName(still).groupBy("row_no").agg(
        F.collect_list("sure").alias("sure"), F.collect_list("mixed").alias("mixed")
    )
    flagged = staged(listed.join(firsts, "row_no"), "flagged")
    bare = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    texts = docs.select(text_key(F.col(text_column)).alias("key"), bare.alias("text")).select("key.a", "key.b", "text")
    texts = texts.where(passes(bit_filter(flagged, "text_a"), F.col("a"))).dropDuplicates(["a", "b"])
    affected = staged(
        flagged.join(texts, (F.col("text_a") == F.col("a")) & (F.col("text_b") == F.col("b"))).drop("a", "b"), "affected"
    )
    broken = pieces(affected, length, piece)
    # Equal pieces once more count as one.
    spans = staged(
        broken.groupBy("core", "span").agg(
            F.sum("weight").alias("held"), F.min(F.struct("row_no", "start", "many")).alias("first")
        ),
        "spans",
    )
    whole = broken.where("weight = 1").join(
        spans.where("held > 1").select("core", "span"), ["core", "span"], "left_semi"
    ).select("row_no", "start", "many")
    differ = spans.groupBy("core").agg(F.count("*").alias("spans")).where("spans > 1").select("core")
    open_pieces = spans.join(differ, "core").select("first.row_no", "held", "core", "first.start", "first.many")
    single = strings(affected, open_pieces, length)
    # A string of a piece held once, that another piece holds too.
    twice = single.groupBy("core", "string").agg(F.sum("held").alias("met")).where("met > 1").select("core", "string")
    alone = single.where("held = 1").join(twice, ["core", "string"], "left_semi").select("row_no", "start", F.lit(1).alias("many"))
    sure = affected.select("row_no", F.explode("sure").alias("s")).select("row_no", "s.start", "s.many")
    done = _cut_texts(affected, sure.unionByName(whole).unionByName(alone), length, with_bytes)
    result = parsed.drop("grams", "spans", "starts", "shapes").join(done, ["text_a", "text_b"], "left")
    no_spans = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return result.select(
        F.col("id").alias("doc_id"), "n_bytes",
        F.coalesce("cut.n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.size(F.coalesce("cut.spans", no_spans)).cast("bigint").alias("n_spans"),
        F.coalesce("cut.spans", no_spans).alias("spans"),
        F.coalesce("cut.kept_sha256", "sha").alias("kept_sha256"),
        F.col("cut.kept").alias("kept"),
    )
