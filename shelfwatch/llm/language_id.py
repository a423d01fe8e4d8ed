"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product of its
letters' vectors, each rotated by its place (binding); a text is the sum of its
trigrams (bundling). A language's prototype is the sum over its training texts, and a
text has the language whose prototype points most nearly the same way (cosine).

As bundling is a sum, training counts (language, trigram) with ordinary aggregation
and turns the counts into vectors afterwards; all labelled rows take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import own_columns, quoted, unused
from shelfwatch.llm.text_batches import slices, text_bytes
from shelfwatch.session import ship_package

DIMENSIONS = 1024
#: Label values a model may have; their prototypes are held by the driver and every task (4 KiB each).
MOST_LANGUAGES = 4096
#: Texts, and distinct trigrams, whose vectors a task holds at once.
HELD_TEXTS, HELD_TRIGRAMS = 512, 4096
#: Cells up to which occurrences are counted in a table instead of being sorted.
TABLE_CELLS = 1 << 22
#: Trigram counts a training task holds before it passes them on.
HELD_COUNTS = 1 << 20
UNKNOWN = "und"
_POINT = np.uint64(21)  # bits of a code point


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # a row of length 1 per language


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 15)
def letter_vector(point: int, dimensions: int) -> np.ndarray:
    """The random vector of a letter (or of the gap between words, 0), the same everywhere."""
    bits = np.random.Generator(np.random.PCG64([dimensions, point])).integers(0, 2, dimensions, np.int8)
    return bits * 2 - 1


@lru_cache(maxsize=1 << 16)
def _rolled(point: int, dimensions: int, shift: int) -> np.ndarray:
    return np.roll(letter_vector(point, dimensions), shift)


def trigram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """One row per packed trigram: the bound vectors of its letters."""
    mask = np.uint64((1 << 21) - 1)
    bound = np.ones((len(grams), dimensions), np.int8)
    for place in range(3):
        points, at = np.unique((grams >> np.uint64(21 * (2 - place))) & mask, return_inverse=True)
        table = np.stack([_rolled(p, dimensions, 2 - place) for p in points.tolist()])
        bound *= table[at]
    return bound


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of some texts (packed), and for every occurrence its number among them and its text.

    Letters are lowered, everything else is a gap, one gap between words; a trigram may
    begin or end with a gap.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le"), np.uint32)
    text_of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points, letter, text_of = points[keep], letter[keep], text_of[keep]
    # A gap in front, so that the first word begins with one too.
    points = np.concatenate([[0], np.where(letter, points, 0)]).astype(np.uint64)
    text_of = np.concatenate([text_of[:1], text_of])
    middle = np.flatnonzero(points[1:-1]) if len(points) > 2 else np.zeros(0, np.int64)
    present, code = _numbered(points)
    width = len(present)
    codes = (code[middle] * width + code[middle + 1]) * width + code[middle + 2]
    if width**3 <= 1 << 24:
        found = np.flatnonzero(np.bincount(codes, minlength=width**3))
        number = np.zeros(width**3, np.int32)
        number[found] = np.arange(len(found))
        number = number[codes]
    else:
        found, number = np.unique(codes, return_inverse=True)
    packed = (
        (present[found // (width * width)] << np.uint64(42)) | (present[found // width % width] << _POINT) | present[found % width]
    )
    return packed, number, text_of[middle + 1]


def _numbered(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    present = np.flatnonzero(np.bincount(points.astype(np.int64), minlength=1))
    number = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
    number[present] = np.arange(len(present))
    return present.astype(np.uint64), number[points.astype(np.int64)]


def _parts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    _, offsets = text_bytes(column)
    for begin, end in slices(offsets):
        for first in range(begin, end, HELD_TEXTS):
            last = min(first + HELD_TEXTS, end)
            yield first, last, column.slice(first, last - first).fill_null("").to_pylist()


def _occurrences(number: np.ndarray, group: np.ndarray, groups: int, grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of trigram and group that occur, by trigram and then group, and how often each does."""
    cells = number.astype(np.int64) * groups + group
    if groups * grams <= TABLE_CELLS:
        table = np.bincount(cells, minlength=groups * grams)
        found = np.flatnonzero(table)
        often = table[found]
    else:
        found, often = np.unique(cells, return_counts=True)
    return found // groups, found % groups, often


def count_trigrams(labelled: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang, gram, total`` over all rows."""
    ship_package(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                totals = np.bincount(at, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(totals)],
                    names=["lang", "gram", "total"],
                )
            held.clear()

        for batch in batches:
            langs = batch.column(0)
            for first, last, texts in _parts(batch.column(1)):
                grams, number, text_of = trigrams(texts)
                names, which = np.unique(np.array(langs.slice(first, last - first).to_pylist(), object).astype(str), return_inverse=True)
                at, of, often = _occurrences(number, which[text_of], len(names), len(grams))
                for label, name in enumerate(names):
                    there = np.flatnonzero(of == label) if len(names) > 1 else slice(None)
                    held.setdefault(str(name), []).append((grams[at[there]], often[there]))
                size += len(at)
                if size > HELD_COUNTS:
                    yield from out()
                    size = 0
        yield from out()

    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, gram bigint, total bigint").groupBy("lang", "gram").agg(F.sum("total").alias("total"))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS) -> Profiles:
    """The profiles of all rows with a label; rows without label or text teach nothing."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = count_trigrams(labelled, lang, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            grams = batch.column(1).to_numpy().astype(np.uint64)
            totals = batch.column(2).to_numpy().astype(np.float64)
            for name in set(names.tolist()):
                rows = np.flatnonzero(names == name)
                for part in np.array_split(rows, len(rows) // 4096 + 1):
                    sums[name] = sums.get(name, 0) + totals[part] @ trigram_vectors(grams[part], dimensions)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions, pa.string()), pa.array(np.arange(dimensions)), pa.array(vector)],
                names=["lang", "at", "value"],
            )

    parts = counts.mapInArrow(run, "lang string, at bigint, value double")
    vectors = parts.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    # Whole numbers add up to the same sum in any order.
    rows = vectors.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("vector"))
    found = rows.select("lang", F.col("vector.value").alias("vector")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found.sort(key=lambda r: r["lang"])
    matrix = np.array([r["vector"] for r in found], np.float64).reshape(len(found), dimensions)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return Profiles([r["lang"] for r in found], (matrix / np.where(length > 0, length, 1)).astype(np.float32))


def cosines(texts: list[str], prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of every text with every prototype, and how many trigrams each text has."""
    grams, number, text_of = trigrams(texts)
    at, of, often = _occurrences(number, text_of, len(texts), len(grams))
    bundles = np.zeros((len(texts), prototypes.shape[1]), np.float32)
    for first in range(0, len(grams), HELD_TRIGRAMS):
        part = grams[first : first + HELD_TRIGRAMS]
        here = slice(*np.searchsorted(at, [first, first + len(part)]))
        counts = np.zeros((len(texts), len(part)), np.float32)
        counts[of[here], at[here] - first] = often[here]
        bundles += counts @ trigram_vectors(part, prototypes.shape[1]).astype(np.float32)
    length = np.linalg.norm(bundles, axis=1, keepdims=True)
    return bundles @ prototypes.T / np.where(length > 0, length, 1), np.bincount(of, often, len(texts))


def judged(batches: Iterator[pa.RecordBatch], model: Profiles, at: int, kept: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The first ``kept`` columns of every row, its language and its score; the text is column ``at``.

    Rows leave in the parts they are judged in, so that no second batch of whole texts is held.
    """
    for batch in batches:
        for first, last, texts in _parts(batch.column(at)):
            found, scores = [UNKNOWN] * (last - first), np.zeros(last - first)
            if model.languages:
                near, total = cosines(texts, model.prototypes)
                best = near.round(6).argmax(axis=1)
                found = [model.languages[b] if n else UNKNOWN for b, n in zip(best, total, strict=True)]
                score = near[np.arange(len(best)), best].astype(np.float64).round(6).clip(0, 1)
                scores = np.where(total > 0, score, 0.0)
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:kept], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=names
            )


def predict(docs: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, unless named) of ``docs``, the predicted language and its score, the cosine cut to 0 to 1.

    The two are called ``_lang_pred`` and ``_score``, with underscores behind where ``docs`` has such columns.

    A NULL text, a text without letters and a model without languages give ``und`` and
    0. Of languages with equal cosine the first by name wins.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(profiles)
    names = list(docs.columns) if keep is None else list(keep)
    given = [*names, *([] if text in names else [text])]
    at = given.index(text)
    # Sent by place: a name may hold signs that the task's frame could not be asked for.
    sent = docs.select(*[F.col(quoted(n)).alias(f"c{i}") for i, n in enumerate(given)])
    added = unused(docs, "_lang_pred", "_score")
    schema = docs.limit(0).select(*[F.col(quoted(n)) for n in names], F.lit("").alias(added[0]), F.lit(0.0).alias(added[1])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return judged(batches, shared.value, at, len(names), [*names, *added])

    return sent.mapInArrow(run, schema)


def held_out(id_column: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text is divisible by 5; rows without id are."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, id_column: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: profiles from the rows that are not held out, then a prediction for every row.

    A NULL or empty text and one without letters is ``und`` with score 0; rows without id are
    held out. Of languages with equal cosine the first by name wins; repeated rows are judged
    alike, each gives a row. An empty table gives no rows, other columns are ignored.
    """
    profiles = train(docs.where(~held_out(id_column)), lang, text)
    rows = docs.select(F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text).alias("text"))
    found = predict(rows, profiles, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))


def drop_unidentified(docs: DataFrame, id_column: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """The documents that have a language, all columns as they were; the profiles come from the same documents.

    NULL and empty texts and those without letters go, and all documents where none has a
    label to learn from; repeated rows go or stay together. Columns may have any names.
    """
    profiles = train(docs.where(~held_out(id_column)), lang, text)
    found = unused(docs, "_lang_pred")[0]
    return predict(docs, profiles, text).where(F.col(found) != UNKNOWN).select(own_columns(docs))
