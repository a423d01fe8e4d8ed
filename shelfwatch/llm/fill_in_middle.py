"""Fill-in-middle transformation: prefix, suffix and middle of a text in another order.

A text is matched once as a repetition of units. The matching library keeps every
repetition of a capture, so one match gives the number of units (how many ends there
are) and both cut offsets (two of the ends). The order of the parts and the two cuts
follow from a digest of the document's id, so every run makes the same choice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm.text_batches import slices, text_bytes
from shelfwatch.session import ship_package

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One code point.
UNIT = "."
SEED = "1"
#: Of a hundred texts so many stay plain, and of the others so many put the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
#: Code points that one match takes in; the library keeps some tens of bytes for each. A longer text of code points
#: is matched in parts of this length, whose ends follow each other.
MATCHED_POINTS = 1 << 20


@lru_cache(maxsize=8)
def _repeated(unit: str) -> regex.Pattern:
    return regex.compile(f"({unit})*", regex.DOTALL)


def capture_ends(text: str, unit: str = UNIT) -> list[int] | None:
    """Where every unit of ``text`` ends; None where the text is no sequence of units."""
    match = _repeated(unit).fullmatch(text)
    return match.ends(1) if match else None


def cut_places(text: str, first: int, second: int, unit: str = UNIT) -> tuple[int, int, int] | None:
    """The number of units and the offsets behind the smaller and larger of ``first % (n + 1)`` and ``second % (n + 1)`` units."""
    if unit == UNIT and len(text) > MATCHED_POINTS:
        parts = [len(capture_ends(text[at : at + MATCHED_POINTS])) for at in range(0, len(text), MATCHED_POINTS)]
        n = sum(parts)
        low, high = sorted((first % (n + 1), second % (n + 1)))
        return n, low, high  # every unit is one code point, so the offsets are the counts
    ends = capture_ends(text, unit)
    if ends is None:
        return None
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def transform(text: str, key: str, unit: str = UNIT) -> tuple[int | None, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text; ``key`` decides the cuts and the form."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    found = cut_places(text, h1, h2, unit)
    n = None if found is None else found[0]
    if not text or found is None or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    _, low, high = found
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = UNIT, seed: str = SEED
) -> DataFrame:
    """One row per document: the id, ``n`` units, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars``, ``output``.

    NULL counts as empty; an empty text, one that holds a marker, one that is no sequence of
    units (``n`` is NULL then) and a tenth of the others stay as they are, with NULL lengths.
    A NULL id is written as nothing behind the seed, rows with equal ids are cut by the same
    numbers. An empty table gives no rows; other columns are ignored, whatever their names.
    A row needs memory for itself and for one match of it.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("key"),
        F.col(text_column).cast("string").alias("text"),
    )
    schema = T.StructType([
        rows.schema["id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            _, offsets = text_bytes(batch.column(2))
            for first, last in slices(offsets):
                part = batch.slice(first, last - first)
                texts, keys = part.column(2).fill_null("").to_pylist(), part.column(1).to_pylist()
                made = zip(*(transform(t, k, unit) for t, k in zip(texts, keys, strict=True)), strict=True)
                columns = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def restored(form: Column, output: Column) -> Column:
    """The text that was transformed; it holds no marker where the form is not plain."""
    head, tail = F.split_part(output, F.lit(MIDDLE), F.lit(1)), F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(
        F.split_part(F.split_part(head, F.lit(SUFFIX), F.lit(1)), F.lit(PREFIX), F.lit(2)), tail,
        F.split_part(head, F.lit(SUFFIX), F.lit(2)),
    )
    spm = F.concat(
        F.split_part(head, F.lit(PREFIX), F.lit(2)), tail,
        F.split_part(F.split_part(head, F.lit(PREFIX), F.lit(1)), F.lit(SUFFIX), F.lit(2)),
    )
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
