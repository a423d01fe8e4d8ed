"""Token counts from the distinct pre-tokens of a corpus, without token ids.

A byte-level tokenizer first splits a text into pre-tokens and merges inside each
of them, so a text's count is the sum of its pre-tokens' counts.

1. One pass splits the texts. Pre-tokens that are one token each are summed on the
   spot; they are entries of the vocabulary, so their number is fixed. Texts are
   taken in blocks of some ten megabytes: a block numbers its other pre-tokens, and a
   document keeps (number, frequency) pairs, packed.
2. The pre-tokens of all blocks meet, equal ones side by side, and each is counted
   once. A pre-token occurs at most once per block, however often documents repeat it.
3. The counts go back to the blocks, join the documents' frequencies there and are
   summed.

Memory is that of a block or of one text; what is shuffled are the vocabularies of the
blocks and the packed frequencies, never text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm import tokenizer_files as files
from shelfwatch.llm.common import staged
from shelfwatch.llm.packed import gaps, pack, unpack
from shelfwatch.llm.text_batches import slices, text_bytes
from shelfwatch.session import ship_package

#: Characters of text whose pre-tokens are numbered together.
BLOCK_CHARS = 1 << 25
#: Characters from which on pre-tokens are counted as they are found instead of being listed first.
LISTED_CHARS = 1 << 20
#: Pre-tokens given to the tokenizer at once.
COUNTED_AT_ONCE = 1 << 14
TOKEN_LIMIT = 512


@lru_cache(maxsize=2)
def _specials(path: str | None) -> tuple[str, ...]:
    """The strings that the tokenizer takes out of a text before it splits the rest."""
    added = files.byte_level(path).get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added) or len(added) > 1:
        raise ValueError("one special token that stands for itself at most")
    return tuple(t.content for t in added)


@lru_cache(maxsize=2)
def _single(path: str | None) -> frozenset[str]:
    """Pre-tokens that are one token each: entries of the vocabulary that come out whole."""
    texts = []
    for entry in files.byte_level_entries(path):
        try:
            texts.append(entry.decode())
        except UnicodeDecodeError:
            continue
    texts = [t for t in texts if t and not files.unsure(t) and files.PRE_TOKEN.fullmatch(t)]
    return frozenset(t for t, n in zip(texts, _lengths(texts, path), strict=True) if n == 1)


def _lengths(parts: list[str], path: str | None) -> list[int]:
    found = files.byte_level(path).encode_batch_fast(parts, add_special_tokens=False)
    return [len(e) for e in found]


def pre_tokens(text: str, path: str | None = None) -> tuple[Counter, int]:
    """How often every pre-token occurs in a text, and how many special strings it holds."""
    counts, specials = Counter(), 0
    parts = [text]
    for special in _specials(path):
        parts = text.split(special)
        specials = len(parts) - 1
    for part in parts:
        if files.unsure(part):
            own = files.byte_level(path).pre_tokenizer
            counts.update(part[a:b] for _, (a, b) in own.pre_tokenize_str(part))
        elif len(part) > LISTED_CHARS:
            counts.update(m.group() for m in files.PRE_TOKEN.finditer(part))
        else:
            counts.update(files.PRE_TOKEN.findall(part))
    return counts, specials


def _split(docs: DataFrame, path: str | None, block_chars: int) -> DataFrame:
    """Per document ``block, id, n_bytes, n_single, packed``; per block and pre-token ``block, number, pre_token``."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), docs.schema["id"], T.StructField("n_bytes", T.LongType()),
        T.StructField("n_single", T.LongType()), T.StructField("packed", T.BinaryType()),
        T.StructField("number", T.IntegerType()), T.StructField("pre_token", T.StringType()),
    ])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chars, numbers = TaskContext.get().partitionId() << 32, 0, {}
        single = _single(path)

        def vocabulary() -> Iterator[pa.RecordBatch]:
            listed = list(numbers)
            for first in range(0, len(listed), 1 << 16):
                part = listed[first : first + (1 << 16)]
                n, none = len(part), pa.nulls(len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), none.cast(id_type), none.cast(pa.int64()), none.cast(pa.int64()),
                     none.cast(pa.binary()), pa.array(range(first, first + n), pa.int32()), pa.array(part, pa.string())],
                    names=names,
                )

        id_type = None
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            id_type = ids.type
            _, offsets = text_bytes(column)
            for first, last in slices(offsets):
                known, packed = [], []
                for text in column.slice(first, last - first).fill_null("").to_pylist():
                    counts, sure = pre_tokens(text, path)
                    at, often = [], []
                    for piece, n in counts.items():
                        if piece in single:
                            sure += n
                        else:
                            at.append(numbers.setdefault(piece, len(numbers)))
                            often.append(n)
                    at, often = np.array(at, np.int64), np.array(often, np.int64)
                    order = np.argsort(at)
                    known.append(sure)
                    packed.append(pack(gaps(at[order]), often[order]))
                    chars += len(text)
                n, none = last - first, pa.nulls(last - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), ids.slice(first, n), pa.array(np.diff(offsets[first : last + 1])),
                     pa.array(known, pa.int64()), pa.array(packed, pa.binary()), none.cast(pa.int32()), none.cast(pa.string())],
                    names=names,
                )
                if chars >= block_chars:
                    yield from vocabulary()
                    block, chars, numbers = block + 1, 0, {}
        if numbers:
            yield from vocabulary()

    return docs.mapInArrow(run, schema)


def _counted(found: DataFrame, path: str | None) -> DataFrame:
    """``block, number, n_tokens``: every distinct pre-token counted once, as equal ones lie side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_n = None, 0
        for whole in batches:
            for first in range(0, whole.num_rows, COUNTED_AT_ONCE):
                batch = whole.slice(first, COUNTED_AT_ONCE)
                runs = batch.column(2).to_pylist()
                different = list(dict.fromkeys(runs))
                new = [p for p in different if p != last]
                n_of = dict(zip(new, _lengths(new, path), strict=True))
                if last in different:
                    n_of[last] = last_n
                last, last_n = runs[-1], n_of[runs[-1]]
                totals = pa.array([n_of[p] for p in runs], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), totals], names=["block", "number", "n_tokens"])

    dealt = found.repartition("pre_token").sortWithinPartitions("pre_token")
    return dealt.select("block", "number", "pre_token").mapInArrow(run, "block bigint, number int, n_tokens bigint")


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the counts of its pre-tokens joined to their frequencies and summed."""
    lengths = np.zeros(counts.num_rows, np.int64)
    lengths[counts.column("number").to_numpy()] = counts.column("n_tokens").to_numpy()
    totals = docs.column("n_single").to_numpy().copy()
    for row, packed in enumerate(docs.column("packed").to_pylist()):
        steps, often = unpack(packed, 2)
        totals[row] += int(lengths[np.cumsum(steps)] @ often)
    return pa.table({"id": docs.column("id"), "n_bytes": docs.column("n_bytes"), "n_tokens": pa.array(totals)})


def count_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document: the id, ``n_bytes`` (UTF-8) and ``n_tokens``, as the tokenizer's library counts them.

    No begin, end or added tokens, no truncation; a special string inside a text is
    one token. NULL and empty texts have no bytes and no tokens. Rows with equal ids or
    texts are counted each for itself, NULL ids included; an empty table gives no rows.
    Other columns are ignored, whatever their names. ``tokenizer`` is the path of a
    byte-level vocabulary on every executor (``tokenizers`` format, the usual
    split pattern, no normaliser); without it the installed one is used.
    A text of any length is worked on whole; it needs memory for its distinct pre-tokens.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = staged(_split(rows, tokenizer, block_chars), "pre-tokens")
    texts = found.where("packed IS NOT NULL").select("block", "id", "n_bytes", "n_single", "packed")
    counts = _counted(found.where("pre_token IS NOT NULL").select("block", "number", "pre_token"), tokenizer)
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    summed = texts.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_summed, schema)
    return summed.withColumnRenamed("id", id_column)
