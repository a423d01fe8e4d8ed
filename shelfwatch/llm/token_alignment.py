"""Alignment of two tokenizers over the same bytes, and how usual every link between their tokens is.

Both tokenizers cut the bytes of a text; where both cut, a group ends. The ends of the
tokens are two ascending lists. While token ``i`` of one and ``i + shift`` of the other
end alike, they are groups of one token each: slices of doubling length are compared at
that shift until one differs, and the whole stretch before the first difference is jumped.
The irregular group behind it is walked token by token until the ends meet, which gives
its links and the new shift.

A text's links are kept as numbers of its block's distinct (A, B) pairs, packed. The
pairs of all blocks are counted by documents, ranked per A token, sent back to the
blocks, and summed over every document's links there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

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

#: Ends compared at first after an irregular group.
FIRST_PROBE = 16
#: Characters of text whose pairs are numbered together.
BLOCK_CHARS = 1 << 24
#: Characters of a text that are encoded and aligned at once.
STRETCH_CHARS = 1 << 18
#: Characters of texts whose distinct words are encoded at once.
ENCODED_CHARS = 1 << 22
#: A single blank between visible characters: both tokenizers begin a token there, whatever stands around it.
BREAK = re.compile(r"(?<=\S) (?=\S)")


def _runs(starts: list[int], lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start`` to ``start + length - 1`` of every run."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(np.array(starts, np.int64) - before, lengths)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two ascending lists of token ends that end alike.

    Returns per group the tokens before its end on either side, and per link the number
    of its token on either side.
    """
    raw_a, raw_b = ends_a.astype(np.int32).tobytes(), ends_b.astype(np.int32).tobytes()
    at_a, at_b = memoryview(raw_a).cast("i"), memoryview(raw_b).cast("i")
    run_a, run_b, run_n = [], [], []  # stretches of one-to-one groups
    cut_a, cut_b, link_a, link_b = [], [], [], []  # the other groups
    i = shift = 0
    n = len(at_a)
    while i < n:
        start, step = i, FIRST_PROBE
        while i < n:
            here, there = raw_a[4 * i : 4 * (i + step)], raw_b[4 * (i + shift) : 4 * (i + shift + step)]
            if here != there:
                # The lowest bit in which the two differ lies in the first end that differs.
                differ = int.from_bytes(here, "little") ^ int.from_bytes(there, "little")
                i += ((differ & -differ).bit_length() - 1) >> 5
                break
            i += len(here) >> 2
            step += step
        if i > start:
            run_a.append(start)
            run_b.append(start + shift)
            run_n.append(i - start)
        if i < n:
            j = i + shift
            a, b = at_a[i], at_b[j]
            while True:
                link_a.append(i)
                link_b.append(j)
                if a < b:
                    i += 1
                    a = at_a[i]
                elif b < a:
                    j += 1
                    b = at_b[j]
                else:
                    break
            i, j = i + 1, j + 1
            cut_a.append(i)
            cut_b.append(j)
            shift = j - i
    length = np.array(run_n, np.int64)
    runs_a, runs_b = _runs(run_a, length), _runs(run_b, length)
    ends = [np.sort(np.concatenate([runs + 1, np.array(cut, np.int64)])) for runs, cut in ((runs_a, cut_a), (runs_b, cut_b))]
    links = [np.concatenate([runs, np.array(link, np.int64)]) for runs, link in ((runs_a, link_a), (runs_b, link_b))]
    return *ends, *links


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and how often each occurs (or its sum of weights)."""
    if weights is not None:
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
    else:
        values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    if weights is not None:
        return values[first], np.add.reduceat(weights, first) if len(first) else weights
    return values[first], np.diff(np.append(first, len(values)))


@dataclass
class Aligned:
    """What one text gives; ``pairs`` are its distinct links (A id in the upper half), ``often`` their occurrences."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups_sha256: str = ""
    groups: str | None = None
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    often: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


@dataclass
class Side:
    """One tokenizer's tokens of some words: word ``w`` has ``ids[start[w] : start[w] + length[w]]``."""

    ids: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        return self.ids[_runs(self.start[words], self.length[words])]


def stretches(text: str) -> Iterator[str]:
    """A text in parts; the blank between two parts belongs to neither."""
    start = 0
    while gap := BREAK.search(text, start + STRETCH_CHARS):
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:]


def _grouped(texts: list[str]) -> Iterator[list[tuple[str, bool]]]:
    """Stretches, each with whether it ends its text, in groups to encode at once."""
    held, chars = [], 0
    for text in texts:
        parts = list(stretches(text))
        for place, part in enumerate(parts, 1):
            held.append((part, place == len(parts)))
            chars += len(part)
            if chars >= ENCODED_CHARS:
                yield held
                held, chars = [], 0
    if held:
        yield held


class _Open:
    """A text whose stretches are being added."""

    def __init__(self, keep_groups: bool):
        self.keep_groups, self.good = keep_groups, True
        self.found, self.parts, self.counts = [], [], np.zeros(4, np.int64)
        self.digest, self.before = hashlib.sha256(), b""

    def add(self, tools: Pairing, a: np.ndarray, b: np.ndarray, good: bool) -> None:
        self.good &= good
        if not self.good:
            return
        cut_a, cut_b, link_a, link_b = align(np.cumsum(tools.sizes[0][a]), np.cumsum(tools.sizes[1][b]))
        groups = self.before + tools.written(a, b, cut_a, cut_b)
        groups, self.before = groups[:-1], groups[-1:]  # the last sign waits for a further stretch
        self.digest.update(groups)
        if self.keep_groups:
            self.parts.append(groups)
        self.found.append(counted((a[link_a] << 32) | b[link_b]))
        self.counts += [len(a), len(b), len(cut_a), len(link_a)]

    def done(self) -> Aligned:
        groups = "" if self.keep_groups else None
        if not self.good or not self.found:
            return Aligned(groups=groups)
        pairs, often = self.found[0]
        if len(self.found) > 1:
            pairs, often = counted(np.concatenate([p for p, _ in self.found]), np.concatenate([n for _, n in self.found]))
        if self.keep_groups:
            groups = b"".join(self.parts).decode()
        return Aligned(*self.counts.tolist(), self.digest.hexdigest(), groups, pairs, often)


class Pairing:
    """The two tokenizers of a task."""

    def __init__(self, path_a: str | None, ranks_a: str | None, path_b: str | None):
        self.path_a, self.ranks_a = path_a, ranks_a
        self.has_ranks = path_a is None or ranks_a is not None
        self.model_b = files.pieces(path_b)
        self.entries = [files.byte_level_entries(path_a), files.piece_entries(path_b)]
        self.sizes = [np.array([len(e) for e in entries], np.int64) for entries in self.entries]
        # Every id with each of the signs that may follow it; the B ids come after the A ids.
        signed = [f"{n}{sign}".encode() for entries, signs in zip(self.entries, (",|", ",;"), strict=True)
                  for n in range(len(entries)) for sign in signs]
        self.signed, self.first_b = np.array(signed), 2 * len(self.entries[0])

    def tokens_a(self, text: str) -> list[int]:
        """A's ids of a blank and ``text``."""
        if self.has_ranks and not files.unsure(text):
            return files.byte_ranks(self.ranks_a).encode_ordinary(" " + text)
        return files.byte_level(self.path_a, special=False).encode(" " + text, add_special_tokens=False).ids

    def sides(self, words: list[str]) -> tuple[Side, Side, np.ndarray]:
        """Both sides' tokens of every word behind a blank, and which words both sides give back.

        A encodes words without blanks at their ends in one go: as parts of one text it cuts
        between them, which the ends of the tokens confirm. The others are encoded alone.
        """
        data = [(" " + w).encode() for w in words]
        inner = np.array([w != "" and not w[0].isspace() and not w[-1].isspace() for w in words], bool)
        together = np.flatnonzero(inner)
        joined = self.tokens_a(" ".join([words[w] for w in together])) if len(together) else []
        ends = np.cumsum([len(data[w]) for w in together], dtype=np.int64)
        token_ends = np.cumsum(self.sizes[0][np.array(joined, np.int64)])
        after = np.searchsorted(token_ends, ends, "right")
        start, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if len(together) and after[0] > 0 and np.array_equal(token_ends[after - 1], ends):
            length[together] = np.diff(after, prepend=0)
            start[together] = after - length[together]
        else:
            joined, inner = [], np.zeros(len(words), bool)
        for w in np.flatnonzero(~inner).tolist():
            own = self.tokens_a(words[w])
            start[w], length[w] = len(joined), len(own)
            joined.extend(own)
        a = Side(np.array(joined, np.int64), start, length)
        pieces = self.model_b.encode(words, num_threads=1)
        length = np.array([len(own) for own in pieces], np.int64)
        b = Side(np.array(list(chain.from_iterable(pieces)), np.int64), np.cumsum(length) - length, length)
        good = np.array([
            b"".join([self.entries[1][t] for t in own]) == d for own, d in zip(pieces, data, strict=True)
        ], bool)
        first, count = a.start.tolist(), a.length.tolist()
        for w, d in enumerate(data):
            good[w] &= b"".join([self.entries[0][t] for t in joined[first[w] : first[w] + count[w]]]) == d
        return a, b, good

    def texts(self, texts: list[str], keep_groups: bool = False) -> Iterator[Aligned]:
        """Whole texts, each in stretches that end where both tokenizers cut, some millions of characters at once."""
        open_text = _Open(keep_groups)
        for group in _grouped(texts):
            numbers: dict[str, int] = {}
            words = [np.array([numbers.setdefault(w, len(numbers)) for w in BREAK.split(part)]) for part, _ in group]
            side_a, side_b, good = self.sides(list(numbers))
            for (part, last), own in zip(group, words, strict=True):
                if part:
                    open_text.add(self, side_a.of(own), side_b.of(own), bool(good[own].all()))
                if last:
                    yield open_text.done()
                    open_text = _Open(keep_groups)

    def written(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3;``: the ids of every group."""
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        order = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a - 1] = 1
        last_b[cut_b - 1] = 1
        order[np.arange(len(a)) + np.repeat(cut_b - size_b, size_a)] = 2 * a + last_a
        order[np.arange(len(b)) + np.repeat(cut_a, size_b)] = self.first_b + 2 * b + last_b
        return self.signed[order].tobytes().translate(None, b"\0")


@lru_cache(maxsize=1)
def pairing(path_a: str | None, ranks_a: str | None, path_b: str | None) -> Pairing:
    return Pairing(path_a, ranks_a, path_b)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(docs: DataFrame, paths: tuple, block_chars: int, keep_groups: bool) -> DataFrame:
    """Per document its counts and packed links; per block and pair ``number, pair, n_docs``."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), docs.schema["id"], *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("groups_sha256", T.StringType()), T.StructField("groups", T.StringType()),
        T.StructField("packed", T.BinaryType()),
        T.StructField("number", T.IntegerType()), T.StructField("pair", T.LongType()), T.StructField("n_docs", T.LongType()),
    ])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = pairing(*paths)
        block, chars, held, ids_held, id_type = TaskContext.get().partitionId() << 32, 0, [], [], None

        def flush() -> Iterator[pa.RecordBatch]:
            linked = np.concatenate([d.pairs for d in held])
            every, docs_of = counted(linked)
            at = np.searchsorted(every, linked)
            bounds = np.cumsum([0] + [len(d.pairs) for d in held])
            packed = [
                pack(gaps(at[lo:hi]), d.often) for d, lo, hi in zip(held, bounds[:-1], bounds[1:], strict=True)
            ]
            n, none = len(held), pa.nulls(len(held))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.concat_arrays(ids_held),
                 *[pa.array([getattr(d, c) for d in held], pa.int64()) for c in _COUNTS],
                 pa.array([d.groups_sha256 for d in held], pa.string()), pa.array([d.groups for d in held], pa.string()),
                 pa.array(packed, pa.binary()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int64())],
                names=names,
            )
            for first in range(0, len(every), 1 << 17):
                part = every[first : first + (1 << 17)]
                n, none = len(part), pa.nulls(len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), none.cast(id_type), *[none.cast(pa.int64())] * 4,
                     none.cast(pa.string()), none.cast(pa.string()), none.cast(pa.binary()),
                     pa.array(np.arange(first, first + n, dtype=np.int32)), pa.array(part),
                     pa.array(docs_of[first : first + n].astype(np.int64))],
                    names=names,
                )

        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            id_type = ids.type
            _, offsets = text_bytes(column)
            for first, last in slices(offsets, ENCODED_CHARS):
                ids_held.append(ids.slice(first, last - first))
                texts = column.slice(first, last - first).fill_null("").to_pylist()
                held.extend(tools.texts(texts, keep_groups))
                chars += sum(map(len, texts))
                if chars >= block_chars:
                    yield from flush()
                    block, chars, held, ids_held = block + 1, 0, [], []
        if held:
            yield from flush()

    return docs.mapInArrow(run, schema)


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the counts of its pairs summed over their links."""
    at = counts.column("number").to_numpy()
    total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    total[at] = counts.column("total").to_numpy()
    best[at] = counts.column("best").to_numpy()
    n_best, count_sum = [], []
    for packed in docs.column("packed").to_pylist():
        steps, often = unpack(packed, 2)
        own = np.cumsum(steps)
        n_best.append(int(best[own] @ often))
        count_sum.append(int(total[own] @ often))
    kept = docs.drop_columns(["block", "packed"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_a: str | None = None,
    ranks_a: str | None = None,
    tokenizer_b: str | None = None,
    keep_groups: bool = False,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document: the id, ``n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``.

    A is a byte-level vocabulary (``ranks_a`` the same as rank file, only for speed), B a
    piece model that sets a blank before the text; both read a blank and the text, special
    strings being plain text. A text that is NULL or empty, or whose bytes one side does not
    give back, has no tokens: counts of 0 and ''. ``keep_groups`` adds the groups themselves
    (``a1,a2|b1;a3|b2,b3``). ``n_best`` and ``count_sum`` weigh every link by the number of
    documents that hold its pair of ids; copies and rows with equal ids count each for itself,
    ties for the highest count are all best. An empty table gives no rows. Other columns are
    ignored, whatever their names. Very long texts are encoded in stretches that end where
    both tokenizers cut, so memory follows a block's distinct pairs.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = staged(_aligned(rows, (tokenizer_a, ranks_a, tokenizer_b), block_chars, keep_groups), "alignments")
    shown = ["id", *_COUNTS, "groups_sha256", *(["groups"] if keep_groups else [])]
    texts = found.where("packed IS NOT NULL").select("block", *shown, "packed")
    pairs = found.where("pair IS NOT NULL").select("block", "number", "pair", "n_docs")
    totals = staged(pairs.groupBy("pair").agg(F.sum("n_docs").alias("total")), "pair-counts")
    token_a = F.shiftright("pair", 32)
    highest = totals.groupBy(token_a.alias("token_a")).agg(F.max("total").alias("highest"))
    ranked = totals.withColumn("token_a", token_a).join(highest, "token_a").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("bigint").alias("best")
    )
    counts = pairs.select(F.col("block").alias("of"), "number", "pair").join(ranked, "pair").select("of", "number", "total", "best")
    schema = T.StructType([
        *[texts.schema[c] for c in shown], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
    ])
    summed = texts.groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(_summed, schema)
    return summed.withColumnRenamed("id", id_column)
