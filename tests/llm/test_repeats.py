import hashlib
import random
from collections import Counter

import numpy as np
from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm.repeats import phrases, remove_repeats
from shelfwatch.llm.text_batches import prefix_hash


def expected(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    met = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if met[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def check(rows, data, **options):
    got = remove_repeats(rows(SCHEMA, *data), with_bytes=True, **options).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(found, key=str) == expected(data, options.get("length", 200))
    for r in got:
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
        assert r.n_removed == 0 or hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_awkward_rows(rows):
    check(rows, awkward())


def test_passages_with_different_surroundings(rows):
    r = random.Random(3)
    passage, other = prose(90, 120), prose(91, 60)
    data = []
    for i in range(30):
        low, high = sorted(r.sample(range(len(passage)), 2))
        data.append(document(i, prose(100 + i, 20) + passage[low:high] + prose(200 + i, 15) + other[: r.randint(0, len(other))]))
    data += [document(50, passage), document(51, passage + passage), document(52, passage[:199]), document(53, "a" * 900)]
    check(rows, data)


def test_short_strings_over_few_letters(rows):
    r = random.Random(4)
    data = [document(i, "".join(r.choices("abé", k=r.randint(0, 300)))) for i in range(25)]
    check(rows, data, length=12, gram=5, piece=3)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_string_belongs_to_one_phrase():
    texts = [prose(s, 200).encode() for s in range(3)] + [b"", b"x" * 150, b"y" * 400]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    start, many, trigger = phrases(prefix_hash(data), offsets, 50, 200)
    held = sorted(s for a, n in zip(start, many, strict=True) for s in range(a, a + n))
    assert held == [o + i for o, t in zip(offsets, texts, strict=False) for i in range(len(t) - 199)]
    assert all(a + n - 1 <= t and t + 50 <= a + 200 for a, n, t in zip(start, many, trigger, strict=True))
