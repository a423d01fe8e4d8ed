import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm import token_alignment
from shelfwatch.llm import tokenizer_files as files
from shelfwatch.llm.token_alignment import Pairing, align, align_tokens, counted


def plain_alignment(text):
    """Groups and links of a text from its bytes' owners; None where it has no tokens."""
    if not text:
        return None
    ids = [files.byte_level(None, special=False).encode(" " + text, add_special_tokens=False).ids, files.pieces().encode(text)]
    entries = [files.byte_level_entries(), files.piece_entries()]
    data = (" " + text).encode()
    if any(b"".join(e[t] for t in own) != data for e, own in zip(entries, ids, strict=True)):
        return None
    owners = [[k for k, t in enumerate(own) for _ in e[t]] for e, own in zip(entries, ids, strict=True)]
    links = [(ids[0][i], ids[1][j]) for i, j in dict.fromkeys(zip(*owners, strict=True))]
    ends = [np.cumsum([len(e[t]) for t in own]).tolist() for e, own in zip(entries, ids, strict=True)]
    common = sorted(set(ends[0]) & set(ends[1]))
    groups = [defaultdict(list), defaultdict(list)]
    for side in (0, 1):
        for t, end in zip(ids[side], ends[side], strict=True):
            groups[side][bisect.bisect_left(common, end)].append(str(t))
    written = ";".join(",".join(groups[0][k]) + "|" + ",".join(groups[1][k]) for k in range(len(common)))
    return len(ids[0]), len(ids[1]), len(common), links, written


def expected(values):
    found = [(v[0], plain_alignment(v[1])) for v in values]
    held, highest = Counter(), Counter()
    for _, one in found:
        held.update(set(one[3]) if one else ())
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    for doc_id, one in found:
        if one is None:
            yield doc_id, 0, 0, 0, 0, "", "", 0, 0
            continue
        n_a, n_b, n_groups, links, written = one
        yield (
            doc_id, n_a, n_b, n_groups, len(links), hashlib.sha256(written.encode()).hexdigest(), written,
            sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links),
        )


def compare(rows, values, **options):
    got = align_tokens(rows(SCHEMA, *values), keep_groups=True, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "n_best", "count_sum"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected(values), key=str)


ODD = [
    "<|endoftext|> a", "<s> </s> <unk> <0x41>", "a▁b", "a ▁ b", "▁", "  a   b\t c\n\n d  ", "\n \n", " ", "   ", "ﬁ ① é é", "\x00 \x01",
    "՘a ₏1 x", "\U000107bb x y", "🙂🙂 🙂", "a  b  c", "it's they'll", "don 't", "漢字 かな", "x" * 300, "12 345 6789", " lead", "trail ", "a\tb \tc",
]


def test_awkward_rows(rows, spark):
    compare(rows, [*awkward(), *[document(100 + i, t) for i, t in enumerate(ODD)]])
    assert align_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_blocks_and_copies(rows):
    values = [document(i, prose(i % 37, 4 + i % 60)) for i in range(150)]
    for chars in (1, 4000):
        compare(rows, values, block_chars=chars)


def test_stretches_and_groups_of_any_length_give_the_same_tokens(monkeypatch):
    texts = [" ".join(prose(s, 200) for s in range(4)), *ODD, prose(9, 300).replace(" ", "  ")]
    whole = [(a.n_a, a.n_b, a.n_groups, a.n_links, a.groups, a.groups_sha256, a.pairs.tolist(), a.often.tolist()) for a in Pairing(None, None, None).texts(texts, True)]
    monkeypatch.setattr(token_alignment, "STRETCH_CHARS", 7)
    monkeypatch.setattr(token_alignment, "ENCODED_CHARS", 50)
    parts = [(a.n_a, a.n_b, a.n_groups, a.n_links, a.groups, a.groups_sha256, a.pairs.tolist(), a.often.tolist()) for a in Pairing(None, None, None).texts(texts, True)]
    assert parts == whole


def test_random_ends():
    r = random.Random(1)
    for _ in range(300):
        last = r.randint(1, 120)
        a = np.array(sorted({last, *r.choices(range(1, last + 1), k=r.randint(0, 90))}))
        b = np.array(sorted({last, *r.choices(range(1, last + 1), k=r.randint(0, 90))}))
        cut_a, cut_b, link_a, link_b = align(a, b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert [a[c - 1] for c in cut_a] == common == [b[c - 1] for c in cut_b]
        owner = [(bisect.bisect_left(a.tolist(), p), bisect.bisect_left(b.tolist(), p)) for p in range(1, last + 1)]
        assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == sorted(set(owner))


def test_long_stretches_are_jumped():
    same = np.arange(1, 100_001)
    cut_a, cut_b, link_a, link_b = align(same, same)
    assert len(cut_a) == len(link_a) == 100_000 and cut_b[-1] == 100_000
    shifted = np.concatenate([[1, 2], np.arange(4, 100_001)])  # one token fewer, the rest alike
    cut_a, cut_b, *_ = align(same, shifted)
    assert len(cut_a) == 99_999 and cut_a[-1] - cut_b[-1] == 1


def test_counted():
    assert [x.tolist() for x in counted(np.array([3, 1, 3]))] == [[1, 3], [1, 2]]
    assert [x.tolist() for x in counted(np.array([3, 1, 3]), np.array([5, 1, 2]))] == [[1, 3], [1, 7]]
    assert [x.tolist() for x in counted(np.zeros(0, np.int64))] == [[], []]


def test_without_ranks_the_tokenizer_itself_is_used(rows):
    values = [document(i, prose(i, 30)) for i in range(5)]
    compare(rows, values, tokenizer_a=files.place(files.BYTE_LEVEL))


@pytest.mark.parametrize("text", ODD)
def test_ranks_are_the_same_vocabulary(text):
    if not files.unsure(text):
        library = files.byte_level(None, special=False)
        assert files.byte_ranks().encode_ordinary(" " + text) == library.encode(" " + text, add_special_tokens=False).ids
