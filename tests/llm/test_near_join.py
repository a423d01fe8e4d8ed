import itertools
import random

import numpy as np
import pytest
from corpus import SCHEMA, awkward, document, prose, words

from shelfwatch.llm import near_join as module
from shelfwatch.llm.components import components
from shelfwatch.llm.near_join import count_links, drop_near, near_join, neighbours, prefix_depth, walk_tries


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def expected(data):
    """Per row its links to other sets and the rows of its group."""
    sets = [shingles(r[1]) for r in data]
    different = list(set(sets) - {frozenset()})
    links = {s: {t for t in different if t != s and 5 * len(s & t) >= 4 * len(s | t)} for s in different}
    group = {s: i for i, s in enumerate(different)}
    for _ in different:
        for s, near in links.items():
            group[s] = min([group[s], *[group[t] for t in near]])
    return [(len(links.get(s, ())), ("alone", i) if not s else ("group", group[s])) for i, s in enumerate(sets)]


def edited(text, r, share):
    return " ".join(w if r.random() > share else "changed" + str(r.randint(0, 999)) for w in text.split())


def near_corpus():
    r = random.Random(8)
    data = awkward()
    for family in range(6):
        base = prose(300 + family, 150)
        data += [document(100 + 20 * family + i, edited(base, r, share)) for i, share in enumerate([0, 0.005, 0.01, 0.02, 0.03, 0.05] * 2)]
    return data + [document(900 + i, prose(500 + i, 3)) for i in range(5)]


def check(rows, data):
    got = {r.row_no: r for r in near_join(rows(SCHEMA, *data)).collect()}
    want = expected(data)
    assert len(got) == len(data)
    ordered = [got[k] for k in sorted(got)]  # rows() deals the rows in order
    assert [r.doc_id for r in ordered] == [d[0] for d in data]
    assert [r.n_links for r in ordered] == [n for n, _ in want]
    for (a, (_, one)), (b, (_, two)) in itertools.combinations(zip(ordered, want, strict=True), 2):
        assert (a.group_no == b.group_no) == (one == two)
    assert [r.group_size for r in ordered] == [sum(w[1] == x[1] for x in want) for w in want]


def test_links_and_groups(rows):
    check(rows, near_corpus())


def test_components_in_blocks(rows, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_CLASSES", 4)
    check(rows, near_corpus())


def test_prefixes_in_blocks(rows, monkeypatch):
    monkeypatch.setattr(module, "FOREST_BLOCK", 3)
    check(rows, near_corpus())


def test_shared_boilerplate_makes_no_candidates(rows):
    r = random.Random(4)
    common = prose(40, 110)
    data = [document(i, common + " " + " ".join(f"w{r.randint(0, 10**9)}" for _ in range(110))) for i in range(600)]
    pair = shingles(data[0][1]), shingles(data[1][1])
    assert 0.28 < len(pair[0] & pair[1]) / len(pair[0] | pair[1]) < 0.36
    data.append(document(1000, data[7][1] + " end"))
    docs = rows(SCHEMA, *data)
    classes = module._classes(module.sketches(docs, "doc_id", "text", 5)).cache()
    found = neighbours(classes).distinct().collect()
    # A prefix of 6 lets 1 - (1 - 0.32**6)**32 of the 180,000 pairs meet, some 6,000.
    assert 1 <= len(found) <= 5
    got = {d.doc_id: d for d in near_join(docs).collect()}
    assert {i for i, d in got.items() if d.n_links} == {7, 1000} and got[7].group_no == got[1000].group_no
    classes.unpersist()


def test_walk_joins_what_looks_alike_under_any_prefix():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, (6, 8)).astype(np.uint64)
    family = r.integers(0, 6, 700)
    bits = base[family] ^ (np.uint64(1) << r.integers(0, 64, (700, 8)).astype(np.uint64))
    deep = r.integers(0, 3, (700, 2)).astype(np.uint16)
    groups = np.stack([r.integers(0, 4, 700), np.zeros(700, int), np.zeros(700, int)], axis=1)
    order = np.lexsort((deep[:, 1], deep[:, 0], groups[:, 0]))
    family, bits, deep, groups = family[order], bits[order], deep[order], groups[order]
    root = walk_tries(groups, deep, bits)
    for i in range(700):
        assert root[i] == np.flatnonzero((groups[:, 0] == groups[i, 0]) & (family == family[i]))[0]


def test_links_where_a_block_is_empty(rows, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_SHINGLES", 200)
    data = [document(2 * i + j, prose(700 + i, 150) + " end" * j) for i in range(8) for j in range(2)]
    # Two classes of about 146 shingles need two blocks; hashing puts some pairs into one of them.
    check(rows, data)


def test_documents_that_stay(rows):
    data = near_corpus()
    docs = rows(SCHEMA, *data)
    got = drop_near(docs)
    assert got.columns == docs.columns
    groups = {}
    for row, (_, group) in zip(data, expected(data), strict=True):
        groups.setdefault(group, []).append(row[0])
    want = [max((i for i in g if i is not None), default=None) for g in groups.values()]
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert near_join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert drop_near(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("blocks", [1, 2])
def test_counted_links_are_those_of_all_pairs(blocks):
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.where(r.random(60) < 0.04, r.integers(0, 1 << 62, 60).astype(np.uint64), base)) for _ in range(120)]
    sets += [np.unique(r.choice(base, 10)) for _ in range(10)]
    side = np.arange(len(sets)) % blocks
    links, least = count_links(np.arange(len(sets)), sets, side)
    for i, s in enumerate(sets):
        near = [
            j for j, t in enumerate(sets)
            if i != j and (blocks == 1 or side[i] != side[j]) and 5 * len(np.intersect1d(s, t)) >= 4 * len(np.union1d(s, t))
        ]
        assert links[i] == len(near) and least[i] <= min([i, *near])


def test_prefixes_are_as_long_as_the_recall_allows():
    assert prefix_depth(0.0) == module.DEPTH
    depth = prefix_depth()
    assert 1 - (1 - 0.8**depth) ** module.TREES >= module.RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** module.TREES


def test_components(rows, spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (7, None), (200, 201), (201, 202), (202, 200), (200, 201)]
    got = {r.node: r.root for r in components(rows("a bigint, b bigint", *chain)).collect()}
    assert got == {i: 0 for i in range(41)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
