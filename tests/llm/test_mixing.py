import re
from collections import defaultdict
from fractions import Fraction

from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm.mixing import mixed_documents, systematic_mix, targets


def shares(sizes):
    """Targets by resharing the excess until none is above its cap, in fractions."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weights = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, full = Fraction(3 * sum(sizes.values()), 2), {}
    while True:
        free = {n: w for n, w in weights.items() if n not in full}
        left = total - sum(full.values())
        level = {n: left * w / sum(free.values()) for n, w in free.items()}
        over = {n: Fraction(2 * sizes[n]) for n, share in level.items() if share >= 2 * sizes[n]}
        if not over:
            return {n: float(v) for n, v in (full | level).items()}
        full |= over


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets(rows):
    for sizes in ({"a": 100, "b": 100, "c": 100, None: 50}, {"z": 1, "é": 1000, "b": 3}, {"a": 0, "b": 0}, {None: 7}, {"a": 0, "b": 9}):
        got = targets(rows("source string, size bigint", *sizes.items())).collect()
        want = shares(sizes)
        assert {r.source: round(r.target, 6) for r in got} == {n: round(v, 6) for n, v in want.items()}


def test_targets_of_many_sources(rows, spark):
    sizes = {f"host{i * 7919 % 3001}": i * i % 977 for i in range(3001)}
    made = spark.createDataFrame(list(sizes.items()), "source string, size bigint").repartition(5)
    got = {r.source: r.target for r in targets(made).collect()}
    want = shares(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert targets(made.where("false")).count() == 0


def corpus():
    return [document(i, prose(i, 1 + i * 7 % 90), source="hot" if i % 3 == 0 else f"s{i % 7}") for i in range(600)]


def test_words_taken_come_near_the_targets(rows):
    got = systematic_mix(rows(SCHEMA, *corpus())).collect()
    taken, goal, largest = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r._copies <= 2 and r._size == size_of(r.text)
        taken[r.source] += r._copies * r._size
        goal[r.source] = r._target
        largest[r.source] = max(largest[r.source], r._size)
    assert all(abs(taken[s] - goal[s]) <= 2 * largest[s] for s in goal)


def test_copies_are_those_of_one_running_sum(rows):
    got = systematic_mix(rows(SCHEMA, *corpus())).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for group in by.values():
        total = 0
        for place, r in enumerate(sorted(group, key=lambda r: (r._size, r.doc_id)), 1):
            total += r._copies
            assert abs(total - place * r._target / r._source_size) <= 1
    again = systematic_mix(rows(SCHEMA, *corpus()).repartition(7)).collect()
    assert {(r.doc_id, r._copies) for r in again} == {(r.doc_id, r._copies) for r in got}


def test_awkward_rows(rows, spark):
    docs = rows(SCHEMA, *awkward())
    got = systematic_mix(docs).collect()
    assert len(got) == len(awkward()) and all(0 <= r._copies <= 2 for r in got)
    mixed = mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "copy"] and mixed.count() == sum(r._copies for r in got)
    assert systematic_mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents_move_once(rows):
    docs = rows(SCHEMA, *corpus())
    plan = mixed_documents(docs)._jdf.queryExecution().explainString(
        docs.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    exchanges = re.findall(r"\(\d+\) (?:Exchange|BroadcastExchange)\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert exchanges and sum("text#" in columns for columns in exchanges) <= 1
