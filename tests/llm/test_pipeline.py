import hashlib
import math
from collections import defaultdict

from corpus import ascii_lower, prose
from test_decontaminate import expected as leaks
from test_mixing import shares, size_of
from test_near_join import expected as near_groups

import corpus_pipeline

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ITEMS = "item_id bigint, text string"


def corpus():
    texts = [prose(i, 80) for i in range(40)]
    texts += [texts[0], texts[1], texts[1] + "!", " ".join(["changed", *texts[2].split()[1:]]), texts[3] + " more words", None, "", "123 456", "?!"]
    texts += ["start " + " ".join(prose(900, 60).split()[10:35]) + " end", texts[5].replace(" ", "\n"), prose(901, 5)]
    return [(i, t, "en" if i % 3 else "fr", None if i % 11 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]


def expected(docs, items):
    """Every stage in plain Python over all that the one before kept."""
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    last = {ascii_lower(d[1]): d for d in sorted(docs)}
    docs = sorted(last.values())
    groups = {}
    for d, (_, group) in zip(docs, near_groups(docs), strict=True):
        groups[group] = d  # the largest id, as documents come in order
    docs = sorted(groups.values())
    clean = {row[0] for row in leaks(docs, items) if not row[5]}
    docs = [d for d in docs if d[0] in clean]
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[3]] += size_of(d[1])
    goal, out = shares(dict(sizes)), []
    for source in sizes:
        own = sorted((d for d in docs if d[3] == source), key=lambda d: (size_of(d[1]), d[0]))
        start = int(hashlib.md5(f"mix:{source or ''}".encode()).hexdigest()[:8], 16) / 2**32
        rate = goal[source] / sizes[source]
        for place, d in enumerate(own, 1):
            for copy in range(math.floor(rate * place + start) - math.floor(rate * (place - 1) + start)):
                out.append((*d, copy + 1))
    return sorted(out, key=str)


def test_rows_are_those_of_the_plain_stages(rows, tmp_path):
    docs, items = corpus(), [(1, prose(900, 60)), (2, None)]
    rows(DOCUMENTS, *docs).write.parquet(str(tmp_path / "documents.parquet"))
    rows(ITEMS, *items).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(rows(DOCUMENTS, docs[0]).sparkSession, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    want = expected(docs, items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert len({r[0] for r in want}) < len(docs) - 8  # every stage had something to do


def test_stages_keep_the_columns_of_documents(spark, rows, tmp_path):
    rows(ITEMS, (1, prose(900, 60))).write.parquet(str(tmp_path / "benchmark.parquet"))
    empty = spark.createDataFrame([], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, str(tmp_path)).columns == empty.columns
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "decontamination", "mixing"]
