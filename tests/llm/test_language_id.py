import random

import numpy as np
import pyarrow as pa
from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm import language_id
from shelfwatch.llm.language_id import Profiles, cosines, drop_unidentified, identify, letter_vector, predict, train
from shelfwatch.session import build_session  # noqa: F401

SYLLABLES = {"xa": ["tro", "mek", "zu", "pli"], "yo": ["ona", "ile", "é", "ava"], "zi": ["schr", "ung", "ö", "ich"]}


def speech(lang, seed):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang], r.integers(1, 4))) for _ in range(30))


def plain_bundle(text, dimensions):
    """The bundle of a text, letter by letter."""
    total = np.zeros(dimensions)
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        framed = [0, *map(ord, word), 0]
        for i in range(len(framed) - 2):
            bound = np.ones(dimensions)
            for place in range(3):
                bound = bound * np.roll(letter_vector(framed[i + place], dimensions), 2 - place)
            total += bound
    return total


def test_cosines_are_those_of_the_plain_bundles():
    texts = ["Straße, 12 Ölung!", "été là", "", "1234 ...", "a", "日本 語"]
    prototypes = np.random.default_rng(1).normal(size=(3, 256)).astype(np.float32)
    prototypes /= np.linalg.norm(prototypes, axis=1, keepdims=True)
    near, total = cosines(texts, prototypes)
    for text, got, n in zip(texts, near, total, strict=True):
        bundle = plain_bundle(text, 256)
        length = np.linalg.norm(bundle)
        assert np.allclose(got, prototypes @ bundle / (length or 1), atol=1e-4)
        assert (n > 0) == any(c.isalpha() for c in text)


def test_prototypes_are_the_bundles_of_all_texts(rows):
    data = [document(i, speech(lang, i), lang) for i, lang in enumerate(["xa", "yo", "zi"] * 5)] + [document(99, "q", None), document(98, None, "xa")]
    profiles = train(rows(SCHEMA, *data), dimensions=128)
    assert profiles.languages == ["xa", "yo", "zi"]
    for lang, got in zip(profiles.languages, profiles.prototypes, strict=True):
        want = sum(plain_bundle(r[1], 128) for r in data if r[2] == lang and r[1])
        assert np.allclose(got, want / np.linalg.norm(want), atol=1e-5)


def test_held_out_accuracy(rows):
    data = [document(i, speech(lang, i), lang) for i, lang in enumerate(["xa", "yo", "zi"] * 100)]
    truth = {r[0]: r[2] for r in data}
    held = identify(rows(SCHEMA, *data)).where("held_out").collect()
    assert len(held) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_generated_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count()


def test_awkward_rows_and_empty_tables(rows, spark):
    got = identify(rows(SCHEMA, *awkward())).collect()
    assert len(got) == len(awkward())
    assert sorted(r.doc_id for r in got if r.lang_pred == "und" and r.doc_id) == [4, 5, 6, 7]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert all(r.held_out for r in got if r.doc_id is None)
    assert identify(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = Profiles([], np.zeros((0, 64), np.float32))
    assert {r._lang_pred for r in predict(rows(SCHEMA, document(1, "abc")), nothing).collect()} == {"und"}


def test_documents_that_stay(rows):
    docs = rows(SCHEMA, *awkward())
    got = drop_unidentified(docs)
    assert got.columns == docs.columns
    assert got.count() == len(awkward()) - 5


def test_training_flushes_what_it_holds(rows, monkeypatch):
    data = [document(i, speech("xa", i), "xa") for i in range(20)]
    whole = language_id.count_trigrams(rows(SCHEMA, *data), "lang", "text").count()
    monkeypatch.setattr(language_id, "HELD_COUNTS", 1)
    assert language_id.count_trigrams(rows(SCHEMA, *data), "lang", "text").count() == whole


def test_many_short_texts_and_one_long_one_in_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from shelfwatch.llm.language_id import _parts, cosines

    r = random.Random(4)
    short = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=100)) for _ in range(10_000)]
    long = "".join(map(chr, r.choices(range(0x4E00, 0x9FA5), k=300_000)))
    prototypes = np.random.default_rng(1).normal(size=(4, 1024)).astype(np.float32)
    for texts in (short, [long]):
        tracemalloc.start()
        column = pa.array(texts)
        rows = sum(len(cosines(part, prototypes)[1]) for _, _, part in _parts(column))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(texts) and peak < 300e6, peak


def test_parts_of_trigrams_add_up(monkeypatch):
    import numpy as np

    from shelfwatch.llm import language_id

    texts = [prose(i, 1 + i % 9) for i in range(40)] + ["", "a"]
    prototypes = np.random.default_rng(1).normal(size=(3, 1024)).astype(np.float32)
    near, total = language_id.cosines(texts, prototypes)
    for name, value in (("HELD_TRIGRAMS", 7), ("TABLE_CELLS", 0)):
        monkeypatch.setattr(language_id, name, value)
        again, same = language_id.cosines(texts, prototypes)
        assert np.allclose(near, again, atol=1e-5) and (total == same).all()


def test_judged_rows_leave_in_parts():
    texts = [None if i % 50 == 0 else prose(i, 3) for i in range(2 * language_id.HELD_TEXTS + 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["c0", "c1"])
    model = Profiles(["en"], np.eye(1, language_id.DIMENSIONS, dtype=np.float32))
    parts = list(language_id.judged(iter([batch, batch.slice(0, 0)]), model, 1, 2, ["doc_id", "text", "lang", "score"]))
    assert [p.num_rows for p in parts] == [language_id.HELD_TEXTS, language_id.HELD_TEXTS, 5]
    got = pa.Table.from_batches(parts).to_pydict()
    assert got["doc_id"] == list(range(len(texts))) and got["text"] == texts
    assert [lang == "und" for lang in got["lang"]] == [t is None for t in texts]
