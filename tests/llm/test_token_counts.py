import random

import pytest
from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm import tokenizer_files as files
from shelfwatch.llm import token_counts
from shelfwatch.llm.token_counts import count_tokens, pre_tokens


def expected(texts):
    library = files.byte_level()
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def compare(rows, values, **options):
    docs = rows(SCHEMA, *values)
    got = count_tokens(docs, **options)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [(v[0], len((v[1] or "").encode()), n) for v, n in zip(values, expected([v[1] for v in values]), strict=True)]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_awkward_rows(rows, spark):
    compare(rows, awkward())
    assert count_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


def test_special_strings_blanks_and_unusual_characters(rows):
    texts = [
        "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", " <|endoftext|> x", "  a   b\t\n\n c \r\n", "\n \n", "it's they'll 'd ''s !'s",
        "՘a ₏1 ꟎꟏ \u0088f", "\U000107bb\U0001c400 x", "   x​", "1234567890" * 9, "Ünïcödé ｆｕｌｌ 漢字かな", "é", "\x00\x01\x7f",
        "�" * 3, "a" * 5000, "🙂" * 300, " " * 4000 + "end",
    ]
    compare(rows, [document(i, t) for i, t in enumerate(texts)])


def test_blocks_of_any_size_give_the_same_counts(rows):
    values = [document(i, prose(i % 50, 5 + i % 90)) for i in range(200)]
    for chars in (1, 5000):
        compare(rows, values, block_chars=chars)


def test_random_strings_split_as_the_library_does():
    r = random.Random(3)
    letters = "ab1 '\n\t.sltreé漢՘  🙂" + " "
    library = files.byte_level()
    for _ in range(300):
        text = "".join(r.choices(letters, k=r.randint(1, 40)))
        counts, specials = pre_tokens(text)
        assert specials == 0
        assert sum(counts.values()) == len(library.pre_tokenizer.pre_tokenize_str(text))
        assert sum(n * k for n, k in zip(counts.values(), expected(list(counts)), strict=True)) == expected([text])[0]


def test_long_texts_are_counted_as_they_are_read(rows, monkeypatch):
    text = " ".join(prose(s, 300) for s in range(30)) + "x" * 30000
    listed, _ = pre_tokens(text)
    monkeypatch.setattr(token_counts, "LISTED_CHARS", 100)
    assert pre_tokens(text)[0] == listed


def test_splitting_agrees_on_every_assigned_character():
    library = files.byte_level().pre_tokenizer
    r = random.Random(5)
    points = [*range(0x20, 0x3000), *r.sample([p for p in range(0x3000, 0x110000) if not 0xD800 <= p < 0xE000], 20000)]
    for p in points:
        c = chr(p)
        text = f"a{c}1{c} {c}!{c}{c} x"
        if not files.unsure(text):
            assert files.PRE_TOKEN.findall(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)], hex(p)


def test_other_special_tokens_are_refused(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    other = Tokenizer.from_file(files.place(files.BYTE_LEVEL))
    other.add_special_tokens([AddedToken("<x>", lstrip=True)])
    other.save(str(tmp_path / "other.json"))
    with pytest.raises(ValueError):
        pre_tokens("a <x>", str(tmp_path / "other.json"))
