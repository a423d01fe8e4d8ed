"""Small corpora and plain versions of the operators to compare with."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, digest string, row_no string, score string, norm string"


def prose(seed: int, words: int = 60) -> str:
    r = random.Random(seed)
    stems = ["lor", "ipsa", "dol", "mena", "torv", "quil", "sant", "bera", "éle", "ñor", "über", "ka", "vo", "ti", "ra"]
    return " ".join("".join(r.choices(stems, k=r.randint(1, 3))) for _ in range(words))


def document(doc_id, text, lang="en", source="a"):
    """A row with extra columns whose names an operator might want for itself."""
    return (doc_id, text, lang, source, "x", "y", "z", "w")


def awkward() -> list[tuple]:
    """NULLs in every column, empty and very long texts, ties, repeated rows."""
    long = " ".join(prose(s, 400) for s in range(40))
    return [
        document(1, prose(1)), document(1, prose(1)), document(2, prose(1).upper()), document(3, prose(1), None, None),
        document(None, prose(2)), document(None, prose(2)), document(4, None), document(5, ""), document(6, "   "),
        document(7, "?!"), document(None, None, None, None), document(8, long), document(9, long + " end"),
        document(10, "ab"), document(11, prose(3) + "\n" + prose(4)), document(12, prose(5) + "\x00" + prose(6)),
        document(13, "🙂" + prose(7) + "🙂"),
    ]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(ascii_lower(text or ""))
