import hashlib
import re

from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm.pii import LABELERS, digest, find_personal_data, reliabilities

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def base(text):
    kinds = list(PATTERNS)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m.group())]
    return [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found)]


TRICKY = [
    "a@b.c_d@e.f and x@y..z, a.b+c%d@host-1.example.com.", "1.2.3.4.5.6.7.8 and 256.1.1.1 then 00000000255.0.0.1 9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "call +1 (826) 555-4081 190.137.223.204 now", "+12345 +1 2 3 4 5 6 7 8 9 0 1",
    "🙂 é@x.de user@exämple.com +49 (0)30.1234-567", "no.digits@here", "7536784127813050 4111111111111111 done", "@@@ +++ 1", "+" * 50 + "1" * 30,
    "9" * 3000 + " " + "1.1" * 2000, "a" * 50_000, "x@" + "a." * 5000 + "b", "1 " * 3000, "name (at) example (dot) com",
]


def corpus():
    return [*awkward(), *[document(100 + i, t) for i, t in enumerate(TRICKY)], document(200, " ".join(TRICKY[:9]) + "\n" + prose(1))]


def test_base_spans(rows):
    data = corpus()
    got = digest(find_personal_data(rows(SCHEMA, *data))).collect()
    want = sorted(((r[0], *[sum(s.startswith(k) for s in base(r[1])) for k in PATTERNS], hashlib.sha256(",".join(base(r[1])).encode()).hexdigest()) for r in data), key=str)
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == want
    by_id = {r.doc_id: r.spans for r in got if r.doc_id is not None}
    for row in data:
        if row[0] is not None:
            assert set(base(row[1])) <= set(filter(None, by_id[row[0]].split(",")))


def test_added_spans(rows):
    plain = [document(i, f"{prose(i, 8)} mail jo.{i}@mail{i}.example.com or call +1 (555) 555-{1000 + i} today, card 4111 1111 1111 1111") for i in range(40)]
    odd = [
        document(100, "call +1 (826) 555-4081 190.137.223.204 now"), document(101, "pay 4111111111111111 4012888888881881 soon"),
        document(102, "token = \"1234567812345678\" and 1234567812345678 too"), document(103, prose(9, 50)),
    ]
    got = {r.doc_id: r for r in find_personal_data(rows(SCHEMA, *plain, *odd)).collect()}
    assert [(s.start, s.kind, s.end) for s in got[100].added] == [(5, 3, 22)]
    assert [(s.start, s.kind, s.end) for s in got[101].added] == [(4, 2, 20), (21, 2, 37)]
    assert not got[102].added and not got[103].added
    assert not any(got[i].added for i in range(40))


def test_reliabilities_follow_the_votes():
    def pattern(count, *votes):
        return dict(zip(LABELERS, votes, strict=True)) | {"count": count}

    patterns = [pattern(9000, 1, 1, 1, 1, 1), pattern(9000, -1, -1, -1, 0, 1), pattern(200, 1, 1, -1, 0, 1), pattern(100, 1, -1, 1, 0, -1)]
    trust, likely = reliabilities(patterns)
    assert trust["check"] > 0.9 and trust["borders"] < 0.7  # borders agree with the others half the time
    assert likely[0] > 0.99 and likely[1] < 0.01


def test_empty_tables(spark, rows):
    assert find_personal_data(spark.createDataFrame([], SCHEMA)).count() == 0
    got = digest(find_personal_data(rows(SCHEMA, document(1, "nothing here"), document(2, None))))
    assert [r.spans for r in got.collect()] == ["", ""]


def test_a_text_with_many_matches(rows):
    """Several thousand spans in one text; pieces, gathered lists and clusters are crossed."""
    mails = [f"u{i}@mail{i % 97}.example.com" for i in range(1500)]
    text = "é " + " ".join(f"{m} {i * 7919 % 90000}" for i, m in enumerate(mails))
    got = digest(find_personal_data(rows(SCHEMA, document(1, text), document(2, None)))).orderBy("doc_id").collect()
    want = base(text)
    assert got[0].n_email == 1500 and got[0].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert set(want) <= set(got[0].spans.split(",")) and got[1].spans == ""
