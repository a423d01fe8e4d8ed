"""Personal data by weak supervision.

Strict patterns with checks give the base spans, which always stay. Looser patterns give
further candidates, such as a phone number that an address follows. On every candidate
labelers vote for, against or not at all: the strict shape, the check (digits, Luhn,
ranges), gazetteers (issuer and dialling prefixes, domains, reserved addresses), the
words around the span and its borders. Expectation-maximisation estimates from the votes
alone how reliable each labeler is and how likely each pattern of votes is a true span;
a logistic regression trained on those likelihoods decides about the candidates.

The votes are counted by pattern, at most ``4 x 3**5`` rows, so what the driver sees has
a fixed size. All columns are built-in expressions; texts are read once and not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwatch.llm.common import staged

KINDS = ("email", "ip", "card", "phone")

#: The base patterns. A look behind or ``\G`` keeps the first part of a match
#: from being tried at every character of a long run; the matches are the same without it.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns of candidates.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,63}+){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: The gazetteers.
DOMAINS = (
    "com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "uk", "us", "it", "nl", "at", "ch", "be", "ca",
    "mx", "ar", "cl", "co", "pt", "br", "pl", "se", "no", "dk", "fi", "ie", "au", "nz", "jp", "cn", "in", "ru", "example", "test",
)
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|36|38|30[0-5]|35|6011|64|65|62)"
DIALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[1-9]|37[0-9]|38[0-9]|42[013]|97[0-9]|99[2-8])"
RESERVED = r"^0*(?:0|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CUES = {
    "email": "mail|contact|kontakt|contacto|courriel|correo|write|schreib",
    "ip": r"\bip\b|address|adresse|host|server|serveur|servidor|login",
    "card": "card|karte|carte|tarjeta|visa|master|credit|kredit|pay|zahl",
    "phone": r"phone|telef|tel\b|tél|call|mobil|fax|ruf|appel|llam",
}
AGAINST = r"version|isbn|order|token|key|sku|serial|invoice|\bv\.?$|[=\"/_]$"
#: Characters of context on either side.
AROUND = 30
LABELERS = ("shape", "check", "gazetteer", "context", "borders")
#: What is thought of a labeler before any vote is seen: reliability and how many votes that is worth.
PRIOR = {"shape": (0.7, 50), "check": (0.95, 5000), "gazetteer": (0.75, 200), "context": (0.8, 200), "borders": (0.7, 200)}
ACCEPT = 0.9
#: Characters of the pieces that context is cut from, and how many large pieces a text is cut into first.
PIECE, FIRST_PIECES = 4096, 256
#: Spans that gather in one list before it is put aside.
GATHERED = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, place, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when((F.length(digits) - place) % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern passes the kind's check."""
    size = F.length(_digits(value))
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": F.when(size.between(14, 19), luhn(_digits(value))).otherwise(F.lit(False)),
        "phone": size.between(10, 15),
    }[kind]


def _found(text: Column, pattern: str, worth: Column) -> Column:
    """The matches of a pattern as ``start, end, value`` in code points, end exclusive.

    Matches and the stretches between them come from the same pattern, so the lengths
    of what lies before a match add up to its place.
    """
    spans, parted = "array<struct<start: int, end: int, value: string>>", "array<array<struct<start: int, end: int, value: string>>>"
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    parts = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))
    )

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + part["g"]
        end = start + F.length(part["m"])
        span = F.array(F.struct(start.alias("start"), end.alias("end"), part["m"].alias("value")))
        # Spans gather in a short list first, as every added one copies the list it joins.
        full = F.size(acc["near"]) >= GATHERED
        near = F.when(full, span).otherwise(F.concat(acc["near"], span))
        done = F.when(full, F.concat(acc["done"], F.array(acc["near"]))).otherwise(acc["done"])
        return F.when(part["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), near.alias("near"), done.alias("done")))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("near"), F.array().cast(parted).alias("done"))
    found = F.aggregate(parts, first, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["near"]))
    return F.when(worth, found).otherwise(F.array().cast(spans))


def _pieces(text: Column, worth: Column) -> Column:
    """The text in pieces of ``PIECE`` characters, each with the start of the next; two steps keep long texts linear."""

    def cut(whole: Column, size: Column, more: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor(F.length(whole) / size).cast("int")),
            lambda i: F.substr(whole, (i * size + 1).cast("int"), (size + more).cast("int")),
        )

    large = F.lit(PIECE) * F.ceil((F.length(text) + 1) / (PIECE * FIRST_PIECES)).cast("int")
    # A large piece ends where the next begins, but for the characters that its last small piece shares with it.
    small = F.transform(cut(text, large, AROUND), lambda part: F.slice(cut(part, F.lit(PIECE), AROUND), F.lit(1), (large / PIECE).cast("int")))
    return F.when(worth, F.flatten(small))


def scan(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per document, written: ``row_no, doc_id, base, candidates``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    # Most texts hold no digit and no sign of an address; they skip the patterns.
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]")).withColumn("at", F.contains("text", F.lit("@")))
    text, worth = F.col("text"), {"email": F.col("at")} | dict.fromkeys(("ip", "card", "phone"), F.col("digit"))
    rows = rows.withColumn("at_word", F.contains("text", F.lit("(at)")) | F.contains("text", F.lit("[at]")))
    rows = rows.withColumns({f"base_{k}": _found(text, BASE[k], worth[k]) for k in KINDS})
    loose_worth = worth | {"email": F.col("at_word")}
    rows = rows.withColumns({f"loose_{k}": _found(text, LOOSE[k], loose_worth[k]) for k in KINDS})

    def spans(kind: str) -> Column:
        chosen = F.filter(F.col(f"base_{kind}"), lambda s: valid(kind, s["value"]))
        return F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    base = F.concat(*[spans(k) for k in KINDS])

    rows = rows.withColumn("pieces", _pieces(text, worth["email"] | worth["card"] | loose_worth["email"]))

    def near(start: Column, length: Column) -> Column:
        """Some characters of the text from ``start`` on, found without reading what lies before their piece."""
        return F.substr(F.get("pieces", (start / PIECE).cast("int")), start % PIECE + 1, length)

    def candidate(kind: str) -> Callable[[Column], Column]:
        def make(s: Column) -> Column:
            before = near(F.greatest(s["start"] - AROUND, F.lit(0)), F.least(s["start"], F.lit(AROUND)))
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                before.alias("before"), near(s["end"], F.lit(AROUND)).alias("after"),
            )

        return make

    # Candidates: what the base patterns match, passed or not, and what the looser ones do; sorted, copies lie side by side.
    tried = F.array_sort(F.concat(
        *[F.transform(F.col(f"{way}_{k}"), candidate(k)) for k in KINDS for way in ("base", "loose")]
    ))
    rows = rows.select("row_no", "doc_id", F.array_sort(base).alias("base"), tried.alias("tried"))
    once = F.filter("tried", lambda c, i: (i == 0) | (F.get("tried", i - 1) != c))
    return staged(rows.select("row_no", "doc_id", "base", once.alias("candidates")), "pii-scan")


def votes(candidates: DataFrame) -> DataFrame:
    """The labelers' votes, 1, 0 or -1, beside each candidate."""
    kind, value, digits = F.col("kind"), F.col("value"), _digits(F.col("value"))
    size = F.length(digits)

    def by_kind(**cases: Column) -> Column:
        choice = F.lit(0)
        for name, vote in cases.items():
            choice = F.when(kind == name, vote).otherwise(choice)
        return choice

    def sign(test: Column) -> Column:
        return F.when(test, 1).otherwise(-1)

    ending = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))
    shape = by_kind(
        email=F.when(value.contains("@"), 1).otherwise(0), ip=F.when(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), 1).otherwise(-1),
        card=F.when(value.rlike(r"^[0-9]{14,19}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}$"), 1).otherwise(-1),
        phone=F.when(value.startswith("+"), 1).when(value.contains("("), 0).otherwise(-1),
    )
    check = by_kind(
        email=sign(ending.rlike("^[a-z]{2,}$")), ip=sign(valid("ip", value) & ~value.rlike(r"(?:^|\.)0[0-9]")),
        card=sign(valid("card", value)), phone=sign(size.between(10, 13)),
    )
    gazetteer = by_kind(
        email=sign(ending.isin(*DOMAINS)), ip=sign(~value.rlike(RESERVED)), card=sign(digits.rlike(ISSUERS)),
        phone=F.when(value.startswith("+"), sign(F.concat(F.lit("+"), digits).rlike(DIALLING))).otherwise(0),
    )
    before = F.lower("before")
    cue = by_kind(**{k: F.when(before.rlike(CUES[k]), 1).otherwise(0) for k in KINDS})
    context = F.when(before.rlike(AGAINST), -1).otherwise(cue)
    outer = F.concat(F.substr("before", F.greatest(F.length("before"), F.lit(1)), F.lit(1)), F.lit(" "), F.substr("after", F.lit(1), F.lit(1)))
    borders = sign(~outer.rlike(r"[\p{L}0-9_]"))
    return candidates.withColumns(dict(zip(LABELERS, (shape, check, gazetteer, context, borders), strict=True)))


def reliabilities(patterns: list[dict], rounds: int = 50) -> tuple[dict[str, float], list[float]]:
    """Expectation-maximisation over counted vote patterns.

    Each labeler, where it votes, is right with a probability of its own; the start is its
    prior, which also counts as votes in every round. Returns the reliabilities and each
    pattern's probability of being a true span.
    """
    trust = {name: PRIOR[name][0] for name in LABELERS}
    share, likely = 0.5, [0.5] * len(patterns)
    for _ in range(rounds):
        for i, row in enumerate(patterns):
            odds = math.log(share / (1 - share))
            for name in LABELERS:
                odds += row[name] * math.log(trust[name] / (1 - trust[name]))
            likely[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        total = sum(row["count"] for row in patterns)
        share = (1 + sum(row["count"] * p for row, p in zip(patterns, likely, strict=True))) / (2 + total)
        for name in LABELERS:
            first, worth = PRIOR[name]
            right, cast = first * worth, float(worth)
            for row, p in zip(patterns, likely, strict=True):
                if row[name]:
                    right += row["count"] * (p if row[name] > 0 else 1 - p)
                    cast += row["count"]
            # A labeler is never taken for worse than a coin, nor for infallible.
            trust[name] = min(max(right / cast, 0.5), 0.999)
    return trust, likely


def _features() -> list[Column]:
    kinds = [F.when(F.col("kind") == k, 1.0).otherwise(0.0) for k in KINDS]
    cast = [F.col(name).cast("double") for name in LABELERS]
    return kinds + cast + [k * F.col("check") for k in kinds]


def classifier(voted: DataFrame) -> Column | None:
    """The probability that a candidate is personal data, learnt from the votes; None without candidates."""
    counted = voted.groupBy("kind", *LABELERS).agg(F.count("*").alias("count"))
    patterns = [row.asDict() for row in counted.collect()]  # at most 4 x 3**5 rows
    if not patterns:
        return None
    patterns.sort(key=lambda r: (r["kind"], *[r[name] for name in LABELERS]))
    _, likely = reliabilities(patterns)
    rows = [
        (row["kind"], *[row[name] for name in LABELERS], label, row["count"] * weight)
        for row, p in zip(patterns, likely, strict=True) for label, weight in ((1.0, p), (0.0, 1 - p))
    ]
    columns = ", ".join(f"{name} int" for name in LABELERS)
    table = voted.sparkSession.createDataFrame(rows, f"kind string, {columns}, label double, weight double").coalesce(1)
    ready = table.select(array_to_vector(F.array(*_features())).alias("features"), "label", "weight")
    model = LogisticRegression(weightCol="weight", regParam=0.0005, maxIter=50, standardization=False).fit(ready)
    score = F.lit(float(model.intercept))
    for weight, feature in zip(model.coefficients.toArray().tolist(), _features(), strict=True):
        score = score + F.lit(weight) * feature
    return 1 / (1 + F.exp(-score))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id, base, added`` and ``spans`` (both), sorted arrays of ``start, kind, end``.

    Offsets are code points, the end exclusive; ``kind`` is a number in ``KINDS``. NULL and
    empty texts have no spans; an empty table gives an empty result; repeated rows are
    judged one by one and alike. A candidate that touches a base span of its own kind
    or lies inside one of another is not added; of candidates of one kind that touch each other the likeliest, then the first, stays.
    """
    rows = scan(docs, id_column, text_column)
    tried = rows.select("row_no", F.explode("candidates").alias("c")).select("row_no", "c.*")
    voted = staged(votes(tried), "pii-votes")
    chance = classifier(voted)
    if chance is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"), F.slice("base", 1, 0).alias("added"))
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    accepted = voted.withColumn("doubt", F.round(1 - chance, 9)).where(F.col("doubt") <= 1 - ACCEPT)
    found = accepted.select("row_no", kind.alias("kind"), "start", "end", "doubt")
    held = rows.select("row_no", F.explode("base").alias("b")).select("row_no", "b.kind", "b.start", "b.end")
    listed = _apart(_free(found, held)).groupBy("row_no").agg(
        F.array_sort(F.collect_list(F.struct("doubt", F.struct("start", "kind", "end").alias("span")))).alias("found")
    )
    none = F.slice("base", 1, 0)
    joined = rows.join(listed, "row_no", "left").withColumn("added", F.coalesce(F.col("found.span"), none))
    return joined.select("doc_id", "base", "added", F.array_sort(F.concat("base", "added")).alias("spans"))


def _free(found: DataFrame, base: DataFrame) -> DataFrame:
    """The spans ``row_no, kind, start, end, doubt`` that touch no base span of their kind and lie in none of another.

    Both are sorted together along each text. A span touches one of its kind if, of those that
    start before its end, the farthest end lies behind its start; it lies in one of another
    kind if, of those that start no later, the farthest end of another kind reaches its end.
    """
    both = found.withColumn("held", F.lit(False)).unionByName(
        base.withColumn("doubt", F.lit(None).cast("double")).withColumn("held", F.lit(True))
    )
    so_far = (W.unboundedPreceding, W.currentRow)
    own = W.partitionBy("row_no", "kind").orderBy(F.when(F.col("held"), F.col("start")).otherwise(F.col("end")), "held")
    along = W.partitionBy("row_no").orderBy("start", F.desc("held"))
    ends = {k: F.max(F.when(F.col("held") & (F.col("kind") == k), F.col("end"))).over(along.rowsBetween(*so_far)) for k in range(len(KINDS))}
    marked = both.withColumn("own_end", F.max(F.when(F.col("held"), F.col("end"))).over(own.rowsBetween(*so_far)))
    marked = marked.withColumns({f"end_{k}": end for k, end in ends.items()})
    others = F.greatest(*[F.when(F.col("kind") != k, F.coalesce(F.col(f"end_{k}"), F.lit(-1))).otherwise(-1) for k in ends])
    touches = F.coalesce(F.col("own_end"), F.lit(-1)) > F.col("start")
    return marked.where(~F.col("held") & ~touches & (others < F.col("end"))).select("row_no", "kind", "start", "end", "doubt")


def _apart(spans: DataFrame) -> DataFrame:
    """Of spans of one kind that touch each other the likeliest, then the first, stays.

    Spans that are linked by touching form a cluster along the text; a choice reaches no farther.
    """
    along = W.partitionBy("row_no", "kind").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(W.unboundedPreceding, -1))
    opened = spans.withColumn("opens", (F.col("start") >= F.coalesce(before, F.lit(0))).cast("int"))
    numbered = opened.withColumn("cluster", F.sum("opens").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
    near = numbered.groupBy("row_no", "kind", "cluster").agg(F.array_sort(F.collect_set(F.struct("doubt", "start", "end"))).alias("found"))

    def take(kept: Column, span: Column) -> Column:
        touches = F.exists(kept, lambda k: (k["start"] < span["end"]) & (span["start"] < k["end"]))
        return F.when(touches, kept).otherwise(F.concat(kept, F.array(span)))

    kept = F.aggregate("found", F.slice("found", 1, 0), take)
    return near.select("row_no", "kind", F.explode(kept).alias("k")).select("row_no", "kind", "k.start", "k.end", "k.doubt")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint").alias(f"n_{KINDS[number]}")

    counts = [count(number) for number in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
