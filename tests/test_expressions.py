import pytest
from conftest import column
from pyspark.sql import functions as F

from shelfwatch import schema as S
from shelfwatch.functions import dates, numeric, text


def apply(rows, expression, values, kind="string"):
    df = rows(f"i int, c {kind}", *enumerate(values))
    return column(df.withColumn("out", expression(F.col("c"))), "out", "i")


@pytest.mark.parametrize(
    "bands, right, cases",
    [
        (S.PRICE_TIER, False, {-0.01: None, 0.0: "Budget", 39.99: "Budget", 40.0: "Premium", 119.99: "Premium", 120.0: "Luxury"}),
        (S.DISCOUNT_BAND, True, {-0.01: None, 0.0: "No Discount", 0.01: "Low (≤10%)", 10.0: "Low (≤10%)", 10.01: "Medium (10–20%)",
                                 20.0: "Medium (10–20%)", 40.0: "High (20–40%)", 40.01: "Very High (>40%)"}),
        (S.AGE_BAND, True, {0.0: None, 1.0: "≤10", 10.0: "≤10", 11.0: "11–15", 15.0: "11–15", 16.0: "16–18", 18.0: "16–18",
                            19.0: "19–25", 25.0: "19–25", 26.0: "25+"}),
        (S.BOTTLE_BAND, True, {0.0: None, 0.35: "Mini/Small (≤35cl)", 0.36: "Half–Standard (35–70cl)", 0.7: "Half–Standard (35–70cl)",
                               0.71: "Standard–Large (70cl–1L)", 1.0: "Standard–Large (70cl–1L)", 1.01: "Extra Large (>1L)"}),
        (S.ABV_BAND, True, {0.0: None, 40.0: "≤40%", 40.1: "40–43%", 43.0: "40–43%", 46.0: "43–46%", 50.0: "46–50%", 50.1: "50%+"}),
    ],
)
def test_band_edges(rows, bands, right, cases):
    got = apply(rows, lambda c: numeric.band(c, *bands, right=right), [*cases, None], "double")
    assert got == [*cases.values(), None]


def test_band_needs_matching_labels():
    with pytest.raises(ValueError):
        numeric.band(None, [0, 1], ["a", "b"])


def test_bands_partition_the_line(rows):
    values = [i / 8 for i in range(1, 800)]
    got = apply(rows, lambda c: numeric.band(c, *S.ABV_BAND), values, "double")
    assert None not in got
    assert [S.ABV_BAND[1].index(g) for g in got] == sorted(S.ABV_BAND[1].index(g) for g in got)


def test_to_double_is_strict(rows):
    texts = ["12.5", " 7 ", "1e3", ".5", "5.", "-2", "5d", "5f", "inf", "nan", "1e999", "", "1,000", None]
    got = apply(rows, lambda c: numeric.finite(numeric.to_double(c)), texts)
    assert got == [12.5, 7.0, 1000.0, 0.5, 5.0, -2.0] + [None] * 8


def test_whole_numbers(rows):
    df = rows("i int, c string", *enumerate(["12", "12.0", " 7", "12.5", "x", "99999999999999999999", None]))
    df = df.withColumn("e", numeric.to_exact(F.col("c"))).withColumn("out", numeric.whole(F.col("e")))
    assert column(df, "out", "i") == [12, 12, 7, None, None, None, None]


def test_decimal_casts_round_and_overflow(rows):
    assert [str(v) if v is not None else None for v in apply(rows, lambda c: numeric.to_decimal(c, 5, 0), ["12.5", "123456", "a"])] == ["13", None, None]
    assert apply(rows, numeric.to_key, ["12", "12.0", "abc", None]) == [12, 12, None, None]


def test_round_half_even_against_report_rounding(rows):
    assert apply(rows, lambda c: numeric.round_half_even(c, 0), [0.5, 1.5, 2.5], "double") == [0.0, 2.0, 2.0]
    assert apply(rows, lambda c: numeric.round_report(c, 0), [0.5, 1.5, 2.5, -2.5], "double") == [1.0, 2.0, 3.0, -3.0]


def test_strip_knows_unicode_blanks(rows):
    assert apply(rows, text.strip, ["\t a b \n", "　x", "", None]) == ["a b", "x", "", None]


def test_capitalize_lowers_the_rest(rows):
    assert apply(rows, text.capitalize, ["the HIGHLANDS", "x", "", None]) == ["The highlands", "X", "", None]


def test_tidy_list_and_slug(rows):
    assert apply(rows, text.tidy_list, ["a | b|c ", "| a |", " | ", None]) == ["a|b|c ", "a", "", None]
    assert apply(rows, text.slug, ["Cask  Type", " (Region) ", "Ünit"]) == ["cask_type", "region", "nit"]


def test_text_flags(rows):
    assert apply(rows, text.text_flag, ["TRUE", "y", "0", "No", "maybe", "", None]) == [True, True, False, False, None, None, None]


def test_times_and_calendar(rows):
    got = apply(rows, dates.to_time, ["2026-01-16 09:30:00", "2026-01-16", "soon", None])
    assert [str(v) if v else None for v in got] == ["2026-01-16 09:30:00", "2026-01-16 00:00:00", None, None]
    day = rows("d date").sparkSession.sql("SELECT DATE'2026-01-16' AS d")
    (row,) = day.select(*dates.calendar_parts(F.col("d"))).collect()
    assert (row.date_key, row.year, row.month, row.day, row.week, row.day_name) == (20260116, 2026, 1, 16, 3, "Fri")
