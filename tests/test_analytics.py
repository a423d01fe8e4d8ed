"""The seven queries against plain Python over one hand-sized catalogue."""

import math
import statistics
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest

from shelfwatch.plans import analytics, measures

SCHEMA = (
    "product_id bigint, name string, brand string, category string, region string, bottle_size_l decimal(10,3),"
    " is_standard_bottle boolean, is_comparable_bottle boolean, is_cask_strength boolean, age_years decimal(5,0),"
    " is_age_stated boolean, age_band string, price_tier string, discount_band string, price_inc_vat_gbp decimal(10,2),"
    " alcohol_units decimal(10,2), price_per_alcohol_unit_gbp decimal(10,4), discount_amount_gbp decimal(10,2),"
    " is_discounted boolean, discount_percent decimal(6,2), rating_stars decimal(4,2), review_count decimal(10,0)"
)
BANDS = [(10, "≤10"), (15, "11–15"), (18, "16–18"), (25, "19–25"), (99, "25+")]


def dec(value, places="0.01"):
    return None if value is None else Decimal(str(value)).quantize(Decimal(places), ROUND_HALF_UP)


def catalogue():
    rng = np.random.default_rng(11)
    out = []
    for i in range(240):
        age = int(rng.integers(0, 40)) if i % 3 else None
        price = None if i % 37 == 0 else float(rng.lognormal(4, 0.7))
        size = [0.7, 0.35, 1.0, 0.05][i % 4]
        off = float(rng.uniform(0, 60)) if i % 2 else None
        out.append(
            {
                "product_id": i,
                "name": f"P{i}",
                "brand": None if i % 41 == 0 else "BrandHot" if i % 3 == 0 else f"Brand{i % 17}",
                "category": "Single Malt" if i % 5 else "Blended",
                "region": None if i % 7 == 0 else ["Islay", "Highland", "Speyside", "Lowland"][i % 4 if i % 60 else 3],
                "bottle_size_l": dec(size, "0.001"),
                "is_standard_bottle": size >= 0.7,
                "is_comparable_bottle": size >= 0.35,
                "is_cask_strength": i % 6 == 0,
                "age_years": None if age is None else Decimal(age),
                "is_age_stated": age is not None,
                "age_band": None if not age else next(b for top, b in BANDS if age <= top),
                "price_tier": None if price is None else "Budget" if price < 40 else "Premium" if price < 120 else "Luxury",
                "discount_band": "No Discount" if off is None else "Low (≤10%)" if off <= 10 else "Deep",
                "price_inc_vat_gbp": dec(price),
                "alcohol_units": dec(28),
                "price_per_alcohol_unit_gbp": dec(0 if i == 24 else None if i % 29 == 0 else float(rng.uniform(0.2, 5)), "0.0001"),
                "discount_amount_gbp": dec(off),
                "is_discounted": off is not None,
                "discount_percent": dec(off if off is not None else 0),
                "rating_stars": None if i % 19 == 0 else dec(round(float(rng.uniform(3, 5)) * 4) / 4),
                "review_count": None if i % 23 == 0 else Decimal(int(rng.integers(0, 300))),
            }
        )
    return out


ITEMS = catalogue()


@pytest.fixture(scope="module")
def latest(spark):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(i[n] for n in names) for i in ITEMS], SCHEMA).repartition(6)


def rnd(value, digits):
    """Ties away from zero after six decimals."""
    if value is None:
        return None
    six = Decimal(repr(float(value)) if isinstance(value, float) else str(value)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    return float(six.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        for a, b in zip(g, w, strict=True):
            assert a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, abs_tol=1e-9)), (g, w)


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def positioning(items, key):
    groups = defaultdict(list)
    for i in items:
        groups[i[key]].append(i)
    for name, g in groups.items():
        if len(g) < 5:
            continue
        prices = [float(i["price_inc_vat_gbp"]) for i in g]
        reviews = sum(i["review_count"] for i in g)
        weighted = sum(i["rating_stars"] * i["review_count"] for i in g) / reviews if reviews else None
        yield g, [
            name, len(g), rnd(statistics.median(prices), 2), rnd(mean([i["price_inc_vat_gbp"] for i in g]), 2),
            min(prices), max(prices), rnd(float(np.quantile(prices, 0.9) - np.quantile(prices, 0.1)), 2),
            rnd(mean([i["rating_stars"] for i in g]), 2), rnd(weighted, 2),
        ]


def complete(*names):
    return [i for i in ITEMS if all(i[n] is not None for n in names)]


def test_brand_positioning(latest):
    want = []
    for g, figures in positioning(complete("price_inc_vat_gbp", "rating_stars", "review_count", "brand"), "brand"):
        want.append((*figures, rnd(Decimal(sum(i["is_discounted"] for i in g)) / len(g) * 100, 1)))
    want.sort(key=lambda r: (-r[2], r[0]))
    same([tuple(r) for r in analytics.brand_positioning(latest).collect()], want)


def test_region_positioning(latest):
    items = [
        i for i in complete("price_inc_vat_gbp", "rating_stars", "review_count", "region")
        if i["category"] == "Single Malt" and i["is_comparable_bottle"]
    ]
    want = []
    for g, figures in positioning(items, "region"):
        want.append((*figures, int(sum(i["review_count"] for i in g)), rnd(Decimal(sum(i["is_discounted"] for i in g)) / len(g) * 100, 2)))
    want.sort(key=lambda r: (-r[3], r[0]))
    assert want
    same([tuple(r) for r in analytics.region_positioning(latest).collect()], want)


def test_best_value_ranks_a_missing_score_last(latest):
    items = [
        i for i in complete("price_per_alcohol_unit_gbp", "rating_stars", "review_count")
        if i["is_standard_bottle"] and i["rating_stars"] >= 4 and i["review_count"] >= 50
    ]
    scored = [(i["product_id"], rnd(i["rating_stars"] / i["price_per_alcohol_unit_gbp"], 2) if i["price_per_alcohol_unit_gbp"] else None) for i in items]
    scored.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = [(r.product_id, r.value_score) for r in analytics.best_value(latest).collect()]
    assert got == scored[:20]
    everything = analytics.best_value(latest, top=1000).collect()
    assert [(r.product_id, r.value_score) for r in everything] == scored


def test_discount_strategy(latest):
    groups = defaultdict(list)
    for i in ITEMS:
        if i["is_discounted"] and i["discount_percent"] is not None:
            groups[i["discount_band"]].append(i)
    want = [
        (b, len(g), rnd(mean([i["discount_percent"] for i in g]), 2), rnd(mean([i["discount_amount_gbp"] for i in g]), 2),
         float(min(i["discount_percent"] for i in g)), float(max(i["discount_percent"] for i in g)))
        for b, g in groups.items()
    ]
    want.sort(key=lambda r: -r[2])
    same([tuple(r) for r in analytics.discount_strategy(latest).collect()], want)


def test_top_ratings(latest):
    items = complete("rating_stars", "review_count")
    found = []
    for label, key in (("Brand", "brand"), ("Region", "region")):
        groups = defaultdict(list)
        for i in items:
            if i[key] is not None:
                groups[i[key]].append(i)
        for name, g in groups.items():
            reviews = sum(i["review_count"] for i in g)
            if reviews >= 200:
                found.append((label, name, len(g), int(reviews), rnd(sum(i["rating_stars"] * i["review_count"] for i in g) / reviews, 2)))
    found += [("Product", str(i["product_id"]), 1, int(i["review_count"]), float(i["rating_stars"])) for i in items if i["review_count"] >= 50]
    want = []
    for label in ("Brand", "Product", "Region"):
        want += sorted([f for f in found if f[0] == label], key=lambda r: (-r[4], -r[3], r[1]))[:3]
    same([tuple(r) for r in analytics.top_ratings(latest).collect()], want)
    relabelled = analytics.top_ratings(latest, product_label="Bottle").select("entity_type").distinct().collect()
    assert {r.entity_type for r in relabelled} == {"Brand", "Region", "Bottle"}


def test_price_premium(latest):
    items = [i for i in complete("price_inc_vat_gbp") if i["is_comparable_bottle"]]
    base = dec(statistics.median(float(i["price_inc_vat_gbp"]) for i in items), "0.000001")

    def age_tier(i):
        for low, high in [(1, 9), (10, 12), (13, 15), (16, 18), (19, 21), (22, 25), (26, 30)]:
            if low <= i["age_years"] <= high:
                return f"{low:02d}-{high:02d}"
        return "31+"

    def quality(i):
        r = i["rating_stars"]
        return "Exceptional (4.5+)" if r >= 4.5 else "Excellent (4.0-4.5)" if r >= 4 else "Good (3.5-4.0)" if r >= 3.5 else "Average (<3.5)"

    blocks = [
        ("Age Tier Premium", age_tier, [i for i in items if i["is_age_stated"] and i["age_years"] > 0], 5),
        ("Cask Strength", lambda i: "Cask Strength" if i["is_cask_strength"] else "Standard ABV", items, 0),
        ("Region Premium", lambda i: i["region"], [i for i in items if i["region"]], 10),
        ("Quality Tier", quality, [i for i in items if i["rating_stars"] is not None], 0),
    ]
    want = [("Overall Baseline", "All comparable bottles (median baseline)", len(items), rnd(base, 2), None, None)]
    for factor, label, members, least in blocks:
        groups = defaultdict(list)
        for i in members:
            groups[label(i)].append(i["price_inc_vat_gbp"])
        for name, prices in groups.items():
            if len(prices) >= least:
                average = dec(sum(prices) / len(prices), "0.000001")
                want.append((factor, name, len(prices), rnd(average, 2), rnd(average - base, 2), rnd(float(average - base) / float(base) * 100, 1)))
    want.sort(key=lambda r: (r[0], -(r[4] if r[4] is not None else -1e9), r[1]))
    same([tuple(r) for r in analytics.price_premium(latest).collect()], want)


def test_price_premium_without_comparable_bottles(latest):
    rows = analytics.price_premium(latest.where("NOT is_comparable_bottle")).collect()
    assert [tuple(r) for r in rows] == [("Overall Baseline", "All comparable bottles (median baseline)", 0, None, None, None)]


def test_age_roi(latest):
    items = [i for i in complete("age_years", "price_inc_vat_gbp") if i["is_comparable_bottle"]]
    groups = defaultdict(list)
    for i in items:
        groups[i["age_band"]].append(i)
    bands = []
    for band, g in groups.items():
        prices = [i["price_inc_vat_gbp"] for i in g]
        bands.append(
            [band, rnd(mean([i["age_years"] for i in g]), 1), len(g), rnd(mean(prices), 2), rnd(statistics.median(float(p) for p in prices), 2),
             rnd(mean([i["price_inc_vat_gbp"] / i["age_years"] if i["age_years"] else None for i in g]), 2),
             rnd(mean([i["rating_stars"] for i in g]), 2), rnd(mean([i["price_per_alcohol_unit_gbp"] for i in g]), 2)]
        )
    bands.sort(key=lambda r: r[1])
    want = []
    for n, b in enumerate(bands):
        step = rnd(b[3] - bands[n - 1][3], 2) if n else None
        cost = rnd((b[3] - bands[n - 1][3]) / (b[1] - bands[n - 1][1]), 2) if n else None
        value = b[5]
        label = "Premium/Diminishing Returns"
        for limit, name in [(15, "Fair Value"), (10, "Good Value"), (5, "Excellent Value")]:
            if value is not None and value <= limit:
                label = name
        want.append((*b, step, cost, label))
    same([tuple(r) for r in analytics.age_roi(latest).collect()], want)


def test_histogram_and_engagement_agree(latest):
    bins = {r.price_from: r.sku_count for r in measures.price_histogram(latest).collect()}
    engagement = {r.price_from: (r.sku_count, r.total_reviews) for r in measures.price_band_engagement(latest).collect()}
    assert {k: v[0] for k, v in engagement.items()} == bins
    assert sum(bins.values()) == len(complete("price_inc_vat_gbp"))


def test_slicer_total_covers_every_row(latest):
    got = {r.category: r.sku_count for r in measures.category_slicer(latest).collect()}
    assert got["All"] == len(ITEMS) == sum(v for k, v in got.items() if k != "All")


def test_measures_of_one_category(latest):
    whole = {r.category: r.sku_count for r in measures.category_slicer(latest).collect()}
    sliced = measures.price_skew(measures.slice_to(latest, "Blended")).first().sku_count
    assert sliced == len([i for i in complete("price_inc_vat_gbp") if i["category"] == "Blended"]) <= whole["Blended"]
    assert measures.slice_to(latest) is latest


def test_brand_tier_mix_covers_priced_rows(latest):
    rows = measures.brand_tier_mix(latest).collect()
    assert sum(r.budget + r.premium + r.luxury for r in rows) == len(complete("brand", "price_tier"))
