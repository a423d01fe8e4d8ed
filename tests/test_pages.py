import time

import pytest

from shelfwatch.plans import collect
from shelfwatch.schema import DETAIL_COLUMNS, RAW_COLUMNS
from shelfwatch.operators import listing
from shelfwatch.sources import pages
from shelfwatch.sources.outline import outline

LD = '<script type="application/ld+json">{}</script>'


@pytest.fixture
def details(rows):
    def read(*htmls):
        df = rows("url string, html string", *[(f"u{i:02d}", h) for i, h in enumerate(htmls)])
        return [r.asDict() for r in pages.detail_rows(df).orderBy("product_url").collect()]

    return read


@pytest.fixture
def listed(rows):
    def read(html, url="https://shop.example/c/1?pg=1"):
        df = rows("url string, html string, category string, fetched_at string", (url, html, "Single Malt", "2026-01-16 09:00:00"))
        return [r.asDict() for r in pages.listing_rows(df).orderBy("position").collect()]

    return read


def test_prices_and_ratings_in_json_ld(details):
    got = details(
        LD.format('{"offers": {"price": "45.00"}, "aggregateRating": {"ratingValue": 4.5, "reviewCount": "12"}}'),
        LD.format('[{"a": 1}, "text", {"offers": [{"price": null}, {"x": 1}, {"price": 30.5}, {"price": 31}]}]'),
        LD.format('{"offers": {"price": "1"') + LD.format('{"offers": {"price": " 7 "}}'),
        LD.format('{"offers": {"currency": "GBP"}}') + LD.format('{"offers": {"price": 8}}'),
        LD.format('{"offers": "none", "aggregateRating": [1]}'),
        "<SCRIPT TYPE='application/ld+json'>\n {\"offers\": {\"price\": 9}} \n</SCRIPT>",
        "<p>nothing</p>",
        None,
        "",
        LD.format('{"offers": {"price": 5}} trailing'),
        LD.format('{"aggregateRating": {"ratingValue": "3"}}') + LD.format('{"aggregateRating": {"ratingValue": "5", "reviewCount": 9}}'),
    )
    assert [g["price_inc_vat_gbp"] for g in got] == ["45.00", "30.5", "7", "8", "", "9", "", "", "", "", ""]
    assert [(g["rating_stars"], g["review_count"]) for g in got] == [("4.5", "12")] + [("", "")] * 9 + [("3", "")]
    assert list(got[0]) == ["product_url", *DETAIL_COLUMNS]


def test_was_price(details):
    got = details(
        '<span class="x product-offer__price">Was <b>£ 55.50</b> now</span>',
        '<span class="product-offer__price">£40</span><span class="product-offer__price">was £60</span>',
        '<span class="product-offer__price-x">was £60</span>',
    )
    assert [g["price_before_discount_gbp"] for g in got] == ["55.50", "", ""]


PROFILE = (
    '<{tag}><ul class="flavour-profile__list">'
    '<li class="flavour-profile__item"><span class="flavour-profile__label">Body</span><span class="flavour-profile__content"> 6 </span></li>'
    '<li class="flavour-profile__item"><span class="flavour-profile__label">Smoke</span><i class="flavour-profile__gauge" data-text=" 2 "></i></li>'
    '<li class="flavour-profile__item"><span class="flavour-profile__label">Richness</span></li>'
    '<li class="flavour-profile__item"><span class="other">Sweetness</span><span class="flavour-profile__content">9</span></li></ul></{end}>'
)


def test_style_and_notes(details):
    got = details(
        PROFILE.format(tag='details id="Style"', end="details") + PROFILE.format(tag='details id="Character"', end="details"),
        PROFILE.format(tag='div class="Flavour-Profile flavour-profile--style"', end="div"),
        PROFILE.format(tag="div", end="div"),
    )
    assert [(g["style_body"], g["style_smoke"], g["style_richness"], g["style_sweetness"]) for g in got] == [("6", "2", "", "")] * 2 + [("", "", "", "")]
    assert [g["character_notes"] for g in got] == ["Body|Smoke|Richness", "", ""]


def test_facts(details):
    got = details(
        '<details id="ProductFacts"><ul class="product-facts"><li><h3> Cask   Type </h3><p>Bourbon <b>&amp;</b> Sherry</p></li>'
        '<li><h3>Region</h3><p>Islay</p></li><li><h3>Region</h3><p>Jura</p></li><li><h3>Country</h3><p> </p></li></ul></details>',
        '<section class="Product-Facts"><ul><li><i class="fact-label">Bottler</i><i class="fact-value">X</i></li><li><h3>Colouring</h3></li></ul></section>',
    )
    assert (got[0]["fact_cask_type"], got[0]["fact_region"], got[0]["fact_country"]) == ("Bourbon & Sherry", "Jura", "")
    assert (got[1]["fact_bottler"], got[1]["fact_colouring"]) == ("X", "")


CARD = '<li class="product-grid__item"><a href="/p/{id}/x"><img src="/i/{id}.jpg"></a>{extra}</li>'


def test_script_items_meet_their_cards(listed):
    html = (
        '<script>var items = [broken];</script><script>var a = 1; var items = [{"item_id": 11, "item_name": "Glen", "item_brand": "G",'
        ' "item_variant": "70cl / 40%", "price": 45.5, "item_category3": "Islay", "item_category5": "New"}, {"item_id": "12", "item_category3": ""},'
        ' {"_url": "/p/13/z"}, {"item_name": "no id"}]; go();</script>'
        + CARD.format(id=11, extra='<p class="unit-price">£65 per litre</p><b class="badge">Last one</b>')
        + CARD.format(id=13, extra="")
    )
    a, b, c, d = listed(html)
    assert (a["product_id"], a["name"], a["brand"], a["variant"], a["price_ex_vat_gbp"], a["region"], a["promo_label"]) == ("11", "Glen", "G", "70cl / 40%", "45.5", "Islay", "New")
    assert (a["unit_price_raw"], a["status"], a["product_url"], a["image_url"]) == ("£65 per litre", "Last one", "https://shop.example/p/11/x", "/i/11.jpg")
    assert (b["product_id"], b["region"], b["status"], b["product_url"], b["image_url"]) == ("12", "N/A", "Current", "https://shop.example/p/12", "")
    assert (c["product_id"], c["status"], c["product_url"]) == ("13", "In Stock", "https://shop.example/p/13/x")
    assert (d["product_id"], d["name"], d["product_url"]) == ("", "no id", "")
    assert {r["category"] for r in (a, b, c, d)} == {"Single Malt"}


def test_item_list_when_there_are_no_script_items(listed):
    html = (
        "<script>var items = [];</script>"
        + LD.format('{"@type": "Thing"}')
        + LD.format('{"@type": "ItemList", "itemListElement": [{"item": {"sku": "5", "name": "A", "brand": {"name": "B"}, "offers": {"price": "9"}, "url": "https://x.example/p/5/"}}, {"item": {}}, {"position": 2}]}')
        + LD.format('{"@type": "ItemList", "itemListElement": [{"item": {"name": "C", "brand": "text", "url": "/p/6/c"}}]}')
    )
    a, c = listed(html)
    assert (a["product_id"], a["name"], a["brand"], a["price_ex_vat_gbp"], a["product_url"], a["region"]) == ("5", "A", "B", "9", "https://x.example/p/5/", "N/A")
    assert (c["product_id"], c["brand"], c["price_ex_vat_gbp"], c["product_url"]) == ("6", "", "", "https://shop.example/p/6/c")


def test_odd_lists_lose_only_their_own_items(listed):
    html = (
        LD.format('{"@type": "ItemList"}')
        + LD.format('{"@type": "ItemList", "itemListElement": {"item": {"sku": "1"}}}')
        + LD.format('{"@type": "ItemList", "itemListElement": [{"item": {"sku": 7, "offers": [{"price": 3}]}}, "text", {"item": "x"}]}')
    )
    (row,) = listed(html)
    assert (row["product_id"], row["price_ex_vat_gbp"]) == ("7", "")
    (row,) = listed('<script>var items = [1, {"item_id": 8}, "x", null];</script>')
    assert row["product_id"] == "8"


def test_cards_alone_are_the_last_resort(listed):
    html = (
        '<ul><li class=product-card><a href="/p/1/a"><h3>One &amp; Only</h3></a><p class="price">now £ 12.50</p></li>'
        '<li class="product-card"><a class="product-link" href="/x">no id</a></li>'
        '<li class="product-card"><a href="https://y.example/p/2/"><p class="product-name">Two</p></a><img data-src="d.jpg" src="s.jpg"></li></ul>'
    )
    one, two = listed(html)
    assert (one["product_id"], one["name"], one["price_ex_vat_gbp"], one["category"], one["region"], one["status"]) == ("1", "One & Only", "12.50", "", "N/A", "In Stock")
    assert (two["product_url"], two["image_url"], two["name"], two["price_ex_vat_gbp"]) == ("https://y.example/p/2/", "d.jpg", "Two", "")
    assert listed("<p>product</p>") == [] and listed(None) == []


def test_outline_of_sloppy_markup():
    page = (
        '<!-- <li>no</li> --><ul><li CLASS=a href=x href=y>one<ul><li class="b a">two &amp; &eacute;</li></ul>tail</li>'
        "<li class='c'><p>three<br>four<script>var t='</li>';</script></li></ul></b><b id=x/><p>five"
    )
    got = outline(page)
    assert [(r["tag"], r["text"]) for r in got if r["classes"] or r["tag"] == "p"] == [
        ("li", "onetwo & étail"), ("li", "two & é"), ("li", "threefour"), ("p", "threefour"), ("p", "five"),
    ]
    by_tag = {r["tag"]: r for r in got}
    inner, outer = got[2], got[0]
    assert outer["first"] < inner["first"] < inner["last"] < outer["last"] < by_tag["b"]["first"]
    assert got[1]["href"] == "x" and got[1]["spaced"] == "one two & é tail" and by_tag["b"]["id"] == "x/"
    assert outline(None) == outline("") == []


def test_json_with_repeated_keys_and_bare_script_types(details, listed):
    got = details(
        LD.format('{"name": "a", "name": "b", "offers": {"price": 3, "price": 4}}'),
        '<script type=application/ld+json>{"offers": {"price": 6}, "aggregateRating": {"ratingValue": 1, "ratingValue": 2}}</script>',
    )
    assert [(g["price_inc_vat_gbp"], g["rating_stars"]) for g in got] == [("4", ""), ("6", "2")]
    (row,) = listed('<script>var items = [{"item_id": 1, "item_id": 2, "item_name": "n"}];</script>')
    assert (row["product_id"], row["name"]) == ("2", "n")


def test_listing_cap(rows):
    df = rows("category string, product_id string, page int, position int",
              ("a", "1", 1, 0), ("a", "2", 1, 1), ("a", "1", 2, 0), ("a", "3", 2, 1), ("a", "", 1, 2), ("a", None, 1, 3), ("b", "1", 1, 0))
    out = listing.listing_cap(df, cap=2)
    assert sorted((r.category, r.product_id, r.page) for r in out.collect()) == [("a", "1", 1), ("a", "2", 1), ("b", "1", 1)]


def test_every_row_stays_without_a_cap_and_long_rankings_are_exact(rows):
    df = rows("category string, product_id string, page int, position int", *[("a", str(i), i % 7, i) for i in range(3000)])
    assert listing.listing_cap(df).count() == 3000
    got = [(r.page, r.position) for r in listing.listing_cap(df, cap=1500).collect()]
    assert sorted(got) == sorted((i % 7, i) for i in range(3000))[:1500]


def test_cards_of_one_product_in_two_categories_stay_apart(rows):
    page = "".join(CARD.format(id=i, extra="") for i in (1, 2)), "".join(CARD.format(id=i, extra="") for i in (1, 3))
    df = rows("url string, html string, category string, fetched_at string, page int",
              ("https://s.example/a", page[0], "Single Malt", "t", 1), ("https://s.example/b", page[1], "Blended", "t", 1))
    got = sorted((r.page_category, r.category, r.product_id) for r in collect.listing_records(df).collect())
    assert got == [("Blended", "", "1"), ("Blended", "", "3"), ("Single Malt", "", "1"), ("Single Malt", "", "2")]


def test_no_html_is_shuffled(spark, rows):
    listings = rows("url string, html string, category string, fetched_at string, page int", ("https://s.example/a", CARD.format(id=1, extra=""), "x", "t", 1))
    details = rows("url string, html string", ("https://s.example/p/1/x", "<p>x</p>"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = collect.raw_records(listings, details)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [line for line in plan.split("\n") if "Exchange" in line and "html" in line]


def test_enrichment(rows):
    listing_rows = rows("product_id string, product_url string, rating_stars string", ("1", "u1", "old"), ("2", "u2", "old"), ("3", "", "old"))
    details = rows("product_url string, rating_stars string", ("u1", "4.5"))
    assert sorted(r.product_url for r in listing.detail_urls(listing_rows).collect()) == ["u1", "u2"]
    out = listing.enrich(listing_rows, details, fields=["rating_stars"])
    assert sorted((r.product_id, r.rating_stars) for r in out.collect()) == [("1", "4.5"), ("2", ""), ("3", "")]
    assert [tuple(r) for r in listing.rows_per_group(rows("category string", ("a",), ("a",))).collect()] == [("a", 2)]


def test_raw_records_from_pages(spark, rows):
    script = '<script>var items = [{}];</script>'
    item = '{{"item_id": "{0}", "item_name": "P{0}", "price": "{1}"}}'
    listings = rows(
        "url string, html string, category string, fetched_at string, page int",
        ("https://s.example/c?pg=1", script.format(item.format(1, 10) + "," + item.format(2, 20)), "Single Malt", "t1", 1),
        ("https://s.example/c?pg=2", script.format(item.format(2, 99) + "," + item.format(3, 30) + "," + item.format(4, 40)), "Single Malt", "t2", 2),
        ("https://s.example/d?pg=1", script.format(item.format(1, 11)), "Blended", "t3", 1),
    )
    details = rows(
        "url string, html string",
        ("https://s.example/p/1", LD.format('{"offers": {"price": 12}}')),
        ("https://s.example/p/1", LD.format('{"offers": {"price": 12}}')),
        ("https://s.example/p/9", LD.format('{"offers": {"price": 99}}')),
    )
    out = collect.raw_records(listings, details, cap=3)
    assert out.columns == RAW_COLUMNS
    got = sorted((r.category, r.product_id, r.price_ex_vat_gbp, r.price_inc_vat_gbp, r.scraped_at) for r in out.collect())
    assert got == [
        ("Blended", "1", "11", "12", "t3"), ("Single Malt", "1", "10", "12", "t1"),
        ("Single Malt", "2", "20", "", "t1"), ("Single Malt", "3", "30", "", "t2"),
    ]


def test_rows_inside_an_element_are_the_slice_behind_it():
    page = "<ul class=a><li><b>x</b><img><p>y<li>z</ul></li></b><div><div/><span>t</div>u</div><i>"
    got = outline(page)
    for r in got:
        inside = [e["at"] for e in got if r["first"] < e["first"] and e["last"] <= r["last"]]
        assert inside == list(range(r["at"] + 1, r["at"] + 1 + r["size"]))


def test_cards_of_one_id_anywhere_on_the_page(listed):
    def card(number, name, image):
        return f'<li class="product-grid__item"><a href="/p/{number}/"><img src="{image}"><p class="name">{name}</p></a></li>'

    got = listed("<ul>" + card(20, "A", "1") + card(3, "B", "2") + card(20, "C", "3") + '<li class="product-grid__item">no link</li>' + card(3, "D", "4") + card(20, "E", "5") + "</ul>")
    assert [(g["product_id"], g["name"], g["image_url"]) for g in got] == [("20", "A", "5"), ("3", "B", "4")]


def test_a_page_with_many_cards_takes_time_in_proportion(rows):
    def seconds(cards):
        page = "<ul>" + "".join(
            f'<li class="product-grid__item"><a href="/p/{i}/x"><img src="{i}.jpg"><p class="product-card__name">N {i}</p>'
            f'<p class="product-card__price">£{i}</p></a></li>' for i in range(cards)
        ) + "</ul>"
        df = rows("url string, html string, category string, fetched_at string", ("https://x.example/c", page, "c", "t"))
        start = time.perf_counter()
        got = pages.listing_rows(df).select("product_id", "name", "price_ex_vat_gbp").collect()
        assert [tuple(g) for g in got[:2]] == [("0", "N 0", "0"), ("1", "N 1", "1")] and len(got) == cards
        return time.perf_counter() - start

    seconds(100)
    small, large = seconds(1000), seconds(10_000)
    assert large < 10 * small + 5


def test_rows_of_a_batch_leave_in_runs():
    import pandas as pd

    from shelfwatch.sources import outline as module

    page = "<p>" + "x" * (module.OUTLINED_AT_ONCE // 4) + "</p>"
    batch = pd.Series([page] * 9 + [None, "<p>last</p>"])
    made = list(module._outlines(iter([batch, batch[:0]])))
    assert [len(part) for part in made] == [4, 4, 3]
    assert [rows for part in made for rows in part] == [module.outline(p, module.LABEL_CLASSES) for p in batch]
