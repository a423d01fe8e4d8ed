"""Crawled pages to listing rows and product details.

Embedded JSON is read with built-in expressions, and so are cards and panels, out of the
flat rows of elements that one pass over a page's tokens gives. A page's cards and JSON
items meet in a map inside its row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.text import extract, slug, strip
from shelfwatch.schema import DETAIL_COLUMNS
from shelfwatch.sources.outline import elements

# The scripts and texts that carry product data.
LD_SCRIPT = r"(?is)<script[^>]*type\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script>"
ANY_SCRIPT = r"(?is)<script[^>]*>(.*?)</script>"
ITEMS_ARRAY = r"(?s)var items\s*=\s*(\[.*?\]);"
WAS_PRICE = r"(?i)Was\s*£\s*(\d+(?:\.\d+)?)"
PRODUCT_LINK = r"/p/(\d+)/"
CARD_PRICE = r"£\s*(\d+(?:\.\d+)?)"
CARD_MARKUP = r"(?i)product"
PANEL_MARKUP = r"(?i)product-offer__price|flavour-profile|product-facts|<details"

ITEM_TYPE = (
    "struct<item_id string, item_name string, item_brand string, item_variant string, price string,"
    " item_category3 string, item_category5 string, _url string>"
)


# -- embedded JSON -------------------------------------------------------------------------


def _field(json: Column, name: str) -> Column:
    """A member of a JSON object as text, nested JSON as it is written; of repeated keys the last."""
    return F.from_json(json, f"`{name}` string")[name]


def _valid_json(texts: Column) -> Column:
    """Texts that are one JSON value; keys may repeat. As a member of an object, text after the value is an error too."""

    def whole(s: Column) -> Column:
        read = F.from_json(
            F.concat(F.lit('{"x":'), s, F.lit("}")), "x string, _bad string", {"columnNameOfCorruptRecord": "_bad"}
        )
        return read["_bad"].isNull() & read["x"].isNotNull()

    return F.filter(texts, whole)


def _parts(json: Column) -> Column:
    """The elements of a JSON list as JSON texts; no elements for anything else.

    Never NULL: one NULL array would turn a whole flattened result NULL.
    """
    return F.coalesce(F.from_json(json, "array<string>"), F.array().cast("array<string>"))


def _elements(json: Column) -> Column:
    """A JSON list as an array of JSON texts, any other value as an array of itself."""
    return F.when(strip(json).startswith("["), _parts(json)).otherwise(F.array(strip(json)))


def _is_object(json: Column) -> Column:
    return json.startswith("{")


def ld_objects(html: Column) -> Column:
    """All JSON-LD objects of a page in document order, as JSON texts; broken scripts are skipped."""
    scripts = _valid_json(F.regexp_extract_all(html, F.lit(LD_SCRIPT), F.lit(1)))
    return F.filter(F.flatten(F.transform(scripts, _elements)), _is_object)


def ld_price(objects: Column) -> Column:
    """The first price found in any object's offers, one offer or a list of them."""

    def prices(obj: Column) -> Column:
        offers = F.filter(F.coalesce(_elements(_field(obj, "offers")), F.array().cast("array<string>")), _is_object)
        return F.transform(offers, lambda o: _field(o, "price"))

    found = F.flatten(F.transform(objects, prices))
    return strip(F.get(F.filter(found, lambda p: p.isNotNull()), 0))


def ld_rating(objects: Column) -> Column:
    """The first aggregate rating of any object, as a JSON text."""
    ratings = F.transform(objects, lambda o: _field(o, "aggregateRating"))
    return F.get(F.filter(ratings, lambda r: r.isNotNull() & _is_object(r)), 0)


def _script_items(html: Column) -> Column:
    """Items of the first readable ``var items = [...]``."""
    scripts = F.filter(F.regexp_extract_all(html, F.lit(ANY_SCRIPT), F.lit(1)), lambda s: s.contains("var items ="))
    lists = F.transform(scripts, lambda s: F.regexp_extract(s, ITEMS_ARRAY, 1))
    first = F.get(_valid_json(F.filter(lists, lambda s: s != "")), 0)
    items = F.transform(F.filter(_parts(first), _is_object), lambda item: F.from_json(item, ITEM_TYPE))
    return F.filter(items, lambda item: item.isNotNull())


def _ld_items(html: Column) -> Column:
    """Items of every JSON-LD ``ItemList``."""

    def item(entry: Column) -> Column:
        product = _field(entry, "item")

        def field(name: str, inner: str | None = None) -> Column:
            value = _field(product, name)
            if inner:
                value = F.when(_is_object(value), _field(value, inner))
            return F.coalesce(value, F.lit(""))

        return F.struct(
            field("sku").alias("item_id"),
            field("name").alias("item_name"),
            field("brand", "name").alias("item_brand"),
            F.lit("").alias("item_variant"),
            field("offers", "price").alias("price"),
            F.lit("").alias("item_category3"),
            F.lit("").alias("item_category5"),
            field("url").alias("_url"),
        )

    scripts = F.filter(_valid_json(F.regexp_extract_all(html, F.lit(LD_SCRIPT), F.lit(1))), lambda s: _is_object(strip(s)))
    lists = F.filter(scripts, lambda s: _field(s, "@type") == "ItemList")
    entries = F.flatten(F.transform(lists, lambda s: _parts(_field(s, "itemListElement"))))
    products = F.filter(
        F.filter(entries, _is_object), lambda e: F.coalesce(_field(e, "item").startswith("{\""), F.lit(False))
    )
    return F.transform(products, item)


def _or(first: Column, *rest: Column) -> Column:
    """The first non-empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (first, *rest)], F.lit(""))


# -- elements ------------------------------------------------------------------------------


def _is(element: Column, tag: str = "", like: str = "", named: str = "", id: str = "") -> Column:
    """Condition by tag, class pattern in any case, exact class name, and id."""
    tests = [
        *([element["tag"] == tag] if tag else []),
        *([element["classes"].rlike(f"(?i){like}")] if like else []),
        *([F.array_contains(F.split(element["classes"], r"\s+"), named)] if named else []),
        *([element["id"] == id] if id else []),
    ]
    out = tests[0]
    for test in tests[1:]:
        out &= test
    return out


def _inside(rows: Column, outer: Column) -> Column:
    """The elements inside another: the rows that follow it."""
    return F.slice(rows, outer["at"] + 2, outer["size"])


def _within(rows: Column, outer: Column, test: Callable[[Column], Column]) -> Column:
    """The elements inside another that pass a test, in document order."""
    return F.filter(_inside(rows, outer), test)


def _is_given(test: dict, element: Column) -> Column:
    return _is(element, **test)


def _first(found: Column) -> Column:
    return F.get(found, 0)


def _one(rows: str, *choices: dict) -> Column:
    """The first element by the first choice that has one; NULL without any."""
    return F.coalesce(*[_first(_all(rows, choice)) for choice in choices])


def _card(inside: Column) -> Column:
    """What one card shows, from the elements inside it; its id is empty without a product link."""

    def inner(field: str, **test: str) -> Column:
        return _first(F.filter(inside, lambda e: _is(e, **test)))[field]

    link = _first(F.filter(inside, lambda e: _is(e, tag="a") & e["href"].rlike(PRODUCT_LINK)))["href"]
    title = F.coalesce(
        inner("text", like="(product.*name|title)"), inner("text", tag="h2"), inner("text", tag="h3"),
        inner("text", tag="p", like="(name|title)"), F.lit(""),
    )
    return F.struct(
        F.regexp_extract(F.coalesce(link, F.lit("")), PRODUCT_LINK, 1).alias("id"),
        F.coalesce(link, F.lit("")).alias("url"),
        F.coalesce(inner("image", tag="img"), F.lit("")).alias("image"),
        F.coalesce(inner("text", like="(status|badge|stock)"), F.lit("In Stock")).alias("status"),
        F.coalesce(inner("text", like="unit.price"), F.lit("")).alias("unit_price"),
        title.alias("name"),
        F.regexp_extract(F.coalesce(inner("text", like="price(?!.*unit)"), F.lit("")), CARD_PRICE, 1).alias("price"),
    )


def _card_elements(rows: str) -> Column:
    """The elements that hold a card: those of the first kind present."""
    # The kinds.
    kinds = [{"tag": "li", "named": "product-grid__item"}, {"tag": "li", "like": "(product.*item|product-card)"}]
    choice = F.filter(rows, lambda e: _is(e, tag="div", like="(product-card|product-grid)"))
    for kind in reversed(kinds):
        found = _all(rows, kind)
        choice = F.when(F.size(found) > 0, found).otherwise(choice)
    return choice


def _all(rows: str, test: dict) -> Column:
    return F.filter(rows, lambda e: _is(e, **test))


def _by_id(cards: str) -> Column:
    """The cards with an id as ``id, place, card``, cards of one id side by side in page order."""
    placed = F.transform(cards, lambda c, i: F.struct(c["id"].alias("id"), i.alias("place"), c.alias("card")))
    return F.array_sort(F.filter(placed, lambda p: p["id"] != ""))


def _at_edge(sorted_cards: str, step: int) -> Column:
    """The first (step -1) or last (step 1) card of every id."""

    def edge(p: Column, i: Column) -> Column:
        beside = F.get(sorted_cards, i + step)  # beyond the ends there is none
        return beside.isNull() | (beside["id"] != p["id"])

    return F.filter(sorted_cards, edge)


def _merged(first: str, last: str) -> Column:
    """One card per id in order of first sight: the first one's name and price, the last one's other fields."""

    def merge(a: Column, b: Column) -> Column:
        return F.struct(
            a["place"].alias("place"),
            F.struct(
                *[b["card"][f].alias(f) for f in ("id", "url", "image", "status", "unit_price")],
                *[a["card"][f].alias(f) for f in ("name", "price")],
            ).alias("card"),
        )

    return F.transform(F.array_sort(F.zip_with(first, last, merge)), lambda m: m["card"])


def _style_entry(rows: Column, item: Column) -> Column:
    def inner(field: str, **test: str) -> Column:
        return _first(_within(rows, item, lambda e: _is(e, **test)))[field]

    shown = inner("text", tag="span", named="flavour-profile__content")
    gauge = strip(inner("gauge", like="flavour-profile__gauge"))
    return F.struct(
        inner("text", tag="span", named="flavour-profile__label").alias("label"), F.coalesce(shown, gauge, F.lit("")).alias("value")
    )


def _fact_entry(rows: Column, item: Column) -> Column:
    def inner(field: str, **test: str) -> Column:
        return _first(_within(rows, item, lambda e: _is(e, **test)))[field]

    return F.struct(
        F.coalesce(inner("text", tag="h3"), inner("text", like="(type|key|label)")).alias("label"),
        F.coalesce(inner("spaced", tag="p"), inner("spaced", like="(data|value)")).alias("value"),
    )


def _valued(entries: Column) -> Column:
    return F.filter(entries, lambda e: e["label"].isNotNull() & (F.coalesce(e["value"], F.lit("")) != ""))


# -- jobs ----------------------------------------------------------------------------------


def listing_rows(pages: DataFrame) -> DataFrame:
    """Product rows of listing pages ``(url, html, category, fetched_at)``.

    Items come from ``var items``, else from JSON-LD item lists; each takes its
    card's URL, image, status and unit price by product id. A page with cards
    but no items gives one row per card, with an empty ``category``. ``page_category``
    is the page's own, ``page_url`` and ``position`` give the order inside a page.
    """
    kept = [c for c in pages.columns if c not in ("url", "html", "category", "fetched_at")]
    read = pages.select(
        *kept,
        F.col("url").alias("page_url"),
        F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("site"),
        F.coalesce(F.col("category"), F.lit("")).alias("page_category"),
        F.col("fetched_at").alias("scraped_at"),
        _script_items(F.col("html")).alias("script_items"),
        _ld_items(F.col("html")).alias("ld_items"),
        elements(F.col("html"), CARD_MARKUP).alias("rows"),
    )
    # Staged one by one: nested, an array would be built once per use.
    read = read.withColumn("holders", _card_elements("rows"))
    read = read.withColumn("insides", F.transform("holders", lambda e: _inside(F.col("rows"), e)))
    read = read.withColumn("all_cards", F.transform("insides", _card))
    read = read.withColumn("sorted_cards", _by_id("all_cards"))
    read = read.withColumn("first_cards", _at_edge("sorted_cards", -1)).withColumn("last_cards", _at_edge("sorted_cards", 1))
    read = read.withColumn("cards", _merged("first_cards", "last_cards"))
    items = F.when(F.coalesce(F.size("script_items"), F.lit(0)) > 0, F.col("script_items")).otherwise(F.col("ld_items"))
    read = read.withColumn("items", items)
    read = read.withColumn(
        "by_id", F.map_from_entries(F.transform("cards", lambda c: F.struct(c["id"].alias("key"), c.alias("value"))))
    )

    def number(item: Column) -> Column:
        return strip(_or(item["item_id"], F.regexp_extract(F.coalesce(item["_url"], F.lit("")), PRODUCT_LINK, 1)))

    def from_item(item: Column) -> Column:
        card = F.try_element_at("by_id", number(item))
        return F.struct(F.lit(True).alias("from_item"), number(item).alias("product_id"), item.alias("item"), card.alias("card"))

    none = F.lit(None).cast(ITEM_TYPE)
    alone = F.transform(
        "cards", lambda c: F.struct(F.lit(False).alias("from_item"), c["id"].alias("product_id"), none.alias("item"), c.alias("card"))
    )
    entries = F.when(F.coalesce(F.size("items"), F.lit(0)) > 0, F.transform("items", from_item)).otherwise(alone)
    rows = read.select(*kept, "page_url", "site", "page_category", "scraped_at", F.posexplode(entries).alias("position", "entry"))
    rows = rows.select("*", "entry.*").drop("entry")
    link = _or(
        F.col("card.url"),
        F.col("item._url"),
        F.when(F.col("product_id") != "", F.concat(F.lit("/p/"), F.col("product_id"))),
    )
    rows = rows.withColumn("link", link)
    item = F.col("from_item")
    return rows.select(
        *kept,
        "page_url",
        "page_category",
        "position",
        "scraped_at",
        F.when(item, F.col("page_category")).otherwise("").alias("category"),
        "product_id",
        F.when(item, _or(F.col("item.item_name"))).otherwise(F.col("card.name")).alias("name"),
        _or(F.col("item.item_brand")).alias("brand"),
        _or(F.col("item.item_variant")).alias("variant"),
        F.when(item, _or(F.col("item.price"))).otherwise(F.col("card.price")).alias("price_ex_vat_gbp"),
        F.when(item, _or(F.col("card.unit_price"))).otherwise("").alias("unit_price_raw"),
        _or(F.col("item.item_category3"), F.lit("N/A")).alias("region"),
        _or(F.col("item.item_category5")).alias("promo_label"),
        F.coalesce("card.status", F.lit("Current")).alias("status"),
        F.when((F.col("link") == "") | F.col("link").startswith("http"), F.col("link"))
        .otherwise(F.concat("site", "link"))
        .alias("product_url"),
        _or(F.col("card.image")).alias("image_url"),
    )


def detail_rows(pages: DataFrame) -> DataFrame:
    """The detail fields of product pages ``(url, html)``, empty text where absent."""
    read = pages.select(
        F.col("url").alias("product_url"), ld_objects(F.col("html")).alias("objects"),
        elements(F.col("html"), PANEL_MARKUP).alias("rows"),
    )
    rows = F.col("rows")
    read = read.withColumns({
        "style_panel": _one("rows", {"tag": "details", "id": "Style"}, {"like": "flavour-profile.*style"}),
        "notes_panel": _one("rows", {"tag": "details", "id": "Character"}, {"like": "flavour-profile.*character"}),
        "facts_panel": _one("rows", {"tag": "details", "id": "ProductFacts"}, {"like": "product-facts"}),
    })

    def listed(panel: str, *tests: dict) -> Column:
        outer = F.col(panel)
        found = [_first(_within(rows, outer, partial(_is_given, test))) for test in tests]
        return F.coalesce(*found)

    profile = {"tag": "ul", "like": "flavour-profile__list"}
    read = read.withColumns({
        "style_list": listed("style_panel", profile),
        "notes_list": listed("notes_panel", profile),
        "facts_list": listed("facts_panel", {"tag": "ul", "named": "product-facts"}, {"tag": "ul"}),
    })

    def entries(outer: str, test: dict, make: Callable[[Column, Column], Column]) -> Column:
        return F.transform(_within(rows, F.col(outer), partial(_is_given, test)), lambda item: make(rows, item))

    read = read.select(
        "product_url", "objects", ld_rating(F.col("objects")).alias("rating"),
        _one("rows", {"tag": "span", "named": "product-offer__price"})["spaced"].alias("was"),
        _valued(entries("style_list", {"tag": "li", "like": "flavour-profile__item"}, _style_entry)).alias("styles"),
        F.filter(
            entries("notes_list", {"tag": "span", "named": "flavour-profile__label"}, lambda _, e: e["text"]), lambda t: t != ""
        ).alias("notes"),
        _valued(entries("facts_list", {"tag": "li"}, _fact_entry)).alias("facts"),
    )

    def last(pairs: str, key, wanted: str, value: str) -> Column:
        return F.try_element_at(F.filter(pairs, lambda p: key(p["label"]) == wanted), F.lit(-1))[value]

    def style(name: str) -> Column:
        return last("styles", lambda label: F.replace(F.lower(label), F.lit(" "), F.lit("_")), name, "value")

    def fact(name: str) -> Column:
        return last("facts", slug, name, "value")

    fields = {
        "rating_stars": strip(_field(F.col("rating"), "ratingValue")),
        "review_count": strip(_field(F.col("rating"), "reviewCount")),
        "price_inc_vat_gbp": ld_price(F.col("objects")),
        "price_before_discount_gbp": extract(F.col("was"), WAS_PRICE),
        **{f"style_{n}": style(n) for n in ("body", "richness", "smoke", "sweetness")},
        "character_notes": F.array_join("notes", "|"),
        **{f"fact_{n}": fact(n) for n in ("bottler", "country", "region", "cask_type", "colouring")},
    }
    return read.select("product_url", *[F.coalesce(fields[c], F.lit("")).alias(c) for c in DETAIL_COLUMNS])
