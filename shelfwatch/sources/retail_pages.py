"""Crawled pages out of the retail tables: the given pages plus one listing per
two dozen parts and one detail page per part, built as HTML text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.sources.retail_tables import table

PARTS_PER_PAGE = 24
SITE = "https://shop.example"

ITEM = (
    """'{"item_id": "' || CAST(p_partkey AS STRING) || '", "item_name": "' || p_name || '", "item_brand": "' || p_brand"""
    """ || '", "item_variant": "' || CAST(p_size * 2 AS STRING) || 'cl / 40%", "price": ' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)"""
    """ || ', "item_category3": "' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'Islay' END || '"}'"""
)
LD_ITEM = (
    """'{"@type": "ListItem", "item": {"sku": "' || CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS STRING) ELSE '' END"""
    """ || '", "name": "' || p_name || '", "brand": {"name": "' || p_brand || '"}, "offers": {"price": "' ||"""
    """ CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) || '"}, "url": "/p/' || CAST(p_partkey AS STRING) || '/x"}}'"""
)
CARD = (
    """'<li class="product-grid__item"><a class="product-card" href="/p/' || CAST(p_partkey AS STRING) || '/x">"""
    """<img data-src="/img/' || CAST(p_partkey AS STRING) || '.jpg"><p class="product-card__name">' || p_name || ' &amp; Co</p>"""
    """<p class="product-card__price">£' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) || '</p>"""
    """<p class="product-card__unit-price">(£' || CAST(p_size AS STRING) || ' per litre)</p>'"""
    """ || CASE WHEN p_partkey % 5 = 0 THEN '<span class="badge"> Sold <b>out</b></span>' ELSE '' END || '</a></li>'"""
)


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages in three layouts (script items, JSON-LD list, cards only), then the given pages."""
    parts = table(spark, folder, "part").select(
        F.expr(f"p_partkey div {PARTS_PER_PAGE}").alias("page"), "p_partkey",
        F.expr(ITEM).alias("item"), F.expr(LD_ITEM).alias("ld"),
        F.when(F.expr("p_partkey % 7 <> 0"), F.expr(CARD)).otherwise("").alias("card"),
    )
    # A page gathers two dozen parts at most.
    rows = parts.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "item", "ld", "card"))).alias("p"))

    def joined(field: str, separator: str):
        return F.array_join(F.transform("p", lambda x: x[field]), separator)

    layout = F.col("page") % 3
    script = F.concat(F.lit("<script>var x = 1; var items = ["), joined("item", ", "), F.lit("]; track();</script>"))
    ld = F.concat(
        F.lit('<script type="application/ld+json">{broken</script><script type="application/ld+json">{"@type": "ItemList", "itemListElement": ['),
        joined("ld", ", "),
        F.lit("]}</script>"),
    )
    head = F.when(layout == 0, script).when(layout == 1, ld).otherwise("")
    html = F.concat(F.lit("<html><head>"), head, F.lit("</head><body><ul>"), joined("card", ""), F.lit("</ul></body></html>"))
    listing = rows.select(
        F.concat(F.lit(f"{SITE}/c/all?pg="), F.col("page").cast("string")).alias("url"),
        html.alias("html"),
        F.lit("Single Malt").alias("category"),
        F.lit("2026-01-16 09:00:00").alias("fetched_at"),
        F.col("page").alias("page"),
    )
    # Pages of cards alone are shown in a second category as well.
    again = listing.where("page % 3 = 2").withColumns(
        {"url": F.concat(F.lit(f"{SITE}/c/blend?pg="), F.col("page").cast("string")), "category": F.lit("Blended")}
    )
    given = table(spark, folder, "pages").select(
        "url", "html", F.lit("Blended").alias("category"), F.lit("2026-01-16 09:00:00").alias("fetched_at"),
        F.col("page_id").alias("page"),
    )
    return listing.unionByName(again).unionByName(given)


DETAIL_HTML = (
    """'<html><head>' || CASE p_partkey % 3"""
    """ WHEN 0 THEN '<script type=application/ld+json>{"@type": "Thing", "@type": "Product", "offers": {"price": "0", "price": "' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)"""
    """ || '"}, "aggregateRating": {"ratingValue": "4.5", "reviewCount": ' || CAST(p_size AS STRING) || '}}</script>'"""
    """ WHEN 1 THEN '<script type="application/ld+json">{"broken": </script><script type="application/ld+json">[{"@type": "Crumbs"}, {"offers": [{"price": null}, {"price": '"""
    """ || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) || '}]}]</script>' ELSE '' END || '</head><body>'"""
    """ || CASE WHEN p_partkey % 2 = 0 THEN '<span class="a product-offer__price">WAS <b>£ ' || CAST(p_size + 100 AS STRING) || '.50</b></span>' ELSE '' END"""
    """ || '<details id="Style"><ul class="flavour-profile__list"><li class="flavour-profile__item"><span class="flavour-profile__label">Body</span>"""
    """<span class="flavour-profile__content"> ' || CAST(p_size % 11 AS STRING) || ' </span></li><li class="flavour-profile__item"><span class="flavour-profile__label"> Smoke </span>"""
    """<div class="flavour-profile__gauge" data-text="' || CAST(p_size % 7 AS STRING) || '"></div></li></ul></details>"""
    """<details id="Character"><ul class="flavour-profile__list"><li><span class="flavour-profile__label">Oak</span></li><li><span class="flavour-profile__label">' || p_type || '</span></li></ul></details>"""
    """<details id="ProductFacts"><ul class="product-facts"><li><h3>Bottler</h3><p>' || p_brand || ' &amp; <i>Sons</i></p></li><li><h3>Cask  Type</h3><p>Sherry</p></li><li><h3>Colouring</h3><p></p></li></ul></details></body></html>'"""
)


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One detail page per part, then the given pages."""
    # Spread the narrow rows first: a page costs far more to read than to build.
    parts = table(spark, folder, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    own = parts.select(
        F.expr(f"'{SITE}/p/' || CAST(p_partkey AS STRING) || '/x'").alias("url"), F.expr(DETAIL_HTML).alias("html")
    )
    return own.unionByName(table(spark, folder, "pages").select("url", "html"))
