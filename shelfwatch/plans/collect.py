"""Crawled pages to raw product records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators import listing
from shelfwatch.operators.keyfilter import bit_filter, passes
from shelfwatch.schema import DETAIL_COLUMNS, RAW_COLUMNS
from shelfwatch.session import materialise
from shelfwatch.sources import pages


def listing_records(listing_pages: DataFrame, cap: int | None = None) -> DataFrame:
    """First occurrence per product and category of the page, capped per category only if asked.

    ``listing_pages`` holds ``url, html, category, fetched_at`` and the number
    of the listing ``page``.
    """
    return listing.listing_cap(pages.listing_rows(listing_pages), group="page_category", cap=cap)


def raw_records(listing_pages: DataFrame, detail_pages: DataFrame, cap: int | None = None) -> DataFrame:
    """Listing rows with the details of their product pages, in raw-column order.

    Only pages some listing row links to are read: a filter of fixed size passes over
    the page URLs, and only the short fields of the pages that are left are joined, so no
    HTML is shuffled. Of several copies of a page one is kept, by value.
    """
    # Read twice below, for the wanted URLs and for the result.
    rows = materialise(listing_records(listing_pages, cap), "listing")
    wanted = listing.detail_urls(rows)
    likely = detail_pages.where(passes(bit_filter(wanted, "product_url"), F.col("url")))
    details = pages.detail_rows(likely).groupBy("product_url").agg(F.min(F.struct(*DETAIL_COLUMNS)).alias("d"))
    return listing.enrich(rows, details.select("product_url", "d.*")).select(*RAW_COLUMNS)
