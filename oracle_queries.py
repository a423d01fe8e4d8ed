"""The SQL each registered query is checked against, in plain ANSI style for DuckDB."""

from __future__ import annotations

from shelfwatch import schema as S
from shelfwatch.sources import retail_tables as R
from shelfwatch.sources.retail_pages import PARTS_PER_PAGE, SITE

# Fixed values, written out here so that a wrong rule in the library shows.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
AGE_PATTERN = r"(?i)\b(\d{1,2})\s*(?:year(?:s)?(?:\s+old)?|yo)\b"
AMOUNT_PATTERN = r"(\d+(?:\.\d+)?)\s*(?:ml|cl|l|litre|liter)"
UNIT_PATTERN = r"(?i)(\d+(?:\.\d+)?)\s*(ml|cl|l|litre|liter)"
STRENGTH_PATTERN = r"(\d+(?:\.\d+)?)\s*%"
NUMBER_PATTERN = r"(\d+(?:\.\d+)?)"
BASIS_PATTERN = r"(?:per|/)\s*([0-9]+(?:\.[0-9]+)?\s*)?(ml|cl|l|litre|liter)"
PRICE_TIER = ([0, 40, 120, None], ["Budget", "Premium", "Luxury"])
DISCOUNT_BAND = (
    [-0.01, 0, 10, 20, 40, None], ["No Discount", "Low (≤10%)", "Medium (10–20%)", "High (20–40%)", "Very High (>40%)"],
)
AGE_BAND = ([0, 10, 15, 18, 25, None], ["≤10", "11–15", "16–18", "19–25", "25+"])
BOTTLE_BAND = (
    [0, 0.35, 0.7, 1.0, None],
    ["Mini/Small (≤35cl)", "Half–Standard (35–70cl)", "Standard–Large (70cl–1L)", "Extra Large (>1L)"],
)
ABV_BAND = ([0, 40, 43, 46, 50, None], ["≤40%", "40–43%", "43–46%", "46–50%", "50%+"])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def report(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


def even(expression: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"(round_even(({expression}) * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE)"


def band(c: str, edges, labels, right: bool = True) -> str:
    op = "<=" if right else "<"
    cases = [f"WHEN {c} IS NULL OR {c} {op} {edges[0]} THEN NULL"]
    for upper, label in zip(edges[1:], labels, strict=True):
        cases.append(f"WHEN {'TRUE' if upper is None else f'{c} {op} {upper}'} THEN '{label}'")
    return "CASE " + " ".join(cases) + " END"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def untoken(c: str) -> str:
    words = ", ".join(f"'{t}'" for t in S.MISSING_TOKENS)
    return f"CASE WHEN lower({strip(c)}) IN ({words}) THEN NULL ELSE {strip(c)} END"


def number(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{NUMBER_TEXT}') THEN TRY_CAST({c} AS DOUBLE) END"


def integer(c: str) -> str:
    d = f"TRY_CAST(trim({c}) AS DECIMAL(38,10))"
    return f"CASE WHEN regexp_matches({c}, '{NUMBER_TEXT}') AND {d} = floor({d}) THEN CAST({d} AS BIGINT) END"


def match(c: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({c}, '{pattern}', {group}), '')"


# -- the mapped snapshots ----------------------------------------------------------------

BEFORE = (
    "CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.002 AS DECIMAL(4,3)), 2) AS DECIMAL(10,2))"
)
SALE = f"CAST(ROUND({BEFORE} * (1 - 5 * CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(10,2))"

MAPPED = f"""mapped AS (
  SELECT l_shipdate AS scraped_at, l_orderkey, l_linenumber, l_extendedprice, l_quantity,
    l_partkey AS product_id, p_name AS name, p_brand AS brand, p_type AS category, r_name AS region,
    CAST({BEFORE} AS DOUBLE) AS price_before_discount_gbp, CAST({SALE} AS DOUBLE) AS price_inc_vat_gbp,
    CAST(CAST(p_size / 50.0 AS DECIMAL(10,3)) AS DOUBLE) AS bottle_size_l,
    CAST(38 + p_partkey % 20 AS DOUBLE) AS abv_percent, NULLIF(p_partkey % 36, 0) AS age_years,
    CAST(3 + l_tax * 25 AS DECIMAL(4,2)) AS rating_stars, CAST(l_quantity * 10 AS BIGINT) AS review_count
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def price_cte(source: str, out: str) -> str:
    units = even("bottle_size_l * abv_percent")
    return f"""{out}_units AS (
  SELECT *, COALESCE(price_before_discount_gbp, price_inc_vat_gbp) AS reference_price_gbp,
    CASE WHEN {units} > 0 THEN {units} END AS alcohol_units,
    CASE WHEN price_before_discount_gbp - price_inc_vat_gbp > 0 THEN price_before_discount_gbp - price_inc_vat_gbp END AS discount_amount_gbp
  FROM {source}),
{out}_prices AS (
  SELECT *, {even("reference_price_gbp / alcohol_units")} AS price_per_alcohol_unit_gbp,
    {band("reference_price_gbp", *PRICE_TIER, right=False)} AS price_tier,
    discount_amount_gbp IS NOT NULL AS is_discounted,
    CASE WHEN discount_amount_gbp IS NULL THEN 0.0::DOUBLE ELSE {even("discount_amount_gbp / price_before_discount_gbp * 100.0::DOUBLE")} END AS discount_percent
  FROM {out}_units),
{out} AS (SELECT *, {band("discount_percent", *DISCOUNT_BAND)} AS discount_band FROM {out}_prices)"""


BANDS = f"""age_years IS NOT NULL AS is_age_stated, {band("age_years", *AGE_BAND)} AS age_band,
    {band("bottle_size_l", *BOTTLE_BAND)} AS bottle_size_band,
    COALESCE(bottle_size_l >= 0.7, FALSE) AS is_standard_bottle, COALESCE(bottle_size_l >= 0.35, FALSE) AS is_comparable_bottle,
    {band("abv_percent", *ABV_BAND)} AS abv_band, COALESCE(abv_percent >= 50, FALSE) AS is_cask_strength"""

SNAPSHOTS = (MAPPED, price_cte("mapped", "priced"), f"snapshots AS (SELECT *, {BANDS} FROM priced)")

NEWEST = (
    "ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, l_orderkey DESC, l_linenumber DESC,"
    " l_extendedprice DESC, l_quantity DESC) = 1"
)


def _as_warehouse() -> str:
    decimals = {"bottle_size_l": (10, 3), "abv_percent": (5, 2)} | {
        c: S.FACT_DECIMALS[c]
        for c in (
            "price_before_discount_gbp", "price_inc_vat_gbp", "reference_price_gbp", "alcohol_units",
            "price_per_alcohol_unit_gbp", "discount_amount_gbp", "discount_percent",
        )
    }
    casts = ", ".join(f"CAST({c} AS DECIMAL({p},{s})) AS {c}" for c, (p, s) in decimals.items())
    return f"latest AS (SELECT * REPLACE ({casts}) FROM snapshots QUALIFY {NEWEST})"


LATEST = (*SNAPSHOTS, _as_warehouse())
L = with_(*LATEST)

# -- the seven queries -------------------------------------------------------------------

P = "price_inc_vat_gbp"
PD = f"CAST({P} AS DOUBLE)"


def positioning(key: str) -> str:
    return f"""{key}, COUNT(*) AS sku_count, {report(f"MEDIAN({PD})", 2)} AS median_price_gbp,
  {report(f"AVG({P})", 2)} AS avg_price_gbp, {report(f"MIN({P})", 2)} AS min_price_gbp, {report(f"MAX({P})", 2)} AS max_price_gbp,
  {report(f"quantile_cont({PD}, 0.9) - quantile_cont({PD}, 0.1)", 2)} AS p10_p90_spread_gbp,
  {report("AVG(rating_stars)", 2)} AS avg_catalog_rating,
  {report("SUM(rating_stars * review_count) / NULLIF(SUM(review_count), 0)", 2)} AS weighted_consumer_rating"""


RATED = f"{P} IS NOT NULL AND rating_stars IS NOT NULL AND review_count IS NOT NULL"
ON_SALE = "AVG(CASE WHEN is_discounted THEN 1 ELSE 0 END) * 100"

Q1 = f"""{L} SELECT {positioning("brand")}, {report(ON_SALE, 1)} AS pct_skus_on_sale_now
FROM latest WHERE {RATED} AND brand IS NOT NULL GROUP BY brand HAVING COUNT(*) >= 5"""

Q2 = f"""{L} SELECT {positioning("region")}, CAST(SUM(review_count) AS BIGINT) AS total_reviews,
  {report(ON_SALE, 2)} AS pct_skus_discounted_now
FROM latest WHERE {RATED} AND region IS NOT NULL AND category = 'STANDARD' AND is_comparable_bottle
GROUP BY region HAVING COUNT(*) >= 5"""

SCORE = report("CAST(rating_stars AS DOUBLE) / NULLIF(CAST(price_per_alcohol_unit_gbp AS DOUBLE), 0)", 2)

Q3 = f"""{L} SELECT product_id, name, brand, region, CAST(bottle_size_l AS DOUBLE) AS bottle_size_l,
  CAST(rating_stars AS DOUBLE) AS rating_stars, CAST(review_count AS DOUBLE) AS review_count, {PD} AS {P},
  CAST(alcohol_units AS DOUBLE) AS alcohol_units, CAST(price_per_alcohol_unit_gbp AS DOUBLE) AS price_per_alcohol_unit_gbp,
  {SCORE} AS value_score
FROM latest WHERE is_standard_bottle AND price_per_alcohol_unit_gbp IS NOT NULL AND rating_stars >= 4.0 AND review_count >= 50
ORDER BY value_score DESC NULLS LAST, product_id LIMIT 20"""

Q4 = f"""{L} SELECT discount_band, COUNT(*) AS discounted_skus_now, {report("AVG(discount_percent)", 2)} AS avg_discount_pct,
  {report("AVG(discount_amount_gbp)", 2)} AS avg_discount_amount_gbp, {report("MIN(discount_percent)", 2)} AS min_discount_pct,
  {report("MAX(discount_percent)", 2)} AS max_discount_pct
FROM latest WHERE is_discounted AND discount_percent IS NOT NULL GROUP BY discount_band"""


def rated_entity(kind: str, column: str) -> str:
    return f"""SELECT '{kind}' AS entity_type, {column} AS entity_name, COUNT(*) AS sku_count,
  CAST(SUM(review_count) AS BIGINT) AS total_reviews,
  {report("SUM(rating_stars * review_count) / NULLIF(SUM(review_count), 0)", 2)} AS weighted_rating
FROM latest WHERE {column} IS NOT NULL AND rating_stars IS NOT NULL AND review_count IS NOT NULL
GROUP BY {column} HAVING SUM(review_count) >= 200"""


Q5 = f"""{L}, entities AS (
{rated_entity("Brand", "brand")} UNION ALL {rated_entity("Region", "region")} UNION ALL
SELECT 'Product', CAST(product_id AS VARCHAR), 1, review_count, {report("rating_stars", 2)} FROM latest
WHERE rating_stars IS NOT NULL AND review_count >= 50)
SELECT entity_type, entity_name, sku_count, total_reviews, weighted_rating FROM entities
QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_type ORDER BY weighted_rating DESC, total_reviews DESC, entity_name) <= 3"""


def factor(name: str, label: str, condition: str, least: int = 0) -> str:
    mean = f"CAST(AVG({P}) AS DECIMAL(28,6))"
    return f"""SELECT '{name}' AS factor, {label} AS category, COUNT(DISTINCT product_id) AS sku_count, {report(f"AVG({P})", 2)} AS avg_price,
  {report(f"{mean} - (SELECT b FROM base)", 2)} AS vs_baseline_gbp,
  {report(f"CAST({mean} - (SELECT b FROM base) AS DOUBLE) / NULLIF(CAST((SELECT b FROM base) AS DOUBLE), 0) * 100", 1)} AS vs_baseline_pct
FROM comparable WHERE {condition} GROUP BY 2 HAVING COUNT(DISTINCT product_id) >= {least}"""


AGE_TIER = (
    "CASE WHEN age_years BETWEEN 1 AND 9 THEN '01-09' WHEN age_years BETWEEN 10 AND 12 THEN '10-12'"
    " WHEN age_years BETWEEN 13 AND 15 THEN '13-15' WHEN age_years BETWEEN 16 AND 18 THEN '16-18'"
    " WHEN age_years BETWEEN 19 AND 21 THEN '19-21' WHEN age_years BETWEEN 22 AND 25 THEN '22-25'"
    " WHEN age_years BETWEEN 26 AND 30 THEN '26-30' ELSE '31+' END"
)
QUALITY = (
    "CASE WHEN rating_stars >= 4.5 THEN 'Exceptional (4.5+)' WHEN rating_stars >= 4.0 THEN 'Excellent (4.0-4.5)'"
    " WHEN rating_stars >= 3.5 THEN 'Good (3.5-4.0)' ELSE 'Average (<3.5)' END"
)
Q6 = f"""{L}, comparable AS (SELECT * FROM latest WHERE is_comparable_bottle AND {P} IS NOT NULL),
base AS (SELECT CAST(MEDIAN({PD}) AS DECIMAL(28,6)) AS b, COUNT(DISTINCT product_id) AS n FROM comparable)
SELECT 'Overall Baseline' AS factor, 'All comparable bottles (median baseline)' AS category, n AS sku_count,
  {report("b", 2)} AS avg_price, CAST(NULL AS DOUBLE) AS vs_baseline_gbp, CAST(NULL AS DOUBLE) AS vs_baseline_pct FROM base
UNION ALL {factor("Age Tier Premium", AGE_TIER, "is_age_stated AND age_years > 0", 5)}
UNION ALL {factor("Cask Strength", "CASE WHEN is_cask_strength THEN 'Cask Strength' ELSE 'Standard ABV' END", "is_cask_strength IS NOT NULL")}
UNION ALL {factor("Region Premium", "region", "region IS NOT NULL", 10)}
UNION ALL {factor("Quality Tier", QUALITY, "rating_stars IS NOT NULL")}"""

PRICE_STEP = "avg_price - LAG(avg_price) OVER (ORDER BY avg_age_years, age_band)"
AGE_STEP = "avg_age_years - LAG(avg_age_years) OVER (ORDER BY avg_age_years, age_band)"
Q7 = f"""{L}, bands AS (SELECT age_band, {report("AVG(age_years)", 1)} AS avg_age_years, COUNT(DISTINCT product_id) AS sku_count,
  {report(f"AVG({P})", 2)} AS avg_price, {report(f"MEDIAN({PD})", 2)} AS median_price,
  {report(f"AVG({PD} / NULLIF(age_years, 0))", 2)} AS price_per_year_aged, {report("AVG(rating_stars)", 2)} AS avg_rating,
  {report("AVG(price_per_alcohol_unit_gbp)", 2)} AS avg_price_per_unit
FROM latest WHERE is_age_stated AND is_comparable_bottle AND age_years IS NOT NULL AND {P} IS NOT NULL GROUP BY age_band)
SELECT *, {report(PRICE_STEP, 2)} AS marginal_price_increase_gbp,
  {report(f"({PRICE_STEP}) / NULLIF({AGE_STEP}, 0)", 2)} AS marginal_cost_per_additional_year,
  CASE WHEN price_per_year_aged <= 5 THEN 'Excellent Value' WHEN price_per_year_aged <= 10 THEN 'Good Value'
    WHEN price_per_year_aged <= 15 THEN 'Fair Value' ELSE 'Premium/Diminishing Returns' END AS value_assessment FROM bands"""

# -- dashboard measures ------------------------------------------------------------------

REVIEWS = "CAST(COALESCE(SUM(review_count), 0) AS BIGINT) AS total_reviews"
BIN = f"CAST(floor({P} / 50) * 50 AS DOUBLE)"
MEASURES = {
    "m1_histogram": f"{L} SELECT {BIN} AS price_from, COUNT(*) AS sku_count FROM latest WHERE {P} IS NOT NULL GROUP BY 1",
    "m1_skew": f"""{L}, x AS (SELECT {PD} AS x FROM latest), m AS (SELECT AVG(x) AS m, STDDEV_POP(x) AS s, COUNT(x) AS n FROM x)
SELECT MAX(n) AS sku_count, {report("MAX(m)", 4)} AS mean_price, {report("MAX(s)", 4)} AS sd_price,
  {report("AVG((x - m) * (x - m) * (x - m)) / (MAX(s) * MAX(s) * MAX(s))", 4)} AS price_skewness FROM x, m""",
    "m2_tier_overview": f"""{L} SELECT price_tier, COUNT(*) AS sku_count, {REVIEWS}, {report("AVG(rating_stars)", 2)} AS avg_rating
FROM latest GROUP BY price_tier""",
    "m3_price_rating": f"""{L} SELECT category, COUNT(*) FILTER ({P} IS NOT NULL AND rating_stars IS NOT NULL) AS sku_count,
  {report(f"corr({PD}, CAST(rating_stars AS DOUBLE))", 4)} AS price_rating_corr FROM latest GROUP BY category""",
    "m4_revenue_index": f"""{L} SELECT brand, COUNT(*) AS sku_count, {report(f"SUM(review_count * {P})", 2)} AS revenue_index
FROM latest WHERE brand IS NOT NULL GROUP BY brand""",
    "m5_brand_tier_mix": f"""{L} SELECT brand, COUNT(*) FILTER (price_tier = 'Budget') AS budget,
  COUNT(*) FILTER (price_tier = 'Premium') AS premium, COUNT(*) FILTER (price_tier = 'Luxury') AS luxury
FROM latest WHERE brand IS NOT NULL GROUP BY brand""",
    "m6_value_score": f"""{L}, s AS (SELECT price_tier, brand, CAST({SCORE} AS DECIMAL(18,2)) AS score FROM latest WHERE brand IS NOT NULL)
SELECT price_tier, brand, COUNT(score) AS scored_skus, {report("AVG(score)", 2)} AS avg_value_score FROM s GROUP BY price_tier, brand
UNION ALL SELECT price_tier, 'All', COUNT(score), {report("AVG(score)", 2)} FROM s GROUP BY price_tier""",
    "m7_discount_penetration": f"""{L} SELECT price_tier, COUNT(*) AS sku_count, COUNT(*) FILTER (is_discounted) AS discounted_skus,
  {report("CAST(COUNT(*) FILTER (is_discounted) AS DOUBLE) / COUNT(*) * 100", 2)} AS discount_penetration_pct,
  {report("AVG(CASE WHEN is_discounted THEN discount_percent END)", 2)} AS avg_depth_pct FROM latest GROUP BY price_tier""",
    "m8_band_engagement": f"""{L} SELECT discount_band, COUNT(*) AS sku_count, {REVIEWS}, {report("AVG(review_count)", 2)} AS avg_reviews
FROM latest GROUP BY discount_band""",
    "m9_price_band_engagement": f"""{L} SELECT {BIN} AS price_from, COUNT(*) AS sku_count, {REVIEWS}, {report("AVG(review_count)", 2)} AS avg_reviews
FROM latest WHERE {P} IS NOT NULL GROUP BY 1""",
    "m10_elasticity": f"""{L}, x AS (SELECT category, {PD} AS price, CAST(review_count AS DOUBLE) AS reviews FROM latest)
SELECT category, regr_count(reviews, price) AS sku_count, {report("regr_slope(reviews, price)", 4)} AS review_slope,
  {report("regr_slope(CASE WHEN price > 0 AND reviews > 0 THEN ln(reviews) END, CASE WHEN price > 0 AND reviews > 0 THEN ln(price) END)", 4)} AS review_elasticity
FROM x GROUP BY category""",
    "m11_slicer": f"""{L}, g AS (SELECT category, FALSE AS every, {P}, rating_stars, review_count FROM latest
  UNION ALL SELECT 'All', TRUE, {P}, rating_stars, review_count FROM latest)
SELECT category, COUNT(*) AS sku_count, {report(f"AVG({P})", 2)} AS avg_price, {report("AVG(rating_stars)", 2)} AS avg_rating, {REVIEWS}
FROM g GROUP BY category, every""",
}

# -- dedup -------------------------------------------------------------------------------

DEDUP = {
    "latest_per_product": """SELECT l_partkey AS product_id, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  CAST(l_shipdate AS VARCHAR) AS scraped_at FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
  l_extendedprice DESC, l_quantity DESC) = 1""",
    "exact_dedup": """SELECT l_partkey AS product_id, l_returnflag, l_discount, CAST(MIN(l_shipdate) AS VARCHAR) AS scraped_at
FROM lineitem GROUP BY l_partkey, l_returnflag, l_discount""",
    "dedup_snapshots_aba": """WITH d AS (SELECT user_id, event_type, MIN(ts) AS ts FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, CAST(ts AS VARCHAR) AS ts FROM d
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) = 1""",
    "dedup_snapshots_newest": """SELECT user_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) = 1""",
    "intake_stream": """SELECT user_id, event_type, value, props, CAST(MIN(ts) AS VARCHAR) AS ts FROM events
GROUP BY user_id, event_type, value, props""",
}

# -- star schema -------------------------------------------------------------------------

SN = with_(*SNAPSHOTS)
DIM = f"""dim AS (SELECT product_id, name, brand, category, region, bottle_size_l, bottle_size_band,
    is_standard_bottle, is_comparable_bottle, abv_percent, abv_band, is_cask_strength, age_years, is_age_stated, age_band
  FROM snapshots QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, region DESC) = 1)"""


def columns(names: list[str], known: set[str], flags: set[str], prefix: str) -> str:
    out = []
    for c in names:
        if c not in known:
            kind = "BOOLEAN" if c in flags else "DOUBLE" if c in S.PRODUCT_DECIMALS | S.FACT_DECIMALS else "VARCHAR"
            out.append(f"CAST(NULL AS {kind}) AS {c}")
        elif c in S.PRODUCT_DECIMALS | S.FACT_DECIMALS:
            p, s = (S.PRODUCT_DECIMALS | S.FACT_DECIMALS)[c]
            out.append(f"CAST(CAST({prefix}.{c} AS DECIMAL({p},{s})) AS DOUBLE) AS {c}")
        else:
            out.append(f"{prefix}.{c}")
    return ", ".join(out)


DIM_KNOWN = {
    "name", "brand", "category", "region", "bottle_size_l", "bottle_size_band", "is_standard_bottle",
    "is_comparable_bottle", "abv_percent", "abv_band", "is_cask_strength", "age_years", "is_age_stated", "age_band",
}
FACT_KNOWN = {
    "price_inc_vat_gbp", "price_before_discount_gbp", "reference_price_gbp", "alcohol_units", "price_per_alcohol_unit_gbp",
    "discount_amount_gbp", "is_discounted", "discount_percent", "rating_stars", "review_count",
}
FLAGS = set(S.PRODUCT_FLAGS + S.FACT_FLAGS)
VIEW_DIM = [c for c in S.SNAPSHOT_COLUMNS[3:26]]

# The text of a measure in a snapshot's key: its declared decimal, or '-' for NULL.
KEY_TEXTS = ", ".join(
    "'-'" if c not in FACT_KNOWN else f"COALESCE(CAST(s.{c} AS VARCHAR), '-')" if c in FLAGS
    else "COALESCE(CAST(CAST(s.{} AS DECIMAL({},{})) AS VARCHAR), '-')".format(c, *S.FACT_DECIMALS[c])
    for c in S.FACT_MEASURES
)
DATE_KEY = "CAST(strftime(scraped_at, '%Y%m%d') AS INTEGER)"
STAR = {
    "dim_date": """SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS full_date,
  CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(day(l_shipdate) AS INTEGER) AS day,
  CAST(weekofyear(l_shipdate) AS INTEGER) AS week, left(dayname(l_shipdate), 3) AS day_name FROM lineitem""",
    "dim_tier": f"{SN} SELECT ROW_NUMBER() OVER (ORDER BY price_tier) AS price_tier_key, price_tier FROM (SELECT DISTINCT price_tier FROM snapshots WHERE price_tier IS NOT NULL)",
    "dim_band": f"{SN} SELECT ROW_NUMBER() OVER (ORDER BY discount_band) AS discount_band_key, discount_band FROM (SELECT DISTINCT discount_band FROM snapshots WHERE discount_band IS NOT NULL)",
    "dim_product": f"{with_(*SNAPSHOTS, DIM)} SELECT product_id AS product_key, product_id, {columns(S.PRODUCT_ATTRIBUTES, DIM_KNOWN, FLAGS, 'dim')} FROM dim",
    "fact_snapshot": f"""{SN} SELECT {DATE_KEY} AS date_key, product_id AS product_key,
  CASE price_tier WHEN 'Budget' THEN 1 WHEN 'Luxury' THEN 2 WHEN 'Premium' THEN 3 END AS price_tier_key,
  CAST((SELECT COUNT(DISTINCT o.discount_band) FROM snapshots o WHERE o.discount_band <= s.discount_band) AS BIGINT) AS discount_band_key,
  CAST(scraped_at AS VARCHAR) AS snapshot_ts, {columns(S.FACT_MEASURES, FACT_KNOWN, FLAGS, 's')} FROM snapshots s""",
    "star_join": f"""{with_(*SNAPSHOTS, DIM)} SELECT CAST(CAST(s.scraped_at AS DATE) AS VARCHAR) AS full_date, dim.product_id,
  {columns(VIEW_DIM, DIM_KNOWN, FLAGS, 'dim')}, s.price_tier, s.discount_band, {columns(S.FACT_MEASURES, FACT_KNOWN, FLAGS, 's')},
  CAST(s.scraped_at AS VARCHAR) AS snapshot_ts FROM snapshots s JOIN dim USING (product_id)""",
    "star_latest": f"""{with_(*SNAPSHOTS, DIM)}, m AS (SELECT product_id, scraped_at, {columns(S.FACT_MEASURES, FACT_KNOWN, FLAGS, 's')} FROM snapshots s),
newest AS (SELECT * FROM m QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, {', '.join(f'{c} DESC NULLS LAST' for c in S.FACT_MEASURES)}) = 1)
SELECT dim.product_id, name, brand, category, region, age_band, CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS full_date,
  CAST(scraped_at AS VARCHAR) AS snapshot_ts, {', '.join(f'newest.{c}' for c in S.FACT_MEASURES)} FROM dim JOIN newest USING (product_id)""",
    "star_load": f"""{SN} SELECT 'dim_date' AS table_name, COUNT(DISTINCT CAST(scraped_at AS DATE)) AS row_count FROM snapshots
UNION ALL SELECT 'dim_price_tier', COUNT(DISTINCT price_tier) FROM snapshots UNION ALL SELECT 'dim_discount_band', COUNT(DISTINCT discount_band) FROM snapshots
UNION ALL SELECT 'dim_product', COUNT(DISTINCT product_id) FROM snapshots UNION ALL SELECT 'fact_product_snapshot', COUNT(*) FROM snapshots""",
    "star_reload": f"""{SN}, m AS (SELECT 'after' AS reader, * FROM snapshots UNION ALL SELECT 'before', * FROM snapshots WHERE scraped_at < TIMESTAMP '1996-01-01'),
t AS (SELECT reader, product_id, scraped_at, {columns(S.FACT_MEASURES, FACT_KNOWN, FLAGS, 'm')} FROM m),
newest AS (SELECT * FROM t QUALIFY ROW_NUMBER() OVER (PARTITION BY reader, product_id ORDER BY scraped_at DESC, {', '.join(f'{c} DESC NULLS LAST' for c in S.FACT_MEASURES)}) = 1)
SELECT reader, 'latest' AS table_name, COUNT(*) AS row_count, CAST(SUM(CAST(price_inc_vat_gbp AS DECIMAL(18,2))) AS DOUBLE) AS price_total FROM newest GROUP BY reader
UNION ALL SELECT reader, 'fact', COUNT(*), CAST(SUM(CAST(price_inc_vat_gbp AS DECIMAL(18,2))) AS DOUBLE) FROM t GROUP BY reader""",
    "snapshot_keys": f"""{SN}, said AS (SELECT product_id, scraped_at, concat_ws('|', CAST(product_id AS VARCHAR), CAST(scraped_at AS VARCHAR),
    COALESCE(price_tier, '-'), COALESCE(discount_band, '-'), {KEY_TEXTS}) AS words, price_inc_vat_gbp FROM snapshots s)
SELECT md5(words || '|' || ROW_NUMBER() OVER (PARTITION BY words) || '|0') AS snapshot_key, product_id AS product_key, {DATE_KEY} AS date_key,
  CAST(CAST(price_inc_vat_gbp AS DECIMAL(10,2)) AS DOUBLE) AS price_inc_vat_gbp FROM said""",
    "audit_fk": f"""{SN} SELECT 'dim_date' AS dimension, (SELECT COUNT(*) FROM lineitem WHERE day(l_shipdate) = 1) AS orphan_rows
UNION ALL SELECT 'dim_product', (SELECT COUNT(*) FROM lineitem WHERE l_partkey % 13 = 0)
UNION ALL SELECT 'dim_price_tier', (SELECT COUNT(*) FROM snapshots WHERE price_tier = 'Luxury')
UNION ALL SELECT 'dim_discount_band', (SELECT COUNT(*) FROM snapshots WHERE discount_band = 'No Discount')""",
    "audit_unique": """WITH d AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'lineitem' AS table_name, MAX(n) <= 1 AS is_unique, COUNT(*) AS distinct_keys, CAST(SUM(n - 1) AS BIGINT) AS surplus_rows FROM d
UNION ALL SELECT 'part', COUNT(*) = COUNT(DISTINCT p_partkey), COUNT(DISTINCT p_partkey), COUNT(*) - COUNT(DISTINCT p_partkey) FROM part
UNION ALL SELECT 'orders', COUNT(*) = COUNT(DISTINCT o_orderkey), COUNT(DISTINCT o_orderkey), COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders""",
    "audit_star_unique": """WITH twice AS (SELECT COUNT(DISTINCT l_partkey) AS n FROM lineitem WHERE l_partkey % 13 <> 0 AND l_partkey % 10 = 0)
SELECT table_name, key_name, table_name <> 'dim_product' OR n = 0 AS is_unique, CASE WHEN table_name = 'dim_product' THEN n ELSE 0 END AS surplus_rows
FROM twice, (VALUES ('dim_date', 'date_key'), ('dim_price_tier', 'price_tier_key'), ('dim_price_tier', 'price_tier'),
  ('dim_discount_band', 'discount_band_key'), ('dim_discount_band', 'discount_band'), ('dim_product', 'product_key'),
  ('dim_product', 'product_id'), ('fact_product_snapshot', 'snapshot_key')) t(table_name, key_name)""",
    "audit_nulls": """WITH k AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_partkey % 13 <> 0 AND l_partkey % 7 = 0)
SELECT table_name, column_name, CAST(CASE WHEN column_name = 'name' THEN (SELECT COUNT(*) + COUNT(*) FILTER (key % 10 = 0) FROM k) ELSE 0 END AS BIGINT) AS null_count
FROM (VALUES ('dim_date', 'date_key'), ('dim_date', 'full_date'), ('dim_price_tier', 'price_tier'), ('dim_discount_band', 'discount_band'),
  ('dim_product', 'product_id'), ('dim_product', 'name'), ('fact_product_snapshot', 'date_key'), ('fact_product_snapshot', 'product_key')) t(table_name, column_name)""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1",
    "orphan_keys": "SELECT doc_id, COUNT(*) AS row_count FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id",
}

# -- raw records and cleaning ------------------------------------------------------------

RAW = "raw AS (SELECT " + ", ".join(f"{R.RAW_TEXTS[c]} AS {c}" for c in S.RAW_COLUMNS) + " FROM lineitem JOIN part ON p_partkey = l_partkey)"


def cast_of(c: str) -> str:
    if c in S.TIME_COLUMNS:
        return f"TRY_CAST({c} AS TIMESTAMP)"
    if c in S.INTEGER_COLUMNS:
        return integer(c)
    return number(c) if c in S.NUMERIC_COLUMNS else c


TYPED = "typed AS (SELECT " + ", ".join(f"{cast_of(c)} AS {c}" for c in S.RAW_COLUMNS) + " FROM raw)"
TYPED_NAMES = [*S.TIME_COLUMNS, *S.INTEGER_COLUMNS, *S.NUMERIC_COLUMNS]
TEXT_NAMES = [c for c in S.RAW_COLUMNS if c not in TYPED_NAMES and c not in S.URL_COLUMNS]
TIDY_LIST = r"trim(regexp_replace({}, '\s*\|\s*', '|', 'g'), '|')"


def tidy(source: str, out: str) -> str:
    replaced = ", ".join(f"{untoken(c)} AS {c}" for c in TEXT_NAMES)
    return f"{out} AS (SELECT * REPLACE ({replaced}) FROM {source})"


def region_name(c: str) -> str:
    return f"CASE lower({strip(c)}) WHEN 'islands' THEN 'island' WHEN 'the islands' THEN 'island' ELSE lower({strip(c)}) END"


VALID = ", ".join(f"'{r}'" for r in S.VALID_REGIONS)
OWN = region_name("region")
REGION = (
    f"COALESCE(CASE WHEN COALESCE(lower(category) = 'blended', FALSE) THEN NULL"
    f" WHEN COALESCE(lower(category) = 'single malt' AND {OWN} NOT IN ({VALID}), FALSE) THEN NULL ELSE {OWN} END, {region_name('fact_region')})"
)


def capital(c: str) -> str:
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


def brand_name(c: str) -> str:
    name = rf"regexp_replace({strip(c)}, '\s+', ' ', 'g')"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.BRAND_ALIASES.items())
    return f"CASE lower({name}) {cases} ELSE {name} END"


def litres(c: str) -> str:
    amount = f"TRY_CAST({match(c, AMOUNT_PATTERN)} AS DOUBLE)"
    unit = f"lower({match(c, UNIT_PATTERN, 2)})"
    return f"CASE {unit} WHEN 'ml' THEN {amount} / 1000.0::DOUBLE WHEN 'cl' THEN {amount} / 100.0::DOUBLE WHEN 'l' THEN {amount} WHEN 'litre' THEN {amount} WHEN 'liter' THEN {amount} END"


def abv(c: str) -> str:
    return f"TRY_CAST({match(c, STRENGTH_PATTERN)} AS DOUBLE)"


def litre_price(c: str) -> str:
    price = f"TRY_CAST({match(f'''replace(replace({c}, '£', ''), ',', '')''', NUMBER_PATTERN)} AS DOUBLE)"
    basis = f"replace(lower({c}), ',', '')"
    qty = f"TRY_CAST(trim({match(basis, BASIS_PATTERN, 1)}) AS DOUBLE)"
    unit = match(basis, BASIS_PATTERN, 2)
    scale = (
        f"CASE WHEN {unit} = 'ml' AND {qty} IS NOT NULL THEN 1000.0::DOUBLE / NULLIF({qty}, 0)"
        f" WHEN {unit} = 'cl' AND {qty} IS NOT NULL THEN 100.0::DOUBLE / NULLIF({qty}, 0)"
        f" WHEN {unit} IN ('l', 'litre', 'liter') THEN 1.0::DOUBLE / NULLIF(COALESCE({qty}, 1.0::DOUBLE), 0) ELSE 1.0::DOUBLE END"
    )
    return even(f"{price} * {scale}")


AGE = f"CAST({match('name', AGE_PATTERN)} AS BIGINT)"

OTHERS = [c for c in S.RAW_COLUMNS if c != "scraped_at"]
LIMITS = """limits AS (SELECT category,
    CASE WHEN COUNT(price_inc_vat_gbp) >= 30 THEN quantile_cont(price_inc_vat_gbp, 0.99) END AS price_limit,
    CASE WHEN COUNT(price_per_alcohol_unit_gbp) >= 30 THEN quantile_cont(price_per_alcohol_unit_gbp, 0.99) END AS value_limit
  FROM {0} WHERE category IS NOT NULL GROUP BY category),
flagged AS (SELECT f.*, COALESCE(price_inc_vat_gbp > price_limit, FALSE) AS is_price_outlier,
    COALESCE(price_per_alcohol_unit_gbp > value_limit, FALSE) AS is_value_outlier
  FROM {0} f LEFT JOIN limits ON limits.category = f.category)"""

CLEAN_STEPS = (
    RAW,
    TYPED,
    f"once AS (SELECT {', '.join(OTHERS)}, MIN(scraped_at) AS scraped_at FROM typed GROUP BY {', '.join(OTHERS)})",
    "newest AS (SELECT * FROM once QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY scraped_at DESC NULLS LAST, "
    + ", ".join(f"{c} DESC NULLS LAST" for c in OTHERS if c != "product_id")
    + ") = 1)",
    tidy("newest", "tidied"),
    f"named AS (SELECT * REPLACE ({TIDY_LIST.format('character_notes')} AS character_notes, {capital(f'({REGION})')} AS region, {brand_name('brand')} AS brand) FROM tidied)",
    f"parsed AS (SELECT * REPLACE (COALESCE(price_inc_vat_gbp, {even('price_ex_vat_gbp * 1.2::DOUBLE')}) AS price_inc_vat_gbp),"
    f" {litres('variant')} AS bottle_size_l, {abv('variant')} AS abv_percent, {litre_price('unit_price_raw')} AS unit_price, {AGE} AS age_years FROM named)",
    f"sized AS (SELECT *, {even('bottle_size_l * 100.0::DOUBLE')} AS bottle_size_cl,"
    f" COALESCE(unit_price, CASE WHEN bottle_size_l > 0 THEN {even('price_inc_vat_gbp / bottle_size_l')} END) AS unit_price_gbp_per_litre FROM parsed)",
    price_cte("sized", "featured"),
    LIMITS.format("featured"),
)
CLEAN = (
    with_(*CLEAN_STEPS)
    + f"SELECT *, {BANDS}, brand = 'Independent/Unknown' AS is_brand_placeholder, is_price_outlier OR is_value_outlier AS is_outlier FROM flagged"
)
CLEAN = f"SELECT {', '.join(c if c != 'scraped_at' else 'CAST(scraped_at AS VARCHAR) AS scraped_at' for c in [*S.CLEAN_COLUMNS, 'status'])} FROM ({CLEAN})"

CHAIN_COLUMNS = [c for c in S.SNAPSHOT_COLUMNS if c not in ("snapshot_key", "full_date", "product_id")]
CHAINED = f"""chained AS (SELECT CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS full_date, CAST(product_id AS BIGINT) AS product_id,
  {columns(CHAIN_COLUMNS, set(CHAIN_COLUMNS), FLAGS, 'c')}, CAST(scraped_at AS VARCHAR) AS snapshot_ts
FROM ({CLEAN}) c WHERE scraped_at IS NOT NULL)"""
CHAIN = {
    "chain_latest": f"WITH {CHAINED} SELECT * FROM chained",
    "chain_brand": f"""WITH {CHAINED}, latest AS (SELECT * REPLACE (CAST(price_inc_vat_gbp AS DECIMAL(10,2)) AS price_inc_vat_gbp,
  CAST(rating_stars AS DECIMAL(4,2)) AS rating_stars, CAST(review_count AS DECIMAL(10,0)) AS review_count) FROM chained)
SELECT {positioning("brand")}, {report(ON_SALE, 1)} AS pct_skus_on_sale_now
FROM latest WHERE {RATED} AND brand IS NOT NULL GROUP BY brand HAVING COUNT(*) >= 5""",
    "copy_into": f"""{with_(RAW)} SELECT product_id, name, CASE WHEN brand NOT IN ('', 'NULL', 'null', 'None') THEN brand END AS brand,
  CAST(NULL AS VARCHAR) AS region, 2 * COUNT(*) AS row_count FROM raw GROUP BY ALL""",
    "newest_file": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, '2026-01-16' AS file_date FROM part",
    "newest_rows": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, CAST(p_size AS VARCHAR) AS size,
  CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'b' WHEN p_type <> 'PROMO' THEN 'a' ELSE 'c' END AS seen_in, '2026-01-16' AS file_date FROM part""",
    "load_check": "SELECT COUNT(*) AS row_count, LEAST(COUNT(*), 10) AS preview_rows FROM lineitem JOIN part ON p_partkey = l_partkey",
    "distinct_products": f"""{with_(*SNAPSHOTS)} SELECT category, CAST(year(scraped_at) AS INTEGER) AS year, COUNT(DISTINCT product_id) AS sku_count
FROM snapshots GROUP BY ALL UNION ALL SELECT category, NULL, COUNT(DISTINCT product_id) FROM snapshots GROUP BY category""",
    "ordered_snapshots": f"""{with_(*SNAPSHOTS)} SELECT product_id, CAST(scraped_at AS VARCHAR) AS scraped_at, l_orderkey, l_linenumber, category, discount_amount_gbp,
  ROW_NUMBER() OVER (ORDER BY category, discount_amount_gbp DESC NULLS LAST, scraped_at DESC, l_orderkey, l_linenumber) AS position FROM snapshots""",
    "full_reload": """SELECT 'dim_date' AS view_name, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS row_count FROM lineitem
UNION ALL SELECT name, COUNT(DISTINCT l_partkey) FROM lineitem, (VALUES ('dim_product'), ('product_latest')) t(name) GROUP BY name
UNION ALL SELECT name, COUNT(*) FROM lineitem, (VALUES ('fact_product_snapshot'), ('product_snapshot')) t(name) GROUP BY name""",
    "unread_first": f"""{with_(RAW, TYPED)} SELECT product_id, CAST(scraped_at AS VARCHAR) AS scraped_at, price_ex_vat_gbp FROM typed
QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY scraped_at IS NULL DESC, scraped_at DESC, price_ex_vat_gbp DESC NULLS LAST) = 1""",
    "infinities": "SELECT p_partkey, CASE WHEN p_partkey % 4 > 1 THEN p_retailprice END AS ratio FROM part",
}

PART = (
    f"texts AS (SELECT p_partkey, p_size, p_brand, p_type, p_retailprice, {R.NAME_TEXT} AS name, {R.VARIANT_TEXT} AS variant,"
    f" {R.UNIT_PRICE_TEXT} AS unit_price_raw FROM part)"
)
T = with_(PART)


def unpivot(source: str, checks: dict[str, str], value: str, cte: str) -> str:
    return cte + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER ({condition}) AS BIGINT) AS {value} FROM {source}" for c, condition in checks.items()
    )


OWN_KEPT = (
    f"CASE WHEN COALESCE(lower(category) = 'blended', FALSE) THEN NULL"
    f" WHEN COALESCE(lower(category) = 'single malt' AND {OWN} NOT IN ({VALID}), FALSE) THEN NULL ELSE {OWN} END"
)
COUNTERS = {
    "rows_read": "COUNT(*) FROM raw",
    "rows_without_copies": "COUNT(*) FROM once",
    "region_filled": f"COUNT(*) FILTER (({OWN_KEPT}) IS NULL AND fact_region IS NOT NULL) FROM tidied",
    "vat_filled": "COUNT(*) FILTER (price_inc_vat_gbp IS NULL AND price_ex_vat_gbp IS NOT NULL) FROM named",
    "unit_price_filled": "COUNT(*) FILTER (unit_price IS NULL AND unit_price_gbp_per_litre IS NOT NULL) FROM sized",
    "rows": "COUNT(*) FROM flagged",
    "discounted": "COUNT(*) FILTER (is_discounted) FROM flagged",
    "without_price": "COUNT(*) FILTER (price_inc_vat_gbp IS NULL) FROM flagged",
    "outliers": "COUNT(*) FILTER (is_price_outlier OR is_value_outlier) FROM flagged",
}

CLEANING = {
    "clean_products": CLEAN,
    "clean_counters": with_(*CLEAN_STEPS)
    + " UNION ALL ".join(f"SELECT '{name}' AS counter, {query}" for name, query in COUNTERS.items()).replace(
        "COUNT(*) F", "COUNT(*) AS total F", 1
    ),
    "enforce_schema": with_(RAW, TYPED)
    + f"SELECT {', '.join(c if c != 'scraped_at' else 'CAST(scraped_at AS VARCHAR) AS scraped_at' for c in [*TYPED_NAMES, 'name'])} FROM typed",
    "rejected_cells": unpivot(
        "raw", {c: f"({untoken(c)}) IS NOT NULL AND ({cast_of(c)}) IS NULL" for c in TYPED_NAMES}, "rejected", with_(RAW)
    ),
    "null_profile": f"SELECT * FROM ({unpivot('tidied', {c: f'{c} IS NULL' for c in S.RAW_COLUMNS}, 'null_count', with_(RAW, TYPED, tidy('typed', 'tidied')))}) WHERE null_count > 0",
    "value_counts": f"{with_(RAW, TYPED, tidy('typed', 'tidied'))} SELECT region, COUNT(*) AS row_count FROM tidied GROUP BY region",
    "constant_columns": """SELECT * FROM (VALUES ('l_linestatus'), ('l_returnflag'), ('one')) t(column_name)
WHERE column_name = 'one' OR (column_name = 'l_linestatus' AND (SELECT COUNT(DISTINCT l_linestatus) FROM lineitem) <= 1)
  OR (column_name = 'l_returnflag' AND (SELECT COUNT(DISTINCT l_returnflag) FROM lineitem) <= 1)""",
    "run_summary": f"""{SN} SELECT COUNT(*) AS row_count, COUNT(*) FILTER (is_discounted) AS discounted,
  COUNT(*) FILTER (price_inc_vat_gbp IS NULL) AS without_price FROM snapshots""",
    "missing_tokens": f"{with_(RAW, TYPED, tidy('typed', 'tidied'))} SELECT {', '.join(TEXT_NAMES)}, COUNT(*) AS row_count FROM tidied GROUP BY ALL",
    "notes_norm": f"SELECT p_partkey, {TIDY_LIST.format('notes')} AS character_notes FROM (SELECT p_partkey, {R.NOTES_TEXT} AS notes FROM part)",
    "regions": f"""{with_(RAW, TYPED, tidy('typed', 'tidied'))} SELECT product_id, category, {capital(f'({REGION})')} AS region, COUNT(*) AS row_count
FROM tidied GROUP BY ALL""",
    "brands": f"SELECT p_partkey, {brand_name('b')} AS brand, ({brand_name('b')}) = 'Independent/Unknown' AS is_brand_placeholder FROM (SELECT p_partkey, {R.BRAND_TEXT} AS b FROM part)",
    "vat_fallback": f"""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE {even('p_retailprice * 1.2::DOUBLE')} END AS price_inc_vat_gbp FROM part""",
    "vat_filled": "SELECT COUNT(*) FILTER (p_partkey % 3 <> 0) AS vat_filled FROM part",
    "bottle_abv": f"{T} SELECT p_partkey, {litres('variant')} AS bottle_size_l, {even(f'({litres('variant')}) * 100.0::DOUBLE')} AS bottle_size_cl, {abv('variant')} AS abv_percent FROM texts",
    "unit_price": f"""{T} SELECT p_partkey, {litre_price('unit_price_raw')} AS parsed,
  COALESCE({litre_price('unit_price_raw')}, CASE WHEN ({litres('variant')}) > 0 THEN {even(f'p_retailprice / ({litres('variant')})')} END) AS unit_price_gbp_per_litre FROM texts""",
    "age_parse": f"{T} SELECT p_partkey, {AGE} AS age_years, ({AGE}) IS NOT NULL AS is_age_stated FROM texts",
    "price_features": f"""{with_(MAPPED, price_cte("mapped", "priced"))} SELECT product_id, CAST(scraped_at AS VARCHAR) AS scraped_at, l_orderkey, l_linenumber,
  reference_price_gbp, alcohol_units, price_per_alcohol_unit_gbp, price_tier, discount_amount_gbp, is_discounted, discount_percent, discount_band FROM priced""",
    "bands_all": f"""{SN} SELECT price_tier, discount_band, age_band, bottle_size_band, abv_band, is_age_stated, is_standard_bottle,
  is_comparable_bottle, is_cask_strength, COUNT(*) AS row_count FROM snapshots GROUP BY ALL""",
    "outliers": f"""{with_(*SNAPSHOTS, LIMITS.format("snapshots"))} SELECT product_id, CAST(scraped_at AS VARCHAR) AS scraped_at, l_orderkey, l_linenumber,
  is_price_outlier, is_value_outlier, is_price_outlier OR is_value_outlier AS is_outlier FROM flagged""",
    "outlier_limits": f"""{SN} SELECT category, {report("quantile_cont(price_inc_vat_gbp, 0.99)", 4)} AS price_limit,
  {report("quantile_cont(price_per_alcohol_unit_gbp, 0.99)", 4)} AS value_limit FROM snapshots GROUP BY category""",
    "text_flags": """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS flag FROM part""",
    "decimal_casts": """SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(10,1)) AS DOUBLE) AS one_digit,
  CASE WHEN ROUND(p_retailprice) < 1000 THEN CAST(CAST(p_retailprice AS DECIMAL(38,0)) AS DOUBLE) END AS three_places, p_partkey AS key FROM part""",
    "json_props": "SELECT event_type, COUNT(*) AS row_count, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total_k FROM events GROUP BY event_type",
    "snapshot_partitions": """SELECT strftime(o_orderdate, '%Y-%m') AS scrape_date, o_orderpriority, COUNT(*) AS row_count,
  MAX(o_orderkey) AS last_order FROM orders GROUP BY ALL""",
    "csv_round_trip": f"{T} SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, name, variant, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE unit_price_raw || chr(10) || '\"quoted\", twice' END AS unit_price_raw FROM texts",
}

# -- listings and pages ------------------------------------------------------------------

MONEY = "CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR)"
LISTED = (
    f"""p AS (SELECT *, p_partkey // {PARTS_PER_PAGE} AS page, p_partkey % 7 <> 0 AS has_card FROM part)""",
    """n AS (SELECT *, page % 3 AS layout, ROW_NUMBER() OVER (PARTITION BY page ORDER BY p_partkey) - 1 AS item_no,
  CAST(COUNT(*) FILTER (has_card) OVER (PARTITION BY page ORDER BY p_partkey) AS BIGINT) - 1 AS card_no FROM p)""",
    f"""listed AS (SELECT page, '{SITE}/c/all?pg=' || CAST(page AS VARCHAR) AS page_url, CASE WHEN layout = 2 THEN card_no ELSE item_no END AS position,
  '2026-01-16 09:00:00' AS scraped_at, CASE WHEN layout = 2 THEN '' ELSE 'Single Malt' END AS category,
  CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN layout = 2 THEN p_name || ' & Co' ELSE p_name END AS name,
  CASE WHEN layout = 2 THEN '' ELSE p_brand END AS brand,
  CASE WHEN layout = 0 THEN CAST(p_size * 2 AS VARCHAR) || 'cl / 40%' ELSE '' END AS variant,
  CASE WHEN layout = 0 THEN CAST(p_retailprice AS VARCHAR) ELSE {MONEY} END AS price_ex_vat_gbp,
  CASE WHEN has_card AND layout <> 2 THEN '(£' || CAST(p_size AS VARCHAR) || ' per litre)' ELSE '' END AS unit_price_raw,
  CASE WHEN layout = 0 AND p_partkey % 3 <> 0 THEN 'Islay' ELSE 'N/A' END AS region, '' AS promo_label,
  CASE WHEN NOT has_card THEN 'Current' WHEN p_partkey % 5 = 0 THEN 'Soldout' ELSE 'In Stock' END AS status,
  '{SITE}/p/' || CAST(p_partkey AS VARCHAR) || CASE WHEN layout = 0 AND NOT has_card THEN '' ELSE '/x' END AS product_url,
  CASE WHEN has_card THEN '/img/' || CAST(p_partkey AS VARCHAR) || '.jpg' ELSE '' END AS image_url
FROM n WHERE layout <> 2 OR has_card)""",
)
# Pages of cards alone are shown in a second category as well.
SHOWN = f"""shown AS (SELECT * FROM listed
UNION ALL SELECT * REPLACE ('{SITE}/c/blend?pg=' || CAST(page AS VARCHAR) AS page_url) FROM listed WHERE page % 3 = 2)"""
DETAILED = f"""detailed AS (SELECT '{SITE}/p/' || CAST(p_partkey AS VARCHAR) || '/x' AS product_url,
  CASE WHEN p_partkey % 3 = 0 THEN '4.5' ELSE '' END AS rating_stars, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS review_count,
  CASE p_partkey % 3 WHEN 0 THEN {MONEY} WHEN 1 THEN CAST(p_retailprice AS VARCHAR) ELSE '' END AS price_inc_vat_gbp,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size + 100 AS VARCHAR) || '.50' ELSE '' END AS price_before_discount_gbp,
  CAST(p_size % 11 AS VARCHAR) AS style_body, '' AS style_richness, CAST(p_size % 7 AS VARCHAR) AS style_smoke, '' AS style_sweetness,
  'Oak|' || p_type AS character_notes, p_brand || ' & Sons' AS fact_bottler, '' AS fact_country, '' AS fact_region,
  'Sherry' AS fact_cask_type, '' AS fact_colouring FROM part
UNION ALL SELECT url, '', '', '', '', '', '', '', '', '', '', '', '', '', '' FROM pages)"""
LISTING = {
    "listing_cap": """WITH f AS (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT o_orderpriority AS category, o_custkey AS product_id, o_orderkey AS position FROM f
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) <= 600""",
    "enrich_merge": """WITH d AS (SELECT o_custkey, CAST(COUNT(*) AS VARCHAR) AS review_count, CAST(MAX(o_orderkey) AS VARCHAR) AS rating_stars FROM orders GROUP BY o_custkey)
SELECT c_custkey, COALESCE(rating_stars, '') AS rating_stars, COALESCE(review_count, '') AS review_count
FROM customer LEFT JOIN d ON o_custkey = c_custkey AND c_custkey % 10 <> 0""",
    "detail_urls": "SELECT DISTINCT 'https://shop.example/p/' || CAST(l_partkey AS VARCHAR) || '/' AS product_url FROM lineitem",
    "category_counts": "SELECT p_type AS category, COUNT(*) AS row_count FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type",
    "pages_listing": f"{with_(*LISTED, SHOWN)} SELECT * FROM shown",
    "pages_detail": f"{with_(DETAILED)} SELECT * FROM detailed",
    "collect_records": f"""{with_(*LISTED, SHOWN, DETAILED)}
SELECT {', '.join(f"COALESCE(d.{c}, '') AS {c}" if c in S.DETAIL_COLUMNS else f"c.{c}" for c in S.RAW_COLUMNS)}
FROM shown c LEFT JOIN detailed d ON d.product_url = c.product_url""",
}


STAR["intake_upsert"] = STAR["star_latest"]

# The latest rows as the star's view has them: equal days are settled by the measures, attributes are the dimension's.
_DECIMAL_MEASURES = ", ".join(
    "CAST(newest.review_count AS BIGINT) AS review_count" if c == "review_count"
    else "CAST(newest.{0} AS DECIMAL({1},{2})) AS {0}".format(c, *S.FACT_DECIMALS[c]) if c in S.FACT_DECIMALS else f"newest.{c}"
    for c in S.FACT_MEASURES
)
LV = f"""{with_(*SNAPSHOTS, DIM)}, m AS (SELECT product_id, scraped_at, {columns(S.FACT_MEASURES, FACT_KNOWN, FLAGS, 's')} FROM snapshots s),
newest AS (SELECT * FROM m QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, {', '.join(f'{c} DESC NULLS LAST' for c in S.FACT_MEASURES)}) = 1),
latest AS (SELECT dim.*, {_DECIMAL_MEASURES} FROM dim JOIN newest USING (product_id))"""
STAR |= {f"view_{name}": text.replace(L, LV, 1) for name, text in (("top_ratings", Q5), ("price_premium", Q6), ("age_roi", Q7))}


def oracle_sql() -> dict[str, str]:
    seven = {
        "q1_brand": Q1, "q2_region": Q2, "q3_best_value": Q3, "q4_discounts": Q4,
        "q5_top_ratings": Q5, "q6_price_premium": Q6, "q7_age_roi": Q7,
    }
    return seven | MEASURES | DEDUP | STAR | CLEANING | LISTING | CHAIN
