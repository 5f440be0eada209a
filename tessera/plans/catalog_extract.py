"""Registered extraction queries over ``pages`` (and rendered markup).

Where the driver's pages lack a piece of markup the reference reads
(og:url, JSON-LD, card images, address and price lines, an active
pagination button), the query first renders it from driver columns and
then extracts it; the oracle derives the same values straight from the
source columns, so each such query is a full round trip.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import extract as ex
from tessera.operators import relational as rel
from tessera.operators.index import dense_ids
from tessera.plans import oracle_sql as o
from tessera.plans.catalog import register
from tessera.plans.catalog_listing import GEO, LP, _geo_spark
from tessera.sources.tables import read_table

BATCH = 20


def sql_node_text(x: str, strip: bool = True) -> str:
    out = f"regexp_replace({x}, {o.q(ex.TAG_RE)}, '', 'g')"
    for ent, ch in ex.ENTITIES:
        out = f"replace({out}, {o.q(ent)}, {o.q(ch)})"
    if strip:
        out = f"regexp_replace({out}, {o.q(ex.STRIP_RE)}, '', 'g')"
    return out


def sql_first(html: str, pattern: str) -> str:
    return f"nullif(regexp_extract({html}, {o.q(pattern)}, 1), '')"


def _pages(spark, d):
    return read_table(spark, d, "pages")


# ------------------------------------------------------------- fields

_F = {f.name: f for f in ex.PAGE_FIELDS}


@register("extract_fields", (
    "SELECT page_id, "
    f"{sql_first('html', _F['lang'].pattern)} AS lang, "
    f"{sql_node_text(sql_first('html', _F['title'].pattern), strip=False)} AS title, "
    f"{sql_node_text(sql_first('html', _F['h1'].pattern))} AS h1, "
    f"len(regexp_extract_all(html, {o.q(_F['nav_links'].pattern)}, 1))::BIGINT AS n_links, "
    f"(({sql_first('html', _F['lang'].pattern)} IS NULL)::INT + "
    f"({sql_first('html', _F['title'].pattern)} IS NULL)::INT + "
    f"({sql_first('html', _F['h1'].pattern)} IS NULL)::INT)::BIGINT AS n_errors FROM pages"))
def extract_fields(spark, d):
    """Declarative field spec over every page; errors counted, never raised."""
    out = ex.extract(_pages(spark, d), ex.PAGE_FIELDS)
    return out.select("page_id", "lang", "title", "h1",
                      F.size("nav_links").cast("long").alias("n_links"),
                      F.size("_errors").cast("long").alias("n_errors"))


_PARAS_SQL = ("list_transform(string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')[2:], "
              "lambda p: " + sql_node_text("regexp_replace(p, '(?s)</p>.*$', '')") + ")")


@register("extract_list", (
    f"SELECT page_id, unnest(generate_series(0, len(ps) - 1))::BIGINT AS pos, unnest(ps) AS para "
    f"FROM (SELECT page_id, {_PARAS_SQL} AS ps FROM pages)"))
def extract_list(spark, d):
    """X6f: every article paragraph (stripped text, order and duplicates kept)."""
    p = _pages(spark, d).select("page_id", ex.paragraphs(F.col("html")).alias("ps"))
    return p.select("page_id", F.posexplode("ps").alias("pos", "para")).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "para")


@register("extract_links", (
    "SELECT page_id, unnest(generate_series(0, len(h) - 1))::BIGINT AS pos, "
    "unnest(list_transform(h, lambda x: host || x)) AS link FROM (SELECT page_id, "
    "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS host, "
    "list_filter(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1), lambda x: x <> '') AS h FROM pages)"))
def extract_links(spark, d):
    """Detail links of an index page, host-prefixed, duplicates kept."""
    return ex.links(_pages(spark, d))


@register("url_key", (
    "SELECT page_id, coalesce(nullif(regexp_extract(url, '[^/]+$', 0), ''), 'unknown') AS url_key FROM pages"))
def url_key(spark, d):
    """File key of a URL (last path segment, else 'unknown')."""
    return _pages(spark, d).select("page_id", ex.url_key(F.col("url")).alias("url_key"))


@register("batch_assign", (
    f"SELECT page_id, batch, url_key, (row_number() OVER (PARTITION BY batch, url_key ORDER BY pos DESC) = 1) "
    f"AS kept FROM (SELECT page_id, coalesce(nullif(regexp_extract(url, '[^/]+$', 0), ''), 'unknown') AS url_key, "
    f"(row_number() OVER (ORDER BY url, page_id) - 1) AS pos, "
    f"((row_number() OVER (ORDER BY url, page_id) - 1) // {BATCH} + 1)::BIGINT AS batch FROM pages)"))
def batch_assign(spark, d):
    """X5 + X4: 20 URLs per folder in URL order; per folder the last URL
    with a given key wins (distributed numbering, groups of at most 20)."""
    p = _pages(spark, d).select("page_id", "url", ex.url_key(F.col("url")).alias("url_key"))
    numbered = dense_ids(p.withColumn("_o", F.struct("url", "page_id")), "_o", "pos")
    b = numbered.withColumn("batch", (F.floor(F.col("pos") / BATCH) + 1).cast("long"))
    w = Window.partitionBy("batch", "url_key").orderBy(F.desc("pos"))
    return b.select("page_id", "batch", "url_key", (F.row_number().over(w) == 1).alias("kept"))


@register("extract_meta", "SELECT page_id, url AS website FROM pages")
def extract_meta(spark, d):
    """X6i: og:url, rendered into each page head from its URL, then read back."""
    p = _pages(spark, d)
    url = F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("'"), F.lit("&#39;"))
    html = F.replace(F.col("html"), F.lit("<head>"), F.concat(F.lit("<head><meta content='"), url, F.lit("' property=\"og:url\">")))
    return p.select("page_id", ex.og_url(html).alias("website"))


@register("next_page", (
    "SELECT page_id, coalesce(list_position(h, list_max(h)) < len(h), false) AS has_next FROM "
    "(SELECT page_id, regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1) AS h FROM pages)"))
def next_page(spark, d):
    """X2: 'next page' test on pagination rendered from the nav list (the
    item with the largest href is marked active)."""
    h = F.col("html")
    items = ex.all_of(h, "<li>(.*?)</li>")
    top = F.array_max(ex.all_of(h, '<li><a href="([^"]*)"'))
    marked = F.transform(items, lambda x: F.when(
        F.contains(x, F.concat(F.lit('href="'), top, F.lit('"'))),
        F.regexp_replace(x, "^<a ", '<a class="active" ')).otherwise(x))
    return _pages(spark, d).select("page_id", ex.next_page(marked).alias("has_next"))


# ------------------------------------------- rendered listing markup

@register("extract_jsonld", o.with_(LP + GEO,
          "SELECT restaurantId, g.restaurantName AS name, g.region, g.latitude, g.longitude "
          "FROM (SELECT restaurantId FROM listing_parts UNION ALL SELECT -s_suppkey FROM supplier) l LEFT JOIN geo g USING (restaurantId)"))
def extract_jsonld(spark, d):
    """JSON-LD rendered from geo rows, parsed back; pages without the
    block (here those of suppliers, with negative ids) keep a NULL record."""
    lp = rel.listing_parts(spark, d).select("restaurantId")
    lp = lp.unionByName(read_table(spark, d, "supplier").select((-F.col("s_suppkey")).cast(lp.schema[0].dataType).alias("restaurantId")))
    geo = _geo_spark(spark, d)
    doc = F.to_json(F.struct(F.col("restaurantName").alias("name"),
                             F.struct(F.col("region").alias("addressRegion")).alias("address"),
                             "latitude", "longitude"))
    script = F.when(F.col("latitude").isNotNull(), F.concat(
        F.lit('<script type="application/ld+json">'), doc, F.lit("</script>"))).otherwise(F.lit(""))
    pages = lp.join(geo, "restaurantId", "left").select(
        "restaurantId", F.concat(F.lit("<html><head>"), script, F.lit("</head><body></body></html>")).alias("html"))
    j = ex.jsonld(F.col("html"))
    return pages.select("restaurantId", j["name"].alias("name"), j["address"]["addressRegion"].alias("region"),
                        j["latitude"].alias("latitude"), j["longitude"].alias("longitude"))


@register("extract_codes", o.with_(LP,
          "SELECT restaurantId, array_to_string(list_transform(creditCards, lambda x: lower(x)), ',') AS codes "
          "FROM listing_parts"))
def extract_codes(spark, d):
    """X6g: card codes read back from rendered ``data-src`` image paths."""
    lp = rel.listing_parts(spark, d)
    imgs = F.concat_ws("", F.transform("creditCards", lambda c: F.concat(
        F.lit('<img class="card" data-src="/img/'), F.lower(c), F.lit("-"),
        F.col("restaurantId").cast("string"), F.lit('.svg">'))))
    html = F.concat(F.lit('<div class="list--card">'), imgs, F.lit("</div>"))
    return lp.select("restaurantId", F.concat_ws(",", ex.card_codes(html)).alias("codes"))


def _addr_line():
    return F.concat_ws(", ", "address", "restaurantName", "city", "region", "cuisineType")


@register("split_address", o.with_(LP + [
    f"al AS (SELECT restaurantId, string_split(regexp_replace(concat_ws(', ', address, restaurantName, city, "
    f"region, cuisineType), {o.q(ex.STRIP_RE)}, '', 'g'), ',') AS a FROM listing_parts)"],
    "SELECT restaurantId, a[-3] AS city, a[-2] AS postalCode, a[-1] AS country, "
    f"replace(regexp_replace(array_to_string(a[1:len(a) - 3], ' '), {o.q(ex.STRIP_RE)}, '', 'g'), chr(10), '') "
    "AS address FROM al"))
def split_address(spark, d):
    """Address line rendered from listing columns, split back."""
    lp = rel.listing_parts(spark, d)
    parts = ex.split_address(_addr_line())
    return lp.select("restaurantId", *[v.alias(k) for k, v in parts.items()])


@register("split_price_category", o.with_(LP + [
    "pc AS (SELECT restaurantId, string_split(priceRange || ' · ' || cuisineType, '·') AS a FROM listing_parts)"],
    f"SELECT restaurantId, regexp_replace(a[1], {o.q(ex.STRIP_RE)}, '', 'g') AS priceRange, "
    f"regexp_replace(a[2], {o.q(ex.STRIP_RE)}, '', 'g') AS cuisineType FROM pc"))
def split_price_category(spark, d):
    """X6d: 'price · category' rendered from listing columns, split back."""
    lp = rel.listing_parts(spark, d)
    parts = ex.split_price_category(F.concat_ws(" · ", "priceRange", "cuisineType"))
    return lp.select("restaurantId", *[v.alias(k) for k, v in parts.items()])


@register("extract_listing", o.with_(LP, (
    "SELECT restaurantId, restaurantName || ' & café ’x' || chr(39) AS restaurantName, ' ' || city AS city, ' ' || region AS postalCode, "
    "' ' || cuisineType AS country, address || '  ' || restaurantName AS address, priceRange, cuisineType, "
    "CASE WHEN restaurantId % 7 <> 0 THEN 'About ' || restaurantName || 'and more' END AS description, "
    "array_to_string(facilitiesServices, '|') AS facilitiesServices, lower(array_to_string(creditCards, '|')) AS creditCards, "
    "CASE WHEN restaurantId % 5 <> 0 THEN '+39 ' || restaurantId END AS phoneNumber, website || '?a=1&b=2' AS website, "
    "((restaurantId % 7 = 0)::INT + (restaurantId % 5 = 0)::INT)::BIGINT AS n_errors FROM listing_parts")))
def extract_listing(spark, d):
    """X6, X6a-X6i, X8: the listing record read from pages rendered with the
    template's class names, with entities, missing nodes, rows inside rows and
    elements of a scope's own name in it."""
    def div(cls, *inner):
        return F.concat(F.lit(f'<div class="{cls}">'), *inner, F.lit("</div>"))

    name, rid = F.col("restaurantName"), F.col("restaurantId").cast("string")
    items = F.concat_ws("", F.transform("facilitiesServices", lambda x: F.concat(F.lit("<li> "), x, F.lit("\n</li>"))))
    cards = F.concat_ws("", F.transform("creditCards", lambda c: F.concat(F.lit("<img class='c' data-src='/i/"), F.lower(c), F.lit("-1.svg'>"))))
    address = F.concat_ws(", ", "address", "restaurantName", "city", "region", "cuisineType")
    block = "data-sheet__block"
    sheet = div("data-sheet", div("row", div("row", div("row y", F.lit("inner"))), F.lit('<h1 id="t" class="big data-sheet__title">'), name, F.lit(" &amp; caf&eacute; &#8217;x&#x27;</h1>")),
                div("row x", div(block, div(f"{block}--text", F.lit("\n "), address, F.lit(" "))),
                    div(block, div(f"{block}--text", F.concat_ws(" &middot; ", "priceRange", "cuisineType")))), div("row", F.lit("ignored")))
    about = F.when(F.col("restaurantId") % 7 != 0, div("data-sheet__description", F.lit(" About <div><b>"), name, F.lit("</b><div></div></div>\nand more ")))
    phone = F.when(F.col("restaurantId") % 5 != 0, F.concat(
        F.lit('<section class="section section-main section__text-componets section__text-separator">'),
        div("collapse__block-title", div("d-flex a", F.lit("<span> +39 "), rid, F.lit("</span><span>no</span>"))), F.lit("</section>")))
    head = F.concat(F.lit("<html><head><meta content='"), F.replace(F.concat(F.col("website"), F.lit("?a=1&b=2")), F.lit("&"), F.lit("&amp;")),
                    F.lit("' property='og:url'></head><body>"))
    # A page costs far more time than its listing row has bytes, by which Spark would put the rows into a few tasks.
    listing = rel.listing_parts(spark, d).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    pages = listing.select("restaurantId", F.concat(
        head, div("restaurant-details__components", sheet, F.coalesce(about, F.lit("")), F.coalesce(phone, F.lit(""))),
        div("restaurant-details__services", div("title"), F.lit("<ul>"), items, F.lit("</ul>")), F.lit("<ul><li>no</li></ul>"), div("list--card", cards),
        F.lit("</body></html>")).alias("html"))
    out = ex.listing_record(pages, keep=("restaurantId",))
    return (out.withColumn("facilitiesServices", F.array_join("facilitiesServices", "|")).withColumn("creditCards", F.array_join("creditCards", "|"))
            .withColumn("n_errors", F.size("_errors").cast("long")).drop("_errors"))


@register("card_links", o.with_(LP, "SELECT restaurantId AS page_id, row_number() OVER (PARTITION BY restaurantId ORDER BY i) - 1 AS pos, "
          "'https://parts.example/' || x || '?a&b' AS link FROM (SELECT restaurantId, unnest(creditCards) AS x, "
          "unnest(range(1, len(creditCards) + 1)) AS i FROM listing_parts)"))
def card_links(spark, d):
    """Title links of the cards of rendered index pages, with cards
    without a link between them."""
    lp = rel.listing_parts(spark, d)
    card = F.transform("creditCards", lambda c: F.concat(F.lit('<div class="x card__menu-content y"><h3 class="card__menu-content--title z"><a class="t" '),
                                                         F.lit("href='/"), c, F.lit("?a&amp;b'>t</a></h3></div>")))
    html = F.concat(F.array_join(card, "<div class='card__menu-content'><h3>none</h3></div>"), F.lit("<a href='/no'>n</a>"))
    return ex.card_links(lp.select(F.col("restaurantId").alias("page_id"), F.col("website").alias("url"), html.alias("html")))
