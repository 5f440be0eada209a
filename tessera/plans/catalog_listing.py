"""Registered listing queries: facets, filters, joins, custom and faceted search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import index as ix
from tessera.operators import relational as rel
from tessera.operators import score as sc
from tessera.operators import search as srch
from tessera.plans import oracle_sql as o
from tessera.plans.catalog import DOC_IDX, FIELD_TEXT, SEARCH_TEXT, register
from tessera.plans.catalog import _PART_IDX, _PART_Q, K, _doc_index
from tessera.sources.tables import read_table

# Parameters of the example searches.
CUSTOM = sc.CustomQuery(description=SEARCH_TEXT, cuisineType="src3",
                        facilitiesServices=["quality", "long", "labelled", "quality"],
                        priceRange="€€€", num_results=10)
SIM_TEXTS = {"restaurantName": "Red bolt", "city": " Asia ", "cuisineType": ""}
FACETS = sc.FacetQuery(restaurant_name="small", city="europe", cuisine_type="promo",
                       price_range=("€€", "€€€€"), regions=[f"NATION_{i}" for i in range(0, 25, 2)],
                       credit_cards=["BUILDING"], facilities=["1-URGENT"])
PRICE_RANGE = ("€€", "€€€")
REGIONS = ["NATION_1", "NATION_7", "NATION_12"]
CARDS = ["BUILDING", "MACHINERY"]
FACILITIES = ["1-URGENT"]


def _bands(col: str, cuts) -> str:
    return "repeat('€', 1 + " + " + ".join(f"({col} > {c})::INT" for c in cuts) + ")"


LP = [
    "lp_low AS (SELECT l_partkey AS p_partkey, min(l_suppkey) AS s_suppkey FROM lineitem GROUP BY l_partkey)",
    "lp_place AS (SELECT low.p_partkey, low.s_suppkey, n.n_nationkey, n.n_name, r.r_name FROM lp_low low "
    "JOIN supplier s USING (s_suppkey) JOIN nation n ON s.s_nationkey = n.n_nationkey "
    "JOIN region r ON n.n_regionkey = r.r_regionkey)",
    "lp_pairs AS (SELECT DISTINCT l_partkey, c_mktsegment, o_orderpriority FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)",
    "lp_sets AS (SELECT l_partkey AS p_partkey, list_sort(list_distinct(list(c_mktsegment))) AS creditCards, "
    "list_sort(list_distinct(list(o_orderpriority))) AS facilitiesServices FROM lp_pairs GROUP BY l_partkey)",
    "listing_parts AS (SELECT p.p_partkey AS restaurantId, p.p_name AS restaurantName, pl.r_name AS city, "
    "p.p_brand AS address, pl.n_name AS region, "
    f"{_bands('p.p_retailprice', rel.PART_PRICE_CUTS)} AS priceRange, p.p_type AS cuisineType, "
    "coalesce(st.facilitiesServices, []::VARCHAR[]) AS facilitiesServices, "
    "coalesce(st.creditCards, []::VARCHAR[]) AS creditCards, "
    "'https://parts.example/' || p.p_partkey AS website "
    "FROM part p LEFT JOIN lp_place pl USING (p_partkey) LEFT JOIN lp_sets st USING (p_partkey))",
]

LD = [
    "listing_docs AS (SELECT d.doc_id, 'doc ' || d.doc_id AS restaurantName, d.lang AS address, "
    "d.text AS description, d.source AS cuisineType, "
    f"{_bands('d.n_chars', rel.DOC_LENGTH_CUTS)} AS priceRange, "
    "list_filter([CASE WHEN l.quality = 1 THEN 'quality' END, CASE WHEN l.toxic = 1 THEN 'toxic' END, "
    f"CASE WHEN d.n_chars > {rel.DOC_LENGTH_CUTS[-1]} THEN 'long' END, "
    "CASE WHEN l.quality IS NOT NULL THEN 'labelled' END], lambda x: x IS NOT NULL) AS facilitiesServices, "
    "'https://docs.example/' || d.doc_id AS website FROM documents d LEFT JOIN labels l USING (doc_id))",
]


def _geo_spark(spark, d) -> DataFrame:
    place = rel.part_supplier_place(spark, d)
    part = read_table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return part.join(place, "p_partkey").select(
        F.col("p_partkey").alias("restaurantId"),
        F.col("p_name").alias("restaurantName"),
        rel.translate_region(F.col("n_name")).alias("region"),
        F.round(F.lit(36.0) + F.col("n_nationkey") * 0.35 + F.col("p_size") * 0.001, 6).alias("latitude"),
        F.round(F.lit(7.0) + F.col("n_nationkey") * 0.2 + (F.col("p_retailprice") - 900) * 0.001, 6)
        .alias("longitude"))


def _geo_all(spark, d) -> DataFrame:
    """The geo table of parts and suppliers; suppliers (ids from
    SUPPLIER_IDS on) have no listing, so a right join leaves them alone."""
    geo = _geo_spark(spark, d)
    sup = read_table(spark, d, "supplier").select(
        (F.col("s_suppkey") + SUPPLIER_IDS).cast(geo.schema["restaurantId"].dataType).alias("restaurantId"),
        F.col("s_name").alias("restaurantName"), F.lit(None).cast("string").alias("region"),
        F.round(F.lit(36.0) + F.col("s_nationkey") * 0.35, 6).alias("latitude"),
        F.round(F.lit(7.0) + F.col("s_nationkey") * 0.2, 6).alias("longitude"))
    return geo.unionByName(sup)


SUPPLIER_IDS = 1_000_000_000_000


def _region_case(col: str) -> str:
    whens = " ".join(f"WHEN {o.q(a)} THEN {o.q(b)}" for a, b in rel.REGION_NAMES)
    return f"CASE {col} {whens} ELSE {col} END"


GEO = [
    "geo AS (SELECT p.p_partkey AS restaurantId, p.p_name AS restaurantName, "
    f"{_region_case('pl.n_name')} AS region, "
    "round((36.0 + pl.n_nationkey * 0.35 + p.p_size * 0.001)::DOUBLE, 6) AS latitude, "
    "round((7.0 + pl.n_nationkey * 0.2 + (p.p_retailprice - 900) * 0.001)::DOUBLE, 6) AS longitude "
    "FROM part p JOIN lp_place pl USING (p_partkey))",
]


GEO_ALL = [
    f"geo_all AS (SELECT * FROM geo UNION ALL SELECT s_suppkey + {SUPPLIER_IDS}, s_name, NULL, "
    "round((36.0 + s_nationkey * 0.35)::DOUBLE, 6), round((7.0 + s_nationkey * 0.2)::DOUBLE, 6) FROM supplier)",
]


def _arrays_as_text(df: DataFrame, cols=("facilitiesServices", "creditCards")) -> DataFrame:
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, F.concat_ws(",", c))
    return df


def _sql_arrays_as_text(cols=("facilitiesServices", "creditCards")) -> str:
    return ", ".join(f"array_to_string({c}, ',') AS {c}" for c in cols)


@register("listing_parts", o.with_(LP, f"SELECT * REPLACE ({_sql_arrays_as_text()}) FROM listing_parts"))
def listing_parts(spark, d):
    """The listing view over part x lineitem x orders x customer x supplier."""
    return _arrays_as_text(rel.listing_parts(spark, d))


@register("listing_docs", o.with_(LD,
          "SELECT * EXCLUDE (description) REPLACE (array_to_string(facilitiesServices, ',') "
          "AS facilitiesServices) FROM listing_docs"))
def listing_docs(spark, d):
    """The listing view over documents x labels (description omitted)."""
    return _arrays_as_text(rel.listing_docs(spark, d)).drop("description")


@register("filter_price_between", o.with_(LP,
          f"SELECT restaurantId, priceRange FROM listing_parts WHERE priceRange BETWEEN "
          f"{o.q(PRICE_RANGE[0])} AND {o.q(PRICE_RANGE[1])}"))
def filter_price_between(spark, d):
    """Q11: inclusive price-band range (string order)."""
    lp = rel.listing_parts(spark, d)
    return rel.filter_price_between(lp, *PRICE_RANGE).select("restaurantId", "priceRange")


@register("filter_region_in", o.with_(LP,
          "SELECT restaurantId, region FROM listing_parts WHERE region IN ("
          + ", ".join(o.q(r) for r in REGIONS) + ")"))
def filter_region_in(spark, d):
    """Q12: region membership."""
    return rel.filter_in(rel.listing_parts(spark, d), "region", REGIONS).select("restaurantId", "region")


@register("filter_contains_all", o.with_(LP,
          "SELECT restaurantId FROM listing_parts WHERE list_has_all(creditCards, ["
          + ", ".join(o.q(c) for c in CARDS) + "]) AND list_has_all(facilitiesServices, ["
          + ", ".join(o.q(c) for c in FACILITIES) + "])"))
def filter_contains_all(spark, d):
    """Q13 + Q14: holds all selected cards and all selected facilities."""
    lp = rel.listing_parts(spark, d)
    lp = rel.filter_contains_all(lp, "creditCards", CARDS)
    return rel.filter_contains_all(lp, "facilitiesServices", FACILITIES).select("restaurantId")


@register("facet_values", o.with_(LP,
          "SELECT DISTINCT 'creditCards' AS facet, unnest(creditCards) AS value FROM listing_parts "
          "UNION SELECT DISTINCT 'facilitiesServices', unnest(facilitiesServices) FROM listing_parts"))
def facet_values(spark, d):
    """A1: distinct values of the two list columns."""
    return rel.facet_values(rel.listing_parts(spark, d),
                            {"creditCards": "creditCards", "facilitiesServices": "facilitiesServices"})


@register("distinct_sorted", o.with_(LP, "SELECT DISTINCT priceRange FROM listing_parts"))
def distinct_sorted(spark, d):
    """A2: distinct price bands, sorted."""
    return rel.distinct_sorted(rel.listing_parts(spark, d), "priceRange")


@register("distinct_nonnull", o.with_(LP,
          "SELECT DISTINCT region FROM listing_parts WHERE region IS NOT NULL"))
def distinct_nonnull(spark, d):
    """A3: distinct regions without NULL, sorted."""
    return rel.distinct_nonnull(rel.listing_parts(spark, d), "region")


@register("translate_region", o.with_(LP + GEO,
          f"SELECT restaurantId, region_en, {_region_case('region_en')} AS region_it FROM (SELECT restaurantId, "
          f"CASE regexp_extract(region, '[0-9]+$') {' '.join(f'WHEN {o.q(str(k))} THEN {o.q(a)}' for k, (a, _) in enumerate(rel.REGION_NAMES))} "
          "ELSE region END AS region_en FROM listing_parts)"))
def translate_region(spark, d):
    """Fixed region-name translation, others unchanged (nations 0 to 7 stand for the eight regions)."""
    number = F.regexp_extract("region", "[0-9]+$", 0)
    named = F.create_map(*[F.lit(x) for k, (a, _) in enumerate(rel.REGION_NAMES) for x in (str(k), a)])
    lp = rel.listing_parts(spark, d).select("restaurantId", F.coalesce(F.try_element_at(named, number), "region").alias("region_en"))
    return lp.withColumn("region_it", rel.translate_region(F.col("region_en")))


_RJ_SQL = ("SELECT g.restaurantId, l.city, l.address, l.priceRange, l.cuisineType, l.website, "
           "l.restaurantName, g.region, g.latitude, g.longitude FROM "
           "listing_parts l RIGHT JOIN geo_all g USING (restaurantId)")


def _right_join(spark, d):
    lp = rel.listing_parts(spark, d).select(
        "restaurantId", "city", "address", "priceRange", "cuisineType", "website", "restaurantName")
    return rel.right_join(lp, _geo_all(spark, d), "restaurantId")


@register("right_join_geo", o.with_(LP + GEO + GEO_ALL, _RJ_SQL))
def right_join_geo(spark, d):
    """Right join of the listing with all geo rows (some without a listing)."""
    return _right_join(spark, d)


@register("fill_empty", o.with_(LP + GEO + GEO_ALL,
          "SELECT restaurantId, coalesce(city, '') AS city, coalesce(address, '') AS address, "
          "coalesce(priceRange, '') AS priceRange, coalesce(cuisineType, '') AS cuisineType, "
          "coalesce(website, '') AS website, coalesce(restaurantName, '') AS restaurantName, "
          "coalesce(region, '') AS region, latitude, longitude FROM (" + _RJ_SQL + ")"))
def fill_empty(spark, d):
    """NULL strings to '' after the right join."""
    return _right_join(spark, d).na.fill("")


@register("rank_key_join", o.with_(LP + GEO + [
    "la AS (SELECT row_number() OVER (ORDER BY restaurantName, restaurantId)::BIGINT AS rank_key, "
    "restaurantId, restaurantName FROM listing_parts)",
    "gb AS (SELECT row_number() OVER (ORDER BY restaurantName, restaurantId)::BIGINT AS rank_key, "
    "restaurantId AS geo_id, restaurantName AS geo_name, latitude, longitude FROM geo)"],
    "SELECT * FROM la JOIN gb USING (rank_key)"))
def rank_key_join(spark, d):
    """Pair rows by position after sorting both sides by name."""
    la = rel.rank_key(rel.listing_parts(spark, d).select("restaurantId", "restaurantName"),
                      ["restaurantName", "restaurantId"])
    gb = rel.rank_key(_geo_spark(spark, d).select(
        F.col("restaurantId").alias("geo_id"), F.col("restaurantName").alias("geo_name"),
        "latitude", "longitude"), ["geo_name", "geo_id"])
    return la.join(gb, "rank_key")


_TOPK_FIELD = o.top_k_sql("sc", K, "qid", "p_partkey")


@register("semi_join_topk", o.with_(LP + _PART_IDX + _PART_Q + o.cosine_ctes("sc", "px", "fq", "qid", "p_partkey") + [
    f"tk AS (SELECT p.p_name FROM ({_TOPK_FIELD}) t JOIN part p USING (p_partkey))"],
    "SELECT restaurantId, restaurantName FROM listing_parts WHERE restaurantName IN (SELECT p_name FROM tk)"))
def semi_join_topk(spark, d):
    """Listing rows whose name is among the names of a saved top-k."""
    part = read_table(spark, d, "part")
    idx = ix.build_index(part, "p_partkey", "p_name")
    top = srch.ranked_search(*srch.literal(idx, FIELD_TEXT), k=K)
    names = top.join(part.select("p_partkey", "p_name"), "p_partkey").select(
        F.col("p_name").alias("restaurantName"))
    lp = rel.listing_parts(spark, d)
    return lp.join(names, "restaurantName", "left_semi").select(
        "restaurantId", "restaurantName")


@register("head", o.with_(LP,
          "SELECT restaurantId, restaurantName, city, priceRange FROM listing_parts "
          "ORDER BY restaurantName, restaurantId LIMIT 5"))
def head(spark, d):
    """First five rows in name order."""
    return (rel.listing_parts(spark, d).select("restaurantId", "restaurantName", "city", "priceRange")
            .orderBy("restaurantName", "restaurantId").limit(5))


def _sql_hover(n, c, a, t) -> str:
    return (f"'<b>Name:</b> ' || coalesce({n}, '') || '<br>' || '<b>City:</b> ' || coalesce({c}, '') || "
            f"'<br>' || '<b>Address:</b> ' || coalesce({a}, '') || '<br>' || "
            f"'<b>Types of cuisine: </b> ' || coalesce({t}, '') || '<br>'")


@register("hover_text", o.with_(LP,
          "SELECT restaurantId, " + _sql_hover("restaurantName", "city", "address", "cuisineType")
          + " AS hover FROM listing_parts"))
def hover_text(spark, d):
    """P5: per-row hover HTML."""
    lp = rel.listing_parts(spark, d)
    return lp.select("restaurantId", rel.hover_text(F.col("restaurantName"), F.col("city"),
                                                    F.col("address"), F.col("cuisineType")).alias("hover"))


@register("parse_list_literal", o.with_(LP,
          "SELECT restaurantId, '[' || array_to_string(list_transform(creditCards, lambda x: '''' || x || ''''), ', ') "
          "|| ']' AS literal, len(creditCards)::BIGINT AS n_items, array_to_string(creditCards, ',') AS parsed "
          "FROM listing_parts"))
def parse_list_literal(spark, d):
    """List column -> Python-style literal -> parsed back (no eval)."""
    lp = rel.listing_parts(spark, d).select("restaurantId", rel.list_literal(F.col("creditCards")).alias("literal"))
    parsed = rel.parse_list_literal(F.col("literal"))
    return lp.select("restaurantId", "literal", F.size(parsed).cast("long").alias("n_items"),
                     F.concat_ws(",", parsed).alias("parsed"))


# ------------------------------------------------------------ custom score

_CUSTOM_Q = o.query_ctes("cq", "dx", o.literal_query_sql(CUSTOM.description))
_CONJ = ("cm AS (SELECT p.doc_id FROM dx_tf p JOIN cq_all a USING (term) GROUP BY p.doc_id "
         "HAVING count(*) = (SELECT count(*) FROM cq_all))")
_DESC = [
    "cqlen AS (SELECT count(*) AS n FROM cq_tok)",
    "cqv AS (SELECT term, count(*) / (SELECT n FROM cqlen) * i.idf AS qw FROM cq_tok "
    "JOIN dx_idf i USING (term) GROUP BY term, i.idf)",
    "craw AS (SELECT doc_id, list_filter(regexp_split_to_array(description, '" + tx.BLANK + "+'), lambda t: t <> '') "
    "AS toks FROM listing_docs WHERE doc_id IN (SELECT doc_id FROM cm))",
    "ctok AS (SELECT doc_id, len(toks) AS dlen, unnest(toks) AS term FROM craw)",
    "cdv AS (SELECT doc_id, term, count(*) / any_value(dlen) * i.idf AS dw FROM ctok "
    "JOIN dx_idf i USING (term) GROUP BY doc_id, term, i.idf)",
    "cdn AS (SELECT doc_id, sqrt(sum(dw * dw)) AS dn FROM cdv GROUP BY doc_id)",
    "cdot AS (SELECT doc_id, sum(dw * qw) AS dot FROM cdv JOIN cqv USING (term) GROUP BY doc_id)",
    "cdesc AS (SELECT m.doc_id, coalesce(CASE WHEN n.dn * (SELECT sqrt(sum(qw * qw)) FROM cqv) = 0 THEN NULL "
    "ELSE t.dot / (n.dn * (SELECT sqrt(sum(qw * qw)) FROM cqv)) END, 0.0) AS desc_score "
    "FROM cm m LEFT JOIN cdot t USING (doc_id) LEFT JOIN cdn n USING (doc_id))",
]


def _sql_fac_fraction(col: str, wishes) -> str:
    if not wishes:
        return "0.0"
    arr = "[" + ", ".join(o.q(w) for w in wishes) + "]"
    return f"len(list_filter({arr}, lambda w: list_contains({col}, w))) / {float(len(wishes))}"


_W = sc.CUSTOM_WEIGHTS
_SCORED = (
    "SELECT l.doc_id, l.restaurantName, l.address, l.description, l.website, "
    f"c.desc_score * {_W['description']} + "
    f"(CASE WHEN l.cuisineType = {o.q(CUSTOM.cuisineType)} THEN 1.0 ELSE 0.0 END) * {_W['cuisine']} + "
    f"({_sql_fac_fraction('l.facilitiesServices', CUSTOM.facilitiesServices)}) * {_W['facilities']} + "
    f"(CASE WHEN l.priceRange = {o.q(CUSTOM.priceRange)} THEN 1.0 ELSE 0.0 END) * {_W['price']} "
    "AS customScore FROM listing_docs l JOIN cdesc c USING (doc_id)")


@register("custom_score", o.with_(DOC_IDX + LD + _CUSTOM_Q + [_CONJ] + _DESC,
          f"SELECT * REPLACE (round(customScore, 6) AS customScore) FROM ({_SCORED}) "
          f"ORDER BY round(customScore, 12) DESC, doc_id LIMIT {CUSTOM.result_size()}"))
def custom_score(spark, d):
    """Q8: weighted custom score of the all-terms matches, top n."""
    lst = rel.listing_docs(spark, d)
    res = sc.custom_score(lst, _doc_index(spark, d), CUSTOM)
    return res.select("doc_id", "restaurantName", "address", "description", "website", F.round("customScore", 6).alias("customScore"))


@register("custom_description_score", o.with_(DOC_IDX + LD + _CUSTOM_Q + [_CONJ] + _DESC,
          "SELECT doc_id, round(desc_score, 6) AS desc_score FROM cdesc"))
def custom_description_score(spark, d):
    """Description cosine (raw whitespace tokens vs analysed vocabulary)."""
    lst = rel.listing_docs(spark, d)
    idx = _doc_index(spark, d)
    query = srch.query_table(spark, CUSTOM.description)
    matches = srch.conjunctive_search(idx, query).select("doc_id")
    return sc.description_scores(lst, idx, matches, query).select(
        "doc_id", F.round("desc_score", 6).alias("desc_score"))


@register("facility_match", o.with_(LD,
          f"SELECT doc_id, round({_sql_fac_fraction('facilitiesServices', CUSTOM.facilitiesServices)}, 6) "
          "AS facility_score FROM listing_docs"))
def facility_match(spark, d):
    """Q8d: fraction of wished facilities present (duplicate wishes count)."""
    lst = rel.listing_docs(spark, d)
    return lst.select("doc_id", F.round(sc.facility_fraction(
        F.col("facilitiesServices"), CUSTOM.facilitiesServices), 6).alias("facility_score"))


# ------------------------------------------------ multi-field and faceted

def _sql_similarity(texts: dict) -> list[str]:
    norm = {f: (texts.get(f) or "").strip().lower() for f in sc.FIELDS}
    active = [f for f in sc.FIELDS if norm[f]]
    wts = sc.field_weights(active)
    ctes = []
    unions = []
    for i, f in enumerate(active):
        p = f"f{i}"
        ctes += o.index_ctes(p, f"SELECT restaurantId, {f} FROM listing_parts", "restaurantId", f)
        ctes += o.query_ctes(f"{p}q", p, o.literal_query_sql(norm[f]))
        ctes += o.cosine_ctes(f"{p}s", p, f"{p}q", "qid", "restaurantId")
        unions.append(f"SELECT restaurantId, score * {wts.get(f, 0.0)} AS ws FROM {p}s")
    if unions:
        ctes.append("simu AS (" + " UNION ALL ".join(unions) + ")")
        ctes.append("sim AS (SELECT l.restaurantId, coalesce(s.s, 0.0) AS similarity_score "
                    "FROM listing_parts l LEFT JOIN (SELECT restaurantId, sum(ws) / "
                    f"{float(len(active))} AS s FROM simu GROUP BY restaurantId) s USING (restaurantId))")
    else:
        ctes.append("sim AS (SELECT restaurantId, 0.0 AS similarity_score FROM listing_parts)")
    return ctes


@register("weighted_similarity", o.with_(LP + _sql_similarity(SIM_TEXTS),
          "SELECT restaurantId, round(similarity_score, 6) AS similarity_score FROM sim"))
def weighted_similarity(spark, d):
    """Q9: weighted multi-field cosine over the listing (every row)."""
    return sc.weighted_similarity(rel.listing_parts(spark, d), SIM_TEXTS).withColumn(
        "similarity_score", F.round("similarity_score", 6))


def _sql_faceted(q: sc.FacetQuery) -> str:
    texts = {"restaurantName": q.restaurant_name, "city": q.city, "cuisineType": q.cuisine_type}
    conds = []
    if any((v or "").strip() for v in texts.values()):
        conds.append("s.similarity_score > 0")
    if q.price_range:
        conds.append(f"l.priceRange BETWEEN {o.q(q.price_range[0])} AND {o.q(q.price_range[1])}")
    if q.regions:
        conds.append("l.region IN (" + ", ".join(o.q(r) for r in q.regions) + ")")
    if q.credit_cards:
        conds.append("list_has_all(l.creditCards, [" + ", ".join(o.q(c) for c in q.credit_cards) + "])")
    if q.facilities:
        conds.append("list_has_all(l.facilitiesServices, [" + ", ".join(o.q(c) for c in q.facilities) + "])")
    where = (" WHERE " + " AND ".join(conds)) if conds else ""
    return o.with_(LP + _sql_similarity(texts),
                   "SELECT l.restaurantId, l.restaurantName, l.address, l.cuisineType, l.priceRange, l.website, "
                   "round(s.similarity_score, 6) AS similarity_score, row_number() OVER (ORDER BY round(s.similarity_score, 12) DESC, "
                   "l.restaurantId) AS rank FROM listing_parts l JOIN sim s USING (restaurantId)" + where)


@register("faceted_search", _sql_faceted(FACETS))
def faceted_search(spark, d):
    """Q10: similarity + price range + regions + cards + facilities, best first."""
    return sc.faceted_search(rel.listing_parts(spark, d), FACETS).withColumn(
        "similarity_score", F.round("similarity_score", 6))
