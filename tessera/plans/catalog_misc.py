"""Registered queries: ordered paths, map tables, file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import geo as g
from tessera.operators import index as ix
from tessera.operators import relational as rel
from tessera.operators import score as sc
from tessera.operators import paths as pth
from tessera.operators import search as srch
from tessera.plans import oracle_sql as o
from tessera.plans.catalog import ORACLE, FIELD_TEXT, K, SEARCH_TEXT, _doc_index, _docs, register
from tessera.plans.catalog_extract import batch_assign
from tessera.plans.catalog_listing import CUSTOM, GEO, GEO_ALL, LD, LP, _geo_spark, _right_join, _arrays_as_text
from tessera.sources import files
from tessera.sources.tables import read_table

MARKER_REGION = "NATION_7"
SCORE_REGION = "NATION_2"
PAGE_RANGE = (2, 9)
CHUNK = 16  # an order's path has some 50 moves
PART = 100  # vertices of a feature: an outline is many features


def _points(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").cast("long").alias("x"),
                     F.col("l_quantity").cast("long").alias("y"))


_PTS = ("pts AS (SELECT l_orderkey AS case_id, l_linenumber::BIGINT AS x, trunc(l_quantity)::BIGINT AS y "
        "FROM lineitem)")
_STEPS = ("st AS (SELECT *, x - coalesce(lag(x) OVER w, 0) AS dx, y - coalesce(lag(y) OVER w, 0) AS dy "
          "FROM {src} WINDOW w AS (PARTITION BY case_id ORDER BY x, y))")


@register("monotone_path", o.with_([_PTS, "dp AS (SELECT DISTINCT * FROM pts)", _STEPS.format(src="dp"),
                                    "feas AS (SELECT case_id, min(least(dx, dy)) >= 0 AS ok FROM st GROUP BY case_id)",
                                    "paths AS (SELECT case_id, string_agg(repeat('R', dx::INT) || repeat('U', dy::INT), "
                                    "'' ORDER BY x, y) AS path FROM st GROUP BY case_id)"],
          "SELECT case_id, CASE WHEN ok THEN 'YES' ELSE 'NO' END AS possible, CASE WHEN ok THEN coalesce(path, '') END "
          "AS path FROM feas JOIN paths USING (case_id)"))
def monotone_path(spark, d):
    """K1: per order, can a right/up walk from (0,0) visit all (line, qty)
    points, and the lexicographically smallest such walk."""
    return pth.monotone_path(_points(spark, d))


@register("path_moves", o.with_([_PTS, "dp AS (SELECT DISTINCT * FROM pts)", _STEPS.format(src="dp")],
          "SELECT case_id, x, y, dx AS rights, dy AS ups FROM st WHERE case_id IN "
          "(SELECT case_id FROM st GROUP BY case_id HAVING min(least(dx, dy)) >= 0)"))
def path_moves(spark, d):
    """K1 in long form: the moves to each point of the orders that have a path."""
    return pth.path_moves(_points(spark, d))


@register("path_chunks", f"SELECT case_id, chunk, substr(path, chunk * {CHUNK} + 1, {CHUNK}) AS path FROM ("
          f"SELECT case_id, path, unnest(range(0, (length(path) + {CHUNK} - 1) // {CHUNK})) AS chunk FROM ({ORACLE['monotone_path']}) WHERE path <> '')")
def path_chunks(spark, d):
    """K1 as text in pieces: paths of orders, CHUNK moves a row."""
    return pth.path_chunks(_points(spark, d), size=CHUNK)


@register("tour_length", o.with_([_PTS, _STEPS.format(src="pts")],
          "SELECT case_id, sum(abs(dx) + abs(dy))::BIGINT AS steps FROM st GROUP BY case_id"))
def tour_length(spark, d):
    """K2: Manhattan length of the (x, y)-ordered walk per order."""
    return pth.tour_length(_points(spark, d))


@register("polygon_centroid", o.with_(LP + GEO + [
    "gp AS (SELECT DISTINCT region, longitude AS lon, latitude AS lat FROM geo)",
    "gm AS (SELECT region, avg(lon) AS mx, avg(lat) AS my FROM gp GROUP BY region)",
    "ring AS (SELECT p.region, atan2(lat - my, lon - mx) AS a, pow(lat - my, 2) + pow(lon - mx, 2) AS d, "
    "lon AS x, lat AS y FROM gp p JOIN gm USING (region))",
    "edges AS (SELECT region, x, y, coalesce(lag(x) OVER w, last_value(x) OVER wa) AS px, "
    "coalesce(lag(y) OVER w, last_value(y) OVER wa) AS py FROM ring "
    "WINDOW w AS (PARTITION BY region ORDER BY a, d, x, y), "
    "wa AS (PARTITION BY region ORDER BY a, d, x, y ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))",
    "sums AS (SELECT region, sum(px * y - x * py) AS a2, sum((px + x) * (px * y - x * py)) AS cx6, "
    "sum((py + y) * (px * y - x * py)) AS cy6 FROM edges GROUP BY region)"],
    "SELECT region, round(CASE WHEN a2 = 0 THEN NULL ELSE cx6 / (a2 * 3) END, 6) AS lon, "
    "round(CASE WHEN a2 = 0 THEN NULL ELSE cy6 / (a2 * 3) END, 6) AS lat, round(abs(a2) / 2, 6) AS area FROM sums"))
def polygon_centroid(spark, d):
    """Area centroid of each region's polygon (a star-shaped ring over
    the region's restaurant points)."""
    geo = _geo_spark(spark, d).select("region", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    return g.polygon_centroid(g.star_ring(geo), order_cols=g.STAR_ORDER)


_TOPK_FIELD = o.top_k_sql("sc", K, "qid", "p_partkey")


def _sql_markers() -> str:
    from tessera.plans.catalog import _PART_IDX, _PART_Q
    from tessera.plans.catalog_listing import _sql_hover
    bands = ", ".join(o.q(b) for b, _ in rel.PRICE_COLOURS)
    colour = "CASE priceRange " + " ".join(f"WHEN {o.q(b)} THEN {o.q(c)}" for b, c in rel.PRICE_COLOURS) + " END"
    rj = ("SELECT g.restaurantId, l.city, l.address, l.priceRange, l.cuisineType, l.restaurantName, g.region, "
          "g.latitude, g.longitude FROM listing_parts l RIGHT JOIN geo_all g USING (restaurantId)")
    return o.with_(LP + GEO + GEO_ALL + _PART_IDX + _PART_Q + o.cosine_ctes("sc", "px", "fq", "qid", "p_partkey") + [
        f"tk AS (SELECT DISTINCT p.p_name AS restaurantName FROM ({_TOPK_FIELD}) t JOIN part p USING (p_partkey))",
        f"lg AS (SELECT * FROM ({rj}) WHERE restaurantName IN (SELECT restaurantName FROM tk))",
        f"mk AS (SELECT 'national' AS scope, * FROM lg UNION ALL "
        f"SELECT 'regional', * FROM lg WHERE region = {o.q(MARKER_REGION)})"],
        f"SELECT scope, priceRange, {colour} AS colour, restaurantId, latitude, longitude, restaurantName, "
        f"{_sql_hover('restaurantName', 'city', 'address', 'cuisineType')} AS hover FROM mk "
        f"WHERE priceRange IN ({bands})")


@register("region_markers", _sql_markers())
def region_markers(spark, d):
    """National and regional marker tables of the
    saved top-k (written to storage and read back, as the map step does)."""
    part = read_table(spark, d, "part")
    idx = ix.build_index(part, "p_partkey", "p_name")
    top = srch.ranked_search(*srch.literal(idx, FIELD_TEXT), k=K)
    names = top.join(part.select("p_partkey", "p_name"), "p_partkey").select(
        F.col("p_name").alias("restaurantName"))
    path = files.scratch_path(spark, "top_k_result")
    files.save_result(names, path)
    return g.region_markers(_right_join(spark, d), MARKER_REGION, topk_names=files.read_result(spark, path))


def _sql_score_markers() -> str:
    from tessera.plans.catalog_listing import _sql_hover
    colour = "CASE priceRange " + " ".join(f"WHEN {o.q(b)} THEN {o.q(c)}" for b, c in rel.PRICE_COLOURS) + " END"
    return o.with_(LP + GEO + LD + [
        f"sv AS (SELECT l.*, s.customScore FROM ({ORACLE['custom_score']}) s JOIN listing_docs l USING (doc_id))",
        "lg AS (SELECT s.*, g.region, g.region AS city, g.latitude, g.longitude FROM sv s JOIN geo g ON g.restaurantId = s.doc_id)",
        f"mk AS (SELECT 'national' AS scope, * FROM lg UNION ALL SELECT 'regional', * FROM lg WHERE region = {o.q(SCORE_REGION)})"],
        f"SELECT scope, priceRange, {colour} AS colour, doc_id, latitude, longitude, restaurantName, "
        f"{_sql_hover('restaurantName', 'city', 'address', 'cuisineType')} AS hover, customScore FROM mk "
        f"WHERE priceRange IN ({', '.join(o.q(b) for b, _ in rel.PRICE_COLOURS)})")


@register("saved_score_markers", _sql_score_markers())
def saved_score_markers(spark, d):
    """A custom score's whole rows saved, and its markers with their
    scores from the newest version (documents placed by the part of their number)."""
    path = files.scratch_path(spark, "custom_score_result")
    files.save_result(sc.custom_score(rel.listing_docs(spark, d), _doc_index(spark, d), CUSTOM), path)
    saved = files.read_result(spark, path)
    places = _geo_spark(spark, d).select(F.col("restaurantId").alias("doc_id"), "region", F.col("region").alias("city"), "latitude", "longitude")
    marks = g.region_markers(saved.join(places, "doc_id"), SCORE_REGION, topk_names=saved.select("restaurantName"), id_col="doc_id")
    return marks.join(saved.select("doc_id", F.round("customScore", 6).alias("customScore")), "doc_id")


# ---------------------------------------------------------- round trips

def _landed(spark, d):
    b = batch_assign(spark, d).where("kept")
    pages = read_table(spark, d, "pages").select("page_id", "html")
    path = files.scratch_path(spark, "landed")
    files.land_pages(b.join(pages, "page_id"), path)
    return path


_BATCH_SQL = ORACLE["batch_assign"]


@register("scan_pages", f"SELECT b.batch AS page, b.url_key AS key, p.html FROM ({_BATCH_SQL}) b "
                        f"JOIN pages p USING (page_id) WHERE b.kept")
def scan_pages(spark, d):
    """S1 (+X5 landing): every landed page file, one row per file."""
    return files.scan_pages(spark, _landed(spark, d))


@register("scan_page_range", f"SELECT b.batch AS page, b.url_key AS key, p.html FROM ({_BATCH_SQL}) b "
                             f"JOIN pages p USING (page_id) WHERE b.kept AND b.batch BETWEEN "
                             f"{PAGE_RANGE[0]} AND {PAGE_RANGE[1]}")
def scan_page_range(spark, d):
    """Only batch folders 2..9 (partition filter at the scan)."""
    return files.scan_pages(spark, _landed(spark, d), *PAGE_RANGE)


@register("tsv_roundtrip", o.with_(LP, "SELECT * REPLACE (array_to_string(facilitiesServices, ',') AS "
                                       "facilitiesServices, array_to_string(creditCards, ',') AS creditCards) "
                                       "FROM listing_parts"))
def tsv_roundtrip(spark, d):
    """Listing to TSV (lists as JSON text) and back with a schema."""
    lp = rel.listing_parts(spark, d)
    path = files.scratch_path(spark, "listing_tsv")
    files.write_tsv(lp, path)
    return _arrays_as_text(files.read_tsv(spark, path, lp.schema))


@register("url_list_roundtrip", "SELECT url FROM pages")
def url_list_roundtrip(spark, d):
    """URL list written one per line and read back stripped."""
    path = files.scratch_path(spark, "urls")
    files.write_url_list(read_table(spark, d, "pages"), path)
    return files.read_url_list(spark, path)


@register("index_roundtrip", ORACLE["ranked_search_batch"])
def index_roundtrip(spark, d):
    """The index saved, loaded and searched: batch ranked search that
    reads nothing but the files."""
    idx = ix.build_index(_docs(spark, d), "doc_id", "text")
    path = files.scratch_path(spark, "index")
    ix.save_index(idx, path)
    loaded = ix.load_index(spark, path)
    queries = read_table(spark, d, "benchmark").select("item_id", "text")
    return srch.ranked_search(loaded, queries, k=K, qid="item_id").select(
        "item_id", "doc_id", "rank", F.round("score", 6).alias("score"))


@register("saved_index_search", ORACLE["ranked_search"])
def saved_index_search(spark, d):
    """S7 + Q6: one query over a loaded index; its terms reach the scan."""
    path = files.scratch_path(spark, "index")
    ix.save_index(ix.build_index(_docs(spark, d), "doc_id", "text"), path)
    return saved_search(spark, d, path)


def saved_search(spark, d, path: str):
    """The search half of :func:`saved_index_search`."""
    res = srch.ranked_search(*srch.literal(ix.load_index(spark, path), SEARCH_TEXT), k=K)
    docs = _docs(spark, d).select("doc_id", "lang", "source")
    return docs.join(res, "doc_id").select("doc_id", "rank", F.round("score", 6).alias("score"), "lang", "source")


@register("saved_vocabulary", ORACLE["vocabulary"])
def saved_vocabulary(spark, d):
    """The vocabulary of a saved index, exported as CSV and read back."""
    path = files.scratch_path(spark, "index")
    ix.save_index(ix.build_index(_docs(spark, d), "doc_id", "text"), path)
    ix.save_vocabulary(spark, path, f"{path}/vocabulary.csv")
    return spark.read.schema("term string, term_id long").option("header", True).option("escape", '"').csv(f"{path}/vocabulary.csv")


@register("geojson_centroid", ORACLE["polygon_centroid"])
def geojson_centroid(spark, d):
    """Region rings written as GeoJSON features of bounded length,
    read back with an explicit schema, exploded to vertices, centroids computed."""
    geo = _geo_spark(spark, d).select("region", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    path = files.scratch_path(spark, "regions-geojson")
    files.write_geojson_parts(g.star_ring(geo), path, order_cols=g.STAR_ORDER, size=PART)
    verts = files.read_geojson(spark, path).withColumnRenamed("reg_name", "region")
    return g.polygon_centroid(verts, order_cols=("i",))


_SIDE = "(p_size + 4)::DOUBLE"
_MULTI_AREA = f"({_SIDE} * {_SIDE} - 2 + 4)"


@register("multipolygon_centroid", (
    f"SELECT p_partkey AS region, round(p_partkey + ({_SIDE} * {_SIDE} * {_SIDE} / 2 - 2 * 1.5 + 4 * 1) / {_MULTI_AREA}, 6) AS lon, "
    f"round(({_SIDE} * {_SIDE} * {_SIDE} / 2 - 2 * 2 + 4 * 101) / {_MULTI_AREA}, 6) AS lat, round({_MULTI_AREA}, 6) AS area FROM part"))
def multipolygon_centroid(spark, d):
    """MultiPolygon features with a hole and a second part (squares
    placed by each part's key and size), written, read back, centroids."""
    def box(x, y, w, h, turn):
        corners = [(0, 0), (w, 0), (w, h), (0, h), (0, 0)][::turn]
        return F.array(*[F.array((x + a).cast("double"), (y + b).cast("double")) for a, b in corners])

    x, zero, side = F.col("p_partkey"), F.lit(0), F.col("p_size") + 4
    rings = F.array(F.array(box(x, zero, side, side, 1), box(x + 1, zero + 1, 1, 2, 1)), F.array(box(x, zero + 100, 2, 2, -1)))
    path = files.scratch_path(spark, "multi-geojson")
    (read_table(spark, d, "part").select(F.lit("Feature").alias("type"), F.struct(x.cast("string").alias("reg_name")).alias("properties"),
                                         F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates")).alias("geometry"))
     .write.json(path))
    verts = files.read_geojson(spark, path).withColumnRenamed("reg_name", "region")
    out = g.polygon_centroid(verts, part_col="part", ring_col="ring")
    return out.withColumn("region", F.col("region").cast("long"))


@register("region_list", o.with_(LP + GEO, "SELECT DISTINCT region FROM geo WHERE region IS NOT NULL"))
def region_list(spark, d):
    """The region names of a GeoJSON file, sorted."""
    geo = _geo_spark(spark, d).select("region", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    path = files.scratch_path(spark, "regions-geojson")
    files.write_geojson_parts(geo, path, order_cols=("lon", "lat"), size=PART)
    return files.region_names(files.read_features(spark, path))


@register("points_text_path", ORACLE["monotone_path"])
def points_text_path(spark, d):
    """S12 (re-aimed) + K1: points written as 'case x y' lines, parsed back
    with split + cast, then the monotone-path check."""
    path = files.scratch_path(spark, "points-text")
    files.write_points_text(_points(spark, d), path)
    return pth.monotone_path(files.read_points_text(spark, path))


@register("union_ragged", o.with_(LP + GEO, "SELECT restaurantId, restaurantName, city, NULL::DOUBLE AS latitude FROM listing_parts "
          "UNION ALL SELECT restaurantId, restaurantName, NULL, latitude FROM geo"))
def union_ragged(spark, d):
    """S3: records of two shapes as one table, missing fields NULL."""
    lp = rel.listing_parts(spark, d).select("restaurantId", "restaurantName", "city")
    return files.union_ragged([lp, _geo_spark(spark, d).select("restaurantId", "restaurantName", "latitude")])


@register("keep_ok", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 404 END AS status, o_orderstatus = 'F' AS ok FROM orders")
def keep_ok(spark, d):
    """Responses (orders stand in, finished ones as status 200) split into kept and rejected."""
    status = F.when(F.col("o_orderstatus") == "F", 200).when(F.col("o_orderstatus") == "O", 404)
    ok, bad = files.keep_ok(read_table(spark, d, "orders").select("o_orderkey", status.alias("status")))
    return ok.withColumn("ok", F.lit(True)).unionByName(bad.withColumn("ok", F.lit(False)))


@register("no_region_markers", o.with_(LP + GEO + GEO_ALL + [
    "rj AS (SELECT g.region, l.priceRange, g.latitude, g.longitude FROM listing_parts l RIGHT JOIN geo_all g USING (restaurantId))",
    "picks AS (SELECT DISTINCT region FROM geo WHERE region IS NOT NULL UNION ALL SELECT NULL)",
    f"shown AS (SELECT * FROM rj WHERE priceRange IN ({', '.join(o.q(b) for b, _ in rel.PRICE_COLOURS)}))"],
    "SELECT p.region, count(s.region)::BIGINT AS markers, min(s.latitude) AS south, max(s.latitude) AS north, min(s.longitude) AS west, "
    "max(s.longitude) AS east FROM picks p LEFT JOIN shown s ON p.region = s.region GROUP BY p.region"))
def no_region_markers(spark, d):
    """Markers of each region that can be picked, and of none picked, which has none."""
    regions = _geo_spark(spark, d).select("region").na.drop().distinct()
    none = spark.range(1).select(F.lit(None).cast("string").alias("region"))
    return g.marker_frames(_right_join(spark, d), regions.unionByName(none))
