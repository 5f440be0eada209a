"""Map tables: marker tables per price band (G1, G4) and polygon centroids.

No drawing: the outputs are the rows a map would plot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import relational as rel
from tessera.operators.paths import with_previous


def region_markers(listing_geo: DataFrame, region: str | None, topk_names: DataFrame | None = None,
                   id_col: str = "restaurantId") -> DataFrame:
    """Marker rows ``(scope, priceRange, colour, id, lat, lon, name, hover)``.

    With a saved top-k (``topk_names``: one ``restaurantName`` column) the
    listing is first restricted to those names (J3).  ``national`` markers
    (all regions) exist only when top-k is on and a region is picked;
    ``regional`` markers are the picked region's.  No region -> no rows.
    Bands other than the four known ones are dropped.
    """
    base = listing_geo
    if topk_names is not None:
        base = base.join(topk_names.select("restaurantName").distinct(), "restaurantName", "left_semi")
    if not region:
        return base.limit(0).select(F.lit("").alias("scope"), "priceRange", F.lit("").alias("colour"),
                                    id_col, "latitude", "longitude", "restaurantName",
                                    F.lit("").alias("hover"))
    scoped = base.withColumn("scope", F.array(F.lit("regional"))) if topk_names is None else \
        base.withColumn("scope", F.array(F.lit("national"), F.lit("regional")))
    marks = scoped.select("*", F.explode("scope").alias("_scope")).where(
        (F.col("_scope") == "national") | (F.col("region") == F.lit(region)))
    return (marks.where(F.col("priceRange").isin([b for b, _ in rel.PRICE_COLOURS]))
            .select(F.col("_scope").alias("scope"), "priceRange",
                    rel.price_colour(F.col("priceRange")).alias("colour"), id_col, "latitude", "longitude",
                    "restaurantName",
                    rel.hover_text(F.col("restaurantName"), F.col("city"), F.col("address"),
                                   F.col("cuisineType")).alias("hover")))


def marker_frames(listing_geo: DataFrame, picks: DataFrame) -> DataFrame:
    """G4 for a table of picked regions: per pick the number of its markers and
    the frame around them ``(region, markers, south, north, west, east)``.
    No region picked (null) has no markers.  Counted before the join, one row
    a region."""
    frames = (listing_geo.where(F.col("region").isNotNull() & F.col("priceRange").isin([b for b, _ in rel.PRICE_COLOURS]))
              .groupBy("region").agg(F.count(F.lit(1)).alias("markers"), F.min("latitude").alias("south"), F.max("latitude").alias("north"),
                                     F.min("longitude").alias("west"), F.max("longitude").alias("east")))
    return picks.select("region").join(frames, "region", "left").withColumn("markers", F.coalesce("markers", F.lit(0).cast("long")))


def polygon_centroid(vertices: DataFrame, key: str = "region", order_cols=("i",),
                     part_col: str | None = None, ring_col: str | None = None) -> DataFrame:
    """Area centroid of each key's polygons from their rings
    ``(key, [part, ring,] <order_cols>, lon, lat)``, by the shoelace sums.

    Without part and ring a key is one ring.  Ring 0 of a part is its
    outline and the others are holes; each ring's direction is normalised, so
    holes are taken off whichever way they run.  Edges come from
    :func:`with_previous` (distributed, no per-key task); the edge that closes
    a ring comes from its first and last vertices, one row per ring.
    """
    order_cols, ring_keys = list(order_cols), [key, *(c for c in (part_col, ring_col) if c)]
    v = vertices.select(*ring_keys, *order_cols, F.col("lon").alias("x"), F.col("lat").alias("y"))
    edges = with_previous(v, ring_keys, order_cols=order_cols, value_cols=("x", "y")).where(
        F.col("prev_x").isNotNull()).select(*ring_keys, F.col("prev_x").alias("px"), F.col("prev_y").alias("py"), "x", "y")
    place = F.struct(*order_cols)
    ends = v.groupBy(*ring_keys).agg(F.max_by(F.struct("x", "y"), place).alias("l"), F.min_by(F.struct("x", "y"), place).alias("f"))
    closing = ends.select(*ring_keys, F.col("l.x").alias("px"), F.col("l.y").alias("py"), F.col("f.x").alias("x"), F.col("f.y").alias("y"))
    cross = F.col("px") * F.col("y") - F.col("x") * F.col("py")
    rings = edges.unionByName(closing).groupBy(*ring_keys).agg(
        F.sum(cross).alias("a2"), F.sum((F.col("px") + F.col("x")) * cross).alias("cx6"),
        F.sum((F.col("py") + F.col("y")) * cross).alias("cy6"))
    sign = F.signum("a2") * (F.when(F.col(ring_col) > 0, -1).otherwise(1) if ring_col else F.lit(1))
    sums = rings.groupBy(key).agg(*[F.sum(sign * F.col(c)).alias(c) for c in ("a2", "cx6", "cy6")])
    return sums.select(key,
                       F.round(F.try_divide(F.col("cx6"), F.col("a2") * 3), 6).alias("lon"),
                       F.round(F.try_divide(F.col("cy6"), F.col("a2") * 3), 6).alias("lat"),
                       F.round(F.col("a2") / 2, 6).alias("area"))


STAR_ORDER = ("a", "d", "lon", "lat")


def star_ring(points: DataFrame, key: str = "region") -> DataFrame:
    """Order distinct points of each key by angle around their mean: a
    simple (star-shaped) ring ``(key, a, d, lon, lat)``; the vertex order is
    :data:`STAR_ORDER` (angle, squared distance, lon, lat)."""
    pts = points.select(key, "lon", "lat").distinct()
    mean = pts.groupBy(key).agg(F.avg("lon").alias("_mx"), F.avg("lat").alias("_my"))
    j = pts.join(mean, key)
    ang = F.atan2(F.col("lat") - F.col("_my"), F.col("lon") - F.col("_mx"))
    dist = F.pow(F.col("lat") - F.col("_my"), 2) + F.pow(F.col("lon") - F.col("_mx"), 2)
    return j.select(key, ang.alias("a"), dist.alias("d"), "lon", "lat")
