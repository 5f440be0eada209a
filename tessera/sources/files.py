"""File sources and sinks (S1-S13): landed pages, TSV, index tables, results.

All paths are on shared storage: callers pass one, or :func:`scratch_path`
puts it under ``spark.checkpoint.dir`` (the cluster's shared folder).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import STRIP_RE
from tessera.operators.index import dense_ids
from tessera.session import checkpoint_dir, freed_shuffles, own_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return own_scratch(f"{base}/tessera-out/{name}-{uuid.uuid4().hex[:12]}")


COMPRESSION = "zstd"  # of scratch tables and saved indexes: two thirds of Spark's default on token tables


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back:
    computed once, reused by several branches, lineage cut (a lost
    executor re-reads files instead of recomputing the whole chain).  Its
    shuffle files go with the end of the write.  ``path``: a scratch path made
    before, outside of a scope that ends sooner than the table."""
    path = path or scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------- landed pages

def land_pages(pages: DataFrame, path: str) -> None:
    """Land pages ``(batch, url_key, html)`` as Parquet rows (page, key, html),
    range-sorted by batch folder: a range of folders reaches the scan as a
    pushed filter, and there is no directory or file per page."""
    (pages.select(F.col("batch").cast("long").alias("page"), F.col("url_key").cast("string").alias("key"), "html")
     .repartitionByRange("page", "key").sortWithinPartitions("page", "key").write.mode("overwrite").parquet(path))


def _between(df: DataFrame, first: int | None, last: int | None) -> DataFrame:
    return df if first is None or last is None else df.where(F.col("page").between(first, last))


def scan_pages(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """S1/S2 over landed rows: (page, key, html), of folders first..last if given."""
    return _between(spark.read.schema("page long, key string, html string").parquet(path), first, last)


def scan_page_folders(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """S1/S2 over a crawl's own folders ``page_<n>/<name>.html``: one row per
    file with its whole text (UTF-8, byte for byte), page and key from the path.  A range of folders
    is listed by name, so the others are never opened."""
    folders = "page_*" if first is None or last is None else "page_{" + ",".join(map(str, range(first, last + 1))) + "}"
    files = (spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{folders}/*.html")
             .select(F.col("content").cast("string").alias("value"), F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")).alias("file")))
    return files.select(F.regexp_extract("file", "/page_([0-9]+)/[^/]+$", 1).cast("long").alias("page"),
                        F.regexp_extract("file", r"([^/]+)\.html$", 1).alias("key"), F.col("value").alias("html"))


# ---------------------------------------------------------------- TSV

# How line breaks and the escape itself are written in a TSV, so
# that a record is one line and a file can be read in parts.
LINE_CODES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))
NULL_CODE = "\\N"  # null, which an empty text isn't


def _nested(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))


def write_tsv(df: DataFrame, path: str, quoted: bool = False) -> None:
    """Tab-separated with a header; list columns as JSON text.  Line breaks
    in a text are written as two characters (LINE_CODES), so no record spans
    lines; ``quoted`` leaves them as they are, inside quotes."""
    out = df
    for f in df.schema.fields:
        if _nested(f):
            out = out.withColumn(f.name, F.to_json(f.name))
        if not quoted and (_nested(f) or isinstance(f.dataType, T.StringType)):
            for plain, code in LINE_CODES:
                out = out.withColumn(f.name, F.replace(F.col(f.name), F.lit(plain), F.lit(code)))
    out.write.mode("overwrite").option("header", True).option("sep", "\t") \
        .option("quote", '"').option("escape", '"').option("nullValue", "" if quoted else NULL_CODE).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, quoted: bool = False) -> DataFrame:
    """Read back with an explicit schema; list columns parsed from JSON
    (single-quoted Python-style literals are accepted too).  A file is as many
    tasks as its size asks for; one with quoted line breaks (``quoted``) is one task."""
    flat = T.StructType([T.StructField(f.name, T.StringType() if _nested(f) else f.dataType, True) for f in schema.fields])
    df = (spark.read.schema(flat).option("header", True).option("sep", "\t")
          .option("quote", '"').option("escape", '"').option("multiLine", quoted)
          .option("nullValue", "" if quoted else NULL_CODE).csv(path))
    for f in schema.fields:
        if not quoted and (_nested(f) or isinstance(f.dataType, T.StringType)):
            for plain, code in reversed(LINE_CODES):
                df = df.withColumn(f.name, F.replace(F.col(f.name), F.lit(code), F.lit(plain)))
        if _nested(f):
            df = df.withColumn(f.name, F.from_json(f.name, f.dataType, {"allowSingleQuotes": "true"}))
    return df


# --------------------------------------------------- index and results

VERSION = "saved_at timestamp, version string"


def save_result(df: DataFrame, path: str) -> DataFrame:
    """Persist a search result, whole rows and scores (explicit opt-in), as
    a new version, and return the table read back from storage (lineage cut).

    The rows go to a folder of their own; only when they are complete is a
    line added to the list of versions, so a reader never sees half a result,
    a job that fails leaves the former one, and one that is being read stays."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}/rows/{version}")
    (spark.range(1).select(F.current_timestamp().alias("saved_at"), F.lit(version).alias("version"))
     .coalesce(1).write.mode("append").parquet(f"{path}/versions"))
    return spark.read.schema(df.schema).parquet(f"{path}/rows/{version}")


def result_versions(spark: SparkSession, path: str) -> DataFrame:
    """The complete versions of a saved result: (saved_at, version)."""
    return spark.read.schema(VERSION).parquet(f"{path}/versions")


def read_result(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The newest version of a saved result, or a stated one."""
    if version is None:
        version = result_versions(spark, path).agg(F.max_by("version", F.struct("saved_at", "version"))).first()[0]
    return spark.read.parquet(f"{path}/rows/{version}")


def write_url_list(df: DataFrame, path: str, col: str = "url") -> None:
    """One URL per line."""
    df.select(col).write.mode("overwrite").text(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """URL list, each line stripped (blank lines stay as '')."""
    return spark.read.text(path).select(F.regexp_replace("value", STRIP_RE, "").alias("url"))


# ------------------------------------------------------------ GeoJSON

# Coordinates are kept as JSON text: their depth depends on the type.
FEATURE = ("struct<type:string, properties:struct<reg_name:string, `from`:bigint>, geometry:struct<type:string, coordinates:string>>")
POLYGON = "array<array<array<double>>>"
PART_VERTICES = 50_000


def write_geojson_parts(vertices: DataFrame, path: str, key: str = "region", order_cols=("i",), size: int = PART_VERTICES) -> None:
    """One outline a key as GeoJSON Features of at most ``size`` vertices, one
    per line: a LineString is a stretch of the outline, its property ``from``
    the number of its first vertex.  Numbers rise along an outline, over all
    keys, so no key is gathered or counted by one task."""
    order_cols = list(order_cols)
    place = dense_ids(vertices.select(F.struct(key, *dict.fromkeys([*order_cols, "lon", "lat"])).alias("_v")), "_v", "_id")
    part = (place.groupBy(F.col("_v")[key].alias("_key"), F.floor(F.col("_id") / size).alias("_part"))
            .agg(F.array_sort(F.collect_list(F.struct("_id", F.array(F.col("_v.lon"), F.col("_v.lat")).alias("xy")))).alias("_pts")))
    (part.select(F.lit("Feature").alias("type"), F.struct(F.col("_key").alias("reg_name"), F.col("_pts")[0]["_id"].alias("from")).alias("properties"),
                 F.struct(F.lit("LineString").alias("type"), F.transform("_pts", lambda p: p["xy"]).alias("coordinates")).alias("geometry"))
     .write.mode("overwrite").json(path))


def write_geojson(vertices: DataFrame, path: str, key: str = "region", order_cols=("i",)) -> None:
    """One GeoJSON Feature per line (a Polygon with one closed ring of
    ``[lon, lat]`` in vertex order).  A feature is one row by its format; for
    outlines of any length there is :func:`write_geojson_parts`."""
    order_cols = list(order_cols)
    ring = (vertices.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(*dict.fromkeys([*order_cols, "lon", "lat"])))).alias("pts"))
            .withColumn("ring", F.transform("pts", lambda p: F.array(p["lon"], p["lat"])))
            .select(F.lit("Feature").alias("type"), F.struct(F.col(key).alias("reg_name")).alias("properties"),
                    F.struct(F.lit("Polygon").alias("type"), F.array(F.concat("ring", F.slice("ring", 1, 1))).alias("coordinates"))
                    .alias("geometry")))
    ring.write.mode("overwrite").json(path)


# A FeatureCollection is cut at each feature's type.  A piece must go on with the feature's other members (so the type comes first).
FEATURE_MARK = '"Feature"'
COLLECTION_HEAD = r'^\x{FEFF}?\s*\{(?s:.*)"features"\s*:\s*\[\s*(\{[^{}]*"type"\s*:\s*$|\])'


def _collection_features(spark: SparkSession, path: str) -> DataFrame:
    pieces = spark.read.option("lineSep", FEATURE_MARK).text(path).where(F.trim("value") != "")
    rest = F.col("value").rlike(r"^\s*,")
    f = F.from_json(F.when(rest, F.concat(F.lit('{"type": ' + FEATURE_MARK), "value")), FEATURE)
    wrong = F.raise_error(F.lit("collection can't be read in parts (a feature's type isn't its first member, or a value reads " + FEATURE_MARK
                                + "); read it with whole=True")).cast(FEATURE)
    return (pieces.where(~F.col("value").rlike(COLLECTION_HEAD))
            .select(F.when(rest & (f["type"] == "Feature"), f).otherwise(wrong).alias("f")).select("f.*"))


def read_features(spark: SparkSession, path: str, collection: bool = False, whole: bool = False) -> DataFrame:
    """GeoJSON features, one per line or a FeatureCollection.  A collection
    is read in parts, as many tasks as its size asks for; that needs each
    feature's type to be its first member, otherwise it is an error.  ``whole``
    reads any member order, a file a task."""
    if collection and not whole:
        return _collection_features(spark, path)
    if collection:
        fc = spark.read.schema(f"type string, features array<{FEATURE}>").option("multiLine", True).json(path)
        return fc.select(F.explode("features").alias("f")).select("f.*")
    return spark.read.schema(T._parse_datatype_string(FEATURE)).json(path)


def region_names(features: DataFrame) -> DataFrame:
    """The region list, sorted, without nulls and repetitions."""
    return features.select(F.col("properties.reg_name").alias("region")).na.drop().distinct().orderBy("region")


def read_geojson(spark: SparkSession, path: str, collection: bool = False, whole: bool = False) -> DataFrame:
    """S10 + G2: the vertices of Polygon and MultiPolygon features, and of
    outlines in LineStrings (:func:`write_geojson_parts`):
    ``(reg_name, part, ring, i, lon, lat)``; ring 0 is a part's outline, the
    others are its holes.  A feature without geometry has none; another type
    of geometry is an error."""
    g = F.col("geometry")
    parts = (F.when(g["type"] == "Polygon", F.array(F.from_json(g["coordinates"], POLYGON)))
             .when(g["type"] == "MultiPolygon", F.from_json(g["coordinates"], f"array<{POLYGON}>"))
             .when(g["type"] == "LineString", F.array(F.array(F.from_json(g["coordinates"], "array<array<double>>"))))
             .when(g["type"].isNotNull(), F.raise_error(F.concat(F.lit("geometry type not supported: "), g["type"])).cast(f"array<{POLYGON}>")))
    p = read_features(spark, path, collection, whole).select(
        F.col("properties.reg_name").alias("reg_name"), F.coalesce("properties.from", F.lit(0).cast("long")).alias("first"), F.posexplode(parts).alias("part", "rings"))
    r = p.select("reg_name", "first", "part", F.posexplode("rings").alias("ring", "coords"))
    return r.select("reg_name", "first", F.col("part").cast("long").alias("part"), F.col("ring").cast("long").alias("ring"),
                    F.posexplode("coords").alias("i", "xy")).select(
        "reg_name", "part", "ring", (F.col("first") + F.col("i")).alias("i"), F.col("xy")[0].alias("lon"), F.col("xy")[1].alias("lat"))


# ------------------------------------------------------- points as text

def write_points_text(points: DataFrame, path: str) -> None:
    """Points as text lines ``case x y``."""
    points.select(F.concat_ws(" ", "case_id", "x", "y").alias("value")).write.mode("overwrite").text(path)


def read_points_text(spark: SparkSession, path: str) -> DataFrame:
    """S12 (re-aimed): ``case x y`` lines -> ``points(case_id, x, y)`` by
    split + cast (the reference's sequential stdin format needs line order,
    which a distributed read does not have, so the case id is on each line)."""
    parts = F.split(F.trim("value"), " +")
    return (spark.read.text(path).where(F.trim("value") != "")
            .select(parts[0].cast("long").alias("case_id"), parts[1].cast("long").alias("x"),
                    parts[2].cast("long").alias("y")))


# --------------------------------------------------------- misc helpers

def union_ragged(parts: list[DataFrame]) -> DataFrame:
    """S3: records with differing keys -> one table, missing fields NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def keep_ok(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages with status 200, rejected responses for the log)."""
    ok = F.col("status") == 200
    return responses.where(ok), responses.where(~ok | F.col("status").isNull())
