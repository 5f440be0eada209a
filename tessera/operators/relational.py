"""Listing views, facet filters, facet values, joins.

The reference's listing table (one row per crawled page) does not exist in
the driver's data; two views bind its columns to driver tables:

* :func:`listing_parts` - one row per ``part``: name, brand, type, price
  band, the region of its lowest supplier, and the distinct market segments
  (``creditCards``) and order priorities (``facilitiesServices``) of its
  buyers.  The two sets come from lineitem x orders x customer: the heavy
  join of the pipeline, reduced to distinct (part, value) pairs before the
  per-part ``collect_set`` so a part bought a billion times still ships at
  most one row per distinct value.
* :func:`listing_docs` - one row per ``documents`` row, facilities from
  ``labels`` and the text length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# Price-band cut points (quartiles of p_retailprice and of
# documents.n_chars at sf0.01), and the four bands with their map colours.
PART_PRICE_CUTS = (924.975, 949.95, 974.925)
DOC_LENGTH_CUTS = (855, 1475, 2678)
PRICE_COLOURS = [("€", "teal"), ("€€", "red"), ("€€€", "mediumpurple"), ("€€€€", "peru")]

# English -> Italian region names; other names stay unchanged.
REGION_NAMES = [
    ("Aosta Valley", "Valle d'Aosta/Vallée d'Aoste"),
    ("Piedmont", "Piemonte"),
    ("Lombardy", "Lombardia"),
    ("Sicily", "Sicilia"),
    ("Tuscany", "Toscana"),
    ("Apulia", "Puglia"),
    ("Trentino-South Tyrol", "Trentino-Alto Adige/Südtirol"),
    ("Sardinia", "Sardegna"),
]


def price_band(value: Column, cuts) -> Column:
    """``€`` .. ``€€€€``: one plus the number of cut points below the value."""
    n = F.lit(1)
    for c in cuts:
        n = n + (value > F.lit(c)).cast("int")
    return F.repeat(F.lit("€"), n)


def translate_region(col: Column) -> Column:
    """Fixed English -> Italian region names, others unchanged."""
    m = F.create_map(*[F.lit(x) for pair in REGION_NAMES for x in pair])
    return F.coalesce(F.try_element_at(m, col), col)


def price_colour(col: Column) -> Column:
    """Band -> marker colour (NULL outside the four bands)."""
    m = F.create_map(*[F.lit(x) for pair in PRICE_COLOURS for x in pair])
    return F.try_element_at(m, col)


def part_buyer_sets(spark: SparkSession, d: str) -> DataFrame:
    """Distinct buyer segments and order priorities per part."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    pairs = (li.join(orders, li.l_orderkey == orders.o_orderkey)
             .join(cust, F.col("o_custkey") == cust.c_custkey)
             .select("l_partkey", "c_mktsegment", "o_orderpriority")
             .distinct())
    return pairs.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("creditCards"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("facilitiesServices"))


def part_supplier_place(spark: SparkSession, d: str) -> DataFrame:
    """Lowest supplier of each part with its nation and region names."""
    li = read_table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    low = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_suppkey").alias("s_suppkey"))
    sup = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables
    nat = read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = read_table(spark, d, "region").select("r_regionkey", "r_name")
    return (low.join(sup, "s_suppkey")
            .join(F.broadcast(nat), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(reg), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("p_partkey", "s_suppkey", "n_nationkey", "n_name", "r_name"))


def listing_parts(spark: SparkSession, d: str) -> DataFrame:
    """The listing table bound to ``part`` (see module doc)."""
    part = read_table(spark, d, "part")
    place = part_supplier_place(spark, d)
    sets = part_buyer_sets(spark, d)
    return (part.join(place, "p_partkey", "left").join(sets, "p_partkey", "left")
            .select(F.col("p_partkey").alias("restaurantId"),
                    F.col("p_name").alias("restaurantName"),
                    F.col("r_name").alias("city"),
                    F.col("p_brand").alias("address"),
                    F.col("n_name").alias("region"),
                    price_band(F.col("p_retailprice"), PART_PRICE_CUTS).alias("priceRange"),
                    F.col("p_type").alias("cuisineType"),
                    F.coalesce("facilitiesServices", F.array().cast("array<string>")).alias("facilitiesServices"),
                    F.coalesce("creditCards", F.array().cast("array<string>")).alias("creditCards"),
                    F.concat(F.lit("https://parts.example/"), F.col("p_partkey").cast("string")).alias("website")))


def listing_docs(spark: SparkSession, d: str) -> DataFrame:
    """The listing table bound to ``documents`` (+ ``labels``)."""
    docs = read_table(spark, d, "documents")
    labels = read_table(spark, d, "labels")
    j = docs.join(labels, "doc_id", "left")
    long_ = F.col("n_chars") > F.lit(DOC_LENGTH_CUTS[-1])
    fac = F.array_compact(F.array(
        F.when(F.col("quality") == 1, F.lit("quality")),
        F.when(F.col("toxic") == 1, F.lit("toxic")),
        F.when(long_, F.lit("long")),
        F.when(F.col("quality").isNotNull(), F.lit("labelled"))))
    return j.select(
        "doc_id",
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("restaurantName"),
        F.col("lang").alias("address"),
        F.col("text").alias("description"),
        F.col("source").alias("cuisineType"),
        price_band(F.col("n_chars"), DOC_LENGTH_CUTS).alias("priceRange"),
        fac.alias("facilitiesServices"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("website"))


# ------------------------------------------------------------ predicates

def filter_price_between(df: DataFrame, lo: str | None, hi: str | None,
                         col: str = "priceRange") -> DataFrame:
    """Q11: inclusive band range in string order; skipped when unset."""
    if not lo or not hi:
        return df
    return df.where(F.col(col).between(lo, hi))


def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """Q12: membership; skipped when the list is empty."""
    if not values:
        return df
    return df.where(F.col(col).isin(list(values)))


def contains_all(col: Column, values) -> Column:
    """Q13/Q14: the array column holds every selected value."""
    lit_arr = F.array(*[F.lit(v) for v in values])
    return F.forall(lit_arr, lambda x: F.array_contains(F.coalesce(col, F.array().cast("array<string>")), x))


def filter_contains_all(df: DataFrame, col: str, values) -> DataFrame:
    if not values:
        return df
    return df.where(contains_all(F.col(col), values))


# --------------------------------------------------------- facet values

def facet_values(df: DataFrame, array_cols: dict[str, str]) -> DataFrame:
    """A1: distinct values of list columns, as (facet, value), sorted."""
    parts = [df.select(F.lit(name).alias("facet"), F.explode(col).alias("value"))
             for name, col in array_cols.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().orderBy("facet", "value")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """A2: distinct values (NULL kept), sorted."""
    return df.select(col).distinct().orderBy(F.asc_nulls_last(col))


def distinct_nonnull(df: DataFrame, col: str) -> DataFrame:
    """A3: distinct non-NULL values, sorted."""
    return df.select(col).na.drop().dropDuplicates().orderBy(col)


# ---------------------------------------------------------------- joins

def right_join(left: DataFrame, right: DataFrame, key: str, suffix_drop: str = "_geo") -> DataFrame:
    """Right equi join; right-side columns that clash are renamed
    before the join and dropped after (the left name is kept)."""
    clash = [c for c in right.columns if c in left.columns and c != key]
    r = right
    for c in clash:
        r = r.withColumnRenamed(c, c + suffix_drop)
    return left.join(r, key, "right").drop(*[c + suffix_drop for c in clash])


def rank_key(df: DataFrame, order_cols: list[str], name: str = "rank_key") -> DataFrame:
    """1-based position after sorting (distributed, no global window)."""
    from tessera.operators.index import dense_ids
    nulls_last = [f(c) for c in order_cols for f in (lambda c: F.col(c).isNull().alias(f"{c}_null"), F.col)]
    keyed = df.withColumn("_ord", F.struct(*nulls_last))
    return dense_ids(keyed, "_ord", name).withColumn(name, F.col(name) + 1).drop("_ord")


def hover_text(name: Column, city: Column, address: Column, cuisine: Column) -> Column:
    """P5: marker hover HTML (NULL fields print as empty); its labels are fixed values."""
    return F.concat(
        F.lit("<b>Name:</b> "), F.coalesce(name, F.lit("")), F.lit("<br>"),
        F.lit("<b>City:</b> "), F.coalesce(city, F.lit("")), F.lit("<br>"),
        F.lit("<b>Address:</b> "), F.coalesce(address, F.lit("")), F.lit("<br>"),
        F.lit("<b>Types of cuisine: </b> "), F.coalesce(cuisine, F.lit("")), F.lit("<br>"))


def list_literal(col: Column) -> Column:
    """Render an array as a list literal (the TSV form), quoted and escaped as
    Python does: single quotes, unless the value holds one and no double quote."""
    def item(x):
        plain = F.regexp_replace(x, r"\\", r"\\\\")
        double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
        return F.when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.regexp_replace(plain, "'", r"\\'"), F.lit("'")))
    return F.concat(F.lit("["), F.concat_ws(", ", F.transform(col, item)), F.lit("]"))


def parse_list_literal(col: Column) -> Column:
    """Parse a list literal (single or double quotes) without eval."""
    return F.from_json(col, "array<string>", {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})
