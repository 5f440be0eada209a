"""Custom score, multi-field similarity and faceted search (Q8-Q10).

Everything is joins and column arithmetic over the listing table; the
per-field cosines reuse :func:`tessera.operators.search.cosine_scores` with
one index of all typed fields over the whole listing (IDF over all rows, filters
applied afterwards, as in the reference).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import index as ix
from tessera.operators import relational as rel
from tessera.operators import search as srch

# Weights of the custom score (description, cuisine,
# facilities, price).
CUSTOM_WEIGHTS = {"description": 0.1, "cuisine": 0.3, "facilities": 0.3, "price": 0.3}


@dataclass
class CustomQuery:
    description: str
    cuisineType: str = ""
    facilitiesServices: list = field(default_factory=list)
    priceRange: str = ""
    num_results: int = 0

    @classmethod
    def from_choices(cls, description: str, cuisine: str | None = "All", facilities: dict[str, bool] | None = None,
                     price: str | None = "All", num_results: int = 0) -> CustomQuery:
        """A search form's choices as a query: ``All`` (or nothing chosen)
        is no preference, and only the ticked facilities are wishes."""
        def choice(value):
            return "" if value in (None, "All") else value

        return cls(description, choice(cuisine), [name for name, ticked in (facilities or {}).items() if ticked], choice(price), num_results)

    def result_size(self, k: int = 5) -> int:
        """``num_results`` if a positive int, else ``k``."""
        n = self.num_results
        return n if isinstance(n, int) and not isinstance(n, bool) and n > 0 else k


def description_scores(listing: DataFrame, index: ix.Index, matches: DataFrame,
                       query: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Cosine of relative-TF x IDF vectors; the document side uses raw
    whitespace tokens of ``description`` (case kept, not analysed) looked up
    in the analysed vocabulary, the query side its analysed terms.  0 when a
    norm is 0.  Output (id_col, desc_score) for every matched row.
    """
    qtoks = index.analyze(query, "qid", "text")
    qlen = qtoks.groupBy("qid").agg(F.sum("n").alias("qlen"))
    qv = (qtoks.select("qid", "term", F.col("n").alias("qtf"))
          .join(qlen, "qid").join(index.idf.select("term", "idf"), "term")
          .select("term", (F.col("qtf") / F.col("qlen") * F.col("idf")).alias("qw")))
    qnorm = qv.select(F.sqrt(F.sum(F.col("qw") * F.col("qw")))).scalar()

    docs = listing.join(matches.select(id_col), id_col, "left_semi")
    raw = docs.select(id_col, tx.whitespace_tokens(F.col("description")).alias("toks"))
    toks = raw.select(id_col, F.size("toks").alias("dlen"), F.explode("toks").alias("term"))
    dv = (toks.groupBy(id_col, "dlen", "term").agg(F.count(F.lit(1)).alias("dtf"))
          .join(index.idf.select("term", "idf"), "term")
          .select(id_col, "term", (F.col("dtf") / F.col("dlen") * F.col("idf")).alias("dw")))
    # norm and dot product in one pass over the matched texts
    both = (dv.join(qv, "term", "left").groupBy(id_col)
            .agg(F.sqrt(F.sum(F.col("dw") * F.col("dw"))).alias("dnorm"), F.sum(F.col("dw") * F.col("qw")).alias("dot")))
    return (matches.select(id_col).join(both, id_col, "left")
            .select(id_col, F.coalesce(
                F.try_divide(F.col("dot"), F.col("dnorm") * qnorm), F.lit(0.0)).alias("desc_score")))


def facility_fraction(col, wishes: list[str]):
    """Q8d: matched wishes / number of wishes (duplicates count), 0 if none."""
    if not wishes:
        return F.lit(0.0)
    arr = F.array(*[F.lit(w) for w in wishes])
    have = F.coalesce(col, F.array().cast("array<string>"))
    return F.size(F.filter(arr, lambda w: F.array_contains(have, w))) / F.lit(float(len(wishes)))


def custom_score(listing: DataFrame, index: ix.Index, q: CustomQuery, k: int = 5,
                 id_col: str = "doc_id", weights: dict | None = None) -> DataFrame:
    """Q8: all-terms matches of the description, scored and cut to n.

    Returns the listing columns of the matches plus ``customScore`` (and the
    sub-scores), ordered top-n by score with ties by id.
    """
    wts = dict(CUSTOM_WEIGHTS, **(weights or {}))
    spark = listing.sparkSession
    from tessera.sources.files import materialize
    query = srch.query_table(spark, q.description)
    matches = materialize(srch.conjunctive_search(*srch.literal(index, q.description)).select(id_col), "matches")
    desc = description_scores(listing, index, matches, query, id_col)
    cuisine = (F.col("cuisineType") == F.lit(q.cuisineType)).cast("double") if q.cuisineType else F.lit(0.0)
    price = (F.col("priceRange") == F.lit(q.priceRange)).cast("double") if q.priceRange else F.lit(0.0)
    # scored on narrow columns; the wide rows are fetched for the n that stay
    narrow = listing.select(id_col, "cuisineType", "facilitiesServices", "priceRange")
    scored = (narrow.join(desc, id_col)
              .withColumn("cuisine_score", F.coalesce(cuisine, F.lit(0.0)))
              .withColumn("facility_score", facility_fraction(F.col("facilitiesServices"), q.facilitiesServices))
              .withColumn("price_score", F.coalesce(price, F.lit(0.0))))
    total = (F.col("desc_score") * wts["description"] + F.col("cuisine_score") * wts["cuisine"]
             + F.col("facility_score") * wts["facilities"] + F.col("price_score") * wts["price"])
    scored = scored.withColumn("customScore", total)
    n = q.result_size(k)
    top = scored.drop("cuisineType", "facilitiesServices", "priceRange").orderBy(srch.by_score("customScore"), F.asc(id_col)).limit(n)
    # n rows, the caller's own bound
    return listing.join(F.broadcast(materialize(top, "top")), id_col).orderBy(srch.by_score("customScore"), F.asc(id_col))


# ------------------------------------------------------ multi-field search

FIELDS = ("restaurantName", "city", "cuisineType")


def field_weights(active: list[str]) -> dict[str, float]:
    """Q9 weight scheme by the set of typed fields (fixed values)."""
    if len(active) == 1:
        return {active[0]: 1.0}
    if len(active) == 2 and "restaurantName" in active:
        return {f: (0.7 if f == "restaurantName" else 0.3) for f in active}
    if len(active) == 2:
        return {"city": 0.7, "cuisineType": 0.3}
    if len(active) == 3:
        return {"restaurantName": 0.5, "city": 0.3, "cuisineType": 0.2}
    return {}


def weighted_similarity(listing: DataFrame, texts: dict[str, str], id_col: str = "restaurantId",
                        fields=FIELDS) -> DataFrame:
    """Q9: sum of weight x cosine over typed fields / number typed.

    Every listing row is returned (0 when nothing matched or nothing typed).
    One index holds all typed fields over the whole listing, keyed by field, so
    the scores of all fields come from one join and are summed per row.
    """
    from tessera.sources.files import materialize
    active = typed_fields(texts, fields)
    # one pass over the (possibly expensive) listing for all fields
    rows = listing.select(id_col, *active)
    return field_similarity(materialize(rows, "listing-fields") if active else rows, active, id_col)


def typed_fields(texts: dict[str, str], fields=FIELDS) -> dict[str, str]:
    """The fields with a text, lower-cased and without blanks at its ends."""
    norm = {f: (texts.get(f) or "").strip().lower() for f in fields}
    return {f: t for f, t in norm.items() if t}


def field_similarity(listing: DataFrame, active: dict[str, str], id_col: str) -> DataFrame:
    """(id, similarity_score) of every row of a table that is cheap to read."""
    spark = listing.sparkSession
    if not active:
        return listing.select(id_col, F.lit(0.0).alias("similarity_score"))
    wts = field_weights(list(active))
    index = ix.build_fields_index(listing, id_col, list(active))
    typed = index.analyze(spark.createDataFrame(list(active.items()), "field string, text string"), "field", "text").collect()  # the caller's own words
    narrow = srch.narrowed(index, sorted({r["term"] for r in typed}))
    scores = srch.cosine_scores(narrow, spark.createDataFrame(typed, "field string, term string, n long"), qid="field")
    weight = F.element_at(F.create_map(*[F.lit(x) for f in active for x in (f, wts.get(f, 0.0))]), F.col("field"))
    summed = scores.groupBy(id_col).agg((F.sum(F.col("score") * weight) / F.lit(float(len(active)))).alias("s"))
    return (listing.select(id_col).join(summed, id_col, "left")
            .select(id_col, F.coalesce("s", F.lit(0.0)).alias("similarity_score")))


@dataclass
class FacetQuery:
    restaurant_name: str = ""
    city: str = ""
    cuisine_type: str = ""
    price_range: tuple = ()
    regions: list = field(default_factory=list)
    credit_cards: list = field(default_factory=list)
    facilities: list = field(default_factory=list)


def faceted_search(listing: DataFrame, q: FacetQuery, id_col: str = "restaurantId") -> DataFrame:
    """Q10: similarity, score > 0 if any text typed, four filters, sorted.

    Output: rank, restaurantName, address, cuisineType, priceRange, website
    and the score (kept, unlike the reference), best score first, then id.
    """
    texts = {"restaurantName": q.restaurant_name, "city": q.city, "cuisineType": q.cuisine_type}
    from tessera.sources.files import materialize
    listing = materialize(listing, "listing")
    sim = field_similarity(listing, typed_fields(texts), id_col)
    res = listing.join(sim, id_col)
    if any((v or "").strip() for v in texts.values()):
        res = res.where(F.col("similarity_score") > 0)
    if q.price_range:
        res = rel.filter_price_between(res, q.price_range[0], q.price_range[1])
    res = rel.filter_in(res, "region", q.regions)
    res = rel.filter_contains_all(res, "creditCards", q.credit_cards)
    res = rel.filter_contains_all(res, "facilitiesServices", q.facilities)
    res = res.select(id_col, "restaurantName", "address", "cuisineType", "priceRange", "website",
                     "similarity_score")
    return srch.ranked(res, id_col, "similarity_score")
