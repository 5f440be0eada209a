from tessera.operators import index as ix
from tessera.operators import score as sc
from tessera.operators import search as srch
from pyspark.sql import functions as F


def test_custom_score_golden(spark, corpus):
    """FIXTURES §4.2: 0.1 x 0.707107 + 0 + 0.3 x 2/3 + 0.3 = 0.570711."""
    idx = ix.build_index(corpus)
    listing = corpus.select(
        "doc_id", F.col("text").alias("description"), F.lit("Creative").alias("cuisineType"),
        F.array(F.lit("Bar"), F.lit("Garden")).alias("facilitiesServices"), F.lit("€€").alias("priceRange"))
    q = sc.CustomQuery(description="modern seasonal", cuisineType="Italian",
                       facilitiesServices=["Bar", "Garden", "Terrace"], priceRange="€€", num_results=3)
    res = sc.custom_score(listing, idx, q).collect()
    assert [(r.doc_id, round(r.customScore, 6)) for r in res] == [(0, 0.570711)]
    assert round(res[0].desc_score, 6) == 0.707107


def test_result_size_rule():
    assert sc.CustomQuery("x", num_results=0).result_size(5) == 5
    assert sc.CustomQuery("x", num_results="3").result_size(5) == 5
    assert sc.CustomQuery("x", num_results=7).result_size(5) == 7


def test_weighted_similarity_golden(spark):
    """FIXTURES §4.3."""
    lst = spark.createDataFrame(
        [(1, "al mare", "venice", "seafood"), (2, "al ponte", "rome", "italian"),
         (3, "mare blu", "venice", "seafood italian"), (4, "bar", "milan", "creative")],
        "restaurantId long, restaurantName string, city string, cuisineType string")
    cases = {
        ("al", "", ""): {1: 0.707107, 2: 0.447214, 3: 0.0, 4: 0.0},
        ("al", "venice", ""): {1: 0.397487, 2: 0.156525, 3: 0.15, 4: 0.0},
        ("", "venice", "seafood"): {1: 0.5, 2: 0.0, 3: 0.456066, 4: 0.0},
        ("al", "venice", "seafood"): {1: 0.284518, 2: 0.074536, 3: 0.14714, 4: 0.0},
        ("", "", ""): {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0},
    }
    for (n, c, t), want in cases.items():
        got = sc.weighted_similarity(lst, {"restaurantName": n, "city": c, "cuisineType": t}).collect()
        assert {r.restaurantId: round(r.similarity_score, 6) for r in got} == want, (n, c, t)


def test_faceted_filters(spark):
    lst = spark.createDataFrame(
        [(1, "al mare", "venice", "seafood", "a", "€€", "Veneto", ["visa", "amex"], ["Terrace"], "u1"),
         (2, "al ponte", "rome", "italian", "b", "€", "Lazio", ["visa"], ["Terrace"], "u2"),
         (3, "al lago", "venice", "seafood", "c", "€€€€", "Veneto", ["visa", "amex"], ["Terrace", "Bar"], "u3")],
        "restaurantId long, restaurantName string, city string, cuisineType string, address string, "
        "priceRange string, region string, creditCards array<string>, facilitiesServices array<string>, "
        "website string")
    q = sc.FacetQuery(restaurant_name="Mare lago", price_range=("€€", "€€€€"), regions=["Veneto"],
                      credit_cards=["amex"], facilities=["Terrace"])
    got = sorted(r.restaurantId for r in sc.faceted_search(lst, q).collect())
    assert got == [1, 3]


def test_choices_of_the_form():
    q = sc.CustomQuery.from_choices("modern", facilities={"Bar": True, "Garden": False, "Parking": True}, num_results=3)
    assert q == sc.CustomQuery("modern", "", ["Bar", "Parking"], "", 3)
    assert sc.CustomQuery.from_choices("x", "Italian", None, "€") == sc.CustomQuery("x", "Italian", [], "€")
    assert sc.CustomQuery.from_choices("x", None, {}, None).result_size() == 5


def test_no_preference_scores_by_text_alone(spark, corpus):
    """All / nothing ticked: the other parts of the score are 0."""
    listing = corpus.selectExpr("doc_id", "text AS description", "'Italian' AS cuisineType", "array('Bar') AS facilitiesServices", "'€' AS priceRange")
    idx = ix.build_index(corpus)
    rows = sc.custom_score(listing, idx, sc.CustomQuery.from_choices("modern seasonal", facilities={"Bar": False})).collect()
    assert [(r.doc_id, r.cuisine_score, r.facility_score, r.price_score) for r in rows] == [(0, 0.0, 0.0, 0.0)]
    assert abs(rows[0].customScore - 0.1 * rows[0].desc_score) < 1e-12
