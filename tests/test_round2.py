"""Cuts that are gone, exact integers, order of results, shared folder."""

import os

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.functions import text as tx
from tessera.operators import paths as pth
from tessera.operators import relational as rel
from tessera.operators import score as sc
from tessera.operators import search as srch
from tessera.plans import catalog_listing, catalog_misc


def test_scores_are_ranked_unrounded(spark):
    scores = spark.createDataFrame([(0, 1, 0.5), (0, 2, 0.50000001), (0, 3, 1e-9)], "qid long, doc_id long, score double")
    assert [r.doc_id for r in srch.top_k(scores, 3).orderBy("rank").collect()] == [2, 1, 3]
    assert [(r.doc_id, r.rank) for r in srch.ranked(scores, "doc_id").collect()] == [(2, 1), (1, 2), (3, 3)]


def test_faceted_search_keeps_tiny_scores_in_order(spark):
    n = 3000
    rows = [(i, "bolt" + (" x" if i % 2 else "") * (i % 5), "a", "r", "€", "c", ["f"], ["k"], "w", "p") for i in range(n)]
    rows.append((n, "rare bolt", "a", "r", "€", "c", ["f"], ["k"], "w", "p"))
    cols = "restaurantId long, restaurantName string, address string, region string, priceRange string, cuisineType string, " \
           "facilitiesServices array<string>, creditCards array<string>, website string, city string"
    out = sc.faceted_search(spark.createDataFrame(rows, cols), sc.FacetQuery(restaurant_name="bolt rare")).collect()
    assert out[0].restaurantId == n and [r.rank for r in out] == list(range(1, len(out) + 1))
    scores = [round(r.similarity_score, 12) for r in out]
    assert scores == sorted(scores, reverse=True) and all(s >= 0 for s in scores)


def test_all_price_bands_reach_the_markers(spark):
    d = "/root/testdata/sf0.01"
    bands = {r.priceRange for r in catalog_listing._right_join(spark, d).select("priceRange").distinct().collect()}
    assert {"€", "€€", "€€€", "€€€€"} <= bands and None in bands  # suppliers have no listing
    assert catalog_misc.g.region_markers(catalog_listing._right_join(spark, d), None).count() == 0


def test_paths_are_exact(spark):
    big = 9007199254740993
    pts = spark.createDataFrame([(1, big, 0), (1, big + 1, 2), (2, None, 3)], "case_id long, x long, y long")
    p = {r.x: (r.prev_x, r.prev_y) for r in pth.with_previous(pts).where("case_id = 1").collect()}
    assert p == {big: (None, None), big + 1: (big, 0)}
    assert [(r.dx, r.dy) for r in pth.steps(pts).where("case_id = 1").orderBy("x").collect()] == [(big, 0), (1, 2)]


def test_cases_without_points_and_long_form(spark):
    pts = spark.createDataFrame([(1, 1, 0), (1, 1, 2), (3, 2, 0), (3, 1, 1)], "case_id long, x long, y long")
    cases = spark.createDataFrame([(1,), (2,), (3,)], "case_id long")
    out = {r.case_id: (r.possible, r.path) for r in pth.monotone_path(pts, cases=cases).collect()}
    assert out == {1: ("YES", "RUU"), 2: ("YES", ""), 3: ("NO", None)}
    moves = [(r.x, r.y, r.rights, r.ups) for r in pth.path_moves(pts).orderBy("x", "y").collect()]
    assert moves == [(1, 0, 1, 0), (1, 2, 0, 2)]


def test_list_literals_round_trip(spark):
    lists = [["chef's table", 'a "b"', "it's \"x\"", "back\\slash", "", "plain"], [], ["[1, 2]", "a, b"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i long, a array<string>")
    out = df.select("i", rel.list_literal(F.col("a")).alias("t"))
    assert [list(r.a) for r in out.select("i", rel.parse_list_literal(F.col("t")).alias("a")).orderBy("i").collect()] == lists
    assert [eval(r.t) for r in out.orderBy("i").collect()] == lists  # noqa: S307 - a Python literal


def test_blanks_and_null_names(spark):
    df = spark.createDataFrame([("a　b c d\x1ce",)], "t string")
    assert df.select(tx.whitespace_tokens(F.col("t")).alias("a")).first().a == list("abcde")
    names = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "id long, name string")
    assert {r.id: r.rank_key for r in rel.rank_key(names, ["name", "id"]).collect()} == {3: 1, 2: 2, 1: 3}


def test_no_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_scratch_scope_removes_its_tables(spark):
    from tessera.sources.files import materialize, scratch_path
    with session.scratch_scope(spark):
        assert materialize(spark.range(5), "x").count() == 5
        path = scratch_path(spark, "y").removeprefix("file:")
        spark.range(2).write.parquet(path)
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_landed_keys_and_texts_are_kept(spark, tmp_path):
    from tessera.sources import files
    rows = [(1, "007", "abc\n"), (1, "1e5", "a\n\n"), (2, "0100", ""), (12, "x", "é\r\n")]
    files.land_pages(spark.createDataFrame(rows, "batch long, url_key string, html string"), f"{tmp_path}/p")
    assert sorted(map(tuple, files.scan_pages(spark, f"{tmp_path}/p").collect())) == rows
    assert [r.key for r in files.scan_pages(spark, f"{tmp_path}/p", 2, 11).collect()] == ["0100"]


def test_page_folders(spark, tmp_path):
    from tessera.sources import files
    rows = [(1, "007", "abc\n"), (2, "a b+c%20", "x"), (11, "é", "y\n"), (2, "0100", "z")]
    for page, key, text in rows:
        folder = tmp_path / f"page_{page}"
        folder.mkdir(exist_ok=True)
        (folder / f"{key}.html").write_text(text, encoding="utf-8")
    assert sorted(map(tuple, files.scan_page_folders(spark, str(tmp_path)).collect())) == sorted(rows)
    assert sorted(r.key for r in files.scan_page_folders(spark, str(tmp_path), 2, 10).collect()) == ["0100", "a b+c%20"]


def test_holes_and_parts(spark, tmp_path):
    import json
    from tessera.operators import geo
    from tessera.sources import files
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 3], [1, 3], [1, 1]]
    far = [[[10, 0], [10, 2], [12, 2], [12, 0], [10, 0]]]
    features = [("A", "Polygon", [square, hole]), ("B", "MultiPolygon", [[square, hole[::-1]], far]), ("C", "Polygon", [square[:-1]])]
    collection = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"reg_name": n}, "geometry": {"type": t, "coordinates": c}} for n, t, c in features]
        + [{"type": "Feature", "properties": {"reg_name": "D"}, "geometry": None}]}
    (tmp_path / "r.json").write_text(json.dumps(collection, indent=1))
    v = files.read_geojson(spark, str(tmp_path), collection=True).withColumnRenamed("reg_name", "region")
    out = {r.region: (r.lon, r.lat, r.area) for r in geo.polygon_centroid(v, part_col="part", ring_col="ring").collect()}
    assert out["A"] == (2.071429, 2.0, 14.0) and out["C"] == (2.0, 2.0, 16.0)
    assert out["B"] == (round((2.0714285714 * 14 + 11 * 4) / 18, 6), round((2 * 14 + 1 * 4) / 18, 6), 18.0)
    names = files.region_names(files.read_features(spark, str(tmp_path), collection=True))
    assert [r.region for r in names.collect()] == ["A", "B", "C", "D"]


def test_saved_index_search_reads_its_terms_only(spark, tmp_path):
    from tessera.operators import index as ix
    docs = spark.createDataFrame([(i, f"term{i % 50} common word{i}") for i in range(300)], "doc_id long, text string")
    built = ix.build_index(docs)
    ix.save_index(built, f"{tmp_path}/ix")
    loaded = ix.load_index(spark, f"{tmp_path}/ix")
    q = srch.query_table(spark, "term7 common")
    small, terms = srch.literal(loaded, "term7 common")
    key = lambda df: [(r.doc_id, r.rank, round(r.score, 9)) for r in df.orderBy("rank").collect()]
    assert key(srch.ranked_search(small, terms)) == key(srch.ranked_search(small, q)) == key(srch.ranked_search(built, q)) == key(srch.ranked_search(loaded, q))
    plan = srch.ranked_search(small, terms)._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [" in plan and "sum(pow" not in plan
    assert srch.conjunctive_search(small, q).count() == 6
