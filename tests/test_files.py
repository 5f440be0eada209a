import json
import os
import tempfile

import pytest

from tessera.sources import files


def test_union_ragged_and_status(spark):
    a = spark.createDataFrame([("x", "r1")], "restaurantName string, region string")
    b = spark.createDataFrame([("y", 1.5)], "restaurantName string, latitude double")
    u = files.union_ragged([a, b]).orderBy("restaurantName").collect()
    assert [(r.restaurantName, r.region, r.latitude) for r in u] == [("x", "r1", None), ("y", None, 1.5)]
    resp = spark.createDataFrame([("u1", 200), ("u2", 404), ("u3", None)], "url string, status int")
    ok, bad = files.keep_ok(resp)
    assert [r.url for r in ok.collect()] == ["u1"]
    assert sorted(r.url for r in bad.collect()) == ["u2", "u3"]


def test_feature_collection_read(spark):
    d = tempfile.mkdtemp(prefix="tessera-geo-")
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"reg_name": "Veneto"},
         "geometry": {"type": "Polygon", "coordinates": [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]]]}}]}
    with open(os.path.join(d, "regions.json"), "w") as f:
        json.dump(fc, f, indent=2)
    v = files.read_geojson(spark, d, collection=True).orderBy("i").collect()
    assert [(r.reg_name, r.ring, r.i, r.lon, r.lat) for r in v][:2] == [("Veneto", 0, 0, 0.0, 0.0), ("Veneto", 0, 1, 2.0, 0.0)]
    assert len(v) == 4


def _collection(names, indent=None, **more):
    features = [{"type": "Feature", "properties": {"note": 'a "quoted" {brace}', "reg_name": n},
                 "geometry": {"type": "Polygon", "coordinates": [[[float(i), 0.0], [2.0, 0.0], [2.0, 2.0], [float(i), 0.0]]]}} for i, n in enumerate(names)]
    return json.dumps({"type": "FeatureCollection", "name": "r", "crs": {"type": "name", "properties": {"name": "x"}}, "features": features} | more, indent=indent)


def test_collection_is_read_in_several_tasks(spark, tmp_path):
    names = [f"region {i}" for i in range(600)]
    (tmp_path / "a.json").write_text(_collection(names, bbox=[1, 2, 3, 4]))
    (tmp_path / "b.json").write_text(_collection(["x", "FeatureCollection", "é"], indent=2) + "\n")
    (tmp_path / "c.json").write_text(_collection([]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        parts = files.read_features(spark, str(tmp_path), collection=True)
        assert parts.rdd.getNumPartitions() > 5
        assert sorted(r.properties.reg_name for r in parts.collect()) == sorted([*names, "x", "FeatureCollection", "é"])
        vertices, whole = (sorted(map(tuple, files.read_geojson(spark, str(tmp_path), collection=True, whole=w).collect())) for w in (False, True))
        assert vertices == whole and len(vertices) == 4 * 603
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("feature", [
    {"properties": {"reg_name": "a"}, "geometry": None, "type": "Feature"}, {"properties": {"reg_name": "a"}, "type": "Feature", "geometry": None},
    {"type": "Feature", "properties": {"kind": "Feature", "reg_name": "a"}, "geometry": None}])
def test_collection_that_cannot_be_cut_is_an_error(spark, tmp_path, feature):
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}))
    with pytest.raises(Exception, match="whole=True"):
        files.read_features(spark, str(tmp_path), collection=True).collect()
    assert [r.properties.reg_name for r in files.read_features(spark, str(tmp_path), collection=True, whole=True).collect()] == ["a", "a"]


def test_outlines_in_bounded_parts(spark, tmp_path):
    rows = [(k, i, float(i), float(-i)) for k, n in (("hot", 5000), ("b", 1), ("c", 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "region string, i long, lon double, lat double").repartition(7)
    files.write_geojson_parts(df, str(tmp_path), size=64)
    features = files.read_features(spark, str(tmp_path))
    assert features.count() > 5031 / 64 and features.selectExpr("max(size(from_json(geometry.coordinates, 'array<array<double>>')))").first()[0] <= 64
    back = files.read_geojson(spark, str(tmp_path)).orderBy("reg_name", "i").collect()
    assert [(r.reg_name, r.lon, r.lat) for r in back] == [(k, x, y) for k, _, x, y in sorted(rows)]


def test_versions_of_a_result(spark, tmp_path):
    """A reader gets the newest complete version; a write that fails leaves the former one."""
    path = str(tmp_path / "r")
    one = files.save_result(spark.createDataFrame([(1, "a", 0.5)], "id long, name string, score double"), path)
    assert [tuple(r) for r in files.read_result(spark, path).collect()] == [(1, "a", 0.5)]
    with pytest.raises(Exception, match="broken"):
        files.save_result(spark.range(100).selectExpr("id", "'x' AS name", "double(if(id = 99, raise_error('broken'), 1)) AS score"), path)
    assert files.read_result(spark, path).count() == 1 == files.result_versions(spark, path).count()
    files.save_result(one.union(one), path)  # reads a version while the next one is written
    assert files.read_result(spark, path).count() == 2 and one.count() == 1
    first = files.result_versions(spark, path).orderBy("saved_at").first().version
    assert files.read_result(spark, path, first).count() == 1


def test_points_text(spark):
    d = tempfile.mkdtemp(prefix="tessera-pts-")
    pts = spark.createDataFrame([(1, 1, 3), (1, 4, 3)], "case_id long, x long, y long")
    files.write_points_text(pts, d + "/p")
    back = sorted(tuple(r) for r in files.read_points_text(spark, d + "/p").collect())
    assert back == [(1, 1, 3), (1, 4, 3)]


def test_tsv_is_read_in_several_tasks(spark, tmp_path):
    """Tabs, quotes, line breaks and backslashes come back from a file that is read in parts."""
    odd = ['a\tb', 'say "x"', "two\nlines", "cr\r\nlf", "back\\slash \\n \\b \\\\", "", None, '"', "\n", "é\t\"\n\\"]
    rows = [(i, odd[i % len(odd)], [odd[i % len(odd)] or "", "x\ny"]) for i in range(4000)]
    df = spark.createDataFrame(rows, "i long, t string, l array<string>")
    for quoted in (False, True):
        path = f"{tmp_path}/{quoted}"
        files.write_tsv(df.coalesce(1), path, quoted=quoted)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        try:
            back = files.read_tsv(spark, path, df.schema, quoted=quoted)
            assert (back.rdd.getNumPartitions() > 3) is not quoted
            if not quoted:
                assert sorted(map(tuple, back.collect())) == sorted((i, t, l) for i, t, l in rows)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
