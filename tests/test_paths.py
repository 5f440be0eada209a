import random

from tessera.operators import paths as pth
from tessera.operators import geo as g


def _py_path(points):
    """Plain-Python mirror of the package walk."""
    x0 = y0 = 0
    path = ""
    for x, y in sorted(points):
        if x < x0 or y < y0:
            return "NO", None
        path += "R" * (x - x0) + "U" * (y - y0)
        x0, y0 = x, y
    return "YES", path


def test_golden_cases(spark):
    """FIXTURES §4.4."""
    rows = [(1, 1, 3), (1, 1, 2), (1, 3, 3), (1, 5, 5), (1, 4, 3), (2, 1, 0), (2, 0, 1), (3, 4, 3)]
    df = spark.createDataFrame(rows, "case_id long, x long, y long")
    got = {r.case_id: (r.possible, r.path) for r in pth.monotone_path(df).collect()}
    assert got == {1: ("YES", "RUUURRRRUU"), 2: ("NO", None), 3: ("YES", "RRRRUUU")}


def test_path_in_chunks(spark):
    """Chunks joined are the path, for jumps over many chunks, many points a
    chunk, repeated points, points at the origin and cases without a path."""
    rnd = random.Random(11)
    by_case = {0: [(i // 3, i // 2) for i in range(700)], 1: [(0, 0)], 2: [(500, 333)], 3: [(1, 5), (2, 4)], 4: [(0, 0), (3, 0), (3, 0), (3, 9)], 5: [(-1, 2)]}
    for c in range(6, 60):
        x = y = 0
        by_case[c] = []
        for _ in range(rnd.randint(1, 9)):
            x, y = x + rnd.randint(0, 20), y + rnd.randint(0, 20)
            by_case[c].append((x, y))
    df = spark.createDataFrame([(c, x, y) for c, p in by_case.items() for x, y in p], "case_id long, x long, y long")
    for size in (1, 7, 65_536):
        got = {}
        for r in pth.path_chunks(df, size=size).orderBy("case_id", "chunk").collect():
            assert r.chunk * size == len(got.get(r.case_id, "")) and 0 < len(r.path) <= size
            got[r.case_id] = got.get(r.case_id, "") + r.path
        assert got == {c: path for c, p in by_case.items() if (path := _py_path(p)[1])}
    assert pth.path_chunks(df.limit(0)).count() == 0


def test_marker_frames(spark):
    rows = [("A", "€", 1.0, 5.0), ("A", "€€", 3.0, 4.0), ("A", "cheap", 9.0, 9.0), (None, "€", 7.0, 7.0), ("B", None, 2.0, 2.0)]
    geo = spark.createDataFrame(rows, "region string, priceRange string, latitude double, longitude double")
    picks = spark.createDataFrame([("A",), ("B",), (None,)], "region string")
    out = {r.region: tuple(r)[1:] for r in g.marker_frames(geo, picks).collect()}
    assert out == {"A": (2, 1.0, 3.0, 4.0, 5.0), "B": (0, None, None, None, None), None: (0, None, None, None, None)}


def test_route_lengths(spark):
    """16 steps in x order, 11 when (0,2) comes first (prose example)."""
    pts = [(1, i, 0) for i in range(1, 8)] + [(1, 0, 2)]
    df = spark.createDataFrame(pts, "case_id long, x long, y long")
    # sorted (x, y) order visits (0,2) first: 2 up, 2 down + 1 right, 6 right = 11
    assert pth.tour_length(df).first().steps == 11


def test_hot_case_across_partitions(spark):
    """One case holds most points and spans several range partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rnd = random.Random(7)
        pts = [(0, i // 3, i // 2) for i in range(3000)]              # hot, feasible staircase
        pts += [(c, rnd.randint(0, 6), rnd.randint(0, 6)) for c in range(1, 200) for _ in range(4)]
        df = spark.createDataFrame(pts, "case_id long, x long, y long")
        got = {r.case_id: (r.possible, r.path) for r in pth.monotone_path(df).collect()}
        by_case = {}
        for c, x, y in pts:
            by_case.setdefault(c, []).append((x, y))
        assert got == {c: _py_path(p) for c, p in by_case.items()}
        lengths = {r.case_id: r.steps for r in pth.tour_length(df).collect()}
        for c, p in by_case.items():
            x0 = y0 = 0
            n = 0
            for x, y in sorted(p):
                n += abs(x - x0) + abs(y - y0)
                x0, y0 = x, y
            assert lengths[c] == n
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_centroid_of_square_and_triangle(spark):
    ring = [("sq", 0, 0.0, 0.0), ("sq", 1, 2.0, 0.0), ("sq", 2, 2.0, 2.0), ("sq", 3, 0.0, 2.0),
            ("tr", 0, 0.0, 0.0), ("tr", 1, 3.0, 0.0), ("tr", 2, 0.0, 3.0)]
    df = spark.createDataFrame(ring, "region string, i long, lon double, lat double")
    got = {r.region: (r.lon, r.lat, r.area) for r in g.polygon_centroid(df).collect()}
    assert got == {"sq": (1.0, 1.0, 4.0), "tr": (1.0, 1.0, 4.5)}
