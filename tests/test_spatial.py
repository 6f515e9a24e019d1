import numpy as np
import pandas as pd

from terrasol.functions import geo
from terrasol.operators.spatial import intersection_area_and_intersects, spatial_left_join


def ring(*pts):
    pts = list(pts) + [pts[0]]
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def _inside(poly, x, y):
    """Even-odd point-in-polygon over all rings (holes subtract)."""
    c = np.zeros_like(x, dtype=bool)
    for r in poly:
        xs = np.array([p["x"] for p in r]); ys = np.array([p["y"] for p in r])
        for i in range(len(r) - 1):
            x1, y1, x2, y2 = xs[i], ys[i], xs[i + 1], ys[i + 1]
            cross = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / np.where(y2 == y1, 1, y2 - y1) + x1)
            c ^= cross
    return c


def _grid_area(a, b, lo=-5, hi=25):
    g = np.arange(lo, hi, 0.25) + 0.125
    x, y = np.meshgrid(g, g)
    return float((_inside(a, x, y) & _inside(b, x, y)).sum()) * 0.0625


L_SHAPE = [ring((0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10))]          # concave
HOLED = [ring((2, 2), (14, 2), (14, 14), (2, 14)), ring((5, 5), (5, 11), (11, 11), (11, 5))]
CW_SQUARE = [list(reversed(ring((3, 3), (8, 3), (8, 8), (3, 8))))]
TOUCH = [ring((10, 0), (12, 0), (12, 4), (10, 4))]                            # shares an edge with L
FAR = [ring((20, 20), (22, 20), (22, 22), (20, 22))]
IN_HOLE = [ring((6, 6), (7, 6), (7, 7), (6, 7))]


def test_exact_area_against_grid():
    pairs = [(L_SHAPE, HOLED), (L_SHAPE, CW_SQUARE), (HOLED, CW_SQUARE), (L_SHAPE, TOUCH), (L_SHAPE, FAR),
             (HOLED, IN_HOLE)]
    res = intersection_area_and_intersects(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    for (a, b), area in zip(pairs, res.area):
        assert abs(area - _grid_area(a, b)) < 1e-6
    assert list(res.intersects) == [True, True, True, True, False, False]


def test_spatial_left_join_keeps_unmatched(spark):
    left = spark.createDataFrame([(1, 2154, L_SHAPE), (2, 2154, FAR), (3, 5490, L_SHAPE)],
                                 "id long, srid int, geom array<array<struct<x:double,y:double>>>")
    right = spark.createDataFrame([("a", 2154, HOLED), ("b", 2154, TOUCH), ("c", 2154, IN_HOLE)],
                                  "cid string, srid int, rgeom array<array<struct<x:double,y:double>>>")
    out = spatial_left_join(left, right, "geom", "rgeom", cell=3.0, max_cells=4)
    got = sorted((r.id, r.cid, round(r.geom_intersection_area or 0, 6)) for r in out.collect())
    assert got == [(1, "a", _grid_area(L_SHAPE, HOLED)), (1, "b", 0.0), (2, None, 0.0), (3, None, 0.0)]


def test_area_and_centroid(spark):
    df = spark.createDataFrame([(L_SHAPE,), (HOLED,)], "g array<array<struct<x:double,y:double>>>")
    r = df.select(geo.polygon_area("g").alias("a"), geo.centroid("g").alias("c")).collect()
    assert r[0].a == 64.0 and r[1].a == 108.0
    assert abs(r[1].c.x - 8.0) < 1e-9 and abs(r[1].c.y - 8.0) < 1e-9


def test_projection_round_trip(spark):
    from pyspark.sql import functions as F
    pts = [(2154, 2.35, 48.85), (2154, -4.5, 43.3), (5490, -61.5, 16.2), (2972, -53.0, 4.9),
           (2975, 55.5, -21.1), (4471, 45.1, -12.8)]
    df = spark.createDataFrame(pts, "srid int, lon double, lat double")
    xy = df.select("srid", "lon", "lat", geo.project("lon", "lat", "srid").alias("p"))
    back = xy.select("lon", "lat", geo.unproject(F.col("p.x"), F.col("p.y"), "srid").alias("b")).collect()
    for r in back:
        assert abs(r.b.lon - r.lon) < 1e-7 and abs(r.b.lat - r.lat) < 1e-7
    origin = spark.createDataFrame([(3.0, 46.5)], "lon double, lat double").select(
        geo.lcc_2154("lon", "lat").alias("p")).collect()[0].p
    assert abs(origin.x - 700000.0) < 1e-6 and abs(origin.y - 6600000.0) < 1e-6   # projection origin


def test_ring_unprojection_matches_columns():
    import pandas as pd
    ring = [[{"x": 652301.5648305281, "y": 6861302.725899576}, {"x": 700000.0, "y": 6600000.0}]]
    out = geo._rings_to_wgs84(pd.Series([ring]), pd.Series([2154]))[0][0]
    assert abs(out[0]["x"] - 2.35) < 1e-9 and abs(out[0]["y"] - 48.85) < 1e-9
    assert abs(out[1]["x"] - 3.0) < 1e-9 and abs(out[1]["y"] - 46.5) < 1e-9


def test_repeated_park_ids_and_levels_keep_their_partners(spark):
    """Rows that repeat an id keep their own partners; fine and coarse cells give the same pairs."""
    import random
    rng = random.Random(5)

    def rect(big):
        x, y = rng.uniform(0, 60), rng.uniform(0, 60)
        w, h = (rng.uniform(1, 5) * (9 if big else 1) for _ in range(2))
        pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
        return [[{"x": a, "y": b} for a, b in pts]], (x, y, x + w, y + h)

    parks = [(k % 7, 2154 if k % 3 else 5490, 2000 + k, *rect(k % 5 == 0)) for k in range(25)]
    covers = [(f"c{k}", 2154 if k % 2 else 5490, *rect(k % 6 == 0)) for k in range(30)]
    want = sorted((p[2], c[0], round(max(0, min(p[4][2], c[3][2]) - max(p[4][0], c[3][0])) * max(0, min(p[4][3], c[3][3]) - max(p[4][1], c[3][1])), 6))
                  for p in parks for c in covers if p[1] == c[1] and p[4][0] <= c[3][2] and c[3][0] <= p[4][2] and p[4][1] <= c[3][3] and c[3][1] <= p[4][3])
    left = spark.createDataFrame([p[:4] for p in parks], "id long, srid int, millesime int, geom array<array<struct<x:double,y:double>>>")
    right = spark.createDataFrame([c[:3] for c in covers], "cid string, srid int, rgeom array<array<struct<x:double,y:double>>>")
    for cell, most in ((2.0, 4), (2.0, 10_000), (50.0, 64)):
        out = spatial_left_join(left, right, "geom", "rgeom", cell=cell, max_cells=most).collect()
        assert sorted((r.millesime, r.cid, round(r.geom_intersection_area, 6)) for r in out if r.cid) == want
        assert len({r.millesime for r in out}) == 25


def test_slices_do_not_change_areas(monkeypatch):
    from terrasol.operators import spatial
    pairs = [(L_SHAPE, HOLED), (HOLED, CW_SQUARE), (L_SHAPE, TOUCH)]
    want = [spatial._overlap(a, b) for a, b in pairs]
    monkeypatch.setattr(spatial, "SLICE", 1)
    assert [spatial._overlap(a, b) for a, b in pairs] == want


def test_intersection_polygons():
    from terrasol.operators.spatial import intersection_polygons

    def area(polys):
        total = 0.0
        for rings in polys:
            p = [(q["x"], q["y"]) for q in rings[0]]
            assert p[0] == p[-1] and len(rings) == 1
            total += sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:])) / 2
        return total

    for a, b in ((L_SHAPE, HOLED), (L_SHAPE, CW_SQUARE), (HOLED, CW_SQUARE), (L_SHAPE, TOUCH), (L_SHAPE, FAR), (HOLED, IN_HOLE)):
        assert abs(area(intersection_polygons(a, b)) - _grid_area(a, b)) < 1e-6
    ring = lambda *p: [[{"x": float(x), "y": float(y)} for x, y in p]]
    diamond, square = ring((0, 2), (2, 0), (4, 2), (2, 4), (0, 2)), ring((0, 0), (2, 0), (2, 4), (0, 4), (0, 0))
    assert abs(area(intersection_polygons(diamond, square)) - 4.0) < 1e-9
    rect = ring((1, 1), (3, 1), (3, 5), (1, 5), (1, 1))
    assert intersection_polygons(rect, ring((2, 0), (9, 0), (9, 3), (2, 3), (2, 0))) == [ring((2, 1), (3, 1), (3, 3), (2, 3), (2, 1))]
    assert intersection_polygons(rect, None) == []


def test_latest_vintage_by_given_columns(spark):
    from terrasol.operators.cover import latest_vintage
    rows = [(1, 2020, "c", 2015), (1, 2020, "c", 2018), (1, 2019, "c", 2015), (1, 2019, "c", 2018), (2, 2020, None, None)]
    link = spark.createDataFrame(rows, "id long, millesime int, id_1 string, millesime_ocs int")
    key = lambda df: sorted((r.id, r.millesime, r.millesime_ocs or 0) for r in df.collect())
    assert key(latest_vintage(link)) == [(2, 2020, 0)]   # two rows share the latest vintage: none is kept
    assert key(latest_vintage(link, ("id", "millesime", "id_1"))) == [(1, 2019, 2018), (1, 2020, 2018), (2, 2020, 0)]


def _star(n, cx, cy, r, wave=0.2, teeth=40):
    t = np.linspace(0, 2 * np.pi, n, endpoint=False)
    rr = r * (1 + wave * np.sin(teeth * t))
    return np.stack([cx + rr * np.cos(t), cy + rr * np.sin(t)], axis=1)


def _as_ring(pts):
    pts = [*pts.tolist(), pts[0].tolist()]
    return [{"x": x, "y": y} for x, y in pts]


def test_strips_equal_triangle_clipping():
    from terrasol.operators import spatial
    pairs = [([_as_ring(_star(600, 0, 0, 10))], [_as_ring(_star(500, 6, 1, 9, teeth=23))]), (HOLED, L_SHAPE), (HOLED, IN_HOLE), (L_SHAPE, TOUCH),
             ([_as_ring(_star(300, 0, 0, 10)), _as_ring(_star(200, 0, 0, 4)[::-1])], [_as_ring(_star(300, 1, 0, 3))])]
    for a, b in pairs:
        ea, eb = (spatial._segments(g).reshape(-1, 4) for g in (a, b))
        lo, hi = max(ea[:, [1, 3]].min(), eb[:, [1, 3]].min()), min(ea[:, [1, 3]].max(), eb[:, [1, 3]].max())
        cuts = np.linspace(lo, hi, 8)
        parts = [spatial.strip_overlap(ea, eb, u, v) for u, v in zip(cuts[:-1], cuts[1:])]
        area, meets = spatial._overlap(a, b)
        got = sum(p[0] for p in parts)
        assert abs(got - area) < 1e-6 * max(1, area)
        assert (got > 1e-9 or any(p[1] for p in parts)) == meets


def test_large_polygons_are_cut_into_strips(spark):
    from terrasol.operators import spatial
    shape = "srid int, {} array<array<struct<x:double,y:double>>>"
    big, other = _star(20_000, 0, 0, 1000, 0.0), _star(20_000, 1000, 0, 1000, 0.0)
    left = spark.createDataFrame([(1, 2154, [_as_ring(big)]), (2, 2154, L_SHAPE), (3, 2154, [_as_ring(_star(9000, 5000, 0, 10, 0.0))])], "id long, " + shape.format("geom"))
    right = spark.createDataFrame([("a", 2154, [_as_ring(other)]), ("b", 2154, HOLED), ("c", 2154, [_as_ring(_star(5000, 0, 0, 100, 0.0))])], "cid string, " + shape.format("rgeom"))
    out = {(r.id, r.cid): r.geom_intersection_area for r in spatial_left_join(left, right, "geom", "rgeom", cell=100.0).collect()}
    lens = 1000 ** 2 * (2 * np.pi / 3 - np.sqrt(3) / 2)
    assert abs(out[1, "a"] - lens) < lens * 1e-6 and abs(out[1, "c"] - np.pi * 1e4) < 1
    assert abs(out[1, "b"] - 108) < 1e-6 and out[3, None] is None
    assert abs(out[2, "a"] - _overlap_of(L_SHAPE, other)) < 1e-6
    assert spatial.HEAVY < 20_000


def _overlap_of(a, pts):
    from terrasol.operators import spatial
    return spatial._overlap(a, [_as_ring(pts)])[0]


def test_touching_in_bounded_memory():
    import tracemalloc
    from terrasol.operators import spatial
    a, b = (spatial._segments([_as_ring(_star(20_000, x, 0, 1000, 0.0))]) for x in (0, 2500))
    inner = spatial._segments([_as_ring(_star(20_000, 0, 0, 900, 0.0))])
    tracemalloc.start()
    assert not spatial._touch_flat(a, b) and not spatial._touch_flat(a, inner)
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_batched_pairs_equal_single_pairs():
    import pyarrow as pa
    from terrasol.operators import spatial
    rng = np.random.default_rng(8)
    shapes = [L_SHAPE, HOLED, CW_SQUARE, TOUCH, FAR, IN_HOLE, [], None, [ring((0, 0), (1, 1))], [ring((0, 0), (4, 0), (8, 0))]]
    shapes += [[_as_ring(_star(int(rng.integers(3, 60)), *rng.uniform(0, 12, 2), rng.uniform(1, 9), teeth=5))] for _ in range(30)]
    shapes += [[_as_ring(_star(40, 6e5, 6.6e6, 500))], [_as_ring(_star(40, 6e5 + 300, 6.6e6, 500, 0.0)[::-1]), _as_ring(_star(9, 6e5 + 300, 6.6e6, 50))]]
    pairs = [(a, b) for a in shapes for b in shapes]
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    a, b = (pa.array([p[k] for p in pairs], kind) for k in (0, 1))
    for lo, n in ((0, len(pairs)), (7, 100)):   # a slice of a column as well
        got = spatial._pair(a.slice(lo, n), b.slice(lo, n))
        for (x, y), g in zip(pairs[lo:lo + n], got.to_pylist()):
            area, meets = spatial._overlap(x, y)
            assert abs(g["area"] - area) <= 1e-9 * max(1.0, area) and g["intersects"] == meets


def test_no_side_of_the_spatial_join_is_broadcast(spark):
    square = "array(array(struct({0} AS x, 0D AS y), struct({0} + 1 AS x, 0D AS y), struct({0} + 1 AS x, 1D AS y), struct({0} AS x, 1D AS y), struct({0} AS x, 0D AS y)))"
    left = spark.range(20).selectExpr("id", "2154 AS srid", square.format("CAST(id AS double)") + " AS geom")
    right = spark.range(20).selectExpr("id AS id_1", "2154 AS srid", square.format("(id + 0.5D)") + " AS geom_1")
    link = spatial_left_join(left, right, "geom", "geom_1", cell=4.0)
    plan = link._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    got = {(r.id, r.id_1): r.geom_intersection_area for r in link.collect()}
    assert got[3, 3] == got[3, 2] == 0.5 and len(got) == 39
