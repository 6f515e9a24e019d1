"""Planar geometry as Column math.

A polygon is ``array<array<struct<x: double, y: double>>>``: closed rings, the
first ring is the shell, the following ones are holes (any orientation).
Areas and centroids are shoelace sums over the ring vertices with array
higher-order functions, so they stay inside the JVM.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from terrasol.functions.common import col


def point(x, y) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def rectangle_ring(x0, y0, x1, y1) -> Column:
    """Closed counter-clockwise ring of an axis-aligned rectangle."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def _ring_sum(ring: Column, term) -> Column:
    n = F.size(ring)
    return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), F.lit(0.0),
                       lambda acc, i: acc + F.when(n >= 2, term(F.get(ring, i), F.get(ring, i + 1))).otherwise(0.0))


def ring_signed_area(ring: Column) -> Column:
    """Shoelace signed area of a closed ring (positive when counter-clockwise)."""
    return _ring_sum(ring, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]) / 2


def polygon_area(rings) -> Column:
    """|shell| − Σ|holes|."""
    r = col(rings)
    areas = F.transform(r, lambda ring: F.abs(ring_signed_area(ring)))
    holes = F.aggregate(F.slice(areas, 2, 1 << 30), F.lit(0.0), lambda acc, a: acc + a)
    return F.coalesce(F.get(areas, 0), F.lit(0.0)) - holes


def centroid(rings) -> Column:
    """Area-weighted centroid struct(x, y) of shell minus holes (G2), computed in
    a frame centred on the first shell vertex so products stay exact."""
    o = F.get(F.get(col(rings), 0), 0)
    r = F.transform(col(rings), lambda ring: F.transform(
        ring, lambda p: F.struct((p["x"] - o["x"]).alias("x"), (p["y"] - o["y"]).alias("y"))))

    def moments(ring, i):
        a = ring_signed_area(ring)
        mx = _ring_sum(ring, lambda p, q: (p["x"] + q["x"]) * (p["x"] * q["y"] - q["x"] * p["y"])) / 6
        my = _ring_sum(ring, lambda p, q: (p["y"] + q["y"]) * (p["x"] * q["y"] - q["x"] * p["y"])) / 6
        role = F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        sgn = F.signum(a)
        return F.struct((role * F.abs(a)).alias("a"), (role * sgn * mx).alias("mx"), (role * sgn * my).alias("my"))

    m = F.transform(r, moments)
    tot = F.aggregate(m, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")),
                      lambda acc, x: F.struct((acc["a"] + x["a"]).alias("a"), (acc["mx"] + x["mx"]).alias("mx"),
                                              (acc["my"] + x["my"]).alias("my")))
    return F.struct((o["x"] + tot["mx"] / tot["a"]).alias("x"), (o["y"] + tot["my"] / tot["a"]).alias("y"))


def bbox(rings) -> Column:
    """struct(minx, miny, maxx, maxy) of the shell."""
    shell = F.get(col(rings), 0)
    xs = F.transform(shell, lambda p: p["x"])
    ys = F.transform(shell, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


# GRS80 ellipsoid and the projections used per territory (public EPSG parameters).
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
LCC_2154 = dict(lat0=46.5, lon0=3.0, lat1=49.0, lat2=44.0, fe=700000.0, fn=6600000.0)
UTM = {5490: (-63.0, 0.0), 2972: (-51.0, 0.0), 2975: (57.0, 10000000.0), 4471: (45.0, 10000000.0)}
UTM_K0 = 0.9996
UTM_FE = 500000.0


def _e2() -> float:
    f = 1 / GRS80_INV_F
    return 2 * f - f * f


def lcc_2154(lon, lat) -> Column:
    """Lambert Conformal Conic 2SP (EPSG:2154) of lon/lat degrees → struct(x, y) metres."""
    e2 = _e2()
    e = math.sqrt(e2)
    p = LCC_2154
    rad = math.pi / 180

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = p["lat1"] * rad, p["lat2"] * rad, p["lat0"] * rad
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    r0 = GRS80_A * big_f * t(p0) ** n
    phi = col(lat) * rad
    es = F.lit(e) * F.sin(phi)
    tc = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(e / 2))
    r = F.lit(GRS80_A * big_f) * F.pow(tc, F.lit(n))
    theta = F.lit(n) * (col(lon) - p["lon0"]) * rad
    return F.struct((F.lit(p["fe"]) + r * F.sin(theta)).alias("x"),
                    (F.lit(p["fn"] + r0) - r * F.cos(theta)).alias("y"))


def utm(lon, lat, srid: int) -> Column:
    """Transverse Mercator (UTM zones of the overseas territories) → struct(x, y)."""
    lon0, fn = UTM[srid]
    e2 = _e2()
    ep2 = e2 / (1 - e2)
    rad = math.pi / 180
    phi = col(lat) * rad
    lam = (col(lon) - lon0) * rad
    sin_p, cos_p, tan_p = F.sin(phi), F.cos(phi), F.tan(phi)
    nu = F.lit(GRS80_A) / F.sqrt(1 - F.lit(e2) * sin_p * sin_p)
    t = tan_p * tan_p
    c = F.lit(ep2) * cos_p * cos_p
    a = cos_p * lam
    e4, e6 = e2 * e2, e2 * e2 * e2
    mer = F.lit(GRS80_A) * (
        F.lit(1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - F.lit(3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + F.lit(15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - F.lit(35 * e6 / 3072) * F.sin(6 * phi))
    x = F.lit(UTM_K0) * nu * (a + (1 - t + c) * F.pow(a, 3) / 6
                              + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120)
    y = F.lit(UTM_K0) * (mer + nu * tan_p * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24
                                             + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720))
    return F.struct((F.lit(UTM_FE) + x).alias("x"), (F.lit(fn) + y).alias("y"))


def project(lon, lat, srid) -> Column:
    """lon/lat → projected struct(x, y) for the territory CRS in column ``srid``."""
    s = col(srid)
    out = F.when(s == 2154, lcc_2154(lon, lat))
    for code in UTM:
        out = out.when(s == code, utm(lon, lat, code))
    return out


def geojson_polygon(rings) -> Column:
    """GeoJSON geometry string of a polygon."""
    coords = F.transform(col(rings), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")))


from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType  # noqa: E402

RINGS_TYPE = ArrayType(ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])))


POLYGONS_TYPE = ArrayType(RINGS_TYPE)


def decode_wkb_polygons(s):
    """Little/big-endian WKB Polygon / MultiPolygon → every polygon's rings (G1).

    Z and M ordinates (ISO and extended codes) are skipped; another geometry
    type raises."""
    import struct as st

    import pandas as pd

    def polygon(b, off):
        end = "<" if b[off] == 1 else ">"
        code = st.unpack_from(end + "I", b, off + 1)[0]
        dims = 2 + (bool(code & 0x80000000) + bool(code & 0x40000000) or {0: 0, 1: 1, 2: 1, 3: 2}[code % 0x10000000 // 1000])
        kind, off = (code & 0xFFFF) % 1000, off + 5 + 4 * bool(code & 0x20000000)
        n = st.unpack_from(end + "I", b, off)[0]
        off += 4
        if kind == 6:
            parts = []
            for _ in range(n):
                part, off = polygon(b, off)
                parts += part
            return parts, off
        if kind != 3:
            raise ValueError(f"WKB geometry type {kind} is no polygon")
        rings = []
        for _ in range(n):
            k = st.unpack_from(end + "I", b, off)[0]
            xy = st.unpack_from(f"{end}{dims * k}d", b, off + 4)
            off += 4 + 8 * dims * k
            rings.append([{"x": xy[dims * i], "y": xy[dims * i + 1]} for i in range(k)])
        return [rings], off

    return pd.Series([None if b is None else polygon(bytes(b), 0)[0] for b in s])


def encode_wkb_polygons(s):
    """Polygons (lists of rings) → little-endian WKB: one polygon as Polygon, any other number as MultiPolygon (G1)."""
    import struct as st

    import pandas as pd

    def polygon(rings):
        out = [st.pack("<BII", 1, 3, len(rings))]
        for ring in rings:
            out.append(st.pack(f"<I{2 * len(ring)}d", len(ring), *(v for p in ring for v in (p["x"], p["y"]))))
        return b"".join(out)

    return pd.Series([None if polys is None else polygon(polys[0]) if len(polys) == 1
                      else st.pack("<BII", 1, 6, len(polys)) + b"".join(polygon(p) for p in polys) for polys in s])


def _decode_arrow(s: pa.Array) -> pa.Array:
    point_type = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    return pa.array(decode_wkb_polygons(s.to_pylist()).tolist(), pa.list_(pa.list_(pa.list_(point_type))))


def _encode_arrow(s: pa.Array) -> pa.Array:
    return pa.array(encode_wkb_polygons(s.to_pylist()).tolist(), pa.binary())


# Arrow lists: nested rings of different lengths do not fit numpy arrays
polygons_from_wkb = F.arrow_udf(_decode_arrow, POLYGONS_TYPE)
wkb_from_polygons = F.arrow_udf(_encode_arrow, BinaryType())


def _lcc_constants():
    e2 = _e2()
    e = math.sqrt(e2)
    p = LCC_2154
    rad = math.pi / 180

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = p["lat1"] * rad, p["lat2"] * rad, p["lat0"] * rad
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    r0 = GRS80_A * big_f * t(p0) ** n
    return e, n, big_f, r0


def lcc_2154_inverse(x, y, iterations: int = 8) -> Column:
    """EPSG:2154 metres → struct(lon, lat) degrees (G4 inverse); latitude by
    fixed-point iteration of the conformal latitude equation."""
    e, n, big_f, r0 = _lcc_constants()
    p = LCC_2154
    dx = col(x) - p["fe"]
    dy = F.lit(r0) - (col(y) - p["fn"])
    r = F.signum(F.lit(n)) * F.sqrt(dx * dx + dy * dy)
    t = F.pow(r / (GRS80_A * big_f), F.lit(1 / n))
    theta = F.atan2(dx, dy)
    def step(acc, _i):
        es = F.lit(e) * F.sin(acc)
        return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - es) / (1 + es), F.lit(e / 2)))

    phi = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), F.lit(math.pi / 2) - 2 * F.atan(t), step)
    return F.struct((F.degrees(theta / n) + p["lon0"]).alias("lon"), F.degrees(phi).alias("lat"))


def utm_inverse(x, y, srid: int) -> Column:
    """UTM metres → struct(lon, lat) degrees (footpoint-latitude series) (G4 inverse)."""
    lon0, fn = UTM[srid]
    e2 = _e2()
    ep2 = e2 / (1 - e2)
    e4, e6 = e2 * e2, e2 * e2 * e2
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mer = (col(y) - fn) / UTM_K0
    mu = mer / (GRS80_A * (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256))
    phi1 = (mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * F.sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * F.sin(4 * mu)
            + (151 * e1 ** 3 / 96) * F.sin(6 * mu) + (1097 * e1 ** 4 / 512) * F.sin(8 * mu))
    s1, c1, t1 = F.sin(phi1), F.cos(phi1), F.tan(phi1)
    n1 = F.lit(GRS80_A) / F.sqrt(1 - F.lit(e2) * s1 * s1)
    r1 = F.lit(GRS80_A * (1 - e2)) / F.pow(1 - F.lit(e2) * s1 * s1, F.lit(1.5))
    tt, cc = t1 * t1, F.lit(ep2) * c1 * c1
    d = (col(x) - UTM_FE) / (n1 * UTM_K0)
    lat = phi1 - (n1 * t1 / r1) * (d * d / 2 - (5 + 3 * tt + 10 * cc - 4 * cc * cc - 9 * ep2) * F.pow(d, 4) / 24
                                   + (61 + 90 * tt + 298 * cc + 45 * tt * tt - 252 * ep2 - 3 * cc * cc) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * tt + cc) * F.pow(d, 3) / 6
           + (5 - 2 * cc + 28 * tt - 3 * cc * cc + 8 * ep2 + 24 * tt * tt) * F.pow(d, 5) / 120) / c1
    return F.struct((F.degrees(lon) + lon0).alias("lon"), F.degrees(lat).alias("lat"))


def unproject(x, y, srid) -> Column:
    """Projected struct → lon/lat for the territory CRS in column ``srid``."""
    s = col(srid)
    out = F.when(s == 2154, lcc_2154_inverse(x, y))
    for code in UTM:
        out = out.when(s == code, utm_inverse(x, y, code))
    return out


def rings_to_wgs84(rings, srid) -> Column:
    """Every vertex of a projected polygon back to lon/lat (x = lon, y = lat)."""
    def vertex(p):
        ll = unproject(p["x"], p["y"], srid)
        return F.struct(ll["lon"].alias("x"), ll["lat"].alias("y"))
    return F.transform(col(rings), lambda ring: F.transform(ring, vertex))


def _np_unproject(x, y, srid: int):
    """numpy twin of :func:`unproject` for vertex arrays (used on whole rings)."""
    import numpy as np
    e2 = _e2()
    if srid == 2154:
        e, n, big_f, r0 = _lcc_constants()
        p = LCC_2154
        dx, dy = x - p["fe"], r0 - (y - p["fn"])
        r = np.sign(n) * np.sqrt(dx * dx + dy * dy)
        t = (r / (GRS80_A * big_f)) ** (1 / n)
        phi = math.pi / 2 - 2 * np.arctan(t)
        for _ in range(8):
            es = e * np.sin(phi)
            phi = math.pi / 2 - 2 * np.arctan(t * ((1 - es) / (1 + es)) ** (e / 2))
        return np.degrees(np.arctan2(dx, dy) / n) + p["lon0"], np.degrees(phi)
    lon0, fn = UTM[srid]
    ep2 = e2 / (1 - e2)
    e4, e6 = e2 * e2, e2 * e2 * e2
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (y - fn) / UTM_K0 / (GRS80_A * (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256))
    phi1 = (mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * np.sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * np.sin(4 * mu)
            + (151 * e1 ** 3 / 96) * np.sin(6 * mu) + (1097 * e1 ** 4 / 512) * np.sin(8 * mu))
    s1, c1, t1 = np.sin(phi1), np.cos(phi1), np.tan(phi1)
    n1 = GRS80_A / np.sqrt(1 - e2 * s1 * s1)
    r1 = GRS80_A * (1 - e2) / (1 - e2 * s1 * s1) ** 1.5
    tt, cc = t1 * t1, ep2 * c1 * c1
    d = (x - UTM_FE) / (n1 * UTM_K0)
    lat = phi1 - (n1 * t1 / r1) * (d * d / 2 - (5 + 3 * tt + 10 * cc - 4 * cc * cc - 9 * ep2) * d ** 4 / 24
                                   + (61 + 90 * tt + 298 * cc + 45 * tt * tt - 252 * ep2 - 3 * cc * cc) * d ** 6 / 720)
    lon = (d - (1 + 2 * tt + cc) * d ** 3 / 6 + (5 - 2 * cc + 28 * tt - 3 * cc * cc + 8 * ep2 + 24 * tt * tt) * d ** 5 / 120) / c1
    return np.degrees(lon) + lon0, np.degrees(lat)


def _rings_to_wgs84(rings, srids):
    import numpy as np
    import pandas as pd
    out = []
    for poly, srid in zip(rings, srids):
        if poly is None or srid is None or int(srid) not in (2154, *UTM):
            out.append(None)
            continue
        res = []
        for ring in poly:
            xs = np.array([p["x"] for p in ring], dtype=float)
            ys = np.array([p["y"] for p in ring], dtype=float)
            lon, lat = _np_unproject(xs, ys, int(srid))
            res.append([{"x": float(a), "y": float(b)} for a, b in zip(lon, lat)])
        out.append(res)
    return pd.Series(out)


# Whole polygons back to lon/lat in Arrow batches (compact for the planner).
rings_to_wgs84_udf = F.pandas_udf(_rings_to_wgs84, RINGS_TYPE)
