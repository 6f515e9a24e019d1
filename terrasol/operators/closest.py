"""Which pairs of dense cubes have two points within eps: closest pairs by cell halving.

Both cubes of a pair are halved in every direction, round by round, and only cells
that may still hold a pair within eps go on: two cells whose boxes are farther apart
are dropped, and the first two cells whose places are near enough settle the whole
pair with one witness.  Places are never paired with places; a pair of cells that
hold one place each is decided by the exact distance.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.sources.io import staged

AXES = ("x", "y", "z")
WGS84_A, WGS84_F = 6378.137, 1 / 298.257223563
EARTH_RADIUS_KM = 6371.0088


def position(lat: str, lon: str, metric: str) -> list[Column]:
    """Straight-line coordinates (km): on the sphere for haversine, on the ellipsoid for geodesic distances."""
    rad = math.pi / 180
    p, l = F.col(lat) * rad, F.col(lon) * rad
    if metric == "haversine":
        r, squeeze = F.lit(EARTH_RADIUS_KM), 1.0
    else:
        e2 = WGS84_F * (2 - WGS84_F)
        r, squeeze = F.lit(WGS84_A) / F.sqrt(1 - e2 * F.sin(p) * F.sin(p)), 1 - e2
    return [(r * F.cos(p) * F.cos(l)).alias("x"), (r * F.cos(p) * F.sin(l)).alias("y"), (r * squeeze * F.sin(p)).alias("z")]


def chord_bounds(eps_km: float, metric: str) -> tuple[float, float]:
    """Straight lines up to the first are within eps along the surface; lines beyond the second are not."""
    radius = EARTH_RADIUS_KM if metric == "haversine" else WGS84_A * (1 - WGS84_F) ** 2  # least radius of curvature
    within = 2 * radius * math.sin(min(eps_km / (2 * radius), math.pi / 2))
    return within * (1 - 1e-9), eps_km * (1 + 1e-9)  # the surface is never shorter than the line


def witness_links(pairs: DataFrame, places: DataFrame, eps_km: float, metric: str, distance, counts: list[int] | None = None) -> DataFrame:
    """The pairs (a, b, ca, cb) that hold two places within eps, as ``a, b``.

    ``pairs``: the ends ``a, b`` to link and the cubes ``ca, cb``; ``places``: ``c, lat,
    lon`` distinct places of each cube; ``distance(lat1, lon1, lat2, lon2)``: the exact
    metric as a column.  ``counts`` collects the number of cell pairs of each round.
    """
    near, far = chord_bounds(eps_km, metric)
    root = F.struct(*(F.lit(0).cast("long").alias(a) for a in AXES))
    open_ = staged(pairs.select("a", "b", "ca", "cb", root.alias("ka"), root.alias("kb")), "cells")
    if open_.isEmpty():
        return open_.select("a", "b")
    cubes = open_.select(F.col("ca").alias("c")).union(open_.select("cb")).distinct()
    points = places.join(cubes, "c", "left_semi").select("c", "lat", "lon", *position("lat", "lon", metric))
    box = points.groupBy("c").agg(*(f(a).alias(f"{n}{a}") for a in AXES for f, n in ((F.min, "lo"), (F.max, "hi"))))
    size = F.greatest(*(F.col(f"hi{a}") - F.col(f"lo{a}") for a in AXES))
    # each cube is halved from the box of its places
    points = staged(points.join(box.select("c", *(f"lo{a}" for a in AXES), F.greatest(size, F.lit(1e-12)).alias("w")), "c"), "places")
    found, level = [], 0
    while True:
        n = open_.count()
        if counts is not None:
            counts.append(n)
        if not n:
            break
        level += 1
        # the cells of this level with their boxes, one place each and whether there are more
        cell = F.struct(*(F.floor(F.least((F.col(a) - F.col(f"lo{a}")) / F.col("w"), F.lit(1 - 1e-15)) * F.lit(float(2 ** level))).cast("long").alias(a) for a in AXES))
        live = open_.select(F.col("ca").alias("c")).union(open_.select("cb")).distinct()
        cells = points.join(live, "c", "left_semi").withColumn("k", cell).groupBy("c", "k").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("lat", "lon")).alias("at"),
            *(f(a).alias(f"{m}_{a}") for a in AXES for f, m in ((F.min, "lo"), (F.max, "hi"))))
        up = F.struct(*(F.shiftright(F.col(f"k.{a}"), 1).alias(a) for a in AXES))
        boxes = F.struct("n", "at", *(f"{m}_{a}" for a in AXES for m in ("lo", "hi")))
        cells = cells.select("c", "k", up.alias("up"), boxes.alias("box"))
        side = lambda s: cells.select(F.col("c").alias(f"c{s}"), F.col("up").alias(f"k{s}"), F.col("k").alias(f"new{s}"), F.col("box").alias(f"box{s}"))
        grown = open_.join(side("a"), ["ca", "ka"]).join(side("b"), ["cb", "kb"])
        gap = sum(F.pow(F.greatest(F.col(f"boxa.lo_{a}") - F.col(f"boxb.hi_{a}"), F.col(f"boxb.lo_{a}") - F.col(f"boxa.hi_{a}"), F.lit(0.0)), 2) for a in AXES)
        reach = sum(F.pow(F.greatest(F.col(f"boxa.hi_{a}") - F.col(f"boxb.lo_{a}"), F.col(f"boxb.hi_{a}") - F.col(f"boxa.lo_{a}")), 2) for a in AXES)
        grown = grown.where(F.sqrt(gap) <= far)
        # one place, or places that no halving can part
        one = lambda box: reduce(lambda p, q: p & q, [F.col(f"{box}.lo_{a}") == F.col(f"{box}.hi_{a}") for a in AXES])
        exact = distance("lat1", "lon1", "lat2", "lon2") <= eps_km
        grown = grown.withColumns({"lat1": F.col("boxa.at.lat"), "lon1": F.col("boxa.at.lon"), "lat2": F.col("boxb.at.lat"), "lon2": F.col("boxb.at.lon")})
        grown = grown.withColumn("hit", (F.sqrt(reach) <= near) | exact).withColumn("alone", one("boxa") & one("boxb"))
        grown = staged(grown.select("a", "b", "ca", "cb", F.col("newa").alias("ka"), F.col("newb").alias("kb"), "hit", "alone"), f"halved{level}")
        hits = grown.where("hit").select("a", "b").distinct()
        found.append(hits)
        open_ = staged(grown.where("not hit and not alone").drop("hit", "alone").join(hits, ["a", "b"], "left_anti"), f"cells{level}")
    if not found:
        return pairs.select("a", "b").where("false")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
