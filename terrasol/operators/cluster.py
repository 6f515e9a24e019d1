"""DBSCAN on geographic points.

* Points are placed in 3-D cubes on a sphere; the cube side is chosen so that
  any two points of one cube are within ``eps`` (geodesic, with margin), so a
  cube is a clique: its members are linked by a star to the cube's smallest
  id, never by all pairs (a location holding a third of all rows costs linear
  work).  No pole or antimeridian special case is needed.
* Candidate pairs only come from *occupied* neighbouring cubes (half of the
  5x5x5 neighbourhood, each unordered cube pair once); two dense cubes whose
  point boxes lie entirely within eps are linked directly, and two that are
  partly within eps by one witness, found by halving both (no pairs of places);
  pairs with a sparse cube are filtered by the exact
  distance (haversine Column expression, or geodesic on the WGS-84 ellipsoid
  in an Arrow-batched pandas UDF).
* Core points (``degree >= min_samples``, self included) are connected by
  iterative min-label propagation with pointer jumping; every iteration is checkpointed to the
  shared ``spark.checkpoint.dir`` so lineage stays short and a lost executor
  only recomputes one step.
* Clusters are numbered 0..k-1 by their smallest core id (the discovery order
  of a scan by id), via a range-partitioned sort and partition offsets; border points take the smallest neighbouring cluster;
  noise is -1.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from terrasol.operators.closest import witness_links
from terrasol.session import checkpoint_dir
from terrasol.sources.io import staged

EARTH_RADIUS_KM = 6371.0088
# geodesic/spherical distance ratio stays within 0.6 %: 1 % margin everywhere.
MARGIN = 1.01
WGS84_A = 6378.137
WGS84_F = 1 / 298.257223563


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    rad = math.pi / 180
    p1, p2 = F.col(lat1) * rad, F.col(lat2) * rad
    dp, dl = (F.col(lat2) - F.col(lat1)) * rad, (F.col(lon2) - F.col(lon1)) * rad
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def vincenty_km(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Ellipsoidal (WGS-84) inverse distance, vectorised (Vincenty 1975).

    Pairs of one DBSCAN neighbourhood are close together, where the iteration
    always converges; pairs that do not converge (near-antipodal) raise."""
    a, f = WGS84_A, WGS84_F
    b = a * (1 - f)
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    lon_d = np.radians(lon2 - lon1)
    lam = lon_d.copy()
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    sin_s = cos_s = sigma = cos2a = cos2sm = np.zeros_like(lam)
    for step in range(1000):
        sl, cl = np.sin(lam), np.cos(lam)
        sin_s = np.sqrt((cu2 * sl) ** 2 + (cu1 * su2 - su1 * cu2 * cl) ** 2)
        cos_s = su1 * su2 + cu1 * cu2 * cl
        sigma = np.arctan2(sin_s, cos_s)
        sin_a = np.where(sin_s == 0, 0.0, cu1 * cu2 * sl / np.where(sin_s == 0, 1.0, sin_s))
        cos2a = 1 - sin_a ** 2
        cos2sm = np.where(cos2a == 0, 0.0, cos_s - 2 * su1 * su2 / np.where(cos2a == 0, 1.0, cos2a))
        c = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
        prev = lam
        lam = lon_d + (1 - c) * f * sin_a * (sigma + c * sin_s * (cos2sm + c * cos_s * (-1 + 2 * cos2sm ** 2)))
        if np.all(np.abs(lam - prev) < 1e-12):
            break
        if step == 999:
            raise ArithmeticError("geodesic distance of near-antipodal points does not converge")
    u2sq = cos2a * (a * a - b * b) / (b * b)
    big_a = 1 + u2sq / 16384 * (4096 + u2sq * (-768 + u2sq * (320 - 175 * u2sq)))
    big_b = u2sq / 1024 * (256 + u2sq * (-128 + u2sq * (74 - 47 * u2sq)))
    ds = big_b * sin_s * (cos2sm + big_b / 4 * (cos_s * (-1 + 2 * cos2sm ** 2)
                                               - big_b / 6 * cos2sm * (-3 + 4 * sin_s ** 2) * (-3 + 4 * cos2sm ** 2)))
    return np.where(sin_s == 0, 0.0, b * big_a * (sigma - ds))


@F.pandas_udf(DoubleType())
def geodesic_km(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    return pd.Series(vincenty_km(lat1.to_numpy(float), lon1.to_numpy(float), lat2.to_numpy(float),
                                 lon2.to_numpy(float)))


def _cube_cols(lat: str, lon: str, side_km: float) -> list[Column]:
    """3-D position on the sphere (km) and the cube it falls in."""
    rad = math.pi / 180
    p, l = F.col(lat) * rad, F.col(lon) * rad
    xyz = (F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p))
    pos = [(c * EARTH_RADIUS_KM).alias(n) for c, n in zip(xyz, ("px", "py", "pz"))]
    cube = [F.floor(c * EARTH_RADIUS_KM / side_km).cast("long").alias(n) for c, n in zip(xyz, ("cx", "cy", "cz"))]
    return pos + cube


def _half_offsets(r: int) -> list[tuple[int, int, int]]:
    return [(dx, dy, dz) for dx in range(-r, r + 1) for dy in range(-r, r + 1) for dz in range(-r, r + 1)
            if (dx, dy, dz) > (0, 0, 0)]


def _dense_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based dense rank of the distinct values of ``col`` without a global
    window: a range-partitioned sort, a row number inside each partition and
    per-partition offsets from the (tiny) table of partition sizes."""
    ranked = (df.select(col).distinct().orderBy(col)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(col))))
    sizes = ranked.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (ranked.join(F.broadcast(offsets), "_pid")
                  .select(col, (F.col("_off") + F.col("_rn") - 1).cast("long").alias(out)))


def dbscan(points: DataFrame, id_col: str = "id", lat: str = "latitude", lon: str = "longitude",
           eps_km: float = 1.0, min_samples: int = 2, metric: str = "geodesic",
           label_col: str = "labels") -> DataFrame:
    """Add ``label_col`` (cluster 0..k-1, noise -1) to ``points``.

    Rows are clustered, not ids: rows that repeat an id are points of their own.
    A row number generated once (and checkpointed, so that it survives
    re-evaluation) tells them apart; clusters are still numbered by id."""
    checkpoint_dir(points.sparkSession)
    given, id_name = points, id_col
    points = given.withColumn("_row", F.struct(F.col(id_name).alias("id"), F.monotonically_increasing_id().alias("n"))).checkpoint()
    id_col = "_row"
    side = eps_km / (math.sqrt(3) * MARGIN * MARGIN)
    reach = int(math.ceil(eps_km * MARGIN / side))
    pts = points.select(F.col(id_col).alias("id"), F.col(lat).alias("lat"), F.col(lon).alias("lon"),
                        *_cube_cols(lat, lon, side))
    cubes = pts.groupBy("cx", "cy", "cz").agg(
        F.count("*").alias("n_cube"), F.min("id").alias("cube_min"),
        *[f(c).alias(f"{n}{c}") for c in ("px", "py", "pz") for f, n in ((F.min, "lo_"), (F.max, "hi_"))])
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(dz).alias("dz"))
                        for dx, dy, dz in _half_offsets(reach)])
    # occupied neighbouring cube pairs, each unordered pair once (62 fixed offsets per cube)
    cube_pairs = (cubes.select("cx", "cy", "cz", "n_cube", "cube_min", "lo_px", "hi_px", "lo_py", "hi_py", "lo_pz",
                               "hi_pz", F.inline(offsets))
                  .select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("cz").alias("az"),
                          F.col("n_cube").alias("an"), F.col("cube_min").alias("aroot"),
                          *[F.col(f"{h}_{c}").alias(f"a{h}{c}") for h in ("lo", "hi") for c in ("px", "py", "pz")],
                          (F.col("cx") + F.col("dx")).alias("bx"), (F.col("cy") + F.col("dy")).alias("by"),
                          (F.col("cz") + F.col("dz")).alias("bz"))
                  .join(cubes.select(F.col("cx").alias("bx"), F.col("cy").alias("by"), F.col("cz").alias("bz"),
                                     F.col("n_cube").alias("bn"), F.col("cube_min").alias("broot"),
                                     *[F.col(f"{h}_{c}").alias(f"b{h}{c}") for h in ("lo", "hi")
                                       for c in ("px", "py", "pz")]),
                        ["bx", "by", "bz"]))
    # two dense cubes (every point core) whose point boxes lie entirely within eps
    # are certainly connected: link their star roots, do not enumerate point pairs
    far = [F.greatest(F.abs(F.col(f"ahi{c}") - F.col(f"blo{c}")), F.abs(F.col(f"bhi{c}") - F.col(f"alo{c}")))
           for c in ("px", "py", "pz")]
    max_chord = F.sqrt(far[0] * far[0] + far[1] * far[1] + far[2] * far[2])
    certain = (F.col("an") >= min_samples) & (F.col("bn") >= min_samples) & (max_chord * MARGIN <= eps_km)
    root_links = cube_pairs.where(certain).select(F.col("aroot").alias("a"), F.col("broot").alias("b"))
    open_pairs = cube_pairs.where(~certain)
    # two dense cubes that are partly within eps: one pair of places within eps links their
    # roots (every point of both is core); it is found by halving the cubes, not by pairing places
    dense = (F.col("an") >= min_samples) & (F.col("bn") >= min_samples)
    cube = lambda p: F.struct(*(F.col(f"{p}{c}").alias(c) for c in ("x", "y", "z")))
    places = pts.select(F.struct(*(F.col(f"c{c}").alias(c) for c in ("x", "y", "z"))).alias("c"), "lat", "lon").distinct()
    partly = open_pairs.where(dense).select(F.col("aroot").alias("a"), F.col("broot").alias("b"), cube("a").alias("ca"), cube("b").alias("cb"))
    # the others have fewer than min_samples points on one side
    cube_pairs = open_pairs.where(~dense).select("ax", "ay", "az", "bx", "by", "bz")
    a = pts.select(F.col("id").alias("a"), F.col("lat").alias("alat"), F.col("lon").alias("alon"),
                   F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("cz").alias("az"))
    b = pts.select(F.col("id").alias("b"), F.col("lat").alias("blat"), F.col("lon").alias("blon"),
                   F.col("cx").alias("bx"), F.col("cy").alias("by"), F.col("cz").alias("bz"))
    cand = a.join(cube_pairs, ["ax", "ay", "az"]).join(b, ["bx", "by", "bz"])
    if metric == "haversine":
        dist = haversine_km("alat", "alon", "blat", "blon")
    elif metric == "geodesic":
        dist = geodesic_km("alat", "alon", "blat", "blon")
    else:
        raise ValueError(metric)
    near = witness_links(partly, places, eps_km, metric, haversine_km if metric == "haversine" else geodesic_km)
    root_links = root_links.unionByName(near)
    cross = cand.select("a", "b", dist.alias("d")).where(F.col("d") <= eps_km).select("a", "b")
    cross = cross.unionByName(cross.select(F.col("b").alias("a"), F.col("a").alias("b")))
    cross = cross.checkpoint()            # shared folder; reused three times below
    # degree = members of the own cube (self included) + neighbours in other cubes
    deg = (pts.join(cubes, ["cx", "cy", "cz"]).select("id", "cx", "cy", "cz", "n_cube")
              .join(cross.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_cross")), "id", "left")
              .select("id", "cx", "cy", "cz", (F.col("n_cube") + F.coalesce("n_cross", F.lit(0))).alias("degree")))
    core = deg.where(F.col("degree") >= min_samples).select("id", "cx", "cy", "cz")
    # edges among core points: star per cube + cross pairs of two cores
    star_root = core.groupBy("cx", "cy", "cz").agg(F.min("id").alias("root"))
    star = core.join(star_root, ["cx", "cy", "cz"]).where(F.col("id") != F.col("root")) \
               .select(F.col("id").alias("a"), F.col("root").alias("b"))
    star = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
    core_ids = core.select("id")
    cc = (cross.join(core_ids.withColumnRenamed("id", "a"), "a", "left_semi")
               .join(core_ids.withColumnRenamed("id", "b"), "b", "left_semi"))
    root_links = root_links.unionByName(root_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = star.unionByName(cc).unionByName(root_links).checkpoint()
    labels = core_ids.select("id", F.col("id").alias("lab")).checkpoint()
    while True:
        # propagate the smallest label over edges, then jump: label := label of label
        proposals = edges.join(labels.select(F.col("id").alias("a"), "lab"), "a").select(F.col("b").alias("id"), "lab")
        m = labels.unionByName(proposals).groupBy("id").agg(F.min("lab").alias("lab"))
        jumped = m.join(m.select(F.col("id").alias("lab"), F.col("lab").alias("_l2")), "lab", "left") \
                  .select("id", F.coalesce("_l2", "lab").alias("lab"))
        new = (jumped.join(labels.withColumnRenamed("lab", "_old"), "id")
                     .select("id", "lab", (F.col("lab") != F.col("_old")).alias("_chg")).checkpoint())
        changed = new.where(F.col("_chg")).count()
        labels = new.select("id", "lab")
        if changed == 0:
            break
    numbers = _dense_index(labels, "lab", "cluster")
    core_lab = labels.join(numbers, "lab").select("id", "cluster")
    # border points: non-core with a core neighbour (same cube or cross pair) → smallest cluster
    non_core = deg.where(F.col("degree") < min_samples).select("id", "cx", "cy", "cz")
    core_cube = core.join(core_lab, "id").groupBy("cx", "cy", "cz").agg(F.min("cluster").alias("c1"))
    via_cube = non_core.join(core_cube, ["cx", "cy", "cz"]).select("id", F.col("c1").alias("cluster"))
    via_pair = (cross.join(non_core.select(F.col("id").alias("a")), "a")
                     .join(core_lab.select(F.col("id").alias("b"), "cluster"), "b").select(F.col("a").alias("id"), "cluster"))
    border = via_cube.unionByName(via_pair).groupBy("id").agg(F.min("cluster").alias("cluster"))
    assigned = core_lab.unionByName(border)
    return (points.join(assigned.withColumnRenamed("id", id_col), id_col, "left")
                  .withColumn(label_col, F.coalesce(F.col("cluster"), F.lit(-1)).cast("long")).drop("cluster", "_row"))


def cluster_polygons(polygons: DataFrame, id_col: str = "id", geom: str = "geom", srid: str = "srid", **options) -> DataFrame:
    """The input with ``centroid`` (struct lon, lat in degrees) and ``labels`` (M1): polygons in their projected CRS,
    their area centroids back to degrees, and clusters of those within eps."""
    from terrasol.functions import geo
    # written once: the projection formulas refer to the centroid many times over
    metres = staged(polygons.withColumn("_c", geo.centroid(geom)), "centroids")
    degrees = metres.withColumn("centroid", geo.unproject(F.col("_c.x"), F.col("_c.y"), srid)).drop("_c")
    placed = staged(degrees, "centroids").withColumns({"_lat": F.col("centroid.lat"), "_lon": F.col("centroid.lon")})
    return dbscan(placed, id_col, "_lat", "_lon", **options).drop("_lat", "_lon")
