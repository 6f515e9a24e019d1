"""Spatial left join with exact intersection areas.

Catalyst would plan ``ST_INTERSECTS`` as a nested-loop join.  We rewrite it as
an equi join on grid cells:

1. each polygon gets its bounding box and a level: level 0 when its box covers
   at most ``max_cells`` fine cells, level 1 (cells ``coarse_factor`` times
   larger) otherwise, so a huge polygon never explodes into millions of rows;
2. polygons are exploded to tagged cells and joined once on (srid, tag,
   cell): tag 0 = two small polygons on fine cells, tag 1 = a big right polygon
   on coarse cells, tag 2 = a big left and a small right polygon on coarse
   cells, so every pair is produced by exactly one tag and each input is
   scanned once;
3. the closed bounding-box test prunes, and a pair is kept only in its
   *reference cell* (the cell holding the corner (max minx, max miny) of the two
   boxes), so no ``distinct`` shuffle is needed;
4. exact area of the intersection and the closed ``intersects`` predicate are
   computed for the surviving pairs by an Arrow UDF (signed
   triangle fans + convex clipping, vectorised in numpy); a pair with many vertices
   is cut into horizontal strips first, so a country-sized polygon is many tasks and
   each holds a strip's edges only (a sweep over their heights);
5. left rows without any partner are re-attached (left outer semantics).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from terrasol.functions import geo
from terrasol.operators.joins import by_shuffle
from terrasol.session import checkpoint_dir

PAIR_SCHEMA = StructType([StructField("area", DoubleType()), StructField("intersects", BooleanType())])


# ----------------------------------------------------------------------------- numpy geometry

def _triangles(rings) -> tuple[np.ndarray, np.ndarray]:
    """Fan triangles (counter-clockwise) with signs for one polygon: shell +1, holes -1."""
    tris, signs = [], []
    for k, ring in enumerate(rings):
        pts = np.array([(p["x"], p["y"]) for p in ring], dtype=float)
        if len(pts) >= 2 and np.allclose(pts[0], pts[-1]):
            pts = pts[:-1]
        if len(pts) < 3:
            continue
        ring_area = 0.5 * np.sum(pts[:, 0] * np.roll(pts[:, 1], -1) - np.roll(pts[:, 0], -1) * pts[:, 1])
        orient = 1.0 if ring_area >= 0 else -1.0
        role = 1.0 if k == 0 else -1.0
        a, b, c = pts[0], pts[1:-1], pts[2:]
        t = np.stack([np.broadcast_to(a, b.shape), b, c], axis=1)
        s = np.sign((b[:, 0] - a[0]) * (c[:, 1] - a[1]) - (c[:, 0] - a[0]) * (b[:, 1] - a[1]))
        keep = s != 0
        t, s = t[keep], s[keep]
        t[s < 0] = t[s < 0][:, ::-1]          # make every triangle counter-clockwise
        tris.append(t)
        signs.append(s * orient * role)  # fan-term sign x ring orientation x shell/hole role
    if not tris:
        return np.zeros((0, 3, 2)), np.zeros(0)
    return np.concatenate(tris), np.concatenate(signs)


def _clip_areas(subj: np.ndarray, clip: np.ndarray) -> np.ndarray:
    """Area of subj[m] ∩ clip[m] for counter-clockwise triangles, vectorised over m."""
    m = subj.shape[0]
    poly, n = subj.copy(), np.full(m, 3)
    for e in range(3):
        a, b = clip[:, e], clip[:, (e + 1) % 3]
        k = poly.shape[1]
        idx = np.arange(k)[None, :]
        valid = idx < n[:, None]
        nxt_idx = np.where(idx + 1 < n[:, None], idx + 1, 0)
        nxt = np.take_along_axis(poly, nxt_idx[..., None].repeat(2, -1), axis=1)
        ab = (b - a)[:, None, :]
        dc = ab[..., 0] * (poly[..., 1] - a[:, None, 1]) - ab[..., 1] * (poly[..., 0] - a[:, None, 0])
        dn = ab[..., 0] * (nxt[..., 1] - a[:, None, 1]) - ab[..., 1] * (nxt[..., 0] - a[:, None, 0])
        cin, nin = dc >= 0, dn >= 0
        denom = np.where(dc - dn == 0, 1.0, dc - dn)
        inter = poly + (dc / denom)[..., None] * (nxt - poly)
        out = np.stack([poly, inter], axis=2).reshape(m, 2 * k, 2)
        mask = np.stack([valid & cin, valid & (cin != nin)], axis=2).reshape(m, 2 * k)
        order = np.argsort(~mask, axis=1, kind="stable")
        poly = np.take_along_axis(out, order[..., None].repeat(2, -1), axis=1)
        n = mask.sum(axis=1)
    k = poly.shape[1]
    idx = np.arange(k)[None, :]
    nxt_idx = np.where(idx + 1 < n[:, None], idx + 1, 0)
    nxt = np.take_along_axis(poly, nxt_idx[..., None].repeat(2, -1), axis=1)
    cross = np.where(idx < n[:, None], poly[..., 0] * nxt[..., 1] - nxt[..., 0] * poly[..., 1], 0.0)
    return np.where(n >= 3, 0.5 * cross.sum(axis=1), 0.0)


def _segments(rings) -> np.ndarray:
    segs = []
    for ring in rings:
        pts = np.array([(p["x"], p["y"]) for p in ring], dtype=float)
        if len(pts) >= 2:
            segs.append(np.stack([pts[:-1], pts[1:]], axis=1))
    return np.concatenate(segs) if segs else np.zeros((0, 2, 2))


#: Triangle or segment pairs looked at together: memory of a batch does not grow with the polygons in it.
SLICE = 100_000


def _touch_flat(sa: np.ndarray, sb: np.ndarray) -> bool:
    """Closed boundaries meet: any segment of A meets any segment of B (a slice of A's against all of B's at a time)."""
    A, B = sa.reshape(-1, 2, 2), sb.reshape(-1, 2, 2)
    if not len(A) or not len(B):
        return False
    # only what lies in the common box, lowest first: a slice meets a short stretch of B
    box = np.maximum(A.min(axis=(0, 1)), B.min(axis=(0, 1))), np.minimum(A.max(axis=(0, 1)), B.max(axis=(0, 1)))
    A, B = (s[((s.max(axis=1) >= box[0]) & (s.min(axis=1) <= box[1])).all(axis=1)] for s in (A, B))
    A, B = (s[np.argsort(s[:, :, 1].min(axis=1), kind="stable")] for s in (A, B))
    low, high = B[:, :, 1].min(axis=1), B[:, :, 1].max(axis=1)
    k = 0
    while k < len(A):
        part = A[k:k + max(1, SLICE // max(1, len(B)))]
        near = B[:np.searchsorted(low, part[:, :, 1].max(), "right")]
        near = near[high[:len(near)] >= part[:, :, 1].min()]
        if len(near) and _meet(part, near):
            return True
        k += len(part)
    return False


def _meet(A: np.ndarray, B: np.ndarray) -> bool:
    p, p2 = A[:, None, 0], A[:, None, 1]
    q, q2 = B[None, :, 0], B[None, :, 1]

    def orient(a, b, c):
        return np.sign((b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0]))

    def on_seg(a, b, c):
        return ((np.minimum(a[..., 0], b[..., 0]) <= c[..., 0]) & (c[..., 0] <= np.maximum(a[..., 0], b[..., 0]))
                & (np.minimum(a[..., 1], b[..., 1]) <= c[..., 1]) & (c[..., 1] <= np.maximum(a[..., 1], b[..., 1])))

    o1, o2, o3, o4 = orient(p, p2, q), orient(p, p2, q2), orient(q, q2, p), orient(q, q2, p2)
    hit = (o1 != o2) & (o3 != o4)
    hit |= (o1 == 0) & on_seg(p, p2, q)
    hit |= (o2 == 0) & on_seg(p, p2, q2)
    hit |= (o3 == 0) & on_seg(q, q2, p)
    hit |= (o4 == 0) & on_seg(q, q2, p2)
    return bool(hit.any())


def _signed(rings) -> tuple[np.ndarray, np.ndarray]:
    t, s = _triangles(rings or [])
    return t, s


def _overlap(a, b) -> tuple[float, bool]:
    """(area of the intersection, closed boundaries or interiors meet) of two polygons."""
    (ta, ca), (tb, cb) = _signed(a), _signed(b)
    area = 0.0
    if len(ta) and len(tb):
        origin = ta[0, 0]                    # local frame: small, exact cross products
        ta, tb = ta - origin, tb - origin
        alo, ahi, blo, bhi = ta.min(axis=1), ta.max(axis=1), tb.min(axis=1), tb.max(axis=1)
        step = max(1, SLICE // len(tb))
        for k in range(0, len(ta), step):    # clip only triangle pairs whose boxes overlap
            near = ((alo[k:k + step, None] <= bhi[None]) & (blo[None] <= ahi[k:k + step, None])).all(axis=2)
            i, j = np.nonzero(near)
            for n in range(0, len(i), SLICE):
                ii, jj = i[n:n + SLICE] + k, j[n:n + SLICE]
                area += float((_clip_areas(ta[ii], tb[jj]) * ca[ii] * cb[jj]).sum())
    area = 0.0 if abs(area) < 1e-9 else area
    return area, area > 0 or _touch_flat(_segments(a or []), _segments(b or []))


def _edges(rings) -> np.ndarray:
    """Non-horizontal edges (x, y, x', y') with y < y' of all rings."""
    e = _segments(rings or []).reshape(-1, 4)
    e = e[e[:, 1] != e[:, 3]]
    return np.where((e[:, 1] < e[:, 3])[:, None], e, e[:, [2, 3, 0, 1]])


def _crossing_heights(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights at which an edge of a crosses an edge of b, in bounded slices."""
    out, step = [np.empty(0)], max(1, SLICE // max(1, len(b)))
    for k in range(0, len(a), step):
        p, r = a[k:k + step, None, :2], a[k:k + step, None, 2:] - a[k:k + step, None, :2]
        q, s = b[None, :, :2], b[None, :, 2:] - b[None, :, :2]
        d = r[..., 0] * s[..., 1] - r[..., 1] * s[..., 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((q - p)[..., 0] * s[..., 1] - (q - p)[..., 1] * s[..., 0]) / d
            u = ((q - p)[..., 0] * r[..., 1] - (q - p)[..., 1] * r[..., 0]) / d
        hit = (d != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        out.append((p[..., 1] + t * r[..., 1])[hit])
    return np.concatenate(out)


def intersection_polygons(a, b) -> list:
    """The intersection of two polygons as convex polygons that do not overlap.

    Between two neighbouring heights of vertices or crossings no two edges
    change places, so the inside of each polygon is a row of trapezoids there;
    those of both polygons are intersected, and trapezoids that continue between
    the same two edges are joined."""
    ea, eb = _edges(a), _edges(b)
    if not len(ea) or not len(eb):
        return []
    lo, hi = max(ea[:, 1].min(), eb[:, 1].min()), min(ea[:, 3].max(), eb[:, 3].max())
    if lo >= hi:
        return []
    every = np.concatenate([ea, eb])
    ys = np.concatenate([every[:, 1], every[:, 3], _crossing_heights(ea, eb)])
    ys = np.unique(np.concatenate([[lo, hi], ys[(ys > lo) & (ys < hi)]]))

    def at(edge, y):
        x0, y0, x1, y1 = edge
        return x0 if y == y0 else x1 if y == y1 else x0 + (y - y0) / (y1 - y0) * (x1 - x0)

    def spans(edges, first, y0, y1):
        """(left edge, right edge) of each stretch inside one polygon, with their places at mid-height."""
        own = np.flatnonzero((edges[:, 1] <= y0) & (edges[:, 3] >= y1))
        x = sorted((at(edges[i], (y0 + y1) / 2), first + int(i)) for i in own)
        return list(zip(x[::2], x[1::2]))

    done, open_ = [], {}
    for y0, y1 in zip(ys[:-1], ys[1:]):
        now = {}
        for left_a, right_a in spans(ea, 0, y0, y1):
            for left_b, right_b in spans(eb, len(ea), y0, y1):
                left, right = max(left_a, left_b), min(right_a, right_b)
                if left[0] < right[0]:
                    now[left[1], right[1]] = open_.pop((left[1], right[1]), y0)
        done += [(key, begin, y0) for key, begin in open_.items()]
        open_ = now
    done += [(key, begin, ys[-1]) for key, begin in open_.items()]
    out = []
    for (left, right), y0, y1 in done:
        corners = [(at(every[left], y0), y0), (at(every[right], y0), y0), (at(every[right], y1), y1), (at(every[left], y1), y1)]
        ring = [c for k, c in enumerate(corners) if c != corners[k - 1]]
        out.append([[{"x": float(x), "y": float(y)} for x, y in [*ring, ring[0]]]])
    return out


#: Pairs with more vertices than this are cut into strips of about so many edges, each a row of its own.
HEAVY, STRIP = 4096, 1024


def strip_overlap(ea: np.ndarray, eb: np.ndarray, lo: float, hi: float) -> tuple[float, bool]:
    """(area of the intersection between two heights, boundaries meet there) of two polygons given by the edges
    (x, y, x', y') that reach into the strip.

    A sweep over the heights of vertices and crossings: between two of them the edges of
    both polygons keep their order, so the intersection is a row of trapezoids."""
    touch = _touch_flat(ea, eb)
    if not len(ea) or not len(eb) or not hi > lo:
        return 0.0, touch
    origin = np.array([ea[0, 0], lo] * 2)

    def upward(e):
        e = e[e[:, 1] != e[:, 3]] - origin
        return np.where((e[:, 1] < e[:, 3])[:, None], e, e[:, [2, 3, 0, 1]])

    a, b = upward(ea), upward(eb)
    top = hi - lo
    ys = np.concatenate([a[:, 1], a[:, 3], b[:, 1], b[:, 3], _crossing_heights(a, b)])
    ys = np.unique(np.concatenate([[0.0, top], ys[(ys > 0) & (ys < top)]]))

    def at(e, y):
        return e[:, 0] + (y - e[:, 1]) / (e[:, 3] - e[:, 1]) * (e[:, 2] - e[:, 0])

    def spans(edges, y0, y1):
        own = edges[(edges[:, 1] <= y0) & (edges[:, 3] >= y1)]
        x0, x1 = at(own, y0), at(own, y1)
        order = np.argsort(x0 + x1, kind="stable")
        return np.stack([x0[order], x1[order]], axis=1).reshape(-1, 2, 2).tolist()   # [span][left, right][at y0, at y1]

    area = 0.0
    for y0, y1 in zip(ys[:-1], ys[1:]):
        sa, sb, i, j = spans(a, y0, y1), spans(b, y0, y1), 0, 0
        while i < len(sa) and j < len(sb):
            (la, ra), (lb, rb) = sa[i], sb[j]
            left, right = max(la, lb, key=sum), min(ra, rb, key=sum)
            if sum(left) < sum(right):
                area += (right[0] - left[0] + right[1] - left[1]) / 2 * (y1 - y0)
            if sum(ra) <= sum(rb):
                i += 1
            else:
                j += 1
    return float(area), touch


def _strips(a: pa.Array, b: pa.Array, lo: pa.Array, hi: pa.Array) -> pa.Array:
    def edges(lists):  # flat arrays, one view per row
        flat = np.stack([lists.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("x0", "y0", "x1", "y1")], axis=1) if len(lists.flatten()) else np.zeros((0, 4))
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        return [flat[s:e] for s, e in zip(ends[:-1], ends[1:])]

    found = [strip_overlap(x, y, u, v) for x, y, u, v in zip(edges(a), edges(b), lo.to_pylist(), hi.to_pylist())]
    return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.bool_())], names=["area", "intersects"])


_strips_udf = F.arrow_udf(_strips, PAIR_SCHEMA).asNondeterministic()


def _heavy_pairs(geometry: DataFrame) -> DataFrame:
    """``_lk, _rk, _x`` of pairs with many vertices: their edges are dealt over horizontal strips, and every strip
    of every pair is a row that any task may take."""
    def edges(geom: str, side: str):
        ring = lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(
            F.get(r, i - 1)["x"].alias("x0"), F.get(r, i - 1)["y"].alias("y0"), F.get(r, i)["x"].alias("x1"), F.get(r, i)["y"].alias("y1")))
        return geometry.select("_lk", "_rk", F.lit(side).alias("side"), F.inline(F.flatten(F.transform(F.filter(geom, lambda r: F.size(r) > 1), ring))))

    every = edges("_ga", "a").unionByName(edges("_gb", "b"))
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    bound = lambda f, v, side: f(F.when(F.col("side") == side, v))
    spans = every.groupBy("_lk", "_rk").agg(
        F.greatest(bound(F.min, low, "a"), bound(F.min, low, "b")).alias("lo"), F.least(bound(F.max, high, "a"), bound(F.max, high, "b")).alias("hi"),
        F.ceil(F.count(F.lit(1)) / STRIP).cast("int").alias("k")).where("lo <= hi").withColumn("h", (F.col("hi") - F.col("lo")) / F.col("k"))
    level = lambda y: F.when(F.col("h") > 0, F.floor((y - F.col("lo")) / F.col("h"))).otherwise(0).cast("int")
    near = every.join(by_shuffle(spans), ["_lk", "_rk"]).where((high >= F.col("lo")) & (low <= F.col("hi")))
    # an edge belongs to all strips that it reaches, ends included
    first, last = F.greatest(level(low) - 1, F.lit(0)), F.least(level(high), F.col("k") - 1)
    dealt = near.select("_lk", "_rk", "lo", "h", "k", "hi", "side", F.struct("x0", "y0", "x1", "y1").alias("e"), F.explode(F.sequence(F.least(first, last), last)).alias("strip"))
    of = lambda side: F.collect_list(F.when(F.col("side") == side, F.col("e")))
    strips = dealt.groupBy("_lk", "_rk", "strip", "lo", "h", "k", "hi").agg(of("a").alias("ea"), of("b").alias("eb"))
    y0 = F.col("lo") + F.col("strip") * F.col("h")
    y1 = F.when(F.col("strip") == F.col("k") - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("strip") + 1) * F.col("h"))
    done = strips.select("_lk", "_rk", _strips_udf("ea", "eb", y0, y1).alias("_s"))
    area = F.sum("_s.area")
    return done.groupBy("_lk", "_rk").agg(F.struct(F.when(F.abs(area) < 1e-9, 0.0).otherwise(area).alias("area"),
                                                   (F.max("_s.intersects") | (area >= 1e-9)).alias("intersects")).alias("_x"))


def intersection_area_and_intersects(a_rings: pd.Series, b_rings: pd.Series) -> pd.DataFrame:
    """Exact overlap area and closed intersects flag of aligned polygon pairs."""
    return pd.DataFrame([_overlap(a, b) for a, b in zip(a_rings, b_rings)], columns=["area", "intersects"])


class _Flat:
    """The polygons of an Arrow column as flat arrays: points, rings, rows and signed fan triangles."""

    def __init__(self, column: pa.Array):
        lens = lambda lists: lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = lambda n: np.cumsum(n) - n
        rings = column.flatten()
        points = rings.flatten()
        self.xy = np.stack([points.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y")], axis=1).astype(float).reshape(-1, 2)
        per_row, self.size = lens(column), lens(rings)
        self.begin, self.row_of_ring, self.rows = starts(self.size), np.repeat(np.arange(len(per_row)), per_row), len(per_row)
        self.first_ring, self.n_rings = starts(per_row), per_row
        some = self.size >= 2
        closed = np.zeros(len(self.size), bool)
        closed[some] = np.isclose(self.xy[self.begin[some]], self.xy[self.begin[some] + self.size[some] - 1]).all(axis=1)
        n = np.maximum(self.size - closed - 2, 0)
        ring = np.repeat(np.arange(len(n)), n)
        i = np.arange(n.sum()) - np.repeat(starts(n), n) + 1
        at = self.begin[ring]
        t = np.stack([self.xy[at], self.xy[at + i], self.xy[at + i + 1]], axis=1) if len(ring) else np.zeros((0, 3, 2))
        u, v = t[:, 1] - t[:, 0], t[:, 2] - t[:, 0]
        cross = u[:, 0] * v[:, 1] - v[:, 0] * u[:, 1]
        orient = np.where(np.bincount(ring, cross, minlength=len(n)) >= 0, 1.0, -1.0)
        role = np.where(np.arange(len(n)) == self.first_ring[self.row_of_ring], 1.0, -1.0)
        sign = np.sign(cross)
        keep = sign != 0
        t, ring, sign = t[keep], ring[keep], sign[keep]
        t[sign < 0] = t[sign < 0][:, ::-1]          # every triangle counter-clockwise
        self.triangles, self.weight, self.row = t, sign * (orient * role)[ring], self.row_of_ring[ring]
        self.count = np.bincount(self.row, minlength=self.rows)
        self.start = starts(self.count)

    def segments(self, row: int) -> np.ndarray:
        rings = range(self.first_ring[row], self.first_ring[row] + self.n_rings[row])
        pts = [self.xy[self.begin[r]:self.begin[r] + self.size[r]] for r in rings if self.size[r] >= 2]
        return np.concatenate([np.stack([q[:-1], q[1:]], axis=1) for q in pts]) if pts else np.zeros((0, 2, 2))


def _areas(a: _Flat, b: _Flat) -> np.ndarray:
    """Intersection areas of aligned polygons: all triangle pairs of many rows are clipped together, a slice at a time."""
    area = np.zeros(a.rows)
    pairs = a.count * b.count
    ends = np.cumsum(pairs)
    lo = 0
    while lo < a.rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 4 * SLICE, "right")))
        n = pairs[lo:hi]
        row = np.repeat(np.arange(lo, hi), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        for part in range(0, len(row), 4 * SLICE):
            r, q = row[part:part + 4 * SLICE], k[part:part + 4 * SLICE]
            i, j = a.start[r] + q // b.count[r], b.start[r] + q % b.count[r]
            origin = a.triangles[a.start[r], 0][:, None]   # local frame: small, exact cross products
            s, t = a.triangles[i] - origin, b.triangles[j] - origin
            near = ((s.min(axis=1) <= t.max(axis=1)) & (t.min(axis=1) <= s.max(axis=1))).all(axis=1)
            s, t, r, w = s[near], t[near], r[near], (a.weight[i] * b.weight[j])[near]
            for m in range(0, len(r), SLICE):
                e = slice(m, m + SLICE)
                area += np.bincount(r[e], _clip_areas(s[e], t[e]) * w[e], minlength=a.rows)
        lo = hi
    return np.where(np.abs(area) < 1e-9, 0.0, area)


def _pair(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = _Flat(a), _Flat(b)
    area = _areas(x, y)
    meets = area > 0
    for k in np.flatnonzero(~meets):   # only pairs without common area need their boundaries compared
        meets[k] = _touch_flat(x.segments(k), y.segments(k))
    return pa.StructArray.from_arrays([pa.array(area, pa.float64()), pa.array(meets, pa.bool_())], names=["area", "intersects"])


# Marked non-deterministic only so Catalyst evaluates it once: otherwise the
# filter on ``intersects`` and the projection of ``area`` each get a copy.
_pair_udf = F.arrow_udf(_pair, PAIR_SCHEMA).asNondeterministic()


def _pieces(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([intersection_polygons(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())],
                    pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))


_pieces_udf = F.arrow_udf(_pieces, geo.POLYGONS_TYPE)


# ----------------------------------------------------------------------------- grid join

def _with_cells(df: DataFrame, geom: str, cell: float, max_cells: int, p: str) -> DataFrame:
    """Flat bounding-box columns ``{p}minx..{p}maxy`` and the level ``{p}level``."""
    bb = geo.bbox(geom)
    d = df.withColumn("_bbs", bb).select(
        *df.columns, *[F.col("_bbs." + k).alias(p + k) for k in ("minx", "miny", "maxx", "maxy")])
    span = ((F.floor(F.col(p + "maxx") / cell) - F.floor(F.col(p + "minx") / cell) + 1)
            * (F.floor(F.col(p + "maxy") / cell) - F.floor(F.col(p + "miny") / cell) + 1))
    return d.withColumn(p + "level", F.when(span <= max_cells, F.lit(0)).otherwise(F.lit(1)))


def _cells(p: str, size: float) -> F.Column:
    """Grid cells (cx, cy) of size ``size`` covered by the bounding box ``{p}minx..``."""
    xs = F.sequence(F.floor(F.col(p + "minx") / size).cast("long"), F.floor(F.col(p + "maxx") / size).cast("long"))
    ys = F.sequence(F.floor(F.col(p + "miny") / size).cast("long"), F.floor(F.col(p + "maxy") / size).cast("long"))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def _tagged(df: DataFrame, p: str, fine: float, coarse: float, tags) -> DataFrame:
    """One row per (tag, cell).  ``tags`` lists (tag, level condition, cell size)."""
    empty = F.array().cast("array<struct<cx:bigint,cy:bigint>>")

    def tagger(tag: int):
        # one-argument lambda: a second parameter would be bound to the element index
        return lambda c: F.struct(F.lit(tag).alias(p + "tag"), c["cx"].alias(p + "cx"), c["cy"].alias(p + "cy"))

    parts = [F.transform(F.when(cond, _cells(p, size)).otherwise(empty), tagger(tag)) for tag, cond, size in tags]
    return df.select("*", F.inline(F.concat(*parts)))


def spatial_left_join(left: DataFrame, right: DataFrame, left_geom: str = "geom", right_geom: str = "geom",
                      srid: str = "srid", cell: float = 1000.0,
                      coarse_factor: int = 32, max_cells: int = 64, with_geometry: bool = False) -> DataFrame:
    """``left ⟕ right ON intersects(left_geom, right_geom)`` within the same srid.

    Adds ``geom_intersection_area`` (0 for boundary contact) and, on request,
    ``geom_intersection`` (an array of polygons, G6); right columns are
    null for left rows without partner.  Left rows are told apart by a row number
    generated once and checkpointed, so rows that repeat an id (several vintages
    of a park) keep their own partners; right column names must not collide with
    left ones (except ``srid``).
    """
    checkpoint_dir(left.sparkSession)
    coarse = cell * coarse_factor
    vertices = lambda g: F.aggregate(g, F.lit(0), lambda n, r: n + F.size(r))
    left = left.withColumn("_lk", F.monotonically_increasing_id()).withColumn("_ln", vertices(left_geom)).checkpoint()
    r_cols = [c for c in right.columns if c != srid]
    right = right.select(*[F.col(c).alias("_r_" + c) for c in r_cols], F.col(srid).alias("_rs"), F.col(right_geom).alias("_gb")) \
                 .withColumn("_rk", F.monotonically_increasing_id()).withColumn("_rn", vertices("_gb")).checkpoint()
    # only keys and boxes are exploded into cells and shuffled; geometry is fetched once per surviving pair
    L = _with_cells(left.select("_lk", "_ln", F.col(srid).alias("_ls"), F.col(left_geom).alias("_ga")), "_ga", cell, max_cells, "_l").drop("_ga")
    R = _with_cells(right.select("_rk", "_rn", "_rs", "_gb"), "_gb", cell, max_cells, "_r").drop("_gb")

    # Each pair is produced by exactly one tag: 0 = both small (fine cells),
    # 1 = right polygon big (coarse cells), 2 = left big and right small (coarse).
    small_l, big_l = F.col("_llevel") == 0, F.col("_llevel") == 1
    small_r, big_r = F.col("_rlevel") == 0, F.col("_rlevel") == 1
    lx = _tagged(L, "_l", cell, coarse, [(0, small_l, cell), (1, F.lit(True), coarse), (2, big_l, coarse)])
    rx = _tagged(R, "_r", cell, coarse, [(0, small_r, cell), (1, big_r, coarse), (2, small_r, coarse)])
    j = lx.join(by_shuffle(rx), (F.col("_ls") == F.col("_rs")) & (F.col("_ltag") == F.col("_rtag"))
                & (F.col("_lcx") == F.col("_rcx")) & (F.col("_lcy") == F.col("_rcy")))
    size = F.when(F.col("_ltag") == 0, F.lit(cell)).otherwise(F.lit(coarse))
    overlap = ((F.col("_lminx") <= F.col("_rmaxx")) & (F.col("_rminx") <= F.col("_lmaxx"))
               & (F.col("_lminy") <= F.col("_rmaxy")) & (F.col("_rminy") <= F.col("_lmaxy")))
    reference = ((F.floor(F.greatest("_lminx", "_rminx") / size) == F.col("_lcx"))
                 & (F.floor(F.greatest("_lminy", "_rminy") / size) == F.col("_lcy")))
    pairs = j.where(overlap & reference)
    fetch = lambda p: (p.select("_lk", "_rk").join(by_shuffle(left.select("_lk", F.col(left_geom).alias("_ga"))), "_lk")
                       .join(by_shuffle(right.drop("_rs", "_rn")), "_rk"))
    large = F.col("_ln") + F.col("_rn") > HEAVY
    exact = fetch(pairs.where(~large)).withColumn("_x", _pair_udf("_ga", "_gb")).where(F.col("_x.intersects"))
    # two numbers tell whether any pair can be large: without one its branch is not planned at all
    if sum(df.agg(F.max(n)).first()[0] or 0 for df, n in ((left, "_ln"), (right, "_rn"))) > HEAVY:
        heavy = fetch(pairs.where(large))
        exact = exact.unionByName(heavy.join(by_shuffle(_heavy_pairs(heavy).where("_x.intersects")), ["_lk", "_rk"]).select(*exact.columns))
    shape = [_pieces_udf("_ga", "_gb").alias("geom_intersection")] if with_geometry else []
    matched = exact.select("_lk", *[F.col("_r_" + c).alias(c) for c in r_cols],
                           F.col("_x.area").alias("geom_intersection_area"), *shape)
    # left outer: every left row, partners when any.
    return left.join(by_shuffle(matched), "_lk", "left").drop("_lk", "_ln")
