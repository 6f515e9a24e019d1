"""Near-duplicate detection with HyperMinHash registers, exact after verification.

A document's set holds its distinct five-word shingles as 64-bit hashes.  The
first bits of a hash choose one of 128 buckets; a bucket keeps its smallest hash
as a register of leading-zero count and mantissa bits.  Bands of registers are
the candidate keys.  Copies of one set are first reduced to one representative.

Candidates are never expanded into pairs.  In each round some members of every
bucket that still spans several components become pivots: a pivot is compared
with all members of all its buckets (a collision-corrected estimate first, then
the full sets) and leaves its buckets for good, and linked components merge.  A
bucket is finished when its members belong to one component, so a large group of
near copies needs few pivots, yet no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import Scratch, WordIds, batches, bitmap, marked, mix, released, utf8

WORDS = 5
#: Links: ``PERCENT[1] * intersection >= PERCENT[0] * union``.
PERCENT = (75, 100)
BUCKET_BITS, MANTISSA = 7, 10
BANDS = 32
#: Pivots compared in one task, and members by count and by bytes of their sets.
PIVOTS, MEMBERS, SET_BYTES = 256, 1024, 8 << 20
#: How far below the threshold an estimate must lie to rule a pair out (six standard errors).
MARGIN = 0.23
#: Sets up to this size get registers from independent hash functions.
SMALL = 32
_rng = np.random.default_rng(10)
#: For each try, the bucket that an empty bucket looks into; the salts of the small sets' hash functions.
TRIES = _rng.integers(0, 1 << BUCKET_BITS, (256, 1 << BUCKET_BITS), np.uint8)
SALTS = _rng.integers(0, 2**64, 1 << BUCKET_BITS, np.uint64)
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def shingles(text: bytes, ids: WordIds, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text; fewer words: the whole sequence as one."""
    h = ids.array(text.lower().split())
    if not len(h):
        return h
    with np.errstate(over="ignore"):
        if len(h) < words:
            x = np.uint64(len(h))
            for w in h:
                x = mix(x * np.uint64(ODD[0]) + w)
            return np.array([x], np.uint64)
        n = len(h) - words + 1
        total = h[:n] * np.uint64(ODD[0])  # words are 64-bit hashes already: one odd factor per place
        for k in range(1, words):
            total += h[k:k + n] * np.uint64(ODD[k % len(ODD)] + 2 * (k // len(ODD)))
        return np.unique(mix(total))


def encoded(x: np.ndarray) -> np.ndarray:
    """Register of a hash whose bits start at the top: leading zeros + 1 and the mantissa bits after the first one."""
    zeros = 64 - np.frexp(x.astype(np.float64))[1].astype(np.int64).clip(BUCKET_BITS, 64)
    mantissa = (x << (zeros + 1).clip(0, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    return ((zeros + 1) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)


def registers(s: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set, one per bucket (the first bits of a hash choose it).

    An empty bucket takes the register of another one, tried in an order that is
    fixed per bucket, so two registers agree as often as the sets are alike
    however few elements there are.  No set: all 0.
    """
    out = np.zeros(1 << BUCKET_BITS, np.uint16)
    if not len(s):
        return out
    bucket = (s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    own = np.zeros(len(out), np.uint16)
    own[bucket[first]] = encoded(s[first] << np.uint64(BUCKET_BITS))
    out[:] = own
    empty, k = np.flatnonzero(own == 0), 0
    while len(empty):
        out[empty] = own[TRIES[k % len(TRIES)][empty]]
        empty, k = empty[out[empty] == 0], k + 1
        if k == len(TRIES):  # no try has met a filled bucket: the next one in the ring
            filled = np.flatnonzero(own)
            out[empty] = own[filled[np.searchsorted(filled, empty) % len(filled)]]
            break
    return out


def small_registers(s: np.ndarray) -> np.ndarray:
    """Registers of a small set: each from a hash function of its own instead of a bucket."""
    with np.errstate(over="ignore"):
        return encoded(mix(s[:, None] ^ SALTS[None, :]).min(axis=0))


def sketches(s: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(kind, registers) that a set takes part with.

    Kind 0 serves sets of at most ``SMALL`` elements, kind 1 larger ones.  A set
    that is large, yet within the threshold of a small one, has both kinds, so
    every linkable pair has one in common.
    """
    out = []
    if 0 < len(s) <= SMALL * PERCENT[1] // PERCENT[0]:
        out.append((0, small_registers(s)))
    if len(s) > SMALL:
        out.append((1, registers(s)))
    return out


def band_keys(sketch: list[tuple[int, np.ndarray]], bands: int = BANDS) -> np.ndarray:
    """A 64-bit key per kind and band of registers."""
    keys = [np.empty(0, np.int64)]
    for kind, reg in sketch:
        rows = reg.reshape(bands, -1).astype(np.uint64)
        with np.errstate(over="ignore"):
            key = np.arange(1 + kind * bands, 1 + (kind + 1) * bands, dtype=np.uint64) * np.uint64(ODD[1])
            for k in range(rows.shape[1]):
                key = mix(key * np.uint64(ODD[0]) + rows[:, k])
        keys.append(key.view(np.int64))
    return np.concatenate(keys)


def expected_collisions(n, m):
    """Registers that agree by chance between sets of n and m elements (p bucket bits, r mantissa bits)."""
    ratio = n / m
    return 0.169919487159739093975315012348 * 2.0 ** (BUCKET_BITS - MANTISSA) * 4 * ratio / (1 + ratio) ** 2


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of register rows a against b (broadcast) of sets of n and m elements."""
    same = ((a == b) & (a != 0)).sum(axis=-1)
    return (same - expected_collisions(n, m)).clip(0) / a.shape[-1]


def digest_of(s: np.ndarray) -> bytes:
    import hashlib
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def node_of(digest: bytes) -> int:
    """Number of a set in the graph of links."""
    return int.from_bytes(digest[:8], "little", signed=True)


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest, node, keys``; a text without words has a null digest and node."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for b in batches(it):
            n, digest, keys = [], [], []
            for t in utf8(b, "text"):
                s = shingles(t, ids)
                n.append(len(s))
                digest.append(digest_of(s) if len(s) else None)
                keys.append(band_keys(sketches(s)))
            ends = np.cumsum([0, *map(len, keys)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                              pa.array([d and node_of(d) for d in digest], pa.int64()), lists],
                                             names=["doc_id", "text_hash", "n_shingles", "digest", "node", "keys"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(released(run), "doc_id long, text_hash long, n_shingles long, digest binary, node long, keys array<long>")


def document_sets(docs: DataFrame) -> DataFrame:
    """``id, n, reg, elements``: node, size, registers and the full sorted set as bytes."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for b in batches(it, 500):
            sets = [shingles(t, ids) for t in utf8(b, "text")]
            yield pa.RecordBatch.from_arrays([
                pa.array([node_of(digest_of(s)) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["id", "n", "reg", "elements"])

    return docs.select("text").mapInArrow(released(run), "id long, n long, reg binary, elements binary")


def intersections(pivots: list[np.ndarray], members: list[np.ndarray], most: int = 2_000_000) -> np.ndarray:
    """Sizes of all intersections, members by pivots, through an index of the pivots' elements."""
    out = np.zeros((len(members), len(pivots)), np.int64)
    owner = np.repeat(np.arange(len(pivots)), [len(s) for s in pivots])
    index = np.concatenate(pivots)
    order = np.argsort(index, kind="stable")
    index, owner = index[order], owner[order]
    value, start, count = np.unique(index, return_index=True, return_counts=True)
    row = np.repeat(np.arange(len(members)), [len(s) for s in members])
    element = np.concatenate(members)
    at = np.searchsorted(value, element).clip(max=len(value) - 1)
    hit = value[at] == element
    row, at = row[hit], at[hit]
    size = count[at]
    total = np.cumsum(size)
    lo = 0
    while lo < len(row):  # bounded slices of (element, pivot) hits
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        n = size[lo:hi]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pivot = owner[np.repeat(start[at[lo:hi]], n) + inside]
        np.add(out, np.bincount(np.repeat(row[lo:hi], n) * len(pivots) + pivot, minlength=out.size).reshape(out.shape), out=out)
        lo = hi
    return out


def linked(pivots: pd.DataFrame, members: pd.DataFrame, percent=PERCENT) -> np.ndarray:
    """Members by pivots: True where the full sets are similar enough."""
    view = lambda f, c, t: [np.frombuffer(x, t) for x in f[c]]
    n_p, n_m = pivots["n"].to_numpy(), members["n"].to_numpy()
    reg_p, reg_m = np.stack(view(pivots, "reg", np.uint16)), np.stack(view(members, "reg", np.uint16))
    close = np.zeros((len(n_m), len(n_p)), bool)
    for j in range(len(n_p)):
        fits = percent[1] * np.minimum(n_m, n_p[j]) >= percent[0] * np.maximum(n_m, n_p[j])
        # the estimate only rules out what lies far below the threshold: the full sets decide about the rest
        # (registers filled from few buckets scatter more, so small sets are all compared in full)
        est = estimate(reg_m, reg_p[j], n_m, n_p[j])
        close[:, j] = fits & ((est >= percent[0] / percent[1] - MARGIN) | (np.minimum(n_m, n_p[j]) < 4 << BUCKET_BITS))
    p, m = np.flatnonzero(close.any(axis=0)), np.flatnonzero(close.any(axis=1))
    if not len(p):
        return close
    sets_p, sets_m = view(pivots, "elements", np.uint64), view(members, "elements", np.uint64)
    both = intersections([sets_p[j] for j in p], [sets_m[i] for i in m])
    union = n_m[m][:, None] + n_p[p][None, :] - both
    out = np.zeros_like(close)
    out[np.ix_(m, p)] = percent[1] * both >= percent[0] * union
    return out & close


def forest(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> set[tuple[int, int]]:
    """(component, least component reached) for components a (members) and b (pivots) under the links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(links)):
        x, y = root(int(a[i])), root(int(b[j]))
        parent[max(x, y)] = min(x, y)
    return {(x, root(x)) for x in list(parent) if root(x) != x}


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``id, label``: the least id each end of an edge (a, b) reaches; min-label rounds with pointer jumps."""
    both = scratch.save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = scratch.save(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    k = 0
    while True:
        k += 1
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        new = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = new.join(jump, "label").select("id", "old", F.least("label", "far").alias("label"))
        new = scratch.save(new, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}") if k > 1 else None
        if new.where("old != label").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")


def near_duplicates(docs: DataFrame, percent=PERCENT) -> DataFrame:
    """Per row of docs ``doc_id, n_shingles, component_id, kept``.

    A text without words is linked with nothing; a row without an id is its own
    group (null component, kept); rows that repeat a doc_id are judged each by its
    own text: of a group, the rows of one set with the smallest id are kept.  An
    empty table gives an empty result.
    """
    return judged(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, percent=PERCENT) -> DataFrame:
    """``near_duplicates`` with the columns ``text_hash`` and ``digest`` (of the set; null without words)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    feats = scratch.save(document_features(docs), "features")
    known = feats.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # the nodes are the sets: one doc_id may stand on rows with different texts, and a set on many rows
    classes = scratch.save(known.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("node").alias("node"),
                                                       F.first("keys").alias("keys")), "classes")
    rows = classes.select(F.col("node").alias("id"), F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi")
    active = scratch.save(rows.join(shared.select("key", "size", "lo"), "key").distinct(), "buckets")
    # degree: how central a row is; home: rows of one group mostly have the same one
    degree = active.groupBy("id").agg(F.sum("size").alias("degree"), F.min("lo").alias("home"))
    nodes = scratch.save(degree, "nodes")
    linkable = classes.join(nodes.select(F.col("id").alias("node")), "node", "left_semi").select("rep.doc_id", "rep.text_hash")
    linkable = scratch.save(linkable, "linkable")
    # only texts that may be linkable are moved, repeated rows of them once
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).where(F.col("doc_id").isNotNull())
    texts = marked(texts, bitmap(linkable, "doc_id", "text_hash"), "doc_id", "text_hash").where("_maybe")
    texts = texts.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text")).join(linkable.hint("merge"), ["doc_id", "text_hash"], "left_semi")
    sets = scratch.save(document_sets(texts).where("n > 0"), "sets")
    labels = scratch.save(nodes.select("id", F.col("id").alias("comp")), "labels-0")
    active = scratch.save(active.select("key", "id").join(nodes, "id"), "active-0")
    pivots_per_bucket, k = 1, 0
    while True:
        k += 1
        now = active.join(labels, "id")
        by = now.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
        open_ = by.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                      F.max_by("comp", F.struct("n", "comp")).alias("main")).where("lo != hi").select("key", "main")
        now = scratch.save(now.join(open_, "key").select("key", "id", "comp", "main", "degree", "home"), f"now-{k}")
        if now.isEmpty():
            break
        # the main component of a bucket needs no pivot: the others meet all of it
        others = now if k == 1 else now.where("comp != main")
        order = Window.partitionBy("key").orderBy(F.col("degree").desc(), "id")
        chosen = others.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= pivots_per_bucket)
        chosen = chosen.select("id", "home").distinct()
        many = chosen.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / PIVOTS).alias("parts"))
        pivots = scratch.save(chosen.join(many, "home").select(
            "id", F.xxhash64("home", F.pmod(F.xxhash64("id"), "parts")).alias("chunk")), f"pivots-{k}")
        keys = now.join(pivots, "id").select("chunk", "key").distinct()
        meet = now.select("key", "id").join(keys, "key").select("chunk", "id").distinct().join(labels, "id")
        meet = scratch.save(meet.join(sets.select("id", "n"), "id").groupBy("chunk", "id", "comp").agg(F.max("n").alias("n")), f"meet-{k}")
        parts = meet.groupBy("chunk").agg(F.ceil(F.greatest(F.count(F.lit(1)) / MEMBERS, F.sum("n") * 8 / SET_BYTES)).cast("int").alias("parts"))
        member = meet.join(parts, "chunk").select("chunk", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), "id", "comp", F.lit(False).alias("pivot"))
        asks = (pivots.join(labels, "id").join(parts, "chunk")
                .select("chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "comp", F.lit(True).alias("pivot")))
        work = member.unionByName(asks).join(sets, "id")

        def compare(pdf: pd.DataFrame) -> pd.DataFrame:
            p, m = pdf[pdf["pivot"]], pdf[~pdf["pivot"]]
            found = set()
            if len(p) and len(m):
                a, b = m["comp"].to_numpy(), p["comp"].to_numpy()
                links = linked(p, m, percent) & (a[:, None] != b[None, :])
                found = forest(links, a, b)
            return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

        edges = scratch.save(work.groupBy("chunk", "part").applyInPandas(compare, "a long, b long").distinct(), f"edges-{k}")
        if not edges.isEmpty():
            merged = components(edges, scratch, f"merge-{k}").select(F.col("id").alias("comp"), "label")
            labels = scratch.save(labels.join(merged, "comp", "left").select("id", F.coalesce("label", "comp").alias("comp")), f"labels-{k}")
        active = scratch.save(now.select("key", "id", "degree", "home").join(pivots.select("id"), "id", "left_anti"), f"active-{k}")
        for old in ("now", "meet", "active" if k > 1 else "buckets"):
            scratch.drop(old if old == "buckets" else f"{old}-{k - (old == 'active')}")
        pivots_per_bucket *= 8
    for old in ("sets", "nodes", "linkable", f"now-{k}", f"active-{k - 1}"):  # the result reads features, classes and labels alone
        scratch.drop(old)
    # a component is named by its smallest doc_id; should several of its sets have that id, the one with the least node is kept
    sets_of = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "digest", F.col("rep.doc_id").alias("rep"), "node", F.coalesce("comp", "node").alias("comp"))
    least = sets_of.groupBy("comp").agg(F.min(F.struct("rep", "node")).alias("least"))
    rep = sets_of.join(least, "comp").select("digest", F.col("least.rep").alias("comp"), (F.col("node") == F.col("least.node")).alias("first"))
    out = feats.select("doc_id", "text_hash", "n_shingles", "digest").join(rep, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    kept = (component == F.col("doc_id")) & F.coalesce("first", F.lit(True))
    return out.select("doc_id", "text_hash", "n_shingles", "digest", component.alias("component_id"),
                      F.when(F.col("doc_id").isNull(), F.lit(True)).otherwise(kept).alias("kept"))
