"""Mixing sources to target weights by balanced sampling (cube method).

Every document of a source is wanted ``f = target / source words`` times.  It is
taken ``floor(f)`` times for sure; the rest is an inclusion probability that the
cube method turns into 0 or 1 while it keeps two totals of the source at their
expected values: the number of documents and the number of words.  The flight
moves three probabilities at a time through the null space of the constraints
until one of them is 0 or 1.  It runs on salted chunks of a source; the at most
two undecided documents of each chunk fly again in ever fewer chunks, and the
two that remain of a source are the landing problem.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import WORD, Scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
CHUNK = 5_000
EPS = 1e-9


def word_count(text) -> Column:
    """Words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Add ``position`` (from 0): order by code point, null last, without one task for all sources."""
    spread = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    spread = Scratch(sources.sparkSession, "sources").save(spread, "ranges")
    inside = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    sizes = spread.groupBy("_part").count()
    # one row per range partition
    before = sizes.select("_part", F.coalesce(F.sum("count").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (spread.withColumn("_at", F.row_number().over(inside) - 1).join(before, "_part")
            .withColumn("position", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before"))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, n_docs, target`` per source.

    All targets sum to ``share`` of all sizes, split by weight; a target above
    ``cap`` times its source stops there and its excess is shared again by weight
    among the others, until none is above.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("position") % len(weights) + 1).cast("int"))
    table = Scratch(sized.sparkSession, "targets").save(ranked_sources(per).withColumn("weight", w), "sources")
    total = table.agg(F.sum("source_size").alias("s")).first().s or 0
    level, limit = 0.0, F.col("source_size") * cap  # words per unit of weight
    while True:
        full = F.col("weight") * level >= limit
        r = table.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("fixed"),
                      F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        new = (share * total - r.fixed) / r.open if r.open else level
        if new <= level:
            break
        level = new
    return table.select("source", "source_size", "n_docs", F.least(F.col("weight") * level, limit).alias("target"))


def fly(p: np.ndarray, x: np.ndarray, seed: int) -> np.ndarray:
    """Flight phase: move p until at most ``x.shape[1]`` entries are strictly between 0 and 1.

    ``p @ x`` stays as it is.  The window holds one unit more than there are
    constraints, so its null space is never empty.
    """
    p, width = p.copy(), x.shape[1] + 1
    rng = np.random.default_rng(seed)
    todo = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS]
    window: list[int] = []
    draws = iter(rng.random(len(todo) + width))
    todo.reverse()
    while True:
        while len(window) < width and todo:
            window.append(todo.pop())
        if len(window) < width:
            return p
        a, b, c = window
        (a0, a1), (b0, b1), (c0, c1) = x[a], x[b], x[c]
        u = (b0 * c1 - c0 * b1, c0 * a1 - a0 * c1, a0 * b1 - b0 * a1)
        if not any(u):  # parallel rows: any direction that keeps the first total
            u = (1.0, -1.0, 0.0)
        up = down = np.inf
        for i, d in zip(window, u):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, -p[i] / d), min(down, (p[i] - 1) / d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(window, u):
            p[i] += step * d
        window = [i for i in window if EPS < p[i] < 1 - EPS]


def land(p: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Landing of at most two units: keep the word total with one more move, then round by chance."""
    p = p.copy()
    rng = np.random.default_rng(seed)
    open_ = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS]
    if len(open_) == 2:
        i, j = open_
        u = (float(size[j]), -float(size[i])) if size[i] or size[j] else (1.0, -1.0)
        ups = [(1 - p[k]) / d if d > 0 else -p[k] / d for k, d in zip(open_, u) if d]
        downs = [p[k] / d if d > 0 else (p[k] - 1) / d for k, d in zip(open_, u) if d]
        up, down = min(ups), min(downs)
        step = up if rng.random() * (up + down) < down else -down
        p[i] += step * u[0]
        p[j] += step * u[1]
    for i in open_:
        p[i] = float(rng.random() < p[i]) if EPS < p[i] < 1 - EPS else round(p[i])
    return p


def _seed(*key) -> int:
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, chunk: int = CHUNK) -> DataFrame:
    """Per document ``doc_id, size, source, source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document (at most ``ceil(f)``).
    Null text has size 0, a null source is a source of its own, repeated rows are
    units of their own, an empty table gives an empty result.  Chunks, order and
    random draws depend on the rows alone, so reruns agree.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    sized = scratch.save(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    targets = scratch.save(source_targets(sized, weights, share, cap), "targets")
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(f + EPS)
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    t = targets.withColumn("_key", key(F.col("source"))).withColumnRenamed("source", "_source")
    units = (sized.withColumn("_key", key(F.col("source"))).join(t, "_key")
             .withColumn("base", base).withColumn("p", F.greatest(f - F.col("base"), F.lit(0.0)))
             .withColumn("draw", F.xxhash64("doc_id", "size"))
             .select("doc_id", "source", "size", "source_size", "target", "base", "p", "draw", F.col("n_docs").alias("n")))
    schema = units.schema

    def flight(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "draw", "doc_id"], ascending=[False, True, True], kind="stable")
            size = pdf["size"].to_numpy(np.float64)
            x = np.column_stack([np.ones(len(size)), size])
            seed = _seed(pdf["source"].iloc[0], int(pdf["draw"].iloc[0]), len(pdf))
            p = fly(pdf["p"].to_numpy(np.float64), x, seed)
            if last:
                p = land(p, size, seed ^ 1)
            return pdf.assign(p=p)[[c.name for c in schema]]
        return run

    decided, rounds, open_ = [], 0, units
    while True:
        # as many chunks of a source as its units need; the second key salts a hot source
        chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / chunk))
        most = open_.agg(F.max("n").alias("n")).first().n or 0
        last = most <= chunk
        flown = open_.withColumn("_chunk", F.pmod(F.xxhash64("draw", F.lit(rounds)), chunks)).groupBy("source", "_chunk")
        flown = scratch.save(flown.applyInPandas(_drop(flight(last), "_chunk"), schema), f"round{rounds}")
        between = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
        decided.append(flown.where(~between))
        if last:
            break
        left = flown.where(between).drop("n")
        counts = left.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("_key", key(F.col("source"))).drop("source")
        open_ = scratch.save(left.withColumn("_key", key(F.col("source"))).join(counts, "_key").select(*schema.names), f"open{rounds}")
        rounds += 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    copies = (F.col("base") + F.round("p")).cast("long")
    return out.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def _drop(run, name: str):
    return lambda pdf: run(pdf.drop(columns=[name]))
