"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integers (a component is a term with a weight, zero
components have no posting).  Candidates are packed into blocks with one posting
list per term.  For a block of queries every term scatters its weighted postings
into dense score arrays; a partition selection keeps the k best of each block
and a merge by query keeps the k best of all.  Every query meets every candidate
block, so the answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.llm.common import Scratch

#: Rows of a block.  A candidate block is copied once per query block, so these are large: all copies together hold
#: 1 / ``QUERY_BLOCK`` of the pairs of rows.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 16384
#: Score arrays in memory: so many candidates by so many queries.
TILE = (2048, 256)
NONE = np.iinfo(np.int64).min


def integer_vectors(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, v`` with v = floor(scale * x) as 64-bit integers.

    Rows with a null id, a null vector or a null or non-finite component take no
    part.  Components beyond 64 bits are held at the largest 64-bit integer.
    """
    d = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(d, lambda x: F.floor(x * scale)).alias("v")))


def packed(vectors: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block: ids ascending with their row numbers, row lengths and values as bytes (every row, also of a repeated id)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "_row"])
        ids, rows = pdf["vec_id"].to_numpy(np.int64), pdf["_row"].to_numpy(np.int64)
        lens = np.array([len(v) for v in pdf["v"]], np.int32)
        values = np.concatenate([np.empty(0, np.int64), *(np.asarray(v, np.int64) for v in pdf["v"])])
        low, high = (values.min(), values.max()) if len(values) else (0, 0)
        kind = next(t for t in ("i1", "i2", "i4", "i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
        return pd.DataFrame({name: [int(pdf["_block"].iloc[0])], f"{name}_ids": [ids.tobytes()], f"{name}_rows": [rows.tobytes()],
                             f"{name}_lens": [lens.tobytes()], f"{name}_kind": [kind], f"{name}_values": [values.astype(kind).tobytes()]})

    schema = f"{name} int, {name}_ids binary, {name}_rows binary, {name}_lens binary, {name}_kind string, {name}_values binary"
    # by row number: an id that a third of the rows have is dealt like any other
    block = F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int")
    return vectors.withColumn("_block", block).groupBy("_block").applyInPandas(run, schema)


def _rows(ids: bytes, rows: bytes, lens: bytes, kind: str, values: bytes) -> tuple[np.ndarray, ...]:
    """ids and row numbers, and the nonzero components as (row of the block, term, weight)."""
    n = np.frombuffer(lens, np.int32)
    w = np.frombuffer(values, kind).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    term = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
    keep = w != 0
    return np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64), row[keep], term[keep], w[keep]


def search_block(queries, candidates, k: int) -> tuple[np.ndarray, ...]:
    """(query ids, query rows, vec ids, scores) of the k best candidates of one block for each query of one block."""
    q_ids, q_num, q_row, q_term, q_w = queries
    c_ids, c_num, c_row, c_term, c_w = candidates
    terms = int(max(q_term.max(initial=-1), c_term.max(initial=-1))) + 1
    bound = float(np.abs(q_w).max(initial=0)) * float(np.abs(c_w).max(initial=0)) * max(terms, 1)
    dtype = np.int32 if bound < 2**31 else np.int64
    out = []
    for q0 in range(0, len(q_ids), TILE[1]):
        q1 = min(q0 + TILE[1], len(q_ids))
        at = (q_row >= q0) & (q_row < q1)
        weights = np.zeros((terms, q1 - q0), dtype)
        weights[q_term[at], q_row[at] - q0] = q_w[at]
        best_s = np.empty((q1 - q0, 0), np.int64)
        best_i = np.empty((q1 - q0, 0), np.int64)
        for c0 in range(0, len(c_ids), TILE[0]):
            c1 = min(c0 + TILE[0], len(c_ids))
            lo, hi = np.searchsorted(c_row, [c0, c1])
            order = np.argsort(c_term[lo:hi], kind="stable")
            post, post_w = (c_row[lo:hi] - c0)[order], c_w[lo:hi][order].astype(dtype)
            ends = np.searchsorted(c_term[lo:hi][order], np.arange(terms + 1))
            scores = np.zeros((c1 - c0, q1 - q0), dtype)
            for t in range(terms):  # one term at a time: its postings add to the scores of all queries that have it
                rows = slice(ends[t], ends[t + 1])
                if ends[t] < ends[t + 1] and weights[t].any():
                    scores[post[rows]] += post_w[rows, None] * weights[t]
            s = np.ascontiguousarray(scores.T).astype(np.int64)
            ids = np.broadcast_to(c_ids[c0:c1], s.shape)
            s = np.concatenate([best_s, np.where(c_num[None, c0:c1] == q_num[q0:q1, None], NONE, s)], axis=1)
            ids = np.concatenate([best_i, ids], axis=1)
            if s.shape[1] > k:  # columns stand by ascending id, so of equal scores the first ones win
                cut = -np.partition(-np.where(s == NONE, -2**62, s), k - 1, axis=1)[:, k - 1:k]
                above = s > cut
                tied = s == cut
                keep = above | (tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)))
                col = np.nonzero(keep)[1].reshape(len(s), -1) if (keep.sum(axis=1) == k).all() else np.argsort(~keep, axis=1, kind="stable")[:, :k]
                s, ids = np.take_along_axis(s, col, 1), np.take_along_axis(ids, col, 1)
            best_s, best_i = s, ids
        q, num = (np.broadcast_to(x[q0:q1, None], best_s.shape) for x in (q_ids, q_num))
        fine = best_s != NONE
        out.append((q[fine], num[fine], best_i[fine], best_s[fine]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 4


def top_k(vectors: DataFrame, asks: Column, k: int = 20) -> DataFrame:
    """Each query's k highest integer inner products: ``query_id, rank, vec_id, score``.

    ``vectors`` hold ``vec_id, v`` (array of long); the rows where ``asks`` holds are
    the queries.  A missing component counts as 0, an empty vector scores 0.  A query
    meets every row but itself: rows that repeat an id are queries and candidates of
    their own.  Ties go to the smaller vec_id; a query with fewer candidates gets them
    all; an empty table gives an empty result.  Scores are exact within 64 bits.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    # a row's number is written once, so that queries and candidates agree on it
    numbered = scratch.save(vectors.select("vec_id", "v", F.coalesce(asks, F.lit(False)).alias("_asks"), F.monotonically_increasing_id().alias("_row")), "rows")
    n = numbered.agg(F.count(F.lit(1)).alias("c"), F.count_if("_asks").alias("q")).first()
    c_blocks, q_blocks = -(-max(1, n.c) // CANDIDATE_BLOCK), -(-max(1, n.q) // QUERY_BLOCK)
    cands, asked = packed(numbered, c_blocks, "c"), packed(numbered.where("_asks"), q_blocks, "q")
    # block pairs, equi-joined on their key: each pair is a task's unit of work
    cands = cands.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asked = asked.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    schema = "query_id long, _row long, vec_id long, score long"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for r in pdf.itertuples(index=False):
                got = search_block(_rows(r.q_ids, r.q_rows, r.q_lens, r.q_kind, r.q_values), _rows(r.c_ids, r.c_rows, r.c_lens, r.c_kind, r.c_values), k)
                yield pd.DataFrame(dict(zip(("query_id", "_row", "vec_id", "score"), got)))

    pairs = asked.hint("shuffle_hash").join(cands, ["q", "c"])
    best = Window.partitionBy("query_id", "_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (pairs.mapInPandas(run, schema).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
