import math

import numpy as np

from pyspark.sql import functions as F

from terrasol.llm import topk_search
from terrasol.llm.queries import op2_topk
from llm_data import SF

SCHEMA = "vec_id long, embedding array<float>, label int, score long, v string"


def brute_force(rows, is_query, k):
    """rows: (id, integer vector); every query row's best candidates by score, then id; rows of one id one after the other."""
    out = {}
    for i, (q, a) in enumerate(rows):
        if is_query(q):
            scores = [(-sum(x * y for x, y in zip(a, b)), c) for j, (c, b) in enumerate(rows) if i != j]
            out.setdefault(q, []).extend((n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k]))
    return {q: sorted(v) for q, v in out.items()}


def grouped(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, [math.floor(64 * float(x)) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert grouped(op2_topk(spark, SF).collect()) == brute_force(rows, lambda q: q % 20 == 0, 20)


def test_odd_vectors_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk_search, "TILE", (5, 2))
    rng = np.random.default_rng(4)
    good = [(i, [float(x) for x in rng.integers(-3, 4, rng.integers(0, 6)) / 8]) for i in range(60)]
    good += [(i, good[7][1]) for i in range(60, 70)]  # ties
    good += [(20, [0.5, 0.25]), (20, [0.5, 0.25]), (40, good[40][1]), (5, good[5][1])]  # repeated ids and rows
    bad = [(100, None), (120, [1.0, None]), (140, [float("nan")]), (160, [float("inf")]), (None, [1.0])]
    rows = [(i, v, None, 1, "x") for i, v in good + bad]
    vectors = topk_search.integer_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = grouped(topk_search.top_k(vectors, F.expr("vec_id % 20 = 0"), 7).collect())
    pad = [(i, [math.floor(64 * x) for x in v] + [0] * (6 - len(v))) for i, v in good]
    assert got == brute_force(pad, lambda q: q % 20 == 0, 7)


def test_few_candidates_and_empty(spark):
    two = topk_search.integer_vectors(spark.createDataFrame([(0, [1.0], 0, 0, ""), (1, [2.0], 0, 0, "")], SCHEMA))
    assert grouped(topk_search.top_k(two, F.lit(True), 5).collect()) == {0: [(1, 1, 64 * 128)], 1: [(1, 0, 64 * 128)]}
    none = topk_search.integer_vectors(spark.createDataFrame([], SCHEMA))
    assert topk_search.top_k(none, F.lit(True)).collect() == []
    assert topk_search.top_k(two, F.lit(False)).collect() == []


def test_repeated_ids_are_rows_of_their_own_as_in_the_sql(spark, tmp_path):
    import duckdb
    from terrasol.llm.queries import ORACLES
    rows = [(0, [1.0]), (0, [5.0]), (1, [2.0]), (1, [3.0]), (20, [1.0]), (20, [1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.execute(ORACLES["op2_topk"]).fetchall())
    got = op2_topk(spark, str(tmp_path)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want and len(want) == 4 * 5
