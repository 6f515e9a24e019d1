from terrasol.operators.profile import profile


def test_profile_nulls_distinct_quantiles(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (3, 4.0), (None, 4.0)], "a int, b double")
    got = {r.column_name: r for r in profile(df, exact_distinct=True, quantiles=True).collect()}
    a, b = got["a"], got["b"]
    assert (a.min, a.max, a.n_distinct, a["count"], a.null_percentage) == (1.0, 3.0, 2, 3, 25.0)
    assert (b.min, b.max, b.n_distinct, b["count"], b.null_percentage) == (2.0, 4.0, 2, 3, 25.0)
    assert abs(a.avg - 5 / 3) < 1e-12 and b.q50 == 4.0


def test_profile_covers_every_type(spark):
    import datetime as dt
    df = spark.createDataFrame([("b", dt.date(2020, 1, 2), True), (None, dt.date(2019, 1, 2), None), ("a", None, True)], "t string, d date, f boolean")
    for exact in (False, True):
        got = {r.column_name: (r.min, r.min_text, r.max_text, r.n_distinct, r["count"]) for r in profile(df, exact_distinct=exact).collect()}
        assert got == {"t": (None, "a", "b", 2, 2), "d": (None, "2019-01-02", "2020-01-02", 2, 2), "f": (None, "true", "true", 1, 2)}


def test_sketches_of_increments_merge(spark):
    from pyspark.sql import functions as F
    from terrasol.operators import profile as p
    df = spark.range(30_000).select(F.when(F.col("id") % 10 > 0, (F.col("id") * 7919) % 20_011).alias("x"), F.concat(F.lit("t"), F.col("id") % 300).alias("t"), F.lit(None).cast("double").alias("n"))
    parts = [p.sketch(df.where(c)) for c in ("x < 3000", "x >= 3000", "x is null", "false")]
    merged = parts[0]
    for q in parts[1:]:
        merged = merged.unionByName(q)
    got = {r.column_name: r for r in p.read_sketches(p.merge_sketches(merged)).collect()}
    exact = {r.column_name: r for r in p.profile(df, exact_distinct=True).collect()}
    for c in ("x", "t", "n"):
        assert (got[c]["count"], got[c].min, got[c].max, got[c].min_text, got[c].max_text) == tuple(exact[c][k] for k in ("count", "min", "max", "min_text", "max_text"))
        assert abs(got[c].n_distinct - exact[c].n_distinct) <= p.DISTINCT_ERROR * exact[c].n_distinct
        assert abs(got[c].null_percentage - exact[c].null_percentage) < 1e-9
    assert abs(got["x"].avg - exact["x"].avg) < 1e-6 and abs(got["x"].std - exact["x"].std) < 1e-6
    xs = sorted(r.x for r in df.where("x is not null").collect())
    for q in (25, 50, 75):
        v = got["x"][f"q{q}"]
        assert abs(sum(x <= v for x in xs) / len(xs) - q / 100) <= p.RANK_ERROR
    assert got["n"].q50 is None and got["n"].n_distinct == 0
