import pytest
from pyspark.sql import functions as F

from terrasol.operators.joins import null_safe_left_join

LEFT = [(1, "a", "x"), (2, "a", None), (3, None, "x"), (4, None, None), (5, None, None), (6, "b", "y"), (6, "b", "y"), (7, "c", "z")]
RIGHT = [("a", "x", 10), ("a", None, 20), (None, None, 30), (None, None, 31), ("b", "y", 40), ("b", "y", 41), (None, "w", 50)]


def test_null_keys_match_null_keys(spark):
    left, right = spark.createDataFrame(LEFT, "id int, k string, d string"), spark.createDataFrame(RIGHT, "rk string, rd string, v int")
    got = sorted((r.id, r.v or 0) for r in null_safe_left_join(left, right, [("k", "rk"), ("d", "rd")]).collect())
    want = sorted((i, v) for i, k, d in LEFT for v in ([v for rk, rd, v in RIGHT if rk == k and rd == d] or [0]))
    assert got == want
    out = null_safe_left_join(left.withColumn("_salt", F.lit(1)), right, [("k", "rk"), ("d", "rd")])
    assert out.columns == ["id", "k", "d", "_salt", "rk", "rd", "v"]


@pytest.mark.parametrize("rows", [0, 4000])
def test_the_null_group_is_dealt_over_many_tasks(spark, rows):
    left = spark.range(rows).select(F.col("id"), F.lit(None).cast("string").alias("k"))
    right = spark.createDataFrame([(None, 1), ("a", 2)], "rk string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = null_safe_left_join(left, right, [("k", "rk")]).withColumn("_task", F.spark_partition_id())
        sizes = [r["count"] for r in out.where("v = 1").groupBy("_task").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == rows and (not rows or (len(sizes) > 8 and max(sizes) < rows / 4))
