import zlib
from collections import Counter, defaultdict

from llm_data import docs, empty, odd  # noqa: F401

from pyspark.sql import functions as F

from terrasol.llm import sharding as sh


def shards(spark, tree, n=20000):
    return [r[0] for r in sh.with_shard(spark.range(n), F.col("id").cast("string"), tree).orderBy("id").select("shard").collect()]


def test_columns_slots_and_growth(docs):  # noqa: F811
    tree = sh.even_tree(8)
    got = sh.shard_documents(docs, tree, sh.grown(tree, "region0", "rack0")).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    slots = defaultdict(list)
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(got) == len(texts)


def test_every_growth_takes_rows_only_into_itself(spark):
    tree = sh.even_tree(8)
    before = shards(spark, tree)
    for region, rack, weight in (("region0", "rack0", 1.0), ("region1", "rack2", 2.0), ("region9", "rack9", 0.5), ("region0", "rack0", 1.0)):
        tree = sh.grown(tree, region, rack, weight)
        after, new = shards(spark, tree), len(tree) - 1
        assert all(a == b or a == new for a, b in zip(after, before))
        share = weight / sum(s.weight for s in tree)
        assert abs(sum(a == new for a in after) / len(after) - share) < 0.02
        before = after


def test_shares_follow_weights(spark):
    tree = [sh.Shard(0, "a", "x", 1.0), sh.Shard(1, "a", "y", 3.0), sh.Shard(2, "b", "z", 4.0), sh.Shard(3, "b", "z", 0.0)]
    n = Counter(shards(spark, tree))
    assert 3 not in n and all(abs(n[k] / 20000 - w / 8) < 0.015 for k, w in ((0, 1), (1, 3), (2, 4)))


def test_a_changed_weight_moves_rows_of_its_subtrees_only(spark):
    tree = sh.even_tree(8)
    heavier = [s._replace(weight=2.0) if s.shard == 5 else s for s in tree]
    moved = {(a, b) for a, b in zip(shards(spark, tree), shards(spark, heavier)) if a != b}
    # region 1 grows: rows come into it from region 0, inside it only into rack 2, inside that only into shard 5
    assert all(b >= 4 for _, b in moved)
    assert all(b in (4, 5) for a, b in moved if a >= 4) and all(b == 5 for a, b in moved if a == 4)


def test_odd_rows_and_empty_table(odd, empty):  # noqa: F811
    got = sh.shard_documents(odd).collect()
    assert len(got) == 12 and {r["grown_shard"] for r in got} == {None}
    by = Counter((r["shard"], r["slot"]) for r in got)
    assert max(by.values()) == 1  # rows that repeat one another have slots of their own
    assert {r["size"] for r in got if r["doc_id"] == 1} == {1}
    assert sh.shard_documents(empty).collect() == []
    assert len({r["shard"] for r in sh.shard_documents(odd, key="lang").collect()}) <= 3


def test_hot_key_is_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sh, "BLOCK", 50)
    df = spark.range(0, 3000, 1, 3).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = sh.shard_documents(df).collect()
    assert sorted(r["slot"] for r in got) == list(range(3000)) and len({r["shard"] for r in got}) == 1
