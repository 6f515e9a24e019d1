import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as cp
from llm_data import SF, docs, empty, odd  # noqa: F401


def staged(spark, docs, upto, tmp):
    for k, (_, stage) in enumerate(cp.STAGES[:upto]):
        stage(spark, docs, SF).write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
    return docs


def test_registered_and_in_order():
    q = E.queries()
    assert q["pipeline"] is cp.run and len([n for n in q if re.match(r"op\d+_", n)]) == 13
    assert [s.__name__ for _, s in cp.STAGES] == ["keep_quality", "drop_near_duplicates", "redact_secrets", "mix_sources", "pack_sequences"]


def test_stages_take_effect(spark, docs, tmp_path):
    good = staged(spark, docs, 1, tmp_path / "a")
    assert good.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    n_good = docs.join(labels.where("quality = 1"), "doc_id").count()
    n_bad = docs.join(labels.where("quality = 0"), "doc_id").count()
    assert good.join(labels.where("quality = 1"), "doc_id").count() == n_good  # clean documents stay
    assert good.join(labels.where("quality = 0"), "doc_id").count() < 0.6 * n_bad
    once = cp.drop_near_duplicates(spark, good, SF)
    groups = {r.doc_id: r.kept for r in __import__("terrasol.llm.near_dedup", fromlist=["x"]).near_duplicates(good).collect()}
    assert sorted(r.doc_id for r in once.collect()) == sorted(d for d, k in groups.items() if k)
    clean = cp.redact_secrets(spark, good, SF)
    before = {r.doc_id: r.text for r in good.collect()}
    for r in clean.collect():
        assert not re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r.text) and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or "<secret>" in r.text
    mixed = cp.mix_sources(spark, good, SF)
    assert mixed.columns == docs.columns and {r.text for r in mixed.collect()} <= set(before.values())


def test_run_packs_what_the_stages_leave(spark):
    got = cp.run(spark, SF).collect()
    assert got and all(1 <= r.length <= 1024 and r.offset + r.length <= 1024 for r in got)


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_odd_and_empty_tables(spark, odd, empty, k):
    name, stage = cp.STAGES[k]
    assert stage(spark, empty, SF).collect() == []
    out = stage(spark, odd, SF)
    rows = out.collect()
    if k < 4:
        assert out.columns == odd.columns
    if k == 1:
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [*((False, d) for d in (1, 2, 3, 4, 7, 9, 10)), (True, 0)]
    if k == 2:
        assert len(rows) == odd.count() and sum("<secret>" in (r.text or "") for r in rows) == 1
    if k == 3:
        assert {r.doc_id for r in rows} <= {r.doc_id for r in odd.collect()}


def test_dedup_stage_keeps_different_texts_of_one_id(spark):
    a, b = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf at ", "words that stand nowhere else in this table at all"
    rows = [(3, a + "night"), (7, a + "noon"), (7, b), (7, b), (7, b.upper()), (5, "x y"), (5, "z"), (5, "z"), (None, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text.lower()) for r in cp.drop_near_duplicates(spark, df, SF).collect()]
    assert sorted(got, key=str) == sorted([(3, a + "night"), (7, b), (5, "x y"), (5, "z"), (None, b)], key=str)


CLASHES = ("_id", "_hash", "_own", "_copy", "_copies", "_rows", "_row", "_key", "_n", "_maybe", "_stays", "_doc_id", "_source", "_size", "score", "kept")


def test_stages_leave_columns_with_their_own_names_alone(spark, docs):
    more = docs.orderBy("doc_id").limit(60)
    more = more.select("*", *(F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))
    for _, stage in cp.STAGES[:4]:
        out = stage(spark, more, SF)
        assert out.columns == more.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHES)


def test_rows_without_id_share_their_copies_exactly(spark):
    from terrasol.llm import mixing
    rows = [(None, "a", "one two three")] * 40 + [(k, "b", "w " * (k % 9 + 1)) for k in range(60)] + [(None, None, f"x{k} y z") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    want = {tuple(r)[:3]: r.copies for r in mixing.mix(df).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies")).collect()}
    got = cp.mix_sources(spark, df, SF).groupBy("doc_id", "source", mixing.word_count("text").alias("size")).count().collect()
    assert {(r.doc_id, r.source, r.size): r["count"] for r in got} == {k: v for k, v in want.items() if v}
