from pyspark.sql import functions as F

from terrasol.functions import text as tx


def test_clean_text(spark):
    raw = "a==> picture [12 x 34] intentionally omitted <==b   c\x00d\n\tkeep"
    df = spark.createDataFrame([(raw,), (None,)], "t string")
    got = [r.c for r in df.select(tx.clean_text("t").alias("c")).collect()]
    assert got == ["ab cd\n\tkeep", None]


def test_context_spans(spark):
    text = "Le parc est situé sur une friche industrielle."
    ctx = "situé sur[SEP]  friche industrielle[SEP]absent"
    df = spark.createDataFrame([(text, ctx)], "t string, c string")
    r = df.select(tx.split_contexts("c").alias("cs")).select(
        "cs", tx.context_locations(F.lit(text), "cs").alias("loc")).collect()[0]
    assert r.cs == ["situé sur", " friche industrielle", "absent"]   # cleaned before the split
    assert [(x.start, x.length) for x in r.loc] == [(12, 9), (26, 20), (-1, 6)]


def test_chunks_cover_all_tokens(spark):
    words = " ".join(f"w{i}" for i in range(600))
    df = spark.createDataFrame([(words,), ("",)], "t string")
    got = [r.c for r in df.select(tx.chunks("t", 256, 10).alias("c")).collect()]
    assert [len(c) for c in got[0]] == [256, 256, 108]
    assert got[0][1][0] == "w246" and got[1] == []


def test_chunks_split_a_text_once(spark):
    df = spark.createDataFrame([("a b c",), (None,)], "t string").select(tx.chunks("t", 2, 1).alias("c"))
    assert [r.c for r in df.collect()] == [[["a", "b"], ["b", "c"], ["c"]], []]
    assert df._jdf.queryExecution().analyzed().toString().count("split(") == 1


def test_fit_budget_halves(spark):
    words = " ".join(["mot"] * 3000)
    df = spark.createDataFrame([(words,)], "t string")
    r = df.select(tx.fit_budget("t", 2000, 1000).alias("f")).collect()[0].f
    n = len(words)
    k = 0
    while len(words[: n >> k].split()) + 1000 > 2000:
        k += 1
    assert r.n_chars == n >> k


def test_highlight(spark):
    df = spark.createDataFrame([("Une Friche et une friche.", ["friche", " "])], "t string, cs array<string>")
    assert df.select(tx.highlight("t", "cs").alias("h")).collect()[0].h == \
        "Une <mark>Friche</mark> et une <mark>friche</mark>."
