from pyspark.sql import functions as F

from terrasol.operators import ml, scorers, scoring

TEXTS = ["friche industrielle et friche", "zone natura 2000, ZNIEFF", "rien", "", None, "résineux. Vignes en exploitation " * 50, "boum friche"]


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, pdf_text string").withColumn("error", F.lit("old"))


def test_rules_as_a_plugin_equal_the_column_rules(spark):
    df = frame(spark)
    cols = [f"{k}_score" for k in scoring.RULE_PHRASES]
    got = {r.id: [r[c] for c in cols] for r in scorers.score_documents(df, scorers.RuleScorer(2)).collect()}
    want = {r.id: [r[c] for c in cols] for r in scoring.rule_scores(df.where("pdf_text is not null"), "pdf_text").collect()}
    assert got.pop(4) == [None] * 4 and got == want


def test_a_failing_text_costs_no_other_its_scores(spark):
    class Failing(scorers.RuleScorer):
        """Fails on any batch that holds the word boum."""

        def score(self, state, texts):
            if any("boum" in t for t in texts):
                raise ValueError("boum")
            return scorers.RuleScorer.score(self, state, texts)

    got = {r.id: r for r in scorers.score_documents(frame(spark).coalesce(1), Failing(2)).collect()}
    assert got[6].error == "ValueError: boum" and got[6].surfaces_agricoles_score is None and got[6].scored_chars is None
    assert got[4].error == "no text within the budget"
    assert all(got[k].error is None and got[k].surfaces_naturelles_score is not None for k in (0, 1, 2, 3, 5))


def test_budget_cuts_before_scoring(spark):
    got = {r.id: r.scored_chars for r in scorers.score_documents(frame(spark), scorers.RuleScorer(), context=30, reserve=10).collect()}
    assert got[0] == len(TEXTS[0]) and got[5] == len(TEXTS[5]) // 16 and got[4] is None


def test_state_is_made_once_per_worker_iterator(spark):
    class Counting(scorers.RuleScorer):
        def setup(self):
            self.made = getattr(self, "made", 0) + 1
            return scorers.RuleScorer.setup(self)

        def score(self, state, texts):
            return [{**s, "surfaces_naturelles": float(self.made)} for s in scorers.RuleScorer.score(self, state, texts)]

    df = spark.range(2000).select("id", F.lit("friche").alias("pdf_text")).coalesce(1)
    out = scorers.score_documents(df, Counting(), batch=10)
    assert {r[0] for r in out.select("surfaces_naturelles_score").distinct().collect()} == {1.0}


def test_trained_model_as_a_plugin_equals_the_pipeline(spark):
    rows = [(k, f"bon vent {k % 7} soleil" if k % 2 else f"mauvais temps {k % 5} pluie", k % 2) for k in range(200)]
    df = spark.createDataFrame(rows, "id int, pdf_text string, y int")
    w, b = ml.linear_weights(df, "pdf_text", "y")
    got = scorers.score_documents(df, scorers.LinearScorer({"y": (w, b)})).select("y", "y_score").collect()
    assert all((r.y_score > 0.5) == (r.y == 1) for r in got)
    from pyspark.ml.feature import HashingTF
    tf = HashingTF(numFeatures=1 << 14)
    for word in ("a", "soleil", "énergie", "abcdefg", "日本語", ""):
        assert tf.indexOf(word) == scorers.murmur3(word.encode()) % (1 << 14)
