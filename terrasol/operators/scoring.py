"""Model answers and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from terrasol.operators.evaluate import LABELS

TOKEN_LIMIT_STOP = "maxPredictedTokensReached"

ANSWER_SCHEMA = StructType([
    StructField("scores", StructType([StructField(name, DoubleType()) for name in LABELS.values()])),
    StructField("contexts", ArrayType(StringType())),
    StructField("explanation", StringType()),
])


def parse_answers(df: DataFrame, answer: str = "answer", stop_reason: str = "stop_reason") -> DataFrame:
    """Parse the fixed-schema JSON answer.

    * a JSON object and a normal stop → scores under canonical ``{key}_score``
      (a missing score stays null), contexts and explanation;
    * a JSON object cut by the token limit → everything null;
    * anything else (not JSON, not an object) → every score 0 (under the
      canonical names: deliberate fix of the original key mix-up).
    """
    is_obj = F.json_object_keys(F.col(answer)).isNotNull()
    parsed = F.from_json(F.col(answer), ANSWER_SCHEMA)
    cut = F.coalesce(F.col(stop_reason) == TOKEN_LIMIT_STOP, F.lit(False))
    status = F.when(~is_obj, "unparsed").when(cut, "truncated").otherwise("parsed")
    out = df.withColumn("_p", parsed).withColumn("status", status)
    for key, name in LABELS.items():
        out = out.withColumn(key + "_score", F.when(F.col("status") == "unparsed", F.lit(0.0))
                             .when(F.col("status") == "parsed", F.col("_p.scores").getField(name)))
    return (out.withColumn("contexts", F.when(F.col("status") == "parsed", F.col("_p.contexts")))
               .withColumn("explanation", F.when(F.col("status") == "parsed", F.col("_p.explanation")))
               .drop("_p"))


# Phrases of the land-type rules (lower case; each word may be plural).
RULE_PHRASES = {
    "surfaces_naturelles": ("friche carrière", "friche gravière", "friche ferroviaire", "friche routière", "friche mine", "znieff", "natura 2000",
                            "friche militaire", "friche activités de gestion de déchets", "friche aéroportuaire"),
    "surfaces_artificialisees": ("friche industrielle", "friche tertiaire", "friche commerciale", "friche portuaire",
                                 "friche agro industrielle", "carrière en exploitation"),
    "surfaces_forestieres": ("résineux", "monospécifique", "plantation", "landes des landes", "spontanée"),
    "surfaces_agricoles": ("friche", "en exploitation", "prairie permanente", "culture intensive", "arboriculture", "vigne"),
}
MAX_CONTEXTS = 3


def phrase_pattern(phrase: str) -> str:
    """A phrase over text whose words stand between two blanks each; a plural s is optional."""
    return "  ".join(w if w.endswith("s") or w.isdigit() or w in ("en", "de") else w + "s?" for w in phrase.split())


def rule_matches(text) -> F.Column:
    """Phrases found in a text as whole words: leftmost first, of several at one place the longest,
    so that "friche industrielle" is not also a "friche"."""
    phrases = sorted((p for ps in RULE_PHRASES.values() for p in ps), key=lambda p: (-len(p.split()), -len(p), p))
    padded = F.concat(F.lit("  "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "  "), F.lit("  "))
    return F.regexp_extract_all(padded, F.lit(" (" + "|".join(map(phrase_pattern, phrases)) + ") "), F.lit(1))


def rule_hits(matches, key: str) -> F.Column:
    """How many different phrases of a label are among the matches."""
    is_phrase = lambda p: lambda m: m.rlike(f"^{phrase_pattern(p)}$")
    found = [F.exists(matches, is_phrase(p)).cast("int") for p in RULE_PHRASES[key]]
    return sum(found[1:], found[0])


def rule_scores(df, text: str = "pdf_text", hits_for_certainty: int = 2):
    """Default pluggable scorer (M2): per label, the number of its phrases found in
    the text, 1 from ``hits_for_certainty`` phrases on; contexts are up to three
    sentences with a phrase.  A stand-in for a model server, written as Column
    code so it runs inside the JVM."""
    out = df.withColumn("_matches", rule_matches(F.col(text)))
    for key in RULE_PHRASES:
        out = out.withColumn(key + "_score", F.least(F.lit(1.0), rule_hits("_matches", key) / F.lit(float(hits_for_certainty))))
    sentences = F.split(F.col(text), r"(?<=[.!?])\s+")
    hits = F.filter(sentences, lambda s: F.size(rule_matches(s)) > 0)
    return (out.drop("_matches").withColumn("contexts", F.slice(hits, 1, MAX_CONTEXTS))
               .withColumn("explanation", F.concat(F.lit("keyword rules, "), F.size(hits).cast("string"),
                                                   F.lit(" matching sentences"))))
