"""Secret scans: known patterns, and character Markov models of random strings.

Two first-order Markov models over the characters of keys and tokens are trained
from labelled samples: random strings (values the patterns found, and digests in
several alphabets) and ordinary words and identifiers.  A long run of key
characters is a secret where the log-likelihood ratio of the two models is high;
in a run that is ordinary as a whole, its best-scoring stretches are.
Everything is Column code.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.llm.common import running

# The patterns of the known kinds, in the order that breaks ties.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
#: Cheap tests that every text with a match passes.
HINT = {"assign": r"(?i:pass|secret|token|key)[a-zA-Z]*[\"']?\x20*[:=]", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
ASSIGN_LEAST = 6
#: Runs of key characters that are scored.  Shorter ones cannot be told from words: of so few pairs the ratio's spread is as large as the threshold.
RUN = r"[A-Za-z0-9+/_=-]{12,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Log-likelihood ratio from which a run counts as random: odds of 10,000 to 1.
THRESHOLD = math.log(10_000)
#: Characters a stretch inside a run has at least; separators that it is widened to.
LEAST = 10
SEPARATORS = "/_=-"
#: Bound of the documents that training samples are taken from.
MAX_DOCS = 2000
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def located(df: DataFrame, name: str, pattern: str, hint: str | None, rank: int, kind: str) -> DataFrame:
    """Add array column ``name``: leftmost non-overlapping matches in ``text`` as spans in code points, with their strings."""
    has = F.col("text").rlike(hint or pattern)
    df = df.withColumns({
        "_gaps": F.when(has, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>")),
        "_hits": F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))})
    df = df.withColumn("_steps", F.transform("_hits", lambda h, i: F.length(F.get("_gaps", i)) + F.length(h)))
    df = df.withColumn("_before", running(F.col("_steps")))
    span = F.transform("_hits", lambda h, i: F.struct(
        (F.get("_before", i) + F.length(F.get("_gaps", i))).alias("start"), F.lit(rank).alias("rank"),
        (F.get("_before", i) + F.get("_steps", i)).alias("end"), F.lit(kind).alias("kind"), h.alias("hit")))
    return df.withColumn(name, span).drop("_gaps", "_hits", "_steps", "_before")


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``assign, access, hex`` span arrays; an assignment counts with a value of six characters or more."""
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        df = located(df, kind, pattern, HINT[kind], rank, kind)
    value = lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= ASSIGN_LEAST
    return df.withColumn("assign", F.filter("assign", value))


def samples(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Labelled training strings ``s, random`` from at most about ``max_docs`` documents chosen by a hash."""
    n = docs.count()
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30))  # by the text as well: ids may be missing
    some = docs.where(draw < int(min(1.0, max_docs / max(1, n)) * (1 << 30))).select(
        F.concat_ws(" ", F.col("doc_id").cast("string"), F.when(F.col("doc_id").isNull(), F.xxhash64("text").cast("string"))).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit("sample"), "id"), 256)
    digests = F.array(digest, F.upper(F.md5("id")), F.base64(F.unhex(digest)), F.translate(F.base64(F.unhex(F.sha1("id"))), "+/", "-_"))
    values = F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda s: F.length(s) >= 16)
    found = F.concat(digests, values, F.regexp_extract_all("text", F.lit(r"[0-9a-f]{24,}"), F.lit(0)))
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z/_-]{3,}|[0-9]{3,})(?![A-Za-z0-9+/_=-])"), F.lit(0))
    return some.select(F.explode(found).alias("s"), F.lit(True).alias("random")).unionByName(
        some.select(F.explode(words).alias("s"), F.lit(False).alias("random")))


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> list[float]:
    """Log-likelihood ratios of all character pairs (random against ordinary), row by row of the alphabet."""
    pairs = samples(docs, max_docs).where(F.length("s") > 1).select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, F.lit(2)))).alias("pair"))
    # at most two rows per character pair reach the driver
    counts = {(r["pair"], r["random"]): r["count"] for r in pairs.groupBy("pair", "random").count().collect()}
    out = []
    for a in ALPHABET:
        total = {k: sum(counts.get((a + b, k), 0) for b in ALPHABET) for k in (True, False)}
        for b in ALPHABET:
            p, q = ((counts.get((a + b, k), 0) + 0.5) / (total[k] + 0.5 * len(ALPHABET)) for k in (True, False))
            out.append(math.log(p / q))
    return out


def steps(s: Column, table: Column) -> Column:
    """Log-likelihood ratios of the character pairs of a string of alphabet characters."""
    code = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pairs = lambda c: F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.get(table, F.get(c, i - 1) * len(ALPHABET) + F.get(c, i)))
    return F.get(F.transform(F.array(code), pairs), F.lit(0))  # the codes are made once, not for every pair


def stretches(s: Column, ratios: Column, threshold: float) -> Column:
    """Array of (lo, hi): the best-scoring stretches of a string, each widened to the separators around it.

    A running sum of the pairs' ratios starts anew where it falls to 0 or by the
    threshold below its highest value; a stretch ends at that value and counts if
    it reaches the threshold.
    """
    bounds = "array<struct<lo:int,hi:int>>"
    start = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("lo"), F.lit(0).alias("hi"),
                     F.array().cast(bounds).alias("out"))

    def closed(acc):
        done = (acc["best"] >= threshold) & (acc["hi"] - acc["lo"] >= LEAST)
        found = F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi"))
        return F.when(done, F.concat(acc["out"], F.array(found))).otherwise(acc["out"])

    def step(acc, x):  # x belongs to the characters at and at + 1
        at, total = (acc["at"] + 1).alias("at"), acc["sum"] + x
        anew = (total <= 0) | (total < acc["best"] - threshold)
        return F.when(anew, F.struct(at, F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), at.alias("lo"), at.alias("hi"), closed(acc).alias("out"))).otherwise(
            F.struct(at, total.alias("sum"), F.greatest(total, acc["best"]).alias("best"), acc["lo"].alias("lo"),
                     F.when(total > acc["best"], acc["at"] + 2).otherwise(acc["hi"]).alias("hi"), acc["out"].alias("out")))

    found = F.aggregate(ratios, start, step, closed)
    plain = F.translate(s, SEPARATORS, SEPARATORS[0] * len(SEPARATORS))
    before = lambda k: F.length(F.substring_index(F.substring(plain, F.lit(1), k), SEPARATORS[0], -1))
    after = lambda k: F.length(F.substring_index(F.substring(plain, k + 1, F.length(s)), SEPARATORS[0], 1))
    return F.array_distinct(F.transform(found, lambda x: F.struct((x["lo"] - before(x["lo"])).alias("lo"), (x["hi"] + after(x["hi"])).alias("hi"))))


def uncovered(run: Column, base: Column) -> Column:
    """Array of (start, end): the parts of a run that no base span covers."""
    met = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    start = F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    part = lambda lo, hi: F.array(F.struct(lo.alias("start"), hi.alias("end")))
    return F.aggregate(
        met, start,
        lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.when(
            b["start"] > acc["at"], F.concat(acc["out"], part(acc["at"], b["start"]))).otherwise(acc["out"]).alias("out")),
        lambda acc: F.when(acc["at"] < run["end"], F.concat(acc["out"], part(acc["at"], run["end"]))).otherwise(acc["out"]))


def scan(docs: DataFrame, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs and ``base`` and ``spans``: arrays of (start, rank, end, kind), by start, then kind.

    ``base`` holds the pattern matches; ``spans`` adds what looks random in runs of
    12 characters or more (kind ``markov``): the whole run, or its part outside the
    base spans, or else the stretches in it that do.  Offsets are code points, the
    end exclusive.  Null text is the empty text (no spans); repeated rows have the same
    spans; an empty table stays empty.
    """
    own = [c for c in docs.columns if c not in ("base", "spans")]
    df = docs.select(F.struct(*own).alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    df = located(base_spans(df), "runs", RUN, None, len(KINDS), "markov")
    bare = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]).cast(SPAN))
    df = df.withColumn("base", F.array_sort(F.concat(*(bare(k) for k in KINDS))))
    model = F.from_json(F.lit(json.dumps(table)), "array<double>")
    parts = F.flatten(F.transform("runs", lambda r: F.transform(uncovered(r, F.col("base")), lambda p: F.struct(
        p["start"].alias("start"), F.substring(r["hit"], p["start"] - r["start"] + 1, p["end"] - p["start"]).alias("hit")))))
    df = df.withColumn("_parts", F.transform(F.filter(parts, lambda p: F.length(p["hit"]) >= LEAST), lambda p: F.struct(
        p["start"].alias("start"), p["hit"].alias("hit"), steps(p["hit"], model).alias("steps"))))
    total = lambda p: F.aggregate(p["steps"], F.lit(0.0), lambda acc, x: acc + x)
    whole = lambda p: F.array(F.struct(F.lit(0).alias("lo"), F.length(p["hit"]).alias("hi")))
    found = F.transform("_parts", lambda p: F.transform(
        F.when(total(p) >= threshold, whole(p)).otherwise(stretches(p["hit"], p["steps"], threshold)),
        lambda x: F.struct((p["start"] + x["lo"]).alias("start"), F.lit(len(KINDS)).alias("rank"), (p["start"] + x["hi"]).alias("end"), F.lit("markov").alias("kind")).cast(SPAN)))
    df = df.withColumn("spans", F.array_sort(F.concat("base", F.flatten(found))))
    return df.select("_row.*", "base", "spans")


def listed(spans) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(scanned: DataFrame, mark: str = "<secret>") -> DataFrame:
    """The scanned rows with every stretch of ``text`` that spans cover replaced by the mark; other texts stay as they are."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        gap = F.concat(F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(gap))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring("text", acc["at"] + 1, F.length("text"))))
    return scanned.withColumn("text", F.when(F.size("spans") > 0, done).otherwise(F.col("text")))
