"""A training corpus from the documents table in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrasol.llm import mixing, near_dedup, packing, quality, secrets
from terrasol.llm.common import Scratch, bitmap, marked
from terrasol.llm.queries import tokenizer_file
from terrasol.sources.tables import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.5 or more).

    Every row is judged by its own text; null and empty texts get the score of the
    model's bias; repeated rows stay or go together; an empty table stays empty.
    """
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    return quality.score(rows, weights, text=F.col("_row.text")).where(F.col("score") >= 0.5).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (the smallest id).

    Rows that repeat an id and a set of shingles: one of them stays, the one with the
    least hash of its text.  Rows without an id or without words are linked with
    nothing and stay; an empty table stays empty.
    """
    # rows are told apart by id and text, as one id may stand on different texts
    groups = near_dedup.judged(docs).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "kept",
                                            F.coalesce("digest", F.col("text_hash").cast("string").cast("binary")).alias("_same"))
    scratch = Scratch(spark, "dedup-stage")
    groups = scratch.save(groups, "groups")
    known = groups.where("kept and _id is not null").select("_id", "_same", "_hash")
    twice = scratch.save(known.groupBy("_id", "_same").agg(F.count(F.lit(1)).alias("_n"), F.min("_hash").alias("_first")).where("_n > 1"), "twice")
    # only rows that may go, or that may stand more than once, are moved
    drop = groups.where(~F.col("kept")).select("_id", "_hash").distinct()
    again = known.join(twice.hint("merge"), ["_id", "_same"]).select("_id", "_hash", (F.col("_hash") == F.col("_first")).alias("_stays")).distinct()
    fate = scratch.save(drop.withColumn("_stays", F.lit(False)).unionByName(again), "fate")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    rows = marked(rows, bitmap(fate, "_id", "_hash"), "_id", "_hash")
    met = rows.where("_maybe").join(fate.hint("merge"), ["_id", "_hash"], "left")
    once = met.where("_stays").groupBy("_id", "_hash").agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    parts = rows.where("not _maybe"), met.where("_stays is null"), once
    return parts[0].select("_row.*").unionByName(parts[1].select("_row.*")).unionByName(parts[2].select("_row.*"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark (``n_chars`` follows the new text).

    Null and empty texts stay as they are; repeated rows stay and change alike; an
    empty table stays empty.
    """
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    clean = secrets.redact(secrets.scan(rows, secrets.train(docs)))
    changed = F.size("spans") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("_row.text")),
           "n_chars": F.when(changed, F.length("text")).otherwise(F.col("_row.n_chars")).cast("long")}
    return clean.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Rows that no id, source or size tells apart share their copies: each takes the
    whole part, and the rest goes to the first of them by text.  Null texts have no
    words and are not taken; an empty table stays empty.
    """
    scratch = Scratch(spark, "mix-stage")
    taken = mixing.mix(docs.select("doc_id", "source", "text")).groupBy("doc_id", "source", "size").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    taken = scratch.save(taken.select(F.struct("doc_id", "source", "size").alias("_key"), "_copies", "_rows"), "taken")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), mixing.word_count("text").alias("_size"))
    rows = rows.select("_row", F.struct(F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"), F.col("_size").alias("size")).alias("_key"))
    uneven = F.col("_copies") % F.col("_rows") > 0
    whole = F.floor(F.col("_copies") / F.col("_rows")).cast("int")
    # nulls inside the key are equal
    alone = rows.join(taken.where(~uneven), "_key").select("_row", whole.alias("_n"))
    # the rest of a group's copies goes to exactly so many of its rows, ranked in salted parts
    split = taken.where(uneven)
    shared = marked(rows, bitmap(split, "_key"), "_key").where("_maybe").drop("_maybe").join(split, "_key")
    shared = scratch.save(shared.withColumn("_draw", F.xxhash64(F.to_json("_row"))), "shared")
    shared = shared.withColumns({"_file": F.xxhash64(F.col("_metadata.file_path")), "_at": F.col("_metadata.row_index")})
    parts = shared.groupBy("_key", "_file").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("_key").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_key", "_file", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    rank = F.row_number().over(Window.partitionBy("_key", "_file").orderBy("_draw", "_at"))
    shared = shared.withColumn("_rank", rank).join(parts, ["_key", "_file"])
    extra = (F.col("_ahead") + F.col("_rank") <= F.col("_copies") % F.col("_rows")).cast("int")
    shared = shared.select("_row", (whole + extra).alias("_n"))
    taken = alone.unionByName(shared).where("_n > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 1024 tokens.

    Null and empty texts are one piece (the end id); repeated rows are packed each by
    itself; an empty table gives no sequence.
    """
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), ranks=tokenizer_file("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicate removal", drop_near_duplicates),
    ("secret redaction", redact_secrets),
    ("source mixing", mix_sources),
    ("sequence packing", pack_sequences),
]

#: Trained models, sampling and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
