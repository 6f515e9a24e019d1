"""Queries bound to the driver tables (one per operator family of the survey).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; inputs
that the reference reads from PDFs, CSVs or web pages are derived from the
driver tables by the expressions of :mod:`terrasol.plans.synth`, so the work of
every query grows with the tables.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasol.functions import measure, text as tx, title
from terrasol.functions import harvest as hv
from terrasol.functions import geo
from terrasol.operators import scorers
from terrasol.operators import annotate, cluster, combine, cover, crawl, harvest_sites, html_blocks, ml, evaluate, harvest, locks, page_tree, parks, profile, sampling, scoring
from terrasol.plans import synth
from terrasol.sources import io
from terrasol.sources.snapshots import RejectTable
from terrasol.sources.tables import spread, table
from terrasol.streaming import claims as claims_stream, ingest, locks as lock_stream


def _docs(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*cols)
    return spread(docs) if "text" in cols else docs


def doc_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface and power measured in every (whole) document body."""
    docs = _docs(spark, sf_dir, "doc_id", "text", "n_chars")
    bodies = docs.select("doc_id", F.expr(synth.MEASURE_BODY).alias("pdf_text"))
    return measure.document_measures(bodies, "pdf_text").select("doc_id", "land_surface_ha", "power_mwc")


def title_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title fields, communes flattened to a joined string for comparison."""
    docs = _docs(spark, sf_dir, "doc_id", "n_chars")
    parsed = title.with_parsed_title(docs.select("doc_id", F.expr(synth.TITLE).alias("title")), "title", "t")
    return parsed.select(
        "doc_id", "t.project_type", "t.dept", "t.land_surface_ha_title", "t.power_mwc_title",
        F.size("t.communes").alias("n_communes"),
        F.array_join("t.communes", "|").alias("communes"))



def _sql_on(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """Evaluate a synth SELECT over driver tables registered as temp views."""
    for t in tables:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql)


def _gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql_on(spark, sf_dir, synth.GAZETTEER_NATION, "nation").unionByName(
        _sql_on(spark, sf_dir, synth.GAZETTEER_REGION, "region"))


def combined_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 flagship: metadata ⟕ year links ⟕ measures → communes → gazetteer."""
    docs = table(spark, sf_dir, "documents")
    metadata = docs.select(F.expr(synth.PDF_NAME).alias("pdf_name"), F.expr(synth.TITLE).alias("title"),
                           F.expr(synth.YEAR_URL).alias("year_url"))
    year_links = docs.select(F.expr(synth.YEAR_URL).alias("year_url"), F.expr(synth.REGION_NAME).alias("region"),
                             F.expr(synth.YEAR).alias("year")).distinct()
    measures = doc_measures(spark, sf_dir).select(F.expr(synth.PDF_NAME).alias("pdf_name"),
                                                  "land_surface_ha", "power_mwc")
    return combine.combine_projects(metadata, year_links, measures, _gazetteer(spark, sf_dir))



def dept_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer padding, raw code cleaning, code/commune from a title."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.expr(synth.RAW_DEPT).alias("raw_code"))
    t = cust.withColumn("title", F.expr(synth.DEPT_TITLE))
    m = title.departement_code_and_commune("title")
    return t.select("c_custkey", "raw_code", title.gazetteer_dept("raw_code").alias("zfill_code"),
                    title.clean_departement_code("raw_code").alias("clean_code"),
                    m["departement_code"].alias("title_code"), m["commune_name"].alias("title_commune"))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text of every document, null texts dropped."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    return (docs.select("doc_id", tx.clean_text(F.expr(synth.RAW_TEXT)).alias("pdf_text"))
                .where(F.col("pdf_text").isNotNull()))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir, "doc_id", "text", "lang", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id")


def dataset_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: labels ⋈ texts → cleaned text, contexts, spans, sorted labels; one row per context."""
    lab = _labelled(spark, sf_dir).select(
        F.expr(synth.PDF_NAME).alias("pdf_name"), F.col("text").alias("pdf_text"),
        F.expr(synth.LAND_TYPE).alias("land_type"), F.expr(synth.CONTEXT).alias("context"))
    ds = (lab.withColumn("pdf_text", tx.clean_text("pdf_text"))
             .withColumn("contexts", tx.split_contexts("context"))
             .withColumn("contexts_locations", tx.context_locations("pdf_text", "contexts"))
             .withColumn("labels", tx.sorted_labels("land_type"))
             .where(F.col("pdf_text").isNotNull()))
    z = F.arrays_zip("contexts", "contexts_locations")
    return ds.select("pdf_name", F.array_join("labels", "|").alias("labels"),
                     F.posexplode(z).alias("ctx_pos", "z")).select(
        "pdf_name", "labels", "ctx_pos", F.col("z.contexts").alias("context"),
        F.col("z.contexts_locations.start").alias("start"), F.col("z.contexts_locations.length").alias("length"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """256-token windows with 10-token overlap, one row per chunk."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", F.posexplode(tx.chunks("text", 256, 10)).alias("chunk_idx", "toks")).select(
        "doc_id", "chunk_idx", F.size("toks").alias("n_tokens"), F.array_join("toks", " ").alias("chunk_text"))


def chunk_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk scores pooled per (document, label) by mean and max."""
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.expr(synth.ARENA_TEXT).alias("text"))
    ch = docs.select("doc_id", F.posexplode(tx.chunks("text", 256, 10)).alias("chunk_idx", "toks"))
    ch = ch.select("doc_id", scoring.rule_matches(F.array_join("toks", " ")).alias("_m"))
    score = lambda k: F.least(F.lit(1.0), scoring.rule_hits("_m", k) / F.lit(2.0))
    scored = ch.select("doc_id", F.inline(F.array(*(F.struct(F.lit(k).alias("label"), score(k).alias("score")) for k in evaluate.LABELS))))
    return scored.groupBy("doc_id", "label").agg(F.round(F.avg("score"), 9).alias("mean_score"),
                                                 F.max("score").alias("max_score"))


def fit_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halve each text until its token count + 1000 fits a 2000-token context."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    fb = tx.fit_budget("text", 2000, 1000)
    return docs.select("doc_id", fb["n_chars"].alias("kept_chars"), fb["n_tokens"].alias("kept_tokens"))


def multi_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth columns by substring test of the land_type string."""
    lab = _labelled(spark, sf_dir).select("doc_id", F.expr(synth.LAND_TYPE).alias("land_type"))
    return lab.select("doc_id", *evaluate.multi_hot(F.col("land_type")))


def isin_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership flag as 0/1."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", F.col("p_type").isin("PROMO", "SMALL", "ECONOMY").cast("int").alias("is_artificial"))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = _labelled(spark, sf_dir)
    cols = [F.col("doc_id")]
    for k in evaluate.LABELS:
        cols.append(F.expr(synth.TRUTH[k]).cast("int").alias(k))
        cols.append(F.expr(synth.SCORE[k]).alias(k + "_score"))
    cols.append(F.expr(synth.PREDICTION_TIME).alias("prediction_time"))
    return lab.select(*cols)


def _round_report(df: DataFrame, *by: str) -> DataFrame:
    return df.select(*by, "label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")],
                     F.col("support").cast("long").alias("support"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification report at the 0.5 threshold."""
    pred = _predictions(spark, sf_dir)
    evaluate.check_score_columns(pred)
    return _round_report(evaluate.classification_report(pred))


def threshold_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best micro-F1 threshold."""
    out = evaluate.best_threshold(_predictions(spark, sf_dir))
    return out.select(F.round("threshold", 9).alias("threshold"), F.round("best_f1", 9).alias("best_f1"))


def timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total / mean / sample std of prediction times."""
    t = evaluate.timing_stats(_predictions(spark, sf_dir))
    return t.select(*[F.round(c, 6).alias(c) for c in t.columns])


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Argmax of each embedding (as logits) against its label."""
    emb = table(spark, sf_dir, "embeddings").select(
        "embedding", (F.col("label") % 8).alias("label"))
    return evaluate.accuracy(emb, "embedding", "label").select(F.round("accuracy", 9).alias("accuracy"))


def _annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation table: every document; labelled ones validated by a user."""
    docs = _docs(spark, sf_dir, "doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels")
    j = docs.join(lab, "doc_id", "left")
    truth = {k: F.expr(f"CASE WHEN quality IS NULL THEN NULL ELSE {v} END") for k, v in synth.TRUTH.items()}
    score = {k: F.expr(synth.SCORE[k].replace("quality", "coalesce(quality, 0)").replace("toxic", "coalesce(toxic, 0)"))
             for k in evaluate.LABELS}
    val = []
    for k in evaluate.LABELS:
        j = j.withColumn(k + "_score", score[k]).withColumn(k + "_pred", evaluate.binarise(score[k], 0.5))
        val += [F.lit(k), truth[k].cast("boolean")]
    validated = F.col("quality").isNotNull()
    return j.select(
        F.expr(synth.PDF_NAME).alias("pdf_name"), "doc_id",
        validated.alias("is_validated"),
        F.when(validated, F.expr(synth.VALIDATOR)).alias("validated_by"),
        annotate.pack_predictions().alias("original_predictions"),
        F.when(validated, F.create_map(*val)).alias("validated_predictions"))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion and contribution of user_3."""
    p = annotate.progress(_annotations(spark, sf_dir), user="user_3")
    return p.select("total_docs", "validated_docs", F.round("overall_completion", 9).alias("overall_completion"),
                    "user_validated_docs", F.round("user_contribution", 9).alias("user_contribution"))


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated documents per user."""
    return annotate.leaderboard(_annotations(spark, sf_dir))


def human_vs_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of human validation against the model's predictions."""
    wide = annotate.human_vs_model(_annotations(spark, sf_dir))
    return _round_report(evaluate.classification_report(wide))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated and original prediction summaries."""
    ann = _annotations(spark, sf_dir)
    return ann.select("pdf_name", annotate.validated_summary(ann).alias("validated_summary"),
                      annotate.original_summary(ann).alias("original_summary"))


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(f"{synth.CLAIM_DOC} AS doc_id", "user_id", "ts")


def claim_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 batch twin: claim sessions per (document, user), 60-minute expiry."""
    return annotate.claim_sessions(_claims(spark, sf_dir))


def _locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    last = ev.groupBy("user_id").agg(F.max("ts").alias("locked_at"))
    ann = _annotations(spark, sf_dir)
    return ann.join(last, ann.doc_id == last.user_id, "left").select(
        "pdf_name", "doc_id", "is_validated", F.col("user_id").cast("string").alias("locked_by"), "locked_at")


AS_OF_SQL = "TIMESTAMP_NTZ '2024-01-30 23:00:00'"


def stale_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """locks older than 30 minutes, and 60-minute expiry of unvalidated ones."""
    return annotate.lock_states(_locks(spark, sf_dir), F.expr(AS_OF_SQL)).select("pdf_name", "kind")


def claimable_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next claimable document by seeded hash (top-1 is the feature)."""
    locks = annotate.release_expired(_locks(spark, sf_dir), F.expr(AS_OF_SQL))
    return annotate.next_claimable(locks).select("pdf_name")


def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified 80/20 split of the labelled documents by quality."""
    lab = table(spark, sf_dir, "labels")
    return sampling.stratified_split(lab, "doc_id", "quality", 0.2, "42").select("doc_id", "quality", "split")


def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every context occurrence wrapped in <mark> tags (whole texts)."""
    lab = _labelled(spark, sf_dir).select("doc_id", "text", F.expr(synth.CONTEXT).alias("context"))
    return lab.select("doc_id", tx.highlight("text", F.split("context", r"\Q[SEP]\E")).alias("highlighted"))



def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor of every page, resolved."""
    return harvest.extract_links(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))).select(
        "page_id", "link_pos", "href", "anchor_text", "abs_url", "file_name", "is_pdf", "year")


def follow_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link targets, fetched or still to crawl."""
    pages = table(spark, sf_dir, "pages")
    links = harvest.extract_links(spread(pages.select("page_id", "url", "html")))
    return harvest.follow_frontier(links, pages.select("url"))


def harvest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three harvest layouts, each with its relevance rule, unioned."""
    docs = _docs(spark, sf_dir, "doc_id", "source", "text", "n_chars")
    base = docs.select("doc_id", F.expr(synth.SOURCE_NO).alias("_src"), F.expr(synth.TITLE).alias("project_name"),
                       F.expr(synth.PDF_URL).alias("pdf_url"), "source", "text")
    a = base.where((F.col("_src") == 0) & hv.relevant_folded("project_name")).select(
        "project_name", "pdf_url", hv.file_name("pdf_url").alias("pdf_filename"),
        F.col("text").alias("description"))
    b = base.where((F.col("_src") == 1) & hv.relevant_regex("project_name")).select(
        "project_name", "pdf_url", hv.file_name("pdf_url", keep_query=False).alias("pdf_filename"),
        hv.parse_date(F.expr(synth.SLASH_DATE), "dd/MM/yyyy").alias("publish_date_scraped"),
        F.expr("'NATION_' || cast(doc_id % 25 AS string)").alias("commune_name_scraped"))
    c = base.where((F.col("_src") == 2) & hv.relevant_plain("project_name")).select(
        "project_name", "pdf_url", hv.sanitize_filename(F.concat(F.col("project_name"), F.lit(".pdf"))).alias("pdf_filename"),
        hv.parse_french_date(F.expr(synth.FRENCH_DATE)).alias("publish_date_scraped"),
        F.lit("973").alias("departement_code"), hv.first_year(F.expr(synth.FRENCH_DATE)).alias("year_scraped"))
    return harvest.union_sources(a, b, c)


def harvest_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvested rows, renamed to project metadata, through the combined project table."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select(F.expr(synth.SOURCE_NO).alias("_src"), F.expr(synth.TITLE).alias("project_name"),
                        F.expr(synth.PDF_URL).alias("pdf_url"), F.expr(synth.YEAR_URL).alias("year_url"))
    found = found.where((F.col("_src") == 0) & hv.relevant_folded("project_name")).select(
        "project_name", "pdf_url", hv.file_name("pdf_url").alias("pdf_filename"), "year_url")
    year_links = docs.select(F.expr(synth.YEAR_URL).alias("year_url"), F.expr(synth.REGION_NAME).alias("region"),
                             F.expr(synth.YEAR).alias("year")).distinct()
    measures = doc_measures(spark, sf_dir).select(F.expr(synth.PDF_NAME).alias("pdf_name"), "land_surface_ha", "power_mwc")
    return combine.combine_projects(harvest.to_metadata(found), year_links, measures, _gazetteer(spark, sf_dir))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    plan = orders.select(F.expr("'https://www.example.org/avis_' || cast(o_orderkey AS string) || '.pdf'").alias("pdf_url"))
    plan = plan.withColumn("pdf_filename", hv.file_name("pdf_url"))
    # every line item is a file record; a file is present and non-empty when any record has size > 0
    existing = table(spark, sf_dir, "lineitem").select(
        F.expr("'avis_' || cast(l_orderkey AS string) || '.pdf'").alias("file_name"),
        ((F.col("l_partkey") % 4) * 1000).alias("size"))
    return harvest.download_plan(plan, existing)


def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip files already present and non-empty."""
    return _plan(spark, sf_dir).select("pdf_filename", "pdf_url", "action")


def download_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the download plan."""
    return harvest.download_stats(_plan(spark, sf_dir))


def relevance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3a-c/F4/F7/F10: relevance and class flags of every title."""
    docs = _docs(spark, sf_dir, "doc_id", "source", "n_chars")
    t = docs.select("doc_id", F.expr(synth.TITLE).alias("t"), F.expr(synth.YEAR).alias("y"),
                    F.expr(synth.PDF_URL).alias("u"))
    return t.select("doc_id", hv.relevant_folded("t").cast("int").alias("f3a"), hv.relevant_regex("t").cast("int").alias("f3b"),
                    hv.relevant_plain("t").cast("int").alias("f3c"), hv.is_opinion_title("t").cast("int").alias("f4_avis"),
                    hv.is_opinion_or_case("t").cast("int").alias("f4_lower"),
                    hv.year_in_range("y").cast("int").alias("f7_year"), hv.is_pdf("u").cast("int").alias("f10_pdf"))


def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: profile of every column of lineitem (exact distinct counts, for the comparison)."""
    p = profile.profile(spread(table(spark, sf_dir, "lineitem")), exact_distinct=True)
    return p.select("column_name", "min", "max", "min_text", "max_text", "n_distinct", F.round("avg", 4).alias("avg"),
                    F.round("std", 4).alias("std"), "count", F.round("null_percentage", 6).alias("null_percentage"))


def _parks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return cust.select("c_custkey", F.expr(synth.PARK_ID).alias("id"),
                       parks.split_list(F.expr(synth.INSEE_LIST)).alias("insee_com"),
                       parks.split_list(F.expr(synth.TERRITORY_CODES)).alias("territory_codes"))


def commune_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parks per first commune code."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("COM"))
    return parks.count_by_first_commune(_parks(spark, sf_dir), nation)


def crs_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected CRS chosen from the commune codes."""
    p = _parks(spark, sf_dir)
    return p.select("c_custkey", F.size("territory_codes").alias("n_codes"),
                    parks.territory_crs("territory_codes").alias("srid"))


def decimal_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DECIMAL(18,3) projection and global sum."""
    return parks.decimal_total(table(spark, sf_dir, "part"), "p_retailprice")


def tech_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solar installations per technology (null group kept)."""
    part = table(spark, sf_dir, "part").select(F.expr(synth.FILIERE).alias("filiere"),
                                               F.expr(synth.TECHNOLOGIE).alias("technologie"))
    return parks.count_by(part, "technologie", F.col("filiere") == "Solaire")


def parse_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers parsed against the fixed schema."""
    lab = _labelled(spark, sf_dir).select("doc_id", F.expr(synth.ANSWER).alias("answer"),
                                          F.expr(synth.STOP_REASON).alias("stop_reason"))
    p = scoring.parse_answers(lab)
    return p.select("doc_id", "status", *[k + "_score" for k in evaluate.LABELS],
                    F.when(F.col("contexts").isNotNull(), F.size("contexts")).alias("n_contexts"), "explanation")


def upsert_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import keyed on pdf_name into the annotation table (validation preserved)."""
    orders = table(spark, sf_dir, "orders")
    existing = orders.select(
        F.expr("'avis_' || cast(o_orderkey AS string)").alias("pdf_name"),
        F.expr("'old ' || o_orderstatus").alias("explanation"),
        F.lit(None).cast("double").alias("prediction_time"),
        (F.col("o_orderstatus") == "F").alias("is_validated"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'user_' || cast(o_custkey % 5 AS string) END").alias("validated_by"))
    batch = table(spark, sf_dir, "lineitem").select(
        F.expr("'avis_' || cast(l_orderkey * 2 + l_linenumber % 2 AS string)").alias("pdf_name"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("_ord"),
        F.expr("'new ' || l_returnflag || cast(l_linenumber AS string)").alias("explanation"),
        F.col("l_quantity").alias("prediction_time"))
    return annotate.upsert(existing, batch).select("pdf_name", "explanation", "prediction_time", "is_validated",
                                                   "validated_by", "action")



RINGS_SCHEMA = "array<array<struct<x: double, y: double>>>"


def _ring(*pts) -> F.Column:
    """One closed ring from (x, y) column pairs."""
    return F.array(*(geo.point(x, y) for x, y in pts))


def _park_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select(
        F.expr(synth.PARK_KEY).alias("id"), F.expr(synth.PARK_X0).alias("x0"), F.expr(synth.PARK_Y0).alias("y0"),
        F.expr(synth.PARK_W).alias("w"), F.expr(synth.PARK_H).alias("h"), F.expr(synth.PARK_L).alias("is_l"),
        F.expr(synth.PARK_MILLESIME).alias("millesime"), F.expr(synth.PARK_SURF).alias("surf_parc"),
        F.expr(synth.PARK_SRID).alias("srid"))
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    xm, ym = F.col("x0") + F.col("w") / 2, F.col("y0") + F.col("h") / 2
    l_ring = _ring((x0, y0), (x1, y0), (x1, ym), (xm, ym), (xm, y1), (x0, y1), (x0, y0))
    rect = _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    rings = F.when(F.col("is_l"), F.array(l_ring)).otherwise(F.array(rect))
    return sup.select("id", "millesime", "surf_parc", "srid", (F.col("id") % 30).cast("string").alias("insee_com"), rings.alias("geom"))


def _cover_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.expr(synth.COVER_ID).alias("id_1"), F.expr(synth.COVER_MILLESIME).alias("millesime_ocs"),
        F.expr(synth.CODE_US).alias("code_us"), F.expr(synth.COVER_X0).alias("x0"), F.expr(synth.COVER_Y0).alias("y0"),
        F.expr(synth.COVER_W).alias("w"), F.expr(synth.COVER_H).alias("h"), F.expr(synth.COVER_HOLE).alias("hole"),
        F.expr(synth.COVER_SRID).alias("srid"))
    x0, y0, w, h = F.col("x0"), F.col("y0"), F.col("w"), F.col("h")
    x1, y1 = x0 + w, y0 + h
    outer = _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    hx0, hy0, hx1, hy1 = x0 + w / 4, y0 + h / 4, x1 - w / 4, y1 - h / 4
    inner = _ring((hx0, hy0), (hx0, hy1), (hx1, hy1), (hx1, hy0), (hx0, hy0))
    rings = F.when(F.col("hole"), F.array(outer, inner)).otherwise(F.array(outer))
    return part.select("id_1", "millesime_ocs", "code_us", "srid", rings.alias("ocs_geom"))


def _link(spark: SparkSession, sf_dir: str, with_geometry: bool = False) -> DataFrame:
    return cover.park_cover_link(_park_polygons(spark, sf_dir), _cover_polygons(spark, sf_dir), cell=500.0, with_geometry=with_geometry)


def park_cover_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parks ⟕ land-cover polygons on intersection, with the three areas."""
    link = _link(spark, sf_dir)
    return link.select("id", "id_1", "millesime", "millesime_ocs", "code_us",
                       F.round("project_geom_area", 6).alias("project_geom_area"),
                       F.round("ocs_geom_area", 6).alias("ocs_geom_area"),
                       F.round("geom_intersection_area", 6).alias("geom_intersection_area"))


def vintage_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strictly older covers, unique latest vintage per (park, cover id)."""
    f = cover.latest_vintage(_link(spark, sf_dir))
    return f.select("id", "id_1", "millesime_ocs", F.round("geom_intersection_area", 6).alias("geom_intersection_area"))


def has_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: parks with and without a cover after the vintage filter."""
    return cover.has_cover_counts(cover.latest_vintage(_link(spark, sf_dir)))


def area_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared vs geometric vs intersected areas per park."""
    a = cover.area_check(cover.latest_vintage(_link(spark, sf_dir)))
    areas = F.aggregate("ocs_geom_area_list", F.lit(0.0), lambda acc, x: acc + x)
    return a.select("id", "num_lines", "num_unique_ocs_tiles", F.array_join("insee_com_list", ",").alias("insee_com_list"),
                    F.size("ocs_geom_area_list").alias("n_ocs_areas"), F.round(areas, 6).alias("ocs_areas"),
                    *[F.round(c, 6).alias(c) for c in ("surf_parc", "project_geom_area", "geom_intersection_area",
                                                        "area_error", "area_geom_error")])


def usage_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface by land use with the unmatched residual."""
    u = cover.usage_shares(cover.latest_vintage(_link(spark, sf_dir)))
    return u.select("code_us", F.round("surface", 6).alias("surface"), F.round("pct_surface", 6).alias("pct_surface"))


def polygon_area_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shoelace area and centroid of every park polygon."""
    p = _park_polygons(spark, sf_dir)
    c = geo.centroid("geom")
    return p.select("id", F.round(geo.polygon_area("geom"), 6).alias("area"),
                    F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))


def geojson_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features of the shared areas (coloured by code) and of each park once, read back from the JSON text."""
    feats = cover.geojson_features(cover.latest_vintage(_link(spark, sf_dir, with_geometry=True)), to_wgs84=False)
    at = lambda path: F.get_json_object("feature", path)
    point = "array<array<array<double>>>"
    polygons = F.when(at("$.geometry.type") == "Polygon", F.array(F.from_json(at("$.geometry.coordinates"), point))) \
                .otherwise(F.from_json(at("$.geometry.coordinates"), f"array<{point}>"))
    as_rings = F.transform(polygons, lambda poly: F.transform(poly, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))
    area = F.aggregate(F.transform(as_rings, geo.polygon_area), F.lit(0.0), lambda a, x: a + x)
    return feats.select(at("$.geometry.type").alias("kind"), at("$.properties.popup").alias("popup"),
                        at("$.properties.color").alias("color"), F.round(area, 4).alias("area"))


def crs_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer points (lon/lat) projected to their territory CRS."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(synth.POINT_LON).alias("lon"), F.expr(synth.POINT_LAT).alias("lat"),
        parks.territory_crs(parks.split_list(F.expr(synth.TERRITORY_CODES))).alias("srid"))
    xy = geo.project("lon", "lat", "srid")
    return cust.select("c_custkey", "srid", F.round(xy["x"], 3).alias("x"), F.round(xy["y"], 3).alias("y"))



def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.expr(synth.SITE_LAT).alias("latitude"), F.expr(synth.SITE_LON).alias("longitude"))


def dbscan_parks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DBSCAN, eps 1 km (haversine), min_samples 2."""
    return cluster.dbscan(_sites(spark, sf_dir), "id", metric="haversine").select("id", "labels")


def dbscan_geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DBSCAN on WGS-84 geodesic distance, min_samples 3 (border points)."""
    return cluster.dbscan(_sites(spark, sf_dir), "id", metric="geodesic", min_samples=3).select("id", "labels")



def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents streamed (available-now) → cleaned → measured → upserted by doc_id."""
    return ingest.ingest_documents(spark, sf_dir, "documents.parquet", body_expr=synth.MEASURE_BODY)


def claim_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 streaming: claim sessions with a 2-hour watermark, open ones closed at the end of the input."""
    return claims_stream.run_claims(spark, sf_dir, "events.parquet",
                                    [f"{synth.CLAIM_DOC} AS doc_id", "user_id", "ts"]).select(
        "doc_id", "user_id", "claim_start", "last_refresh", "n_events")


LOCK_EVENTS = [f"{synth.CLAIM_DOC} AS doc_id", "user_id", "ts", "event_id", f"{synth.CLAIM_ACTION} AS action"]


def lock_life_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: claims of competing users granted, refreshed, refused, released, validated and expired (ordered fold)."""
    return locks.lock_life_cycle(table(spark, sf_dir, "events").selectExpr(*LOCK_EVENTS))


def lock_life_cycle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the same life-cycle as a stream with keyed state and event-time timers, run to the end of the input."""
    return lock_stream.run_locks(spark, sf_dir, "events.parquet", LOCK_EVENTS)


def refused_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: per document and user, what became of the claims."""
    return locks.claims_of(lock_life_cycle(spark, sf_dir))


def ordered_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every document arrive in either order; the newer version is stored, whichever comes last."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(synth.MEASURE_BODY).alias("new"), F.col("text").alias("old"))
    src, target, ckpt = (ingest.work_dir(spark, n) for n in ("ordered-src", "ordered-target", "ordered-ckpt"))
    late = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0   # these documents' older version arrives last
    for k in range(2):
        version = F.when(late, F.lit(1 - k)).otherwise(F.lit(k))
        part = docs.select("doc_id", version.alias("version"), F.when(version == 1, F.col("new")).otherwise(F.col("old")).alias("text"))
        part.write.parquet(f"{src}/arrival{k}")
        out = ingest.ingest_documents(spark, f"{src}/*", "*.parquet", target=target, checkpoint=ckpt, order=("version",))
    return out


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with rows that cannot be taken; what was stored and what went to the side table with its reason."""
    docs = table(spark, sf_dir, "documents")
    src, bad = (ingest.work_dir(spark, n) for n in ("reject-src", "rejects"))
    docs.selectExpr(f"{synth.REJECT_KEY} AS doc_id", f"{synth.REJECT_TEXT} AS text").write.parquet(f"{src}/arrival")
    stored = ingest.ingest_documents(spark, f"{src}/*", "*.parquet", rejects=bad)
    rejected = RejectTable(spark, bad).read()
    return (stored.select("doc_id", F.lit("stored").alias("outcome")).unionByName(rejected.select("doc_id", F.col("_reason").alias("outcome")))
            .groupBy("doc_id", "outcome").agg(F.count(F.lit(1)).alias("n_rows")))


def resumed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the ingest with one target and checkpoint; the second reads only the files that arrived since."""
    docs = table(spark, sf_dir, "documents")
    src, target, ckpt = (ingest.work_dir(spark, n) for n in ("resume-src", "resume-target", "resume-ckpt"))
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    for k, part in enumerate((docs.where(first), docs.where(~first))):   # both halves are ingested
        part.write.parquet(f"{src}/arrival{k}")
        out = ingest.ingest_documents(spark, f"{src}/*", "*.parquet", body_expr=synth.MEASURE_BODY, target=target, checkpoint=ckpt)
    return out


def resumed_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are scored already; the others are found by an anti join, scored and appended."""
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.expr(synth.ARENA_TEXT).alias("pdf_text"))
    score = lambda df: scoring.rule_scores(df, "pdf_text").select("doc_id", *[k + "_score" for k in evaluate.LABELS])
    done = ingest.work_dir(spark, "scored")
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    score(docs.join(labelled, "doc_id", "left_semi")).withColumn("run", F.lit(1)).write.parquet(done)
    score(io.pending(docs, spark.read.parquet(done), "doc_id")).withColumn("run", F.lit(2)).write.mode("append").parquet(done)
    return spark.read.parquet(done)


PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "decimal(18,3)"}


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the part table read as text and typed again, decimals exact."""
    text = table(spark, sf_dir, "part").select(*(F.concat(F.lit(" "), F.col(c).cast("string")).alias(c) for c in PART_TYPES))
    return parks.typed_projection(text, PART_TYPES)


def multi_hot_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth columns from the array of label names."""
    lab = _labelled(spark, sf_dir).select("doc_id", F.split(F.expr(synth.LAND_TYPE), ", ").alias("land_types"))
    return lab.select("doc_id", *evaluate.multi_hot_array(F.col("land_types")))


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """texts of labelled documents only (semi join: repeated labels repeat nothing)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.length("text").alias("n_text"))
    return docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


def validated_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents validated within a span of days (validation time: the validator's last event)."""
    last = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 7).alias("_u")).agg(F.max("ts").alias("validated_at"))
    ann = _annotations(spark, sf_dir).withColumn("_u", F.col("doc_id") % 7).join(last, "_u")
    t = lambda day: F.expr(f"TIMESTAMP_NTZ '2024-01-{day} 00:00:00'")
    return annotate.validated_between(ann, t("01"), t("31")).select("pdf_name", "validated_by", "validated_at")


def attempt_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skipped, successful and failed downloads (attempts: the line items of an order, in their order)."""
    attempts = table(spark, sf_dir, "lineitem").select(
        F.expr("'avis_' || cast(l_orderkey AS string) || '.pdf'").alias("pdf_filename"),
        F.col("l_linenumber").alias("attempt"), (F.col("l_suppkey") % 3 == 0).alias("ok"))
    return harvest.attempt_outcomes(_plan(spark, sf_dir), attempts, retries=2)


def layers_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded twice as one layer per priority (the second load replaces the first), read back and counted."""
    path = ingest.work_dir(spark, "layers")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    for _ in range(2):
        io.write_layers(orders, path, "o_orderpriority")
    return io.read_layers(spark, path).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def scored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores written per model and run, read back; the number of rows and the mean of each run."""
    path, report_path = ingest.work_dir(spark, "runs"), ingest.work_dir(spark, "report")
    pred = _predictions(spark, sf_dir).select("doc_id", *[k + "_score" for k in evaluate.LABELS])
    models = F.explode(F.array(*(F.lit(m) for m, _ in synth.ARENA_MODELS)))
    io.write_runs(pred.withColumn("model_id", models).withColumn("run_ts", F.concat(F.lit("run"), (F.col("doc_id") % 3).cast("string"))), path)
    io.write_report(spark.read.parquet(path).groupBy("model_id", "run_ts").agg(
        F.count("*").alias("n"), F.round(F.avg("surfaces_naturelles_score"), 9).alias("mean_score")), report_path)
    return spark.read.schema("model_id string, run_ts string, n long, mean_score double").json(report_path)


def _layout(spark: SparkSession, sf_dir: str, html: str) -> DataFrame:
    """Elements of the pages that one layout gives, one page per document."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "n_chars"))
    return html_blocks.page_elements(docs.select(F.col("doc_id").alias("page_id"), F.expr(html).alias("html")))


def listing_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: framed blocks of the listings with heading, text and links."""
    return html_blocks.listing_blocks(_layout(spark, sf_dir, synth.LISTING_HTML)).drop("block_pos")


def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: the link of every listing that leads to its next page."""
    return html_blocks.next_page_links(_layout(spark, sf_dir, synth.LISTING_HTML))


def heading_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: paragraphs under their heading, with the link that follows."""
    return html_blocks.heading_scoped_blocks(_layout(spark, sf_dir, synth.LISTING_HTML)).drop("pos")


def card_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: cards of a listing joined with the PDF link of the page each one leads to (some pages were not fetched)."""
    at = lambda c: F.concat(F.lit("https://www.example.org/p/"), F.col(c).cast("string"))
    cards = table(spark, sf_dir, "documents").select("doc_id", at("doc_id").alias("abs_url"))
    pages = _layout(spark, sf_dir, synth.DETAIL_HTML).where(F.col("page_id") % 4 != 0).withColumn("url", at("page_id"))
    return html_blocks.card_details(cards, pages).select("doc_id", "pdf_href", "pdf_label")


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: PDF links of the table rows that mention a keyword."""
    return html_blocks.table_row_links(_layout(spark, sf_dir, synth.TABLE_HTML)).drop("tr_pos")


def dated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: paragraphs "title - date"; the others are reported as such."""
    return html_blocks.dated_paragraphs(_layout(spark, sf_dir, synth.DATED_HTML)).drop("pos")


def offset_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: result pages by offset."""
    listing = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://www.example.org/l?q="), F.col("doc_id").cast("string")).alias("base_url"), (F.col("n_chars") % 60).cast("int").alias("num_docs"))
    return html_blocks.offset_page_plan(listing)


def detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: the first document of the detail records of opinions."""
    return html_blocks.detail_records(table(spark, sf_dir, "documents").select(
        F.expr(synth.DETAIL_TITLE).alias("title"), F.expr(synth.DETAIL_JSON).alias("payload")))


def wkb_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: parks and covers of a cell as (multi)polygons, encoded to WKB and decoded; every part keeps its area."""
    parks_ = _park_polygons(spark, sf_dir).select(F.col("id").alias("cell"), F.col("geom"))
    covers = _cover_polygons(spark, sf_dir).select(F.floor(F.regexp_extract("id_1", "([0-9]+)", 1).cast("long") / 10).alias("cell"), F.col("ocs_geom").alias("geom"))
    multi = parks_.unionByName(covers).groupBy("cell").agg(F.collect_list("geom").alias("polygons"))
    back = multi.select("cell", geo.polygons_from_wkb(geo.wkb_from_polygons("polygons")).alias("p"))
    area = F.aggregate(F.transform("p", geo.polygon_area), F.lit(0.0), lambda a, x: a + x)
    return back.select("cell", F.size("p").alias("n_polygons"), F.round(area, 6).alias("area"))


def dot_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9: references with dot segments of every page, resolved against its address."""
    refs = F.array(*(F.lit(r) for r in synth.DOT_REFERENCES))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(refs).alias("pos", "href"))
    return pages.select("page_id", "pos", hv.resolve_url("url", "href").alias("abs_url"))


def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2-H8: pages parsed once into elements; paragraphs scoped by their heading."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    el = html_blocks.page_elements(pages)
    return html_blocks.heading_scoped_blocks(el, heading="h1", block="p").select(
        "page_id", "pos", "section", F.length("block_text").alias("block_chars"), "next_link")



def arena_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule scorer variants ("models") over every labelled document, one report per model."""
    lab = _labelled(spark, sf_dir)
    base = lab.select("doc_id", F.expr(synth.ARENA_TEXT).alias("pdf_text"),
                      *[F.expr(synth.TRUTH[k]).cast("int").alias(k) for k in evaluate.LABELS])
    # the phrases are matched once; the models differ in how many of them make a label certain
    matched = base.withColumn("_m", scoring.rule_matches(F.col("pdf_text"))).select(
        *evaluate.LABELS, *[scoring.rule_hits("_m", k).alias("_" + k) for k in evaluate.LABELS])
    models = F.array(*(F.struct(F.lit(m).alias("model_id"), F.lit(float(h)).alias("hits")) for m, h in synth.ARENA_MODELS))
    scored = matched.select("*", F.inline(models)).select(
        "model_id", *evaluate.LABELS, *[F.least(F.lit(1.0), F.col("_" + k) / F.col("hits")).alias(k + "_score") for k in evaluate.LABELS])
    return _round_report(evaluate.classification_report(scored, by=("model_id",)), "model_id")


def _measured(result: DataFrame) -> DataFrame:
    """Sizes of the split and whether an accuracy was measured (its value is the model's, not SQL's)."""
    return result.select(F.col("n_train").cast("long").alias("n_train"), "n_test", F.col("accuracy").between(0.0, 1.0).alias("measured"))


def _quality_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the labelled documents with their split."""
    lab = _labelled(spark, sf_dir).select("doc_id", "text", F.col("quality").alias("label"))
    split = sampling.stratified_split(lab, "doc_id", "label", 0.2, "42")
    ch = split.select("doc_id", "label", "split", F.explode(tx.chunks("text", 256, 10)).alias("toks"))
    return ch.withColumn("chunk_text", F.array_join("toks", " "))


def text_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk-level text classifier of document quality."""
    return _measured(ml.text_classifier(_quality_chunks(spark, sf_dir)))


def embedding_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on embeddings, stratified 80/20."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    split = sampling.stratified_split(emb, "vec_id", "label", 0.2, "42")
    return _measured(ml.embedding_classifier(split))



def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commune gazetteer written as CSV (header, no index) and read back
    with an explicit schema: names keep their blanks, codes stay strings."""
    path = ingest.work_dir(spark, "gazetteer-csv")
    io.write_csv(_gazetteer(spark, sf_dir), path)
    return io.read_csv(spark, path, "nom_commune string, code_departement string, longitude double, latitude double")


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files a table was read from, with the rows and the text each one holds."""
    docs = table(spark, sf_dir, "documents").select(F.regexp_extract("_metadata.file_path", r"([^/]*)$", 1).alias("file_name"), "text")
    return docs.groupBy("file_name").agg(F.count("*").alias("n_rows"), F.sum(F.length("text").cast("long")).alias("text_chars"))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON value with a default, per event type."""
    ev = table(spark, sf_dir, "events").select("event_type", "props")
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(-1))
    return ev.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("sum_k"), F.max(k).alias("max_k"))


def annotation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """validated annotations whose name or a context contains a search term."""
    lab = _labelled(spark, sf_dir).select(
        F.expr(synth.PDF_NAME).alias("pdf_name"), F.col("quality").cast("boolean").alias("is_validated"),
        tx.split_contexts(F.expr(synth.CONTEXT)).alias("contexts"))
    return annotate.search(lab, "th", validated=True).select("pdf_name")



def user_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every validator's number of documents and share of the validated ones."""
    c = annotate.user_contributions(_annotations(spark, sf_dir))
    return c.select("validated_by", "n_validated", F.round("contribution_pct", 9).alias("contribution_pct"))



def download_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land-cover download links: label → (code, name, year), download predicate."""
    links = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(synth.DOWNLOAD_LINK_LABEL).alias("label"), F.expr(synth.DOWNLOAD_LINK_HREF).alias("href"))
    parsed = title.parse_download_label("label")
    return links.select("c_custkey", parsed["code"].alias("code"), parsed["name"].alias("name"),
                        parsed["year"].alias("year"),
                        hv.is_download_link("href", "https://data.example.org/ocs/").alias("is_download"))


def packed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide score and prediction columns packed into one map, and read back label by label."""
    wide = _predictions(spark, sf_dir).select("doc_id", *[c for k in evaluate.LABELS for c in (
        F.col(k + "_score"), evaluate.binarise(F.col(k + "_score"), 0.5).alias(k + "_pred"))])
    packed = wide.select("doc_id", F.explode(annotate.pack_predictions()).alias("label", "p"))
    return packed.select("doc_id", "label", F.round("p.score", 9).alias("score"), "p.pred")


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: true and false positives and negatives of each label."""
    return evaluate.label_counts(_predictions(spark, sf_dir))


def document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """links of all pages without index entries and without missing targets."""
    links = harvest.extract_links(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    listed = links.select("page_id", "link_pos", F.when(F.col("link_pos") % 5 == 1, "Avis publiés").otherwise(F.col("anchor_text")).alias("title"),
                          F.when(F.col("link_pos") % 7 != 3, F.col("href")).alias("href"))
    return hv.keep_document_links(listed)


def table_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE, CREATE IF NOT EXISTS and CREATE OR REPLACE TABLE AS; the rows stored after each, and whether it was refused."""
    from pyspark.errors import AnalysisException
    name = f"terrasol_modes_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    some = orders.where("o_orderstatus = 'F'")
    out = []
    for step, rows in (("error", orders), ("error again", some), ("ignore", some), ("overwrite", some)):
        refused = False
        try:
            io.save_table(rows, name, step.split()[0])
        except AnalysisException:   # the table exists
            refused = True
        out.append(io.staged(spark.table(name).agg(F.lit(step).alias("mode"), F.count("*").alias("n"), F.lit(refused).alias("refused")), "modes"))
    spark.sql(f"DROP TABLE {name}")
    return reduce(DataFrame.unionByName, out)


def binary_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and sizes of a folder's files of one suffix, in either case, by the binary file source (contents are not read)."""
    path = ingest.work_dir(spark, "inventory")
    docs = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").cast("string").alias("value"))
    docs.repartition("lang").write.partitionBy("lang").text(path)
    files = io.file_inventory(spark, f"{path}/*", "*.{txt,TXT}").where("size > 0")
    return files.agg(F.count("*").alias("n_files"), F.sum("size").alias("size"), F.max("size").alias("largest"))


def years_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The harvested years in ascending order, each with its place (one row a year)."""
    years = table(spark, sf_dir, "documents").groupBy(F.expr(synth.YEAR).alias("year")).agg(F.count("*").alias("n_documents"))
    return harvest.in_year_order(years)


def span_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context spans written to one table, those not found to a side table with the reason; both read back."""
    spans = dataset_build(spark, sf_dir).select("pdf_name", "ctx_pos", "start", "length").withColumn("_reason", F.when(F.col("start") < 0, "span not found"))
    good, bad = io.split_rejects(spans, ingest.work_dir(spark, "spans"))
    return good.withColumn("outcome", F.lit("located")).unionByName(
        bad.withColumnRenamed("_reason", "outcome").withColumn("start", F.lit(None).cast("int"))).select("pdf_name", "ctx_pos", "outcome", "start", "length")


def crs_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points projected to the CRS of their territory and back."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(synth.POINT_LON).alias("lon"), F.expr(synth.POINT_LAT).alias("lat"), F.expr(synth.POINT_SRID).alias("srid"))
    there = io.staged(cust.select("c_custkey", "srid", geo.project("lon", "lat", "srid").alias("p")), "projected")
    back = geo.unproject(F.col("p.x"), F.col("p.y"), "srid")
    return there.select("c_custkey", F.round(back["lon"], 6).alias("lon"), F.round(back["lat"], 6).alias("lat"))


def site_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: site polygons in metres → centroid in degrees → clusters of sites within 1 km; the input with ``centroid`` and ``labels``."""
    xy = io.staged(_sites(spark, sf_dir).select("id", geo.lcc_2154("longitude", "latitude").alias("p")), "sites")
    x, y, d = F.col("p.x"), F.col("p.y"), F.lit(40.0)
    sites = xy.select("id", F.lit(2154).alias("srid"), F.array(_ring((x - d, y - d), (x + d, y - d), (x + d, y + d), (x - d, y + d), (x - d, y - d))).alias("geom"))
    out = cluster.cluster_polygons(sites, metric="haversine")
    return out.select("id", F.format_string("POINT (%.5f %.5f)", "centroid.lon", "centroid.lat").alias("centroid"), "labels")


def profile_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: line items profiled in two increments whose sketches are stored and merged; the read-out against exact ranks and counts."""
    cols = ["l_extendedprice", "l_quantity", "l_orderkey", "l_returnflag"]
    items, store = table(spark, sf_dir, "lineitem").select(*cols), ingest.work_dir(spark, "sketches")
    early = F.pmod(F.xxhash64("l_orderkey"), F.lit(3)) > 0
    for part in (items.where(early), items.where(~early)):   # the second reads nothing of the first
        profile.sketch(part).write.mode("append").parquet(store)
    found = profile.read_sketches(profile.merge_sketches(spark.read.parquet(store)))
    quartiles = found.select("column_name", F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.col(f"q{int(q * 100)}").alias("v")) for q in (0.25, 0.5, 0.75)))).alias("s")).select("column_name", "s.*")
    exact = []
    for c in cols:
        # the exact share of rows below and up to each quartile, and the exact distinct count
        value = F.col(c).cast("double") if c != "l_returnflag" else F.lit(None).cast("double")
        exact.append(items.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("t"), value.alias("x")))
    rows = reduce(DataFrame.unionByName, exact)
    counted = rows.groupBy("column_name").agg(F.countDistinct("t").alias("nd"))
    ranks = rows.join(F.broadcast(quartiles.where("v is not null")), "column_name").groupBy("column_name", "q").agg(
        F.avg((F.col("x") < F.col("v")).cast("double")).alias("below"), F.avg((F.col("x") <= F.col("v")).cast("double")).alias("up_to"))
    e = profile.RANK_ERROR
    ok = ranks.groupBy("column_name").agg(F.min((F.col("below") - e <= F.col("q")) & (F.col("q") <= F.col("up_to") + e)).alias("quartiles_within"))
    out = found.join(counted, "column_name").join(ok, "column_name", "left")
    near = F.abs(F.col("n_distinct") - F.col("nd")) <= F.greatest(F.lit(1.0), profile.DISTINCT_ERROR * F.col("nd"))
    return out.select("column_name", "count", "min", "max", near.alias("distinct_within"), "quartiles_within")


def plugin_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as a plug-in scorer in Python workers, texts cut to a budget, rows without text reported."""
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.expr(f"CASE WHEN doc_id % 50 = 7 THEN NULL ELSE {synth.ARENA_TEXT} END").alias("pdf_text"))
    return scorers.score_documents(docs, scorers.RuleScorer(2), context=1400).drop("pdf_text")


def scorer_arena(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2/M3/M5: a report per scorer, the rules and classifiers trained on the split's larger part, through one interface on the other part."""
    lab = _labelled(spark, sf_dir)
    base = lab.select("doc_id", F.expr(synth.ARENA_TEXT).alias("pdf_text"), *[F.expr(synth.TRUTH[k]).cast("int").alias(k) for k in evaluate.LABELS])
    split = io.staged(sampling.stratified_split(base.withColumn("label", F.col("surfaces_artificialisees")), "doc_id", "label", 0.2, "42"), "arena")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    models = {k: ml.linear_weights(train, "pdf_text", k) for k in evaluate.LABELS}
    parts = []
    for name, scorer in (("rules", scorers.RuleScorer(2)), ("trained", scorers.LinearScorer(models))):
        parts.append(scorers.score_documents(test.select("doc_id", "pdf_text", *evaluate.LABELS), scorer).drop("pdf_text").withColumn("model_id", F.lit(name)))
    return _round_report(evaluate.classification_report(reduce(DataFrame.unionByName, parts), by=("model_id",)), "model_id")


def text_classifier_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: measured accuracy of the text classifier on held-out chunks."""
    return ml.text_classifier(_quality_chunks(spark, sf_dir))


def embedding_classifier_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: measured accuracy of the embedding classifier on held-out vectors."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return ml.embedding_classifier(sampling.stratified_split(emb, "vec_id", "label", 0.2, "42"))


def _site(spark: SparkSession, sf_dir: str, folder: str, html: str, where: str = "true") -> DataFrame:
    """Page trees of one site, a page per document at ``<site>/<folder>/<doc_id>``, staged."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "n_chars")).where(where)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.expr(f"{synth.SITE} || '{folder}/' || {synth.K}").alias("url"), F.expr(html).alias("html"))
    return io.staged(page_tree.page_tree(pages), f"tree-{folder}")


def _starts(spark: SparkSession, sf_dir: str, folder: str, every: int) -> DataFrame:
    """The first page of every chain of listing pages."""
    docs = table(spark, sf_dir, "documents").where(F.col("doc_id") % every == 0)
    return docs.select(F.expr(f"{synth.SITE} || '{folder}/' || {synth.K}").alias("url"))


def framed_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: framed listing blocks with nested titles and links, relevance, default title, first download link."""
    return harvest_sites.framed_projects(_site(spark, sf_dir, "mrae", synth.FRAMED_HTML))


def nested_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: PDF links anywhere inside relevant table rows, nested tables included."""
    return harvest_sites.keyword_rows(_site(spark, sf_dir, "guadeloupe", synth.NESTED_TABLE_HTML)).drop("pos")


def year_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: year links under card titles, over chains of region pages (some end in a cycle)."""
    return harvest_sites.year_pages(_site(spark, sf_dir, "region", synth.YEAR_HTML), _starts(spark, sf_dir, "region", 4))


def crawl_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page that a chain of listing pages reaches, cycles ended."""
    tree = _site(spark, sf_dir, "liste", synth.CARD_HTML)
    return crawl.follow(_starts(spark, sf_dir, "liste", 3), crawl.next_links(tree, page_tree.has_class(harvest_sites.NEXT)))


def card_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: relevant cards of paged listings with date, file name and link of their detail pages (some not fetched)."""
    details = _site(spark, sf_dir, "fiche", synth.CARD_DETAIL_HTML, "doc_id % 5 <> 0")
    return harvest_sites.card_documents(_site(spark, sf_dir, "liste", synth.CARD_HTML), _starts(spark, sf_dir, "liste", 3), details, "973")


def hop_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: dated paragraphs whose link is a document or, one hop away, a page with one."""
    details = _site(spark, sf_dir, "somme/page", synth.HOP_PAGE_HTML, "n_chars % 3 <> 0")
    return harvest_sites.dated_paragraphs(_site(spark, sf_dir, "somme", synth.HOP_HTML), details).drop("pos")


def result_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: search results with communes and date."""
    found = harvest_sites.result_blocks(_site(spark, sf_dir, "npdc", synth.RESULT_HTML)).drop("pos")
    return found.withColumn("communes_names_scraped", F.array_join("communes_names_scraped", "|"))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: notices with author, publisher, date and collection id."""
    return harvest_sites.notices(_site(spark, sf_dir, "side", synth.NOTICE_HTML))


def headed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: documents under their commune's heading and the page's year."""
    return harvest_sites.headed_documents(_site(spark, sf_dir, "bretagne", synth.HEADED_HTML))


def harvest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven sources harvested from their pages and united under common columns."""
    side = notices(spark, sf_dir).select("project_name", "publish_date_scraped", F.expr("'/' || document_id || '.pdf'").alias("pdf_url"))
    parts = {
        "MRAE": framed_projects(spark, sf_dir), "Bretagne": headed_documents(spark, sf_dir), "Guyane": card_documents(spark, sf_dir).drop("origin"),
        "Guadeloupe": nested_table_rows(spark, sf_dir), "Somme": hop_paragraphs(spark, sf_dir).where("ok").drop("ok"),
        "Nord-Pas-de-Calais": result_blocks(spark, sf_dir), "SIDE": side}
    # a source is computed on its own: in one plan, every stage that ends has all of its hundreds of joins planned anew
    return harvest.union_sources(*(io.staged(df.drop("page_id"), f"harvest-{site}").withColumn("site", F.lit(site)) for site, df in parts.items()))


QUERY_NAMES = [
    "doc_measures", "title_parse", "combined_projects", "dept_codes", "clean_documents", "dataset_build",
    "chunks", "chunk_pool", "fit_budget", "multi_hot", "isin_flag", "report", "threshold_best", "timing",
    "accuracy", "progress", "leaderboard", "human_vs_model", "summaries", "claim_sessions", "stale_claims",
    "claimable_next", "split_80_20", "highlight", "page_links", "follow_frontier", "harvest_union",
    "download_plan", "download_stats", "relevance_filter", "profile_table", "commune_counts", "crs_select",
    "decimal_sum", "tech_counts", "parse_answers", "upsert_import", "park_cover_link", "vintage_latest",
    "has_cover", "area_check", "usage_shares", "polygon_area_centroid", "geojson_export", "crs_project",
    "dbscan_parks", "dbscan_geodesic", "incremental_ingest", "claim_sessions_stream",
    "page_blocks", "arena_report", "text_classifier", "embedding_classifier", "csv_roundtrip",
    "file_inventory", "event_props", "annotation_search", "user_contributions",
    "download_labels", "resumed_ingest", "resumed_scoring", "wkb_round_trip", "dot_segments",
    "typed_projection", "multi_hot_array", "labelled_texts", "validated_facet", "attempt_outcomes", "layers_round_trip",
    "scored_runs", "listing_blocks", "next_pages", "heading_blocks", "card_details", "table_rows", "dated_paragraphs", "offset_pages",
    "detail_records", "harvest_projects",
    "lock_life_cycle", "lock_life_cycle_stream", "refused_claims", "ordered_ingest", "ingest_rejects",
    "framed_projects", "nested_table_rows", "year_pages", "crawl_chains", "card_documents", "hop_paragraphs", "result_blocks", "notices",
    "headed_documents", "harvest_sources",
    "packed_predictions", "label_counts", "document_links", "table_modes", "binary_inventory", "years_ascending", "span_rejects", "crs_round_trip",
    "site_clusters", "profile_increments", "plugin_scores", "scorer_arena", "text_classifier_accuracy", "embedding_classifier_accuracy",
]
