"""Harvest operators over the ``pages`` table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasol.functions import harvest as H
from terrasol.functions.common import strip

REQUIRED_PLAN_COLUMNS = ("pdf_url", "pdf_filename")


def extract_links(pages: DataFrame) -> DataFrame:
    """One row per anchor: position, raw href, anchor text, absolute URL,
    file name, pdf flag and first year found in the anchor text (H1 H9 H10 H13 U4)."""
    group = lambda n: F.regexp_extract_all("html", F.lit(H.ANCHOR), n)
    # one of the three href groups holds the reference, the others are empty
    join = lambda a, b: F.concat(a, b)
    hrefs = F.zip_with(F.zip_with(group(1), group(2), join), group(3), join)
    texts = group(4)
    ex = pages.select("page_id", "url", F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text")))
                      .alias("link_pos", "a"))
    abs_url = H.resolve_url("url", F.col("a.href"))
    return ex.select(
        "page_id", "link_pos", F.col("a.href").alias("href"),
        strip(F.regexp_replace(F.col("a.text"), r"<[^>]*>", "")).alias("anchor_text"),
        abs_url.alias("abs_url")).select(
        "*", H.file_name("abs_url").alias("file_name"), H.is_pdf("abs_url").alias("is_pdf"),
        H.first_year("anchor_text").alias("year"))


def follow_frontier(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Every distinct link target with its reference count and whether the page
    it points to is already fetched (J9); unfetched targets are the frontier (J7)."""
    targets = links.groupBy("abs_url").agg(F.count("*").alias("n_refs"))
    fetched = pages.select(F.col("url").alias("abs_url")).distinct().withColumn("fetched", F.lit(True))
    return (targets.join(fetched, "abs_url", "left")
                   .select("abs_url", "n_refs", F.coalesce("fetched", F.lit(False)).alias("fetched")))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Union of heterogeneous harvest sources, missing columns null, columns
    sorted alphabetically (U2, H14)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    return u.select(*sorted(u.columns))


def to_metadata(harvested: DataFrame) -> DataFrame:
    """Harvest rows under the column names of the project metadata, so that they feed ``combine_projects`` (Q13)."""
    return harvested.withColumnsRenamed({"project_name": "title", "pdf_filename": "pdf_name"})


def check_plan_columns(df: DataFrame, required=REQUIRED_PLAN_COLUMNS) -> None:
    """Schema contract."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def download_plan(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows to download: files already present with size > 0 are skipped."""
    check_plan_columns(plan)
    done = existing.where(F.col("size") > 0).select(F.col("file_name").alias("pdf_filename")).distinct() \
                   .withColumn("_done", F.lit(True))
    return (plan.join(done, "pdf_filename", "left")
                .withColumn("action", F.when(F.col("_done"), "skip").otherwise("download"))
                .drop("_done"))


def attempt_outcomes(planned: DataFrame, attempts: DataFrame, retries: int = 5) -> DataFrame:
    """total / skipped / success / failed of a run (A17): a planned download succeeds with any
    successful attempt among its first ``retries``; without one it has failed."""
    ok = attempts.where(F.col("attempt") <= retries).groupBy("pdf_filename").agg(F.max(F.col("ok").cast("int")).alias("_ok"))
    done = planned.join(ok, "pdf_filename", "left").withColumn("_ok", F.coalesce("_ok", F.lit(0)) == 1)
    todo = F.col("action") == "download"
    return done.agg(F.count("*").alias("total"), F.count_if(~todo).alias("skipped"),
                    F.count_if(todo & F.col("_ok")).alias("success"), F.count_if(todo & ~F.col("_ok")).alias("failed"))


def download_stats(planned: DataFrame) -> DataFrame:
    """total / skipped / to download."""
    return planned.agg(F.count("*").alias("total"), F.count_if(F.col("action") == "skip").alias("skipped"),
                       F.count_if(F.col("action") == "download").alias("to_download"))


def in_year_order(rows: DataFrame, year: str = "year") -> DataFrame:
    """Rows by ascending year, with their place from 1 (O7); years are few, so one task numbers them.

    A null year comes last; rows are expected one per year."""
    from pyspark.sql import Window
    order = F.col(year).asc_nulls_last()
    return rows.withColumn("place", F.row_number().over(Window.orderBy(order)).cast("long")).orderBy(order).select("place", *rows.columns)
