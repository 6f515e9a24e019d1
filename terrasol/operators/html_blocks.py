"""Structural HTML extraction (H2-H8) as one ``mapInPandas`` job.

HTML parsing is per-document work: each page is parsed once (standard-library
``html.parser``) into a flat element table (document position, tag, depth,
own text, href, class, datetime).  Layout rules are then plain Spark: a
window per page carries the last heading forward and looks ahead for the next
link, so each layout is a few Column expressions over the element table.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

ELEMENT_SCHEMA = StructType([
    StructField("page_id", LongType()), StructField("pos", IntegerType()), StructField("tag", StringType()),
    StructField("depth", IntegerType()), StructField("text", StringType()), StructField("href", StringType()),
    StructField("css_class", StringType()), StructField("datetime", StringType()),
    StructField("parent", IntegerType()),
])
BLOCK_TAGS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "a", "li", "td", "tr", "time", "div", "strong", "b", "article"}
#: Tag of the row that reports a page the parser gave up on.
ERROR_TAG = "#error"
VOID_TAGS = {"br", "img", "meta", "link", "input", "hr", "source", "wbr"}
SKIP_TAGS = {"script", "style"}


class _Flattener(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.stack, self.skip = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        if tag in SKIP_TAGS:
            self.skip += 1
        a = dict(attrs)
        row = None
        if tag in BLOCK_TAGS and not self.skip:
            parent = next((r[0] for _, r in reversed(self.stack) if r is not None), None)
            row = [len(self.rows), tag, len(self.stack), [], a.get("href"), a.get("class"), a.get("datetime"), parent]
            self.rows.append(row)
        self.stack.append((tag, row))

    def handle_endtag(self, tag):
        if all(t != tag for t, _ in self.stack):
            return  # an end tag without its element closes nothing
        while True:
            t, _ = self.stack.pop()
            if t in SKIP_TAGS:
                self.skip -= 1
            if t == tag:
                break

    def handle_data(self, data):
        if self.skip:
            return
        for _, row in reversed(self.stack):
            if row is not None:
                row[3].append(data)
                break


def _flatten_batches(batches):
    for pdf in batches:
        out = []
        for pid, html in zip(pdf["page_id"], pdf["html"]):
            p = _Flattener()
            try:
                p.feed(html or "")
                p.close()
            except (AssertionError, ValueError) as e:  # malformed page: keep what was parsed and say so
                out.append((pid, -1, ERROR_TAG, 0, str(e), None, None, None, None))
            for pos, tag, depth, texts, href, cls, dt, parent in p.rows:
                out.append((pid, pos, tag, depth, " ".join("".join(texts).split()), href, cls, dt, parent))
        yield pd.DataFrame(out, columns=[f.name for f in ELEMENT_SCHEMA.fields])


def page_elements(pages: DataFrame) -> DataFrame:
    """pages(page_id, html) → one row per block element in document order."""
    return pages.select("page_id", "html").mapInPandas(_flatten_batches, ELEMENT_SCHEMA)


def bad_pages(elements: DataFrame) -> DataFrame:
    """Pages that could not be parsed to their end, with the reason."""
    return elements.where(F.col("tag") == ERROR_TAG).select("page_id", F.col("text").alias("error"))


def listing_blocks(elements: DataFrame, css_class: str = "texteencadre") -> DataFrame:
    """H2 layout: every framed block of a listing with its heading, its whole text and each of its links.

    A block is an element whose class list holds ``css_class``; what stands
    between it and the next element of its depth or above belongs to it."""
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    framed = F.array_contains(F.split(F.coalesce("css_class", F.lit("")), r"\s+"), css_class)
    el = (elements.where(F.col("tag") != ERROR_TAG)
          .withColumn("_open", F.last(F.when(framed, F.struct("pos", "depth")), ignorenulls=True).over(w))
          .withColumn("_left", (F.col("depth") <= F.col("_open.depth")) & (F.col("pos") > F.col("_open.pos"))))
    inside = Window.partitionBy("page_id", "_open.pos").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    el = el.where(F.col("_open").isNotNull()).withColumn("_gone", F.max(F.col("_left").cast("int")).over(inside)).where("_gone = 0")
    heading = F.min_by("text", F.when(F.col("tag").rlike("^h[1-6]$"), F.col("pos")))
    row = F.struct("pos", "text")
    blocks = el.groupBy("page_id", F.col("_open.pos").alias("block_pos")).agg(
        heading.alias("heading"), F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["text"]), lambda t: t != ""), " ").alias("block_text"),
        F.array_sort(F.collect_list(F.when((F.col("tag") == "a") & F.col("href").isNotNull(), F.struct("pos", "href", "text")))).alias("links"))
    return blocks.select("page_id", "block_pos", "heading", "block_text", F.posexplode_outer("links").alias("link_pos", "l")).select(
        "page_id", "block_pos", "heading", "block_text", "link_pos", F.col("l.href").alias("href"), F.col("l.text").alias("label"))


def next_page_links(elements: DataFrame, labels=("suivant", "page suivante", ">", "»")) -> DataFrame:
    """H1: the first link of a page that leads to the next page of its listing."""
    hit = (F.col("tag") == "a") & F.col("href").isNotNull() & F.lower(F.trim("text")).isin(*labels)
    return elements.where(hit).groupBy("page_id").agg(F.min_by("href", "pos").alias("next_href"))


def card_details(cards: DataFrame, details: DataFrame, link: str = "abs_url", url: str = "url") -> DataFrame:
    """H4 layout: cards of a listing joined with the first PDF link of the detail page each one leads to."""
    from terrasol.functions import harvest as hv
    pdfs = (details.where((F.col("tag") == "a") & hv.is_pdf(F.col("href")))
            .groupBy(F.col(url).alias(link)).agg(F.min_by("href", "pos").alias("pdf_href"), F.min_by("text", "pos").alias("pdf_label")))
    return cards.join(pdfs, link, "left")


def heading_scoped_blocks(elements: DataFrame, heading: str = "h2", block: str = "p") -> DataFrame:
    """H3 layout: each ``block`` element with the last preceding ``heading`` of its
    page and the href of the element that follows it when that one is a link."""
    w = Window.partitionBy("page_id").orderBy("pos")
    sec = F.last(F.when(F.col("tag") == heading, F.col("text")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt_tag, nxt_href = F.lead("tag").over(w), F.lead("href").over(w)
    return (elements.withColumn("section", sec).withColumn("_nt", nxt_tag).withColumn("_nh", nxt_href)
                    .where(F.col("tag") == block)
                    .select("page_id", "pos", "section", F.col("text").alias("block_text"),
                            F.when(F.col("_nt") == "a", F.col("_nh")).alias("next_link")))


def _subtree_text(elements: DataFrame) -> DataFrame:
    """Own text of each element plus that of its direct children (rows → cells)."""
    kids = (elements.where(F.col("parent").isNotNull())
            .groupBy("page_id", F.col("parent").alias("pos"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]),
                              " ").alias("_kids")))
    return (elements.join(kids, ["page_id", "pos"], "left")
                    .withColumn("full_text", F.trim(F.concat_ws(" ", "text", "_kids"))).drop("_kids"))


def table_row_links(elements: DataFrame, keyword_regex: str = r"(?iu)volta[iï]que|solaire") -> DataFrame:
    """H5 layout: table rows mentioning a keyword → their PDF links; the project is
    the row's last cell and the date (dd/mm/yyyy) is read from the link label."""
    el = _subtree_text(elements)
    rows = el.where((F.col("tag") == "tr") & F.col("full_text").rlike(keyword_regex)).select(
        "page_id", F.col("pos").alias("tr_pos"))
    cells = el.where(F.col("tag") == "td").select("page_id", F.col("parent").alias("tr_pos"),
                                                   F.col("pos").alias("td_pos"), F.col("text").alias("cell"))
    last_cell = cells.groupBy("page_id", "tr_pos").agg(F.max_by("cell", "td_pos").alias("project_name"))
    links = el.where((F.col("tag") == "a") & F.lower("href").endswith(".pdf")).select(
        "page_id", F.col("parent").alias("td_pos"), "href", F.col("text").alias("label"))
    link_rows = links.join(cells.select("page_id", "tr_pos", "td_pos"), ["page_id", "td_pos"])
    return (rows.join(link_rows, ["page_id", "tr_pos"]).join(last_cell, ["page_id", "tr_pos"])
                .select("page_id", "tr_pos", "project_name", F.col("href").alias("pdf_href"),
                        F.try_to_date(F.regexp_extract("label", r"([0-9]{2}/[0-9]{2}/[0-9]{4})", 1), "dd/MM/yyyy")
                        .alias("publish_date")))


def dated_paragraphs(elements: DataFrame) -> DataFrame:
    """H6 layout: paragraphs ``title - d MMMM yyyy`` (leading ``-``/``•`` removed);
    anything that does not split into exactly two parts is a bad row."""
    from terrasol.functions import harvest as hv
    p = elements.where(F.col("tag") == "p").select(
        "page_id", "pos", F.regexp_replace("text", r"^[\-•\s]+", "").alias("t"))
    parts = F.split("t", " - ")
    return p.select("page_id", "pos", (F.size(parts) == 2).alias("ok"),
                    F.when(F.size(parts) == 2, F.trim(parts[0])).alias("title"),
                    F.when(F.size(parts) == 2, hv.parse_french_date(parts[1])).alias("publish_date"),
                    F.when(F.size(parts) == 2, hv.sanitize_filename(F.concat(F.trim(parts[0]), F.lit(".pdf"))))
                    .alias("pdf_filename"))


def offset_page_plan(listing: DataFrame, base_url: str = "base_url", num_docs: str = "num_docs",
                     step: int = 10) -> DataFrame:
    """H7: result pages at offsets ``step, 2*step, …`` while below ``num_docs``."""
    offs = F.when(F.col(num_docs) > step, F.sequence(F.lit(step), F.col(num_docs) - 1, F.lit(step))) \
            .otherwise(F.array().cast("array<int>"))
    return listing.select(base_url, F.explode(offs).alias("start")).select(
        base_url, "start", F.concat(F.col(base_url), F.lit("&start="), F.col("start").cast("string")).alias("page_url"))


DOCS_SCHEMA = "struct<d: struct<documents: array<struct<id: string, url: string>>>>"


def detail_records(details: DataFrame, title: str = "title", payload: str = "payload") -> DataFrame:
    """H8: detail records whose title contains ``Avis``; the first document of the
    JSON list (``d.documents[0]``) and its numeric id."""
    from terrasol.functions import harvest as hv
    doc = F.get(F.from_json(F.col(payload), DOCS_SCHEMA)["d"]["documents"], 0)
    return (details.where(hv.is_opinion_title(F.col(title)))
                   .select(title, doc["url"].alias("pdf_url"),
                           F.nullif(F.regexp_extract(doc["id"], r"([0-9]+)", 1), F.lit("")).alias("document_id")))
