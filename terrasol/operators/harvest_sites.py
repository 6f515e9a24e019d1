"""The seven harvest sources as layout rules over page trees.

Every function takes the tree table of :mod:`terrasol.operators.page_tree` (staged by
the caller, as it is read several times) and returns harvest rows under the common
column names; columns that a source does not have are missing and become null in the
union.  Links are resolved against the page's own url.  What a layout lacks (no link,
no date) gives nulls or no row as said, never an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasol.functions import harvest as hv
from terrasol.functions.text import fold_keywords
from terrasol.operators import crawl
from terrasol.operators.joins import by_shuffle
from terrasol.operators.page_tree import contents, first_inside, has_class, inside, spans_of, subtree_text, with_text

# Classes and ids that mark the sources' layouts, and the default title.
FRAME, DOWNLOAD, CARD_TITLE, NEXT = "texteencadre-spip", "fr-download__link", "fr-card__title", "fr-pagination__link--next"
CARD_LINK = ("fr-card__link", "article-card-lien")
UNTITLED = "Sans titre"
NOTICE, VIEWER = "notice_longue_description", "dr-viewer"


def _a(tree: DataFrame, *classes: str) -> DataFrame:
    return tree.where((F.col("tag") == "a") & has_class(*classes))


def year_links(tree: DataFrame) -> DataFrame:
    """H1: ``page_id, url, year, year_url`` of the cards under ``h2.fr-card__title`` (year: four digits of the link's title)."""
    heads = tree.where((F.col("tag") == "h2") & has_class(CARD_TITLE))
    links = inside(heads, tree.where((F.col("tag") == "a") & F.col("href").isNotNull())).select("page_id", "m").distinct()
    return links.select("page_id", "m.url", hv.first_year("m.title").alias("year"), hv.resolve_url("m.url", "m.href").alias("year_url"))


def year_pages(tree: DataFrame, start: DataFrame) -> DataFrame:
    """H1, paged: the year links of each start page and of all pages its next links lead to."""
    chain = crawl.follow(start, crawl.next_links(tree, has_class(NEXT)))
    return chain.join(by_shuffle(year_links(tree)), "url").select("origin", "hop", "year", "year_url")


def framed_projects(tree: DataFrame) -> DataFrame:
    """H2: framed blocks that mention solar power: title (first strong, ``Sans titre`` without), folded text, first download link."""
    frames = tree.where((F.col("tag") == "div") & has_class(FRAME))
    blocks = frames.select("page_id", "pos", "last", "url").join(by_shuffle(subtree_text(tree, frames)), ["page_id", "pos"])
    blocks = blocks.where(hv.relevant_folded("text"))
    strong = with_text(tree, first_inside(blocks, tree.where("tag = 'strong'"), "strong"), "strong", "title", sep="")
    link = first_inside(blocks, _a(tree, DOWNLOAD), "link")
    out = blocks.join(by_shuffle(strong), ["page_id", "pos"], "left").join(by_shuffle(link), ["page_id", "pos"])
    out = out.where(F.coalesce("link.href", F.lit("")) != "").withColumn("pdf_url", hv.resolve_url("url", "link.href"))
    return out.select("page_id", F.coalesce("title", F.lit(UNTITLED)).alias("project_name"), fold_keywords("text").alias("description"),
                      "pdf_url", hv.file_name("pdf_url").alias("pdf_filename"))


def headed_documents(tree: DataFrame) -> DataFrame:
    """H3: download links of a department page under their last ``h2`` (the commune) with the year of the page's ``h1``."""
    from pyspark.sql import Window
    w = Window.partitionBy("page_id").orderBy("pos")
    marks = tree.where(F.col("tag").isin("h1", "h2") | ((F.col("tag") == "a") & hv.is_pdf(F.col("href"))))
    heads = subtree_text(tree, marks, name="t")
    marks = marks.join(by_shuffle(heads), ["page_id", "pos"])
    last = lambda tag: F.last(F.when(F.col("tag") == tag, F.col("t")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marks = marks.withColumns({"commune": last("h2"), "head": last("h1")}).where("tag = 'a'")
    marks = marks.withColumn("pdf_url", hv.resolve_url("url", "href"))
    return marks.where(hv.relevant_plain("t")).select("page_id", F.col("t").alias("project_name"), F.col("commune").alias("commune_name_scraped"),
                                                      hv.first_year("head").alias("year_scraped"), "pdf_url", hv.file_name("pdf_url").alias("pdf_filename"))


def cards(tree: DataFrame, start: DataFrame) -> DataFrame:
    """H4: ``origin, title, detail_url`` of the relevant cards of each start page and all pages its next links lead to."""
    chain = crawl.follow(start, crawl.next_links(tree, has_class(NEXT)))
    found = _a(tree, *CARD_LINK).where(F.col("href").isNotNull())
    found = found.select("page_id", "pos", "url", "href").join(by_shuffle(subtree_text(tree, found, sep="", strip=False, name="title")), ["page_id", "pos"])
    found = found.where(hv.relevant_plain("title")).select("url", "title", hv.resolve_url("url", "href").alias("detail_url"))
    return chain.join(by_shuffle(found), "url").select("origin", "title", "detail_url")


def card_documents(tree: DataFrame, start: DataFrame, details: DataFrame, code: str | None = None) -> DataFrame:
    """H4: cards with the date and the download of the page each one leads to (a page not fetched: nulls)."""
    time = details.where("tag = 'time'").groupBy("url").agg(F.min_by("datetime", "pos").alias("when"))
    link = _a(details, DOWNLOAD).groupBy("page_id", "url").agg(F.min_by(F.struct("pos", "last", "href"), "pos").alias("link"))
    # the file is named after the link's first content
    first = contents(details, spans_of(link, "link")).groupBy("page_id", "pos").agg(F.min_by("text", "at").alias("label"))
    link = link.join(by_shuffle(first), (link["page_id"] == first["page_id"]) & (link["link.pos"] == first["pos"]), "left").select("url", "link.href", "label")
    found = cards(tree, start).withColumnRenamed("detail_url", "url")
    out = found.join(by_shuffle(time), "url", "left").join(by_shuffle(link), "url", "left")
    return out.select("origin", F.col("title").alias("project_name"), F.lit(code).cast("string").alias("departement_code"),
                      hv.parse_date("when", "yyyy-MM-dd").alias("publish_date_scraped"),
                      F.concat(F.replace(F.trim("label"), F.lit(" "), F.lit("_")), F.lit(".pdf")).alias("pdf_filename"),
                      hv.resolve_url("url", "href").alias("pdf_url"))


def keyword_rows(tree: DataFrame) -> DataFrame:
    """H5: the PDF links anywhere inside the table rows that mention solar power.

    The project is the first content of the row's last cell (in page order, nested
    tables included; blank text is no content); the date is read from the link's label,
    which is the file's name where the link has no text.
    """
    rows = tree.where("tag = 'tr'").select("page_id", "pos", "last", "url")
    rows = rows.join(by_shuffle(subtree_text(tree, rows)), ["page_id", "pos"]).where(hv.relevant_regex("text")).select("page_id", "pos", "last", "url")
    cell = first_inside(rows, tree.where("tag = 'td'"), "cell", last=True)
    inner = contents(tree, spans_of(cell, "cell"))
    kids = inner.where("child is not null").select("page_id", F.col("child.pos").alias("pos"), F.col("child.last").alias("last"))
    texts = subtree_text(tree, kids, sep="", strip=False, name="inner").withColumnRenamed("pos", "at")
    inner = inner.join(by_shuffle(texts), ["page_id", "at"], "left").withColumn("name", F.trim(F.coalesce("text", "inner"))).where("name != ''")
    names = inner.groupBy("page_id", F.col("pos").alias("cell_pos")).agg(F.min_by("name", "at").alias("project_name"))
    named = cell.select("page_id", "pos", F.col("cell.pos").alias("cell_pos")).join(by_shuffle(names), ["page_id", "cell_pos"]).select("page_id", "pos", "project_name")
    links = inside(rows, tree.where((F.col("tag") == "a") & hv.is_pdf("href")))
    links = links.select("page_id", F.col("c.pos").alias("pos"), F.col("c.url").alias("url"), F.struct("m.pos", "m.last", "m.href").alias("link"))
    links = with_text(tree, links, "link", "label", sep="").join(by_shuffle(named), ["page_id", "pos"], "left")
    links = links.withColumn("pdf_url", hv.resolve_url("url", "link.href"))
    label = F.coalesce(F.nullif("label", F.lit("")), hv.file_name("link.href"))
    date = F.regexp_extract(label, r"([0-9]{2}/[0-9]{2}/[0-9]{4})", 1)
    return links.select("page_id", "pos", "project_name", hv.parse_date(date, "dd/MM/yyyy").alias("publish_date_scraped"),
                        hv.file_name("link.href").alias("pdf_filename"), "pdf_url")


def dated_paragraphs(tree: DataFrame, details: DataFrame) -> DataFrame:
    """H6: paragraphs ``title - d MMMM yyyy`` with a document link; a link to a page is followed one hop to its download link.

    ``ok`` is false where the text does not part in exactly two at `` - ``.
    """
    p = tree.where((F.col("tag") == "p") & has_class("text-justify")).select("page_id", "pos", "last", "url")
    p = p.join(by_shuffle(subtree_text(tree, p, sep="", strip=False, name="t")), ["page_id", "pos"])
    p = p.withColumn("t", F.trim(F.regexp_replace(F.trim(F.regexp_replace("t", "^-", "")), "^•", ""))).where(hv.relevant_plain("t"))
    link = first_inside(p, tree.where("tag = 'a'"), "link").select("page_id", "pos", "link.href")
    p = p.join(by_shuffle(link), ["page_id", "pos"], "left").withColumn("target", hv.resolve_url("url", "href"))
    hop = _a(details, "fr-link", "fr-link--download").groupBy(F.col("url").alias("target")).agg(F.min_by("href", "pos").alias("_hop"))
    hop = hop.select("target", hv.resolve_url("target", "_hop").alias("hop_url"))
    direct = F.coalesce(F.col("href"), F.lit("")).endswith(".pdf")
    p = p.join(by_shuffle(hop), "target", "left").withColumn("parts", F.split("t", " - "))
    ok = F.size("parts") == 2
    return p.select("page_id", "pos", ok.alias("ok"), F.when(ok, F.col("parts")[0]).alias("project_name"),
                    F.when(ok, hv.parse_french_date(F.col("parts")[1])).alias("publish_date_scraped"),
                    F.when(ok, F.concat(F.lower(F.replace(F.col("parts")[0], F.lit(" "), F.lit("_"))), F.lit(".pdf"))).alias("pdf_filename"),
                    F.when(direct, F.col("target")).otherwise(F.col("hop_url")).alias("pdf_url"))


def result_blocks(tree: DataFrame) -> DataFrame:
    """H7: results of a search page: opinions and case decisions with communes and date (the third content of the information line)."""
    blocks = tree.where((F.col("tag") == "div") & has_class("texte", "fr-col-md-9")).select("page_id", "pos", "last", "url")
    link = with_text(tree, first_inside(blocks, tree.where("tag = 'a'"), "link"), "link", "title", sep="")
    out = blocks.join(by_shuffle(link), ["page_id", "pos"]).where(hv.is_opinion_or_case("title") & F.col("link.href").isNotNull())
    div = lambda c: tree.where((F.col("tag") == "div") & has_class(c))
    communes = with_text(tree, first_inside(out, div("liste_communes"), "c"), "c", "communes", sep="").select("page_id", "pos", "communes")
    info = first_inside(out, div("informations"), "i")
    third = contents(tree, spans_of(info, "i")).groupBy("page_id", F.col("pos").alias("_i")).agg(
        F.get(F.array_sort(F.collect_list(F.struct("at", "text"))), 2)["text"].alias("when"))
    when = info.select("page_id", "pos", F.col("i.pos").alias("_i")).join(by_shuffle(third), ["page_id", "_i"]).select("page_id", "pos", "when")
    out = out.join(by_shuffle(communes), ["page_id", "pos"], "left").join(by_shuffle(when), ["page_id", "pos"], "left").withColumn("pdf_url", hv.resolve_url("url", "link.href"))
    return out.select("page_id", "pos", F.col("title").alias("project_name"), hv.parse_french_date("when").alias("publish_date_scraped"),
                      F.split("communes", "/").alias("communes_names_scraped"), hv.file_name("link.href").alias("pdf_filename"), "pdf_url")


def notices(tree: DataFrame) -> DataFrame:
    """H8: notices titled ``Avis``: author, publisher, date of publication and the id of the document collection."""
    plain = lambda c: F.replace(F.col(c), F.lit("\\"), F.lit(""))
    div = lambda i: tree.where((F.col("tag") == "div") & (F.col("id") == i))

    def first_of(elements: DataFrame, name: str) -> DataFrame:
        return elements.groupBy("page_id").agg(F.min_by(F.struct("pos", "last"), "pos").alias(name))

    top = first_of(div(NOTICE), "n")
    title = with_text(tree, first_inside(spans_of(top, "n"), tree.where("tag = 'h2'"), "h"), "h", "title", sep="", strip=False)
    out = title.groupBy("page_id").agg(F.min_by("title", "pos").alias("title")).withColumn("title", plain("title")).where(hv.is_opinion_title("title"))
    for name in ("author", "publisher"):
        p = first_of(tree.where((F.col("tag") == "p") & has_class(f"item-{name}")), "p")
        a = with_text(tree, first_inside(spans_of(p, "p"), tree.where("tag = 'a'"), "a"), "a", name, sep="", strip=False)
        out = out.join(by_shuffle(a.select("page_id", plain(name).alias(name))), "page_id", "left")
    date = with_text(tree, first_of(tree.where((F.col("tag") == "p") & has_class("item-datepublication")), "p"), "p", "d", sep="", strip=False)
    said = F.trim(F.get(F.split("d", "Date de publication : "), 1))
    out = out.join(by_shuffle(date.select("page_id", hv.parse_date(said, "dd/MM/yyyy").alias("publish_date_scraped"))), "page_id", "left")
    script = first_inside(spans_of(first_of(div(VIEWER), "v"), "v"), tree.where("tag = 'script'"), "s")
    code = F.array_join(F.transform("s.pieces", lambda p: p["text"]), "")
    script = script.select("page_id", F.nullif(F.regexp_extract(code, "collectionId:'([0-9]+)'", 1), F.lit("")).alias("document_id"))
    out = out.join(by_shuffle(script), "page_id", "left")
    return out.select("page_id", F.trim("title").alias("project_name"), F.trim("author").alias("author"), F.trim("publisher").alias("publisher"),
                      "publish_date_scraped", "document_id")
