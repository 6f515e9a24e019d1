import datetime as dt

from pyspark.sql import functions as F

from terrasol.functions import harvest as hv
from terrasol.operators import harvest, html_blocks


def test_resolve_and_file_names(spark):
    base = "https://www.example.org/avis/2019/index.html?p=2#top"
    hrefs = ["/docs/a.PDF", "//cdn.example.org/b.pdf", "c.pdf?x=1", "#frag", "?p=3", "http://other.org/d", ""]
    df = spark.createDataFrame([(base, h) for h in hrefs], "b string, h string")
    got = [(r.u, r.f, r.p) for r in df.select(hv.resolve_url("b", "h").alias("u")).select(
        "u", hv.file_name("u", keep_query=False).alias("f"), hv.is_pdf("u").alias("p")).collect()]
    assert got == [
        ("https://www.example.org/docs/a.PDF", "a.PDF", True),
        ("https://cdn.example.org/b.pdf", "b.pdf", True),
        ("https://www.example.org/avis/2019/c.pdf?x=1", "c.pdf", False),
        ("https://www.example.org/avis/2019/index.html?p=2#frag", "index.html", False),
        ("https://www.example.org/avis/2019/index.html?p=3", "index.html", False),
        ("http://other.org/d", "d", False),
        ("https://www.example.org/avis/2019/index.html?p=2", "index.html", False),
    ]


def test_dates_and_filters(spark):
    df = spark.createDataFrame([("1er janvier 2012", "05/03/2014", "2015", "Parc Photovoltaïque"),
                                ("32 mars 2014", "xx", "2019", "Centrale SOLAIRE")], "fr string, sl string, y string, t string")
    r = df.select(hv.parse_french_date("fr").alias("a"), hv.parse_date("sl", "dd/MM/yyyy").alias("b"),
                  hv.year_in_range("y").alias("c"), hv.relevant_folded("t").alias("d"), hv.relevant_regex("t").alias("e"),
                  hv.relevant_plain("t").alias("f")).collect()
    assert (r[0].a, r[0].b, r[0].c, r[0].d, r[0].e, r[0].f) == (dt.date(2012, 1, 1), dt.date(2014, 3, 5), True, True, True, True)
    assert (r[1].a, r[1].b, r[1].c, r[1].d) == (None, None, False, True)


def test_union_sorted_columns(spark):
    a = spark.createDataFrame([("p", "u")], "project_name string, pdf_url string")
    b = spark.createDataFrame([("q", "v", "973")], "project_name string, pdf_url string, departement_code string")
    u = harvest.union_sources(a, b)
    assert u.columns == ["departement_code", "pdf_url", "project_name"] and u.count() == 2


def test_html_heading_scoped_blocks(spark):
    html = ("<html><body><h2>Commune A</h2><p>Projet solaire 1</p><a href='/x.pdf'>pdf</a>"
            "<p>Projet 2</p><h2>Commune B</h2><p>Projet 3</p><script>var a='<p>';</script></body></html>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    el = html_blocks.page_elements(pages)
    got = [(r.section, r.block_text, r.next_link) for r in
           html_blocks.heading_scoped_blocks(el).orderBy("pos").collect()]
    assert got == [("Commune A", "Projet solaire 1", "/x.pdf"), ("Commune A", "Projet 2", None),
                   ("Commune B", "Projet 3", None)]


def test_table_rows_dated_paragraphs_plan_details(spark):
    html = ("<table><tr><td>Projet photovoltaïque</td><td><a href='/a.pdf'>Avis du 05/03/2014</a></td><td>Commune X</td></tr>"
            "<tr><td>Éolien</td><td><a href='/b.pdf'>Avis</a></td><td>Commune Y</td></tr></table>"
            "<p>• Parc solaire de Z - 1er janvier 2012</p><p>Sans date</p>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    el = html_blocks.page_elements(pages).cache()
    rows = [(r.project_name, r.pdf_href, r.publish_date) for r in html_blocks.table_row_links(el).collect()]
    assert rows == [("Commune X", "/a.pdf", dt.date(2014, 3, 5))]
    par = sorted((r.ok, r.title, r.publish_date, r.pdf_filename) for r in html_blocks.dated_paragraphs(el).collect())
    assert par == [(False, None, None, None), (True, "Parc solaire de Z", dt.date(2012, 1, 1), "Parc solaire de Z.pdf")]
    plan = spark.createDataFrame([("https://x/list?q=1", 35), ("https://y/list?q=1", 5)], "base_url string, num_docs int")
    assert [r.start for r in html_blocks.offset_page_plan(plan).collect()] == [10, 20, 30]
    det = spark.createDataFrame([("Avis délibéré", '{"d": {"documents": [{"id": "doc-42", "url": "/f.pdf"}]}}'),
                                 ("Décision", '{"d": {"documents": []}}')], "title string, payload string")
    assert [(r.pdf_url, r.document_id) for r in html_blocks.detail_records(det).collect()] == [("/f.pdf", "42")]


def test_keep_document_links(spark):
    df = spark.createDataFrame([("Avis publiés", "/index"), ("Avis X", None), ("Avis Y", "/y.pdf"), (None, "/z")],
                               "title string, href string")
    assert sorted(r.href for r in hv.keep_document_links(df).collect()) == ["/y.pdf", "/z"]


def test_dot_segments_like_urljoin(spark):
    from urllib.parse import urljoin
    bases = ["https://h/a/b/c.html", "https://h/a/", "https://h", "https://h/x/y/z/w?q=1#f"]
    refs = ["../z.pdf", "./a/../b", "/x/./y/../z?q=../r#s", "../../../../up", "a/b/..", "/p/q/.", "plain", "a..b/c.", "..", "."]
    rows = [(b, h) for b in bases for h in refs]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", hv.resolve_url("b", "h").alias("u")).collect()
    assert [(r.b, r.h, r.u) for r in got] == [(b, h, urljoin(b, h)) for b, h in rows]


def test_anchor_quotes(spark):
    html = """<a href="/1.pdf">un</a><A class=x HREF='/2.pdf' >d<b>eu</b>x</A><a data-href="/no" href=/3.pdf>trois</a><a name=x>no</a>"""
    pages = spark.createDataFrame([(1, "https://h/", html)], "page_id long, url string, html string")
    got = [(r.link_pos, r.abs_url, r.anchor_text) for r in harvest.extract_links(pages).orderBy("link_pos").collect()]
    assert got == [(0, "https://h/1.pdf", "un"), (1, "https://h/2.pdf", "deux"), (2, "https://h/3.pdf", "trois")]


def test_stray_end_tags_and_listing_layouts(spark):
    listing = ("<h1>Avis</h1><div class='texteencadre main'><h2>Parc A</h2><p>Projet solaire</p><a href='/a.pdf'>Avis A</a><a href='/a2.pdf'>Annexe</a></div>"
               "<p>entre</p><div class='texteencadre'><h3>Parc B</h3><p>Sans lien</p></div><a href='?p=2'>Suivant</a>")
    pages = spark.createDataFrame([(1, "<div>un </span>deux <p>trois</p> quatre</div>"), (2, listing)], "page_id long, html string")
    el = html_blocks.page_elements(pages)
    text = " ".join(r.text for r in el.where("page_id = 1").orderBy("pos").collect())
    assert all(w in text for w in ("un", "deux", "trois", "quatre"))
    got = [(r.heading, r.block_text, r.href, r.label) for r in html_blocks.listing_blocks(el).orderBy("block_pos", "link_pos").collect()]
    assert got == [("Parc A", "Parc A Projet solaire Avis A Annexe", "/a.pdf", "Avis A"), ("Parc A", "Parc A Projet solaire Avis A Annexe", "/a2.pdf", "Annexe"),
                   ("Parc B", "Parc B Sans lien", None, None)]
    assert [r.next_href for r in html_blocks.next_page_links(el).collect()] == ["?p=2"]
    details = html_blocks.page_elements(spark.createDataFrame([(7, "<a href='/x'>x</a><a href='/d.PDF'>PDF</a>")], "page_id long, html string"))
    cards = spark.createDataFrame([("A", "https://h/7"), ("B", "https://h/8")], "title string, abs_url string")
    joined = html_blocks.card_details(cards, details.withColumn("url", F.concat(F.lit("https://h/"), F.col("page_id").cast("string"))))
    assert sorted((r.title, r.pdf_href) for r in joined.collect()) == [("A", "/d.PDF"), ("B", None)]
    assert html_blocks.bad_pages(el).collect() == []
