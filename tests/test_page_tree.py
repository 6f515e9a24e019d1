import datetime as dt
import random

from terrasol.operators import crawl, harvest_sites, page_tree as pt
from terrasol.sources import io

URL = "https://www.example.org/a/"


def tree_of(spark, *htmls):
    pages = spark.createDataFrame([(k, f"{URL}{k}", h) for k, h in enumerate(htmls)], "page_id long, url string, html string")
    return io.staged(pt.page_tree(pages), "test-tree")


def test_intervals_hold_exactly_the_descendants(spark):
    rng = random.Random(4)

    def page(depth):
        return "".join(rng.choice(["t ", "<br>", f"<div>{page(depth - 1)}</div>", f"<p class='x y'>{page(depth - 1)}<b>z</b></p>", "</i>"])
                       for _ in range(rng.randrange(5))) if depth else "u"

    tree = tree_of(spark, *(f"<body>{page(5)}</body>" for _ in range(20)))
    rows = tree.select("page_id", "pos", "last", "parent").collect()
    up = {(r.page_id, r.pos): r.parent for r in rows}
    want = set()
    for r in rows:
        at = r.pos
        while at is not None:
            want.add((r.page_id, at, r.pos))
            at = up[r.page_id, at]
    got = [(r.page_id, r.c.pos, r.m.pos) for r in pt.inside(tree.select("page_id", "pos", "last"), tree.select("page_id", "pos")).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_subtree_text_in_page_order(spark):
    tree = tree_of(spark, "<div>a <b>b<i> c</i></b>  d<script>no</script><p></p> e</div>", "", None, "<div><br/></div></div>")
    divs = tree.where("tag = 'div'")
    text = lambda **how: {r.page_id: r.text for r in pt.subtree_text(tree, divs, **how).collect()}
    assert text() == {0: "a b c d e", 3: ""}
    assert text(sep="") == {0: "abcde", 3: ""} and text(sep="", strip=False) == {0: "a b c d e", 3: ""}
    kinds = [(r.at, r.text, r.child and r.child.pos) for r in pt.contents(tree, divs.where("page_id = 0")).orderBy("at").collect()]
    assert [k[1] and k[1].strip() or bool(k[2]) for k in kinds] == ["a", True, "d", True, True, "e"]
    assert pt.bad_pages(tree).count() == 0


def test_links_inside_paragraphs_and_strong_of_cells(spark):
    rows = ("<table>"
            "<tr><td>Photovoltaïque</td><td><p><a href='d/1.pdf'>Avis du 03/02/2014</a></p></td><td>Un</td></tr>"
            "<tr><td><p>parc <strong>solaire</strong></p></td><td><strong><a href='/2.PDF'>Avis</a></strong></td><td><b>Deux</b> x</td></tr>"
            "<tr><td><em>Solaire</em></td><td><a href='3.pdf'></a></td></tr>"
            "<tr><td>Eolien</td><td><a href='4.pdf'>x</a></td></tr></table>")
    got = harvest_sites.keyword_rows(tree_of(spark, rows)).orderBy("pos").collect()
    assert [(r.project_name, r.publish_date_scraped, r.pdf_filename, r.pdf_url) for r in got] == [
        ("Un", dt.date(2014, 2, 3), "1.pdf", URL + "d/1.pdf"), ("Deux", None, "2.PDF", "https://www.example.org/2.PDF"), (None, None, "3.pdf", URL + "3.pdf")]


def test_deep_nesting_and_odd_pages(spark):
    deep = "<div>" * 3000 + "<tr>solaire<a href='x.pdf'>x</a>"
    assert harvest_sites.keyword_rows(tree_of(spark, deep, "<tr", "", None)).count() == 1
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    for f in (harvest_sites.framed_projects, harvest_sites.keyword_rows, harvest_sites.result_blocks, harvest_sites.notices, harvest_sites.headed_documents):
        assert f(pt.page_tree(empty)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_page_table_goes_through_the_driver(spark):
    tree = tree_of(spark, "<div class='texteencadre-spip'>solaire<a class='fr-download__link' href='x.pdf'>x</a></div>")
    for f in (harvest_sites.framed_projects, harvest_sites.keyword_rows, harvest_sites.result_blocks, harvest_sites.notices, harvest_sites.headed_documents):
        plan = plan_of(f(tree))
        assert "Join" in plan and "Broadcast" not in plan, f.__name__
    assert harvest_sites.framed_projects(tree).count() == 1


def test_each_source_is_computed_on_its_own(spark, monkeypatch):
    from terrasol.plans import driver
    a, b = (spark.createDataFrame([(1, 2)], f"page_id long, {c} long") for c in ("x", "y"))
    names = ("framed_projects", "headed_documents", "card_documents", "nested_table_rows", "hop_paragraphs", "result_blocks", "notices")
    for name in names:
        extra = {"card_documents": ["1 AS origin"], "hop_paragraphs": ["true AS ok"], "notices": ["current_date() AS publish_date_scraped", "'7' AS document_id"]}
        found = a.join(b, "page_id").selectExpr("page_id", "'p' AS project_name", *extra.get(name, []))
        monkeypatch.setattr(driver, name, lambda spark, sf_dir, found=found: found)
    got = driver.harvest_sources(spark, "")
    assert "Join" not in plan_of(got) and got.count() == 7


def test_crawl_follows_chains_and_ends_cycles(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", None), ("b", "c"), ("p", "p")], "url string, next_url string")
    start = spark.createDataFrame([("a",), ("x",), ("p",), (None,), ("a",)], "url string")
    got = sorted(tuple(r) for r in crawl.follow(start, links).collect())
    assert got == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("p", "p", 0), ("x", "x", 0), ("x", "y", 1)]
    assert sorted(r.hop for r in crawl.follow(start.where("url = 'a'"), links, hops=1).collect()) == [0, 1]


def test_one_hop_and_missing_pages(spark):
    p = ("<p class='text-justify'>• Parc solaire - 3 mars 2014 <a href='{}'></a></p><p class='text-justify'>solaire</p>")
    tree = tree_of(spark, p.format("x.pdf"), p.format("/detail"), p.format("/missing"))
    pages = spark.createDataFrame([(9, "https://www.example.org/detail", "<a href='no'>x</a><b><a class='fr-link fr-link--download z' href='f/y.pdf'>y</a></b>")],
                                  "page_id long, url string, html string")
    got = harvest_sites.dated_paragraphs(tree, pt.page_tree(pages)).where("ok").orderBy("page_id").collect()
    assert [r.pdf_url for r in got] == [URL + "x.pdf", "https://www.example.org/f/y.pdf", None]
    assert {(r.project_name, r.publish_date_scraped, r.pdf_filename) for r in got} == {("Parc solaire", dt.date(2014, 3, 3), "parc_solaire.pdf")}
