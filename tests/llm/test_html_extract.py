import html
import re

from terrasol.llm import html_extract as hx
from terrasol.llm.queries import op6_html_extract
from llm_data import SF

PAGE = """<!DOCTYPE html><html><head><title>no title words</title><style>p{x:y}</style></head><body>
<div id="cookie-notice">We use cookies and many more words stand here</div>
<header class="site-header"><h1>Site name</h1><ul><li><a href=a>Home page</a></li><li><a href=b>About us</a></li></ul></header>
<%s><h1>Real &lt;Title&gt;</h1><p>First para with <b>bo</b>ld &amp; text,&nbsp;&eacute;.<p>Second
   para.<aside>Side stuff here</aside><p>Third<br>line</p><ul><li>item one</li><li>item two</li></ul>
<form><label>Mail</label><input></form><script>var t = "</p> words";</script><!-- a <p>comment</p> -->
<div class="advert">Buy now</div><p>Last para with enough words.</p></%s>
<section class="comments"><p>Nice article</p><p>I disagree with this a lot and write many words to tell you so</p></section>
<aside class=sidebar><p>Popular posts of the week</p></aside><footer><p>Copyright all rights</p></footer></body></html>"""
WANT = "Real <Title> First para with bold & text, é. Second para. Third line item one item two Last para with enough words."


def article_text(page):
    """Text of the article element, by plain substitution (pages whose markup is simple)."""
    a = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    a = re.sub(r"<[^>]*>", " ", re.sub(r"</?(b|i|em|a|span|strong)\b[^>]*>", "", a))
    return " ".join(html.unescape(a).split())


def test_query_equals_article_elements(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op6_html_extract(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        p = pages[r.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, article_text(p.html), len(article_text(p.html)))


def test_learned_weights_carry_over_to_other_markup(spark):
    w = hx.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    for tag in ("article", "main", "div"):
        assert hx.main_text(PAGE % (tag, tag), w) == WANT
    assert all(v < 0 for (kind, _), v in w.items() if kind == "tag")


def test_odd_pages(spark):
    w = hx.learn(spark.createDataFrame([], "page_id long, html string"))
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>no id"), (4, "u", "plain words only"), (5, "u", "<p>"), (6, "u", "<article></article>"),
            (7, "u", "<div><p>un </span>deux</p> <p>trois</p> quatre"), (8, "u", "<p>" + "long words " * 50000 + "</p>"), (8, "u", "<p>1 < 2 > 0 & x</p>"),
            (9, "u", "<nav><a href=x>Menu</a></nav>"), (10, "u", "<p title='a > b'>attr</p>"), (11, "u", "<script>var x = '<p>no</p>'"), (12, "u", "<P>UPPER<BR/>case</P>")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [(r.page_id, r.text) for r in sorted(hx.extract(df, w).collect(), key=lambda r: (r.page_id or 0, r.n_chars))]
    assert got == [(None, "no id"), (1, ""), (2, ""), (4, "plain words only"), (5, ""), (6, ""), (7, "un deux trois quatre"), (8, "1 < 2 > 0 & x"),
                   (8, ("long words " * 50000).strip()), (9, ""), (10, "attr"), (11, ""), (12, "UPPER case")]


def test_best_region_equals_all_pairs():
    import random
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.choice((-3, -1, -0.5, 0, 1, 2)) for _ in range(rng.randrange(0, 9))]
        lo, hi = hx.best_region(s)
        assert sum(s[lo:hi]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_noise_words_and_forms_around_the_article_do_not_hide_it(spark):
    w = hx.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    for wrapper in ("div class='layout has-sidebar'", "div id='search-results-page'", "section class='post with-comments'", "form method=post action='x.aspx'"):
        for tag in ("article", "main", "div"):
            name = wrapper.split()[0]
            page = (PAGE % (tag, tag)).replace("<body>", f"<body><{wrapper}>").replace("</body>", f"</{name}></body>")
            assert hx.main_text(page, w) == WANT, (wrapper, tag)
    both = "<form><div class='layout has-sidebar'><p>%s</p><div class=sidebar><p>Side stuff</p></div></div></form>" % ("long words " * 20)
    assert hx.main_text(both, w) == ("long words " * 20).strip()
    assert hx.main_text("<form><label>Name</label><input><label>Mail</label></form>", w) == ""


def test_comments_in_article_elements_stay_noise(spark):
    w = hx.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    page = "<div class='page with-sidebar'><article><p>%s</p></article><div id=comments>%s</div></div>"
    assert hx.main_text(page % ("the text " * 9, "<article class=comment><p>I disagree a lot</p></article>" * 2), w) == ("the text " * 9).strip()


def test_unclosed_elements_do_not_swallow_the_page(spark):
    w = hx.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    for tag in ("button", "select", "svg", "noscript", "object", "canvas", "template", "math"):
        assert hx.main_text(f"<div><{tag}><p>the words of a text</p></div>", w) == "the words of a text", tag
    assert hx.main_text("<button>one<p>the words of a text</p><button>two</button>", w).endswith("the words of a text")
    assert hx.main_text("<p class=ad>Buy<p>the words of a text</p>", w) == "the words of a text"


def test_broken_markup_takes_linear_time():
    import time
    w = hx.weights({})
    for piece in ("<a 'x ", "<![CDATA[", "<svg>", "<button>", "<!--", "<a '>' ", "<script", "</div>", "<", "<p title='", "<select><b>", "<a \"'\">", "<x='\""):
        start = time.process_time()
        hx.main_text(f"<p>{'the words of a text ' * 20}</p>" + piece * (1_000_000 // len(piece)), w)
        assert time.process_time() - start < 6, piece  # seconds for 1 MB; it was minutes where time grew with the square


def test_tags_of_broken_markup():
    names = lambda page: [(n, c) for _, _, n, c, _ in hx.tags(page)]
    assert names("<a href='x>y'>b</a><br/><!-- <p> --><p") == [("a", False), ("a", True), ("br", False), ("", False)]
    assert names("<a 'x>y<b>z</b>") == [("a", False), ("b", False), ("b", True)]   # the quote has no end: the tag ends at the first >
    assert names("<script>var a = '<p>';</script><p>x") == [("", False), ("p", False)] and names("<script><p>x") == [("", False)]
    assert names("<svg><p>x</svg><svg><p>") == [("", False), ("svg", False), ("p", False)]
    assert names("<button>a<button>b</button>") == [("button", False), ("", False)] and names("a < b <> c </ d") == []


def test_empty_table_and_rows_without_ids(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert hx.extract(none, hx.learn(none)).collect() == []
    rows = [(None, None, f"<nav>menu {k}</nav><article><p>{'words of the text ' * 9}</p></article>") for k in range(200)]
    pages = spark.createDataFrame(rows, none.schema)
    assert hx.learn(pages, 100) != hx.learn(none) and hx.extract(pages, hx.learn(pages, 100)).where("n_chars > 0").count() == 200
