"""Main text of web pages by a maximum-scoring subsequence.

A page becomes a sequence of tokens: words score positive where articles have
them, tags (and words of menus, footers and the like) score negative.  The
weights are log-odds counted on labelled pages, whose article element marks the
content.  One linear scan finds the contiguous region with the highest score;
the text of its blocks is the main text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasol.llm.common import batches

#: Bound of the labelled pages that are counted.
MAX_LABELLED = 5000
#: Elements whose text runs to their end tag, or to the page's end without one; elements skipped whole where their end
#: tag is ahead; those that also end at the next one of their name.
RAW = frozenset("script style iframe textarea title".split())
SKIPPED = frozenset("noscript template svg object canvas math".split())
CONTROLS = frozenset("select button".split())
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
END = re.compile(r"""[>"']""")
LOWER = {c: c + 32 for c in range(65, 91)}
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset(("article", "main"))
#: Elements, roles and words of class or id that mark what is not the article.
NOISE_TAG = frozenset("nav footer aside form header menu dialog head".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_WORD = frozenset(
    "ad ads advert adverts advertisement advertising sidebar comment comments reply replies respond disqus cookie cookies consent gdpr "
    "notice notices banner promo promotion sponsor sponsored share sharing social related recommended menu nav navbar navigation breadcrumb "
    "breadcrumbs newsletter subscribe popup modal footer widget widgets login search toolbar pagination pager skip masthead".split())
NOISE_NAME = frozenset(("header", "site-header", "page-header", "top-header", "topbar"))
#: Most a run of noise words costs (none of them is part of the text, so a region may reach across an advert).
NOISE_COST = -4.0
#: Words that a form or a noise word's element must hold to count as the page's wrapper where no page word stands in a paragraph.
LOOSE_WORDS = 20
#: Counts every weight starts from, (inside, outside) an article; labelled pages add to them.
PRIOR = {"p": (6, 1), "noise": (1, 60), "link": (1, 8), "li": (4, 2), "h": (3, 1), "div": (2, 1), "td": (2, 1), "body": (2, 1.5), "other": (2, 1)}


def noise_kind(name: str, attributes: str, inside: bool) -> str:
    """Whether an element holds something other than the article's text (inside: it stands in an article).

    "hard": it does; "soft": a form, or a word of its class or id says so, which
    wrappers of a whole page have too (``lifted`` decides); "": no.
    """
    if name in NOISE_TAG and name != "form" and not (name == "header" and inside):
        return "hard"
    kind = "soft" if name == "form" else ""
    if not attributes or name in ("html", "body", *CONTENT):
        return kind
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            names = value.split()
            if NOISE_NAME.intersection(names) or NOISE_WORD.intersection(re.split(r"[^a-z]+", value)):
                kind = "soft"
        elif key == "role" and value in ("form", "search"):
            kind = "soft"
        elif key == "role" and value in NOISE_ROLE or key == "hidden" or key == "aria-hidden" and value == "true":
            return "hard"
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "hard"
    return kind


def group(name: str) -> str:
    return "h" if name in HEADING else "td" if name in ("td", "th") else name if name in ("p", "li", "div") else "other"


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of the tags of a page in one forward pass; the name is "" for comments and skipped elements.

    What is not ahead is looked for once: the quotes from which no tag end was found, the
    last place of every character, the names without an end tag.  So a page of broken
    markup takes time in proportion to its length.
    """
    low = page.translate(LOWER)
    last = {c: page.rfind(c) for c in ">\"'"}
    dead: set[int] = set()
    unclosed: set[str] = set()
    comment_end = cdata_end = 0  # -1: none ahead

    def tag_end(at: int) -> int:
        """Place of the first > outside quotes; without one the first > of all; -1: none."""
        k, seen = at, []
        while True:
            m = END.search(page, k)
            if m is None or m.start() in dead:
                break
            k = m.start()
            if page[k] == ">":
                return k
            seen.append(k)
            if last[page[k]] == k:
                break
            k = page.find(page[k], k + 1) + 1
        dead.update(seen)
        return page.find(">", at)

    at = 0
    while True:
        i = page.find("<", at)
        if i < 0 or i > last[">"]:
            if i >= 0 and page.startswith("<!--", i):
                yield i, len(page), "", False, ""
            return
        at = i + 1
        if page.startswith("<!", i) or page.startswith("<?", i):
            if page.startswith("<!--", i):
                comment_end = page.find("-->", i + 4) if comment_end >= 0 else -1
                at = comment_end + 3 if comment_end >= 0 else len(page)
            elif low.startswith("<![cdata[", i) and cdata_end >= 0 and (cdata_end := page.find("]]>", i)) >= 0:
                at = cdata_end + 3
            else:
                at = page.find(">", i) + 1
            yield i, at, "", False, ""
            continue
        m = NAME.match(page, i)
        if m is None:
            continue
        closing, name = page[i + 1] == "/", low[m.start(1):m.end(1)]
        end = tag_end(m.end())
        if end < 0:
            continue
        attributes, at = page[m.end():end], end + 1
        if closing or not (name in RAW or name in SKIPPED or name in CONTROLS):
            yield i, at, name, closing, attributes
            continue
        if attributes.endswith("/"):
            yield i, at, "", False, ""
            continue
        stop = None
        if name not in unclosed:
            # a control ends before the next one of its name, so no more than that is searched
            nxt = low.find("<" + name, at) if name in CONTROLS else -1
            stop = re.compile(f"</{name}\\s*>").search(low, at, nxt if nxt >= 0 else len(low))
            if stop is None and nxt < 0:
                unclosed.add(name)
        if stop is not None:
            at = stop.end()
            yield i, at, "", False, ""
        elif name in RAW:
            yield i, len(page), "", False, ""
            return
        else:
            yield i, at, name, False, attributes


def follow(page: str) -> Iterator[tuple[str, str, list, tuple | None, str]]:
    """(text before the tag, tag, elements it closes, element it opens, block after it); the tag is "" for comments and at the end.

    An element is (name, noise kind, place).  Open elements are kept on a stack;
    an end tag closes up to its element and is ignored when no such element is
    open, so unclosed and stray tags do no harm.
    """
    stack: list[tuple[str, str, int]] = []
    article = at = 0
    block = "body"
    open_names: Counter = Counter()
    for start, end, name, closing, attributes in tags(page):
        raw, at = page[at:start], end
        popped, pushed = [], None
        if name and closing:
            if open_names[name]:  # an end tag without its element is not searched for in the stack
                depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                popped = stack[depth:]
                del stack[depth:]
        elif name and name not in VOID and not attributes.endswith("/"):
            kind = noise_kind(name, attributes, bool(article))
            if name not in INLINE or name == "a" or kind:  # formatting is no element of its own
                if name == "p" and stack and stack[-1][0] == "p":
                    popped = [stack.pop()]
                pushed = (name, kind, start)
                stack.append(pushed)
                open_names[name] += 1
                article += name in CONTENT
        for n, _, _ in popped:
            open_names[n] -= 1
            article -= n in CONTENT
        if name and name not in INLINE:
            block = next((group(n) for n, _, _ in reversed(stack) if n != "a"), "body")
        yield raw, name, popped, pushed, block
    yield page[at:], "", [], None, block


def lifted(events: list[tuple]) -> set[int]:
    """Places of the soft noise elements that wrap the article: their mark does not count.

    While no article or main element is free of noise, an element that holds one
    and at least half of the paragraph words is lifted, and so is an element with
    most of the paragraph words, three times those free of noise.  Outer elements
    come first; words in hard noise do not count.
    """
    # of each marked element: hard, place, parent, [paragraph words, other words, article elements] of its own
    marks: list[tuple[bool, int, int, list[int]]] = []
    free, path, link, block = [0, 0, 0], [], 0, "body"
    for raw, _, popped, pushed, after in events:
        own = marks[path[-1]][3] if path else free
        if block == "p":
            own[0] += len(raw.split())
        elif block in ("div", "td", "body", "other") and not link:
            own[1] += len(raw.split())
        for n, kind, _ in popped:
            link -= n == "a"
            if kind:
                path.pop()
        if pushed:
            link += pushed[0] == "a"
            if pushed[1]:
                marks.append((pushed[1] == "hard", pushed[2], path[-1] if path else -1, [0, 0, 0]))
                path.append(len(marks) - 1)
            elif pushed[0] in CONTENT:
                own = marks[path[-1]][3] if path else free
                own[2] += 1
        block = after
    if all(hard for hard, *_ in marks):
        return set()
    inside = [list(own) for *_, own in marks]
    total = list(free)
    for k in range(len(marks) - 1, -1, -1):
        if not marks[k][0]:
            up = inside[marks[k][2]] if marks[k][2] >= 0 else total
            up[:] = [x + y for x, y in zip(up, inside[k])]
    unit = 0 if total[0] else 1
    out: dict[int, int] = {}
    for k, (hard, at, parent, own) in enumerate(marks):
        if hard or free[2] or parent >= 0 and parent not in out:
            continue
        n = inside[k][unit]
        holds = inside[k][2] and 2 * n >= total[unit]
        most = 2 * n > total[unit] and n >= 3 * free[unit] and (unit == 0 or n >= LOOSE_WORDS)
        if holds or most:
            out[k] = at
            free = [x + y for x, y in zip(free, own)]
    return set(out.values())


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(kind, feature, text, in article): kind "text", "break" (block tag) or "tag" (inline tag)."""
    events = list(follow(page))
    free = lifted(events)
    noise = article = link = header = 0
    block = "body"

    def unwanted() -> str:
        return "inner noise" if article else "noise"

    for raw, name, popped, pushed, after in events:
        if raw:
            hidden = noise or header and block != "h"
            feature = unwanted() if hidden else "link" if link and block in ("li", "div", "td", "body", "other") else block
            yield "text", feature, html.unescape(raw), bool(article) and not hidden
        if not name:
            continue
        for sign, (n, kind, place) in [(-1, e) for e in popped] + ([(1, pushed)] if pushed else []):
            noise += sign * (kind != "" and place not in free)
            article += sign * (n in CONTENT)
            link += sign * (n == "a")
            header += sign * (n == "header")
        block = after
        if name in INLINE:
            yield "tag", name, "", bool(article) and not noise
        else:
            yield "break", unwanted() if noise else name, "", bool(article) and not noise


def count_labels(page: str) -> Counter:
    """(kind, feature, in article) counts of a page that has an article element."""
    out: Counter = Counter()
    for kind, feature, text, inside in tokens(page):
        if kind == "text":
            out["word", "noise" if "noise" in feature else feature, inside] += len(text.split())
        else:
            out["tag", feature if feature in INLINE or feature in PRIOR else "noise" if "noise" in feature else "other", inside] += 1
    return out


def weights(counts: dict) -> dict[tuple[str, str], float]:
    """Log-odds: words positive unless their place is rather outside, tags always negative."""
    out = {}
    for kind in ("word", "tag"):
        for f in {f for k, f, _ in counts if k == kind} | set(PRIOR):
            a, b = PRIOR.get(f, PRIOR["other"])
            w = math.log((counts.get((kind, f, True), 0) + a) / (counts.get((kind, f, False), 0) + b))
            out[kind, f] = max(-4.0, min(4.0, w)) if kind == "word" else min(-0.05, max(-4.0, w / 4 - 0.05))
    out["word", "noise"] = min(out["word", "noise"], -1.0)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the highest sum (the first, longest one); (0, 0) if none is positive."""
    best = total = 0.0
    lo = hi = begin = 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, k
        total += s
        if total > best or total == best and begin == lo and best > 0:
            best, lo, hi = total, begin, k + 1
    return lo, hi


def main_text(page: str, w: dict[tuple[str, str], float]) -> str:
    """Text of the best region without what stands inside noise elements."""
    pieces, scores, noise = [], [], 0.0
    for kind, feature, text, _ in tokens(page):
        if feature == "inner noise":  # stands in an article element and is left out at no cost
            scores.append(0.0)
            pieces.append(" " if kind == "break" else "")
        elif feature == "noise":  # a run of noise costs a bounded sum
            cost = w["word", "noise"] * len(text.split()) if kind == "text" else w["tag", "noise"]
            scores.append(max(cost, NOISE_COST - noise))
            noise += scores[-1]
            pieces.append(" " if kind == "break" else "")
        elif kind == "text":
            n = len(text.split())
            scores.append(w.get(("word", feature), w["word", "other"]) * n)
            noise = 0.0 if n else noise
            pieces.append(text)
        else:
            scores.append(w.get(("tag", feature), w["tag", "other"]))
            pieces.append(" " if kind == "break" else "")
    lo, hi = best_region(scores)
    return " ".join("".join(pieces[lo:hi]).split())


def learn(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[tuple[str, str], float]:
    """Weights from pages that hold exactly one article element (at most about ``max_labelled``, chosen by a hash).

    Null html takes no part, repeated rows count each; without any such page (an empty
    table as well) the weights are those of the prior counts.
    """
    labelled = pages.where(F.regexp_count("html", F.lit("(?i)<article[\\s>]")) == 1)
    n = labelled.count()
    draw = F.pmod(F.xxhash64("page_id", "html", F.lit(6)), F.lit(1 << 30))  # by the page as well: ids may be missing
    chosen = labelled.where(draw < int(min(1.0, max_labelled / max(1, n)) * (1 << 30))).select("html")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            total: Counter = Counter()
            for page in pdf["html"]:
                total.update(count_labels(page))
            yield pd.DataFrame([(*k, v) for k, v in total.items()], columns=["kind", "feature", "inside", "n"])

    counted = chosen.mapInPandas(run, "kind string, feature string, inside boolean, n long")
    # features are a fixed set of names: few rows whatever the pages hold
    rows = counted.groupBy("kind", "feature", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r.kind, r.feature, r.inside): r.n for r in rows})


def extract(pages: DataFrame, w: dict[tuple[str, str], float]) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Null or empty html and pages without content have the empty text; repeated rows are
    rows of their own; an empty table gives an empty result; other columns are not read.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 500):
            texts = [main_text(p or "", w) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id").cast(pa.int64()), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
