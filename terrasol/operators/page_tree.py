"""Pages as trees in a table: every element an interval, so a subtree is one range condition.

Each page is parsed once (standard-library ``html.parser`` inside ``mapInArrow``).
Elements and text nodes share one pre-order numbering from 1: an element spans
``pos .. last``, and whatever stands inside it, however deep, has a number in that
range.  :func:`inside` evaluates the range as an equi join over dyadic blocks, so a
long page with many containers is not compared pair by pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.operators.joins import by_shuffle

SCHEMA = ("page_id long, url string, pos int, last int, tag string, parent int, id string, css array<string>, href string, title string, "
          "datetime string, pieces array<struct<at:int,text:string>>")
#: Elements without content, and elements whose text is not shown.
VOID_TAGS = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
HIDDEN_TAGS = ("script", "style", "template")
#: Tag of the row that reports a page the parser gave up on.
ERROR_TAG = "#error"
_ARROW = {"page_id": pa.int64(), "url": pa.string(), "pos": pa.int32(), "last": pa.int32(), "tag": pa.string(), "parent": pa.int32(),
          "id": pa.string(), "css": pa.list_(pa.string()), "href": pa.string(), "title": pa.string(), "datetime": pa.string(),
          "pieces": pa.list_(pa.struct([("at", pa.int32()), ("text", pa.string())]))}


class _Tree(HTMLParser):
    """Elements of one page as rows ``[pos, last, tag, parent, attributes, pieces]``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.open, self.at, self.depth_of = [], [], 0, {}

    def _next(self) -> int:
        self.at += 1
        return self.at

    def handle_starttag(self, tag, attrs):
        parent = self.open[-1][0] if self.open else None
        row = [self._next(), None, tag, parent, dict(attrs), []]
        row[1] = row[0]
        self.rows.append(row)
        if tag not in VOID_TAGS:
            self.open.append(row)
            self.depth_of[tag] = self.depth_of.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.depth_of.get(tag):
            return  # an end tag without its element closes nothing
        while True:
            row = self.open.pop()
            row[1] = self.at
            self.depth_of[row[2]] -= 1
            if row[2] == tag:
                return

    def handle_data(self, data):
        if self.open:
            self.open[-1][5].append((self._next(), re.sub(r"\s+", " ", data)))

    def end(self):
        for row in self.open:
            row[1] = self.at


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 200):
            part = b.slice(i, 200)
            out = []
            for page, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                tree = _Tree()
                try:
                    tree.feed(html or "")
                    tree.close()
                except (AssertionError, ValueError) as e:  # malformed page: keep what was parsed and say so
                    out.append((page, url, 0, 0, ERROR_TAG, None, None, None, None, str(e), None, []))
                tree.end()
                for pos, last, tag, parent, attrs, pieces in tree.rows:
                    css = (attrs.get("class") or "").split()
                    out.append((page, url, pos, last, tag, parent, attrs.get("id"), css, attrs.get("href"), attrs.get("title"), attrs.get("datetime"),
                                [{"at": a, "text": t} for a, t in pieces]))
            cols = list(zip(*out)) or [[]] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.values())], names=list(_ARROW))


def page_tree(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) → one row per element.

    ``pieces`` are the element's own text nodes with their numbers, white space folded.
    A null or empty page has no rows; a page the parser gives up on has a row ``#error``
    besides what was parsed; repeated page ids must be told apart by the caller.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_parse, SCHEMA)


def bad_pages(tree: DataFrame) -> DataFrame:
    """Pages that could not be parsed to their end, with the reason."""
    return tree.where(F.col("tag") == ERROR_TAG).select("page_id", "url", F.col("title").alias("error"))


def covering(lo, hi) -> Column:
    """The fewest dyadic blocks ``(level, block)`` that make up lo .. hi (at most two a level)."""
    return F.expr(f"""aggregate(sequence(0, 30),
        named_struct('lo', {lo}, 'hi', {hi}, 'b', CAST(array() AS array<struct<level:int,block:int>>)),
        (acc, k) -> CASE WHEN acc.lo > acc.hi THEN acc ELSE named_struct(
            'lo', shiftright(acc.lo + (acc.lo & 1), 1),
            'hi', shiftright(acc.hi - (1 - (acc.hi & 1)), 1),
            'b', concat(acc.b, CASE WHEN acc.lo & 1 = 1 THEN array(named_struct('level', k, 'block', acc.lo)) ELSE array() END,
                        CASE WHEN acc.hi & 1 = 0 THEN array(named_struct('level', k, 'block', acc.hi)) ELSE array() END)) END,
        acc -> acc.b)""")


def inside(containers: DataFrame, members: DataFrame, at: str = "pos") -> DataFrame:
    """``page_id, c, m``: every member whose number ``at`` lies in a container's ``pos .. last`` of its page.

    A container's own row lies inside it.  A member is met in one block per level, a
    container in at most two, and each pair in exactly one.
    """
    c = containers.select("page_id", F.struct("*").alias("c"), F.inline(covering("pos", "last")))
    levels = F.expr(f"transform(sequence(0, CAST(floor(log2({at})) AS INT)), k -> named_struct('level', k, 'block', shiftright({at}, k)))")
    m = members.where(F.col(at) > 0).select("page_id", F.struct("*").alias("m"), F.inline(levels))
    return c.join(by_shuffle(m), ["page_id", "level", "block"]).select("page_id", "c", "m")


def subtree_text(tree: DataFrame, containers: DataFrame, sep: str = " ", strip: bool = True, name: str = "text") -> DataFrame:
    """``page_id, pos, <name>``: all shown text of each container in page order.

    ``strip`` trims every text node and leaves out blank ones before joining with
    ``sep``; otherwise the nodes are joined as they stand and the whole is trimmed.
    """
    spans = containers.select("page_id", "pos", "last").distinct()
    texts = tree.where(~F.col("tag").isin(*HIDDEN_TAGS) & (F.size("pieces") > 0)).select("page_id", "pos", "pieces")
    got = inside(spans, texts).groupBy("page_id", F.col("c.pos").alias("pos")).agg(F.array_sort(F.flatten(F.collect_list("m.pieces"))).alias("_p"))
    parts = F.transform("_p", lambda p: F.trim(p["text"]) if strip else p["text"])
    text = F.array_join(F.filter(parts, lambda t: t != "") if strip else parts, sep)
    got = got.select("page_id", "pos", F.trim(F.regexp_replace(text, " +", " ")).alias(name))
    return spans.select("page_id", "pos").join(by_shuffle(got), ["page_id", "pos"], "left").select("page_id", "pos", F.coalesce(name, F.lit("")).alias(name))


def first_inside(containers: DataFrame, members: DataFrame, name: str, last: bool = False) -> DataFrame:
    """``page_id, pos, <name>``: the first (or last) member strictly inside each container, as a struct; containers without one are left out."""
    found = inside(containers.select("page_id", "pos", "last").distinct(), members).where("m.pos > c.pos")
    pick = F.max_by if last else F.min_by
    return found.groupBy("page_id", F.col("c.pos").alias("pos")).agg(pick("m", "m.pos").alias(name))


def has_class(*names: str) -> Column:
    """Whether an element's class list holds all names."""
    out = F.lit(True)
    for n in names:
        out = out & F.array_contains(F.coalesce("css", F.array().cast("array<string>")), n)
    return out


def spans_of(found: DataFrame, name: str) -> DataFrame:
    """The elements of a struct column as containers."""
    return found.select("page_id", F.col(f"{name}.pos").alias("pos"), F.col(f"{name}.last").alias("last"))


def with_text(tree: DataFrame, found: DataFrame, name: str, text: str, **how) -> DataFrame:
    """Rows with the text of the element in struct column ``name`` as column ``text`` (null without one)."""
    texts = subtree_text(tree, spans_of(found, name).where("pos is not null"), name=text, **how)
    texts = texts.select(F.col("page_id").alias("_page"), F.col("pos").alias("_pos"), text)
    return found.join(by_shuffle(texts), (F.col("page_id") == F.col("_page")) & (F.col(f"{name}.pos") == F.col("_pos")), "left").drop("_page", "_pos")


def contents(tree: DataFrame, containers: DataFrame) -> DataFrame:
    """``page_id, pos, at, text, child``: the direct children of each container in order, text nodes and elements.

    ``text`` is null for an element, ``child`` its span; null for a text node.
    """
    spans = containers.select("page_id", "pos").distinct()
    own = tree.join(by_shuffle(spans), ["page_id", "pos"], "left_semi").select("page_id", "pos", F.inline("pieces"), F.lit(None).cast("struct<pos:int,last:int>").alias("child"))
    kids = tree.select("page_id", F.col("parent"), F.struct("pos", "last").alias("child")).join(
        by_shuffle(spans.withColumnRenamed("pos", "parent")), ["page_id", "parent"], "left_semi")
    return own.unionByName(kids.select("page_id", F.col("parent").alias("pos"), F.col("child.pos").alias("at"), F.lit(None).cast("string").alias("text"), "child"))
