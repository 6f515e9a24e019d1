"""Harvest rules over already-fetched pages.

Crawling is not built: pages arrive as a ``pages(page_id, url, html)`` table.
URL resolution, file names, dates and relevance tests are Column expressions;
link extraction from HTML is a regex-level ``regexp_extract_all`` (anchors are
flat markup), structural layouts use :mod:`terrasol.operators.html_blocks`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrasol.functions.common import col, nullif_empty, strip
from terrasol.functions.text import fold_keywords

SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
# href in double quotes, in single quotes or bare (groups 1 to 3), then the anchor's content (group 4)
ANCHOR = (r"(?is)<a[ \t\n\r\f](?:[^>]*?[ \t\n\r\f])?href[ \t\n\r\f]*=[ \t\n\r\f]*"
          r"(?:\"([^\"]*)\"|'([^']*)'|([^ \t\n\r\f\"'>]+))[^>]*>(.*?)</a>")

# Relevance keywords of the harvesters.
KEYWORDS_FOLDED = ("voltaique", "solaire")
KEYWORDS_REGEX = r"(?iu)volta[iï]que|solaire"
KEYWORDS_PLAIN = ("solaire", "voltaïque", "voltaique")
# French month names (for ``d MMMM yyyy`` dates).
FRENCH_MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
                 "septembre", "octobre", "novembre", "décembre")
# Characters replaced in file names, maximum length.
UNSAFE_FILENAME_CHARS = r"[\\/*?:\"<>|]"
MAX_FILENAME = 150


def remove_dot_segments(path) -> Column:
    """A path without ``.`` and ``..`` segments (``..`` at the root is dropped; a last dot segment leaves a slash)."""
    p = col(path)
    parts = F.split(p, "/")
    start = F.array().cast("array<string>")
    step = lambda acc, x: (F.when(x == ".", acc)
                           .when((x == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
                           .when(x == "..", acc).otherwise(F.concat(acc, F.array(x))))
    kept = F.aggregate(parts, start, step)
    last = F.element_at(parts, -1)
    clean = F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")))
    return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), clean).otherwise(p)


def resolve_url(base, href) -> Column:
    """``urljoin(base, href)`` for absolute, scheme-relative, root-relative,
    fragment, query and path-relative references, dot segments removed (H9)."""
    b, h = col(base), F.replace(col(href), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(b, SCHEME, 1)
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(b, AUTHORITY, 1))
    path = F.regexp_extract(b, PATH, 1)
    no_frag = F.regexp_extract(b, r"^([^#]*)", 1)
    target_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    suffix = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    directory = F.coalesce(nullif_empty(F.regexp_extract(path, r"^(.*/)", 1)), F.lit("/"))
    return (F.when(h.rlike(SCHEME), h)
             .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
             .when(h.startswith("/"), F.concat(origin, remove_dot_segments(target_path), suffix))
             .when(h == "", no_frag)
             .when(h.startswith("#"), F.concat(no_frag, h))
             .when(h.startswith("?"), F.concat(origin, path, h))
             .otherwise(F.concat(origin, remove_dot_segments(F.concat(directory, target_path)), suffix)))


def file_name(url, keep_query: bool = True) -> Column:
    """Last path segment; ``keep_query`` mirrors ``url.split('/')[-1]``."""
    u = col(url)
    if keep_query:
        return F.regexp_extract(u, r"([^/]*)$", 1)
    return F.regexp_extract(F.regexp_extract(u, r"^([^?#]*)", 1), r"([^/]*)$", 1)


def sanitize_filename(name) -> Column:
    """Unsafe characters → ``_``, strip dots/blanks, at most 150 characters."""
    t = F.regexp_replace(col(name), UNSAFE_FILENAME_CHARS, "_")
    t = F.regexp_replace(t, r"^[. ]+|[. ]+$", "")
    return F.substring(t, 1, MAX_FILENAME)


def first_year(c) -> Column:
    """First 4-digit group as a string, or null."""
    return nullif_empty(F.regexp_extract(col(c), r"([0-9]{4})", 1))


def parse_french_date(c) -> Column:
    """``1er janvier 2012`` / ``5 mars 2014`` → date; unparsable → null."""
    t = F.lower(strip(c))
    t = F.regexp_replace(t, r"^1er\b", "1")
    for i, m in enumerate(FRENCH_MONTHS, start=1):
        t = F.regexp_replace(t, rf"\b{m}\b", str(i))
    return F.try_to_date(t, "d M yyyy")


def parse_date(c, fmt: str) -> Column:
    """``dd/MM/yyyy``, ISO (``yyyy-MM-dd``) or any pattern; null when unparsable."""
    return F.try_to_date(col(c), fmt)


def relevant_folded(c) -> Column:
    """lower + ``ï``→``i``, contains ``voltaique`` or ``solaire``."""
    t = fold_keywords(c)
    out = F.lit(False)
    for k in KEYWORDS_FOLDED:
        out = out | t.contains(k)
    return out


def relevant_regex(c) -> Column:
    """``volta[iï]que|solaire`` ignoring case."""
    return col(c).rlike(KEYWORDS_REGEX)


def relevant_plain(c) -> Column:
    """any of ``solaire``, ``voltaïque``, ``voltaique`` in lower(strip)."""
    t = F.lower(strip(c))
    out = F.lit(False)
    for k in KEYWORDS_PLAIN:
        out = out | t.contains(k)
    return out


def is_opinion_title(c) -> Column:
    """``Avis`` case-sensitive."""
    return col(c).contains("Avis")


def is_opinion_or_case(c) -> Column:
    """lower contains ``cas par cas`` or ``avis``."""
    t = F.lower(col(c))
    return t.contains("cas par cas") | t.contains("avis")


def is_download_link(href, prefix: str) -> Column:
    """href starts with ``prefix`` and does not contain ``DIFF``."""
    h = col(href)
    return h.startswith(prefix) & ~h.contains("DIFF")


def year_in_range(c, lo: int = 2010, hi: int = 2017) -> Column:
    """digit-only text whose value is within [lo, hi]."""
    t = col(c)
    return t.rlike(r"^[0-9]+$") & t.try_cast("int").between(lo, hi)


def is_pdf(url) -> Column:
    """``.pdf`` suffix, case-insensitive."""
    return F.lower(col(url)).endswith(".pdf")


# Listing entries that are index pages, not documents.
INDEX_PAGE_TITLES = ("Avis publiés",)


def keep_document_links(df, title: str = "title", href: str = "href", exclude=INDEX_PAGE_TITLES):
    """Drop the index-page entry and links without href."""
    return df.where(F.col(href).isNotNull() & ~F.coalesce(F.col(title).isin(*exclude), F.lit(False)))
