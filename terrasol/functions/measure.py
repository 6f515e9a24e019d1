"""Surface (ha) and power (MWc) measured in document text.

All matches of ``number + unit`` are collected with one ``regexp_extract_all``
per unit and reduced with ``array_max``: pure Column code, whole-stage codegen,
no Python per row.  ``mode="compat"`` keeps the original number grammar
(thousands groups, no unit boundary, 0 treated as missing); ``mode="strict"``
adds a unit word boundary and accepts long digit runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.functions.common import DIGIT, WORD, WS, col, nullif_zero, parse_decimal_comma, strip, strip_chars

# Number grammar and unit spellings of the measured documents.
NUMBER = rf"({DIGIT}{{1,3}}(?:{WS}{DIGIT}{{3}})*(?:[.,]{DIGIT}+)?)"
NUMBER_STRICT = rf"({DIGIT}+(?:{WS}{DIGIT}{{3}})*(?:[.,]{DIGIT}+)?)"
UNITS = {
    "ha": r"(?:ha|hectares?)",
    "m2": r"(?:m2|m²)",
    "mwc": r"(?:MWc|megawatt-crête|Méga Watt crête)",
    "kwc": r"(?:KWc|kilowatt-crête)",
    "wc": r"(?:Wc)",
}
SECTION_KEYWORDS = ("présentation", "contexte", "presentation")


def unit_pattern(unit: str, mode: str = "compat") -> str:
    num = NUMBER if mode == "compat" else NUMBER_STRICT
    tail = "" if mode == "compat" else rf"(?!{WORD})"
    return rf"(?iu){num}{WS}*{UNITS[unit]}{tail}"


def max_unit(text, unit: str, mode: str = "compat") -> Column:
    """Largest number written before ``unit`` in ``text`` (null when none)."""
    found = F.regexp_extract_all(col(text), F.lit(unit_pattern(unit, mode)), 1)
    return F.array_max(F.transform(found, parse_decimal_comma))


def max_surface_ha(text, mode: str = "compat") -> Column:
    """Hectares, else m² / 10000; a 0 result counts as missing."""
    return F.coalesce(nullif_zero(max_unit(text, "ha", mode)),
                      nullif_zero(max_unit(text, "m2", mode) / 10000))


def max_power_mwc(text, mode: str = "compat") -> Column:
    """MWc, else kWc / 1000, else Wc / 1e6; a 0 result counts as missing."""
    return F.coalesce(nullif_zero(max_unit(text, "mwc", mode)),
                      nullif_zero(max_unit(text, "kwc", mode) / 1000),
                      nullif_zero(max_unit(text, "wc", mode) / 1000000))


def context_section(text) -> Column:
    """Markdown section introducing the project (X8), stripped, or null.

    The text is cut before every line-initial ``#``; each piece is a heading
    with its level (count of ``#``), root number and lower-cased title.  The
    section starts at the first heading mentioning a keyword and ends at the
    first later heading that is shallower, or of the same level with a
    different root number (two missing roots compare equal).
    """
    pieces = F.split(col(text), r"(?dm)(?=^#)")
    heads = _headings(pieces)
    start = _start(heads)
    return _section(pieces, heads, start)


def with_context_section(df: DataFrame, text_col: str, out: str = "_section") -> DataFrame:
    """DataFrame form of :func:`context_section` with staged intermediates."""
    return (df.withColumn("_pieces", F.split(F.col(text_col), r"(?dm)(?=^#)"))
              .withColumn("_heads", _headings(F.col("_pieces")))
              .withColumn("_start", _start(F.col("_heads")))
              .withColumn(out, _section(F.col("_pieces"), F.col("_heads"), F.col("_start")))
              .drop("_pieces", "_heads", "_start"))


def _start(heads: Column) -> Column:
    return F.get(F.filter(heads, lambda h: h["is_heading"] & h["hit"]), 0)


def _headings(pieces: Column) -> Column:

    def describe(p, i):
        title = F.regexp_extract(p, rf"(?d)^#+{WS}*(.*)", 1)
        clean = strip_chars(title, r"*_ ")
        low = F.lower(clean)
        hit = F.lit(False)
        for kw in SECTION_KEYWORDS:
            hit = hit | low.contains(kw)
        return F.struct(
            i.alias("idx"),
            p.startswith("#").alias("is_heading"),
            F.length(F.regexp_extract(p, r"^(#+)", 1)).alias("level"),
            F.nullif(F.regexp_extract(clean, rf"^({DIGIT}+)", 1), F.lit("")).alias("root"),
            hit.alias("hit"),
        )

    return F.transform(pieces, describe)


def _section(pieces: Column, heads: Column, start: Column) -> Column:
    end = F.coalesce(
        F.get(F.filter(heads, lambda h: h["is_heading"] & (h["idx"] > start["idx"]) & (
            (h["level"] < start["level"])
            | ((h["level"] == start["level"]) & ~h["root"].eqNullSafe(start["root"])))), 0)["idx"],
        F.size(pieces))
    section = F.array_join(F.slice(pieces, start["idx"] + 1, end - start["idx"]), "")
    return F.when(start.isNotNull(), strip(section))


def document_measures(df: DataFrame, text_col: str = "pdf_text", mode: str = "compat") -> DataFrame:
    """Add ``land_surface_ha`` and ``power_mwc`` (X9): section first, whole text when
    the section is missing or yields no (non-zero) value.

    Intermediate results are staged as columns so every regex runs once per row
    (Catalyst does not collapse projections that would duplicate them)."""
    staged = with_context_section(df, text_col, "_section")
    units = ("ha", "m2", "mwc", "kwc", "wc")
    for src in ("_section", text_col):
        for u in units:
            staged = staged.withColumn(f"_{u}_{src}", max_unit(src, u, mode))

    def nz(c):
        return F.nullif(F.col(c), F.lit(0))

    def surface(src):
        return F.coalesce(nz(f"_ha_{src}"), F.nullif(F.col(f"_m2_{src}") / 10000, F.lit(0)))

    def power(src):
        return F.coalesce(nz(f"_mwc_{src}"), F.nullif(F.col(f"_kwc_{src}") / 1000, F.lit(0)),
                          F.nullif(F.col(f"_wc_{src}") / 1000000, F.lit(0)))

    out = staged.select("*", F.coalesce(surface("_section"), surface(text_col)).alias("land_surface_ha"),
                        F.coalesce(power("_section"), power(text_col)).alias("power_mwc"))
    return out.drop("_section", *[f"_{u}_{src}" for src in ("_section", text_col) for u in units])
