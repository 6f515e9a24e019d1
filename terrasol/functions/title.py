"""Project-title parsing and administrative codes.

A title such as ``Projet photovoltaïque de 12,5 MWc sur la commune de Lussac (33)``
yields (project_type, communes[], dept, land_surface_ha_title, power_mwc_title).
Everything is Column code; the commune list is built with array higher-order
functions so a title never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.functions.common import DIGIT, WORD, WS, col, nullif_empty, strip

# Locative keywords that precede the commune names.
LOCATIVE_KEYWORDS = (
    r"sur les communes de",
    r"sur la commune d[’']",
    r"sur la commune de",
    r"commune de",
    r"commune d[’']",
    r" à ",
    r" d[’']",
    r" aux ",
    r" de ",
)
# Separators between commune names, quote marks, leading articles.
COMMUNE_SEPARATORS = r" et | & |,"
QUOTE_MARKS = r"[«»\"“”]"
LEADING_ARTICLE = r"(?iu)^(de |d'|d’|le |la |les )"
DEPT_TAIL = r"\(?([0-9][0-9ABO]|[0-9]{3})\)?$"

# Patterns of the project type, the power and the surface in a title.
TYPE_PATTERN = rf"(?iu){WORD}*voltaï?que{WORD}*"
TITLE_MWC = rf"(?iu)({DIGIT}+(?:[.,]{DIGIT}+)?){WS}*MWc?"
TITLE_HA = rf"(?iu)({DIGIT}+(?:[.,]{DIGIT}+)?){WS}*(?:ha|hectares?)"


def normalise_title(c) -> Column:
    """strip, drop trailing dots, drop ``"``, ``« `` and `` »``."""
    t = F.regexp_replace(strip(c), r"\.+\z", "")
    for s in ('"', "« ", " »"):
        t = F.replace(t, F.lit(s), F.lit(""))
    return t


def _last_keyword_end(text: Column) -> Column:
    """End offset of the right-most keyword occurrence (0 when none)."""
    ends = [F.length(F.regexp_extract(text, rf"(?isu)^(.*{kw})", 1)) for kw in LOCATIVE_KEYWORDS]
    return F.greatest(*ends)


def commune_names(before: Column) -> Column:
    """Commune list from the part of the title before the département."""
    last = _last_keyword_end(before)
    raw = strip(F.substring(before, last + 1, 1 << 30))
    parts = F.split(raw, COMMUNE_SEPARATORS)
    cleaned = F.transform(
        parts, lambda p: F.regexp_replace(strip(F.regexp_replace(p, QUOTE_MARKS, "")), LEADING_ARTICLE, ""))
    kept = F.filter(cleaned, lambda p: p.rlike(r"\p{Lu}"))
    return F.when(last > 0, kept).otherwise(F.array().cast("array<string>"))


def parse_title(c) -> Column:
    """Struct of the five title fields (X16); numbers are doubles (deliberate fix)."""
    raw = col(c)
    t = normalise_title(raw)
    split_re = rf"(?sd)^(.*?){DEPT_TAIL}"
    has_dept = t.rlike(rf"(?d){DEPT_TAIL}")
    before = strip(F.regexp_extract(t, split_re, 1))
    dept = F.translate(F.regexp_extract(t, split_re, 2), "O", "0")
    return _title_struct(raw, has_dept, before, dept)


def _title_struct(raw: Column, has_dept: Column, before: Column, dept: Column) -> Column:
    project_type = nullif_empty(F.regexp_extract(raw, TYPE_PATTERN, 0))
    mwc = nullif_empty(F.regexp_extract(raw, TITLE_MWC, 1))
    ha = nullif_empty(F.regexp_extract(raw, TITLE_HA, 1))
    return F.struct(
        project_type.alias("project_type"),
        F.when(has_dept, commune_names(before)).otherwise(F.array().cast("array<string>")).alias("communes"),
        F.when(has_dept, dept).alias("dept"),
        F.replace(ha, F.lit(","), F.lit(".")).try_cast("double").alias("land_surface_ha_title"),
        F.replace(mwc, F.lit(","), F.lit(".")).try_cast("double").alias("power_mwc_title"),
    )


def with_parsed_title(df: DataFrame, title_col: str, out: str = "_t") -> DataFrame:
    """DataFrame form of :func:`parse_title` with staged intermediates, so the
    normalised title and the text before the département are computed once."""
    split_re = rf"(?sd)^(.*?){DEPT_TAIL}"
    staged = (df.withColumn("_raw", F.col(title_col))
                .withColumn("_norm", normalise_title(F.col("_raw")))
                .withColumn("_has_dept", F.col("_norm").rlike(rf"(?d){DEPT_TAIL}"))
                .withColumn("_before", strip(F.regexp_extract(F.col("_norm"), split_re, 1)))
                .withColumn("_dept", F.translate(F.regexp_extract(F.col("_norm"), split_re, 2), "O", "0"))
                .withColumn("_last", _last_keyword_end(F.col("_before"))))
    return (staged.withColumn(out, _title_struct(F.col("_raw"), F.col("_has_dept"), F.col("_before"), F.col("_dept")))
                  .drop("_raw", "_norm", "_has_dept", "_before", "_dept", "_last"))


def gazetteer_dept(code) -> Column:
    """``str(code).zfill(2)``: left-pad to two characters, never truncate."""
    c = col(code).cast("string")
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def clean_departement_code(raw) -> Column:
    """Normalise a raw département code to 2-3 characters."""
    r = col(raw)
    n = F.length(r)
    as_int = r.try_cast("long")
    five = (F.when(r.contains("A") | r.contains("B"), F.substring(r, 1, 2))
             .when(as_int.isNull(), F.lit(None))
             .when(as_int > 97000, F.substring(r, 1, 3))
             .otherwise(F.substring(r, 1, 2)))
    return F.when((n == 2) | (n == 3), r).when(n == 5, five)


# Commune-and-code pattern of document titles.
COMMUNE_CODE = (r"((?:à|communes? d(?:e|'|’)) *([A-Za-zà-üÀ-Ü\-,’' ]+))? +"
                r"(?:\(?([0-9AB]{2,5})\)?)")


def departement_code_and_commune(s) -> Column:
    """First match of the commune/code pattern (X19): struct(departement_code, commune_name)."""
    c = col(s)
    matched = c.rlike(COMMUNE_CODE)
    commune = nullif_empty(strip(F.regexp_extract(c, COMMUNE_CODE, 2)))
    code = strip(F.regexp_extract(c, COMMUNE_CODE, 3))
    return F.struct(F.when(matched, clean_departement_code(code)).alias("departement_code"),
                    F.when(matched, commune).alias("commune_name"))


# Label of a land-cover download link.
DOWNLOAD_LABEL = r"^Département ([0-9A-Z]{2,3}) ?- ?(.+) ?- ?([0-9]{4})"


def parse_download_label(s) -> Column:
    """(code, name, year) of a download link label, null struct when it does not match."""
    c = col(s)
    ok = c.rlike(DOWNLOAD_LABEL)
    return F.when(ok, F.struct(
        F.regexp_extract(c, DOWNLOAD_LABEL, 1).alias("code"),
        strip(F.regexp_extract(c, DOWNLOAD_LABEL, 2)).alias("name"),
        F.regexp_extract(c, DOWNLOAD_LABEL, 3).alias("year")))
