"""Park-table operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasol.functions.common import col

# Territory code prefixes and the projected CRS used there.
TERRITORY_CRS = (
    (("971", "972"), 5490),
    (("973",), 2972),
    (("974",), 2975),
    (("976",), 4471),
)
DEFAULT_CRS = 2154


def split_list(c, sep: str = ", ") -> Column:
    """Delimited string → array."""
    return F.split(col(c), sep)


def any_startswith(arr, prefixes) -> Column:
    """Any element starting with any prefix (P5)."""
    return F.exists(col(arr), lambda s: reduce(lambda a, b: a | b, [s.startswith(p) for p in prefixes]))


def territory_crs(insee_com) -> Column:
    """First matching territory wins, metropolitan Lambert-93 otherwise.
    ``startswith`` replaces the original partial-match regex so 29720 is metropolitan."""
    expr = None
    for prefixes, srid in TERRITORY_CRS:
        cond = any_startswith(insee_com, prefixes)
        expr = F.when(cond, F.lit(srid)) if expr is None else expr.when(cond, F.lit(srid))
    return expr.otherwise(F.lit(DEFAULT_CRS))


def count_by_first_commune(parks: DataFrame, communes: DataFrame, com_col: str = "COM") -> DataFrame:
    """Left join on the first array element, distinct parks per commune (null group kept), desc."""
    c = communes.select(F.col(com_col).alias("COM")).distinct()
    j = parks.join(c, F.get(F.col("insee_com"), 0) == F.col("COM"), "left")
    return (j.groupBy("COM").agg(F.countDistinct("id").alias("num_installations"))
             .orderBy(F.col("num_installations").desc()))


def count_by(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Group count, optionally after an equality filter."""
    d = df.where(where) if where is not None else df
    return d.groupBy(key).agg(F.count("*").alias("len"))


def typed_projection(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The named columns in the given order and types; text that does not fit its type becomes null."""
    return df.select(*(F.expr(f"try_cast(trim(cast(`{c}` AS string)) AS {kind})").alias(c) for c, kind in schema.items()))


def decimal_total(df: DataFrame, c: str, precision: int = 18, scale: int = 3) -> DataFrame:
    """Typed projection to DECIMAL(p,s) then a global sum."""
    x = F.col(c).cast(f"decimal({precision},{scale})")
    return df.agg(F.sum(x).cast(f"decimal(38,{scale})").alias(f"sum_{c}"), F.count(x).alias("n"))
