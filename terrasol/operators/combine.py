"""Combined project table.

metadata ⟕ year_links (year_url) ⟕ measures (pdf_name) → title fields →
one row per commune (empty list keeps one null row) → gazetteer ⟕ on
(commune, département) with null = null → title values override body values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasol.functions.common import strip
from terrasol.functions.title import gazetteer_dept, with_parsed_title
from terrasol.operators.joins import null_safe_left_join

# The columns of the output, in order.
COMBINED_COLUMNS = ["pdf_name", "year", "region", "project_type", "nom_commune", "dept",
                    "land_surface_ha", "power_mwc", "longitude", "latitude"]


def prepare_gazetteer(communes: DataFrame) -> DataFrame:
    """Gazetteer key: stripped name, ``zfill(2)`` département code."""
    return communes.select(strip("nom_commune").alias("_g_nom"),
                           gazetteer_dept("code_departement").alias("_g_dept"),
                           "longitude", "latitude")


def combine_projects(metadata: DataFrame, year_links: DataFrame, measures: DataFrame,
                     communes: DataFrame, full: bool = False) -> DataFrame:
    # the year index may itself be derived (a distinct over the harvest): no count
    # action here, AQE turns the join into a broadcast at run time when it is small
    years = year_links.select("year_url", "region", "year")
    merged = (metadata.join(years, "year_url", "left")
                      .join(measures.select("pdf_name", "land_surface_ha", "power_mwc"), "pdf_name", "left"))
    parsed = with_parsed_title(merged, "title", "_t")
    exploded = (parsed
                .select("*", F.explode_outer("_t.communes").alias("_commune"))
                .select("*",
                        F.col("_t.project_type").alias("project_type"),
                        strip("_commune").alias("nom_commune"),
                        F.col("_t.dept").alias("dept"),
                        F.col("_t.land_surface_ha_title").alias("land_surface_ha_title"),
                        F.col("_t.power_mwc_title").alias("power_mwc_title"))
                .drop("_t", "_commune"))
    # no hint: statistics and AQE broadcast the gazetteer when its bytes allow it
    gaz = prepare_gazetteer(communes)
    joined = null_safe_left_join(exploded, gaz, [("nom_commune", "_g_nom"), ("dept", "_g_dept")])
    out = (joined.drop("_g_nom", "_g_dept")
                 .withColumn("power_mwc", F.coalesce("power_mwc_title", "power_mwc"))
                 .withColumn("land_surface_ha", F.coalesce("land_surface_ha_title", "land_surface_ha")))
    return out if full else out.select(*COMBINED_COLUMNS)
