"""Land-cover crossing of park polygons.

``link`` = parks ⟕ covers on intersection with three areas; the analysis
operators below mirror the notebook steps on that link table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasol.functions import geo
from terrasol.operators.spatial import spatial_left_join

# Land-use codes and their labels.
CODES_US_MAPPING = {
    "US1.1": "Agriculture",
    "US1.2": "Sylviculture",
    "US1.3": "Activités d’extraction",
    "US1.4": "Pêche et aquaculture",
    "US1.5": "Autres productions primaires",
    "US2": "Production secondaire",
    "US235": "Usage mixte ",
    "US3": "Production tertiaire",
    "US4.1.1": "Réseaux routiers",
    "US4.1.2": "Réseaux ferrés ",
    "US4.1.3": "Réseaux aériens ",
    "US4.1.4": "Réseaux de transport fluvial et maritime",
    "US4.1.5": "Autres réseaux de transport",
    "US4.2": "Services de logistique et de stockage",
    "US4.3": "Réseaux d'utilité publique",
    "US5": "Usage résidentiel ",
    "US6.1": "Zones en transition",
    "US6.2": "Zones abandonnées",
    "US6.3": "Sans usage",
    "US6.6": "Usage inconnu ",
}
# Map colours per land-use code.
CODES_US_COLORS = {
    "US1.1": "#ffffa8", "US1.2": "#008000", "US1.3": "#a700cc", "US1.4": "#000099", "US1.5": "#996633",
    "US2": "#e5e5e5", "US235": "#e6004d", "US3": "#ff8c00", "US4.1.1": "#cc0000", "US4.1.2": "#5a5a5a",
    "US4.1.3": "#e6cce6", "US4.1.4": "#0066ff", "US4.1.5": "#660033", "US4.2": "#ff0000", "US4.3": "#ff4d00",
    "US5": "#be0960", "US6.1": "#ff4dff", "US6.2": "#404040", "US6.3": "#f0f028", "US6.6": "#ffcc00",
}
UNKNOWN_CODE = "Code US inconnu"
NO_MATCH = "Sans correspondance"
DEFAULT_COLOR = "#b15928"
DEFAULT_LABEL = "Inconnu"
PARK_COLOR = "#f39c12"


def _map(d: dict):
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def recode(c, mapping=CODES_US_MAPPING):
    """Dictionary recode, unmapped values pass through."""
    return F.coalesce(_map(mapping)[F.col(c)], F.col(c))


def lookup(c, mapping, default):
    """Dictionary lookup with default."""
    return F.coalesce(_map(mapping)[F.col(c)], F.lit(default))


def park_cover_link(parks: DataFrame, covers: DataFrame, cell: float = 500.0, with_geometry: bool = False) -> DataFrame:
    """parks(id, millesime, srid, geom, ...) ⟕ covers(id_1, millesime_ocs, code_us, ocs_geom, srid)
    on intersection; adds project_geom_area, ocs_geom_area, geom_intersection_area (J6 G7)."""
    link = spatial_left_join(parks, covers, left_geom="geom", right_geom="ocs_geom",
                             srid="srid", cell=cell, with_geometry=with_geometry)
    return (link.withColumn("project_geom_area", geo.polygon_area("geom"))
                .withColumn("ocs_geom_area", geo.polygon_area("ocs_geom")))


def latest_vintage(link: DataFrame, partition_cols: tuple[str, ...] = ("id", "id_1")) -> DataFrame:
    """Covers strictly older than the park, then per (park, cover id), or the given
    columns (for instance with the park's own vintage), the unique latest vintage (average-rank semantics: a tie at the top keeps none);
    unmatched parks are kept (F8 W1)."""
    f = link.where((F.col("millesime") > F.col("millesime_ocs")) | F.col("id_1").isNull())
    w = Window.partitionBy(*partition_cols)
    top = F.max("millesime_ocs").over(w)
    n_top = F.count(F.when(F.col("millesime_ocs") == top, 1)).over(w)
    return (f.withColumn("_top", top).withColumn("_n_top", n_top)
             .where(F.col("id_1").isNull() | ((F.col("millesime_ocs") == F.col("_top")) & (F.col("_n_top") == 1)))
             .drop("_top", "_n_top"))


def has_cover_counts(link: DataFrame) -> DataFrame:
    """Parks with / without any cover (A5)."""
    per = link.groupBy("id").agg((F.count("id_1") > 0).alias("has_ocs"))
    return per.groupBy("has_ocs").agg(F.count("*").alias("count"))


def area_check(link: DataFrame) -> DataFrame:
    """Per park: declared and geometric area against the summed intersections, and the
    lists of its commune codes (where the link has them) and cover areas (A6 A7)."""
    lists = [F.array_sort(F.collect_list(c)).alias(f"{c}_list") for c in ("insee_com", "ocs_geom_area") if c in link.columns]
    g = link.groupBy("id").agg(*lists,
        F.max("surf_parc").alias("surf_parc"), F.max("project_geom_area").alias("project_geom_area"),
        F.count("*").alias("num_lines"),
        (F.countDistinct("id_1") + F.max(F.col("id_1").isNull().cast("int"))).alias("num_unique_ocs_tiles"),
        F.coalesce(F.sum("geom_intersection_area"), F.lit(0.0)).alias("geom_intersection_area"))
    return (g.withColumn("area_error", (F.col("surf_parc") - F.col("geom_intersection_area")) / F.col("surf_parc"))
             .withColumn("area_geom_error", F.try_divide(F.col("project_geom_area") - F.col("geom_intersection_area"),
                                                         F.col("project_geom_area")))
             .orderBy(F.abs("area_geom_error").desc_nulls_first()))


def usage_shares(link: DataFrame) -> DataFrame:
    """Surface per land use plus the unmatched residual, recoded, with % of total."""
    filled = link.withColumn("code_us", F.coalesce(F.col("code_us"), F.lit(UNKNOWN_CODE)))
    # one pass over the link: two grouping sets, the (park, code) sums and the park
    # totals from which the unmatched residual is derived
    r = filled.groupingSets([["id", "code_us"], ["id"]], "id", "code_us").agg(
        F.coalesce(F.sum("geom_intersection_area"), F.lit(0.0)).alias("_s"),
        F.max("project_geom_area").alias("_pa"), F.grouping_id().alias("_g"))
    parts = r.select(
        F.when(F.col("_g") == 0, F.col("code_us")).otherwise(F.lit(NO_MATCH)).alias("code_us"),
        F.when(F.col("_g") == 0, F.col("_s")).otherwise(F.col("_pa") - F.col("_s")).alias("surface"))
    by_code = parts.groupBy("code_us").agg(F.sum("surface").alias("surface"))
    # codes that pass through unmapped are not bounded: the total is one broadcast row
    total = by_code.agg(F.sum("surface").alias("_total"))
    return (by_code.join(F.broadcast(total)).select(recode("code_us").alias("code_us"), "surface",
                           (100 * F.col("surface") / F.col("_total")).alias("pct_surface"))
                   .orderBy(F.col("surface").desc()))


def geojson_features(link: DataFrame, to_wgs84: bool = True) -> DataFrame:
    """GeoJSON features of a link with intersection geometry, in lon/lat (projected
    geometry re-projected to WGS 84): one per cover intersection (colour by code,
    popup with the land use and the shared area) and each park outline once
    (S12 U7 P7 G6 G8 G4)."""
    shape, outline = F.col("geom_intersection"), F.col("geom")
    if to_wgs84:
        shape = F.transform("geom_intersection", lambda p: geo.rings_to_wgs84(p, F.col("srid")))
        outline = geo.rings_to_wgs84_udf("geom", "srid")
    rings = lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    shared = F.concat(F.lit("Surface partagée : "), F.round("geom_intersection_area", 2).cast("string"), F.lit("m^2"))

    def feature(kind, coordinates, popup, color):
        return F.to_json(F.struct(
            F.lit("Feature").alias("type"), F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
            F.struct(popup.alias("popup"), color.alias("color")).alias("properties")))

    cover_popup = F.concat(F.col("id_1"), F.lit(" | "), lookup("code_us", CODES_US_MAPPING, DEFAULT_LABEL), F.lit(" - "), shared)
    park_popup = F.concat_ws("", F.col("id").cast("string"), F.lit(" | Surface totale : "), F.round("surf_parc", 2).cast("string"),
                             F.lit(" - "), shared)
    cover_feature = feature("MultiPolygon", F.transform(shape, rings), cover_popup, lookup("code_us", CODES_US_COLORS, DEFAULT_COLOR))
    park_feature = feature("Polygon", rings(outline), park_popup, F.lit(PARK_COLOR))
    # one pass over the link: every cover row gives a feature, the first row of
    # each park (window over that park's few rows) also gives its outline
    # a park listed in several vintages is outlined once, in the earliest of those without a cover, if any
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.col("id_1").asc_nulls_first(), "millesime")) == 1
    feats = F.array(F.when(F.col("id_1").isNotNull(), cover_feature), F.when(F.col("_first"), park_feature))
    return (link.withColumn("_first", first).select(F.explode(feats).alias("feature"))
                .where(F.col("feature").isNotNull()))
