from pyspark.sql import functions as F

from terrasol.functions.measure import context_section, document_measures

NBSP = " "
# (text, expected ha, expected MWc) from the fixture table (compat mode)
CASES = [
    (f"1{NBSP}234,5 ha", 1234.5, None),
    ("12000 m2", None, None),
    ("15 000 m²", 1.5, None),
    ("en 2019 350 ha", 19350.0, None),
    ("5 habitants", 5.0, None),
    ("1.234,5 ha", 234.5, None),
    ("4,5 MWc et 12 MWc", None, 12.0),
    ("250 kWc", None, 0.25),
    ("500 000 Wc", None, 0.5),
    ("0 ha puis 20 000 m2", 2.0, None),
]


def test_measure_edge_rows(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "id int, pdf_text string")
    got = {r.id: (r.land_surface_ha, r.power_mwc) for r in document_measures(df).collect()}
    for i, (_, ha, mwc) in enumerate(CASES):
        assert got[i] == (ha, mwc), CASES[i]


def test_section_first_then_body(spark):
    text = "# 1. Présentation\nparc de 3 ha et 2 MWc\n# 2. Autre\n900 ha 800 MWc"
    no_value = "# 1. Contexte\nrien\n# 2. Autre\n7 ha 5 MWc"
    df = spark.createDataFrame([(1, text), (2, no_value)], "id int, pdf_text string")
    got = {r.id: (r.land_surface_ha, r.power_mwc) for r in document_measures(df).collect()}
    assert got[1] == (3.0, 2.0)
    assert got[2] == (7.0, 5.0)


def test_section_boundaries(spark):
    cases = {
        # un-numbered sibling heading does not close the section
        1: ("## Présentation\na\n## Suite\nb\n# Fin\nc", "## Présentation\na\n## Suite\nb"),
        # same root number does not close it; a different one does
        2: ("## 1. Contexte\na\n## 1.2 Détail\nb\n## 2. Avis\nc", "## 1. Contexte\na\n## 1.2 Détail\nb"),
        # shallower heading closes it
        3: ("## 3 Présentation\na\n# 4 Autre\nb", "## 3 Présentation\na"),
        # bold heading
        4: ("# **1 Contexte**\nx\n# 2 Y\ny", "# **1 Contexte**\nx"),
        # no matching heading
        5: ("# Introduction\nx", None),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "id int, t string")
    got = {r.id: r.s for r in df.select("id", context_section("t").alias("s")).collect()}
    for k, (_, want) in cases.items():
        assert got[k] == want, k


def test_strict_mode_unit_boundary(spark):
    df = spark.createDataFrame([(1, "5 habitants et 12000 m2")], "id int, pdf_text string")
    r = document_measures(df, mode="strict").collect()[0]
    assert r.land_surface_ha == 1.2
