from pyspark.sql import functions as F

from terrasol.operators import combine, scoring


def test_parse_answers_outcomes(spark):
    valid = ('{"scores": {"Surfaces artificialisées": 0.7, "Surfaces naturelles": 0.1, "Surfaces agricoles": 0, '
             '"Surfaces forestières": 0.2}, "contexts": ["a", "b"], "explanation": "e"}')
    missing = '{"scores": {"Surfaces naturelles": 0.4}, "contexts": [], "explanation": "m"}'
    df = spark.createDataFrame([(1, valid, "eosFound"), (2, "pas du json", "eosFound"),
                                (3, valid, "maxPredictedTokensReached"), (4, missing, "eosFound"), (5, "[1, 2]", None)],
                               "id int, answer string, stop_reason string")
    got = {r.id: (r.status, r.surfaces_artificialisees_score, r.surfaces_naturelles_score, r.explanation)
           for r in scoring.parse_answers(df).collect()}
    assert got == {1: ("parsed", 0.7, 0.1, "e"), 2: ("unparsed", 0.0, 0.0, None),
                   3: ("truncated", None, None, None), 4: ("parsed", None, 0.4, "m"), 5: ("unparsed", 0.0, 0.0, None)}


def test_combined_gazetteer_semantics(spark):
    meta = spark.createDataFrame([
        ("a.pdf", "Parc photovoltaïque à Lussac (1)", "u1"),            # no département → null keys
        ("b.pdf", "Centrale sur la commune de Saint-Pierre (974)", "u2"),
        ("c.pdf", "Parc de 5 ha à Ajaccio et Bastia (2A)", "u9"),
    ], "pdf_name string, title string, year_url string")
    years = spark.createDataFrame([("u1", "R1", "2019"), ("u2", "R2", "2020")], "year_url string, region string, year string")
    measures = spark.createDataFrame([("a.pdf", 12.0, 3.0), ("c.pdf", 40.0, None)],
                                     "pdf_name string, land_surface_ha double, power_mwc double")
    gaz = spark.createDataFrame([
        (None, None, 0.0, 0.0),                     # null key row: pandas merge matches it
        (" Saint-Pierre ", "974", 55.5, -21.3),     # blanks stripped, 974 kept whole
        ("Ajaccio", "2A", 8.7, 41.9), ("Ajaccio", "13", 5.0, 43.0),   # same name, two départements
    ], "nom_commune string, code_departement string, longitude double, latitude double")
    out = {(r.pdf_name, r.nom_commune): r for r in combine.combine_projects(meta, years, measures, gaz).collect()}
    a = out[("a.pdf", None)]
    assert (a.dept, a.longitude, a.region, a.land_surface_ha) == (None, 0.0, "R1", 12.0)
    b = out[("b.pdf", "Saint-Pierre")]
    assert (b.dept, b.longitude) == ("974", 55.5)
    c1, c2 = out[("c.pdf", "Ajaccio")], out[("c.pdf", "Bastia")]
    assert (c1.longitude, c1.land_surface_ha, c1.region) == (8.7, 5.0, None)   # title value overrides body
    assert c2.longitude is None and len(out) == 4
