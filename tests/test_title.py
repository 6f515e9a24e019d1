from pyspark.sql import functions as F

from terrasol.functions.title import (clean_departement_code, departement_code_and_commune, gazetteer_dept,
                                      parse_title)


def _parse(spark, titles):
    df = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    return {r.id: r.t for r in df.select("id", parse_title("title").alias("t")).collect()}


def test_title_edges(spark):
    titles = [
        "Projet photovoltaïque sur les communes de Lussac et d’Availles (33)",
        "Centrale solaire 974",
        "Parc photovoltaïque à Ajaccio (2A)",
        "Centrale au sol commune de Bastia (1O)",
        "Projet photovoltaïque sans département",
        "Installation photovoltaïque commune des Landes (40)",
        "« Parc » \"solaire\" de 12,5 MWc et 8 hectares à Pau (64).",
        "Centrale de 3 MW à Tarbes (65)",
    ]
    t = _parse(spark, titles)
    assert t[0].communes == ["Availles"] and t[0].dept == "33" and t[0].project_type == "photovoltaïque"
    assert t[1].dept == "974" and t[1].communes == []
    assert t[2].dept == "2A" and t[2].communes == ["Ajaccio"]
    assert t[3].dept == "10" and t[3].communes == ["Bastia"]
    assert t[4].dept is None and t[4].communes == []
    assert t[5].communes == ["s Landes"]          # keyword inside "commune des" (kept quirk)
    assert t[6].power_mwc_title == 12.5 and t[6].land_surface_ha_title == 8.0 and t[6].communes == ["Pau"]
    assert t[7].power_mwc_title == 3.0


def test_department_codes(spark):
    raw = ["1", "974", "2A", "13", "2A004", "97411", "33063", "X1234", "1234", None]
    df = spark.createDataFrame([(r,) for r in raw], "c string")
    got = [(r.z, r.k) for r in df.select(gazetteer_dept("c").alias("z"), clean_departement_code("c").alias("k")).collect()]
    assert got == [("01", None), ("974", "974"), ("2A", "2A"), ("13", "13"), ("2A004", "2A"), ("97411", "974"),
                   ("33063", "33"), ("X1234", None), ("1234", None), (None, None)]


def test_commune_and_code_first_match(spark):
    df = spark.createDataFrame([("Avis sur le projet à Saint-Jean (33063)",), ("Rapport annuel",)], "s string")
    got = [tuple(r.m) if r.m else None for r in df.select(departement_code_and_commune("s").alias("m")).collect()]
    assert got[0] == ("33", "Saint-Jean")
    assert got[1] == (None, None)
