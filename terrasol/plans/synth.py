"""Deterministic derivations of reference-shaped inputs from the driver tables.

The driver tables are TPC-H-like; the reference works on PDF texts, titles,
parks and annotations.  Each expression below derives such an input column from
driver-table columns with plain SQL arithmetic and string concatenation that
Spark SQL and DuckDB evaluate identically (``||`` propagates nulls in both,
``chr(10)`` is a newline in both, no division).  The Spark plans evaluate them
with ``F.expr``; the oracle SQL embeds the very same text.
"""

from __future__ import annotations

NL = "chr(10)"

# Markdown "avis" body around a real document text (documents table).
MEASURE_BODY = f"""
CASE WHEN doc_id % 5 = 0 THEN text ELSE
  '# ' || cast(doc_id % 3 + 1 AS string) || '. **Présentation du projet**' || {NL} ||
  CASE WHEN doc_id % 4 = 0 THEN 'Le site est décrit plus bas.'
       ELSE 'Le parc couvre ' || cast(n_chars % 900 + 1 AS string) || ',' || cast(doc_id % 10 AS string)
            || ' ha pour une puissance de ' || cast(doc_id % 40 AS string) || ' MWc.' END || {NL} ||
  '## ' || cast(doc_id % 3 + 1 AS string) || '.1 Détails' || {NL} || text || {NL} ||
  CASE WHEN doc_id % 7 = 0 THEN '# Annexe' ELSE '## ' || cast(doc_id % 3 + 2 AS string) || '. Suite' END || {NL} ||
  'Emprise de ' || cast(doc_id % 90 + 10 AS string) || ' ' || lpad(cast(n_chars % 1000 AS string), 3, '0')
  || ' m2, ' || cast(n_chars % 700 AS string) || ' kWc et ' || cast(doc_id % 3 AS string) || ' 500 000 Wc.'
END
"""

# Project title of an "avis" (documents table): type, power, surface, communes, département.
TITLE = """
CASE doc_id % 8
  WHEN 0 THEN 'Projet de centrale photovoltaïque au sol de ' || cast(doc_id % 30 + 1 AS string) || ',5 MWc sur la commune de NATION_' || cast(doc_id % 25 AS string) || ' (0' || cast(doc_id % 5 AS string) || ')'
  WHEN 1 THEN 'Parc Photovoltaique de ' || cast(n_chars % 90 AS string) || ' hectares sur les communes de NATION_' || cast(doc_id % 25 AS string) || ' et d' || chr(39) || 'NATION_' || cast((doc_id + 7) % 25 AS string) || ' (' || cast(doc_id % 5 AS string) || 'O)'
  WHEN 2 THEN 'Centrale agrivoltaïque à NATION_' || cast(doc_id % 25 AS string) || ', NATION_' || cast((doc_id + 3) % 25 AS string) || ' & les Hauts (974).'
  WHEN 3 THEN '« Avis » sur le projet solaire de ' || cast(doc_id % 12 AS string) || ' MW aux Granges (2A)'
  WHEN 4 THEN 'Installation photovoltaïque commune des Landes (40)'
  WHEN 5 THEN 'Projet photovoltaïque sans localisation'
  WHEN 6 THEN 'Ombrières "photovoltaïques" sur la commune d’NATION_' || cast(doc_id % 25 AS string) || ' de ' || cast(doc_id % 9 AS string) || ' ha (0' || cast(doc_id % 5 AS string) || ')'
  ELSE 'Centrale au sol ' || cast(doc_id % 50 AS string) || ' MWc à NATION_' || cast(doc_id % 25 AS string) || ' (1' || cast(doc_id % 10 AS string) || ')'
END
"""

PDF_NAME = "'avis_' || cast(doc_id AS string) || '.pdf'"
YEAR = "cast(2015 + doc_id % 8 AS string)"
YEAR_URL = f"'https://www.example.org/' || source || '/' || {YEAR}"
REGION_NAME = "'Région ' || source"

# Commune gazetteer: nations (some names padded with blanks) plus region rows giving
# a null-key row and a name repeated in another département.
GAZETTEER_NATION = """
SELECT CASE WHEN n_nationkey % 6 = 0 THEN ' ' || n_name || ' ' ELSE n_name END AS nom_commune,
       cast(n_regionkey AS string) AS code_departement,
       cast(n_nationkey AS double) * 0.5 + 1.25 AS longitude,
       45.0 + cast(n_nationkey AS double) * 0.125 AS latitude
FROM nation"""
GAZETTEER_REGION = """
SELECT CASE WHEN r_regionkey = 0 THEN NULL ELSE 'NATION_' || cast(r_regionkey AS string) END AS nom_commune,
       CASE WHEN r_regionkey = 0 THEN NULL ELSE '1' || cast(r_regionkey AS string) END AS code_departement,
       cast(r_regionkey AS double) + 100.0 AS longitude,
       40.0 AS latitude
FROM region"""

# Raw département codes of every length class (customer table).
RAW_DEPT = """
CASE c_custkey % 7
  WHEN 0 THEN cast(c_nationkey AS string)
  WHEN 1 THEN lpad(cast(c_custkey % 1000 AS string), 3, '0')
  WHEN 2 THEN '2' || CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END || lpad(cast(c_custkey % 1000 AS string), 3, '0')
  WHEN 3 THEN cast(97000 + c_custkey % 1000 AS string)
  WHEN 4 THEN lpad(cast(c_custkey % 97000 AS string), 5, '0')
  WHEN 5 THEN 'X' || lpad(cast(c_custkey % 10000 AS string), 4, '0')
  ELSE cast(1000 + c_custkey % 9000 AS string)
END"""
DEPT_TITLE = """
CASE c_custkey % 3
  WHEN 0 THEN 'Avis sur le projet à Saint-' || c_mktsegment || ' (' || raw_code || ')'
  WHEN 1 THEN 'Parc sur les communes de ' || c_mktsegment || ' ' || raw_code
  ELSE 'Rapport ' || c_name || ' ' || raw_code
END"""

# Raw text with placeholders and blank runs (documents table).
RAW_TEXT = """
CASE doc_id % 4
  WHEN 0 THEN '==> picture [' || cast(doc_id % 10000 AS string) || ' x 34] intentionally omitted <==' || text
  WHEN 1 THEN text || '    fin   du  texte'
  WHEN 2 THEN '==> picture [12345 x 34] intentionally omitted <==' || text
  ELSE text
END"""

# Labelled dataset inputs (labels ⋈ documents).
LAND_TYPE = """
CASE quality * 2 + toxic
  WHEN 0 THEN 'Surfaces naturelles, Surfaces agricoles'
  WHEN 1 THEN 'Surfaces artificialisées'
  WHEN 2 THEN 'Surfaces forestières, Surfaces artificialisées, Surfaces naturelles'
  ELSE 'Surfaces agricoles'
END"""
CONTEXT = """
substring(text, 1 + doc_id % 50, 40) || '[SEP]' || ' ' || substring(text, 1 + cast(floor(n_chars * (doc_id % 10) / 10) AS int), 30) || '[SEP]' ||
substring(text, 1 + cast(floor(n_chars * 0.6) AS int), 200) ||
CASE WHEN doc_id % 9 = 0 THEN '[SEP]absent context ' || cast(doc_id AS string) ELSE '' END"""

# Predictions with truth (labels ⋈ documents).
TRUTH = {
    "surfaces_artificialisees": "quality",
    "surfaces_naturelles": "toxic",
    "surfaces_agricoles": "CASE WHEN lang = 'fr' THEN 1 ELSE 0 END",
    "surfaces_forestieres": "CASE WHEN lang IN ('de', 'es') AND quality = 0 THEN 1 ELSE 0 END",
}
SCORE = {
    "surfaces_artificialisees": "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE cast((doc_id * 37 + quality * 45) % 100 AS double) / 100 END",
    "surfaces_naturelles": "cast((doc_id * 53 + toxic * 60) % 100 AS double) / 100",
    "surfaces_agricoles": "cast((n_chars * 7 + doc_id + CASE WHEN lang = 'fr' THEN 30 ELSE 0 END) % 100 AS double) / 100",
    "surfaces_forestieres": "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE cast((doc_id * 13) % 100 AS double) / 100 END",
}
PREDICTION_TIME = "cast(n_chars % 1000 AS double) / 400 + 0.5"
VALIDATOR = "'user_' || cast(doc_id % 7 AS string)"

# Harvest sources cut from documents by source number (three layouts).
SOURCE_NO = "cast(substr(source, 4) AS int) % 3"
PDF_URL = "'https://www.example.org/' || source || '/avis_' || cast(doc_id AS string) || '.pdf'"
SLASH_DATE = ("lpad(cast(doc_id % 28 + 1 AS string), 2, '0') || '/' || lpad(cast(doc_id % 12 + 1 AS string), 2, '0')"
              " || '/' || cast(2012 + doc_id % 9 AS string)")
FRENCH_DATE = """
CASE WHEN doc_id % 10 = 0 THEN 'date inconnue' ELSE
  CASE WHEN doc_id % 28 = 0 THEN '1er' ELSE cast(doc_id % 28 + 1 AS string) END || ' ' ||
  CASE doc_id % 12 WHEN 0 THEN 'janvier' WHEN 1 THEN 'février' WHEN 2 THEN 'mars' WHEN 3 THEN 'avril'
    WHEN 4 THEN 'mai' WHEN 5 THEN 'juin' WHEN 6 THEN 'juillet' WHEN 7 THEN 'août' WHEN 8 THEN 'septembre'
    WHEN 9 THEN 'octobre' WHEN 10 THEN 'novembre' ELSE 'décembre' END || ' ' || cast(2012 + doc_id % 9 AS string)
END"""

# Parks derived from customer rows.
PARK_ID = "CAST(floor(c_custkey / 3) AS BIGINT)"
INSEE_LIST = "cast(c_custkey % 30 AS string) || ', ' || cast(c_nationkey AS string)"
TERRITORY_CODES = """
CASE c_custkey % 8 WHEN 0 THEN '97105' WHEN 1 THEN '97209' WHEN 2 THEN '97302' WHEN 3 THEN '97411'
  WHEN 4 THEN '97608' WHEN 5 THEN '29720' WHEN 6 THEN '33063' ELSE '75056' END ||
CASE WHEN c_custkey % 3 = 0 THEN ', ' || CASE c_custkey % 5 WHEN 0 THEN '97302' WHEN 1 THEN '97411' ELSE '13055' END ELSE '' END"""

# Registry of installations derived from part rows.
FILIERE = "CASE WHEN p_size % 4 = 0 THEN 'Eolien' ELSE 'Solaire' END"
TECHNOLOGIE = "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END"

# Model answers derived from labels ⋈ documents.
ANSWER = """
CASE doc_id % 5
  WHEN 0 THEN 'not json ' || cast(doc_id AS string)
  WHEN 3 THEN '{"scores": {"Surfaces artificialisées": 1}, "contexts": [], "explanation": "partial"}'
  ELSE '{"scores": {"Surfaces artificialisées": 0.' || cast(doc_id % 10 AS string) ||
       ', "Surfaces naturelles": 0.' || cast(quality * 5 + 2 AS string) ||
       ', "Surfaces agricoles": 0.' || cast(toxic * 6 + 1 AS string) ||
       ', "Surfaces forestières": 0.0' || cast(doc_id % 7 AS string) ||
       '}, "contexts": ["' || lang || '", "ctx ' || cast(doc_id AS string) || '"], "explanation": "exp ' || cast(doc_id AS string) || '"}'
END"""
STOP_REASON = "CASE WHEN doc_id % 5 = 2 THEN 'maxPredictedTokensReached' ELSE 'eosFound' END"

# Park rectangles / L-shapes (supplier) and land-cover rectangles with holes (part), metres in EPSG:2154.
# some parks are listed twice, in two vintages and shapes under one id
PARK_KEY = "CASE WHEN s_suppkey % 10 = 7 THEN s_suppkey - 1 ELSE s_suppkey END"
PARK_X0 = "cast(s_suppkey AS double) * 1000.0 + 100.0 + cast(s_suppkey % 3 AS double) * 50.0"
PARK_Y0 = "6600000.0 + cast(s_suppkey % 5 AS double) * 40.0"
# every 25th park is 40 km wide and lies over its neighbours' covers
PARK_W = "CASE WHEN s_suppkey % 25 = 0 THEN 40000.0 ELSE cast(2 * (50 + s_suppkey % 7 * 15) AS double) END"
PARK_H = "cast(2 * (40 + s_suppkey % 5 * 20) AS double)"
PARK_L = "s_suppkey % 4 = 0"
PARK_MILLESIME = "cast(2018 + s_suppkey % 5 AS int)"
PARK_SURF = "CASE WHEN s_suppkey % 25 = 0 THEN 40000.0 ELSE cast(2 * (50 + s_suppkey % 7 * 15) AS double) END * cast(2 * (40 + s_suppkey % 5 * 20) AS double) + cast(s_suppkey % 3 AS double) * 10.0"
COVER_X0 = "cast(floor(p_partkey / 20) AS double) * 1000.0 + cast(p_partkey % 20 AS double) * 15.0 + 20.0"
COVER_Y0 = "6600000.0 + cast(p_partkey % 7 AS double) * 30.0"
COVER_W = "cast(4 * (15 + p_size) AS double)"
COVER_H = "cast(4 * (12 + p_partkey % 11 * 5) AS double)"
COVER_HOLE = "p_partkey % 6 = 0"
COVER_ID = "'OCS_' || cast(cast(floor(p_partkey / 2) AS bigint) AS string)"
COVER_MILLESIME = "cast(2015 + cast(floor(p_partkey / 2) AS bigint) % 8 + CASE WHEN p_partkey % 6 = 1 THEN 1 ELSE 0 END AS int)"
CODE_US = """
CASE p_partkey % 22
  WHEN 0 THEN 'US1.1' WHEN 1 THEN 'US1.2' WHEN 2 THEN 'US1.3' WHEN 3 THEN 'US1.4' WHEN 4 THEN 'US1.5'
  WHEN 5 THEN 'US2' WHEN 6 THEN 'US235' WHEN 7 THEN 'US3' WHEN 8 THEN 'US4.1.1' WHEN 9 THEN 'US4.1.2'
  WHEN 10 THEN 'US4.1.3' WHEN 11 THEN 'US4.1.4' WHEN 12 THEN 'US4.1.5' WHEN 13 THEN 'US4.2' WHEN 14 THEN 'US4.3'
  WHEN 15 THEN 'US5' WHEN 16 THEN 'US6.1' WHEN 17 THEN 'US6.2' WHEN 18 THEN 'US6.3' WHEN 19 THEN 'US6.6'
  WHEN 20 THEN NULL ELSE 'US9.9' END"""

# Points (customer) near the territory of their CRS: lon/lat degrees.
POINT_LON = """
CASE c_custkey % 8 WHEN 0 THEN -61.5 WHEN 1 THEN -61.0 WHEN 2 THEN -53.0 WHEN 3 THEN 55.5 WHEN 4 THEN 45.1
  ELSE 2.0 END + cast(c_custkey % 50 AS double) * 0.01"""
POINT_LAT = """
CASE c_custkey % 8 WHEN 0 THEN 16.2 WHEN 1 THEN 14.6 WHEN 2 THEN 4.9 WHEN 3 THEN -21.1 WHEN 4 THEN -12.8
  ELSE 46.0 END + cast(c_custkey % 40 AS double) * 0.01"""
POINT_SRID = "CASE c_custkey % 8 WHEN 0 THEN 5490 WHEN 1 THEN 5490 WHEN 2 THEN 2972 WHEN 3 THEN 2975 WHEN 4 THEN 4471 ELSE 2154 END"
# Projected CRS of the parks and covers: some lie in another territory; a few covers beside a park there are in the metropolitan one.
PARK_SRID = "CASE WHEN s_suppkey % 5 = 2 THEN 2975 ELSE 2154 END"
COVER_SRID = "CASE WHEN CAST(floor(p_partkey / 20) AS BIGINT) % 5 = 2 AND p_partkey % 10 <> 3 THEN 2975 ELSE 2154 END"

# Site points (customer): groups ~5.5 km apart, chains of 0.4 km steps, a few isolated; new groups as customers grow.
SITE_LAT = ("45.0 + cast(c_custkey % 60 AS double) * 0.05 + cast(c_custkey % 3 AS double) * 0.004"
            " + CASE WHEN c_custkey % 97 = 0 THEN 0.02 ELSE 0.0 END")
SITE_LON = "2.0 + cast(c_custkey % 7 AS double) * 0.005 + cast(floor(c_custkey / 1260) AS double) * 0.2"

# Document text with one land-type rule phrase appended (documents table).
ARENA_TEXT = """
text || ' ' || CASE doc_id % 6
  WHEN 0 THEN 'Le site est une friche industrielle.'
  WHEN 1 THEN 'La zone est en ZNIEFF et en zone Natura 2000.'
  WHEN 2 THEN 'Prairie permanente et vignes en exploitation.'
  WHEN 3 THEN 'Plantations de résineux monospécifiques.'
  WHEN 4 THEN 'Ancienne carrière et friche ferroviaire.'
  ELSE 'Aucune indication.' END"""
ARENA_MODELS = (("rules-1", 1), ("rules-2", 2), ("rules-3", 3))

# Pages of the harvested layouts, one per document: framed listing blocks, a result table,
# dated paragraphs, a detail page and a detail record.
LISTING_HTML = f"""
'<html><body><h1>Avis</h1><div class="main texteencadre"><h2>' || ({TITLE}) || '</h2><p>Projet ' || cast(doc_id AS string)
|| '</p><a href="/avis/' || cast(doc_id AS string) || '.pdf">Avis</a>'
|| CASE WHEN doc_id % 3 = 0 THEN '<a href=' || chr(39) || '/annexe/' || cast(doc_id AS string) || '.pdf' || chr(39) || '>Annexe</a>' ELSE '' END
|| '</div></span><p>entre</p><div class="texteencadre"><h3>Bloc ' || cast(doc_id % 10 AS string)
|| '</h3></div><a href="?page=' || cast(doc_id + 1 AS string) || '">Suivant</a></body></html>'"""
TABLE_HTML = f"""
'<table><tr><td>Projet photovoltaïque ' || cast(doc_id AS string) || '</td><td><a href="/t/' || cast(doc_id AS string) || '.pdf">Avis du '
|| {SLASH_DATE} || '</a></td><td>Commune ' || cast(doc_id % 25 AS string) || '</td></tr>'
|| '<tr><td>Eolien</td><td><a href="/e.pdf">Avis</a></td><td>Commune X</td></tr></table>'"""
DATED_HTML = f"""
'<p>• Parc solaire ' || cast(doc_id AS string) || ' - ' || ({FRENCH_DATE}) || '</p><p>Sans date ' || cast(doc_id AS string) || '</p>'"""
DETAIL_HTML = "'<a href=\"/aide\">Aide</a><p><a href=\"/d/' || cast(doc_id AS string) || '.PDF\">Avis ' || cast(doc_id AS string) || '</a></p>'"
DETAIL_TITLE = "CASE WHEN doc_id % 2 = 0 THEN 'Avis ' ELSE 'Décision ' END || cast(doc_id AS string)"
DETAIL_JSON = """
'{"d": {"documents": [' || CASE WHEN doc_id % 5 = 0 THEN '' ELSE '{"id": "doc-' || cast(doc_id AS string) || '", "url": "/f/' || cast(doc_id AS string) || '.pdf"}' END || ']}}'"""

# References with dot segments (pages).
DOT_REFERENCES = ("../z.pdf", "./a/../b.pdf", "/x/./y/../z.pdf?q=../r", "../../../up.pdf", "a/b/..", "plain.pdf", "/p/q/.")

# Land-cover download links (customer): label "Département CODE - NAME - YEAR" and href.
DOWNLOAD_LINK_LABEL = """
CASE WHEN c_custkey % 9 = 0 THEN 'Notice ' || c_mktsegment
  ELSE 'Département ' || CASE WHEN c_custkey % 5 = 0 THEN '2A' ELSE lpad(cast(c_nationkey AS string), 2, '0') END
       || ' - ' || c_mktsegment || ' - ' || cast(2015 + c_custkey % 8 AS string) END"""
DOWNLOAD_LINK_HREF = """
'https://data.example.org/ocs/' || CASE WHEN c_custkey % 4 = 0 THEN 'DIFF_' ELSE '' END || 'OCS_' || cast(c_custkey AS string) || '.7z'"""

#: Document that an event claims: four users share one, so claims compete and documents grow with the users.
CLAIM_DOC = "CAST(floor(user_id / 4) AS BIGINT)"
CLAIM_ACTION = "CASE WHEN event_type = 'purchase' AND value > 60 THEN 'validate' WHEN event_type = 'error' THEN 'release' ELSE 'claim' END"

#: Rows as a faulty feed would send them: some without a key, some without text.
REJECT_KEY = "CASE WHEN n_chars % 11 = 3 THEN NULL ELSE doc_id END"
REJECT_TEXT = "CASE WHEN n_chars % 7 = 2 THEN NULL WHEN n_chars % 7 = 5 THEN '  ' ELSE text END"

# Pages of the harvested sites, one or more per document: nested markup, missing parts, several blocks a page.
K = "cast(doc_id AS string)"
SITE = "'https://www.example.org/'"
KEYWORD = "CASE n_chars % 3 WHEN 0 THEN 'photovoltaïque' WHEN 1 THEN 'SOLAIRE' ELSE 'éolien' END"
FRAMED_HTML = f"""
'<html><body><div class="texteencadre-spip spip"><p><strong><a href="/a.html">Parc</a> <em>no</em></strong> ' || {KEYWORD} || ' de ' || {K}
|| '</p><div><span><a class="fr-link" href="/no.pdf">Avis</a>'
|| CASE WHEN n_chars % 5 = 0 THEN '' ELSE '<b><a class="fr-download__link fr-btn" href="pdf/avis-' || {K} || '.pdf">PDF</a></b>' END
|| '</span></div></div><div class="autre">solaire<a class="fr-download__link" href="/hors.pdf">x</a></div>'
|| '<div class="texteencadre-spip"><p>Centrale Solaire &amp; ombrières ' || {K} || '</p><a class="fr-download__link" href="/f/' || {K} || '.pdf?v=1">PDF</a></div></body></html>'"""
NESTED_TABLE_HTML = f"""
CASE WHEN n_chars % 4 = 0 THEN '<table><tr><td>Solaire</td><td>' ELSE '' END
|| '<table><tr><td><p>Dossier <strong>' || {KEYWORD} || '</strong> no ' || {K} || '</p></td><td><div><ul><li><a href="docs/t' || {K}
|| '.PDF"><span>Avis du </span><em>' || {SLASH_DATE} || '</em></a></li></ul><p><strong><a href="/annexe/' || {K} || '.pdf"></a></strong></p></div></td>'
|| '<td> <b>Parc <i>de</i> ' || {K} || '</b><br>Commune</td></tr><tr><td>Photovoltaique</td><td><a href="/x.doc">Avis</a></td><td>Rien</td></tr></table>'
|| CASE WHEN n_chars % 4 = 0 THEN '</td></tr></table>' ELSE '' END"""
YEAR_HTML = f"""
'<ul><li><h2 class="fr-card__title"><span><a href="/an/' || {K} || '" title="Avis rendus en ' || cast(2010 + doc_id % 9 AS string) || '">Voir</a></span></h2></li>'
|| '<li><h3><a href="/autre" title="2001">x</a></h3></li><li><h2 class="fr-card__title"><a href="?p=' || {K} || '" title="Sans date">Voir</a></h2></li></ul>'
|| CASE WHEN doc_id % 4 < 3 THEN '<a class="fr-pagination__link fr-pagination__link--next" href="/region/' || cast(doc_id + 1 AS string) || '">Suivant</a>'
        WHEN n_chars % 2 = 0 THEN '<a class="fr-pagination__link--next" href="/region/' || cast(doc_id - 3 AS string) || '">Premier</a>' ELSE '' END"""
CARD_HTML = f"""
'<div><h3><a class="fr-card__link article-card-lien" href="/fiche/' || {K} || '"> Projet ' || {KEYWORD} || ' <b>' || {K} || '</b></a></h3></div>'
|| '<a class="fr-card__link" href="/fiche/0">solaire</a><ul class="fr-pagination__list"><li>'
|| CASE WHEN doc_id % 3 < 2 THEN '<a class="fr-pagination__link fr-pagination__link--next" href="/liste/' || cast(doc_id + 1 AS string) || '">Suivant</a>'
        WHEN n_chars % 2 = 0 THEN '<a class="fr-pagination__link--next" href="/liste/' || cast(doc_id - 2 AS string) || '">Retour</a>' ELSE '' END || '</li></ul>'"""
CARD_DETAIL_HTML = f"""
'<p><span><time datetime="' || cast(2012 + doc_id % 9 AS string) || '-' || lpad(cast(doc_id % 12 + 1 AS string), 2, '0') || '-' || lpad(cast(doc_id % 28 + 1 AS string), 2, '0')
|| '">hier</time></span><time datetime="1999-01-01"></time></p><div><div>'
|| CASE WHEN n_chars % 7 = 0 THEN '' ELSE '<a class="fr-download__link" href="files/' || {K} || '.pdf"> Avis no ' || {K} || ' <span>PDF 2 Mo</span></a>' END || '</div></div>'"""
HOP_HTML = f"""
'<p class="text-justify">- • Parc <strong>solaire</strong> de <em>Lieu ' || {K} || '</em> - ' || ({FRENCH_DATE}) || ' <span><a href="'
|| CASE WHEN n_chars % 2 = 0 THEN '/direct/' || {K} || '.pdf' ELSE 'page/' || {K} END || '"></a></span></p>'
|| '<p class="text-justify">Centrale photovoltaïque ' || {K} || '</p><p class="text-justify">Éolien - 1 mai 2012<a href="/e.pdf"></a></p><p>solaire - 2 mai 2012</p>'"""
HOP_PAGE_HTML = f"""'<div><a class="fr-link" href="/non.pdf">x</a><p><b><a class="fr-link fr-link--download" href="../doc/h' || {K} || '.pdf">PDF</a></b></p></div>'"""
RESULT_HTML = f"""
'<div class="texte fr-col-md-9"><h3><a href="/r/' || {K} || '.pdf">' || CASE n_chars % 3 WHEN 0 THEN 'Avis ' WHEN 1 THEN 'Décision cas par CAS ' ELSE 'Étude ' END
|| '<b>' || {K} || '</b></a></h3><section><div class="liste_communes">Lille/Lens ' || {K} || '</div>'
|| CASE WHEN n_chars % 5 = 0 THEN '' ELSE '<div class="informations"><strong>Publié le</strong><br>' || ({FRENCH_DATE}) || '<i>x</i></div>' END || '</section></div>'
|| '<div class="texte fr-col-md-9"><p>avis sans lien</p></div><div class="texte">Avis<a href="/z.pdf">Avis</a></div>'"""
NOTICE_HTML = f"""
'<div id="notice_longue_description"><section><h2>' || CASE WHEN n_chars % 4 = 0 THEN 'Décision ' ELSE 'Avis \\\\ ' END || {K} || '</h2><h2>Avis 2</h2></section></div>'
|| CASE WHEN n_chars % 3 = 0 THEN '' ELSE '<p class="item-author">Auteur : <span><a>DREAL\\\\ ' || {K} || '</a></span></p>' END
|| '<p class="item-publisher"><a>MRAe</a></p><p class="item-datepublication"><b>Date de publication :</b> ' || {SLASH_DATE} || '</p>'
|| '<div id="dr-viewer"><div><script>var v = {{collectionId:' || chr(39) || cast(doc_id * 7 AS string) || chr(39) || '}};</script></div></div>'"""
HEADED_HTML = f"""
'<h1>Avis ' || cast(2010 + doc_id % 9 AS string) || '</h1><div><h2>Commune <b>' || {K} || '</b></h2><ul><li><a href="/b/' || {K} || '.pdf">Parc ' || {KEYWORD} || ' ' || {K}
|| '</a></li></ul></div><section><h2>Autre</h2><p><a href="c/' || {K} || '.pdf?x=1.pdf">Centrale <i>solaire</i></a><a href="/solaire">solaire</a></p></section>'"""
