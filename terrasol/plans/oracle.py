"""DuckDB oracle SQL for the driver-bound queries.

Each string is an independent formulation of the same semantics in DuckDB SQL
(RE2 regexes with the same explicit character classes, list lambdas instead of
Spark higher-order functions).  The helpers below only assemble SQL text.
"""

from __future__ import annotations

from terrasol.functions.common import DIGIT, WORD, WS
from terrasol.functions.measure import NUMBER, SECTION_KEYWORDS, UNITS
from terrasol.functions import title as T
from terrasol.plans import synth

SENT = "chr(1114109)"  # private-use sentinel used to cut before headings


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_q(f'^{WS}+|{WS}+$')}, '', 'g')"


def _max_unit(x: str, unit: str) -> str:
    pat = f"(?i){NUMBER}{WS}*{UNITS[unit]}"
    return (f"list_max(list_transform(regexp_extract_all({x}, {_q(pat)}, 1), lambda v: "
            f"try_cast(replace(regexp_replace(v, {_q(WS + '+')}, '', 'g'), ',', '.') AS double)))")


def _surface(x: str) -> str:
    return f"coalesce(nullif({_max_unit(x, 'ha')}, 0), nullif({_max_unit(x, 'm2')} / 10000, 0))"


def _power(x: str) -> str:
    return (f"coalesce(nullif({_max_unit(x, 'mwc')}, 0), nullif({_max_unit(x, 'kwc')} / 1000, 0), "
            f"nullif({_max_unit(x, 'wc')} / 1000000, 0))")


def _section_ctes(src: str, text: str) -> str:
    """CTEs ``_p``/``_h``/``_s`` computing the context section of ``text`` in ``src``."""
    hit = " OR ".join(f"contains(lower(x.clean), {_q(k)})" for k in SECTION_KEYWORDS)
    return f"""
_p AS (
  SELECT *, CASE WHEN starts_with({text}, '#') THEN pieces0[2:] ELSE pieces0 END AS pieces
  FROM (SELECT *, string_split(regexp_replace({text}, '(?m)^#', {SENT} || '#', 'g'), {SENT}) AS pieces0 FROM {src})
),
_h AS (
  SELECT *, list_filter(heads, lambda h: h.is_heading AND h.hit)[1] AS st
  FROM (SELECT *, list_transform(list_transform(pieces, lambda p, i: {{'i': i, 'p': p,
          'clean': regexp_replace(regexp_extract(p, {_q(f'^#+{WS}*(.*)')}, 1), '^[*_ ]+|[*_ ]+$', '', 'g')}}),
        lambda x: {{'idx': x.i, 'is_heading': starts_with(x.p, '#'),
          'level': length(regexp_extract(x.p, '^(#+)', 1)),
          'root': nullif(regexp_extract(x.clean, {_q(f'^({DIGIT}+)')}, 1), ''),
          'hit': {hit}}}) AS heads
  FROM _p)
),
_s AS (
  SELECT *, CASE WHEN st IS NULL THEN NULL ELSE {_strip("array_to_string(pieces[st.idx : en - 1], '')")} END AS section
  FROM (SELECT *, coalesce(list_filter(heads, lambda h: h.is_heading AND h.idx > st.idx AND
          (h.level < st.level OR (h.level = st.level AND h.root IS DISTINCT FROM st.root)))[1].idx,
          len(pieces) + 1) AS en FROM _h)
)"""


def doc_measures() -> str:
    return f"""
WITH _src AS (SELECT doc_id, {synth.MEASURE_BODY} AS pdf_text FROM documents),
{_section_ctes('_src', 'pdf_text')}
SELECT doc_id,
  coalesce({_surface('section')}, {_surface('pdf_text')}) AS land_surface_ha,
  coalesce({_power('section')}, {_power('pdf_text')}) AS power_mwc
FROM _s"""


def _title_sql(t: str) -> dict[str, str]:
    """SQL expressions of the five title fields over column ``t``."""
    norm = f"regexp_replace({_strip(t)}, '\\.+$', '')"
    for s in ('"', "« ", " »"):
        norm = f"replace({norm}, {_q(s)}, '')"
    return {
        "norm": norm,
        "project_type": f"nullif(regexp_extract({t}, {_q(T.TYPE_PATTERN.replace('(?iu)', '(?i)'))}, 0), '')",
        "power_mwc_title": f"try_cast(replace(nullif(regexp_extract({t}, {_q(T.TITLE_MWC.replace('(?iu)', '(?i)'))}, 1), ''), ',', '.') AS double)",
        "land_surface_ha_title": f"try_cast(replace(nullif(regexp_extract({t}, {_q(T.TITLE_HA.replace('(?iu)', '(?i)'))}, 1), ''), ',', '.') AS double)",
    }


def _communes_sql(before: str) -> str:
    ends = ", ".join(f"length(regexp_extract({before}, {_q('(?is)^(.*' + kw + ')')}, 1))"
                     for kw in T.LOCATIVE_KEYWORDS)
    return f"""(SELECT CASE WHEN lp > 0 THEN list_filter(list_transform(
        regexp_split_to_array({_strip(f'substring({before}, lp + 1)')}, {_q(T.COMMUNE_SEPARATORS)}),
        lambda p: regexp_replace({_strip(f"regexp_replace(p, {_q(T.QUOTE_MARKS)}, '', 'g')")}, {_q(T.LEADING_ARTICLE.replace('(?iu)', '(?i)'))}, '')),
        lambda p: regexp_matches(p, '\\p{{Lu}}')) ELSE []::varchar[] END
      FROM (SELECT greatest({ends}) AS lp))"""


def _parsed_titles(src: str, t: str) -> str:
    e = _title_sql(t)
    split_re = "(?s)^(.*?)" + T.DEPT_TAIL
    return f"""(SELECT *, CASE WHEN has_dept THEN {_communes_sql('_before')} ELSE []::varchar[] END AS communes
  FROM (SELECT *, regexp_matches(_norm, {_q(T.DEPT_TAIL)}) AS has_dept,
          {_strip(f"regexp_extract(_norm, {_q(split_re)}, 1)")} AS _before,
          CASE WHEN regexp_matches(_norm, {_q(T.DEPT_TAIL)}) THEN replace(regexp_extract(_norm, {_q(split_re)}, 2), 'O', '0') END AS dept
        FROM (SELECT *, {e['norm']} AS _norm, {e['project_type']} AS project_type,
                {e['power_mwc_title']} AS power_mwc_title, {e['land_surface_ha_title']} AS land_surface_ha_title
              FROM {src})))"""


def title_parse() -> str:
    return f"""
SELECT doc_id, project_type, dept, land_surface_ha_title, power_mwc_title,
  CAST(len(communes) AS INTEGER) AS n_communes, array_to_string(communes, '|') AS communes
FROM {_parsed_titles(f'(SELECT doc_id, {synth.TITLE} AS title FROM documents)', 'title')}"""


def harvest_projects() -> str:
    return combined_projects(f"WHERE {synth.SOURCE_NO} = 0 AND {_rel_folded(f'({synth.TITLE})')}")


def combined_projects(where: str = "") -> str:
    body = f"(SELECT doc_id, {synth.PDF_NAME} AS pdf_name, {synth.TITLE} AS title, {synth.YEAR_URL} AS year_url FROM documents {where})"
    return f"""
WITH _src AS (SELECT doc_id, {synth.MEASURE_BODY} AS pdf_text FROM documents),
{_section_ctes('_src', 'pdf_text')},
measures AS (
  SELECT {synth.PDF_NAME} AS pdf_name,
    coalesce({_surface('section')}, {_surface('pdf_text')}) AS land_surface_ha,
    coalesce({_power('section')}, {_power('pdf_text')}) AS power_mwc
  FROM _s),
year_links AS (SELECT DISTINCT {synth.YEAR_URL} AS year_url, {synth.REGION_NAME} AS region, {synth.YEAR} AS year FROM documents),
gaz AS (
  SELECT {_strip('nom_commune')} AS g_nom,
         CASE WHEN length(code_departement) < 2 THEN lpad(code_departement, 2, '0') ELSE code_departement END AS g_dept,
         longitude, latitude
  FROM ({synth.GAZETTEER_NATION} UNION ALL {synth.GAZETTEER_REGION})),
parsed AS {_parsed_titles(body, 'title')},
exploded AS (
  SELECT p.*, {_strip('c')} AS nom_commune
  FROM parsed p, unnest(CASE WHEN len(p.communes) = 0 THEN [NULL::varchar] ELSE p.communes END) AS u(c))
SELECT e.pdf_name, y.year, y.region, e.project_type, e.nom_commune, e.dept,
  coalesce(e.land_surface_ha_title, m.land_surface_ha) AS land_surface_ha,
  coalesce(e.power_mwc_title, m.power_mwc) AS power_mwc,
  g.longitude, g.latitude
FROM exploded e
LEFT JOIN year_links y ON e.year_url = y.year_url
LEFT JOIN measures m ON e.pdf_name = m.pdf_name
LEFT JOIN gaz g ON e.nom_commune IS NOT DISTINCT FROM g.g_nom AND e.dept IS NOT DISTINCT FROM g.g_dept"""


def _clean_dept(r: str) -> str:
    return (f"CASE WHEN length({r}) IN (2, 3) THEN {r} WHEN length({r}) = 5 THEN ("
            f"CASE WHEN contains({r}, 'A') OR contains({r}, 'B') THEN substr({r}, 1, 2) "
            f"WHEN try_cast({r} AS BIGINT) IS NULL THEN NULL "
            f"WHEN try_cast({r} AS BIGINT) > 97000 THEN substr({r}, 1, 3) ELSE substr({r}, 1, 2) END) END")


def dept_codes() -> str:
    pat = _q(T.COMMUNE_CODE)
    return f"""
WITH c AS (SELECT c_custkey, c_name, c_mktsegment, {synth.RAW_DEPT} AS raw_code FROM customer),
t AS (SELECT *, {synth.DEPT_TITLE} AS title FROM c)
SELECT c_custkey, raw_code,
  CASE WHEN length(raw_code) < 2 THEN lpad(raw_code, 2, '0') ELSE raw_code END AS zfill_code,
  {_clean_dept('raw_code')} AS clean_code,
  CASE WHEN regexp_matches(title, {pat}) THEN {_clean_dept(_strip(f'regexp_extract(title, {pat}, 3)'))} END AS title_code,
  CASE WHEN regexp_matches(title, {pat}) THEN nullif({_strip(f'regexp_extract(title, {pat}, 2)')}, '') END AS title_commune
FROM t"""


def _clean_text(x: str) -> str:
    from terrasol.functions.text import IMAGE_PLACEHOLDER
    return f"regexp_replace(regexp_replace({x}, {_q(IMAGE_PLACEHOLDER)}, '', 'g'), ' {{2,}}', ' ', 'g')"


def clean_documents() -> str:
    return f"""
SELECT doc_id, pdf_text FROM (SELECT doc_id, {_clean_text(synth.RAW_TEXT)} AS pdf_text FROM documents)
WHERE pdf_text IS NOT NULL"""


_LABELLED = "(SELECT * FROM labels JOIN documents USING (doc_id))"


def dataset_build() -> str:
    return f"""
WITH lab AS (SELECT {synth.PDF_NAME} AS pdf_name, text AS pdf_text, {synth.LAND_TYPE} AS land_type,
                    {synth.CONTEXT} AS context FROM {_LABELLED}),
ds AS (SELECT pdf_name, {_clean_text('pdf_text')} AS pdf_text,
              string_split({_clean_text('context')}, '[SEP]') AS contexts,
              list_sort(string_split(land_type, ', ')) AS labels FROM lab WHERE pdf_text IS NOT NULL),
ex AS (SELECT pdf_name, pdf_text, labels, unnest(generate_series(0, len(contexts) - 1)) AS ctx_pos,
              unnest(contexts) AS context FROM ds)
SELECT pdf_name, array_to_string(labels, '|') AS labels, CAST(ctx_pos AS INTEGER) AS ctx_pos, context,
       CAST(instr(pdf_text, {_strip('context')}) - 1 AS INTEGER) AS start, CAST(length(context) AS INTEGER) AS length
FROM ex"""


def _tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {_q(WS + '+')}), lambda t: t <> '')"


def chunks() -> str:
    return f"""
WITH t AS (SELECT doc_id, {_tokens('text')} AS toks FROM documents),
s AS (SELECT doc_id, toks, CASE WHEN len(toks) > 0 THEN range(0, len(toks), 246) ELSE [] END AS starts FROM t),
e AS (SELECT doc_id, toks, unnest(generate_series(0, len(starts) - 1)) AS chunk_idx, unnest(starts) AS st FROM s)
SELECT doc_id, CAST(chunk_idx AS INTEGER) AS chunk_idx, CAST(len(toks[st + 1 : st + 256]) AS INTEGER) AS n_tokens, array_to_string(toks[st + 1 : st + 256], ' ') AS chunk_text
FROM e"""


def chunk_pool() -> str:
    inner = chunks().replace("FROM documents", f"FROM (SELECT doc_id, {synth.ARENA_TEXT} AS text FROM documents)")
    one = "\nUNION ALL\n".join(f"SELECT doc_id, {_q(k)} AS label, least(1.0, ({_rule_hits(k)}) / 2.0) AS score FROM c" for k in _RULES)
    return f"""
WITH c AS (SELECT doc_id, {_rule_matches('chunk_text')} AS _m FROM ({inner})),
s AS ({one})
SELECT doc_id, label, round(avg(score), 9) AS mean_score, max(score) AS max_score FROM s GROUP BY doc_id, label"""


def fit_budget() -> str:
    n = "floor(length(text) / pow(2.0, k))::INTEGER"
    return f"""
WITH c AS (SELECT doc_id, list_filter(list_transform(range(0, 41), lambda k: {{'n': {n},
             'tokens': len({_tokens(f'substring(text, 1, {n})')})}}), lambda s: s.tokens + 1000 <= 2000)[1] AS f
           FROM documents)
SELECT doc_id, f.n AS kept_chars, CAST(f.tokens AS INTEGER) AS kept_tokens FROM c"""


def multi_hot() -> str:
    from terrasol.operators.evaluate import LABELS
    cols = ", ".join(f"CAST(contains(land_type, {_q(v)}) AS INTEGER) AS {k}" for k, v in LABELS.items())
    return f"SELECT doc_id, {cols} FROM (SELECT doc_id, {synth.LAND_TYPE} AS land_type FROM {_LABELLED})"


def isin_flag() -> str:
    return ("SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL', 'ECONOMY') THEN 1 ELSE 0 END AS is_artificial "
            "FROM part")


def _pred_cte() -> str:
    from terrasol.operators.evaluate import LABELS
    cols = ", ".join(f"CAST({synth.TRUTH[k]} AS INTEGER) AS {k}, {synth.SCORE[k]} AS {k}_score" for k in LABELS)
    return f"(SELECT doc_id, {cols}, {synth.PREDICTION_TIME} AS prediction_time FROM {_LABELLED})"


def _report_sql(pred: str, threshold: str = "0.5") -> str:
    from terrasol.operators.evaluate import LABELS
    p = lambda k: f"CAST(coalesce({k}_score > {threshold}, false) AS INTEGER)"
    cells = " UNION ALL ".join(f"SELECT {_q(k)} AS label, CAST({k} AS INTEGER) AS y, {p(k)} AS p FROM pr" for k in LABELS)
    inter = " + ".join(f"CAST({k} AS INTEGER) * {p(k)}" for k in LABELS)
    nt = " + ".join(f"CAST({k} AS INTEGER)" for k in LABELS)
    npred = " + ".join(p(k) for k in LABELS)
    d = lambda a, b: f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"
    return f"""
WITH pr AS {pred},
cells AS ({cells}),
cnt AS (SELECT label, sum(y * p) AS tp, sum((1 - y) * p) AS fp, sum(y * (1 - p)) AS fn FROM cells GROUP BY label),
pl AS (SELECT label, {d('tp', 'tp + fp')} AS precision, {d('tp', 'tp + fn')} AS recall,
              {d('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS support FROM cnt),
mi AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM cnt),
rows_ AS (SELECT {inter} AS i, {nt} AS t, {npred} AS np FROM pr),
allr AS (
  SELECT label, precision, recall, f1, support FROM pl
  UNION ALL SELECT 'micro avg', {d('tp', 'tp + fp')}, {d('tp', 'tp + fn')}, {d('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM mi
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM pl
  UNION ALL SELECT 'weighted avg', {d('sum(precision * support)', 'sum(support)')}, {d('sum(recall * support)', 'sum(support)')},
                   {d('sum(f1 * support)', 'sum(support)')}, sum(support) FROM pl
  UNION ALL SELECT 'samples avg', avg({d('i', 'np')}), avg({d('i', 't')}), avg({d('2 * i', 't + np')}), sum(t) FROM rows_)
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
       CAST(support AS BIGINT) AS support FROM allr"""


def report() -> str:
    return _report_sql(_pred_cte())


def threshold_best() -> str:
    from terrasol.operators.evaluate import LABELS
    cells = " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS y, {k}_score AS s FROM pr" for k in LABELS)
    return f"""
WITH pr AS {_pred_cte()},
cells AS ({cells}),
th AS (SELECT i FROM range(20) r(i)),
sw AS (SELECT i, sum(CASE WHEN coalesce(s > i * 0.05::DOUBLE, false) THEN y ELSE 0 END) AS tp,
              sum(CASE WHEN coalesce(s > i * 0.05::DOUBLE, false) THEN 1 - y ELSE 0 END) AS fp,
              sum(y) AS P FROM th, cells GROUP BY i),
f AS (SELECT i, CASE WHEN 2 * tp + fp + (P - tp) = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + (P - tp)) END AS f1 FROM sw),
best AS (SELECT i, f1 FROM f WHERE f1 > 0 ORDER BY f1 DESC, i ASC LIMIT 1)
SELECT round(coalesce((SELECT i * 0.05::DOUBLE FROM best), 0.5), 9) AS threshold,
       round(coalesce((SELECT f1 FROM best), 0.0), 9) AS best_f1"""


def timing() -> str:
    return f"""SELECT round(sum(prediction_time), 6) AS total, round(avg(prediction_time), 6) AS avg,
  round(stddev_samp(prediction_time), 6) AS std FROM {_pred_cte()}"""


def accuracy() -> str:
    return """SELECT round(avg(CAST(list_position(embedding, list_max(embedding)) - 1 = label % 8 AS DOUBLE)), 9) AS accuracy
FROM embeddings"""


def _ann_cte() -> str:
    from terrasol.operators.evaluate import LABELS
    sc = {k: synth.SCORE[k].replace("quality", "coalesce(quality, 0)").replace("toxic", "coalesce(toxic, 0)")
          for k in LABELS}
    cols = ", ".join(
        f"CASE WHEN quality IS NULL THEN NULL ELSE CAST({synth.TRUTH[k]} AS BOOLEAN) END AS {k}, "
        f"{sc[k]} AS {k}_score, coalesce({sc[k]} > 0.5, false) AS {k}_pred" for k in LABELS)
    return f"""(SELECT {synth.PDF_NAME} AS pdf_name, doc_id, quality IS NOT NULL AS is_validated,
  CASE WHEN quality IS NOT NULL THEN {synth.VALIDATOR} END AS validated_by, {cols}
  FROM documents LEFT JOIN labels USING (doc_id))"""


def progress() -> str:
    d = lambda a, b: f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"
    return f"""
WITH a AS (SELECT count(*) AS total_docs, count(*) FILTER (WHERE is_validated) AS validated_docs,
             count(*) FILTER (WHERE is_validated AND validated_by = 'user_3') AS user_validated_docs FROM {_ann_cte()})
SELECT total_docs, validated_docs, round({d('validated_docs', 'total_docs')} * 100, 9) AS overall_completion,
       user_validated_docs, round({d('user_validated_docs', 'validated_docs')} * 100, 9) AS user_contribution FROM a"""


def leaderboard() -> str:
    return f"SELECT validated_by, count(*) AS count FROM {_ann_cte()} WHERE is_validated GROUP BY validated_by"


def human_vs_model() -> str:
    from terrasol.operators.evaluate import LABELS
    cols = ", ".join(f"CAST(coalesce({k}, false) AS INTEGER) AS {k}, CAST({k}_pred AS DOUBLE) AS {k}_score" for k in LABELS)
    return _report_sql(f"(SELECT {cols} FROM {_ann_cte()} WHERE is_validated)")


def summaries() -> str:
    from terrasol.operators.evaluate import LABELS

    def summ(flag):
        keys = "list_filter([" + ", ".join(f"CASE WHEN {flag(k)} THEN {_q(k)} END" for k in LABELS) + "], lambda x: x IS NOT NULL)"
        return (f"(SELECT CASE WHEN len(ks) > 0 THEN CAST(len(ks) AS VARCHAR) || ' labels: ' || array_to_string(ks, ', ') "
                f"ELSE 'No labels selected' END FROM (SELECT {keys} AS ks))")
    return f"""SELECT pdf_name,
  CASE WHEN NOT is_validated THEN 'Not validated' ELSE {summ(lambda k: k)} END AS validated_summary,
  {summ(lambda k: k + '_pred')} AS original_summary
FROM {_ann_cte()}"""


def claim_sessions() -> str:
    return f"""
WITH c AS (SELECT {synth.CLAIM_DOC} AS doc_id, user_id, ts FROM events),
g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 60 MINUTE THEN 1 ELSE 0 END AS brk
      FROM c WINDOW w AS (PARTITION BY doc_id, user_id ORDER BY ts)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id, user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT doc_id, user_id, min(ts) AS claim_start, max(ts) AS last_refresh, count(*) AS n_events
FROM s GROUP BY doc_id, user_id, sid"""


def lock_life_cycle() -> str:
    return f"""
WITH RECURSIVE e AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts, event_id) AS rn
  FROM (SELECT {synth.CLAIM_DOC} AS doc_id, user_id, ts, event_id, {synth.CLAIM_ACTION} AS action FROM events)),
s AS (
  SELECT DISTINCT doc_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS holder, CAST(NULL AS TIMESTAMP) AS since, false AS closed,
    CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS VARCHAR) AS outcome
  FROM e
  UNION ALL
  SELECT doc_id, rn,
    CASE outcome WHEN 'granted' THEN user_id WHEN 'refreshed' THEN user_id WHEN 'refused' THEN held END,
    CASE outcome WHEN 'granted' THEN ts WHEN 'refreshed' THEN ts WHEN 'refused' THEN since END,
    closed OR outcome = 'validated', user_id, ts, event_id, action, outcome
  FROM (
    SELECT *, CASE WHEN closed THEN 'refused'
                   WHEN action = 'claim' THEN CASE WHEN held IS NULL THEN 'granted' WHEN held = user_id THEN 'refreshed' ELSE 'refused' END
                   WHEN held IS NULL OR held <> user_id THEN 'refused'
                   WHEN action = 'release' THEN 'released' ELSE 'validated' END AS outcome
    FROM (SELECT e.*, s.since, s.closed, CASE WHEN e.ts - s.since < INTERVAL 60 MINUTE THEN s.holder END AS held
          FROM s JOIN e ON e.doc_id = s.doc_id AND e.rn = s.rn + 1))),
n AS (SELECT *, lead(ts) OVER (PARTITION BY doc_id ORDER BY rn) AS next_ts FROM s)
SELECT doc_id, user_id, ts, event_id, action, outcome FROM s WHERE rn > 0
UNION ALL
SELECT doc_id, holder, since + INTERVAL 60 MINUTE, NULL, 'timeout', 'expired' FROM n
WHERE holder IS NOT NULL AND (next_ts IS NULL OR next_ts - since >= INTERVAL 60 MINUTE)"""


def lock_life_cycle_stream() -> str:
    return lock_life_cycle()


def refused_claims() -> str:
    outcomes = ("granted", "refreshed", "refused", "released", "validated", "expired")
    return f"""
SELECT doc_id, user_id, {', '.join(f"count(*) FILTER (WHERE outcome = '{o}') AS n_{o}" for o in outcomes)},
  min(ts) FILTER (WHERE outcome = 'granted') AS first_granted
FROM ({lock_life_cycle()}) GROUP BY doc_id, user_id"""


def ordered_ingest() -> str:
    return f"SELECT doc_id, 1 AS version, n_chars_clean, land_surface_ha, power_mwc FROM ({incremental_ingest()})"


def ingest_rejects() -> str:
    text = _clean_text(synth.REJECT_TEXT)
    return f"""
SELECT doc_id, outcome, count(*) AS n_rows FROM (
  SELECT doc_id, CASE WHEN doc_id IS NULL THEN 'no key' WHEN trim(coalesce(t, '')) = '' THEN 'no text' ELSE 'stored' END AS outcome
  FROM (SELECT {synth.REJECT_KEY} AS doc_id, {text} AS t FROM documents))
GROUP BY doc_id, outcome"""


_AS_OF = "TIMESTAMP '2024-01-30 23:00:00'"


def _locks_cte() -> str:
    return f"""(SELECT a.pdf_name, a.doc_id, a.is_validated, CAST(l.user_id AS VARCHAR) AS locked_by, l.locked_at
  FROM {_ann_cte()} a LEFT JOIN (SELECT user_id, max(ts) AS locked_at FROM events GROUP BY user_id) l ON a.doc_id = l.user_id)"""


def stale_claims() -> str:
    return f"""
SELECT pdf_name, 'stale' AS kind FROM {_locks_cte()}
WHERE locked_by IS NOT NULL AND locked_at <= {_AS_OF} - INTERVAL 30 MINUTE
UNION ALL
SELECT pdf_name, 'expired' AS kind FROM {_locks_cte()}
WHERE locked_by IS NOT NULL AND NOT coalesce(is_validated, false) AND locked_at <= {_AS_OF} - INTERVAL 60 MINUTE"""


def claimable_next() -> str:
    return f"""
SELECT pdf_name FROM {_locks_cte()}
WHERE NOT coalesce(is_validated, false)
  AND (locked_by IS NULL OR (NOT coalesce(is_validated, false) AND locked_at <= {_AS_OF} - INTERVAL 60 MINUTE))
ORDER BY md5(pdf_name || '42') LIMIT 1"""


def split_80_20() -> str:
    return """
SELECT doc_id, quality,
  CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id)
            <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY quality)) THEN 'test' ELSE 'train' END AS split
FROM labels"""


def highlight() -> str:
    c = f"(SELECT doc_id, text, string_split({synth.CONTEXT}, '[SEP]') AS cs FROM {_LABELLED})"
    expr = "text"
    for i in (1, 2, 3):
        ci = _strip(f"cs[{i}]")
        expr = (f"CASE WHEN cs[{i}] IS NULL OR {ci} = '' THEN {expr} ELSE "
                f"regexp_replace({expr}, '(?i)(\\Q' || {ci} || '\\E)', '<mark>\\1</mark>', 'g') END")
    return f"SELECT doc_id, {expr} AS highlighted FROM {c}"


def _resolve(b: str, h0: str) -> str:
    from terrasol.functions import harvest as H
    h = f"replace({h0}, '&amp;', '&')"
    scheme = f"regexp_extract({b}, {_q(H.SCHEME)}, 1)"
    origin = f"({scheme} || '://' || regexp_extract({b}, {_q(H.AUTHORITY)}, 1))"
    path = f"regexp_extract({b}, {_q(H.PATH)}, 1)"
    no_frag = f"regexp_extract({b}, '^([^#]*)', 1)"
    directory = f"coalesce(nullif(regexp_extract({path}, '^(.*/)', 1), ''), '/')"
    return (f"CASE WHEN regexp_matches({h}, {_q(H.SCHEME)}) THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {origin} || {h} "
            f"WHEN {h} = '' THEN {no_frag} "
            f"WHEN starts_with({h}, '#') THEN {no_frag} || {h} "
            f"WHEN starts_with({h}, '?') THEN {origin} || {path} || {h} "
            f"ELSE {origin} || {directory} || {h} END")


def _links_cte() -> str:
    a = _q(r'(?is)<a[ \t\n\r\f][^>]*?href="([^"]*)"[^>]*>(.*?)</a>')  # the pages quote every href doubly
    return f"""(
  SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, href, anchor_text, abs_url, regexp_extract(abs_url, '([^/]*)$', 1) AS file_name,
         ends_with(lower(abs_url), '.pdf') AS is_pdf, nullif(regexp_extract(anchor_text, '([0-9]{{4}})', 1), '') AS year
  FROM (SELECT page_id, link_pos, href, {_strip("regexp_replace(atext, '<[^>]*>', '', 'g')")} AS anchor_text,
               {_resolve('url', 'href')} AS abs_url
        FROM (SELECT page_id, url, unnest(generate_series(0, len(hs) - 1)) AS link_pos, unnest(hs) AS href, unnest(ts) AS atext
              FROM (SELECT page_id, url, regexp_extract_all(html, {a}, 1) AS hs, regexp_extract_all(html, {a}, 2) AS ts FROM pages))))"""


def page_links() -> str:
    return f"SELECT * FROM {_links_cte()}"


def follow_frontier() -> str:
    return f"""
SELECT t.abs_url, t.n_refs, coalesce(f.fetched, false) AS fetched
FROM (SELECT abs_url, count(*) AS n_refs FROM {_links_cte()} GROUP BY abs_url) t
LEFT JOIN (SELECT DISTINCT url AS abs_url, true AS fetched FROM pages) f ON t.abs_url = f.abs_url"""


def _rel_folded(t: str) -> str:
    return f"(contains(translate(lower({t}), 'ï', 'i'), 'voltaique') OR contains(translate(lower({t}), 'ï', 'i'), 'solaire'))"


def _rel_regex(t: str) -> str:
    return f"regexp_matches({t}, '(?i)volta[iï]que|solaire')"


def _rel_plain(t: str) -> str:
    lt = f"lower({_strip(t)})"
    return f"(contains({lt}, 'solaire') OR contains({lt}, 'voltaïque') OR contains({lt}, 'voltaique'))"


def _french_date(s: str) -> str:
    from terrasol.functions.harvest import FRENCH_MONTHS
    t = f"regexp_replace(lower({_strip(s)}), '^1er\\b', '1')"
    for i, m in enumerate(FRENCH_MONTHS, start=1):
        t = f"regexp_replace({t}, {_q(chr(92) + 'b' + m + chr(92) + 'b')}, '{i}')"
    return f"CAST(try_strptime({t}, '%d %m %Y') AS DATE)"


def harvest_union() -> str:
    from terrasol.functions.harvest import UNSAFE_FILENAME_CHARS
    base = (f"(SELECT doc_id, {synth.SOURCE_NO} AS _src, {synth.TITLE} AS project_name, {synth.PDF_URL} AS pdf_url, "
            f"source, text FROM documents)")
    san = f"substring(regexp_replace(regexp_replace(project_name || '.pdf', {_q(UNSAFE_FILENAME_CHARS)}, '_', 'g'), '^[. ]+|[. ]+$', '', 'g'), 1, 150)"
    return f"""
SELECT project_name, pdf_url, regexp_extract(pdf_url, '([^/]*)$', 1) AS pdf_filename, text AS description,
       NULL::DATE AS publish_date_scraped, NULL::VARCHAR AS commune_name_scraped, NULL::VARCHAR AS departement_code, NULL::VARCHAR AS year_scraped
FROM {base} WHERE _src = 0 AND {_rel_folded('project_name')}
UNION ALL
SELECT project_name, pdf_url, regexp_extract(regexp_extract(pdf_url, '^([^?#]*)', 1), '([^/]*)$', 1), NULL,
       CAST(try_strptime({synth.SLASH_DATE}, '%d/%m/%Y') AS DATE), 'NATION_' || cast(doc_id % 25 AS string), NULL, NULL
FROM {base} WHERE _src = 1 AND {_rel_regex('project_name')}
UNION ALL
SELECT project_name, pdf_url, {san}, NULL, {_french_date(synth.FRENCH_DATE)}, NULL, '973',
       nullif(regexp_extract({synth.FRENCH_DATE}, '([0-9]{{4}})', 1), '')
FROM {base} WHERE _src = 2 AND {_rel_plain('project_name')}"""


def _plan_sql() -> str:
    return """(
SELECT p.pdf_filename, p.pdf_url, CASE WHEN d.fn IS NOT NULL THEN 'skip' ELSE 'download' END AS action
FROM (SELECT 'https://www.example.org/avis_' || cast(o_orderkey AS string) || '.pdf' AS pdf_url,
             'avis_' || cast(o_orderkey AS string) || '.pdf' AS pdf_filename FROM orders) p
LEFT JOIN (SELECT DISTINCT 'avis_' || cast(l_orderkey AS string) || '.pdf' AS fn FROM lineitem
           WHERE (l_partkey % 4) * 1000 > 0) d ON p.pdf_filename = d.fn)"""


def download_plan() -> str:
    return f"SELECT * FROM {_plan_sql()}"


def download_stats() -> str:
    return (f"SELECT count(*) AS total, count(*) FILTER (WHERE action = 'skip') AS skipped, "
            f"count(*) FILTER (WHERE action = 'download') AS to_download FROM {_plan_sql()}")


def relevance_filter() -> str:
    y = synth.YEAR
    return f"""
SELECT doc_id, CAST({_rel_folded('t')} AS INTEGER) AS f3a, CAST({_rel_regex('t')} AS INTEGER) AS f3b,
  CAST({_rel_plain('t')} AS INTEGER) AS f3c, CAST(contains(t, 'Avis') AS INTEGER) AS f4_avis,
  CAST(contains(lower(t), 'cas par cas') OR contains(lower(t), 'avis') AS INTEGER) AS f4_lower,
  CAST(regexp_matches(y, '^[0-9]+$') AND try_cast(y AS INTEGER) BETWEEN 2010 AND 2017 AS INTEGER) AS f7_year,
  CAST(ends_with(lower(u), '.pdf') AS INTEGER) AS f10_pdf
FROM (SELECT doc_id, {synth.TITLE} AS t, {y} AS y, {synth.PDF_URL} AS u FROM documents)"""


def profile_table() -> str:
    numbers = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    parts = []
    for c in numbers:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, min({x}) AS min, max({x}) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text, "
            f"count(DISTINCT {x}) AS n_distinct, round(avg({x}), 4) AS avg, round(stddev_samp({x}), 4) AS std, count({x}) AS count, "
            f"round(100.0::DOUBLE * (count(*) - count({x})) / count(*), 6) AS null_percentage FROM lineitem")
    return "\nUNION ALL\n".join(parts + [
        f"SELECT '{c}', NULL, NULL, min(CAST({c} AS VARCHAR)), max(CAST({c} AS VARCHAR)), count(DISTINCT {c}), NULL, NULL, count({c}), "
        f"round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) FROM lineitem" for c in ("l_returnflag", "l_linestatus", "l_shipdate")])


def _parks_sql() -> str:
    return (f"(SELECT c_custkey, {synth.PARK_ID} AS id, string_split({synth.INSEE_LIST}, ', ') AS insee_com, "
            f"string_split({synth.TERRITORY_CODES}, ', ') AS territory_codes FROM customer)")


def commune_counts() -> str:
    return f"""
SELECT c.COM, count(DISTINCT p.id) AS num_installations
FROM {_parks_sql()} p LEFT JOIN (SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS COM FROM nation) c ON p.insee_com[1] = c.COM
GROUP BY c.COM"""


def crs_select() -> str:
    from terrasol.operators.parks import DEFAULT_CRS, TERRITORY_CRS
    whens = " ".join(
        "WHEN list_bool_or(list_transform(territory_codes, lambda s: "
        + " OR ".join(f"starts_with(s, '{p}')" for p in prefixes) + f")) THEN {srid}"
        for prefixes, srid in TERRITORY_CRS)
    return f"SELECT c_custkey, CAST(len(territory_codes) AS INTEGER) AS n_codes, CASE {whens} ELSE {DEFAULT_CRS} END AS srid FROM {_parks_sql()}"


def decimal_sum() -> str:
    return ("SELECT CAST(sum(CAST(p_retailprice AS DECIMAL(18,3))) AS DECIMAL(38,3)) AS sum_p_retailprice, "
            "count(CAST(p_retailprice AS DECIMAL(18,3))) AS n FROM part")


def tech_counts() -> str:
    return (f"SELECT technologie, count(*) AS len FROM (SELECT {synth.FILIERE} AS filiere, {synth.TECHNOLOGIE} AS technologie "
            f"FROM part) WHERE filiere = 'Solaire' GROUP BY technologie")


def parse_answers() -> str:
    from terrasol.operators.evaluate import LABELS
    scores = ", ".join(
        f"CASE WHEN status = 'unparsed' THEN 0.0 WHEN status = 'parsed' THEN "
        f"CAST(json_extract(answer, '$.scores.\"{name}\"') AS DOUBLE) END AS {k}_score"
        for k, name in LABELS.items())
    return f"""
WITH a AS (SELECT doc_id, {synth.ANSWER} AS answer, {synth.STOP_REASON} AS stop_reason FROM {_LABELLED}),
s AS (SELECT *, CASE WHEN NOT (json_valid(answer) AND json_type(CASE WHEN json_valid(answer) THEN answer ELSE '0' END) = 'OBJECT')
                     THEN 'unparsed' WHEN stop_reason = 'maxPredictedTokensReached' THEN 'truncated' ELSE 'parsed' END AS status FROM a)
SELECT doc_id, status, {scores},
  CASE WHEN status = 'parsed' THEN CAST(json_array_length(answer, '$.contexts') AS INTEGER) END AS n_contexts,
  CASE WHEN status = 'parsed' THEN json_extract_string(answer, '$.explanation') END AS explanation
FROM s"""


def upsert_import() -> str:
    return """
WITH o AS (SELECT 'avis_' || cast(o_orderkey AS string) AS pdf_name, 'old ' || o_orderstatus AS explanation,
                  NULL::DOUBLE AS prediction_time, o_orderstatus = 'F' AS is_validated,
                  CASE WHEN o_orderstatus = 'F' THEN 'user_' || cast(o_custkey % 5 AS string) END AS validated_by FROM orders),
b AS (SELECT 'avis_' || cast(l_orderkey * 2 + l_linenumber % 2 AS string) AS pdf_name, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
             'new ' || l_returnflag || cast(l_linenumber AS string) AS explanation, l_quantity AS prediction_time FROM lineitem),
n AS (SELECT pdf_name, explanation, prediction_time FROM (SELECT *, row_number() OVER (PARTITION BY pdf_name
        ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM b) WHERE rn = 1)
SELECT coalesce(o.pdf_name, n.pdf_name) AS pdf_name,
  CASE WHEN n.pdf_name IS NOT NULL THEN n.explanation ELSE o.explanation END AS explanation,
  CASE WHEN n.pdf_name IS NOT NULL THEN n.prediction_time ELSE o.prediction_time END AS prediction_time,
  o.is_validated, o.validated_by,
  CASE WHEN o.pdf_name IS NULL THEN 'created' WHEN n.pdf_name IS NULL THEN 'unchanged' ELSE 'updated' END AS action
FROM o FULL OUTER JOIN n ON o.pdf_name = n.pdf_name"""


def _link_sql() -> str:
    s = synth
    return f"""(
WITH pk AS (SELECT s_suppkey AS pkey, {s.PARK_KEY} AS id, {s.PARK_MILLESIME} AS millesime, {s.PARK_SURF} AS surf_parc, {s.PARK_X0} AS x0,
                   {s.PARK_Y0} AS y0, {s.PARK_W} AS w, {s.PARK_H} AS h, {s.PARK_L} AS is_l, {s.PARK_SRID} AS srid FROM supplier),
pieces AS (
  SELECT pkey, srid, x0 AS px0, y0 AS py0, x0 + w AS px1, CASE WHEN is_l THEN y0 + h / 2 ELSE y0 + h END AS py1 FROM pk
  UNION ALL SELECT pkey, srid, x0, y0 + h / 2, x0 + w / 2, y0 + h FROM pk WHERE is_l),
cv AS (SELECT p_partkey AS ck, {s.COVER_ID} AS id_1, {s.COVER_MILLESIME} AS millesime_ocs, {s.CODE_US} AS code_us,
              {s.COVER_X0} AS ox0, {s.COVER_Y0} AS oy0, {s.COVER_W} AS w, {s.COVER_H} AS h, {s.COVER_HOLE} AS hole, {s.COVER_SRID} AS srid FROM part),
cv2 AS (SELECT *, ox0 + w AS ox1, oy0 + h AS oy1, ox0 + w / 4 AS hx0, oy0 + h / 4 AS hy0, ox0 + w - w / 4 AS hx1,
               oy0 + h - h / 4 AS hy1, w * h - CASE WHEN hole THEN (w / 2) * (h / 2) ELSE 0 END AS ocs_geom_area FROM cv),
pp AS (
  SELECT q.pkey, c.ck,
    greatest(0, least(q.px1, c.ox1) - greatest(q.px0, c.ox0)) * greatest(0, least(q.py1, c.oy1) - greatest(q.py0, c.oy0))
    - CASE WHEN c.hole THEN greatest(0, least(q.px1, c.hx1) - greatest(q.px0, c.hx0)) * greatest(0, least(q.py1, c.hy1) - greatest(q.py0, c.hy0)) ELSE 0 END AS a,
    (q.px0 <= c.ox1 AND c.ox0 <= q.px1 AND q.py0 <= c.oy1 AND c.oy0 <= q.py1)
      AND NOT (c.hole AND c.hx0 < q.px0 AND q.px1 < c.hx1 AND c.hy0 < q.py0 AND q.py1 < c.hy1) AS hit
  FROM pieces q JOIN cv2 c ON q.srid = c.srid AND q.px0 <= c.ox1 AND c.ox0 <= q.px1 AND q.py0 <= c.oy1 AND c.oy0 <= q.py1),
m AS (SELECT pkey, ck, sum(a) AS geom_intersection_area FROM pp GROUP BY pkey, ck HAVING bool_or(hit))
SELECT pk.id, c.id_1, pk.millesime, c.millesime_ocs, c.code_us, pk.surf_parc,
  pk.w * pk.h - CASE WHEN pk.is_l THEN (pk.w / 2) * (pk.h / 2) ELSE 0 END AS project_geom_area,
  c.ocs_geom_area, m.geom_intersection_area
FROM pk LEFT JOIN m ON pk.pkey = m.pkey LEFT JOIN cv2 c ON m.ck = c.ck)"""


def park_cover_link() -> str:
    return f"""SELECT id, id_1, millesime, millesime_ocs, code_us, round(project_geom_area, 6) AS project_geom_area,
  round(ocs_geom_area, 6) AS ocs_geom_area, round(geom_intersection_area, 6) AS geom_intersection_area FROM {_link_sql()}"""


def _latest_sql() -> str:
    return f"""(SELECT * EXCLUDE (_top, _n_top) FROM (
  SELECT *, count(CASE WHEN millesime_ocs = _top THEN 1 END) OVER (PARTITION BY id, id_1) AS _n_top
  FROM (SELECT *, max(millesime_ocs) OVER (PARTITION BY id, id_1) AS _top
        FROM {_link_sql()} WHERE millesime > millesime_ocs OR id_1 IS NULL))
 WHERE id_1 IS NULL OR (millesime_ocs = _top AND _n_top = 1))"""


def vintage_latest() -> str:
    return f"SELECT id, id_1, millesime_ocs, round(geom_intersection_area, 6) AS geom_intersection_area FROM {_latest_sql()}"


def has_cover() -> str:
    return f"""SELECT has_ocs, count(*) AS count FROM (SELECT id, count(id_1) > 0 AS has_ocs FROM {_latest_sql()} GROUP BY id)
GROUP BY has_ocs"""


def area_check() -> str:
    return f"""
SELECT id, num_lines, num_unique_ocs_tiles, il AS insee_com_list, CAST(na AS INTEGER) AS n_ocs_areas, round(sa, 6) AS ocs_areas, round(surf_parc, 6) AS surf_parc, round(project_geom_area, 6) AS project_geom_area,
  round(gia, 6) AS geom_intersection_area, round((surf_parc - gia) / surf_parc, 6) AS area_error,
  round(CASE WHEN project_geom_area = 0 THEN NULL ELSE (project_geom_area - gia) / project_geom_area END, 6) AS area_geom_error
FROM (SELECT id, max(surf_parc) AS surf_parc, max(project_geom_area) AS project_geom_area, count(*) AS num_lines,
             array_to_string(list_transform(range(count(*)), lambda i: CAST(id % 30 AS VARCHAR)), ',') AS il,
             count(ocs_geom_area) AS na, coalesce(sum(ocs_geom_area), 0.0) AS sa,
             count(DISTINCT id_1) + max(CASE WHEN id_1 IS NULL THEN 1 ELSE 0 END) AS num_unique_ocs_tiles,
             coalesce(sum(geom_intersection_area), 0.0) AS gia FROM {_latest_sql()} GROUP BY id)"""


def usage_shares() -> str:
    from terrasol.operators.cover import CODES_US_MAPPING, NO_MATCH, UNKNOWN_CODE
    rec = "CASE code_us " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in CODES_US_MAPPING.items()) + " ELSE code_us END"
    return f"""
WITH f AS (SELECT id, coalesce(code_us, {_q(UNKNOWN_CODE)}) AS code_us, geom_intersection_area AS a, project_geom_area FROM {_latest_sql()}),
u AS (SELECT id, code_us, coalesce(sum(a), 0.0) AS surface FROM f GROUP BY id, code_us
      UNION ALL SELECT id, {_q(NO_MATCH)}, max(project_geom_area) - coalesce(sum(a), 0.0) FROM f GROUP BY id),
b AS (SELECT code_us, sum(surface) AS surface FROM u GROUP BY code_us)
SELECT {rec} AS code_us, round(surface, 6) AS surface, round(100 * surface / (SELECT sum(surface) FROM b), 6) AS pct_surface FROM b"""


def geojson_export() -> str:
    from terrasol.operators.cover import CODES_US_COLORS, CODES_US_MAPPING
    case = lambda d, other: "CASE code_us " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in d.items()) + f" ELSE {_q(other)} END"
    shared = "'Surface partagée : ' || CAST(round(geom_intersection_area, 2) AS VARCHAR) || 'm^2'"
    return f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id_1 NULLS FIRST, millesime) AS _rn FROM {_latest_sql()})
SELECT 'MultiPolygon' AS kind, id_1 || ' | ' || {case(CODES_US_MAPPING, 'Inconnu')} || ' - ' || {shared} AS popup,
       {case(CODES_US_COLORS, '#b15928')} AS color, round(geom_intersection_area, 4) AS area FROM l WHERE id_1 IS NOT NULL
UNION ALL
SELECT 'Polygon', CAST(id AS VARCHAR) || ' | Surface totale : ' || CAST(round(surf_parc, 2) AS VARCHAR) || ' - ' || coalesce({shared}, ''),
       '#f39c12', round(project_geom_area, 4) FROM l WHERE _rn = 1"""


def polygon_area_centroid() -> str:
    s = synth
    return f"""
WITH pk AS (SELECT {s.PARK_KEY} AS id, {s.PARK_X0} AS x0, {s.PARK_Y0} AS y0, {s.PARK_W} AS w, {s.PARK_H} AS h, {s.PARK_L} AS is_l FROM supplier)
SELECT id,
  round(CASE WHEN is_l THEN w * (h / 2) + (w / 2) * (h / 2) ELSE w * h END, 6) AS area,
  round(CASE WHEN is_l THEN (w * (h / 2) * (x0 + w / 2) + (w / 2) * (h / 2) * (x0 + w / 4)) / (w * (h / 2) + (w / 2) * (h / 2))
        ELSE x0 + w / 2 END, 6) AS cx,
  round(CASE WHEN is_l THEN (w * (h / 2) * (y0 + h / 4) + (w / 2) * (h / 2) * (y0 + 3 * h / 4)) / (w * (h / 2) + (w / 2) * (h / 2))
        ELSE y0 + h / 2 END, 6) AS cy
FROM pk"""


def crs_project() -> str:
    import math
    from terrasol.functions import geo as G
    from terrasol.operators.parks import DEFAULT_CRS, TERRITORY_CRS
    e2 = G._e2()
    e = math.sqrt(e2)
    p = G.LCC_2154
    rad = math.pi / 180

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = p["lat1"] * rad, p["lat2"] * rad, p["lat0"] * rad
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    bf = m(p1) / (n * t(p1) ** n)
    r0 = G.GRS80_A * bf * t(p0) ** n
    phi = f"(lat * {rad!r})"
    es = f"({e!r} * sin({phi}))"
    r = f"({G.GRS80_A * bf!r} * pow(tan({math.pi / 4!r} - {phi} / 2) / pow((1 - {es}) / (1 + {es}), {e / 2!r}), {n!r}))"
    theta = f"({n!r} * (lon - {p['lon0']!r}) * {rad!r})"
    lx = f"({p['fe']!r} + {r} * sin({theta}))"
    ly = f"({p['fn'] + r0!r} - {r} * cos({theta}))"
    ep2 = e2 / (1 - e2)
    e4, e6 = e2 * e2, e2 * e2 * e2

    def utm(code):
        lon0, fn = G.UTM[code]
        lam = f"((lon - {lon0!r}) * {rad!r})"
        nu = f"({G.GRS80_A!r} / sqrt(1 - {e2!r} * sin({phi}) * sin({phi})))"
        tt = f"(tan({phi}) * tan({phi}))"
        c = f"({ep2!r} * cos({phi}) * cos({phi}))"
        a = f"(cos({phi}) * {lam})"
        mer = (f"({G.GRS80_A!r} * ({1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256!r} * {phi} - {3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024!r} * sin(2 * {phi})"
               f" + {15 * e4 / 256 + 45 * e6 / 1024!r} * sin(4 * {phi}) - {35 * e6 / 3072!r} * sin(6 * {phi})))")
        x = (f"({G.UTM_K0!r} * {nu} * ({a} + (1 - {tt} + {c}) * pow({a}, 3) / 6 + (5 - 18 * {tt} + {tt} * {tt} + 72 * {c} - 58 * {ep2!r}) * pow({a}, 5) / 120))")
        y = (f"({G.UTM_K0!r} * ({mer} + {nu} * tan({phi}) * ({a} * {a} / 2 + (5 - {tt} + 9 * {c} + 4 * {c} * {c}) * pow({a}, 4) / 24"
             f" + (61 - 58 * {tt} + {tt} * {tt} + 600 * {c} - 330 * {ep2!r}) * pow({a}, 6) / 720)))")
        return f"({G.UTM_FE!r} + {x})", f"({fn!r} + {y})"

    xs = f"CASE WHEN srid = 2154 THEN {lx} " + " ".join(f"WHEN srid = {c} THEN {utm(c)[0]}" for c in G.UTM) + " END"
    ys = f"CASE WHEN srid = 2154 THEN {ly} " + " ".join(f"WHEN srid = {c} THEN {utm(c)[1]}" for c in G.UTM) + " END"
    whens = " ".join(
        "WHEN list_bool_or(list_transform(codes, lambda s: " + " OR ".join(f"starts_with(s, '{q}')" for q in prefixes)
        + f")) THEN {srid}" for prefixes, srid in TERRITORY_CRS)
    return f"""
WITH c AS (SELECT c_custkey, {synth.POINT_LON} AS lon, {synth.POINT_LAT} AS lat,
                  string_split({synth.TERRITORY_CODES}, ', ') AS codes FROM customer),
d AS (SELECT *, CASE {whens} ELSE {DEFAULT_CRS} END AS srid FROM c)
SELECT c_custkey, srid, round({xs}, 3) AS x, round({ys}, 3) AS y FROM d"""


def _dbscan_sql(min_samples: int) -> str:
    hv = ("2 * 6371.0088 * asin(sqrt(least(pow(sin((b.lat - a.lat) * pi() / 180 / 2), 2) + cos(a.lat * pi() / 180) * "
          "cos(b.lat * pi() / 180) * pow(sin((b.lon - a.lon) * pi() / 180 / 2), 2), 1.0)))")
    return f"""
WITH RECURSIVE p AS (SELECT c_custkey AS id, {synth.SITE_LAT} AS lat, {synth.SITE_LON} AS lon FROM customer),
e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id <> b.id AND abs(a.lat - b.lat) < 0.02 WHERE {hv} <= 1.0),
deg AS (SELECT p.id, 1 + count(e.b) AS degree FROM p LEFT JOIN e ON p.id = e.a GROUP BY p.id),
core AS (SELECT id FROM deg WHERE degree >= {min_samples}),
ce AS (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(src, dst) AS (SELECT id, id FROM core UNION SELECT r.src, ce.b FROM reach r JOIN ce ON r.dst = ce.a),
comp AS (SELECT src AS id, min(dst) AS root FROM reach GROUP BY src),
lab AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS label FROM comp),
border AS (SELECT e.a AS id, min(lab.label) AS label FROM e JOIN lab ON e.b = lab.id WHERE e.a NOT IN (SELECT id FROM core) GROUP BY e.a)
SELECT p.id, CAST(coalesce(lab.label, border.label, -1) AS BIGINT) AS labels
FROM p LEFT JOIN lab ON p.id = lab.id LEFT JOIN border ON p.id = border.id"""


def dbscan_parks() -> str:
    return _dbscan_sql(2)


def dbscan_geodesic() -> str:
    # no two sites are within 0.6 % of 1 km, so spherical and ellipsoidal distances agree on every pair
    return _dbscan_sql(3)


def incremental_ingest() -> str:
    body = _clean_text(synth.MEASURE_BODY)
    return f"""
WITH _src AS (SELECT doc_id, {body} AS pdf_text FROM documents),
{_section_ctes('_src', 'pdf_text')}
SELECT doc_id, CAST(length(pdf_text) AS INTEGER) AS n_chars_clean,
  coalesce({_surface('section')}, {_surface('pdf_text')}) AS land_surface_ha,
  coalesce({_power('section')}, {_power('pdf_text')}) AS power_mwc
FROM _s"""


# The land-type rules, spelled out: a phrase per row, longest first among those that begin alike.
_RULES = {
    "surfaces_naturelles": ["friches?  carrières?", "friches?  gravières?", "friches?  ferroviaires?", "friches?  routières?", "friches?  mines?",
                            "znieffs?", "naturas?  2000", "friches?  militaires?", "friches?  activités  de  gestions?  de  déchets",
                            "friches?  aéroportuaires?"],
    "surfaces_artificialisees": ["friches?  industrielles?", "friches?  tertiaires?", "friches?  commerciales?", "friches?  portuaires?",
                                 "friches?  agros?  industrielles?", "carrières?  en  exploitations?"],
    "surfaces_forestieres": ["résineuxs?", "monospécifiques?", "plantations?", "landes  des  landes", "spontanées?"],
    "surfaces_agricoles": ["friches?", "en  exploitations?", "prairies?  permanentes?", "cultures?  intensives?", "arboricultures?", "vignes?"],
}


def _rule_matches(text: str) -> str:
    every = sorted((p for ps in _RULES.values() for p in ps), key=lambda p: -len(p.split()))
    return (f"regexp_extract_all('  ' || regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || '  ', "
            f"{_q(' (' + '|'.join(every) + ') ')}, 1)")


def _rule_hits(k: str, m: str = "_m") -> str:
    return " + ".join(f"CASE WHEN len(list_filter({m}, lambda x: regexp_full_match(x, {_q(p)}))) > 0 THEN 1 ELSE 0 END" for p in _RULES[k])


def arena_report() -> str:
    from terrasol.operators.evaluate import LABELS
    parts = []
    for model_id, hits in (("rules-1", 1), ("rules-2", 2), ("rules-3", 3)):
        cols = [f"CAST({synth.TRUTH[k]} AS INTEGER) AS {k}, least(1.0, ({_rule_hits(k)}) / {float(hits)!r}) AS {k}_score" for k in LABELS]
        pred = (f"(SELECT doc_id, {', '.join(cols)} FROM (SELECT *, {_rule_matches(f'({synth.ARENA_TEXT})')} AS _m FROM {_LABELLED}))")
        parts.append(f"SELECT *, {_q(model_id)} AS model_id FROM ({_report_sql(pred)})")
    return "\nUNION ALL\n".join(parts)


def claim_sessions_stream() -> str:
    return claim_sessions()


def file_inventory() -> str:
    return "SELECT 'documents.parquet' AS file_name, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS text_chars FROM documents"


def resumed_ingest() -> str:
    return incremental_ingest()


def resumed_scoring() -> str:
    cols = ", ".join(f"least(1.0, ({_rule_hits(k)}) / 2.0) AS {k}_score" for k in _RULES)
    return f"""
SELECT doc_id, {cols}, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 2 END AS run
FROM (SELECT doc_id, {_rule_matches(f'({synth.ARENA_TEXT})')} AS _m FROM documents)"""


def wkb_round_trip() -> str:
    s = synth
    return f"""
SELECT cell, CAST(count(*) AS INTEGER) AS n_polygons, round(sum(a), 6) AS area FROM (
  SELECT {s.PARK_KEY} AS cell, w * h - CASE WHEN is_l THEN (w / 2) * (h / 2) ELSE 0 END AS a
  FROM (SELECT s_suppkey, {s.PARK_W} AS w, {s.PARK_H} AS h, {s.PARK_L} AS is_l FROM supplier)
  UNION ALL
  SELECT CAST(floor(floor(p_partkey / 2) / 10) AS BIGINT), w * h - CASE WHEN hole THEN (w / 2) * (h / 2) ELSE 0 END
  FROM (SELECT p_partkey, {s.COVER_W} AS w, {s.COVER_H} AS h, {s.COVER_HOLE} AS hole FROM part))
GROUP BY cell"""


def typed_projection() -> str:
    return "SELECT * REPLACE (CAST(p_retailprice AS DECIMAL(18,3)) AS p_retailprice) FROM part"


def multi_hot_array() -> str:
    return multi_hot()


def labelled_texts() -> str:
    return "SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n_text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"


def validated_facet() -> str:
    return f"""
SELECT pdf_name, validated_by, validated_at FROM {_ann_cte()} a
JOIN (SELECT user_id % 7 AS u, max(ts) AS validated_at FROM events GROUP BY 1) l ON a.doc_id % 7 = l.u
WHERE is_validated AND validated_at >= TIMESTAMP '2024-01-01' AND validated_at < TIMESTAMP '2024-01-31'"""


def attempt_outcomes() -> str:
    return f"""
SELECT count(*) AS total, count(*) FILTER (WHERE action = 'skip') AS skipped,
       count(*) FILTER (WHERE action = 'download' AND o.fn IS NOT NULL) AS success,
       count(*) FILTER (WHERE action = 'download' AND o.fn IS NULL) AS failed
FROM {_plan_sql()} p LEFT JOIN (SELECT DISTINCT 'avis_' || cast(l_orderkey AS string) || '.pdf' AS fn FROM lineitem
                                WHERE l_linenumber <= 2 AND l_suppkey % 3 = 0) o ON p.pdf_filename = o.fn"""


def layers_round_trip() -> str:
    return "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority"


def scored_runs() -> str:
    return f"""
SELECT m.model_id, 'run' || CAST(doc_id % 3 AS VARCHAR) AS run_ts, count(*) AS n, round(avg(surfaces_naturelles_score), 9) AS mean_score
FROM {_pred_cte()}, (VALUES ('rules-1'), ('rules-2'), ('rules-3')) m(model_id) GROUP BY ALL"""


def listing_blocks() -> str:
    t = f"regexp_replace(({synth.TITLE}), ' +', ' ', 'g')"
    return f"""
WITH d AS (SELECT doc_id, {t} AS t, CAST(doc_id AS VARCHAR) AS k FROM documents),
b AS (SELECT *, t || ' Projet ' || k || ' Avis' || CASE WHEN doc_id % 3 = 0 THEN ' Annexe' ELSE '' END AS txt FROM d)
SELECT doc_id AS page_id, t AS heading, txt AS block_text, 0 AS link_pos, '/avis/' || k || '.pdf' AS href, 'Avis' AS label FROM b
UNION ALL SELECT doc_id, t, txt, 1, '/annexe/' || k || '.pdf', 'Annexe' FROM b WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 'Bloc ' || CAST(doc_id % 10 AS VARCHAR), 'Bloc ' || CAST(doc_id % 10 AS VARCHAR), NULL, NULL, NULL FROM b"""


def next_pages() -> str:
    return "SELECT doc_id AS page_id, '?page=' || CAST(doc_id + 1 AS VARCHAR) AS next_href FROM documents"


def heading_blocks() -> str:
    t = f"regexp_replace(({synth.TITLE}), ' +', ' ', 'g')"
    return f"""
SELECT doc_id AS page_id, {t} AS section, 'Projet ' || CAST(doc_id AS VARCHAR) AS block_text, '/avis/' || CAST(doc_id AS VARCHAR) || '.pdf' AS next_link FROM documents
UNION ALL SELECT doc_id, {t}, 'entre', NULL FROM documents"""


def card_details() -> str:
    return """SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN '/d/' || CAST(doc_id AS VARCHAR) || '.PDF' END AS pdf_href,
  CASE WHEN doc_id % 4 <> 0 THEN 'Avis ' || CAST(doc_id AS VARCHAR) END AS pdf_label FROM documents"""


def table_rows() -> str:
    return f"""SELECT doc_id AS page_id, 'Commune ' || CAST(doc_id % 25 AS VARCHAR) AS project_name, '/t/' || CAST(doc_id AS VARCHAR) || '.pdf' AS pdf_href,
  CAST(strptime({synth.SLASH_DATE}, '%d/%m/%Y') AS DATE) AS publish_date FROM documents"""


def dated_paragraphs() -> str:
    return f"""
SELECT doc_id AS page_id, true AS ok, 'Parc solaire ' || CAST(doc_id AS VARCHAR) AS title, {_french_date(synth.FRENCH_DATE)} AS publish_date,
       'Parc solaire ' || CAST(doc_id AS VARCHAR) || '.pdf' AS pdf_filename FROM documents
UNION ALL SELECT doc_id, false, NULL, NULL, NULL FROM documents"""


def offset_pages() -> str:
    return """
WITH d AS (SELECT 'https://www.example.org/l?q=' || CAST(doc_id AS VARCHAR) AS base_url, n_chars % 60 AS n FROM documents),
e AS (SELECT base_url, CAST(unnest(range(10, n, 10)) AS INTEGER) AS start FROM d)
SELECT base_url, start, base_url || '&start=' || CAST(start AS VARCHAR) AS page_url FROM e"""


def detail_records() -> str:
    return """
SELECT 'Avis ' || CAST(doc_id AS VARCHAR) AS title, CASE WHEN doc_id % 5 <> 0 THEN '/f/' || CAST(doc_id AS VARCHAR) || '.pdf' END AS pdf_url,
       CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS VARCHAR) END AS document_id FROM documents WHERE doc_id % 2 = 0"""


def text_classifier() -> str:
    return f"""
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test, true AS measured
FROM ({chunks()}) c JOIN (
  SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id)
                           <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY quality)) THEN 'test' ELSE 'train' END AS split
  FROM {_LABELLED}) s ON c.doc_id = s.doc_id"""


def embedding_classifier() -> str:
    return """
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test, true AS measured
FROM (SELECT CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), vec_id)
                       <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM embeddings)"""


def dot_segments() -> str:
    # the results of the references, stated for the last two directories of an address
    return """
WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin,
                  coalesce(nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^(.*/)', 1), ''), '/') AS dir FROM pages),
d AS (SELECT page_id, origin, dir, CASE WHEN dir = '/' THEN '/' ELSE regexp_replace(dir, '[^/]*/$', '') END AS up FROM p)
SELECT page_id, 0 AS pos, origin || up || 'z.pdf' AS abs_url FROM d
UNION ALL SELECT page_id, 1, origin || dir || 'b.pdf' FROM d
UNION ALL SELECT page_id, 2, origin || '/x/z.pdf?q=../r' FROM d
UNION ALL SELECT page_id, 3, origin || CASE WHEN len(string_split(dir, '/')) > 5 THEN regexp_replace(dir, '([^/]*/){3}$', '') ELSE '/' END || 'up.pdf' FROM d
UNION ALL SELECT page_id, 4, origin || dir || 'a/' FROM d
UNION ALL SELECT page_id, 5, origin || dir || 'plain.pdf' FROM d
UNION ALL SELECT page_id, 6, origin || '/p/q/' FROM d"""


def csv_roundtrip() -> str:
    return f"SELECT * FROM ({synth.GAZETTEER_NATION} UNION ALL {synth.GAZETTEER_REGION})"


def event_props() -> str:
    return """SELECT event_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k, max(k) AS max_k
FROM (SELECT event_type, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM events)
GROUP BY event_type"""


def annotation_search() -> str:
    ctx = f"string_split({_clean_text(synth.CONTEXT)}, '[SEP]')"
    return f"""SELECT pdf_name FROM (SELECT {synth.PDF_NAME} AS pdf_name, CAST(quality AS BOOLEAN) AS is_validated,
  {ctx} AS contexts FROM {_LABELLED})
WHERE (contains(lower(pdf_name), 'th') OR list_bool_or(list_transform(contexts, lambda c: contains(lower(c), 'th'))))
  AND coalesce(is_validated, false)"""


def user_contributions() -> str:
    return f"""SELECT validated_by, n_validated,
  round(CASE WHEN sum(n_validated) OVER () = 0 THEN 0.0 ELSE CAST(n_validated AS DOUBLE) / sum(n_validated) OVER () END * 100, 9)
    AS contribution_pct
FROM (SELECT validated_by, count(*) AS n_validated FROM {_ann_cte()} WHERE is_validated GROUP BY validated_by)"""


def download_labels() -> str:
    pat = _q(T.DOWNLOAD_LABEL)
    return f"""
SELECT c_custkey,
  CASE WHEN regexp_matches(label, {pat}) THEN regexp_extract(label, {pat}, 1) END AS code,
  CASE WHEN regexp_matches(label, {pat}) THEN {_strip(f"regexp_extract(label, {pat}, 2)")} END AS name,
  CASE WHEN regexp_matches(label, {pat}) THEN regexp_extract(label, {pat}, 3) END AS year,
  starts_with(href, 'https://data.example.org/ocs/') AND NOT contains(href, 'DIFF') AS is_download
FROM (SELECT c_custkey, {synth.DOWNLOAD_LINK_LABEL} AS label, {synth.DOWNLOAD_LINK_HREF} AS href FROM customer)"""


_K = "CAST(doc_id AS VARCHAR)"
_SITE = "'https://www.example.org/'"
_SOLAR = "n_chars % 3 <> 2"
_WORD_OF = "CASE n_chars % 3 WHEN 0 THEN 'photovoltaïque' WHEN 1 THEN 'SOLAIRE' ELSE 'éolien' END"


def framed_projects() -> str:
    return f"""
SELECT doc_id AS page_id, 'Parcno' AS project_name,
  'parc no ' || CASE n_chars % 3 WHEN 0 THEN 'photovoltaique' ELSE 'solaire' END || ' de ' || {_K} || ' avis pdf' AS description,
  {_SITE} || 'mrae/pdf/avis-' || {_K} || '.pdf' AS pdf_url, 'avis-' || {_K} || '.pdf' AS pdf_filename
FROM documents WHERE {_SOLAR} AND n_chars % 5 <> 0
UNION ALL
SELECT doc_id, 'Sans titre', 'centrale solaire & ombrières ' || {_K} || ' pdf', {_SITE} || 'f/' || {_K} || '.pdf?v=1', {_K} || '.pdf?v=1' FROM documents"""


def nested_table_rows() -> str:
    date = f"CAST(strptime({synth.SLASH_DATE}, '%d/%m/%Y') AS DATE)"
    return f"""
WITH l AS (
  SELECT doc_id, n_chars, {date} AS d, 't' || {_K} || '.PDF' AS f, {_SITE} || 'guadeloupe/docs/t' || {_K} || '.PDF' AS u FROM documents
  UNION ALL SELECT doc_id, n_chars, NULL, {_K} || '.pdf', {_SITE} || 'annexe/' || {_K} || '.pdf' FROM documents)
SELECT doc_id AS page_id, 'Parc de ' || {_K} AS project_name, d AS publish_date_scraped, f AS pdf_filename, u AS pdf_url FROM l WHERE {_SOLAR}
UNION ALL SELECT doc_id, 'Rien', d, f, u FROM l WHERE n_chars % 4 = 0"""


def year_pages() -> str:
    return f"""
WITH p AS (SELECT doc_id, doc_id - doc_id % 4 AS o FROM documents WHERE doc_id - doc_id % 4 IN (SELECT doc_id FROM documents))
SELECT {_SITE} || 'region/' || CAST(o AS VARCHAR) AS origin, CAST(doc_id - o AS INTEGER) AS hop, CAST(2010 + doc_id % 9 AS VARCHAR) AS year,
  {_SITE} || 'an/' || {_K} AS year_url FROM p
UNION ALL SELECT {_SITE} || 'region/' || CAST(o AS VARCHAR), CAST(doc_id - o AS INTEGER), NULL, {_SITE} || 'region/' || {_K} || '?p=' || {_K} FROM p"""


def crawl_chains() -> str:
    return f"""
WITH RECURSIVE e AS (
  SELECT doc_id AS a, CASE WHEN doc_id % 3 < 2 THEN doc_id + 1 WHEN n_chars % 2 = 0 THEN doc_id - 2 END AS b FROM documents),
r AS (
  SELECT doc_id AS o, doc_id AS x, 0 AS hop FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT o, b, hop + 1 FROM r JOIN e ON e.a = r.x WHERE b IS NOT NULL AND hop < 5)
SELECT {_SITE} || 'liste/' || CAST(o AS VARCHAR) AS origin, {_SITE} || 'liste/' || CAST(x AS VARCHAR) AS url, min(hop) AS hop FROM r GROUP BY o, x"""


def card_documents() -> str:
    day = "make_date(2012 + doc_id % 9, doc_id % 12 + 1, doc_id % 28 + 1)"
    return f"""
SELECT {_SITE} || 'liste/' || CAST(doc_id - doc_id % 3 AS VARCHAR) AS origin, 'Projet ' || {_WORD_OF} || ' ' || {_K} AS project_name, '973' AS departement_code,
  CASE WHEN doc_id % 5 <> 0 THEN {day} END AS publish_date_scraped,
  CASE WHEN doc_id % 5 <> 0 AND n_chars % 7 <> 0 THEN 'Avis_no_' || {_K} || '.pdf' END AS pdf_filename,
  CASE WHEN doc_id % 5 <> 0 AND n_chars % 7 <> 0 THEN {_SITE} || 'fiche/files/' || {_K} || '.pdf' END AS pdf_url
FROM documents WHERE {_SOLAR} AND doc_id - doc_id % 3 IN (SELECT doc_id FROM documents)"""


def hop_paragraphs() -> str:
    return f"""
SELECT doc_id AS page_id, true AS ok, 'Parc solaire de Lieu ' || {_K} AS project_name, {_french_date(synth.FRENCH_DATE)} AS publish_date_scraped,
  'parc_solaire_de_lieu_' || {_K} || '.pdf' AS pdf_filename,
  CASE WHEN n_chars % 2 = 0 THEN {_SITE} || 'direct/' || {_K} || '.pdf'
       WHEN n_chars % 3 <> 0 THEN {_SITE} || 'somme/doc/h' || {_K} || '.pdf' END AS pdf_url FROM documents
UNION ALL SELECT doc_id, false, NULL, NULL, NULL, NULL FROM documents"""


def result_blocks() -> str:
    return f"""
SELECT doc_id AS page_id, CASE n_chars % 3 WHEN 0 THEN 'Avis' ELSE 'Décision cas par CAS' END || {_K} AS project_name,
  CASE WHEN n_chars % 5 <> 0 THEN {_french_date(synth.FRENCH_DATE)} END AS publish_date_scraped,
  'Lille|Lens ' || {_K} AS communes_names_scraped, {_K} || '.pdf' AS pdf_filename, {_SITE} || 'r/' || {_K} || '.pdf' AS pdf_url
FROM documents WHERE {_SOLAR}"""


def notices() -> str:
    return f"""
SELECT doc_id AS page_id, 'Avis  ' || {_K} AS project_name, CASE WHEN n_chars % 3 <> 0 THEN 'DREAL ' || {_K} END AS author, 'MRAe' AS publisher,
  CAST(strptime({synth.SLASH_DATE}, '%d/%m/%Y') AS DATE) AS publish_date_scraped, CAST(doc_id * 7 AS VARCHAR) AS document_id
FROM documents WHERE n_chars % 4 <> 0"""


def headed_documents() -> str:
    return f"""
SELECT doc_id AS page_id, 'Parc ' || {_WORD_OF} || ' ' || {_K} AS project_name, 'Commune ' || {_K} AS commune_name_scraped, CAST(2010 + doc_id % 9 AS VARCHAR) AS year_scraped,
  {_SITE} || 'b/' || {_K} || '.pdf' AS pdf_url, {_K} || '.pdf' AS pdf_filename FROM documents WHERE {_SOLAR}
UNION ALL SELECT doc_id, 'Centrale solaire', 'Autre', CAST(2010 + doc_id % 9 AS VARCHAR), {_SITE} || 'bretagne/c/' || {_K} || '.pdf?x=1.pdf', {_K} || '.pdf?x=1.pdf' FROM documents"""


def harvest_sources() -> str:
    cols = ("communes_names_scraped", "commune_name_scraped", "departement_code", "description", "pdf_filename", "pdf_url", "project_name",
            "publish_date_scraped", "year_scraped")
    side = f"SELECT project_name, publish_date_scraped, '/' || document_id || '.pdf' AS pdf_url FROM ({notices()})"
    parts = {"MRAE": framed_projects(), "Bretagne": headed_documents(), "Guyane": card_documents(), "Guadeloupe": nested_table_rows(),
             "Somme": f"SELECT * FROM ({hop_paragraphs()}) WHERE ok", "Nord-Pas-de-Calais": result_blocks(), "SIDE": side}
    given = {"MRAE": (3, 4, 5, 6), "Bretagne": (1, 4, 5, 6, 8), "Guyane": (2, 4, 5, 6, 7), "Guadeloupe": (4, 5, 6, 7), "Somme": (4, 5, 6, 7),
             "Nord-Pas-de-Calais": (0, 4, 5, 6, 7), "SIDE": (5, 6, 7)}
    kind = lambda c: "DATE" if c == "publish_date_scraped" else "VARCHAR"
    return " UNION ALL ".join(
        "SELECT " + ", ".join(c if k in given[site] else f"CAST(NULL AS {kind(c)}) AS {c}" for k, c in enumerate(cols)) + f", '{site}' AS site FROM ({sql})"
        for site, sql in parts.items())


def packed_predictions() -> str:
    rows = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS label, {synth.SCORE[k]} AS score, coalesce({synth.SCORE[k]} > 0.5, false) AS pred FROM {_LABELLED}" for k in synth.TRUTH)
    return f"SELECT doc_id, label, round(score, 9) AS score, pred FROM ({rows})"


def label_counts() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{k}' AS label, CAST({synth.TRUTH[k]} AS INTEGER) AS y, CASE WHEN {synth.SCORE[k]} > 0.5 THEN 1 ELSE 0 END AS p FROM {_LABELLED}" for k in synth.TRUTH)
    cell = lambda y, p, n: f"count(*) FILTER (WHERE y = {y} AND p = {p}) AS {n}"
    return f"SELECT label, {cell(1, 1, 'tp')}, {cell(0, 1, 'fp')}, {cell(1, 0, 'fn')}, {cell(0, 0, 'tn')} FROM ({rows}) GROUP BY label"


def document_links() -> str:
    return f"""SELECT page_id, link_pos, title, href FROM (
  SELECT page_id, link_pos, CASE WHEN link_pos % 5 = 1 THEN 'Avis publiés' ELSE anchor_text END AS title, CASE WHEN link_pos % 7 = 3 THEN NULL ELSE href END AS href
  FROM {_links_cte()}) WHERE href IS NOT NULL AND (title IS NULL OR title <> 'Avis publiés')"""


def table_modes() -> str:
    n = "SELECT count(*) FROM orders"
    return f"""
SELECT 'error' AS mode, ({n}) AS n, false AS refused UNION ALL SELECT 'error again', ({n}), true
UNION ALL SELECT 'ignore', ({n}), false UNION ALL SELECT 'overwrite', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), false"""


def binary_inventory() -> str:
    return """
SELECT count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size, CAST(max(size) AS BIGINT) AS largest
FROM (SELECT lang, sum(length(CAST(doc_id AS VARCHAR)) + 1) AS size FROM documents GROUP BY lang)"""


def years_ascending() -> str:
    return f"SELECT row_number() OVER (ORDER BY year) AS place, year, n_documents FROM (SELECT {synth.YEAR} AS year, count(*) AS n_documents FROM documents GROUP BY 1)"


def span_rejects() -> str:
    return f"""
SELECT pdf_name, ctx_pos, CASE WHEN start < 0 THEN 'span not found' ELSE 'located' END AS outcome, CASE WHEN start >= 0 THEN start END AS start, length
FROM ({dataset_build()})"""


def crs_round_trip() -> str:
    return f"SELECT c_custkey, round({synth.POINT_LON}, 6) AS lon, round({synth.POINT_LAT}, 6) AS lat FROM customer"


def site_clusters() -> str:
    point = "'POINT (' || printf('%.5f', lon) || ' ' || printf('%.5f', lat) || ')'"
    return f"""
SELECT s.id, {point} AS centroid, d.labels FROM ({_dbscan_sql(2)}) d
JOIN (SELECT c_custkey AS id, {synth.SITE_LAT} AS lat, {synth.SITE_LON} AS lon FROM customer) s ON s.id = d.id"""


def profile_increments() -> str:
    return """
SELECT 'l_extendedprice' AS column_name, count(l_extendedprice) AS count, CAST(min(l_extendedprice) AS DOUBLE) AS min, CAST(max(l_extendedprice) AS DOUBLE) AS max,
  true AS distinct_within, true AS quartiles_within FROM lineitem
UNION ALL SELECT 'l_quantity', count(l_quantity), CAST(min(l_quantity) AS DOUBLE), CAST(max(l_quantity) AS DOUBLE), true, true FROM lineitem
UNION ALL SELECT 'l_orderkey', count(l_orderkey), CAST(min(l_orderkey) AS DOUBLE), CAST(max(l_orderkey) AS DOUBLE), true, true FROM lineitem
UNION ALL SELECT 'l_returnflag', count(l_returnflag), NULL, NULL, true, NULL FROM lineitem"""


def plugin_scores() -> str:
    cols = ", ".join(f"CASE WHEN fits THEN least(1.0, ({_rule_hits(k)}) / 2.0) END AS {k}_score" for k in _RULES)
    n = "floor(length(t) / pow(2.0, k))::INTEGER"
    return f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN NULL ELSE {synth.ARENA_TEXT} END AS t FROM documents),
c AS (SELECT doc_id, t, list_filter(list_transform(range(0, 41), lambda k: {{'n': {n}, 'tokens': len({_tokens(f'substring(t, 1, {n})')})}}), lambda s: s.tokens + 1000 <= 1400)[1].n AS n FROM d),
f AS (SELECT doc_id, t IS NOT NULL AS fits, substring(t, 1, n) AS kept, n FROM c),
m AS (SELECT *, {_rule_matches('kept')} AS _m FROM f)
SELECT doc_id, {cols}, CASE WHEN fits THEN n END AS scored_chars, CASE WHEN NOT fits THEN 'no text within the budget' END AS error FROM m"""
