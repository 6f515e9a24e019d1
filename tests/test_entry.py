import __spark_entry__ as E

from conftest import SF


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pdf_name", "year", "region", "project_type", "nom_commune", "dept",
                          "land_surface_ha", "power_mwc", "longitude", "latitude"]
    assert df.count() > 0


def test_stream_ingest_equals_batch(spark):
    q = E.queries()
    batch = {r.doc_id: (r.land_surface_ha, r.power_mwc) for r in q["doc_measures"](spark, SF).collect()}
    clean = {r.doc_id: (r.land_surface_ha, r.power_mwc) for r in q["incremental_ingest"](spark, SF).collect()}
    again = {r.doc_id: (r.land_surface_ha, r.power_mwc) for r in q["resumed_ingest"](spark, SF).collect()}
    assert clean == again and clean.keys() == batch.keys()
    assert sum(clean[d] != batch[d] for d in batch) < 0.1 * len(batch)   # cleaning may move a section's bounds


def test_stream_claims_equal_batch(spark):
    q = E.queries()
    key = lambda r: (r.doc_id, r.user_id, r.claim_start, r.last_refresh, r.n_events)
    s = sorted(key(r) for r in q["claim_sessions_stream"](spark, SF).collect())
    assert s and s == sorted(key(r) for r in q["claim_sessions"](spark, SF).collect())
