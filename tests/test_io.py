import struct

import pandas as pd
from pyspark.sql import functions as F

from terrasol.functions import geo
from terrasol.sources import io
from terrasol.streaming.ingest import work_dir


def test_csv_bad_records_and_string_codes(spark):
    path = work_dir(spark, "csv-test")
    spark.sparkContext.parallelize(["nom_commune,code_departement,longitude",
                                    " Ajaccio ,2A,8.7", "Bastia,2B,not-a-number"], 1).saveAsTextFile(path)
    df = io.read_csv(spark, path, "nom_commune string, code_departement string, longitude double", bad_records=True)
    got = sorted((r.nom_commune, r.code_departement, r.longitude, r._corrupt_record is not None) for r in df.collect())
    assert got == [(" Ajaccio ", "2A", 8.7, False), ("Bastia", "2B", None, True)]


def test_layers_filename_and_idempotent_reload(spark):
    path = work_dir(spark, "layers")
    df = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, millesime int")
    io.write_layers(df, path, "millesime")
    io.write_layers(df, path, "millesime")          # re-run: replaced, not appended
    back = io.read_layers(spark, path)
    assert back.count() == 2
    assert all(r.filename.startswith("part-") for r in back.select("filename").collect())


def test_wkb_polygon_decode():
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 0.0)]
    wkb = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    out = geo.decode_wkb_polygons(pd.Series([wkb, None]))
    assert out[0] == [[[{"x": x, "y": y} for x, y in ring]]] and out[1] is None


def test_wkb_multipolygon_round_trip(spark):
    square = lambda x, y, n: [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y))]
    polys = [[[square(0, 0, 9), square(1, 1, 2)], [square(20, 0, 3)], [square(30, 5, 1)]], [[square(1, 2, 3)]], [], None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(polys)], "id int, g array<array<array<struct<x:double,y:double>>>>")
    back = df.withColumn("b", geo.polygons_from_wkb(geo.wkb_from_polygons("g"))).orderBy("id").collect()
    assert [r.b for r in back] == [r.g for r in back] and len(back[0].b) == 3


def test_wkb_big_endian_with_z():
    z = struct.pack(">BII", 0, 1003, 1) + struct.pack(">I", 2) + struct.pack(">6d", 1, 2, 9, 3, 4, 9)
    multi = struct.pack(">BII", 0, 1006, 2) + z + z
    assert geo.decode_wkb_polygons(pd.Series([multi]))[0] == [[[{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}]]] * 2


def stored(spark, target):
    from terrasol.streaming import ingest
    return sorted((r.k, r.v) for r in ingest.stored_rows(spark, target, "k").collect())


def test_streams_read_a_table_that_is_a_folder_of_files(spark):
    import datetime as dt
    from terrasol.streaming import claims, ingest, locks
    base = work_dir(spark, "folder-tables")
    docs = spark.createDataFrame([(i, f"parc de {i + 1} ha") for i in range(4)], "doc_id long, text string")
    docs.repartition(2).write.parquet(f"{base}/documents.parquet")
    got = ingest.ingest_documents(spark, base, "documents.parquet", buckets=2, partitions=2)
    assert sorted((r.doc_id, r.land_surface_ha) for r in got.collect()) == [(i, i + 1.0) for i in range(4)]
    again = ingest.ingest_documents(spark, f"{base}/documents.parquet", "*.parquet", buckets=2, partitions=2)   # the same files, named one by one
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))
    events = spark.createDataFrame([(k, 1, 1, dt.datetime(2024, 1, 1, 10, k), "claim") for k in range(2)], "event_id long, doc_id long, user_id long, ts timestamp, action string")
    events.repartition(2).write.parquet(f"{base}/events.parquet")
    assert claims.run_claims(spark, base, "events.parquet", ["doc_id", "user_id", "ts"]).agg(F.sum("n_events")).first()[0] == 2
    assert locks.run_locks(spark, base, "events.parquet", ["doc_id", "user_id", "ts", "event_id", "action"]).count() > 0


def test_ingest_measures_a_batch_once(spark):
    from terrasol.streaming import ingest
    seen = spark.sparkContext.accumulator(0)

    def measured(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    batch = spark.range(20).selectExpr("id AS k", "1 AS v").mapInArrow(measured, "k long, v int")
    target = work_dir(spark, "ingest-once")
    ingest.upsert_batch(target, "k", buckets=4)(batch, 0)
    assert seen.value == 20 and stored(spark, target) == [(k, 1) for k in range(20)]
    assert not batch.is_cached


def test_ingest_read_error_keeps_stored_rows(spark, monkeypatch):
    import pytest
    from terrasol.streaming import ingest
    target = work_dir(spark, "ingest-error")
    run = ingest.upsert_batch(target, "k", buckets=4, order=("v",))
    run(spark.createDataFrame([(i, 0) for i in range(20)], "k int, v int"), 0)
    run(spark.createDataFrame([(3, 1), (3, 5), (3, 2), (40, 1)], "k int, v int"), 1)
    rows = sorted([(i, 0) for i in range(20) if i != 3] + [(3, 5), (40, 1)])
    assert stored(spark, target) == rows

    batch = spark.createDataFrame([(1, 9)], "k int, v int")
    monkeypatch.setattr(type(spark), "read", property(lambda self: (_ for _ in ()).throw(OSError("store is away"))))
    with pytest.raises(OSError):
        run(batch, 2)
    monkeypatch.undo()
    assert stored(spark, target) == rows


def test_an_older_row_never_replaces_a_newer_one(spark):
    from terrasol.streaming import ingest
    target = work_dir(spark, "ingest-order")
    run = ingest.upsert_batch(target, "k", buckets=4, order=("v",))
    for n, batch in enumerate([[(1, 9), (None, 1)], [(1, 2), (2, 1)], [(None, 5), (None, 3)], [(2, 4), (2, 3)], []]):
        run(spark.createDataFrame(batch, "k int, v int"), n)
    got = ingest.stored_rows(spark, target, "k").collect()
    assert sorted((r.k or 0, r.v) for r in got) == [(0, 5), (1, 9), (2, 4)]
    unordered = ingest.upsert_batch(work_dir(spark, "ingest-arrival"), "k", buckets=4)
    assert unordered  # without order columns the later batch wins: test_stream_ingest_upserts_across_batches


def test_a_failure_at_any_point_loses_nothing_and_replays(spark, monkeypatch):
    import pytest
    from terrasol.sources.snapshots import SnapshotTable
    table = SnapshotTable(spark, work_dir(spark, "snapshots"), "k", buckets=4, order=("v",))
    batch = lambda rows: spark.createDataFrame(rows, "k int, v int")
    assert table.merge(batch([(i, 0) for i in range(20)]), 0)
    before = sorted(map(tuple, table.read().collect()))
    monkeypatch.setattr(SnapshotTable, "_swap", lambda *a: (_ for _ in ()).throw(OSError("lost between data and manifest")))
    with pytest.raises(OSError):
        table.merge(batch([(3, 7), (50, 1)]), 1)
    monkeypatch.undo()
    assert sorted(map(tuple, table.read().collect())) == before
    assert table.merge(batch([(3, 7), (50, 1)]), 1)          # the replay
    after = sorted(map(tuple, table.read().collect()))
    assert after == sorted([(i, 0) for i in range(20) if i != 3] + [(3, 7), (50, 1)])
    assert not table.merge(batch([(3, 99)]), 1)               # a batch id is taken in once
    assert sorted(map(tuple, table.read().collect())) == after
    assert sorted(map(tuple, table.read(table.versions()[0]).collect())) == before
    for n in range(2, 6):
        table.merge(batch([(n, n)]), n)
    assert len(table.versions()) == 2 and sum(1 for _ in table.read().collect()) == 21


def test_rejects_are_written_once_per_batch(spark):
    from terrasol.sources.snapshots import RejectTable
    from terrasol.streaming.ingest import ingest_documents
    src, bad = work_dir(spark, "reject-src"), work_dir(spark, "rejects")
    spark.createDataFrame([(1, "parc de 3 ha"), (None, "sans clef"), (2, " "), (3, None)], "doc_id long, text string").write.parquet(src + "/a")
    good = ingest_documents(spark, src + "/*", "*.parquet", rejects=bad)
    assert [r.doc_id for r in good.collect()] == [1]
    got = sorted((r.doc_id or 0, r._reason) for r in RejectTable(spark, bad).read().collect())
    assert got == [(0, "no key"), (2, "no text"), (3, "no text")]


def test_ingest_resumes_with_the_same_folders(spark):
    from terrasol.streaming.ingest import ingest_documents
    src, target, ckpt = (work_dir(spark, n) for n in ("resume-src", "resume-target", "resume-ckpt"))
    spark.createDataFrame([(1, "parc de 3 ha"), (2, "rien")], "doc_id long, text string").coalesce(1).write.parquet(src + "/a")
    ingest_documents(spark, src + "/*", "*.parquet", target=target, checkpoint=ckpt)
    spark.createDataFrame([(2, "parc de 5 ha"), (3, "4 MWc")], "doc_id long, text string").coalesce(1).write.parquet(src + "/b")
    out = ingest_documents(spark, src + "/*", "*.parquet", target=target, checkpoint=ckpt)
    assert {r.doc_id: (r.land_surface_ha, r.power_mwc) for r in out.collect()} == {1: (3.0, None), 2: (5.0, None), 3: (None, 4.0)}


def test_stream_ingest_upserts_across_batches(spark):
    import time
    from terrasol.streaming.ingest import ingest_documents
    src = work_dir(spark, "ingest-src")
    first = spark.createDataFrame([(1, "parc de 3 ha"), (2, "parc de 4 ha"), (3, "rien")], "doc_id long, text string")
    first.coalesce(1).write.parquet(src + "/batch1")
    time.sleep(1.1)                                  # later modification time → later micro-batch
    second = spark.createDataFrame([(2, "parc de 9 ha"), (4, "12 MWc")], "doc_id long, text string")
    second.coalesce(1).write.parquet(src + "/batch2")
    out = ingest_documents(spark, src + "/*", "*.parquet", key="doc_id", max_files_per_trigger=1)
    got = {r.doc_id: (r.land_surface_ha, r.power_mwc) for r in out.collect()}
    assert got == {1: (3.0, None), 2: (9.0, None), 3: (None, None), 4: (None, 12.0)}
