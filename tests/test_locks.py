import datetime as dt
import random

from pyspark.sql import functions as F

from terrasol.operators import locks
from terrasol.streaming import locks as stream
from terrasol.streaming.ingest import work_dir

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "doc_id long, user_id long, ts timestamp_ntz, event_id long, action string"


def brute(rows):
    """The rule, event by event and document by document."""
    out, docs = [], {}
    for d, u, t, i, a in sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[2], r[3])):
        lock = docs.setdefault(d, {"by": None, "at": None, "done": False})
        if lock["by"] is not None and t - lock["at"] >= dt.timedelta(hours=1):
            out.append((d, lock["by"], lock["at"] + dt.timedelta(hours=1), None, "timeout", "expired"))
            lock["by"] = None
        if lock["done"]:
            o = "refused"
        elif a == "claim":
            o = "refused" if lock["by"] not in (None, u) else "granted" if lock["by"] is None else "refreshed"
            if o != "refused":
                lock.update(by=u, at=t)
        elif lock["by"] != u:
            o = "refused"
        else:
            o = "released" if a == "release" else "validated"
            lock.update(by=None, done=a == "validate")
        out.append((d, u, t, i, a, o))
    out += [(d, lock["by"], lock["at"] + dt.timedelta(hours=1), None, "timeout", "expired") for d, lock in docs.items() if lock["by"] is not None]
    return key(out)


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def events(n=600, docs=6, users=4, seed=5):
    rng = random.Random(seed)
    t, rows = T0, []
    for i in range(n):
        t += dt.timedelta(minutes=rng.choice([0, 1, 5, 20, 59, 60, 61, 200]) / docs)
        rows.append((rng.randrange(docs), rng.randrange(users), t, i, rng.choices(["claim", "release", "validate"], [30, 5, 1])[0]))
    return rows


def test_batch_equals_the_rule_event_by_event(spark):
    rows = events()
    rows += [(None, 1, T0, 900, "claim"), (1, None, T0, 901, "claim"), (1, 1, None, 902, "claim")]
    got = locks.lock_life_cycle(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert key(got) == brute(rows)
    assert {r["outcome"] for r in got} == set(locks.OUTCOMES)


def test_two_users_never_hold_one_document(spark):
    a, b = (lambda m, u: (1, u, T0 + dt.timedelta(minutes=m), m, "claim")), None
    rows = [a(0, 7), a(30, 8), a(59, 7), a(118, 8), a(119, 8), a(121, 7)]
    got = locks.lock_life_cycle(spark.createDataFrame(rows, SCHEMA))
    assert [r["outcome"] for r in got.where("event_id is not null").orderBy("event_id").collect()] == ["granted", "refused", "refreshed", "refused", "granted", "refused"]
    n = {r["user_id"]: r for r in locks.claims_of(got).collect()}
    assert (n[8]["n_refused"], n[8]["n_granted"], n[7]["n_expired"]) == (2, 1, 1) and b is None


def test_empty_events_and_plain_timestamps(spark):
    assert locks.lock_life_cycle(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = events(80)
    plain = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    got = locks.lock_life_cycle(plain).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert key(got.collect()) == brute(rows)


def test_stream_equals_batch_whatever_the_files(spark):
    rows = events(300)
    src = work_dir(spark, "lock-events")
    for k in range(3):   # three files in order of arrival, each unordered inside
        part = rows[k * 100:(k + 1) * 100]
        random.Random(k).shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{src}/{k}")
    got = stream.run_locks(spark, f"{src}/*", "*.parquet", ["doc_id", "user_id", "ts", "event_id", "action"], max_files_per_trigger=1)
    assert key(got.collect()) == brute(rows)
