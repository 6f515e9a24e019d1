"""K2: the life-cycle of document locks, as an ordered fold over claim events.

A user claims a document, releases it or validates it.  A claim is granted when no
one holds the lock, refreshes the user's own lock, and is refused while another user
holds it; a lock that is not refreshed for 60 minutes expires; a validated document
cannot be claimed again; releasing and validating need the lock.  The same rule
(:func:`advance`) drives the batch fold here and the stream in
:mod:`terrasol.streaming.locks`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.operators.annotate import LOCK_TIMEOUT_MINUTES

TIMEOUT_US = LOCK_TIMEOUT_MINUTES * 60_000_000
CLAIM, RELEASE, VALIDATE, TIMEOUT = "claim", "release", "validate", "timeout"
OUTCOMES = ("granted", "refreshed", "refused", "released", "validated", "expired")


class Lock(NamedTuple):
    """Who holds a document since when (microseconds), and whether it is validated."""

    holder: object = None
    at: int = 0
    validated: bool = False


def expire(lock: Lock, now: int) -> tuple[Lock, tuple | None]:
    """The lock at a moment, and (time, holder) if it has run out by then."""
    if lock.holder is not None and now - lock.at >= TIMEOUT_US:
        return lock._replace(holder=None), (lock.at + TIMEOUT_US, lock.holder)
    return lock, None


def advance(lock: Lock, us: int, user: object, action: str) -> tuple[Lock, str]:
    """The lock after an event, and the event's outcome (expiry is applied before)."""
    if lock.validated:
        return lock, "refused"
    if action == CLAIM:
        if lock.holder is None:
            return Lock(user, us), "granted"
        return (Lock(user, us), "refreshed") if lock.holder == user else (lock, "refused")
    if lock.holder is None or lock.holder != user:
        return lock, "refused"
    return (Lock(), "released") if action == RELEASE else (Lock(validated=True), "validated")


def micros(ts: str, dtype: str) -> Column:
    """Microseconds since 1970 of a timestamp column (wall-clock values as they stand)."""
    if dtype == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(ts)


def from_micros(us: str, dtype: str) -> Column:
    if dtype == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST({us} / 1000000BD AS DECIMAL(18, 6)))")
    return F.timestamp_micros(us)


def episodes(events: DataFrame, key: str, us: str, order: list[str], gap: int = TIMEOUT_US) -> DataFrame:
    """Events with ``_episode``: the time of the first event after a pause of ``gap`` on their key.

    No lock outlives such a pause, so episodes are folded apart.  Pauses are found
    inside (key, hour) groups; a second step over one row per group looks across
    their borders, so no window spans a hot key's events.
    """
    rows = events.withColumn("_hour", F.floor(F.col(us) / 3_600_000_000))
    inside = Window.partitionBy(key, "_hour").orderBy(us, *order)
    across = Window.partitionBy(key).orderBy("_hour")
    hours = rows.groupBy(key, "_hour").agg(F.max(us).alias("_last"))
    hours = hours.select(key, "_hour", F.lag("_last").over(across).alias("_before"))
    rows = rows.withColumn("_prev", F.lag(us).over(inside)).join(hours, [key, "_hour"])
    since = F.col(us) - F.coalesce("_prev", "_before")
    rows = rows.withColumn("_opens", F.when(since.isNull() | (since >= gap), F.col(us))).drop("_prev", "_before")
    opened = rows.groupBy(key, "_hour").agg(F.max("_opens").alias("_opened"))
    opened = opened.select(key, "_hour", F.last("_opened", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    here = F.max("_opens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_here", here).join(opened, [key, "_hour"])
    return rows.withColumn("_episode", F.coalesce("_here", "_carried")).drop("_hour", "_opens", "_here", "_carried")


def lock_life_cycle(events: DataFrame, key: str = "doc_id", user: str = "user_id", ts: str = "ts", action: str = "action",
                    event_id: str = "event_id") -> DataFrame:
    """Every event with its outcome, and a row (action ``timeout``, outcome ``expired``) per lock that ran out.

    Events of one time go by ``event_id``.  Rows without a document, user or time are
    no claims and are left out.  The fold streams through sorted partitions with one
    lock in memory; an episode is one sequence by nature, everything else is spread.
    Validation outlasts episodes: what follows a document's first one is refused in a
    second step.
    """
    dtype = dict(events.dtypes)[ts]
    rows = events.where(F.col(key).isNotNull() & F.col(user).isNotNull() & F.col(ts).isNotNull())
    rows = rows.select(F.col(key).alias("k"), F.col(user).alias("u"), micros(ts, dtype).alias("us"), F.col(action).alias("action"), F.col(event_id).alias("id"))
    parts = episodes(rows, "k", "us", ["id"]).repartition("k", "_episode").sortWithinPartitions("k", "_episode", "us", "id")
    schema = rows.select("k", "u", "us", "action", "id", F.lit("").alias("outcome")).schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lock, at = Lock(), None
        types, out = None, []

        def ran_out(gone):
            if gone:
                out.append((at[0], gone[1], gone[0], TIMEOUT, None, "expired"))

        def flush():
            cols = list(zip(*out)) or [[]] * 6
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["k", "u", "us", "action", "id", "outcome"])
            out.clear()
            return batch

        for b in batches:
            types = types or [b.schema.field(c).type for c in ("k", "u", "us", "action", "id")] + [pa.string()]
            for k, u, us, act, i, episode in zip(*(b.column(c).to_pylist() for c in ("k", "u", "us", "action", "id", "_episode"))):
                if at != (k, episode):
                    ran_out(at and expire(lock, lock.at + TIMEOUT_US)[1])
                    lock, at = Lock(), (k, episode)
                lock, gone = expire(lock, us)
                ran_out(gone)
                lock, outcome = advance(lock, us, u, act)
                out.append((k, u, us, act, i, outcome))
            yield flush()
        if at:
            ran_out(expire(lock, lock.at + TIMEOUT_US)[1])
            yield flush()

    done = parts.mapInArrow(fold, schema)
    first = done.where(F.col("outcome") == "validated").groupBy("k").agg(F.min(F.struct("us", "id")).alias("v"))
    done = done.join(first, "k", "left")
    later = F.coalesce(F.struct("us", F.coalesce("id", F.lit(0).cast(schema["id"].dataType)).alias("id")) > F.col("v"), F.lit(False))
    done = done.where(~(later & (F.col("outcome") == "expired"))).withColumn("outcome", F.when(later, "refused").otherwise(F.col("outcome")))
    return done.select(F.col("k").alias(key), F.col("u").alias(user), from_micros("us", dtype).alias(ts), F.col("id").alias(event_id), F.col("action").alias(action), "outcome")


def claims_of(outcomes: DataFrame, key: str = "doc_id", user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Refused and granted claims per document and user (what competing users met)."""
    n = lambda o: F.count_if(F.col("outcome") == o).alias(f"n_{o}")
    return outcomes.groupBy(key, user).agg(*map(n, OUTCOMES), F.min(F.when(F.col("outcome") == "granted", F.col(ts))).alias("first_granted"))
