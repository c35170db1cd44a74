"""State machines, replayed in batch per key and run as streams by streaming/.

The transition functions are plain Python on one key's events in order; both
the batch replay and the stateful stream call them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

TRANSIENT = ("busy", "waiting", "paused")


@dataclass
class Incident:
    """One key's open incident and its run of transient states."""

    signature: str | None = None
    last_alert: datetime | None = None
    run_signature: str | None = None
    run_length: int = 0
    run_since: datetime | None = None

    def step(self, ts: datetime, status: str, signature: str, remind: timedelta = timedelta(hours=4), runs: int = 2, wait: timedelta = timedelta(minutes=60)) -> str:
        """What a result of this status brings: alert, recovery, or silence of some kind."""
        if status in TRANSIENT:
            if self.run_signature == signature:
                self.run_length += 1
            else:
                self.run_signature, self.run_length, self.run_since = signature, 1, ts
            if self.run_length < runs and ts - self.run_since < wait:
                return "routine"
        else:
            self.run_signature, self.run_length, self.run_since = None, 0, None
        if status == "success":
            was, self.signature = self.signature, None
            alerted, self.last_alert = self.last_alert, None
            return "recovery" if was is not None and alerted is not None else "silent"
        if self.signature == signature and self.last_alert is not None and ts - self.last_alert < remind:
            return "suppressed"
        self.signature, self.last_alert = signature, ts
        return "alert"


@dataclass
class Outbox:
    """A message's delivery: pending, sent, superseded or dead after the fourth failure."""

    status: str = "new"
    attempts: int = 0
    next_attempt: datetime | None = None

    def step(self, ts: datetime, event: str, delays: tuple[int, ...] = (5, 10, 20)) -> str:
        if event == "enqueue" and self.status == "new":
            self.status = "pending"
        elif event == "supersede" and self.status == "pending":
            self.status, self.next_attempt = "superseded", None
        elif event == "delivered" and self.status == "pending":
            self.status, self.next_attempt = "sent", None
        elif event == "failed" and self.status == "pending":
            self.attempts += 1
            if self.attempts > len(delays):
                self.status, self.next_attempt = "dead_letter", None
            else:
                self.next_attempt = ts + timedelta(minutes=delays[self.attempts - 1])
        return self.status


@dataclass
class Retry:
    """A stage's failures: pending with a delay, exhausted at the fourth, or resolved."""

    status: str = "none"
    failures: int = 0
    next_retry: datetime | None = None

    def step(self, ts: datetime, event: str, most: int = 4, delays: tuple[int, ...] = (5, 10, 20)) -> str:
        if event == "resolved":
            self.status, self.failures, self.next_retry = "resolved", 0, None
        elif event == "failed":
            self.failures += 1
            if self.failures >= most:
                self.status, self.next_retry = "retry_exhausted", None
            else:
                self.status, self.next_retry = "retry_pending", ts + timedelta(minutes=delays[min(self.failures, len(delays)) - 1])
        return self.status


def _comparable(key: tuple) -> tuple:
    """A key that equals itself: nulls are None, and a number that is none is a text."""
    return tuple("NaN" if isinstance(v, float) and v != v else v for v in key)


def replay(events: DataFrame, keys: list[str], order: list[str], schema: str, step: Callable[[dict, dict | None], tuple[dict, dict | None]]) -> DataFrame:
    """Each key's events in order, step((event), state) giving an output row and the next state.

    Keys are shuffled and sorted, and each partition is read as a stream with the
    state of one key at a time; so a key of any length needs no more memory
    than a batch. Null keys are one key, like any other.
    """
    columns = events.columns
    output = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        import pyarrow as pa

        at, state = None, None
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                event = dict(zip(columns, row))
                key = _comparable(tuple(event[k] for k in keys))
                if key != at:
                    at, state = key, None
                result, state = step(event, state)
                out.append(result)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=output)

    return events.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def retry_ledger(events: DataFrame, keys: list[str], order: list[str], most: int = 4, delays: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """events (ts, event, ...) with status, failures and next_retry after each: what Retry.step gives, by running sums.

    Failures count from the last resolution on; any other event changes nothing.
    """
    own = Window.partitionBy(*keys).orderBy(*order)
    since = Window.partitionBy(*keys, "__resolved").orderBy(*order)
    failed = F.coalesce(F.col("event") == "failed", F.lit(False))
    rows = events.withColumn("__resolved", F.sum(F.coalesce(F.col("event") == "resolved", F.lit(False)).cast("int")).over(own))
    rows = rows.withColumn("failures", F.sum(failed.cast("int")).over(since).cast("int")).withColumn("__last", F.last(F.when(failed, F.col("ts")), ignorenulls=True).over(since))
    n = F.col("failures")
    status = F.when(n >= most, "retry_exhausted").when(n > 0, "retry_pending").when(F.col("__resolved") > 0, "resolved").otherwise("none")
    delay = F.element_at(F.array(*map(F.lit, delays)), F.least(F.greatest(n, F.lit(1)), F.lit(len(delays))))
    due = F.when((n > 0) & (n < most), F.col("__last") + F.make_dt_interval(mins=delay))
    return rows.withColumn("status", status).withColumn("next_retry", due).drop("__resolved", "__last")


def incident_step(event: dict, state: dict | None) -> tuple[dict, dict]:
    """For replay: events of (key, event_id, ts, status, signature)."""
    s = Incident(**state) if state else Incident()
    action = s.step(event["ts"], event["status"], event["signature"])
    return {"key": event["key"], "event_id": event["event_id"], "action": action}, asdict(s)


def outbox_step(event: dict, state: dict | None) -> tuple[dict, dict]:
    s = Outbox(**state) if state else Outbox()
    s.step(event["ts"], event["event"])
    return {"key": event["key"], "event_id": event["event_id"], "status": s.status, "attempts": s.attempts, "next_attempt": s.next_attempt}, asdict(s)
