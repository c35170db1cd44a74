"""The state machines of operators/state.py as stateful streams, and stream-side deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.state import Incident, Outbox, Retry


def _apply(events: DataFrame, machine, act, output: str, state: str) -> DataFrame:
    """Runs a machine per key; state survives between micro-batches in the state store."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        own = machine(*group.get) if group.exists else machine()
        for b in batches:
            rows = [act(own, e) for e in b.sort_values(["ts", "event_id"]).to_dict("records")]
            if rows:
                yield pd.DataFrame(rows)
        group.update(tuple(own.__dict__.values()))

    return events.groupBy("key").applyInPandasWithState(run, output, state, "append", GroupStateTimeout.NoTimeout)


def incidents(events: DataFrame) -> DataFrame:
    """(key, event_id, action) from a stream of (key, event_id, ts, status, signature)."""

    def act(s: Incident, e: dict) -> dict:
        return {"key": e["key"], "event_id": e["event_id"], "action": s.step(e["ts"].to_pydatetime(), e["status"], e["signature"])}

    return _apply(events, Incident, act, "key string, event_id bigint, action string", "signature string, last_alert timestamp, run_signature string, run_length int, run_since timestamp")


def outbox(events: DataFrame) -> DataFrame:
    """(key, event_id, status, attempts) from a stream of (key, event_id, ts, event)."""

    def act(s: Outbox, e: dict) -> dict:
        s.step(e["ts"].to_pydatetime(), e["event"])
        return {"key": e["key"], "event_id": e["event_id"], "status": s.status, "attempts": s.attempts}

    return _apply(events, Outbox, act, "key string, event_id bigint, status string, attempts int", "status string, attempts int, next_attempt timestamp")


def retries(events: DataFrame) -> DataFrame:
    """(key, event_id, status, failures) from a stream of (key, event_id, ts, event)."""

    def act(s: Retry, e: dict) -> dict:
        s.step(e["ts"].to_pydatetime(), e["event"])
        return {"key": e["key"], "event_id": e["event_id"], "status": s.status, "failures": s.failures}

    return _apply(events, Retry, act, "key string, event_id bigint, status string, failures int", "status string, failures int, next_retry timestamp")


def new_files(files: DataFrame, lateness: str = "1 day") -> DataFrame:
    """The first file of each content hash; hashes older than the watermark are forgotten."""
    return files.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["sha"])


def quiet_windows(files: DataFrame, gap: str = "15 minutes", lateness: str = "1 hour") -> DataFrame:
    """(key, start, end, files): windows of arrivals that closed after a gap without any."""
    w = F.session_window("ts", gap)
    return files.withWatermark("ts", lateness).groupBy("key", w).count().select("key", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), F.col("count").alias("files"))


def publish_once(stream: DataFrame, path: str, checkpoint: str):
    """Starts an idempotent sink: a micro-batch that comes again replaces its own folder."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
