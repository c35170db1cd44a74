"""State machines: transitions, batch replay, and the same as streams."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import state
from tidemark.streaming import machines

T0 = datetime(2024, 1, 1)


def run(machine, *steps):
    return [machine.step(T0 + timedelta(minutes=m), *rest) for m, *rest in steps]


def test_incident_suppresses_and_reminds():
    own = run(state.Incident(), (0, "failed", "a"), (60, "failed", "a"), (240, "failed", "a"), (250, "success", ""), (251, "success", ""))
    assert own == ["alert", "suppressed", "alert", "recovery", "silent"]


def test_another_signature_alerts_at_once():
    assert run(state.Incident(), (0, "failed", "a"), (1, "failed", "b")) == ["alert", "alert"]


def test_transient_states_escalate_by_count_or_time():
    assert run(state.Incident(), (0, "busy", "w"), (1, "busy", "w"), (2, "busy", "w")) == ["routine", "alert", "suppressed"]
    assert run(state.Incident(), (0, "busy", "w"), (1, "success", ""), (2, "busy", "w")) == ["routine", "silent", "routine"]


def test_outbox_dies_after_the_fourth_failure():
    own = run(state.Outbox(), (0, "enqueue"), (1, "failed"), (2, "failed"), (3, "failed"), (4, "failed"), (5, "delivered"))
    assert own == ["pending"] * 4 + ["dead_letter"] * 2
    box = state.Outbox()
    run(box, (0, "enqueue"), (1, "failed"))
    assert box.next_attempt == T0 + timedelta(minutes=6)
    assert run(state.Outbox(), (0, "enqueue"), (1, "supersede"), (2, "delivered")) == ["pending", "superseded", "superseded"]


def test_retry_schedule():
    own = state.Retry()
    assert run(own, (0, "failed"), (10, "failed")) == ["retry_pending"] * 2
    assert own.next_retry == T0 + timedelta(minutes=20)
    assert run(own, (30, "failed"), (60, "failed"), (61, "resolved"), (62, "failed")) == ["retry_pending", "retry_exhausted", "resolved", "retry_pending"]


EVENTS = [(k, i * 3 + n, T0 + timedelta(minutes=30 * i), ["failed", "busy", "success"][(i * 7 + n) % 3], f"s{(i + n) % 2}") for n, k in enumerate("abc") for i in range(20)]


def expected():
    out = set()
    for k in "abc":
        m = state.Incident()
        for _, e, ts, status, sig in sorted((x for x in EVENTS if x[0] == k), key=lambda x: (x[2], x[1])):
            out.add((k, e, m.step(ts, status, sig)))
    return out


def test_replay_in_batch(spark):
    df = spark.createDataFrame(EVENTS, "key string, event_id long, ts timestamp, status string, signature string").repartition(5)
    own = state.replay(df, ["key"], ["ts", "event_id"], "key string, event_id bigint, action string", state.incident_step)
    assert {tuple(r) for r in own.collect()} == expected()
    assert state.replay(df.where("false"), ["key"], ["ts"], "key string, event_id bigint, action string", state.incident_step).count() == 0


def stream(spark, tmp_path, rows, schema, parts=2):
    """The rows as a file stream that arrives in several micro-batches, in order of time."""
    src = tmp_path / "in"
    rows = sorted(rows, key=lambda r: r[2])
    for i in range(parts):
        own = rows[len(rows) * i // parts : len(rows) * (i + 1) // parts]
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(src))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))


def collected(spark, df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.read.parquet(out).collect()


def test_incidents_as_a_stream(spark, tmp_path):
    schema = "key string, event_id long, ts timestamp, status string, signature string"
    own = collected(spark, machines.incidents(stream(spark, tmp_path, EVENTS, schema)), tmp_path)
    assert {(r.key, r.event_id, r.action) for r in own} == expected()


def test_new_files_as_a_stream(spark, tmp_path):
    rows = [(f"p{i}", f"sha{i % 4}", T0 + timedelta(minutes=i)) for i in range(12)]
    own = collected(spark, machines.new_files(stream(spark, tmp_path, rows, "path string, sha string, ts timestamp")), tmp_path)
    assert sorted(r.sha for r in own) == ["sha0", "sha1", "sha2", "sha3"]


def test_quiet_windows_close_after_the_gap(spark, tmp_path):
    at = [0, 5, 12, 60, 61, 500]
    rows = [("k", i, T0 + timedelta(minutes=m)) for i, m in enumerate(at)]
    own = collected(spark, machines.quiet_windows(stream(spark, tmp_path, rows, "key string, event_id int, ts timestamp")), tmp_path)
    assert sorted(r.files for r in own) == [2, 3]  # the last one is still open


def test_publish_once_is_idempotent(spark, tmp_path):
    rows = [("k", i, T0 + timedelta(minutes=i)) for i in range(6)]
    s = stream(spark, tmp_path, rows, "key string, event_id int, ts timestamp")
    for _ in range(2):
        machines.publish_once(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).select(F.countDistinct("event_id"), F.count("*")).first()[:] == (6, 6)


def test_null_and_nan_keys_keep_their_state(spark):
    rows = [(k, i, T0 + timedelta(minutes=i), "failed", "a") for i, k in enumerate([None, 1, None, 1, None])]
    for kind, extra in (("long", []), ("double", [(float("nan"), 10 + i, T0 + timedelta(minutes=i), "failed", "a") for i in range(3)])):
        df = spark.createDataFrame([(None if k is None else k * 1.0 if kind == "double" else k, *rest) for k, *rest in rows] + extra, f"key {kind}, event_id long, ts timestamp, status string, signature string").repartition(3)
        own = state.replay(df, ["key"], ["ts", "event_id"], f"key {kind}, event_id long, action string", state.incident_step).collect()
        got = {r.event_id: r.action for r in own}
        assert [got[i] for i in range(5)] == ["alert", "alert", "suppressed", "suppressed", "suppressed"]
        assert [got[10 + i] for i in range(len(extra))] == ["alert", "suppressed", "suppressed"][: len(extra)]


def test_retry_ledger_equals_the_machine(spark):
    r = random.Random(1)
    rows = [(r.choice([None, 1, 2, 3]), i, T0 + timedelta(minutes=r.randrange(60)), r.choice(["failed", "failed", "failed", "resolved", "other", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "key long, event_id long, ts timestamp, event string").repartition(4)
    own = {x.event_id: (x.status, x.failures, x.next_retry) for x in state.retry_ledger(df, ["key"], ["ts", "event_id"]).collect()}
    for k in (None, 1, 2, 3):
        m = state.Retry()
        for _, e, ts, event in sorted((x for x in rows if x[0] == k), key=lambda x: (x[2], x[1])):
            m.step(ts, event)
            assert own[e] == (m.status, m.failures, m.next_retry)
