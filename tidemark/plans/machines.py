"""Retry, incident and outbox machines over events, replayed per user; sessions and staleness."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import state
from .base import query, table

AS_OF = "2024-01-31 00:00:00"


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type = 'error'),
    l AS (SELECT user_id, ts + to_minutes(CASE WHEN value < 30 THEN 5 WHEN value < 60 THEN 1440 ELSE 4320 END) AS due, value >= 90 AS exhausted FROM r WHERE k = 1)
    SELECT u.user_id, CASE WHEN l.user_id IS NULL THEN 'eligible' WHEN exhausted THEN 'exhausted' WHEN due <= TIMESTAMP '{AS_OF}' THEN 'eligible' ELSE 'deferred' END AS state FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN l USING (user_id)""")
def retry_eligible_split(spark, sf):
    e = table(spark, sf, "events")
    last = e.where("event_type = 'error'").groupBy("user_id").agg(F.max_by(F.struct("ts", "value"), F.struct("ts", "event_id")).alias("l"))
    delay = F.expr("make_dt_interval(0, 0, case when l.value < 30 then 5 when l.value < 60 then 1440 else 4320 end, 0)")
    last = last.select("user_id", (F.col("l.ts") + delay).alias("due"), (F.col("l.value") >= 90).alias("exhausted"), F.lit(True).alias("there"))
    own = e.select("user_id").distinct().join(last, "user_id", "left")
    late = F.col("due") <= F.expr(f"timestamp_ntz'{AS_OF}'")
    return own.select("user_id", F.when(F.col("there").isNull(), "eligible").when(F.col("exhausted"), "exhausted").when(late, "eligible").otherwise("deferred").alias("state"))


@query("""WITH p AS (SELECT * FROM events WHERE event_type IN ('view', 'purchase') AND value > 40), d AS (SELECT DISTINCT user_id FROM p WHERE event_type = 'purchase' AND value > 80)
    SELECT event_id, user_id, event_type FROM p WHERE event_type = 'purchase' OR user_id NOT IN (SELECT user_id FROM d) ORDER BY ts, event_id LIMIT 5""")
def outbox_next_due(spark, sf):
    pending = table(spark, sf, "events").where("event_type in ('view', 'purchase') and value > 40")
    holding = pending.where("event_type = 'purchase' and value > 80").select("user_id").distinct()
    free = pending.where("event_type = 'view'").join(holding, "user_id", "left_anti").unionByName(pending.where("event_type = 'purchase'"))
    return free.orderBy("ts", "event_id").limit(5).select("event_id", "user_id", "event_type")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events)
    SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY user_id, event_type, island ORDER BY ts, event_id) AS INTEGER) AS consecutive FROM o""")
def consecutive_runs(spark, sf):
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    new = F.when(F.lag("event_type").over(own).eqNullSafe(F.col("event_type")), 0).otherwise(1)
    rows = table(spark, sf, "events").withColumn("island", new).withColumn("island", F.sum("island").over(own))
    return rows.select("event_id", "event_type", F.row_number().over(Window.partitionBy("user_id", "island").orderBy("ts", "event_id")).alias("consecutive"))


STATUS = {"error": "failed", "view": "success", "click": "busy", "signup": "waiting", "purchase": "failed"}


def results(spark, sf):
    """events as results of a pipeline per user."""
    status = F.create_map(*(F.lit(x) for kv in STATUS.items() for x in kv))[F.col("event_type")]
    return table(spark, sf, "events").select(F.col("user_id").cast("string").alias("key"), "event_id", F.col("ts").cast("timestamp").alias("ts"), status.alias("status"), F.col("event_type").alias("signature"))


# One event a step for all keys at once: the state is the last alert and the current run of transient results.
@query("""WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, event_type AS sig, CASE event_type WHEN 'view' THEN 'success' WHEN 'click' THEN 'busy' WHEN 'signup' THEN 'waiting' ELSE 'failed' END AS status,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    m(key, event_id, i, action, open_sig, last_alert, run_sig, run_n, run_since) AS (
        SELECT key, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST('' AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), 0, CAST(NULL AS TIMESTAMP) FROM e WHERE i = 1
        UNION ALL
        SELECT key, event_id, i, action,
            CASE action WHEN 'alert' THEN sig WHEN 'recovery' THEN NULL WHEN 'silent' THEN NULL ELSE open_sig END,
            CASE action WHEN 'alert' THEN ts WHEN 'recovery' THEN NULL WHEN 'silent' THEN NULL ELSE last_alert END, rs, rn, rt
        FROM (SELECT key, event_id, i, ts, sig, open_sig, last_alert, rs, rn, rt,
                CASE WHEN transient AND rn < 2 AND ts - rt < INTERVAL 60 MINUTE THEN 'routine' WHEN status = 'success' THEN CASE WHEN open_sig IS NOT NULL AND last_alert IS NOT NULL THEN 'recovery' ELSE 'silent' END
                     WHEN open_sig = sig AND ts - last_alert < INTERVAL 4 HOUR THEN 'suppressed' ELSE 'alert' END AS action
              FROM (SELECT e.key, e.event_id, e.i, e.ts, e.sig, e.status, m.open_sig, m.last_alert, e.status IN ('busy', 'waiting', 'paused') AS transient,
                      CASE WHEN e.status IN ('busy', 'waiting') THEN e.sig END AS rs,
                      CASE WHEN e.status NOT IN ('busy', 'waiting') THEN 0 WHEN m.run_sig = e.sig THEN m.run_n + 1 ELSE 1 END AS rn,
                      CASE WHEN e.status NOT IN ('busy', 'waiting') THEN NULL WHEN m.run_sig = e.sig THEN m.run_since ELSE e.ts END AS rt
                    FROM m JOIN e ON e.key = m.key AND e.i = m.i + 1)))
    SELECT key, event_id, action FROM m WHERE i > 0""")
def incident_suppression(spark, sf):
    return state.replay(results(spark, sf), ["key"], ["ts", "event_id"], "key string, event_id bigint, action string", state.incident_step)


DELIVERY = {"error": "failed", "view": "enqueue", "click": "failed", "signup": "enqueue", "purchase": "delivered"}


@query("""WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) || '/' || CAST(event_id % 8 AS VARCHAR) AS key, event_id, ts, CASE event_type WHEN 'view' THEN 'enqueue' WHEN 'signup' THEN 'enqueue' WHEN 'purchase' THEN 'delivered' ELSE 'failed' END AS ev,
        row_number() OVER (PARTITION BY user_id, event_id % 8 ORDER BY ts, event_id) AS i FROM events),
    m(key, event_id, i, status, attempts, due) AS (
        SELECT key, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), 'new', 0, CAST(NULL AS TIMESTAMP) FROM e WHERE i = 1
        UNION ALL
        SELECT e.key, e.event_id, e.i,
            CASE WHEN m.status = 'new' AND ev = 'enqueue' THEN 'pending' WHEN m.status = 'pending' AND ev = 'delivered' THEN 'sent' WHEN m.status = 'pending' AND ev = 'failed' AND m.attempts >= 3 THEN 'dead_letter' ELSE m.status END,
            CASE WHEN m.status = 'pending' AND ev = 'failed' THEN m.attempts + 1 ELSE m.attempts END,
            CASE WHEN m.status = 'pending' AND ev = 'delivered' THEN NULL WHEN m.status = 'pending' AND ev = 'failed' AND m.attempts >= 3 THEN NULL
                 WHEN m.status = 'pending' AND ev = 'failed' THEN e.ts + to_minutes(CASE m.attempts WHEN 0 THEN 5 WHEN 1 THEN 10 ELSE 20 END) ELSE m.due END
        FROM m JOIN e ON e.key = m.key AND e.i = m.i + 1)
    SELECT key, event_id, status, attempts, strftime(due, '%Y-%m-%d %H:%M:%S') AS next_attempt FROM m WHERE i > 0""")
def outbox_replay(spark, sf):
    event = F.create_map(*(F.lit(x) for kv in DELIVERY.items() for x in kv))[F.col("event_type")]
    own = table(spark, sf, "events").select(F.concat_ws("/", F.col("user_id"), (F.col("event_id") % 8)).alias("key"), "event_id", F.col("ts").cast("timestamp").alias("ts"), event.alias("event"))
    out = state.replay(own, ["key"], ["ts", "event_id"], "key string, event_id bigint, status string, attempts int, next_attempt timestamp", state.outbox_step)
    return out.withColumn("next_attempt", F.date_format("next_attempt", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH e AS (SELECT user_id, event_id, ts, event_type = 'purchase' AS done FROM events WHERE event_type IN ('error', 'purchase')),
    g AS (SELECT *, sum(CASE WHEN done THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e),
    n AS (SELECT *, sum(CASE WHEN done THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS failures FROM g)
    SELECT event_id, CAST(failures AS INTEGER) AS failures, CASE WHEN done THEN 'resolved' WHEN failures >= 4 THEN 'retry_exhausted' ELSE 'retry_pending' END AS status,
        CASE WHEN NOT done AND failures < 4 THEN strftime(ts + to_minutes(CASE failures WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE 20 END), '%Y-%m-%d %H:%M:%S') END AS next_retry FROM n""")
def retry_schedule(spark, sf):
    own = table(spark, sf, "events").where("event_type in ('error', 'purchase')")
    own = own.select(F.col("user_id").cast("string").alias("key"), "event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "purchase", "resolved").otherwise("failed").alias("event"))
    out = state.retry_ledger(own, ["key"], ["ts", "event_id"])
    return out.select("event_id", "failures", "status", F.date_format("next_retry", "yyyy-MM-dd HH:mm:ss").alias("next_retry"))


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS files FROM s GROUP BY user_id, session""")
def quiet_window_sessions(spark, sf):
    own = table(spark, sf, "events").groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "6 hours").alias("w")).agg(F.count("*").alias("files"))
    return own.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "files")


@query(f"SELECT user_id, max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS stale FROM events GROUP BY user_id")
def heartbeat_stale(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg((F.max("ts") < F.expr(f"timestamp_ntz'{AS_OF}' - interval 1 day")).alias("stale"))
