"""Queries of event logs, quotas and queues, and of packed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.queries import base, entry, queries_of, table
from lumbrera.sources import readers as S
from lumbrera.sources import writers as K
from lumbrera.streaming import events as R


@entry("SELECT biblionumber, log_seq, download_status, error FROM (SELECT *, row_number() OVER (PARTITION BY biblionumber ORDER BY log_seq DESC) AS r FROM marc_status_log WHERE biblionumber IS NOT NULL) WHERE r = 1")
def log_latest(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "marc_status_log").select("biblionumber", "log_seq", "download_status", "error")
    return R.latest(log, "biblionumber", "log_seq").select("biblionumber", "log_seq", "download_status", "error")


@entry("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, CAST(ts - INTERVAL 6 HOURS AS DATE) ORDER BY ts, event_id) <= 3 AS admitted FROM events")
def quota_admit(spark: SparkSession, d: str) -> DataFrame:
    return R.user_quota(table(spark, d, "events"), "user_id", [F.col("ts"), F.col("event_id")], 3).select("event_id", "user_id", "admitted")


@entry(
    "WITH t AS (SELECT event_id, user_id, ts, CAST(ts - INTERVAL 6 HOURS AS DATE) AS day, strftime(ts - INTERVAL 6 HOURS, '%Y-%m') AS month FROM events), u AS (SELECT *, row_number() OVER (PARTITION BY day, user_id ORDER BY ts, event_id) <= 2 AS u FROM t), s AS (SELECT *, row_number() OVER (PARTITION BY day, u ORDER BY ts, event_id) <= 100 AS s FROM u), "
    "m AS (SELECT *, CAST(u AND s AND row_number() OVER (PARTITION BY month, u AND s ORDER BY ts, event_id) <= 1500 AS INTEGER) AS a FROM s), c AS (SELECT *, sum(a) OVER (PARTITION BY month ORDER BY ts, event_id) - a AS in_month, sum(a) OVER (PARTITION BY day ORDER BY ts, event_id) - a AS in_day FROM m) "
    "SELECT event_id, CASE WHEN a = 1 THEN '' WHEN in_month >= 1500 THEN 'month' WHEN in_day >= 100 THEN 'site' ELSE 'user' END AS refused FROM c"
)
def quota_levels(spark: SparkSession, d: str) -> DataFrame:
    return R.all_quotas(table(spark, d, "events"), "user_id", 1500, 100, 2).select("event_id", "refused")


@entry("SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS start, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 2")
def rate_window(spark: SparkSession, d: str) -> DataFrame:
    return R.over_rate(table(spark, d, "events"), "user_id", 2, 3600).withColumn("start", F.col("start").cast("timestamp_ntz"))


@entry("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_days(spark: SparkSession, d: str) -> DataFrame:
    return R.tumbling(table(spark, d, "events"), "1 day").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@entry("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOURS THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOURS AS \"end\", count(*) AS n FROM s GROUP BY user_id, k")
def session_ext(spark: SparkSession, d: str) -> DataFrame:
    s = R.sessions(table(spark, d, "events"), "2 hours")
    return s.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@entry(
    "SELECT event_id, user_id, round(sum(abs(value) * 2) OVER w - coalesce(sum(abs(value)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 4) AS reserved, round(sum(abs(value)) OVER w, 4) AS spent FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
)
def budget_ledger(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    b = R.budget(e, "user_id", [F.col("ts"), F.col("event_id")], F.abs("value") * 2, F.abs("value"))
    return b.select("event_id", "user_id", F.round("reserved", 4).alias("reserved"), F.round("spent", 4).alias("spent"))


@entry("WITH f AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM f WHERE r = 1) SELECT event_id, user_id, event_type FROM k WHERE k <= 3")
def saved_items(spark: SparkSession, d: str) -> DataFrame:
    return R.saved(table(spark, d, "events"), "user_id", "event_type", [F.col("ts"), F.col("event_id")], 3).select("event_id", "user_id", "event_type")


@entry("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS")
def unexpired(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    last = e.agg(F.max("ts").alias("now"))
    return R.expired(e.crossJoin(F.broadcast(last)), "ts", F.col("now"), 7).select("event_id")  # last: one row


@entry()
def queue_fifo(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("event_type").alias("k"), F.col("event_id").alias("job"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("ts"))
    log = e.withColumn("kind", F.lit("arrive")).unionByName(e.select("k", "job", (F.col("ts") + 900).alias("ts"), F.lit("finish").alias("kind")))
    return R.replay_queue(log, "k", seats=2, lease=1200.0)


@entry("SELECT log_seq, CASE WHEN download_status = 'failed' AND coalesce(error, '') LIKE '%cuota%' THEN 'pendiente' WHEN download_status = 'failed' THEN CASE WHEN log_seq % 3 + 1 <= 2 THEN 'pendiente' ELSE 'agotada' END ELSE 'lista' END AS state FROM marc_status_log")
def retry_states(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "marc_status_log")
    kind = F.when((F.col("download_status") == "failed") & F.coalesce("error", F.lit("")).contains("cuota"), "sin_cuota").when(F.col("download_status") == "failed", "error").otherwise("ok")
    return log.select("log_seq", R.retry_plan(kind, F.col("log_seq") % 3, F.col("downloaded_at")).alias("p")).select("log_seq", "p.state")


@entry("SELECT user_id, string_agg(event_type, ',' ORDER BY ts, event_id) AS kinds, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def event_sequences(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("seq"), F.col("event_type").alias("kind"), F.col("props").alias("payload"))
    return R.analysis_events(parts, "user_id").select("user_id", F.array_join(F.transform("events", lambda e: e["kind"]), ",").alias("kinds"), "failed")


@entry("SELECT biblionumber, CASE WHEN coalesce(trim(biblionumber), '') = '' THEN 'missing_biblionumber' WHEN target_year IS NOT NULL AND target_year <> 2003 THEN 'out_of_year' WHEN biblionumber IN (SELECT biblionumber FROM marc_status_log) THEN 'already_in_manifest' ELSE 'pending_detail' END AS status FROM marc_year_manifest")
def manifest_states(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "marc_status_log").where("biblionumber IS NOT NULL").select("biblionumber", F.lit(True).alias("seen")).distinct()
    m = table(spark, d, "marc_year_manifest").join(seen, "biblionumber", "left")
    return m.select("biblionumber", S.manifest_status(F.col("biblionumber"), F.col("target_year"), F.lit(2003), F.coalesce("seen", F.lit(False))).alias("status"))


@entry("SELECT (r - 1) // 1000 AS block, count(*) AS count, 12 * count(*) AS bytes FROM (SELECT row_number() OVER (ORDER BY thesis_id) AS r FROM base7_kaggle_clean) GROUP BY 1")
def packed_blobs(spark: SparkSession, d: str) -> DataFrame:
    b = base(spark, d).select("thesis_id", F.col("año").alias("anio"), "num_autores")
    return K.packed(b, [F.col("thesis_id")], {"anio": "int64", "num_autores": "int32"}, 1000).select("block", "count", F.length("content").cast("long").alias("bytes"))


QUERIES = queries_of(globals())
