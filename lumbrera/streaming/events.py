"""Event streams: latest status, windows with watermarks, quotas, budgets and queues.

Batch and stream use the same folds. Files of the driver's kind carry timestamps without a zone, on which no watermark
can stand: ``timed`` casts them first.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window


def timed(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def source(spark: SparkSession, path: str, files: int = 8) -> DataFrame:
    """A parquet file or folder as a stream, with the schema that its files have now."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    is_file = path.endswith(".parquet") and not spark.read.format("binaryFile").load(path).limit(1).isEmpty() and "part-" not in name
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.option("pathGlobFilter", name).parquet(folder) if is_file and not _is_folder(spark, path) else reader.parquet(path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


# Latest status wins ------------------------------------------------------------------------------------------------


def latest(log: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row a key of an append-only log; re-appended rows change nothing."""
    cols = [c for c in log.columns if c != key]
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*cols), seq).alias("x")).select(key, "x.*")


def upsert_latest(target: str, key: str, seq: str):
    """A foreachBatch writer that keeps the latest row a key in a parquet table, a new version for each batch; the
    same batch run twice writes the same version, so a restart loses and repeats nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{target}/v={batch_id}"
        old = f"{target}/v={batch_id - 1}"
        rows = batch
        if batch_id > 0 and _exists(spark, old):
            rows = spark.read.parquet(old).unionByName(batch)
        latest(rows, key, seq).write.mode("overwrite").parquet(path)

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# Windows (an extension: the catalogue's own jobs have none) --------------------------------------------------------


def tumbling(events: DataFrame, width: str, lateness: str = "1 day", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    return timed(events).withWatermark("ts", lateness).groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def sliding(events: DataFrame, width: str, step: str, lateness: str = "1 day", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    return timed(events).withWatermark("ts", lateness).groupBy(F.window("ts", width, step), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, gap: str, lateness: str = "1 day", key: str = "user_id") -> DataFrame:
    s = timed(events).withWatermark("ts", lateness).groupBy(F.session_window("ts", gap), key).agg(F.count("*").alias("n"))
    return s.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def once(events: DataFrame, keys: list[str], lateness: str = "1 day") -> DataFrame:
    """Each key once within the watermark."""
    return timed(events).withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def over_rate(events: DataFrame, key: str, limit: int, seconds: int = 60) -> DataFrame:
    """(key, start, n): windows of ``seconds`` in which a key came more than ``limit`` times (tumbling, as an
    approximation of a sliding limit)."""
    return timed(events).groupBy(key, F.window("ts", f"{seconds} seconds")).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(key, F.col("window.start").alias("start"), "n")


# Quotas ------------------------------------------------------------------------------------------------------------


@dataclass
class Quotas:
    """Three counters in one: a month's, a site-day's and a user-day's. A later one that refuses gives back what the
    earlier ones took; a limit of 0 admits none."""

    month: int
    site_day: int
    user_day: int
    counts: dict = field(default_factory=dict)

    def ask(self, user, ts: datetime) -> tuple[bool, str]:
        local = ts - timedelta(hours=6)
        keys = (("month", local.strftime("%Y-%m"), self.month), ("site", local.strftime("%Y-%m-%d"), self.site_day), ("user", f"{user}/{local:%Y-%m-%d}", self.user_day))
        taken = []
        for kind, key, limit in keys:
            if self.counts.get((kind, key), 0) >= limit:
                for t in taken:
                    self.counts[t] -= 1
                return False, kind
            self.counts[kind, key] = self.counts.get((kind, key), 0) + 1
            taken.append((kind, key))
        return True, ""


def user_quota(events: DataFrame, key: str, order: list[Column], limit: int, hours: int = 6) -> DataFrame:
    """One level in batch: the first ``limit`` requests of a key a local day are admitted."""
    day = F.to_date(F.col("ts").cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS"))
    w = Window.partitionBy(key, "day").orderBy(*order)
    return events.withColumn("day", day).withColumn("admitted", F.row_number().over(w) <= limit)


def all_quotas(events: DataFrame, key: str, month: int, site_day: int, user_day: int) -> DataFrame:
    """Three levels in batch: requests (event_id, ts, key) in time order with ``admitted`` and the level that refused.

    Who is admitted is told by rank, which holds because a refusal takes nothing: of the requests that a user's day
    admits, the first so many of a site's day, and of these the first so many of a month. What refused is the first
    counter, in the order month, site, user, that is full with those admitted before, as the counters themselves say."""
    t = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), key).withColumn("local", F.col("ts") - F.expr("INTERVAL 6 HOURS"))
    t = t.withColumn("day", F.to_date("local")).withColumn("month", F.date_format("local", "yyyy-MM"))
    rank = lambda *k: F.row_number().over(Window.partitionBy(*k).orderBy("ts", "event_id"))
    before = lambda *k: F.coalesce(F.sum(F.col("admitted").cast("int")).over(Window.partitionBy(*k).orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = t.withColumn("u", rank("day", key) <= user_day)
    s = t.withColumn("s", F.when(F.col("u"), rank("day", "u") <= site_day))
    m = s.withColumn("okay", F.coalesce(F.col("u") & F.col("s"), F.lit(False)))
    m = m.withColumn("admitted", F.col("okay") & (rank("month", "okay") <= month))
    m = m.withColumn("in_month", before("month")).withColumn("in_day", before("day"))
    refused = F.when(F.col("admitted"), "").when(F.col("in_month") >= month, "month").when(F.col("in_day") >= site_day, "site").otherwise("user")
    return m.select("event_id", "ts", key, refused.alias("refused"), "admitted")


class QuotaProcessor(StatefulProcessor):
    """Streaming form: all requests of one grouping key in time order through the counters, kept in state."""

    def __init__(self, month: int, site_day: int, user_day: int) -> None:
        self.limits = (month, site_day, user_day)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "k string", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        q = Quotas(*self.limits, counts={tuple(k[0].split("|", 1)): v[0] for k, v in self.counts.iterator()})
        out = []
        for r in pd.concat(list(rows)).sort_values(["ts", "event_id"]).itertuples():
            ok, why = q.ask(r.user_id, r.ts.to_pydatetime())
            out.append((r.event_id, r.user_id, ok, why))
        for k, n in q.counts.items():
            self.counts.updateValue(("|".join(k),), (n,))
        yield pd.DataFrame(out, columns=["event_id", "user_id", "admitted", "refused"])

    def close(self) -> None:
        pass


def stream_quotas(events: DataFrame, month: int, site_day: int, user_day: int) -> DataFrame:
    """Requests with the answer of the three counters. One grouping key: the site's counters are one thing. Needs the
    RocksDB state store."""
    one = timed(events).select("event_id", "user_id", "ts").withColumn("g", F.lit(0))
    return one.groupBy("g").transformWithStateInPandas(statefulProcessor=QuotaProcessor(month, site_day, user_day), outputStructType="event_id long, user_id long, admitted boolean, refused string", outputMode="append", timeMode="None")


def budget(events: DataFrame, key: str, order: list[Column], reserve: Column, actual: Column) -> DataFrame:
    """Reserve and settle: the running balance a key after each event has taken its reserve and given back what it
    did not use."""
    w = Window.partitionBy(key).orderBy(*order)
    return events.withColumn("reserved", F.sum(reserve).over(w) - F.coalesce(F.sum(reserve - actual).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("spent", F.sum(actual).over(w))


def saved(events: DataFrame, user: str, key: str, order: list[Column], limit: int) -> DataFrame:
    """Conditional inserts: a user's distinct keys in order of arrival, the first ``limit`` of them kept."""
    first = events.withColumn("_r", F.row_number().over(Window.partitionBy(user, key).orderBy(*order))).where("_r = 1").drop("_r")
    return first.withColumn("_k", F.row_number().over(Window.partitionBy(user).orderBy(*order))).where(F.col("_k") <= limit).drop("_k")


def expired(rows: DataFrame, ts: str, now: Column, days: int) -> DataFrame:
    """Rows without those older than ``days``."""
    return rows.where(F.col(ts).cast("timestamp") >= now.cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))


def retry_plan(kind: Column, tries: Column, now: Column, most: int = 2) -> Column:
    """struct(state, tries, next): without quota a job waits uncounted until the next reset; an error counts and waits
    six hours, ``most`` times."""
    from lumbrera.functions.text import next_reset

    t = now.cast("timestamp")
    return F.when(kind == "sin_cuota", F.struct(F.lit("pendiente").alias("state"), tries.alias("tries"), next_reset(now).alias("next"))).when((kind == "error") & (tries + 1 <= most), F.struct(F.lit("pendiente").alias("state"), (tries + 1).alias("tries"), (t + F.expr("INTERVAL 6 HOURS")).alias("next"))).when(kind == "error", F.struct(F.lit("agotada").alias("state"), (tries + 1).alias("tries"), F.lit(None).cast("timestamp").alias("next"))).otherwise(F.struct(F.lit("lista").alias("state"), tries.alias("tries"), F.lit(None).cast("timestamp").alias("next")))


# Queue -------------------------------------------------------------------------------------------------------------


@dataclass
class Queue:
    """A first-in-first-out queue with seats and leases. A lease that ran out sends its job to the front again; an
    alarm starts at most ``batch`` jobs."""

    seats: int
    lease: float
    batch: int = 20
    waiting: deque = field(default_factory=deque)
    running: dict = field(default_factory=dict)
    started: list = field(default_factory=list)

    def arrive(self, job, now: float) -> None:
        self.waiting.append(job)
        self.alarm(now)

    def finish(self, job, now: float) -> None:
        self.running.pop(job, None)
        self.alarm(now)

    def alarm(self, now: float) -> None:
        lost = [j for j, until in self.running.items() if until <= now]
        for j in sorted(lost, key=lambda x: self.running[x], reverse=True):
            del self.running[j]
            self.waiting.appendleft(j)
        for _ in range(self.batch):
            if not self.waiting or len(self.running) >= self.seats:
                break
            j = self.waiting.popleft()
            self.running[j] = now + self.lease
            self.started.append((j, now))


def replay_queue(events: DataFrame, key: str, seats: int, lease: float) -> DataFrame:
    """(key, job, started) of an event log (key, job, ts double, kind arrive|finish), each key's queue in time order.
    A key's log, which its queue must see in order, goes to one task and is held there; different keys run apart."""
    kind = events.schema[key].dataType.simpleString()

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        q = Queue(seats, lease)
        for r in pdf.sort_values(["ts", "job"]).itertuples():
            (q.arrive if r.kind == "arrive" else q.finish)(r.job, r.ts)
        return pd.DataFrame([(k[0], j, t) for j, t in q.started], columns=["k", "job", "started"]).astype({"job": "int64", "started": "float64"})

    return events.groupBy(key).applyInPandas(run, f"k {kind}, job long, started double").withColumnRenamed("k", key)


@dataclass
class RetryLane:
    """One waiting reading at a time: starts are ``spacing`` seconds apart, the oldest one that is due comes first, and
    a reading that finds the quota used up puts the lane to rest until the next reset. An error sends its reading back
    for ``wait`` seconds, ``most`` times."""

    spacing: float = 45.0
    wait: float = 6 * 3600.0
    most: int = 2
    paused_until: float = 0.0
    last: float = float("-inf")
    jobs: dict = field(default_factory=dict)  # job -> (due, created, tries)

    def add(self, job, now: float) -> None:
        self.jobs[job] = (now, now, 0)

    def next_alarm(self, now: float) -> float | None:
        """When the lane should wake up next; None if nothing waits."""
        if not self.jobs:
            return None
        return max(now, self.paused_until, self.last + self.spacing, min(due for due, _, _ in self.jobs.values()))

    def alarm(self, now: float, outcome, reset) -> object | None:
        """Takes the oldest reading that is due and returns it; ``outcome(job)`` is ok, error or sin_cuota, ``reset(now)``
        the next reset. None where the lane rests or nothing is due."""
        due = sorted((created, job) for job, (at, created, _) in self.jobs.items() if at <= now)
        if now < self.paused_until or now < self.last + self.spacing or not due:
            return None
        job, self.last = due[0][1], now
        got, (_, created, tries) = outcome(job), self.jobs[job]
        if got == "sin_cuota":
            self.paused_until = reset(now)
        elif got == "error" and tries + 1 <= self.most:
            self.jobs[job] = (now + self.wait, created, tries + 1)
        else:
            del self.jobs[job]
        return job


def spaced(jobs: DataFrame, key: str, due: str, order: list[Column], spacing: float) -> DataFrame:
    """Adds ``start``: when a lane (key) that begins one job each ``spacing`` seconds, in ``order``, gets to each job
    that is due at ``due`` (seconds): the latest of its own due time and the start before plus the spacing, which is the
    running maximum of due - spacing x place, plus spacing x place."""
    w = Window.partitionBy(key).orderBy(*order)
    placed = jobs.withColumn("_p", F.row_number().over(w) - 1)
    return placed.withColumn("start", F.max(F.col(due) - F.col("_p") * spacing).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_p") * spacing).drop("_p")


def analysis_events(parts: DataFrame, key: str) -> DataFrame:
    """(key, events, failed): each analysis's events in order; a part that failed leaves the others."""
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "kind", "payload"))), lambda e: F.struct(e["kind"].alias("kind"), e["payload"].alias("payload"))).alias("events"), F.count_if(F.col("kind") == "error").alias("failed"))
