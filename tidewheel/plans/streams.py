"""Stream queries: the event table is read as a stream of files and run until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.times import epoch_seconds, time_slice
from tidewheel.operators.windows import session_totals
from tidewheel.plans.registry import Tables, query
from tidewheel.plans.windows import SESSION_SQL
from tidewheel.session import fresh_dir
from tidewheel.sources.readers import new_files, table_stream
from tidewheel.sources.sinks import materialised
from tidewheel.streaming import operators as so
from tidewheel.streaming.jobs import drain, drained, merge_into_versions, newest_state, to_batch_folders
from tidewheel.streaming.tables import merge_into_buckets, read_buckets, split_late, split_rows
from tidewheel.streaming.throttles import throttle_trailing, throttle_trailing_stream


def event_stream(t: Tables, delay: str = "10 minutes") -> DataFrame:
    source = table_stream(t.spark, t.base, "events", t.events.schema)
    shaped = source.select("event_id", "user_id", "ts", "event_type", "value")
    return so.with_event_time(shaped, "ts", delay)


def event_batch(t: Tables) -> DataFrame:
    return so.with_event_time(t.events.select("event_id", "user_id", "ts", "event_type", "value"), "ts")


_COUNTS = """SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, user_id, count(*) AS n_events
  FROM events GROUP BY 1, 2"""


@query("sm_01_tumbling_counts", _COUNTS)
def tumbling_counts(t: Tables) -> DataFrame:
    out = so.tumbling_counts(event_stream(t), "user_id", "ts", "5 minutes")
    return newest_state(drained(out, "counts", "update"), ["window_start", "user_id"])


@query("sm_01_tumbling_counts_batch", _COUNTS)
def tumbling_counts_batch(t: Tables) -> DataFrame:
    return so.tumbling_counts(event_batch(t), "user_id", "ts", "5 minutes")


_SUMS = """SELECT time_bucket(INTERVAL 60 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, user_id,
  round(sum(value), 2) AS amount FROM events GROUP BY 1, 2"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.round("amount", 2))


@query("sm_02_tumbling_sums", _SUMS)
def tumbling_sums(t: Tables) -> DataFrame:
    out = so.tumbling_sums(event_stream(t), "user_id", "ts", "value", "60 minutes")
    return _rounded(newest_state(drained(out, "sums", "update"), ["window_start", "user_id"]))


@query("sm_02_tumbling_sums_batch", _SUMS)
def tumbling_sums_batch(t: Tables) -> DataFrame:
    return _rounded(so.tumbling_sums(event_batch(t), "user_id", "ts", "value", "60 minutes"))


@query(
    "sm_03_session_sums",
    f"{SESSION_SQL} SELECT user_id, min(sec) AS session_start, round(sum(value), 2) AS amount FROM s GROUP BY user_id, session_id",
)
def session_sums(t: Tables) -> DataFrame:
    """Whole-second sessions as a batch: spread over slices, for users of any size."""
    timed = t.events.select("event_id", "user_id", "value", epoch_seconds("ts").alias("sec"))
    out = session_totals(timed, ["user_id"], "sec", "event_id", time_slice("sec", 86_400), 1800, "value")
    return _rounded(out)


_SESSION_MICROS = """WITH f AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 1800000000 THEN 0 ELSE 1 END AS opens
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM f)
  SELECT min(ts) AS session_start, user_id, round(sum(value), 2) AS amount FROM s GROUP BY user_id, sid"""


@query("sm_03_session_window_stream", _SESSION_MICROS)
def session_stream(t: Tables) -> DataFrame:
    """All sessions of the stream so far, still open ones included."""
    out = so.session_sums(event_stream(t), "user_id", "ts", "value", "30 minutes")
    return _rounded(drained(out, "sessions", "complete").drop("batch_id"))


_THROTTLE = """SELECT event_id, user_id, tick FROM (SELECT *, row_number() OVER (PARTITION BY user_id, tick ORDER BY event_id) AS rn
  FROM (SELECT event_id, user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS tick FROM events)) WHERE rn <= 1"""


@query("sm_04_throttle", _THROTTLE)
def throttle(t: Tables) -> DataFrame:
    """One event per user and tick. A tick is an hour of event time here: the events are sparse."""
    ticks = t.events.select("event_id", "user_id", time_slice(epoch_seconds("ts"), 3_600).alias("tick"))
    return so.throttle(ticks, "user_id", "tick", ["event_id"], 1)


@query("sm_04_throttle_stream", _THROTTLE)
def throttle_stream(t: Tables) -> DataFrame:
    """The same with state: hours become the seconds of the stream's clock."""
    hour = F.floor(F.col("ts").cast("timestamp").cast("bigint") / 3600)
    rows = table_stream(t.spark, t.base, "events", t.events.schema)
    clock = rows.select(
        "event_id", "user_id", "value", F.timestamp_seconds(hour).alias("clock")
    ).withWatermark("clock", "10 seconds")
    out = so.throttle_stream(clock, "user_id", "clock", "event_id", "value", 1)
    return drained(out, "throttle").select(
        F.col("row_id").alias("event_id"), "user_id", F.col("second").alias("tick")
    )


_SPAN = 21_600_000_000  # six hours of event time in microseconds; the events are sparse
_TRAILING = f"""WITH RECURSIVE o AS (SELECT event_id, user_id, epoch_us(ts) AS at_us,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
  walk AS (SELECT event_id, user_id, at_us, k, [at_us] AS held, true AS ok FROM o WHERE k = 1
    UNION ALL SELECT o.event_id, o.user_id, o.at_us, o.k,
      CASE WHEN len(list_filter(held, lambda h: h > o.at_us - {_SPAN})) < 2 THEN list_append(list_filter(held, lambda h: h > o.at_us - {_SPAN}), o.at_us)
        ELSE list_filter(held, lambda h: h > o.at_us - {_SPAN}) END,
      len(list_filter(held, lambda h: h > o.at_us - {_SPAN})) < 2
    FROM walk JOIN o ON o.user_id = walk.user_id AND o.k = walk.k + 1)
  SELECT event_id, user_id, at_us FROM walk WHERE ok"""


@query("sm_04_trailing_throttle", _TRAILING)
def trailing_throttle(t: Tables) -> DataFrame:
    """At most two accepted events of a user in any trailing six hours, times to the microsecond."""
    timed = t.events.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))
    return throttle_trailing(timed, "user_id", "at_us", "event_id", 2, _SPAN)


@query("sm_04_trailing_throttle_stream", _TRAILING)
def trailing_throttle_stream(t: Tables) -> DataFrame:
    out = throttle_trailing_stream(event_stream(t), "user_id", "ts", "event_id", 2, _SPAN)
    return drained(out, "trailing-throttle").select("event_id", "user_id", F.col("at").alias("at_us"))


@query("sm_05_filter", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND value > 20")
def stream_filter(t: Tables) -> DataFrame:
    big = (F.col("event_type") == "purchase") & (F.col("value") > 20)
    return drained(so.chain(event_stream(t), [so.keep(big)]), "filter").select("event_id", "user_id")


@query("sm_06_map", "SELECT event_id, value * 1.2e0 AS taxed, upper(event_type) AS kind FROM events")
def stream_map(t: Tables) -> DataFrame:
    columns = {"taxed": F.col("value") * 1.2, "kind": F.upper("event_type")}
    return drained(so.chain(event_stream(t), [so.derive(columns)]), "map").select("event_id", "taxed", "kind")


_CHAIN = """SELECT time_bucket(INTERVAL 60 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, user_id,
  round(sum(value * 1.2e0), 2) AS amount FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""


def _steps():
    return [
        so.keep(F.col("event_type") != "error"),
        so.derive({"value": F.col("value") * 1.2}),
        lambda df: so.tumbling_sums(df, "user_id", "ts", "value", "60 minutes"),
    ]


@query("sm_07_chain", _CHAIN)
def stream_chain(t: Tables) -> DataFrame:
    out = drained(so.chain(event_stream(t), _steps()), "chain", "update")
    return _rounded(newest_state(out, ["window_start", "user_id"]))


@query("sm_07_chain_batch", _CHAIN)
def batch_chain(t: Tables) -> DataFrame:
    return _rounded(so.chain(event_batch(t), _steps()))


@query("sm_08_batches", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def batches(t: Tables) -> DataFrame:
    """Each micro-batch is reduced as a whole; the partial results are added up afterwards."""
    root = fresh_dir(t.spark, "batches")
    sink = to_batch_folders(f"{root}/rows")

    def reduce(batch: DataFrame, batch_id: int) -> None:
        sink(batch.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), batch_id)

    drain(event_stream(t), reduce, f"{root}/checkpoint")
    partial = t.spark.read.schema("event_type STRING, n BIGINT, total DOUBLE").parquet(f"{root}/rows")
    return partial.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query(
    "sm_09_lateness",
    """WITH a AS (SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN CAST(floor(epoch(ts) / 86400) AS BIGINT) + 1
         ELSE CAST(floor(epoch(ts) / 86400) AS BIGINT) END AS arrived FROM events),
       m AS (SELECT arrived, max(max(ts)) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
         FROM a GROUP BY arrived)
       SELECT event_id, arrived, coalesce(ts < newest - INTERVAL 600 SECOND, FALSE) AS is_late FROM a JOIN m USING (arrived)""",
)
def lateness(t: Tables) -> DataFrame:
    """Events arrive by day, every tenth a day later; late is more than ten minutes behind."""
    day = time_slice(epoch_seconds("ts"), 86_400)
    arrived = F.when(F.col("event_id") % 10 == 0, day + 1).otherwise(day)
    rows = t.events.select("event_id", "ts", arrived.alias("arrived"))
    return so.lateness(rows, "ts", "arrived", 600).select("event_id", "arrived", "is_late")


_DELIVERED = """WITH a AS (SELECT event_id, ts, CAST(floor(epoch(ts) / 864000) AS BIGINT) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS arrived
    FROM events),
  m AS (SELECT arrived, max(max(ts)) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM a GROUP BY arrived),
  l AS (SELECT event_id, ts, arrived, coalesce(ts < newest - INTERVAL 600 SECOND, FALSE) AS is_late FROM a JOIN m USING (arrived))"""


def _delivered(t: Tables) -> DataFrame:
    """Events in deliveries of ten days, every tenth event a delivery later, drained one by one.

    The stream stops after each delivery and starts again from its checkpoint.
    """
    root = fresh_dir(t.spark, "late-rows")
    day = time_slice(epoch_seconds("ts"), 864_000)
    arrived = F.when(F.col("event_id") % 10 == 0, day + 1).otherwise(day)
    rows = materialised(t.events.select("event_id", "ts", arrived.alias("arrived")), "deliveries")
    for (number,) in rows.select("arrived").distinct().sort("arrived").collect():
        rows.where(F.col("arrived") == number).write.mode("append").parquet(f"{root}/in")
        source = new_files(t.spark, f"{root}/in", rows.schema)
        drain(source, split_late(f"{root}/out", "ts", 600), f"{root}/checkpoint")
    return split_rows(t.spark, f"{root}/out", "event_id BIGINT, ts TIMESTAMP_NTZ, arrived BIGINT")


@query("sm_09_late_rows_kept", f"{_DELIVERED} SELECT event_id, arrived, is_late FROM l")
def late_rows_kept(t: Tables) -> DataFrame:
    """On-time and late output together are the input, row for row."""
    return _delivered(t).select("event_id", "arrived", "is_late")


@query(
    "sm_09_corrected_counts",
    f"""{_DELIVERED} SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, count(*) FILTER (NOT is_late) AS n_on_time,
       count(*) FILTER (is_late) AS n_late, count(*) AS n_events FROM l GROUP BY 1""",
)
def corrected_counts(t: Tables) -> DataFrame:
    """Daily counts as first reported, and as corrected by the late rows kept aside."""
    late = F.count_if("is_late")
    return _delivered(t).groupBy(time_slice(epoch_seconds("ts"), 86_400).alias("day")).agg(
        (F.count("*") - late).alias("n_on_time"), late.alias("n_late"), F.count("*").alias("n_events")
    )


@query("sm_10_stream_dedup", "SELECT DISTINCT event_id, user_id FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """Every event comes twice, and once it stays."""
    twice = event_stream(t, "40 days").select(
        "event_id", "user_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    )
    return drained(so.distinct_events(twice, ["event_id"]), "dedup").select("event_id", "user_id")


@query(
    "sm_11_stream_upsert",
    """SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
         AS rn FROM events) WHERE rn = 1""",
)
def stream_upsert(t: Tables) -> DataFrame:
    root = fresh_dir(t.spark, "merged")
    rows = table_stream(t.spark, t.base, "events", t.events.schema).select("user_id", "event_id", "ts", "value")
    drain(rows, merge_into_versions(f"{root}/table", ["user_id"], ("ts", "event_id")), f"{root}/checkpoint")
    every = t.spark.read.option("basePath", f"{root}/table").parquet(f"{root}/table/v=*")
    last = every.agg(F.max("v").alias("v")).scalar()
    return every.where(F.col("v") == last).drop("v")


@query(
    "sm_11_bucket_upsert",
    """SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
         AS rn FROM events) WHERE rn = 1""",
)
def bucket_upsert(t: Tables) -> DataFrame:
    """Three deliveries, out of order; each rewrites only the buckets it has keys of."""
    root = fresh_dir(t.spark, "bucket-upsert")
    rows = materialised(t.events.select("user_id", "event_id", "ts", "value"), "deliveries")
    for k in (1, 2, 0):
        rows.where(F.col("user_id") % 3 == k).unionByName(rows.where(F.col("event_id") % 3 == k)).write.mode("append").parquet(f"{root}/in")
        sink = merge_into_buckets(f"{root}/table", ["user_id"], ("ts", "event_id"), n=16)
        drain(new_files(t.spark, f"{root}/in", rows.schema), sink, f"{root}/checkpoint")
    return read_buckets(t.spark, f"{root}/table").select("user_id", "event_id", "ts", "value")


@query("sm_12_restart", "SELECT event_id, user_id, value FROM events")
def restart(t: Tables) -> DataFrame:
    """Stopped and started again with its checkpoint, the stream emits no row twice."""
    root = fresh_dir(t.spark, "restart")
    for _ in range(2):
        rows = event_stream(t).select("event_id", "user_id", "value")
        drain(rows, to_batch_folders(f"{root}/rows"), f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/rows").select("event_id", "user_id", "value")
