"""Run filters over the event table, in batch and as streams that read it to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import runs as R
from gleaner.plans.inputs import ITEMS_SQL, items
from gleaner.plans.registry import query
from gleaner.plans.source_queries import scratch
from gleaner.sources.tables import table
from gleaner.streaming import streams as L

IS_ITEM = "event_type IN ('purchase', 'view')"
LIMIT = "CASE WHEN user_id < 20 THEN 0 ELSE 14400 END"
NOW = "2024-02-01 00:00:00"


def _events(spark, folder):
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(writer, checkpoint):
    """Read the stream to its end."""
    stream = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


@query(
    "stale_crawl_filter",
    f"""WITH s AS (SELECT event_id, user_id, ts, {IS_ITEM} AS item, {LIMIT} AS lim, min(ts) OVER (PARTITION BY user_id) AS start,
          max(CASE WHEN {IS_ITEM} THEN ts END) OVER (PARTITION BY user_id ORDER BY ts) AS seen FROM events)
        SELECT event_id, lim > 0 AND epoch_us(ts) - epoch_us(coalesce(seen, start)) > CAST(lim AS BIGINT) * 1000000 AS rejected FROM s WHERE NOT item""",
)
def stale_crawl_filter(spark, folder):
    done = R.stale_crawl_filter(_events(spark, folder), "user_id", "ts", F.expr(IS_ITEM), F.expr(LIMIT))
    return done.select("event_id", "rejected")


STALE_SQL = f"""WITH m AS (SELECT user_id, ts, event_type = 'purchase' AS stop, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events)
        SELECT user_id, epoch_us(ts) AS last_seen_us, epoch_us(ts) + 1800000000 AS alert_us FROM m
        WHERE NOT stop AND coalesce(next, TIMESTAMP '{NOW}') > ts + INTERVAL 30 MINUTE"""


@query("stale_run_alerts", STALE_SQL)
def stale_run_alerts(spark, folder):
    now = F.lit(NOW).cast("timestamp")
    alerts = R.stale_run_alerts(_events(spark, folder), "user_id", "ts", F.col("event_type") == "purchase", now)
    return alerts.select(
        "user_id", F.unix_micros("last_seen").alias("last_seen_us"), F.unix_micros("alert_after").alias("alert_us")
    )


@query(
    "stale_run_sessions",
    STALE_SQL.replace(f"coalesce(next, TIMESTAMP '{NOW}')", "coalesce(next, (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE)").replace("+ 1800000000", "+ 1800000001"),
)
def stale_run_sessions(spark, folder):
    path = scratch(spark, "alerts")
    alerts = L.stale_run_sessions(_event_stream(spark, folder), "user_id", "ts", F.col("event_type") == "purchase")
    _drain(alerts.writeStream.format("parquet").option("path", path).outputMode("append"), path + "-checkpoint")
    return spark.read.schema(alerts.schema).parquet(path).select(
        "user_id", F.unix_micros("last_seen").alias("last_seen_us"), F.unix_micros("alert_after").alias("alert_us")
    )


@query(
    "time_limit_filter",
    """WITH runs AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 5000 THEN TIMESTAMP '2024-01-10 00:00:00' END AS end_time FROM customer)
       SELECT event_id FROM events LEFT JOIN runs USING (user_id) WHERE end_time IS NULL OR ts <= end_time""",
)
def time_limit_filter(spark, folder):
    end = F.when(F.col("c_acctbal") > 5000, F.lit("2024-01-10 00:00:00").cast("timestamp"))
    runs = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), end.alias("end_time"))
    return R.time_limit_filter(_events(spark, folder), runs, "user_id", "ts").select("event_id")


@query(
    "time_limit_stream",
    """WITH runs AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 5000 THEN TIMESTAMP '2024-01-10 00:00:00' END AS end_time FROM customer)
       SELECT event_id FROM events LEFT JOIN runs USING (user_id) WHERE end_time IS NULL OR ts <= end_time""",
)
def time_limit_stream(spark, folder):
    path = scratch(spark, "limit")
    end = F.when(F.col("c_acctbal") > 5000, F.lit("2024-01-10 00:00:00").cast("timestamp"))
    runs = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), end.alias("end_time"))
    # Runs that were ended twice: the last end counts, and no request is multiplied.
    earlier = runs.filter("end_time IS NOT NULL").withColumn("end_time", F.expr("end_time - INTERVAL 1 DAY"))
    kept = L.time_limit_stream(_event_stream(spark, folder), runs.unionByName(earlier), "user_id", "ts").select("event_id")
    _drain(kept.writeStream.format("parquet").option("path", path), path + "-checkpoint")
    return spark.read.schema(kept.schema).parquet(path)


@query(
    "preview_cutoff",
    f"""WITH {ITEMS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY mining_job_id ORDER BY scraped_at, item_no) AS rn FROM items)
        SELECT item_no, mining_job_id FROM r WHERE rn <= 3""",
)
def preview_cutoff(spark, folder):
    kept = R.preview_cutoff(items(spark, folder), "mining_job_id", [F.asc("scraped_at"), F.asc("item_no")], 3)
    return kept.select("item_no", "mining_job_id")


@query(
    "preview_stream",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM events) SELECT event_id, user_id FROM r WHERE rn <= 4""",
)
def preview_stream(spark, folder):
    path = scratch(spark, "preview")
    kept = L.preview_stream(_event_stream(spark, folder), "user_id", "ts", ["ts"], 4).select("event_id", "user_id")
    _drain(kept.writeStream.format("parquet").option("path", path), path + "-checkpoint")
    return spark.read.schema(kept.schema).parquet(path)


@query(
    "stale_crawl_stream",
    f"""WITH s AS (SELECT event_id, user_id, ts, {IS_ITEM} AS item, {LIMIT} AS lim, min(ts) OVER (PARTITION BY user_id) AS start,
          max(CASE WHEN {IS_ITEM} THEN ts END) OVER (PARTITION BY user_id ORDER BY ts) AS seen FROM events)
        SELECT event_id, lim > 0 AND epoch_us(ts) - epoch_us(coalesce(seen, start)) > CAST(lim AS BIGINT) * 1000000 AS rejected FROM s WHERE NOT item""",
)
def stale_crawl_stream(spark, folder):
    path = scratch(spark, "stale")
    stream = _event_stream(spark, folder)
    done = L.stale_crawl_stream(stream, "user_id", "ts", F.expr(IS_ITEM), F.expr(LIMIT)).select("event_id", "rejected")
    _drain(done.writeStream.format("parquet").option("path", path), path + "-checkpoint")
    return spark.read.schema(done.schema).parquet(path)


@query(
    "live_rollup",
    """SELECT epoch_us(date_trunc('day', ts)) AS window_us, field, value, count(*) AS n FROM
         (UNPIVOT (SELECT ts, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events) ON event_type, user_id INTO NAME field VALUE value) GROUP BY ALL""",
)
def live_rollup(spark, folder):
    path = scratch(spark, "rollup")
    rollup = L.live_rollup(_event_stream(spark, folder), "ts", ["event_type", "user_id"], "1 day")
    _drain(L.write_updates(rollup, path, ["window_start", "field", "value"]), path + "-checkpoint")
    return spark.read.schema(rollup.schema).parquet(path).select(F.unix_micros("window_start").alias("window_us"), "field", "value", "n")


@query(
    "live_missing_counts",
    """WITH m AS (SELECT date_trunc('day', ts) AS d, event_type = 'error' AS a, value < 10 AS b FROM events)
       SELECT epoch_us(d) AS window_us, 'kind' AS field, count(*) AS n FROM m WHERE a GROUP BY 1 UNION ALL SELECT epoch_us(d), 'worth', count(*) FROM m WHERE b GROUP BY 1
       UNION ALL SELECT epoch_us(d), 'any', count(*) FROM m WHERE a OR b GROUP BY 1""",
)
def live_missing_counts(spark, folder):
    path = scratch(spark, "missing")
    stream = _event_stream(spark, folder)
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("")
    worth = F.when(F.col("value") >= 10, F.col("value").cast("string"))
    counts = L.live_missing_counts(stream.select("ts", kind.alias("kind"), worth.alias("worth")), "ts", ["kind", "worth"], "1 day")
    _drain(L.write_updates(counts, path, ["window_start", "field"]), path + "-checkpoint")
    return spark.read.schema(counts.schema).parquet(path).select(F.unix_micros("window_start").alias("window_us"), "field", "n")


@query("idempotent_items", "SELECT user_id, event_id FROM events")
def idempotent_items(spark, folder):
    path = scratch(spark, "once")
    sent = _event_stream(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = L.idempotent_items(sent, "ts", ["user_id", "event_id"]).select("user_id", "event_id")
    _drain(once.writeStream.format("parquet").option("path", path), path + "-checkpoint")
    return spark.read.schema(once.schema).parquet(path)


@query(
    "stop_after_drain",
    """WITH m AS (SELECT user_id, event_type = 'purchase' AS stop, ts < (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS passed FROM events)
       SELECT user_id, count(*) FILTER (WHERE NOT stop) AS n_items, count(*) FILTER (WHERE stop AND passed) AS n_stops FROM m
       GROUP BY user_id HAVING count(*) FILTER (WHERE NOT stop OR passed) > 0""",
)
def stop_after_drain(spark, folder):
    path = scratch(spark, "drain")

    def to(kind):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/kind={kind}/batch_id={batch_id}")

    stream, is_stop = _event_stream(spark, folder), F.col("event_type") == "purchase"
    _drain(L.stop_after_drain(stream, "user_id", "ts", is_stop, to("item"), to("stop")), path + "-checkpoint")
    # Stops of the last ten minutes wait for a watermark that passes them.
    delivered = spark.read.parquet(path).groupBy("user_id")
    return delivered.agg(
        F.count_if(F.col("kind") == "item").alias("n_items"), F.count_if(F.col("kind") == "stop").alias("n_stops")
    )


@query(
    "write_items_stream",
    "SELECT event_id, user_id, event_type AS route FROM events",
)
def write_items_stream(spark, folder):
    path = scratch(spark, "lines")
    rows = _event_stream(spark, folder).select("event_id", "user_id", F.col("event_type").alias("route"))
    _drain(L.write_items_stream(rows, path, "route"), path + "-checkpoint")
    return spark.read.schema(rows.schema).json(path)
