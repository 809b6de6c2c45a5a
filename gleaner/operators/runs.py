"""Requests and messages of crawl runs against the time of the run: the batch forms of the stream filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.joins import BUCKET, carry_backward, carry_forward, lookup_join
from gleaner.operators.validate import max_items_limit

# Fixed value: a run without a message for this long is stale.
MAX_AGE = "INTERVAL 30 MINUTES"


def _seconds(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / 1_000_000


def stale_crawl_filter(messages: DataFrame, run: str, ts: str, is_item: Column, limit: Column, bucket: str = "minute") -> DataFrame:
    """Add `rejected` to the requests of each run: no item seen for more than `limit` seconds.

    The first message of a run counts as seen; a limit of 0 switches the filter off. Items leave the result.
    """
    marked = messages.withColumns({"_item": is_item, "_limit": limit})
    item_time = F.when(F.col("_item"), F.col(ts))
    seen = carry_forward(marked, [run], ts, item_time, "last_seen", bucket, initial=F.col(ts))
    rejected = (F.col("_limit") > 0) & (_seconds(F.col(ts), F.col("last_seen")) > F.col("_limit"))
    return seen.filter(~F.col("_item")).withColumn("rejected", rejected).drop("_item", "_limit", BUCKET)


def stale_run_alerts(
    messages: DataFrame, run: str, ts: str, is_stop: Column, now: Column, max_age: str = MAX_AGE, bucket: str = "minute"
) -> DataFrame:
    """One row per silence: `run, last_seen, alert_after`; a stop message clears the run."""
    flagged = messages.select(run, ts, is_stop.alias("_stop"))
    nexts = carry_backward(flagged, [run], ts, F.col(ts), "_next", bucket, strict=True)
    # Messages of one time: a stop among them clears the run.
    moments = nexts.groupBy(run, BUCKET, ts).agg(F.bool_or("_stop").alias("_stop"), F.min("_next").alias("_next"))
    alert_after = F.col(ts) + F.expr(max_age)
    silent = F.coalesce(F.col("_next"), now) > alert_after
    return moments.filter(~F.col("_stop") & silent).select(run, F.col(ts).alias("last_seen"), alert_after.alias("alert_after"))


def time_limit_filter(requests: DataFrame, runs: DataFrame, run: str, ts: str) -> DataFrame:
    """Requests not later than the end time of their run; a run without one keeps all."""
    ends = runs.groupBy(run).agg(F.max("end_time").alias("end_time"))
    kept = lookup_join(requests, ends, [run])
    return kept.filter(F.col("end_time").isNull() | (F.col(ts) <= F.col("end_time"))).drop("end_time")


def preview_cutoff(items: DataFrame, run: str, order: Sequence[Column], max_jobs: int) -> DataFrame:
    """A preview run ends after `max_jobs` accepted items; 0 has no end."""
    return max_items_limit(items, run, order, max_jobs)
