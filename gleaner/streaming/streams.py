"""Streams of items, requests and run messages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gleaner.session import cut_lineage

Sink = Callable[[DataFrame, int], None]

# Just over thirty minutes: a message after exactly thirty minutes still belongs to the run.
STALE_GAP = "1800 seconds 1 microsecond"


def live_rollup(items: DataFrame, ts: str, fields: Sequence[str], window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Items per time window, field and value, kept current while items arrive."""
    values = [F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit("none")).alias(f) for f in fields]
    long = items.withWatermark(ts, delay).select(ts, *values).unpivot([ts], list(fields), "field", "value")
    counted = long.groupBy(F.window(ts, window).alias("w"), "field", "value").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "field", "value", "n")


def live_missing_counts(items: DataFrame, ts: str, fields: Sequence[str], window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Items per time window that miss each field, and that miss any."""
    empty = {f: F.col(f).isNull() | (F.col(f) == "") for f in fields}
    names = F.array_compact(F.array(*[F.when(t, F.lit(f)) for f, t in empty.items()]))
    hits = F.when(F.size(names) > 0, F.concat(names, F.array(F.lit("any")))).otherwise(names)
    long = items.withWatermark(ts, delay).select(ts, F.explode(hits).alias("field"))
    counted = long.groupBy(F.window(ts, window).alias("w"), "field").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "field", "n")


def merge_updates(changed: DataFrame, folder: str, keys: Sequence[str], window: str = "window_start", first: bool = False) -> None:
    """Put changed rows in place of those with the same keys in a table with a folder per window.

    Only the windows of the changed rows are read and written again.
    """
    changed = cut_lineage(changed)
    if changed.isEmpty():
        return
    if first:
        merged = changed
    else:
        known = changed.sparkSession.read.schema(changed.schema).parquet(folder)
        known = known.join(changed.select(window).distinct(), window, "left_semi")
        merged = changed.unionByName(known.join(changed, list(keys), "left_anti").select(*changed.columns))
    # Written before its folders are replaced.
    merged = cut_lineage(merged.repartition(window, *[k for k in keys if k != window][:1]))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(window).parquet(folder)


def write_updates(rollup: DataFrame, folder: str, keys: Sequence[str], window: str = "window_start") -> DataStreamWriter:
    """Keep a table of one row per key, a folder per window, current with the rows that each micro-batch changed.

    A window behind the watermark changes no more, so it is never touched again. A repeated micro-batch brings the same rows
    and leaves the same table.
    """
    return rollup.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: merge_updates(batch, folder, keys, window, first=batch_id == 0)
    )


def stale_run_sessions(messages: DataFrame, run: str, ts: str, is_stop: Column, gap: str = STALE_GAP, delay: str = "1 minute") -> DataFrame:
    """Alerts of silent runs: a session of a run that closes without a stop message as its last one."""
    marked = messages.select(run, ts, is_stop.alias("stop")).withWatermark(ts, delay)
    sessions = marked.groupBy(run, F.session_window(ts, gap).alias("w")).agg(
        F.max(ts).alias("last_seen"), F.max(F.struct(ts, "stop")).alias("last")
    )
    return sessions.filter("NOT last.stop").select(run, "last_seen", F.col("w.end").alias("alert_after"))


def idempotent_items(
    items: DataFrame, ts: str, keys: Sequence[str] = ("mining_job_id", "referencenumber"), delay: str = "1 hour", salts: int = 16
) -> DataFrame:
    """Drop items the run has already delivered.

    Copies of one item may be a third of the stream, so they are first dropped within a few salts of the key
    and only what is left of them meets in one task.
    """
    # Drawn row by row, so few tasks use all salts too, and alike when a task runs again; the draw changes no result.
    salted = items.withWatermark(ts, delay).withColumn("_salt", F.floor(F.rand(7) * salts))
    once_per_salt = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return once_per_salt.dropDuplicatesWithinWatermark(list(keys))


# Rows pass a state function as JSON texts, exact in every type.
_EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def _packed(rows: DataFrame, ts: str, delay: str, **more: Column) -> DataFrame:
    """The event time with its watermark, the same in microseconds, the whole row as one text, and `more`."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), _EXACT)
    marked = rows.withColumns({"_row": row, "_us": F.unix_micros(F.col(ts).cast("timestamp")), **more})
    if dict(rows.dtypes)[ts] != "timestamp":
        marked = marked.withColumn(ts, F.col(ts).cast("timestamp"))
    return marked.withWatermark(ts, delay)


def _unpacked(found: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows as they were, with the columns that the state function added."""
    added = [c for c in found.columns if c != "_row"]
    return found.select(F.from_json("_row", rows.schema, _EXACT).alias("_row"), *added).select("_row.*", *added)


def held_stops(messages: DataFrame, run: str, ts: str, is_stop: Column, delay: str = "10 minutes") -> DataFrame:
    """The stop records of a stream, each held until the watermark has passed it.

    Only stops are kept as state, by run, with a timer at the first of them; a run whose stops are all sent is forgotten.
    A stop that is itself later than `delay` is dropped, as a watermark does; one without a time is not among them.
    """
    # The condition looks at the time, as one that does not would be pushed below the watermark, which then saw stops alone.
    timed_stop = F.when(F.col(ts).isNotNull(), F.coalesce(is_stop, F.lit(False))).otherwise(F.lit(False))
    stops = _packed(messages, ts, delay).filter(timed_stop).select(run, ts, "_us", "_row")

    def hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = list(zip(*state.get)) if state.exists else []
        if state.hasTimedOut:
            yield pd.DataFrame({"_row": [row for us, row in held if us // 1000 < now]})
            held = [(us, row) for us, row in held if us // 1000 >= now]
        else:
            for batch in batches:
                held += zip(batch["_us"].tolist(), batch["_row"].tolist())
        if held:
            state.update(tuple(map(list, zip(*held))))
            state.setTimeoutTimestamp(max(min(us for us, _ in held) // 1000, now + 1))
        else:
            state.remove()

    found = stops.groupBy(run).applyInPandasWithState(
        hold, "_row string", "times array<bigint>, rows array<string>", "append", GroupStateTimeout.EventTimeTimeout
    )
    return _unpacked(found, messages)


def stop_after_drain(
    messages: DataFrame, run: str, ts: str, is_stop: Column, write_items: Sink, write_stops: Sink, delay: str = "10 minutes"
) -> DataStreamWriter:
    """Deliver items as they arrive and a stop record only after all items of its run that are at most `delay` late.

    Items pass no state, so a run with most of them is spread as it was read and none of them is dropped; within a micro-batch
    they are written before the stops that go out with it. A stop without a time goes out at once.
    """
    stopped = F.coalesce(is_stop, F.lit(False))
    items = messages.withColumn("_stop", stopped).filter(~F.col("_stop") | F.col(ts).isNull())
    stops = held_stops(messages, run, ts, is_stop, delay).withColumn("_stop", F.lit(True))

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Kept for both writes; a lost executor only means reading its part of the batch again.
        batch.persist()
        try:
            write_items(batch.filter("NOT _stop").drop("_stop"), batch_id)
            write_stops(batch.filter("_stop").drop("_stop"), batch_id)
        finally:
            batch.unpersist()

    return items.unionByName(stops).writeStream.foreachBatch(sink)


def write_items_stream(items: DataFrame, folder: str, route: str | None = None) -> DataStreamWriter:
    """Item lines as they arrive, one folder per route."""
    writer = items.writeStream.format("json").outputMode("append").option("path", folder).option("ignoreNullFields", "true")
    return writer.partitionBy(route) if route else writer


def stale_crawl_stream(
    messages: DataFrame, run: str, ts: str, is_item: Column, limit: Column, delay: str = "10 minutes", forget: timedelta = timedelta(days=7)
) -> DataFrame:
    """The stale-crawl filter on a stream; the time of the first message or last item of each run is kept as state.

    A micro-batch is taken in the order of its times. A run that is silent for `forget` behind the watermark has ended and
    leaves the state; a message later than `delay` is dropped, as a watermark does.
    """
    marked = _packed(messages, ts, delay, _item=F.coalesce(is_item, F.lit(False)), _limit=limit.cast("bigint"))
    kept = forget // timedelta(milliseconds=1)

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["_us", "_item"], ascending=[True, False], kind="stable")
        start = state.get[0] if state.exists else int(rows["_us"].iloc[0])
        seen = rows["_us"].where(rows["_item"]).cummax().ffill().fillna(start).clip(lower=start)
        state.update((int(seen.iloc[-1]),))
        state.setTimeoutTimestamp(max(int(rows["_us"].iloc[-1]) // 1000 + kept, state.getCurrentWatermarkMs() + 1))
        late = (rows["_limit"] > 0) & (rows["_us"] - seen > rows["_limit"] * 1_000_000)
        found = pd.DataFrame({"_row": rows["_row"], "rejected": late.fillna(False).astype(bool)})
        yield found[~rows["_item"].astype(bool)]

    found = marked.select(run, ts, "_us", "_item", "_limit", "_row").groupBy(run).applyInPandasWithState(
        watch, "_row string, rejected boolean", "seen bigint", "append", GroupStateTimeout.EventTimeTimeout
    )
    return _unpacked(found, messages)


def time_limit_stream(requests: DataFrame, runs: DataFrame, run: str, ts: str) -> DataFrame:
    """The time limit on a stream: a join to the table of runs."""
    # One row per run, so copies of a run do not multiply its requests.
    joined = requests.join(runs.groupBy(run).agg(F.max("end_time").alias("end_time")), run, "left")
    return joined.filter(F.col("end_time").isNull() | (F.col(ts) <= F.col("end_time"))).drop("end_time")


def preview_stream(
    items: DataFrame, run: str, ts: str, order: Sequence[str], max_jobs: int, delay: str = "10 minutes", forget: timedelta = timedelta(days=7)
) -> DataFrame:
    """The preview cutoff on a stream: the first `max_jobs` items of each run, by `order` within a micro-batch. 0 has no end.

    How many items a run has had is kept as state; no more than `max_jobs` rows of a run are held at a time. A run that is
    silent for `forget` behind the watermark leaves the state; an item later than `delay` is dropped, as a watermark does.
    """
    if max_jobs <= 0:
        return items
    marked = _packed(items, ts, delay)
    places = [f"_place{i}" for i in range(len(order))]
    marked = marked.select(run, ts, "_us", "_row", *[F.col(c).alias(p, metadata={}) for c, p in zip(order, places)])
    kept = forget // timedelta(milliseconds=1)

    def take(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        taken = state.get[0] if state.exists else 0
        first, last = None, 0
        for batch in batches:
            last = max(last, int(batch["_us"].max()) // 1000)
            first = batch if first is None else pd.concat([first, batch])
            first = first.sort_values(places, kind="stable", na_position="first").head(max_jobs - taken)
        state.update((taken + len(first),))
        state.setTimeoutTimestamp(max(last + kept, state.getCurrentWatermarkMs() + 1))
        yield first[["_row"]]

    found = marked.groupBy(run).applyInPandasWithState(take, "_row string", "taken bigint", "append", GroupStateTimeout.EventTimeTimeout)
    return _unpacked(found, items)
