"""Streams fed with several files give what the batch operator gives on all of them."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.operators import rollups, runs
from gleaner.streaming import streams as L

START = datetime(2024, 1, 1)
SCHEMA = "run string, type string, ts timestamp, referencenumber string, company string"


def message(run, minute, kind="job", reference=None, company="c"):
    return (run, kind, START + timedelta(minutes=minute), reference, company)


@pytest.fixture
def feed(spark, tmp_path):
    """A stream that reads each given list of rows as one micro-batch, and its folder for results."""

    def run(*batches):
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false")
        return stream.parquet(str(tmp_path / "in" / "*")), str(tmp_path)

    return run


def drain(writer, folder):
    query = writer.option("checkpointLocation", folder + "/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def all_rows(spark, folder):
    return spark.read.schema(SCHEMA).parquet(folder + "/in/*")


def test_live_rollup_equals_the_batch_rollup(spark, feed):
    stream, out = feed(
        [message("a", 1), message("a", 2, company="d")], [message("a", 59), message("b", 61, company="")], [message("b", 62, company=None)]
    )
    keys = ["window_start", "field", "value"]
    drain(L.write_updates(L.live_rollup(stream, "ts", ["run", "company"]), out + "/out", keys), out)
    live = spark.read.parquet(out + "/out")
    assert live.count() == live.select(*keys).distinct().count()
    total = {(r.field, r.value): r.n for r in live.groupBy("field", "value").agg(F.sum("n").alias("n")).collect()}
    batch = rollups.field_rollup(all_rows(spark, out), ["run", "company"])
    assert total == {(r.field, r.value): r.n for r in batch.collect()}
    assert live.select("window_start").distinct().count() == 2


def test_live_missing_counts(spark, feed):
    stream, out = feed([message("a", 1), message("a", 2, company="")], [message("", 3, company=None)])
    drain(L.write_updates(L.live_missing_counts(stream, "ts", ["run", "company"]), out + "/out", ["window_start", "field"]), out)
    live = spark.read.parquet(out + "/out")
    batch = rollups.missing_field_counts(all_rows(spark, out), ["run", "company"])
    assert {r.field: r.n for r in live.collect()} == {r.field: r.n for r in batch.collect()}


def test_stale_run_sessions(spark, feed):
    stream, out = feed(
        [message("r", 0), message("r", 10), message("s", 0)],
        [message("r", 45), message("s", 30), message("s", 50, "api")],
        [message("late", 300)],
    )
    alerts = L.stale_run_sessions(stream, "run", "ts", F.col("type") == "api")
    drain(alerts.writeStream.format("parquet").option("path", out + "/out"), out)
    rows = spark.read.schema(alerts.schema).parquet(out + "/out").collect()
    minutes = sorted((r.run, (r.last_seen - START).seconds // 60, (r.alert_after - START).seconds // 60) for r in rows)
    assert minutes == [("r", 10, 40), ("r", 45, 75)]


def test_stale_crawl_stream_equals_the_batch_filter(spark, feed):
    batches = [
        [message("r", 0, "start"), message("r", 10, "item"), message("r", 39, "request")],
        [message("r", 41, "request"), message("r", 50, "item"), message("q", 55, "request")],
        [message("r", 70, "request"), message("r", 90, "request"), message("q", 90, "request")],
    ]
    stream, out = feed(*batches)
    is_item, limit = F.col("type") == "item", F.lit(1800)
    done = L.stale_crawl_stream(stream, "run", "ts", is_item, limit, delay="40 minutes")
    drain(done.writeStream.format("parquet").option("path", out + "/out"), out)
    live = spark.read.schema(done.schema).parquet(out + "/out").select("run", "ts", "rejected").collect()
    batch = runs.stale_crawl_filter(all_rows(spark, out), "run", "ts", is_item, limit).select("run", "ts", "rejected").collect()
    assert sorted(live) == sorted(batch)
    assert sorted((r.run, (r.ts - START).seconds // 60) for r in live if r.rejected) == [("q", 90), ("r", 41), ("r", 90)]


def test_time_limit(spark, feed):
    stream, out = feed([message("r", 1), message("r", 9), message("s", 9)])
    limits = spark.createDataFrame([("r", START + timedelta(minutes=5))], "run string, end_time timestamp")
    kept = L.time_limit_stream(stream, limits, "run", "ts")
    drain(kept.writeStream.format("parquet").option("path", out + "/out"), out)
    live = spark.read.schema(kept.schema).parquet(out + "/out").select("run", "ts").collect()
    batch = runs.time_limit_filter(all_rows(spark, out), limits, "run", "ts").select("run", "ts").collect()
    assert sorted(live) == sorted(batch) and len(live) == 2


def test_stops_wait_for_late_items(feed):
    stream, out = feed(
        [message("r", 1), message("r", 5, "api", reference="é"), message("s", 1)],
        [message("r", 3), message("s", 12)],  # an item of r after its stop, within the delay
        [message("s", 20, "api"), message("q", 21), message("r", 2)],  # later than the delay: delivered, but behind the stop
        [message("q", 60)],
        [message("q", 61)],
    )
    log = []

    def note(kind):
        return lambda batch, batch_id: log.extend((batch_id, kind, r.run, (r.ts - START).seconds // 60, r.referencenumber) for r in batch.collect())

    drain(L.stop_after_drain(stream, "run", "ts", F.col("type") == "api", note("item"), note("stop"), "10 minutes"), out)
    items = [(r, m) for _, kind, r, m, _ in log if kind == "item"]
    assert sorted(items) == [("q", 21), ("q", 60), ("q", 61), ("r", 1), ("r", 2), ("r", 3), ("s", 1), ("s", 12)]
    at = {(kind, r, m): i for i, (_, kind, r, m, _) in enumerate(log)}
    assert at["item", "r", 3] < at["stop", "r", 5] and at["item", "s", 12] < at["stop", "s", 20]
    batches = {(r, m): (b, reference) for b, kind, r, m, reference in log if kind == "stop"}
    # The watermark passes minute 5 with the message of minute 20 or 21, and minute 20 with that of minute 60.
    assert set(batches) == {("r", 5), ("s", 20)} and batches["r", 5] == (3, "é") and batches["s", 20][0] == 4


def test_a_run_that_stops_twice_and_one_that_never_does(feed):
    stream, out = feed([message("r", 1, "api"), message("r", 2, "api"), message("s", 0)], [message("s", 100)], [message("r", 101, "api"), message("s", 102)], [message("s", 300)], [message("s", 301)])
    log = []
    drain(L.stop_after_drain(stream, "run", "ts", F.col("type") == "api", lambda b, i: None, lambda b, i: log.extend(sorted((r.ts - START).seconds // 60 for r in b.collect()))), out)
    assert log == [1, 2, 101]


def test_ended_runs_leave_the_state(spark, feed):
    day = 1440
    stream, out = feed([message("r", 0, "item"), message("r", 50, "request")], [message("s", 3 * day, "item")], [message("s", 3 * day + 1, "request")], [message("r", 3 * day + 2, "request")])
    done = L.stale_crawl_stream(stream, "run", "ts", F.col("type") == "item", F.lit(600), forget=timedelta(days=1))
    query = done.writeStream.format("parquet").option("path", out + "/out").option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = {(r.run, (r.ts - START).days, (r.ts - START).seconds // 60): r.rejected for r in spark.read.schema(done.schema).parquet(out + "/out").collect()}
    # A run that comes back after it was forgotten starts anew: its first message counts as seen.
    assert rows == {("r", 0, 50): True, ("s", 3, 1): False, ("r", 3, 2): False}


def test_a_rollup_keeps_one_row_per_key_in_any_number_of_batches(spark, feed):
    batches = [[message("a", 7 * k), message("b", 7 * k + 1, company=f"c{k}")] for k in range(30)]
    stream, out = feed(*batches)
    keys = ["window_start", "field", "value"]
    rollup = L.live_rollup(stream, "ts", ["run", "company"])
    writer = L.write_updates(rollup, out + "/out", keys)
    drain(writer, out)
    live = spark.read.schema(rollup.schema).parquet(out + "/out")
    assert live.count() == live.select(*keys).distinct().count()
    total = {(r.field, r.value): r.n for r in live.groupBy("field", "value").agg(F.sum("n").alias("n")).collect()}
    assert total == {(r.field, r.value): r.n for r in rollups.field_rollup(all_rows(spark, out), ["run", "company"]).collect()}
    folders = [p for p in os.listdir(out + "/out") if not p.startswith(("_", "."))]
    assert len(folders) == live.select("window_start").distinct().count() == 4
    assert max(len([f for f in os.listdir(f"{out}/out/{p}") if f.endswith(".parquet")]) for p in folders) <= 4
    # The last micro-batch again leaves the same table.
    before = sorted(map(tuple, live.collect()))
    again = live.filter(F.col("window_start") == live.agg(F.max("window_start")).first()[0])
    L.merge_updates(again, out + "/out", keys)
    assert sorted(map(tuple, spark.read.schema(rollup.schema).parquet(out + "/out").collect())) == before


def test_items_arrive_once(spark, feed):
    stream, out = feed([message("r", 1, reference="x"), message("r", 2, reference="x")], [message("r", 3, reference="x"), message("s", 3, reference="x")])
    once = L.idempotent_items(stream, "ts", ["run", "referencenumber"]).select("run", "referencenumber")
    drain(once.writeStream.format("parquet").option("path", out + "/out"), out)
    rows = spark.read.schema(once.schema).parquet(out + "/out").collect()
    assert sorted(tuple(r) for r in rows) == [("r", "x"), ("s", "x")]


def test_preview(spark, feed):
    stream, out = feed([message("r", 1), message("r", 2), message("s", 1)], [message("r", 3), message("r", 4)], [message("r", 5), message("s", 5)])
    kept = L.preview_stream(stream, "run", "ts", ["ts"], 3)
    drain(kept.writeStream.format("parquet").option("path", out + "/out"), out)
    live = spark.read.schema(kept.schema).parquet(out + "/out").select("run", "ts").collect()
    batch = runs.preview_cutoff(all_rows(spark, out), "run", [F.asc("ts")], 3).select("run", "ts").collect()
    assert sorted(live) == sorted(batch) and len(live) == 5


def test_item_lines(spark, feed):
    stream, out = feed([message("r", 1, reference="é"), message("s", 1)])
    drain(L.write_items_stream(stream.select("run", "type", "referencenumber"), out + "/out", "type"), out)
    lines = sorted(r.value for r in spark.read.text(out + "/out/type=job").collect())
    assert lines == ['{"run":"r","referencenumber":"é"}', '{"run":"s"}']
