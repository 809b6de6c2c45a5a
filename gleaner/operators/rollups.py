"""Counts, rollups and top-k reports over items, requests and runs.

Every group-by here combines in the map task first, so a hot value costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import digits_of, long_of
from gleaner.session import cut_lineage

# Range and precision of the parse time histogram, in milliseconds.
SHORTEST_MS, LONGEST_MS = 1, 5000
EXACT_BELOW_MS = 256  # two significant digits


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group; Spark keeps k rows per group in every task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= k)


def rollup_settings(text: str) -> dict[str, int]:
    """`company:10,jobtype` to the number of values to report per field, -1 for all."""
    parts = [part.partition(":") for part in text.split(",")]
    return {name: int(n) if n else -1 for name, _, n in parts}


def field_rollup(items: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Items per field and value; an absent or empty value counts as 'none'."""
    values = [F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit("none")).alias(f) for f in fields]
    long = items.select(*values).unpivot([], list(fields), "field", "value")
    return long.groupBy("field", "value").agg(F.count("*").alias("n"))


def field_uniques(rollup: DataFrame) -> DataFrame:
    """Distinct values per field; the rollup has one row for each."""
    return rollup.groupBy("field").agg(F.count("*").alias("n_values"))


def field_topk(rollup: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Most frequent values of the limited fields, ties by value; all values of the others.

    Only limited fields are ranked, so no task ever holds all values of an unlimited one.
    """
    limited = {f: k for f, k in limits.items() if k > 0}
    free = [f for f in limits if f not in limited]
    if limited and free:
        rollup = cut_lineage(rollup)  # read twice below
    parts = [rollup.filter(F.col("field").isin(free))] if free else []
    if limited:
        most = max(limited.values())
        ranked = top_per_group(rollup.filter(F.col("field").isin(list(limited))), ["field"], [F.desc("n"), F.asc("value")], most)
        allowed = F.coalesce(*[F.when(F.col("field") == f, F.lit(k)) for f, k in limited.items()])
        parts.append(ranked.filter(F.col("rank") <= allowed).drop("rank"))
    return reduce(DataFrame.unionByName, parts)


def missing_field_counts(items: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows that miss each field, and rows that miss any, in one pass."""
    empty = {f: F.col(f).isNull() | (F.col(f) == "") for f in fields}
    any_empty = F.lit(False)
    for test in empty.values():
        any_empty = any_empty | test
    wide = items.agg(*[F.count_if(t).alias(f) for f, t in empty.items()], F.count_if(any_empty).alias("any"))
    return wide.unpivot([], wide.columns, "field", "n")


def expected_job_count(items: DataFrame, claims: DataFrame, run: str, claim: str) -> DataFrame:
    """Items per run beside the number its site claims: -1 when the claim has no digits, NULL when there is no claim."""
    expected = claims.groupBy(run).agg(F.max(digits_of(F.col(claim))).alias("expected"))
    found = items.groupBy(run).agg(F.count("*").alias("n_items"))
    return expected.join(found, run, "full_outer").withColumn("n_items", F.coalesce("n_items", F.lit(0).cast("bigint")))


def serp_expected_count(text: Column) -> Column:
    """Largest number in the text of the selected element, separators removed; 0 without one."""
    numbers = F.transform(
        F.regexp_extract_all(text, F.lit(r"[.,\d]+"), F.lit(0)),
        lambda n: long_of(F.regexp_replace(n, "[^0-9]", "")),
    )
    return F.coalesce(F.array_max(numbers), F.lit(0).cast("bigint"))


def _bin_top(ms: Column) -> Column:
    """Highest value counted with `ms`: exact at first, then steps that double with the value."""
    clipped = F.least(F.greatest(ms.cast("bigint"), F.lit(SHORTEST_MS)), F.lit(LONGEST_MS))
    top, low, step = clipped, EXACT_BELOW_MS, 2
    while low <= LONGEST_MS:
        top = F.when(clipped >= low, clipped - clipped % step + (step - 1)).otherwise(top)
        low, step = low * 2, step * 2
    return top


def parse_time_histogram(times: DataFrame, ms: Column, group: Sequence[str] = ()) -> DataFrame:
    """Total, count, average and exact percentiles of the histogram of parse times.

    A group has at most about a thousand bins, so its bins fit in one row however many times it holds.
    """
    bins = times.groupBy(*group, _bin_top(ms).alias("ms")).agg(F.count("*").alias("n"))
    packed = bins.groupBy(*group).agg(
        F.sum(F.col("ms") * F.col("n")).alias("total_ms"),
        F.sum("n").alias("n_times"),
        F.array_sort(F.collect_list(F.struct("ms", "n"))).alias("_bins"),
    )

    def percentile(p: int) -> Column:
        target = F.greatest(F.floor(F.col("n_times") * p / 100 + 0.5), F.lit(1))
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).cast("bigint").alias("at"))
        return F.aggregate(
            "_bins",
            start,
            lambda acc, b: F.when(
                acc["seen"] < target, F.struct((acc["seen"] + b["n"]).alias("seen"), b["ms"].alias("at"))
            ).otherwise(acc),
            lambda acc: acc["at"],
        )

    return packed.select(
        *group,
        "total_ms",
        "n_times",
        F.floor(F.col("total_ms") / F.col("n_times")).alias("average_ms"),
        percentile(50).alias("p50_ms"),
        percentile(90).alias("p90_ms"),
    )


def drop_counts(rejected: DataFrame, reason: str) -> DataFrame:
    return rejected.groupBy(reason).agg(F.count("*").alias("n"))


def request_latency(events: DataFrame, request: str, is_start: Column, ts: str) -> DataFrame:
    """Seconds from start to end of each request that has both; one shuffle pairs the events."""
    paired = events.groupBy(request).agg(
        F.min(F.when(is_start, F.col(ts))).alias("start_time"), F.max(F.when(~is_start, F.col(ts))).alias("end_time")
    )
    both = paired.filter(F.col("start_time").isNotNull() & F.col("end_time").isNotNull())
    micros = F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))
    return both.withColumn("micros", micros)


def latest_run(runs: DataFrame, spider: str, updated: str, run: str) -> DataFrame:
    """Last updated run of each spider, the higher run id on a tie."""
    rest = [c for c in runs.columns if c != spider]
    last = F.max_by(F.struct(*rest), F.struct(updated, run)).alias("_last")
    return runs.groupBy(spider).agg(last).select(spider, "_last.*")


def recent_failures(latest: DataFrame, updated: str, now: Column, hours: int = 2) -> DataFrame:
    """Finished latest runs with errors, updated within the last hours."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(updated).cast("timestamp"))
    fresh = (age >= 0) & (age < hours * 3_600_000_000)
    return latest.filter((F.col("state") == "finished") & (F.col("errors_count") > 0) & fresh)


def startable(latest: DataFrame) -> DataFrame:
    return latest.filter(F.col("state") != "running")
