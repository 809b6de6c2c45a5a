"""Joins to a table with one row per key, and ordered carries, both safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a lookup table: true when its rows, written as JSON, stay under `limit` bytes."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    size = df.agg(F.sum(F.octet_length(row)).alias("n")).first()["n"]
    return (size or 0) <= limit


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join many rows to a lookup with one row per key.

    A lookup measured to be small is broadcast, so the facts are not shuffled and a hot key stays spread.
    A larger one is joined by shuffle, where adaptive execution splits the partition of a hot key.
    """
    return facts.join(F.broadcast(lookup) if fits_broadcast(lookup, limit) else lookup, list(on), how)


# Sorts a carried row before every row of its bucket.
_FAR = 1 << 62


def _carry(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: Column,
    name: str,
    bucket: str,
    back: bool,
    strict: bool,
    initial: Column | None = None,
) -> DataFrame:
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    first = F.lit(None).cast("timestamp") if initial is None else initial
    facts = df.withColumns(
        {BUCKET: F.date_trunc(bucket, F.col(ts)), "_value": value, "_first": first, "_place": micros, "_carried": F.lit(False)}
    )
    edge = F.max if back else F.min
    passed = Window.partitionBy(*key).orderBy(F.col(BUCKET).asc() if back else F.col(BUCKET).desc())
    passed = passed.rowsBetween(Window.unboundedPreceding, -1)

    def reached(window) -> Column:
        found = edge("_value").over(window)
        return found if initial is None else F.coalesce(found, F.min("_first").over(window))

    carried = facts.groupBy(*key, BUCKET).agg(edge("_value").alias("_value"), F.min("_first").alias("_first"))
    carried = carried.select(
        *key, BUCKET, reached(passed).alias("_value"), F.lit(-_FAR if back else _FAR).alias("_place"), F.lit(True).alias("_carried")
    )
    # One extra row per bucket brings the value in, so the facts are shuffled and sorted once and never joined.
    both = facts.unionByName(carried.filter(F.col("_value").isNotNull()), allowMissingColumns=True)
    within = Window.partitionBy(*key, BUCKET).orderBy(F.col("_place").asc() if back else F.col("_place").desc())
    within = within.rangeBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    return both.withColumn(name, reached(within)).filter(~F.col("_carried")).drop("_value", "_first", "_place", "_carried")


def carry_forward(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: Column,
    name: str,
    bucket: str = "minute",
    strict: bool = False,
    initial: Column | None = None,
) -> DataFrame:
    """Greatest `value` at or before each row of the same key; `strict` leaves out rows of the same time.

    Where there is none yet, the least `initial` so far is taken.

    Rows are grouped by key and time bucket, so a key with a third of all rows is spread over its buckets;
    only one summary row per bucket crosses them. The bucket stays as a column, so a caller can go on grouping
    without another shuffle.
    """
    return _carry(df, key, ts, value, name, bucket, back=True, strict=strict, initial=initial)


def carry_backward(
    df: DataFrame, key: Sequence[str], ts: str, value: Column, name: str, bucket: str = "minute", strict: bool = False
) -> DataFrame:
    """Least `value` at or after each row of the same key; see `carry_forward`."""
    return _carry(df, key, ts, value, name, bucket, back=False, strict=strict)
