"""What the operators of this subpackage share: inputs, Arrow helpers and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import cut_lineage, spread

#: Text rows differ in size by a factor of a million, so Arrow batches are cut by bytes as well as by rows.
BATCH_BYTES = str(4 * 1024 * 1024)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, so a batch of very long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of a table whatever else it holds; a null text is empty."""
    small_batches(df.sparkSession)
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))


def give_back() -> None:
    """Return to the system the memory that a task of a Python worker has freed, at the end of the task.

    Spark keeps idle workers and takes them in turn. What numpy and Arrow free stays with the process otherwise, so each worker
    would hold on to the most that any stage before took.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """Apply `rows` (columns of the result by name) to each Arrow batch."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = rows(batch)
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in arrow], schema=arrow)
                del found
        give_back()

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def table_of(schema: pa.Schema, columns: dict[str, list]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Edges of a task that writes to a shuffle of `components`.
EDGES = 50_000


def few_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks that write a table of so many short rows: as few as its rows need, but one for each core."""
    return min(partitions(spark), max(spark.sparkContext.defaultParallelism, rows // EDGES + 1))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected `edges` (a, b); component is the least node reachable.

    Rounds of large-star and small-star: each node hangs its larger neighbours, then its smaller ones, under the
    least node it sees, so the depth of a component shrinks by a constant factor per round. Messages to a node are
    combined before the shuffle; no node's neighbours are gathered, so a hub is no hot group. Lineage is cut every round.
    A round is written by as many tasks as its edges need, as few edges in many tasks would be mostly files.
    """
    spark = edges.sparkSession
    edges = cut_lineage(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        tasks = few_tasks(spark, state[0])
        edges = cut_lineage(_small_star(_large_star(edges.coalesce(tasks), tasks).coalesce(tasks), tasks).coalesce(tasks))


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct()


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").coalesce(tasks).distinct()


def joined(spans: Column) -> Column:
    return F.concat_ws(",", spans)
