"""A site's own Python code inside a plan, in Arrow batches: list processors and page callbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_PER_BATCH = 1000


def python_processor(fn: Callable[[list[str]], list[str]]) -> Callable[[Column], Column]:
    """A processor from a Python function on the list of values; use column functions where they can say it."""

    @F.arrow_udf("array<string>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if v is None else fn(v) for v in column.to_pylist()], pa.list_(pa.string()))

    return lambda values: run(values)


def page_callback(pages: DataFrame, fn: Callable[[dict], Iterable[dict]], columns: Sequence[str], schema: StructType) -> DataFrame:
    """Rows a Python generator yields for each page; it gets the named columns of the page as a dict."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for page in batch.to_pylist():
                for row in fn(page):
                    rows.append(row)
                    if len(rows) == ROWS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return pages.select(*columns).mapInArrow(run, schema)
