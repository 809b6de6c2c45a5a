import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gleaner.session import get_session

    session = get_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="gleaner-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Values of columns computed over one literal row."""
    from pyspark.sql import functions as F

    def run(*columns, **inputs):
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()], F.lit(0).alias("_"))
        out = list(row.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())
        return out[0] if len(out) == 1 else out

    return run
