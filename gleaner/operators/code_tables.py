"""Code mapping with a site's own mapping table instead of a fixed map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import clean_special_chars, remove_words
from gleaner.operators.joins import lookup_join


def map_by_table(items: DataFrame, column: str, code_map: DataFrame, out: str, remove: Sequence[str] = ()) -> DataFrame:
    """Code of a single-valued field from `code_map(key, code)`, or its cleaned value in upper case."""
    cleaned = F.get(clean_special_chars(F.array(remove_words(remove)(F.col(column)))), F.lit(0))
    keyed = items.withColumn("_clean", cleaned).withColumn("_key", F.lower("_clean"))
    codes = code_map.groupBy(F.lower("key").alias("_key")).agg(F.min("code").alias("_code"))
    joined = lookup_join(keyed, codes, ["_key"])
    return joined.withColumn(out, F.coalesce("_code", F.upper("_clean"))).drop("_clean", "_key", "_code")
