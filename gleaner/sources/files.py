"""Feeds, dictionaries, robots texts, selector configs, page bytes and item lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import each, strip

# Fixed value: a robots file is read up to this many bytes.
ROBOTS_BYTES = 100 * 1024

# The characters cp1252 puts where ISO-8859-1 has control codes.
CP1252 = {b: bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
UTF8_NAMES = ("utf-8", "utf8")
LATIN_NAMES = ("iso-8859-1", "latin-1", "latin1")
CP1252_NAMES = ("cp1252", "windows-1252")


def scan_url_feed(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file, stripped, with a key that sorts them as they stand in the file."""
    lines = spark.read.text(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return lines.select(place.alias("line_no"), strip(F.col("value")).alias("url"))


def scan_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """First column of a csv file without header."""
    return spark.read.csv(path, header=False).select(F.col("_c0").alias("term"))


def scan_robots(robots: DataFrame, host: str = "host", body: str = "body", most_bytes: int | None = None) -> DataFrame:
    """One row per line of each robots text, numbered in file order.

    `most_bytes` reads only the head of a text, as crawlers that stop at `ROBOTS_BYTES` do; without it the whole text is read.
    """
    text = F.col(body)
    whole = text
    if most_bytes is not None:
        head = F.make_valid_utf8(F.substring(F.encode(text, "UTF-8"), 1, most_bytes).cast("string"))
        whole = F.when(F.octet_length(text) <= most_bytes, text).otherwise(head)
    return robots.select(host, F.posexplode(F.split(whole, "\r\n|\r|\n")).alias("line_no", "line"))


def robots_media_type(header: Column) -> Column:
    """Media type and charset of a content-type header, both in lower case."""
    text = F.lower(strip(F.coalesce(header, F.lit(""))))
    chunks = each(strip)(F.split(text, ";"))
    named = F.transform(
        F.slice(chunks, F.lit(2), F.size(chunks)), lambda c: F.regexp_extract(c, """charset=['"]?([^'"]*)['"]?""", 1)
    )
    charset = F.try_element_at(F.filter(named, lambda c: c != ""), F.lit(-1))
    return F.struct(
        strip(F.get(chunks, F.lit(0))).alias("media_type"), strip(F.coalesce(charset, F.lit(""))).alias("charset")
    )


def parse_selector_config(config: Column) -> Column:
    """Config text to `array<struct<id,selector>>`; no config, an empty list."""
    return F.coalesce(
        F.from_json(config, "array<struct<id:string,selector:string>>"),
        F.array().cast("array<struct<id:string,selector:string>>"),
    )


def decode_body(body: Column, charset: Column) -> Column:
    """Page bytes to text by the inferred charset, else UTF-8; bytes that do not fit become U+FFFD.

    The common charsets are decoded in the JVM. Only pages in another charset are handed to Python.
    """
    name = F.lower(F.coalesce(charset, F.lit("utf-8")))
    latin = F.decode(F.when(name.isin(*LATIN_NAMES, *CP1252_NAMES), body), "ISO-8859-1")
    codes = "".join(chr(b) for b in CP1252)
    rare = ~name.isin(*UTF8_NAMES, *LATIN_NAMES, *CP1252_NAMES)

    @F.arrow_udf("string")
    def decode(column: pa.Array, names: pa.Array) -> pa.Array:
        def one(data: bytes | None, codec: str) -> str | None:
            try:
                return None if data is None else data.decode(codec, "replace")
            except LookupError:
                return data.decode("utf-8", "replace")

        return pa.array([one(*row) for row in zip(column.to_pylist(), names.to_pylist())], pa.string())

    return (
        F.when(name.isin(*UTF8_NAMES), F.make_valid_utf8(body.cast("string")))
        .when(name.isin(*LATIN_NAMES), latin)
        .when(name.isin(*CP1252_NAMES), F.translate(latin, codes, "".join(CP1252.values())))
        .otherwise(decode(F.when(rare, body), name))
    )


def payload_b64url(fields: Sequence[str]) -> Column:
    """Item fields as JSON in url-safe base64 on one line, padding kept."""
    encoded = F.base64(F.encode(F.to_json(F.struct(*fields)), "UTF-8"))
    return F.translate(encoded, "+/\r\n", "-_")


def write_items_jsonl(items: DataFrame, path: str, route: str | None = None) -> None:
    """JSON lines; absent fields are omitted, other alphabets stay as they are."""
    writer = items.write.mode("overwrite").option("ignoreNullFields", "true")
    (writer.partitionBy(route) if route else writer).json(path)


def route_items(preview: Column, aggregator: Column, autocrawl: Column, extract: Column) -> Column:
    """Where an item goes: preview first, then aggregator, then autocrawl, then by mode."""
    return (
        F.when(preview, F.when(extract, "temp-job").otherwise("temp-raw"))
        .when(aggregator, "aggregator")
        .when(autocrawl, "autocrawl")
        .when(extract, "job")
        .otherwise("raw")
    )


def run_lifecycle(
    messages: DataFrame,
    run: str,
    ts: str,
    carried: Sequence[str] = (),
    route: Column | None = None,
    end_fields: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A start and a stop row per run; `carried` columns hold one value per run.

    `route` is computed per run; the end fields are set on the stop row of an autocrawl run only.
    """
    runs = messages.groupBy(run, *carried).agg(F.min(ts).alias("start"), F.max(ts).alias("stop"))
    moments = F.array(
        F.struct(F.lit("start").alias("message"), F.col("start").alias("at")),
        F.struct(F.lit("stop").alias("message"), F.col("stop").alias("at")),
    )
    routed = runs.withColumn("route", F.lit("mining-job") if route is None else route)
    rows = routed.select("*", F.inline(moments)).drop("start", "stop")
    ends = (F.col("route") == "autocrawl") & (F.col("message") == "stop")
    return rows.withColumns({name: F.when(ends, value) for name, value in (end_fields or {}).items()})


def lifecycle_route(preview: Column, aggregator: Column, autocrawl: Column) -> Column:
    return (
        F.when(preview, "temp-job").when(aggregator, "aggregator-job").when(autocrawl, "autocrawl").otherwise("mining-job")
    )
