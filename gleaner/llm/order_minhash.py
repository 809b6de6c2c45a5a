"""Order MinHash fingerprints of documents.

The k-mers of a text are numbered by occurrence, so a repeated k-mer counts as often as it stands there. Each of several
independent orders of the numbered k-mers selects the `picks` minimal ones; the k-mers selected are put back into text order
and hashed as a tuple. Two fingerprints agree in a place with a chance that falls with the edit distance of the texts, not
only with the overlap of their k-mers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, partitions, small_batches, texts

K = 8
PLACES = 32
PICKS = 2
_BLOCK = 8192
#: A k-mer is told by the other bits of its hash, in texts of any length.
_PLACE_BITS = np.uint64(24)
_PLACE_LIMIT = 1 << 24
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _orders(places: int) -> np.ndarray:
    seeds = _mixed(np.arange(1, places + 1, dtype=np.uint64) * _M1)
    return np.stack([seeds, _mixed(seeds) | np.uint64(1)])


def kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k-mer of code points; a shorter text is one k-mer, an empty one has none."""
    if len(points) == 0:
        return np.empty(0, dtype=np.uint64)
    k = min(k, len(points))
    n = len(points) - k + 1
    found = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        found *= _M1
        found += points[j : j + n]
    return _mixed(found)


def fingerprint(text: str, k: int = K, places: int = PLACES, picks: int = PICKS) -> np.ndarray:
    """`places` 32-bit tuple hashes; all 0 for an empty text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(points) - min(k, len(points)) + 1 if len(points) else 0
    if n == 0:
        return np.zeros(places, dtype=np.uint32)
    # One sort brings equal k-mers together in text order: the low bits hold the place. A k-mer has the same bits in every text.
    at = np.uint64(_PLACE_LIMIT - 1)
    hashes = kmer_hashes(points, k)
    if n <= _PLACE_LIMIT:
        order = hashes & ~at | np.arange(n, dtype=np.uint64)
        order.sort()
        place, kmer = order & at, order >> _PLACE_BITS
    else:
        hashes >>= _PLACE_BITS
        place = np.argsort(hashes, kind="stable")
        kmer = hashes[place]
    first = np.zeros(n, dtype=np.int64)
    new = np.flatnonzero(kmer[1:] != kmer[:-1]) + 1
    first[new] = new
    occurrence = (np.arange(n) - np.maximum.accumulate(first)).astype(np.uint64)
    numbered = _mixed(kmer * _M3 + occurrence * _M1)
    seeds, factors = _orders(places)
    picks = min(picks, n)
    best_value, best_at = [], []
    rows = np.arange(places)
    for start in range(0, n, _BLOCK):
        part = (numbered[start : start + _BLOCK][None, :] ^ seeds[:, None]) * factors[:, None]
        for _ in range(min(picks, part.shape[1])):
            least = part.argmin(axis=1)
            best_value.append(part[rows, least])
            best_at.append(least + start)
            part[rows, least] = np.uint64(0xFFFFFFFFFFFFFFFF)
    value, where = np.stack(best_value, axis=1), np.stack(best_at, axis=1)
    chosen = np.take_along_axis(where, np.argsort(value, axis=1, kind="stable")[:, :picks], axis=1)
    in_text = np.take_along_axis(chosen, np.argsort(place[chosen], axis=1), axis=1)
    found = seeds.copy()
    for j in range(picks):
        found = _mixed(found * _M1 + kmer[in_text[:, j]])
    return (found >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places, 0 to 1."""
    return float(np.mean(a == b))


def edited(text: str, other: str) -> str:
    """`text` with its last quarter of code points replaced by the first as many of `other`."""
    cut = len(text) // 4
    return text[: len(text) - cut] + other[:cut]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, tail, doc_id, text): rows by ranges of doc_id, each range followed by a copy of the next one's first row.

    Texts are shuffled once, to their range. The bounds come from an approximate quantile; there are as many as shuffle
    partitions, so they and the first id of each range are the only values that the driver sees. After the last range comes
    the first row of the table. Rows of a range are taken in the order of doc_id, then text; null ids come first.
    """
    n = partitions(docs.sparkSession)
    ids = docs.select("doc_id")
    bounds = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n) if n > 1 else F.array()).first()[0]
    bounds = sorted(set(bounds or []))
    bucket = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    bucket = F.coalesce(F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(bucket), F.lit(0))
    heads = {r["bucket"]: r["head"] for r in ids.groupBy(bucket.alias("bucket")).agg(
        F.when(F.count(F.when(F.col("doc_id").isNull(), 1)) > 0, F.lit(None)).otherwise(F.min("doc_id")).alias("head")
    ).collect()}
    used = sorted(heads)
    before = {heads[b]: used[i - 1] for i, b in enumerate(used)}
    own = F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("tail"))
    copies = F.array(own)
    named = [h for h in before if h is not None]
    if named:
        last = F.create_map(*[F.lit(x) for h in named for x in (h, before[h])])
        copies = F.when(F.col("doc_id").isin(named), F.array(own, F.struct(last[F.col("doc_id")].cast("int").alias("bucket"), F.lit(True).alias("tail")))).otherwise(copies)
    if None in before:
        copies = F.when(F.col("doc_id").isNull(), F.array(own, F.struct(F.lit(before[None]).cast("int").alias("bucket"), F.lit(True).alias("tail")))).otherwise(copies)
    spread = docs.select(F.inline(copies), "doc_id", "text")
    return spread.repartitionById(n, F.col("bucket") % F.lit(n)).sortWithinPartitions("bucket", "tail", "doc_id", "text")


def order_minhash(docs: DataFrame, k: int = K, places: int = PLACES, picks: int = PICKS) -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likeness to each other and to the next row's.

    A null or empty text has the fingerprint of zeros, as has its edited text if that is empty; two of them are fully alike.
    A single row follows itself. Rows with equal ids are ordered by text.
    """
    small_batches(docs.sparkSession)
    arrow = arrow_schema(docs.sparkSession, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        out: list[tuple] = []

        def follow(text: str, mark: np.ndarray) -> None:
            _, doc_id, own, own_mark = held
            other = edited(own, text)
            other_mark = fingerprint(other, k, places, picks) if other != own else own_mark
            out.append(
                (
                    doc_id,
                    len(own),
                    hashlib.sha256(other.encode()).hexdigest(),
                    own_mark.tobytes().hex(),
                    other_mark.tobytes().hex(),
                    likeness(own_mark, other_mark),
                    likeness(own_mark, mark),
                )
            )

        for batch in batches:
            for bucket, tail, doc_id, text in zip(*[batch[c].to_pylist() for c in ("bucket", "tail", "doc_id", "text")]):
                if tail and (held is None or held[0] != bucket):
                    continue
                mark = fingerprint(text, k, places, picks)
                if held is not None and held[0] == bucket:
                    follow(text, mark)
                held = None if tail else (bucket, doc_id, text, mark)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(arrow), arrow)], schema=arrow)
            out.clear()

    return with_next(texts(docs)).mapInArrow(run, SCHEMA)
