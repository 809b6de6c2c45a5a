"""Harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: class c takes lengths of capacity / c, and each of its bins takes exactly c
pieces. Documents may be cut, so every document is cut into whole bins and, for the rest, into powers of two: then each piece
fills its share of a bin exactly, and no bin is padded. Workers number the pieces of each class on their own; the counts per
worker and class, a table as long as there are tasks, turn these numbers into bins that go on across workers. The few pieces
that fill no last bin are put into bins whose filling is a power of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.bpe import encoder
from gleaner.llm.common import arrow_schema, give_back, texts
from gleaner.session import cut_lineage

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, ordinal long"


def cut(tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the pieces of documents of so many tokens.

    Each document's whole bins come first, then the powers of two of the rest, longest first.
    """
    whole, rest = np.divmod(tokens, capacity)
    powers = capacity >> np.arange(1, capacity.bit_length())
    in_rest = rest[:, None] & powers > 0
    doc = np.repeat(np.arange(len(tokens)), whole + in_rest.sum(axis=1))
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    length = np.full(len(doc), capacity)
    length[place >= whole[doc]] = np.broadcast_to(powers, in_rest.shape)[in_rest]
    start = np.cumsum(length) - length - (np.cumsum(tokens) - tokens)[doc]
    return doc, start, length


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every row with the worker that cut them and their number in their class on this worker."""
    arrow = arrow_schema(docs.sparkSession, PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        used = [0] * (capacity.bit_length() + 1)
        own = encoder(path, side_by_side=True)
        for batch in batches:
            ids, tokens = own.encode_rows(batch["text"].to_pylist())
            packed = np.insert(ids, np.cumsum(tokens), end_id).astype("<u4").tobytes()
            tokens += 1
            doc, start, length = cut(tokens, capacity)
            ordinal = np.empty_like(length)
            for share in range(1, capacity.bit_length() + 1):
                of_class = np.flatnonzero(length == 1 << share - 1)
                ordinal[of_class] = used[share] + np.arange(len(of_class))
                used[share] += len(of_class)
            ends = (4 * np.cumsum(length)).tolist()
            crcs = [zlib.crc32(packed[i:j]) for i, j in zip([0, *ends], ends)]
            numbers = start, length, crcs, tokens[doc], np.full(len(doc), worker), ordinal
            columns = [pa.array(n, f.type) for n, f in zip(numbers, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(doc)), *columns], schema=arrow)
        # Spark keeps idle workers and takes them in turn; each would go on holding its words.
        own.forget()
        give_back()

    return texts(docs).mapInArrow(run, PIECES)


def harmonic_pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every row.

    `capacity` is a power of two. Texts are read once; the pieces, a few numbers each, are written to the shared checkpoint
    folder with their worker's numbering, so a lost executor changes no number. A null or empty text is the end id alone;
    repeated rows and null doc_ids are packed like any other row; an empty table has no pieces.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    return place(cut_lineage(token_pieces(docs, path, capacity, end_id)), capacity)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Sequence and offset of numbered pieces whose lengths are powers of two."""
    # A row per worker and class: its size follows the number of tasks, not the number of pieces.
    counts = pieces.groupBy("length", "worker").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("worker")
    counts = counts.select(
        "length",
        "worker",
        F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("length")).alias("total"),
    )
    per_bin = F.lit(capacity) / F.col("length")
    classes = counts.select("length", "total").distinct()
    bins = (F.floor(F.col("total") / per_bin) + F.bit_count(F.col("total") % per_bin.cast("long"))).cast("long")
    # One row per class, twelve at a capacity of 2048.
    classes = classes.select("length", bins.alias("bins"))
    classes = classes.select(
        "length",
        F.coalesce(
            F.sum("bins").over(Window.partitionBy(F.lit(0)).orderBy("length").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("first_bin"),
    )
    found = pieces.join(counts.join(classes, "length"), ["length", "worker"])
    share = per_bin.cast("long")
    rank = F.col("before") + F.col("ordinal")
    full = F.col("total") - F.col("total") % share
    left, rest = rank - full, F.col("total") % share
    # Pieces beyond the last full bin: the highest bit in which their number and the count differ names their bin.
    block = _high_bit(left.bitwiseXOR(rest))
    high = F.bit_count(rest) - F.bit_count(rest.bitwiseAND(block.bitwiseOR(block - 1)))
    number = F.when(rank < full, F.floor(rank / share)).otherwise(F.floor(full / share) + high)
    slot = F.when(rank < full, rank % share).otherwise(left.bitwiseAND(block - 1))
    return found.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first_bin") + number).cast("long").alias("sequence_id"),
        (slot * F.col("length")).cast("long").alias("offset"),
    )


def _high_bit(value: Column) -> Column:
    """The highest set bit of a small positive number."""
    return F.pow(F.lit(2.0), F.floor(F.log2(value.cast("double")))).cast("long")
