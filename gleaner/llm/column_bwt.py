"""Repeated passages by column-wise construction of the Burrows-Wheeler transform of many strings.

The construction takes a collection of strings and inserts one symbol of every string per round, from the right: the symbol that
stands before a suffix in the transform tells, by its rank among equal symbols, where the next longer suffix of that string goes.
The transform of a round is read in order from one file and that of the next round is written in order to another. At the end
the suffixes stand in sorted order, and the common prefixes of neighbours tell which of them start with the same bytes.

Inserting whole documents would take as many rounds over the whole collection as the longest document has bytes. So strings
are cut around anchors: the least hash of the short substrings in every stretch of `SPAN` bytes, which any two equal stretches
share at the same place. First the anchors that occur in one document only leave; they cannot stand in a repeated stretch. The
stretches around each remaining anchor are the strings of one collection per range of anchors.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, give_back, partitions, small_batches, table_of
from gleaner.llm.order_minhash import _mixed
from gleaner.session import cut_lineage

SPAN = 50
#: Bytes of an anchor.
ANCHOR = 32
#: Bytes of a row that holds the stretch around an anchor, a whole number of 64-bit words.
WIDTH = -(-(2 * SPAN - ANCHOR) // 8) * 8
#: Bytes of the transform held in memory before its file goes to disk.
SPOOL = 64 << 20
NO_ID = np.iinfo(np.int64).max
_FACTOR = np.uint32(0x9E3779B1)


def _extreme(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of each window of `width`, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def anchors(text: np.ndarray, span: int = SPAN, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text of bytes, and a 64-bit hash of each; every window of `span` bytes holds one whole."""
    n = len(text)
    if n < span:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    low = text.astype(np.uint32) + np.uint32(1)
    high = low.copy()
    size, factor, other = 1, _FACTOR, np.uint32(0x85EBCA6B)
    with np.errstate(over="ignore"):
        while size < anchor:
            low = low[: len(low) - size] * factor + low[size:]
            high = high[: len(high) - size] * other + high[size:]
            factor, other, size = factor * factor, other * other, size * 2
        order = (low ^ (low >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        order ^= order >> np.uint32(12)
    width = span - anchor + 1
    least = _extreme(order, width, np.minimum)
    reach = np.concatenate([np.zeros(width - 1, dtype=np.uint32), least, np.zeros(width - 1, dtype=np.uint32)])
    places = np.flatnonzero(order == _extreme(reach, width, np.maximum))
    return places, _mixed(low[places].astype(np.uint64) << np.uint64(32) | high[places])


def suffix_order(strings: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of every suffix of the collection in sorted order, equal ones in the order of their strings.

    `strings` has a row of bytes per string, of which the first `size` count. A round holds the transform of all suffixes of
    up to its length: for each suffix in sorted order the symbol before it, its string and its length. The symbols, put in
    order without changing the order of equal ones, give the places of the suffixes that they begin; the empty suffixes stand
    before all.
    """
    m = len(strings)
    most = int(size.max(initial=0))
    # Row j holds the symbol before the last j symbols of each string; 0 stands before a whole string. UTF-8 leaves room for it.
    symbols = np.zeros((most + 1, m), dtype=np.uint8)
    for j in range(most):
        long = np.flatnonzero(size > j)
        symbols[j, long] = strings[long, size[long] - 1 - j] + np.uint8(1)
    symbols = symbols.ravel()
    # A suffix is its length times m, plus its string.
    empty = np.arange(m, dtype=np.int32)
    with tempfile.SpooledTemporaryFile(max_size=SPOOL) as old, tempfile.SpooledTemporaryFile(max_size=SPOOL) as new:
        _write(old, symbols[empty], empty)
        for _ in range(most):
            symbol, suffix = _read(old)
            order = np.argsort(symbol, kind="stable")[np.count_nonzero(symbol == 0) :]
            suffix = np.concatenate([empty, suffix[order] + np.int32(m)])
            _write(new, symbols[suffix], suffix)
            old, new = new, old
        _, suffix = _read(old)
    length, owner = np.divmod(suffix, np.int32(max(m, 1)))
    return owner, size[owner] - length


def _write(file, symbol: np.ndarray, suffix: np.ndarray) -> None:
    file.seek(0)
    file.truncate()
    for part in (np.array([len(symbol)], dtype=np.int64), symbol, suffix):
        file.write(part.data)


def _read(file) -> tuple[np.ndarray, np.ndarray]:
    file.seek(0)
    n = int(np.frombuffer(file.read(8), dtype=np.int64)[0])
    return np.frombuffer(file.read(n), dtype=np.uint8), np.frombuffer(file.read(4 * n), dtype=np.int32)


def first_holders(strings: np.ndarray, size: np.ndarray, docs: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Least document that holds each window of `span` bytes: a row per string, a column per start; NO_ID beyond the end."""
    out = np.full((len(strings), max(1, strings.shape[1] - span + 1)), NO_ID)
    owner, start = suffix_order(strings, size)
    whole = size[owner] - start >= span
    owner, start = owner[whole], start[whole]
    if len(owner) == 0:
        return out
    # Neighbours have a common prefix of a whole window if eight bytes are equal at enough places.
    words = np.lib.stride_tricks.sliding_window_view(strings.ravel(), 8)
    at = owner.astype(np.int64) * strings.shape[1] + start
    equal = np.ones(len(at) - 1, dtype=bool)
    for j in [*range(0, span - 8, 8), span - 8]:
        word = np.ascontiguousarray(words[at + j]).view(np.uint64)[:, 0]
        equal &= word[1:] == word[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~equal]))
    least = np.minimum.reduceat(docs[owner], first)
    out[owner, start] = np.repeat(least, np.diff(np.append(first, len(at))))
    return out


def _row_hashes(strings: np.ndarray, size: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of rows of bytes."""
    found = _mixed(size.astype(np.uint64) + np.uint64(salt << 32))
    words = strings.view(np.uint64)
    for j in range(words.shape[1]):
        found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) + words[:, j])
    return found


def distinct(keys: np.ndarray, strings: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A first row of each distinct (key, string), and the number of its distinct one for each row.

    Rows are told apart by a hash that is checked on the bytes; if two met in it, another hash is taken.
    """
    salt = 0
    while True:
        marks = _mixed(_row_hashes(strings, size, salt) ^ (keys * np.uint64(0x94D049BB133111EB)))
        _, first, back = np.unique(marks, return_index=True, return_inverse=True)
        if all((strings[i : i + 65536] == strings[first[back[i : i + 65536]]]).all() for i in range(0, len(back), 65536)) and (
            (keys == keys[first[back]]) & (size == size[first[back]])
        ).all():
            return first, back
        salt += 1


class Part:
    """The documents of a part, one after another, with their anchors; the same rows give the same numbers whenever it is built."""

    def __init__(self, docs: pa.Table, buckets: int):
        unpack = zstandard.ZstdDecompressor().decompress
        columns = [docs[c].to_pylist() for c in ("place", "text", "doc_id", "rest")]
        self.rows = sorted(zip(columns[0], map(unpack, columns[1]), *columns[2:]), key=lambda r: r[:2])
        self.buckets = np.uint64(buckets)
        self.ends = np.cumsum([len(r[1]) for r in self.rows])
        self.begins = self.ends - [len(r[1]) for r in self.rows]
        self.data = np.frombuffer(b"".join([r[1] for r in self.rows]) + bytes(WIDTH), dtype=np.uint8)
        found = [anchors(self.data[a:b]) for a, b in zip(self.begins.tolist(), self.ends.tolist())]
        self.row = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
        self.at = np.concatenate([at for at, _ in found]) + self.begins[self.row]
        hashes = [h for _, h in found]
        self.hashes = np.concatenate(hashes)
        # A document counts once for an anchor; rows of one id stand together and are one document.
        keys: list[np.ndarray] = []
        for i, own in enumerate(hashes):
            own = np.unique(self._keys(own))
            again = i > 0 and self.rows[i - 1][0] == self.rows[i][0]
            keys.append(np.unique(np.concatenate([keys.pop(), own])) if again else own)
        self.keys, self.count = np.unique(np.concatenate(keys), return_counts=True)

    def _keys(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket and 32 more bits of an anchor's hash, enough to filter by: two anchors that share them are only sent needlessly."""
        return (hashes % self.buckets) << np.uint64(32) | (hashes >> np.uint64(20)) & np.uint64((1 << 32) - 1)

    def sent(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, 32-bit keys in order, packed, documents per key up to 255) for each bucket."""
        for bucket, a, b in _runs(self.keys >> np.uint64(32)):
            yield bucket, _packed_keys(self.keys[a:b]), np.minimum(self.count[a:b], 255).astype(np.uint8).tobytes()

    def entries(self, shared: dict[int, bytes]) -> None:
        """Strings around the anchors that `shared` marks, distinct ones once, each with its least document in this part.

        A mark is 1 for an anchor in several documents and 2 for one in very many. Around these every window is a string of
        its own, with its own key, so the windows at the edges of a common passage spread over the buckets. `low`, `windows`
        and `number` say of each use of a string where it stands, how many windows it has and which string it is.
        """
        marks = np.zeros(len(self.keys), dtype=np.uint8)
        for bucket, a, b in _runs(self.keys >> np.uint64(32)):
            if bucket in shared:
                marks[a:b] = np.frombuffer(shared[bucket], dtype=np.uint8)
        found = marks[np.searchsorted(self.keys, self._keys(self.hashes))] if len(self.keys) else marks
        low = np.maximum(self.begins[self.row], self.at + ANCHOR - SPAN)
        high = np.minimum(self.ends[self.row], self.at + SPAN)
        one, many = np.flatnonzero(found == 1), np.flatnonzero(found == 2)
        count = (high - low - SPAN + 1)[many]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.low = np.concatenate([low[one], np.repeat(low[many], count) + step])
        size = np.concatenate([(high - low)[one], np.full(len(step), SPAN)])
        self.windows = size - SPAN + 1
        self.place = np.array([r[0] for r in self.rows], dtype=np.int64)[np.concatenate([self.row[one], np.repeat(self.row[many], count)])]
        strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.data, WIDTH)[self.low])
        strings[np.arange(WIDTH) >= size[:, None]] = 0
        keys = np.concatenate([self.hashes[one], _row_hashes(strings[len(one) :], size[len(one) :], 1)])
        first, self.number = distinct(keys, strings, size)
        self.least = np.full(len(first), NO_ID)
        np.minimum.at(self.least, self.number, self.place)
        self.entry_keys, self.strings, self.size = keys[first], strings[first], size[first]

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, numbers of its strings)."""
        bucket = self.entry_keys % self.buckets
        order = np.argsort(bucket, kind="stable")
        for name, a, b in _runs(bucket[order]):
            yield name, order[a:b]

    def packed(self, numbers: np.ndarray) -> bytes:
        """Least document, 32 bits of the key, size and bytes of strings, compressed."""
        keys = (self.entry_keys[numbers] >> np.uint64(20)).astype(np.uint32)
        parts = np.array([len(numbers)]), self.least[numbers], keys, self.size[numbers].astype(np.uint8), self.strings[numbers]
        return zstandard.ZstdCompressor(3).compress(b"".join([p.tobytes() for p in parts]))

    def gone(self, masks: np.ndarray) -> np.ndarray:
        """Which bytes of the part a window covers that an earlier document holds, from the mask of each string."""
        mask = np.where(self.least[self.number] < self.place, np.uint64(0xFFFFFFFFFFFFFFFF), masks[self.number])
        starts = np.zeros(len(self.data) + SPAN, dtype=np.int8)
        for j in range(int(self.windows.max(initial=0))):
            here = (mask >> np.uint64(j) & np.uint64(1)).astype(bool) & (self.windows > j)
            starts[self.low[here] + j] = 1
        starts[SPAN:] -= starts[:-SPAN].copy()
        return np.cumsum(starts, dtype=np.int32)[: len(self.data)] > 0


def _packed_keys(keys: np.ndarray) -> bytes:
    """The low 32 bits of keys in order: the steps between them by bytes of one weight, of which the high ones are mostly alike."""
    low = keys.astype(np.uint32)
    steps = np.diff(low, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(3).compress(steps.T.tobytes())


def _unpacked_keys(data: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view(np.uint32)[:, 0], dtype=np.uint64)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, first, after last) of the runs of equal values."""
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1 if len(values) else np.empty(0, dtype=np.int64)
    bounds = [0, *edges.tolist(), len(values)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield int(values[a]), a, b


#: Documents from which an anchor counts as very common.
COMMON = 2_000
#: Strings that are put in order together; anchors with more are put in order alone.
TOGETHER = 20_000

NOTE = "bucket int, part int, kind int, data binary, more binary"


def _notes(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return table_of(schema, dict(zip(schema.names, zip(*rows)))) if rows else schema.empty_table()


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _shared_marks(table: pa.Table) -> list[tuple]:
    """For each part of a bucket the marks of its anchors, in its order: 0 in one document, 1 in several, 2 in very many."""
    parts = table["part"].to_pylist()
    keys = []
    for data in table["data"].to_pylist():
        keys.append(_unpacked_keys(data))
    counts = np.concatenate([np.frombuffer(m, dtype=np.uint8) for m in table["more"].to_pylist()]).astype(np.int64)
    _, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, weights=counts)[back]
    marks = ((total >= 2).astype(np.uint8) + (total >= COMMON)).astype(np.uint8)
    ends = np.cumsum([len(k) for k in keys])
    return [(b, p, 0, m.tobytes(), None) for b, p, m in zip(table["bucket"].to_pylist(), parts, np.split(marks, ends[:-1]))]


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    least, keys, size, strings = np.split(raw[8:], np.cumsum([8 * n, 4 * n, n]))
    return keys.view(np.uint32).astype(np.uint64), least.view(np.int64), size.astype(np.int64), strings.reshape(n, WIDTH)


def _covered(table: pa.Table) -> list[tuple]:
    """For each part of a bucket a mask per string: the windows that a document before the string's least one holds."""
    sent = [_unpacked(d) for d in table["data"].to_pylist()]
    keys, least, size, strings = (np.concatenate(x) for x in zip(*sent))
    first, number = distinct(keys, strings, size)
    holder = np.full(len(first), NO_ID)
    np.minimum.at(holder, number, least)
    # An anchor with one string has the same document for all its windows; only others need an order.
    masks = np.where(holder[number] < least, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    order = np.argsort(keys[first], kind="stable")
    bits = np.uint64(1) << np.arange(WIDTH - SPAN + 1, dtype=np.uint64)
    place = np.full(len(first), -1)
    batch: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        if batch:
            own = np.concatenate(batch)
            found = first_holders(strings[first[own]], size[first[own]], holder[own])
            place[own] = np.arange(len(own))
            uses = np.flatnonzero(place[number] >= 0)
            masks[uses] = ((found[place[number[uses]]] < least[uses, None]) * bits[: found.shape[1]]).sum(axis=1, dtype=np.uint64)
            place[own] = -1
            batch.clear()

    for _, a, b in _runs(keys[first][order]):
        if b - a > 1:
            if held + b - a > TOGETHER:
                flush()
                held = 0
            batch.append(order[a:b])
            held += b - a
    flush()
    ends = np.cumsum([len(x[0]) for x in sent])
    return [(b, p, 1, m.tobytes(), None) for b, p, m in zip(table["bucket"].to_pylist(), table["part"].to_pylist(), np.split(masks, ends[:-1]))]


def _by_bucket(notes: DataFrame, work) -> DataFrame:
    """Bring the notes of a bucket together, one bucket to a partition, and apply `work` to them."""
    spark = notes.sparkSession
    arrow = arrow_schema(spark, NOTE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _whole(batches)
        if table is not None:
            for bucket in sorted(set(table["bucket"].to_pylist())):
                yield from _notes(work(table.filter(pc.equal(table["bucket"], bucket))), arrow).to_batches()
        del table
        give_back()

    return notes.repartitionById(partitions(spark), F.col("bucket")).mapInArrow(run, NOTE)


def _in_parts(docs: DataFrame, n: int) -> DataFrame:
    """(part, place, doc_id, rest, text): texts as compressed bytes, written once by part; later steps meet them without a shuffle."""
    spark = docs.sparkSession
    schema = "part int, place long, doc_id long, rest string, text binary"
    arrow = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            packed = pa.array([pack(t.encode("utf-8", "surrogatepass")) for t in batch["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["part"], batch["place"], batch["doc_id"], batch["rest"], packed], schema=arrow)

    part = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(n)).cast("int")
    rows = docs.select(part.alias("part"), F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), "doc_id", "rest", "text").mapInArrow(run, schema)
    # A checkpoint keeps how its rows are partitioned only for a plan that is not adaptive.
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut_lineage(rows.repartition(n, "part"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


RESULT = "doc_id long, rest string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def remove_repeats(docs: DataFrame, keep_text: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (null unless `keep_text`) and rest of every row.

    `rest` holds the columns named in `carry` as JSON, which spares the result a join.

    Each byte goes that a string of 50 bytes covers which also starts in a document with a smaller doc_id. A null or empty
    text has no bytes. Rows without an id come after all others and are no source for each other; rows of one id are one
    document. An empty table gives no rows.

    Texts are shuffled once, compressed, and written by part to the shared checkpoint folder. What moves after that: two to
    four bytes per anchor and part and a byte of marks back, then the distinct strings around shared anchors and a mask back.
    There are as many parts and buckets as shuffle partitions. The digest is that of the bytes left; in `kept` a letter of which
    bytes went goes whole.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    small_batches(spark)
    rest = F.to_json(F.struct(*carry)) if carry else F.lit(None).cast("string")
    docs = _in_parts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), rest.alias("rest")), n)
    notes, result = arrow_schema(spark, NOTE), arrow_schema(spark, RESULT)

    def first(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        out = _notes([(bucket, part, 0, keys, counts) for bucket, keys, counts in Part(table, n).sent()], notes)
        give_back()
        return out

    def second(table: pa.Table, marks: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return notes.empty_table()
        part, number = Part(table, n), table["part"][0].as_py()
        part.entries(dict(zip(marks["bucket"].to_pylist(), marks["data"].to_pylist())))
        out = _notes([(b, number, 1, part.packed(own), None) for b, own in part.by_bucket()], notes)
        del part
        give_back()
        return out

    def third(table: pa.Table, found: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return result.empty_table()
        part = Part(table, n)
        rows = list(zip(found["kind"].to_pylist(), found["bucket"].to_pylist(), found["data"].to_pylist()))
        part.entries({b: d for kind, b, d in rows if kind == 0})
        masks = np.zeros(len(part.least), dtype=np.uint64)
        answers = {b: d for kind, b, d in rows if kind == 1}
        for bucket, own in part.by_bucket():
            masks[own] = np.frombuffer(answers[bucket], dtype=np.uint64)
        gone = part.gone(masks)
        out = [_kept(row, gone[a:b], keep_text) for row, a, b in zip(part.rows, part.begins.tolist(), part.ends.tolist())]
        del part, gone, masks, answers
        found = table_of(result, dict(zip(result.names, zip(*out))))
        del out
        give_back()
        return found

    grouped = docs.groupBy("part")
    marks = cut_lineage(_by_bucket(grouped.applyInArrow(first, NOTE), _shared_marks))
    masks = _by_bucket(grouped.cogroup(marks.groupBy("part")).applyInArrow(second, NOTE), _covered)
    return grouped.cogroup(marks.unionByName(masks).groupBy("part")).applyInArrow(third, RESULT)


def _kept(row: tuple, gone: np.ndarray, keep_text: bool) -> tuple:
    """Result row of a document from which the bytes marked as gone go."""
    _, text, doc_id, rest = row
    removed = int(gone.sum())
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if removed else 0
    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if removed else text
    return doc_id, rest, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if keep_text else None
