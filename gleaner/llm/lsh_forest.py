"""Near duplicates by an LSH forest over MinHash signatures, with exact confirmation.

Every document has a set of word shingles and a MinHash signature of several trees of `DEPTH` levels. Each tree is a sorted
order of the documents by their levels in that tree. Documents with long common prefixes stand side by side, so the `REACH`
rows before a row are its candidates as far as they share at least `LEAST` levels: where the order is thin this takes short
prefixes. Candidates whose sizes or signatures rule out the similarity leave; the rest are confirmed on the full sets. Documents
with equal sets are one node from the start.

Where more than `REACH` rows share `RUN` levels, the rows that the order leaves uncompared are compared after the links of the
others are known. A run of up to `BLOCKS` blocks of `BLOCK` nodes is compared whole: all pairs that still lie in different
components, block by block, by their sizes and by a lower bound of the difference of their sets, which loses no link. In a longer
run, as of documents that share a passage, the levels say little, so its nodes descend to their shingles: in a fixed order, rarest
first, two sets as similar as asked share one of their first shingles, and only such pairs are compared. That loses no link either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, components, few_tasks, give_back, map_batches, partitions, texts
from gleaner.llm.order_minhash import _mixed
from gleaner.session import cut_lineage

TREES = 20
DEPTH = 8
LEAST = 2
REACH = 6
#: Levels that the rows of a run share; a pair of similarity 0.8 shares them in one of the trees with a chance of 0.99997.
RUN = 4
#: Nodes of a run that are compared with as many others at a time, and the most bits of a set's parity map.
BLOCK, BLOCKS = 512, 8
#: Nodes whose shingles are counted, one of so many; least count of a frequent one; places of the table of frequent ones. They
#: only decide how early a shingle stands in the order, and change no result.
COUNTED, FREQUENT, PLACED = 8, 4, 1 << 18
MOST_BITS = 1 << 14
#: Signature places compared by four bits each before sets are fetched, and how far an estimate may fall below the threshold.
PLACES = 80
SLACK = 0.2
_BLOCK = 1024
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = _mixed(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * _FACTOR)
_ODD = _mixed(_SEEDS) | np.uint64(1)


class Shingles:
    """Sets of hashed word shingles; word hashes are kept for the next text."""

    def __init__(self, words: int, remembered: int = 150_000):
        self.words, self.remembered = words, remembered
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Sorted 64-bit hashes of the distinct shingles of a whole text."""
        # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
        tokens = text.encode("utf-8", "surrogatepass").lower().split()
        if not tokens:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        hashes = list(map(known.get, tokens))
        if None in hashes:
            if len(known) > self.remembered:
                known.clear()
            for i, h in enumerate(hashes):
                if h is None:
                    hashes[i] = known[tokens[i]] = xxhash.xxh3_64_intdigest(tokens[i])
        word = np.array(hashes, dtype=np.uint64)
        n = min(self.words, len(word))
        found = np.full(len(word) - n + 1, np.uint64(n))
        for j in range(n):
            found = _mixed(found * _FACTOR + word[j : j + len(found)])
        return np.unique(found)


def signature(shingles: np.ndarray) -> np.ndarray:
    """A 32-bit MinHash value for each level of each tree."""
    least = np.full(len(_SEEDS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for start in range(0, len(shingles), _BLOCK):
        part = (shingles[start : start + _BLOCK, None] ^ _SEEDS[None, :]) * _ODD[None, :]
        least = np.minimum(least, part.min(axis=0))
    return (_mixed(least) >> np.uint64(32)).astype(np.uint32)


SIGNED = "doc_id long, n_shingles long, digest binary, levels binary, places binary"


def signed(docs: DataFrame, words: int) -> DataFrame:
    """Set size, digest of the set, levels of the trees and short places of every row; null digest where the set is empty."""
    shingles = Shingles(words)

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"n_shingles": [], "digest": [], "levels": [], "places": []}
        for text in batch["text"].to_pylist():
            found = shingles(text)
            out["n_shingles"].append(len(found))
            if len(found) == 0:
                for name in ("digest", "levels", "places"):
                    out[name].append(None)
                continue
            marks = signature(found)
            short = (marks[:PLACES] & np.uint32(15)).astype(np.uint8)
            out["digest"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            out["levels"].append((marks >> np.uint32(16)).astype(">u2").tobytes())
            out["places"].append((short[::2] << 4 | short[1::2]).tobytes())
        return out | {"doc_id": batch["doc_id"]}

    return map_batches(docs, rows, SIGNED)


def forest_pairs(nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b, alike): candidate pairs of node ids, a < b, with their estimated similarity, and (a, a, null) for a node of a long run.

    Nodes are ordered by (tree, levels, id) over range partitions, so a dense region is split like any other; a pair that a
    partition bound separates in one tree meets in the others.
    """
    width = 2 * DEPTH
    tree = F.struct(F.col("tree"), F.substring("levels", F.col("tree") * width + 1, F.lit(width)).alias("key"))
    rows = nodes.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "levels", "node", "n_shingles", "places")
    rows = rows.select(tree.alias("t"), "node", "n_shingles", "places").select("t.tree", "t.key", "node", "n_shingles", "places")
    rows = rows.repartitionByRange(partitions(nodes.sparkSession), "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    schema = "a long, b long, alike double"
    arrow = arrow_schema(nodes.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [
                batch["tree"].to_numpy().astype(np.int32),
                np.frombuffer(b"".join(batch["key"].to_pylist()), dtype=">u2").reshape(-1, DEPTH),
                batch["node"].to_numpy(),
                batch["n_shingles"].to_numpy(),
                np.frombuffer(b"".join(batch["places"].to_pylist()), dtype=np.uint8).reshape(-1, PLACES // 2),
            ]
            old = 0 if held is None else len(held[0])
            if old:
                now = [np.concatenate([h, x]) for h, x in zip(held, now)]
            trees, keys, node, size, places = now
            found = []
            for back in range(1, REACH + 1):
                i = np.arange(max(old, back), len(trees))
                j = i - back
                keep = trees[i] == trees[j]
                keep &= (keys[i, :LEAST] == keys[j, :LEAST]).all(axis=1)
                keep &= np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j])
                i, j = i[keep], j[keep]
                differ = places[i] ^ places[j]
                same = ((differ & 15) == 0).sum(axis=1) + (differ < 16).sum(axis=1)
                alike = (same / PLACES - 1 / 16) * 16 / 15
                keep = alike >= similarity - SLACK
                a, b = node[i[keep]], node[j[keep]]
                found.append((np.minimum(a, b), np.maximum(a, b), alike[keep]))
            i = np.arange(max(old, REACH + 1), len(trees))
            j = i - REACH - 1
            long = (trees[i] == trees[j]) & (keys[i, :RUN] == keys[j, :RUN]).all(axis=1)
            dense = np.unique(node[np.concatenate([i[long], j[long]])])
            found.append((dense, dense, np.full(len(dense), np.nan)))
            held = [x[-REACH - 1 :].copy() for x in now]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=arrow)
        give_back()

    return rows.mapInArrow(run, schema).groupBy("a", "b").agg(F.max("alike").alias("alike"))


def parity(shingles: np.ndarray) -> np.ndarray:
    """Bytes of a map with a bit for each residue of a shingle: whether it is that of an odd number of shingles.

    A map differs from another in at most as many bits as the sets differ in shingles. Its halves combine to the shorter map.
    """
    bits = min(MOST_BITS, max(64, 1 << (2 * len(shingles) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def close(sizes: np.ndarray, maps: list[bytes], groups: np.ndarray, one: np.ndarray, two: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (of `one`, of `two`) in different groups whose sizes and maps allow the similarity."""
    width = np.array([len(m) for m in maps])
    for w in np.unique(width[one]):
        a = one[width[one] == w]
        for v in np.unique(width[two]):
            b = two[width[two] == v]
            n = min(w, v)
            # Sets a size class apart or more are tried too: the sizes decide.
            x, y = (np.frombuffer(b"".join([maps[k] for k in c]), dtype=np.uint8).reshape(len(c), -1, n) for c in (a, b))
            x, y = (np.ascontiguousarray(np.bitwise_xor.reduce(m, axis=1)).view(np.uint64) for m in (x, y))
            for k, row in enumerate(x):
                total = sizes[a[k]] + sizes[b]
                may = (groups[b] != groups[a[k]]) & (100 * np.minimum(sizes[b], sizes[a[k]]) >= percent * np.maximum(sizes[b], sizes[a[k]]))
                at = np.flatnonzero(may)
                if not len(at):
                    continue
                apart = np.bitwise_count(y[at] ^ row).sum(axis=1, dtype=np.int64)
                # 100 * both >= percent * (total - both), where twice `both` is at most total - apart.
                at = at[(100 + percent) * (total[at] - apart) >= 2 * percent * total[at]]
                if len(at):
                    yield np.full(len(at), a[k]), b[at]


def run_pairs(dense: DataFrame, levels: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of the `dense` nodes that share a run, lie in different components and may be as similar as asked.

    A run whose nodes are all of one component leaves. The others are cut into blocks by the hash of the node, and each pair of
    blocks is a group of its own, so a hot run is spread over tasks.
    """
    spark = dense.sparkSession
    wide = 2 * RUN
    key = F.concat(F.col("tree").cast("string"), F.lit(":"), F.hex(F.substring("levels", F.col("tree") * 2 * DEPTH + 1, F.lit(wide))))
    rows = dense.join(levels, "node").join(groups, "node", "left").select("node", "levels", F.coalesce("component", "node").alias("component"))
    rows = rows.select("node", "component", "levels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = cut_lineage(rows.select("node", "component", F.xxhash64(key).alias("run")))
    runs = rows.groupBy("run").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    runs = cut_lineage(runs.select("run", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    long = rows.join(runs.filter(F.col("blocks") > BLOCKS), "run").select("node", "component").distinct()
    found = rare_pairs(cut_lineage(long), sets, percent)
    runs = runs.filter(F.col("blocks") <= BLOCKS)
    maps = _maps(sets.join(dense, "node"))
    rows = rows.join(runs, "run").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.select("run", "node", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.join(maps, "node").select("run", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"), "own", "node", "component", "size", "map")
    rows = rows.repartition(partitions(spark), "run", "s", "t").sortWithinPartitions("run", "s", "t")
    schema = "a long, b long"
    arrow = arrow_schema(spark, schema)

    def compared(block: list[tuple]) -> pa.RecordBatch:
        own, node, group, size, maps = zip(*block)
        own, node, group, size = np.array(own), np.array(node), np.array(group), np.array(size)
        one, two = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
        found = list(close(size, maps, group, one, two, percent))
        a, b = (node[np.concatenate(c)] for c in zip(*found)) if found else (np.empty(0, dtype=np.int64),) * 2
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, []
        for batch in batches:
            for r, s, t, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                # Within the pair (s, t) of different blocks, one of them may be empty.
                if (r, s, t) != last:
                    if len(block) > 1 and (last[1] == last[2] or len({x[0] for x in block}) == 2):
                        yield compared(block)
                    last, block = (r, s, t), []
                block.append(rest)
        if len(block) > 1 and (last[1] == last[2] or len({x[0] for x in block}) == 2):
            yield compared(block)
        block.clear()
        give_back()

    return rows.mapInArrow(run, schema).unionByName(found).distinct()


def _maps(sets: DataFrame) -> DataFrame:
    """(node, size, map) of sets (node, shingles)."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        found = [np.frombuffer(x, dtype=np.uint64) for x in batch["shingles"].to_pylist()]
        return {"node": batch["node"], "size": [len(x) for x in found], "map": [parity(x).tobytes() for x in found]}

    return map_batches(sets.select("node", "shingles"), rows, "node long, size long, map binary")


def frequent_places(sets: DataFrame) -> np.ndarray:
    """For each place, a shingle's last bits, the binary logarithm of how often a frequent shingle there was counted.

    Every `COUNTED`-th node is counted; the table has `PLACED` entries however many shingles there are.
    """
    some = sets.filter(F.pmod(F.xxhash64("node"), F.lit(COUNTED)) == 0).select("shingles")
    arrow = arrow_schema(sets.sparkSession, "shingle long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch["shingles"].to_pylist()), dtype=np.int64))], schema=arrow)

    counts = some.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT)
    place = F.col("shingle").bitwiseAND(PLACED - 1).cast("int")
    table = counts.groupBy(place.alias("place")).agg(F.max("n").alias("n")).toArrow()
    out = np.zeros(PLACED, dtype=np.uint8)
    out[table["place"].to_numpy()] = np.log2(table["n"].to_numpy()).astype(np.uint8)
    return out


def rare_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of `nodes` (node, component) of different components whose sets may be as similar as asked.

    The shorter set of a pair has a common shingle among its first n - 2t/(1+t) n + 1, the longer one among its first
    n - tn + 1, for a similarity of t; where these stand leaves room for enough common ones behind. Shingles of one component
    alone leave, and the component that most holders of a shingle belong to meets the others alone, not itself.
    """
    kept = sets.join(nodes.select("node"), "node", "left_semi")
    place = frequent_places(kept)
    schema = "shingle long, node long, size int, at int, short boolean"
    arrow = arrow_schema(sets.sparkSession, schema)

    def first(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(5)]
        for node, data in zip(batch["node"].to_pylist(), batch["shingles"].to_pylist()):
            x = np.frombuffer(data, dtype=np.uint64)
            x = x[np.lexsort((x, place[(x & np.uint64(PLACED - 1)).astype(np.int64)]))]
            n = len(x)
            # -(-a // b) rounds up; both shares are whole numbers of hundredths.
            probe, index = n + (-percent * n) // 100 + 1, n + (-2 * percent * n) // (100 + percent) + 1
            at = np.arange(probe, dtype=np.int32)
            for column, values in zip(out, (x[:probe].view(np.int64), np.full(probe, node), np.full(probe, n, np.int32), at, at < index)):
                column.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(out, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield first(batch)
        give_back()

    rows = cut_lineage(kept.mapInArrow(run, schema).join(nodes, "node"))
    held = rows.groupBy("shingle", "component").agg(F.count("*").alias("n")).groupBy("shingle")
    held = held.agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.count("*").alias("components")).filter("components > 1")
    rows = rows.join(held.select("shingle", "most"), "shingle").withColumn("big", F.col("component") == F.col("most"))
    side = lambda name: [F.col(c).alias(f"{c}_{name}") for c in ("node", "component", "size", "at")]
    ways = lambda big, small: F.explode(F.when(F.col("big"), F.array(F.lit(big))).otherwise(F.array(F.lit(small), F.lit(2)))).alias("way")
    one = rows.filter("short").select("shingle", ways(0, 1), *side("a"))
    two = rows.select("shingle", ways(1, 0), *side("b"))
    sizes = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("node_a") < F.col("node_b")))
    sizes &= 100 * F.col("size_a") >= percent * F.col("size_b")
    room = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    enough = (100 + percent) * room >= percent * (F.col("size_a") + F.col("size_b"))
    pairs = one.join(two, ["shingle", "way"]).filter(sizes & enough & (F.col("component_a") != F.col("component_b")))
    pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    maps = cut_lineage(_maps(kept))
    for name in ("a", "b"):
        pairs = pairs.join(maps.select(*[F.col(c).alias(c if c == name else f"{c}_{name}") for c in ("size", "map")], F.col("node").alias(name)), name)

    def test(batch: pa.RecordBatch) -> dict[str, list]:
        keep = []
        for m, n, x, y in zip(*[batch[c].to_pylist() for c in ("size_a", "size_b", "map_a", "map_b")]):
            x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
            w = min(len(x), len(y))
            x, y = (np.bitwise_xor.reduce(v.reshape(-1, w), axis=0) for v in (x, y))
            keep.append((100 + percent) * (m + n - int(np.bitwise_count(x ^ y).sum())) >= 2 * percent * (m + n))
        return {"a": batch["a"], "b": batch["b"], "keep": keep}

    return map_batches(pairs, test, "a long, b long, keep boolean").filter("keep").select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their full sets (node, shingles)."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.select("a", "b").join(one, "a").join(two, "b")

    def test(batch: pa.RecordBatch) -> dict[str, list]:
        keep = []
        for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist()):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        return {"a": batch["a"], "b": batch["b"], "keep": keep}

    return map_batches(rows, test, "a long, b long, keep boolean").filter("keep").select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Texts are read twice: for signatures, and, shuffled by id, for the sets of documents in candidate pairs. Each document is
    first confirmed against its likeliest partner; the other pairs are confirmed where they would still join two components,
    so copies in a large group cost no more than their number. Last come the pairs within long runs of the orders that still
    lie in different components. Signatures, sets and links are written to the shared
    checkpoint folder. A null, empty or blank text has no shingle and is linked with nothing; a row without an id is kept by
    itself, with no component; rows with the same id are one document; an empty table gives no rows.
    """
    docs = texts(docs)
    marks = cut_lineage(signed(docs, words))
    known = marks.filter("digest is not null and doc_id is not null")
    nodes = cut_lineage(
        known.groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("levels").alias("levels"), F.first("places").alias("places")
        )
    )
    # Links are two numbers a row: written by few tasks, as many small files and tasks take more memory than the links.
    few = few_tasks(nodes.sparkSession, nodes.count())
    found = cut_lineage(forest_pairs(nodes, percent / 100))
    pairs, dense = found.filter("a < b"), found.filter("a = b").select(F.col("a").alias("node"))
    needed = found.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "digest"), "node")
    sets = cut_lineage(_sets(docs, needed, words))
    first = pairs.groupBy("b").agg(F.max_by("a", F.struct("alike", -F.col("a"))).alias("a")).select("a", "b")
    links = cut_lineage(confirmed(first, sets, percent).repartition(few))
    groups = cut_lineage(components(links).coalesce(few))
    side = lambda name: groups.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    open_pairs = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(
        F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    )
    late = cut_lineage(confirmed(open_pairs, sets, percent).repartition(few))
    if late.limit(1).count():
        links = links.unionByName(late)
        groups = cut_lineage(components(links).coalesce(few))
    apart = run_pairs(dense, nodes.select("node", "levels"), sets, groups, percent)
    rest = cut_lineage(confirmed(apart, sets, percent).repartition(few))
    groups = components(links.unionByName(rest)) if rest.limit(1).count() else groups
    member = nodes.select("digest", "node").join(groups, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    found = marks.select("doc_id", "n_shingles", "digest").join(member, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _sets(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the full set of each needed document, as sorted 64-bit numbers."""
    shingles = Shingles(words)

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        found = [shingles(t).tobytes() for t in batch["text"].to_pylist()]
        right = [hashlib.blake2b(f, digest_size=16).digest() == d for f, d in zip(found, batch["digest"].to_pylist())]
        return {"node": batch["node"], "shingles": found, "right": right}

    read = docs.join(needed, docs["doc_id"] == needed["node"]).select("node", "digest", "text")
    # Rows of one id with another set are not the node.
    return map_batches(read, rows, "node long, shingles binary, right boolean").filter("right").dropDuplicates(["node"]).select("node", "shingles")
