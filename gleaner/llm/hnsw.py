"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard.

Vectors that may be compared share a label and a length. Each such group is cut into shards by hash, and each shard gets a graph of
layers: every layer links a vector to near vectors that are not already nearer to another link, and a higher layer holds a
random fraction of the one below. Every shard is queried by the vectors of every shard of its group, whole batches of queries
walking the graph together. The beam is widened until an audit of some queries against brute force finds the wanted share of
links; a beam that would be as wide as the shard gives way to brute force. Cosines are verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, components, map_batches, small_batches
from gleaner.operators.joins import lookup_join
from gleaner.session import cut_lineage

SHARD = 2048
LINKS = 12
BUILD_BEAM = 48
FIRST_BEAM = 32
AUDITED = 64
RECALL = 0.99
QUERIES = 256
MARGIN = 1e-4


class Graph:
    """Layers of links over unit vectors; node 0 is the entry. `layers[l]` has a row of links per node, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]):
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> Graph:
        """Insert nodes in batches that double, those of the highest level first; the vectors are reordered for it by the caller."""
        n = len(vectors)
        levels = node_levels(n, seed)
        graph = cls(vectors, [np.full((int((levels >= l).sum()), 2 * LINKS if l == 0 else LINKS), -1, dtype=np.int32) for l in range(int(levels[0]) + 1 if n else 0)])
        done = 0
        while done < n:
            batch = np.arange(done, min(n, max(done * 2, done + 16), done + QUERIES))
            entry = np.zeros((len(batch), 1), dtype=np.int32)
            for l in range(len(graph.layers) - 1, -1, -1):
                here = batch[batch < len(graph.layers[l])]
                if done:
                    beam, _ = graph.walk(vectors[batch], entry, l, BUILD_BEAM if len(here) else 4, done)
                    entry = beam[:, :4]
                if len(here):
                    # Nodes of a batch see each other by brute force.
                    own = np.where(np.arange(len(batch))[: len(here)][:, None] != here[None, :] - done, here[None, :], -1)
                    found = np.concatenate([beam[: len(here)], own], axis=1) if done else own
                    graph._link(l, here, found.astype(np.int32))
            done = int(batch[-1]) + 1
        return graph

    def _link(self, layer: int, nodes: np.ndarray, found: np.ndarray) -> None:
        links = self.layers[layer]
        reverse: dict[int, list[int]] = {}
        for node, row in zip(nodes.tolist(), found):
            chosen = self._chosen(node, row[(row >= 0) & (row < len(links))], LINKS)
            links[node, : len(chosen)] = chosen
            for other in chosen.tolist():
                reverse.setdefault(other, []).append(node)
        for node, more in reverse.items():
            old = links[node][links[node] >= 0]
            new = np.unique(np.concatenate([old, np.array(more, dtype=np.int32)]))
            if len(new) > links.shape[1]:
                new = self._chosen(node, new, links.shape[1])
            links[node] = -1
            links[node, : len(new)] = new

    def _chosen(self, node: int, near: np.ndarray, most: int) -> np.ndarray:
        """At most `most` of `near`, nearest first, without those nearer to a chosen one; the rest fill up what is left."""
        near = near[near != node]
        if len(near) == 0:
            return near
        alike = self.vectors[near] @ self.vectors[node]
        order = np.argsort(-alike, kind="stable")[: 4 * most]
        near, alike = near[order], alike[order]
        among = self.vectors[near] @ self.vectors[near].T
        kept: list[int] = []
        for i in range(len(near)):
            if not kept or among[i, kept].max() < alike[i]:
                kept.append(i)
                if len(kept) == most:
                    break
        if len(kept) < most:
            kept += [i for i in range(len(near)) if i not in set(kept)][: most - len(kept)]
        return near[kept]

    def walk(self, queries: np.ndarray, entry: np.ndarray, layer: int, beam: int, limit: int, least: float | None = None):
        """Beams of near nodes, nearest first, of a batch of queries in a layer; with `least` also all (query, node) seen at or above it."""
        links, vectors = self.layers[layer], self.vectors
        q = len(queries)
        rows = np.arange(q)
        seen = np.zeros((q, limit + 1), dtype=bool)
        ids = np.full((q, beam), -1, dtype=np.int32)
        alike = np.full((q, beam), -2.0, dtype=np.float32)
        open_ = np.zeros((q, beam), dtype=bool)
        found: list[np.ndarray] = []

        def take(which: np.ndarray, new: np.ndarray) -> None:
            new = np.where(new < limit, new, -1)
            new = np.where((new >= 0) & ~seen[which[:, None], new], new, -1)
            # A node that stands twice in a row counts once.
            order = np.sort(new, axis=1)
            order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
            new = order
            seen[which[:, None], new] = True
            seen[:, limit] = False
            score = np.einsum("qmd,qd->qm", vectors[new], queries[which]).astype(np.float32)
            score[new < 0] = -2.0
            if least is not None:
                a, b = np.nonzero(score >= least)
                found.append(np.stack([which[a], new[a, b]]))
            every = np.concatenate([alike[which], score], axis=1)
            best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            alike[which] = np.take_along_axis(every, best, axis=1)
            ids[which] = np.take_along_axis(np.concatenate([ids[which], new], axis=1), best, axis=1)
            fresh = np.concatenate([open_[which], new >= 0], axis=1)
            open_[which] = np.take_along_axis(fresh, best, axis=1)

        take(rows, entry)
        active = rows
        while len(active):
            first = open_[active].argmax(axis=1)
            live = open_[active, first]
            active, first = active[live], first[live]
            if not len(active):
                break
            nodes = ids[active, first]
            open_[active, first] = False
            new = np.where((nodes < len(links))[:, None], links[np.minimum(nodes, len(links) - 1)], -1)
            take(active, new)
        return ids, (np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.int64))

    def near(self, queries: np.ndarray, least: float, beam: int) -> np.ndarray:
        """(query, node) pairs found at or above `least`."""
        n = len(self.vectors)
        if beam >= n:
            return np.stack(np.nonzero(queries @ self.vectors.T >= least))
        out = []
        for start in range(0, len(queries), QUERIES):
            part = queries[start : start + QUERIES]
            entry = np.zeros((len(part), 1), dtype=np.int32)
            for l in range(len(self.layers) - 1, 0, -1):
                ids, _ = self.walk(part, entry, l, 4, len(self.layers[l]))
                entry = ids
            _, found = self.walk(part, entry, 0, beam, n, least)
            out.append(found + np.array([[start], [0]]))
        return np.concatenate(out, axis=1) if out else np.empty((2, 0), dtype=np.int64)

    def audited_beam(self, queries: np.ndarray, least: float) -> int:
        """The first beam, from `FIRST_BEAM` in doublings, that finds `RECALL` of the links of audited queries."""
        audited = queries[:: max(1, len(queries) // AUDITED)]
        truth = int((audited @ self.vectors.T >= least).sum())
        beam = FIRST_BEAM
        while beam < len(self.vectors) and self.near(audited, least, beam).shape[1] < RECALL * truth:
            beam *= 2
        return beam


def node_levels(n: int, seed: int) -> np.ndarray:
    """Levels of n nodes, highest first; a level holds about one in `LINKS` nodes of the level below."""
    draws = np.random.default_rng(seed).random(n)
    return np.sort((-np.log(np.maximum(draws, 1e-12)) / np.log(LINKS)).astype(int))[::-1]


INDEX = "grp string, shard int, ids binary, weights binary, vectors binary, layers array<binary>"


def _indexed(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The index row of a shard."""
    ids = table["node"].to_numpy()
    order = np.argsort(ids)
    width = len(table["vector"][0])
    vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(-1, width)[order]
    unit = _unit(vectors)
    graph = Graph.build(unit.astype(np.float32))
    row = (
        table["grp"][0].as_py(),
        table["shard"][0].as_py(),
        ids[order].astype(np.int64).tobytes(),
        table["weight"].to_numpy()[order].astype(np.int64).tobytes(),
        vectors.astype(np.float64).tobytes(),
        [layer.tobytes() for layer in graph.layers],
    )
    return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _linked(batch: pa.RecordBatch, cosine: float) -> dict[str, list]:
    """Links of pairs of shards: per node the vectors linked to it, and edges that keep its components together."""
    nodes, links, partners = [], [], []
    for row in batch.to_pylist():
        ids, other_ids = (np.frombuffer(row[f"{s}_ids"], dtype=np.int64) for s in "st")
        weights, other_weights = (np.frombuffer(row[f"{s}_weights"], dtype=np.int64) for s in "st")
        mine, other = (_unit(np.frombuffer(row[f"{s}_vectors"], dtype=np.float64).reshape(len(i), -1)) for s, i in (("s", ids), ("t", other_ids)))
        layers = [np.frombuffer(x, dtype=np.int32).reshape(-1, 2 * LINKS if l == 0 else LINKS) for l, x in enumerate(row["t_layers"])]
        graph = Graph(other.astype(np.float32), layers)
        queries = mine.astype(np.float32)
        a, b = graph.near(queries, cosine - MARGIN, graph.audited_beam(queries, cosine - MARGIN))
        same = row["s"] == row["t"]
        if same:
            # Both directions of a pair within a shard are one link, whichever of them was found.
            a, b = np.minimum(a, b), np.maximum(a, b)
            a, b = np.unique(np.stack([a, b])[:, a != b], axis=1)
        exact = np.concatenate([(mine[a[i : i + 65536]] * other[b[i : i + 65536]]).sum(axis=1) for i in range(0, len(a), 65536)] or [np.empty(0)])
        a, b = a[exact >= cosine], b[exact >= cosine]
        if same:
            count = np.bincount(a, other_weights[b], len(ids)) + np.bincount(b, weights[a], len(ids))
            parts = [(ids, count)]
        else:
            parts = [(ids, np.bincount(a, other_weights[b], len(ids))), (other_ids, np.bincount(b, weights[a], len(other_ids)))]
        least = _least(len(ids), len(other_ids), a, b, same, ids, other_ids)
        for (who, count), to in zip(parts, least):
            for node, n, partner in zip(who.tolist(), count.astype(np.int64).tolist(), to.tolist()):
                if n:
                    nodes.append(node)
                    links.append(n)
                    partners.append(partner)
    return {"node": nodes, "links": links, "partner": partners}


def _least(n: int, m: int, a: np.ndarray, b: np.ndarray, same: bool, ids: np.ndarray, other_ids: np.ndarray) -> list[np.ndarray]:
    """Least node id of the component of each node among the links of one pair of shards."""
    label = np.concatenate([ids, other_ids])
    b = b if same else b + n
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            break
        label = new
    return [label[:n]] if same else [label[:n], label[n:]]


def similar_vectors(vectors: DataFrame, cosine: float = 0.93, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Equal vectors of a label are one node with a weight, so a vector that stands in a third of all rows is one node. Rows whose
    label or id is null, or whose embedding is null, empty, of zeros or holds null or non-finite numbers, link with nothing.
    Rows of one id are one vector each, of one component. Tables that move: the distinct vectors once to their shard, and each
    shard's index once to each shard of its label, which the method asks for. Of the links only a count per node and pair
    of shards and a forest leave a task.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    good = "label is not null and vec_id is not null and size(vector) > 0 and forall(vector, x -> x is not null and abs(x) < double('Infinity')) and exists(vector, x -> x != 0)"
    rows = rows.withColumn("good", F.coalesce(F.expr(good), F.lit(False)))
    rows = rows.withColumn("grp", F.concat_ws("/", "label", F.size("vector").cast("string")))
    # Zeros of either sign are equal; the digest stands for a vector in joins and groups.
    zeros = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("digest", F.when(F.col("good"), F.sha2(F.concat_ws(",", F.col("grp"), F.transform(zeros, lambda x: x.cast("string"))), 256)))
    nodes = rows.filter("good").groupBy("digest").agg(
        F.min("vec_id").cast("long").alias("node"), F.count("*").alias("weight"), F.first("grp").alias("grp"), F.first("vector").alias("vector")
    )
    nodes = cut_lineage(nodes)
    shards = nodes.groupBy("grp").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    shards = cut_lineage(shards)
    placed = lookup_join(nodes, shards, ["grp"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    schema = arrow_schema(spark, INDEX)
    index = placed.select("grp", "shard", "node", "weight", "vector").groupBy("grp", "shard").applyInArrow(lambda t: _indexed(t, schema), INDEX)
    index = cut_lineage(index)
    pairs = shards.select("grp", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("s"), "shards")
    pairs = pairs.select("grp", "s", F.explode(F.sequence("s", F.col("shards") - 1)).alias("t"))
    side = lambda x: index.select("grp", F.col("shard").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("ids", "weights", "vectors", "layers")])
    both = pairs.join(side("s"), ["grp", "s"]).join(side("t"), ["grp", "t"])
    both = both.select("s", "t", "s_ids", "s_weights", "s_vectors", "t_ids", "t_weights", "t_vectors", "t_layers")
    both = both.repartition(max(1, pairs.count()), "s_ids", "t_ids")
    links = cut_lineage(map_batches(both, lambda batch: _linked(batch, cosine), "node long, links long, partner long"))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("node").alias("a"), F.col("partner").alias("b")))
    found = nodes.join(counted, "node", "left").join(groups, "node", "left")
    found = found.select("digest", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    out = rows.select("vec_id", "digest").join(found, "digest", "left")
    component = F.coalesce("component", F.col("vec_id").cast("long"))
    return out.select(
        "vec_id",
        F.coalesce(F.col("weight") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
