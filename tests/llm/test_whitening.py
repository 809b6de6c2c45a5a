"""Whitening against numpy over all vectors at once."""

import math

import numpy as np
import pytest

from gleaner.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, row long, x string"


def vectors(size=6, n=300):
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) + rng.normal(size=size)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(mixed)]
    rows += [(n + k, rows[0][1]) for k in range(200)] + [(5, rows[5][1]), (None, rows[7][1])]
    bad = [None, [], [math.nan] * size, [math.inf] + [0.0] * (size - 1), [None] + [1.0] * (size - 1), [1.0] * (size - 1)]
    return rows, [(9000 + k, v) for k, v in enumerate(bad)]


def expected(rows, components, steps=256):
    x = np.floor(np.array([v for _, v in rows], dtype=np.float32).astype(float) * steps)
    fit = np.unique(x, axis=0)
    n, centred = len(fit), fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    scores = (x - fit.mean(axis=0)) @ axes[:, :components] / np.sqrt(values[:components])
    deviation = ((n * x - fit.sum(axis=0)) ** 2).sum(axis=1).astype(int)
    return n, scores, deviation, values / values.sum()


@pytest.mark.parametrize("block_rows,split_blocks,components", [(4096, 8, 4), (32, 2, 4), (7, 3, 9)])
def test_equals_numpy(spark, monkeypatch, block_rows, split_blocks, components):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", split_blocks)
    rows, bad = vectors()
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows + bad], SCHEMA).repartition(5)
    found = whitening.whitened(table, components).collect()
    n, scores, deviation, explained = expected(rows, components)
    k = min(components, 6)
    assert len(found) == k * len(rows)
    signs = {}
    by_id = {}
    for r in found:
        by_id.setdefault((r["vec_id"], r["component"]), []).append(r)
    for (i, _), score, d in zip(rows, scores, deviation):
        for j in range(k):
            for r in by_id[i, j + 1]:
                signs.setdefault(j, math.copysign(1, r["whitened"] * score[j]))
                assert r["whitened"] == pytest.approx(signs[j] * score[j], abs=1e-9)
                assert r["deviation"] == d and r["n"] == n
                assert r["explained"] == pytest.approx(explained[j], rel=1e-9)
                assert r["identity_error"] < 1e-9
    assert len(by_id[5, 1]) == 2 and len(by_id[None, 1]) == 1


def test_one_vector_and_flat_components(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    rows = whitening.whitened(one).collect()
    assert len(rows) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["n"] == 1 and r["identity_error"] is None for r in rows)
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<float>")
    rows = whitening.whitened(flat).collect()
    assert {r["component"] for r in rows if r["whitened"] is None} == {2} and all(r["identity_error"] < 1e-9 for r in rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, 1, 1, "x"), (2, [math.nan], 1, 1, "x")], SCHEMA)
    assert whitening.whitened(nothing).count() == 0


def test_great_entries_do_not_fail(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-3e38, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whitened(table).count() == 6
