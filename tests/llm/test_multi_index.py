from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from quillframe.llm.multi_index import k_means, nearest_neighbours, walk
from quillframe.llm.queries import REGISTRY


def brute(rows, k=10, every=100):
    """All neighbours of each query, nearest first, as (vec_id, distance)."""
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], dtype=np.float64)
    result = []
    for i, v in rows:
        if i % every == 0:
            far = np.sqrt(((points - np.asarray(v, np.float64)) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
            result.append((i, [(int(ids[j]), float(far[j])) for j in order]))
    return result


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_on_a_table(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = defaultdict(list)
    for r in REGISTRY["op8_nearest_neighbours"][0](spark, folder).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = total = 0
    vectors = dict(rows)
    for query, near in brute(rows):
        got = sorted(found[query])
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert [(s, v) for _, v, s in got] == sorted((s, v) for _, v, s in got)
        for _, v, s in got:
            assert np.isclose(s, np.sqrt(((np.array(vectors[v], np.float64) - np.array(vectors[query], np.float64)) ** 2).sum()), rtol=1e-12)
        hits += len({v for _, v, _ in got} & {v for v, _ in near})
        total += len(near)
    assert hits / total >= 0.95


def test_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(1, 60)]
    rows += [(0, rows[0][1]), (100, rows[5][1]), (100, rows[5][1]), (200, [1.0] * 6), (7, rows[6][1]), (61, rows[6][1])]
    bad = [(300, None), (62, [0.0] * 6), (63, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (64, [float("nan")] * 6), (65, [float("inf")] * 6), (66, []), (67, [1.0, 2.0]), (None, [1.0] * 6)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, uid string").repartition(4)
    found = defaultdict(list)
    for r in nearest_neighbours(table, first=20, centroids=4, rows_per_shard=10, queries_per_chunk=1, recall=1 - 1e-12).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    expected = defaultdict(list)
    for query, near in brute(rows):
        expected[query] += [(i + 1, v, s) for i, (v, s) in enumerate(near)]
    assert set(found) == {0, 100, 200}
    for query in expected:
        assert [x[:2] for x in sorted(found[query])] == [x[:2] for x in sorted(expected[query])]
        assert np.allclose([x[2] for x in sorted(found[query])], [x[2] for x in sorted(expected[query])])


def test_small_and_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest_neighbours(none).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id, r.score) for r in nearest_neighbours(few).orderBy("rank").collect()] == [(1, 1, 0.0), (2, 2, 2.0)]
    assert nearest_neighbours(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_the_walk_is_in_order():
    draw = np.random.default_rng(1)
    a, b = draw.random(9), draw.random(7)
    seen = list(walk(a, b))
    assert [s for s, _, _ in seen] == sorted((a[:, None] + b[None, :]).ravel().tolist())
    assert len({(i, j) for _, i, j in seen}) == 63
    assert len(k_means(np.ones((20, 3)), 5)) == 1
