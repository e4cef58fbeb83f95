from __future__ import annotations

import numpy as np
import pytest

from quillframe import TableError
from quillframe.operators.agglomerative import merge
from quillframe.operators.single_linkage import _across, _blocks, closest_pair, single_linkage, spanning_tree


def partition(labels):
    groups = {}
    for i, c in enumerate(labels):
        groups.setdefault(c, set()).add(i)
    return sorted(map(sorted, groups.values()))


def found(spark, x, k, **sizes):
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>").repartition(4)
    label = {tuple(r["x"]): r["cluster"] for r in single_linkage(df, k, **sizes).collect()}
    return [label[tuple(row.tolist())] for row in x]


@pytest.mark.parametrize(("width", "k", "sizes"), [(2, 7, {"block_rows": 32}), (5, 4, {"block_rows": 50, "last_edges": 40})])
def test_equals_merging_pair_by_pair(spark, width, k, sizes):
    draw = np.random.default_rng(width)
    x = draw.normal(size=(420, width)) + 6 * draw.normal(size=(9, width))[draw.integers(0, 9, 420)]
    labels = found(spark, np.r_[x, x[:30]], k, **sizes)
    assert partition(labels[:420]) == partition(merge(x, np.ones(420), k, "single")) and labels[420:] == labels[:30]
    assert sorted(set(labels)) == list(range(k))


def test_two_rings_of_many_points(spark):
    """Clusters that have no centre, of more rows than all pairs could be kept of."""
    turn = np.linspace(0, 2 * np.pi, 6000, endpoint=False)
    ring = np.c_[np.cos(turn), np.sin(turn)]
    labels = found(spark, np.r_[ring, 3 * ring], 2)
    assert partition(labels) == [list(range(6000)), list(range(6000, 12000))]


def test_one_cluster_and_too_few_rows(spark):
    x = np.array([[1.0], [2.0], [2.0], [9.0]])
    assert found(spark, x, 1) == [0, 0, 0, 0] and found(spark, x, 3) == [0, 1, 1, 2]
    with pytest.raises(TableError, match="only 3 different rows"):
        found(spark, x, 4)


def test_tree_of_a_few_points():
    assert sorted(spanning_tree(np.array([[0.0], [5.0], [1.0]]))) == [(1.0, 0, 2), (4.0, 2, 1)]
    assert spanning_tree(np.array([[0.0]])) == []


def test_long_parallel_lines_compare_few_points(spark):
    """Blocks that reach from one line to the next must not be compared with all others; few edges leave the blocks."""
    draw = np.random.default_rng(3)
    x = np.concatenate([np.c_[np.sort(draw.random(3000)), np.full(3000, float(y))] for y in (0, 1, 2, 50, 51)])
    held = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, x array<double>").repartition(4)
    blocks = _blocks(held, len(x), 64).cache()
    edges = _across(blocks).count()
    blocks.unpersist()
    assert edges < 3 * len(x) / 10  # before, each reaching block brought edges to all blocks of both lines
    labels = found(spark, x, 2, block_rows=64)
    assert labels == [0] * 9000 + [1] * 6000


def test_closest_pair_is_that_of_all_pairs():
    draw = np.random.default_rng(5)
    for a, b in ((draw.random((700, 3)), draw.random((900, 3)) + [0.9, 0, 0]), (np.c_[draw.random(800), np.zeros(800)], np.c_[draw.random(600), np.ones(600)])):
        gaps = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
        d, i, j = closest_pair(a, b)
        assert d == pytest.approx(gaps.min(), abs=1e-12) and gaps[i, j] == pytest.approx(d, abs=1e-12)
