"""Threshold pairs by cover trees against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landinglake.llm import cover_join
from landinglake.llm.cover_tree import CoverTree, chord, unit

SCHEMA = "vec_id bigint, embedding array<{}>, label int"


def all_pairs(rows, cosine=0.9):
    """Sorted (vec_id, n_links, component_id, kept) of rows (vec_id, vector)."""
    def sound(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for size in {len(v) for _, v in rows if sound(v)}:
        own = [i for i, (_, v) in enumerate(rows) if sound(v) and len(v) == size]
        points = unit(np.array([rows[i][1] for i in own], float))
        products = points @ points.T >= cosine
        for a, i in enumerate(own):
            for b, j in enumerate(own):
                if i != j and (products[a, b] or rows[i][1] == rows[j][1]):
                    links[i] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, (vec, _) in enumerate(rows):
        if vec is not None:
            least[find(i)] = min(vec, least.get(find(i), vec))
    return sorted(((vec, links[i], least.get(find(i)), vec is not None and least[find(i)] == vec)
                   for i, (vec, _) in enumerate(rows)), key=str)


def found_rows(frame):
    assert frame.columns[:4] == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, frame.collect()), key=str)


def clustered(rng, clusters, each, dims, noise):
    centres = rng.normal(size=(clusters, dims))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    points = np.repeat(centres, each, axis=0)
    return points + rng.normal(size=points.shape) * noise / math.sqrt(dims)


CASES = {
    "no structure": lambda rng: rng.normal(size=(300, 48)),
    "few dimensions": lambda rng: rng.normal(size=(400, 3)),
    "two dimensions": lambda rng: rng.normal(size=(300, 2)),
    "tight groups": lambda rng: clustered(rng, 8, 50, 32, 0.05),
    "groups about as wide as the threshold": lambda rng: clustered(rng, 5, 80, 24, 0.33),
    "one wide group": lambda rng: clustered(rng, 1, 400, 16, 0.4),
    "a third in one tight group": lambda rng: np.concatenate(
        [clustered(rng, 1, 150, 32, 0.02), rng.normal(size=(300, 32))]),
}


ONE_CHUNK, MANY_CHUNKS = (2_000_000, 1024), (8_000, 40)


@pytest.mark.parametrize("case, limits", [
    *((case, MANY_CHUNKS) for case in CASES), ("few dimensions", ONE_CHUNK),
    ("groups about as wide as the threshold", ONE_CHUNK)])
def test_all_links_are_found(spark, case, limits):
    """In many chunks, with cells that are dealt to several, and whole in one chunk."""
    points = CASES[case](np.random.default_rng(len(case))).astype(np.float32)
    rows = [(i * 7 % 1009, [float(x) for x in v]) for i, v in enumerate(points)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA.format("float")).repartition(3)
    found = cover_join.near_duplicates(frame, chunk_bytes=limits[0], sample=limits[1])
    assert found_rows(found) == all_pairs(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_awkward_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [5.0, 0.5]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]),
            (11, [-1.0, 0.0]), (12, [1.0, 0.0, 0.0]), (13, [2.0, 0.0, 0.0]), (None, [0.0, 1.0]),
            (14, [0.0, 3.0]), (None, [-1.0, -1.0]), (15, [1e-30, 1e-31]), (16, [3e30, 1e30]),
            (12, [0.0, 1.0]), (None, None), (4, None), (17, [0.9, math.sqrt(1 - 0.81)]),
            (18, [1.0, 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA.format(kind)).withColumns(
        {c: F.lit("x") for c in ("key", "node", "chunk", "copies", "least", "a", "root")})
    if kind == "float":
        rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v])
                for i, v in rows]
    assert found_rows(cover_join.near_duplicates(frame)) == all_pairs(rows)


def test_many_copies_and_scaled_copies(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(3, 16)).astype(np.float32)
    rows = [(i, [float(x) for x in base[0]]) for i in range(400)]
    rows += [(1000 + i, [float(x) for x in base[1] * np.float32(2.0 ** (i % 9))]) for i in range(90)]
    rows += [(2000, [float(x) for x in base[2]])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA.format("float"))
    found = cover_join.near_duplicates(frame, chunk_bytes=100, sample=3)
    assert found_rows(found) == all_pairs(rows)


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA.format("float"))
    assert found_rows(cover_join.near_duplicates(frame)) == []


@pytest.mark.parametrize("cosine", [0.5, 0.99, 1.0])
def test_other_thresholds(spark, cosine):
    points = clustered(np.random.default_rng(8), 6, 30, 8, 0.15).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*points, *points[:5]])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA.format("float"))
    found = cover_join.near_duplicates(frame, cosine, chunk_bytes=2_000, sample=16)
    assert found_rows(found) == all_pairs(rows, cosine)


def test_trees_cover_and_radii_halve():
    rng = np.random.default_rng(2)
    for points in (rng.normal(size=(500, 6)), clustered(rng, 4, 100, 12, 0.3), np.ones((80, 3))):
        tree = CoverTree(points)
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        exact = unit(points)[tree.order]
        for node in range(len(tree.begin)):
            own = exact[tree.begin[node]:tree.end[node]]
            away = chord(own @ own[0])
            assert away.max() <= tree.radius[node] + 1e-9 or tree.single(np.array([node]))[0]
            kids = tree.open(np.array([node]))
            if not tree.single(np.array([node]))[0]:
                assert tree.begin[kids[0]] == tree.begin[node]  # the centre is one of its children
                assert tree.end[kids[-1]] == tree.end[node]
                assert (tree.begin[kids[1:]] == tree.end[kids[:-1]]).all()


def test_far_groups_never_meet(spark):
    """Chunks of groups that the radii keep apart are not paired."""
    rng = np.random.default_rng(6)
    points = clustered(rng, 12, 60, 40, 0.1)
    tree = CoverTree(points[::6])
    away = np.full(len(tree.points), 0.12)
    i, j = cover_join._cell_pairs(tree, away, math.sqrt(0.2))
    group = tree.order // 10
    assert {(a, b) for a, b in zip(group[i].tolist(), group[j].tolist())} \
        == {(a, a) for a in range(12)}
