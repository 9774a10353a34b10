"""Nearest neighbours against brute force: recall, exact scores, ties, copies, rows that take no part, hot partitions."""

import collections
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, part int, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)


def search(df, every=50, **options):
    found = N.nearest(df, F.col("vec_id") % every == 0, **options)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    result = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        result[r.query_id].append((r["rank"], r.vec_id, r.score))
    return result


def brute(rows, every=50, k=5):
    result = {}
    for at, (q, a) in enumerate(rows):
        if q is not None and q % every == 0:
            a = np.array(a, np.float32).astype(float)
            scored = []
            for j, (i, b) in enumerate(rows):
                if j != at:
                    b = np.array(b, np.float32).astype(float)
                    scored.append((-round(float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))), 12), i is None, i))
            result[q] = [(i, -s) for s, _, i in sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return result


def gaussian(n, seed=5, width=16):
    rng = np.random.Generator(np.random.PCG64(seed))
    return [(i, rng.standard_normal(width).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "block_queries": 3}])
def test_recall_and_scores(spark, options):
    rows = gaussian(3000)
    found, truth = search(table(spark, rows), **options), brute(rows)
    assert set(found) == set(truth)
    hits = 0
    for q, near in found.items():
        assert [r for r, _, _ in near] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in near] == sorted((s for _, _, s in near), reverse=True)
        vectors = {i: np.array(rows[i][1]) for i in [q, *(v for _, v, _ in near)]}
        for _, v, s in near:
            assert v != q and s == pytest.approx(vectors[q] @ vectors[v] / np.linalg.norm(vectors[q]) / np.linalg.norm(vectors[v]), abs=1e-12)
        hits += len({v for _, v, _ in near} & {i for i, _ in truth[q]})
    assert hits >= 0.9 * 5 * len(truth)


def test_not_all_partitions_are_searched():
    rng = np.random.Generator(np.random.PCG64(1))
    centres = rng.standard_normal((40, 16)) * 2
    x = centres[rng.integers(0, 40, 4000)] + 0.3 * rng.standard_normal((4000, 16))
    router = N.fit(x, k=5)
    p = router.probabilities(x)
    sizes = np.bincount(p.argmax(axis=1), minlength=p.shape[1])
    row, part = router.probes(p, sizes, 6)
    assert sizes[part].sum() < 0.25 * len(x) * len(x)


def test_partitions_are_balanced_and_keep_neighbours_together():
    rng = np.random.Generator(np.random.PCG64(2))
    x = N.units(rng.standard_normal((1024, 8)))
    lists = N.neighbour_lists(x, 8)
    number = N.balanced_partitions(lists, 16, rng)
    assert set(np.bincount(number).tolist()) == {64}
    together = (number[lists] == number[:, None]).mean()
    assert together > 0.25  # one in sixteen by chance


def test_ties_copies_and_repeated_rows(spark):
    rows = [(i, [1.0, 2.0, 0.5 + i // 4]) for i in range(120)]
    rows += [(50, [1.0, 2.0, 0.5 + 50 // 4]), (None, [1.0, 2.0, 0.5]), (-50, [-1.0, 0.0, 0.0]), (0, [3.0, -1.0, 2.0])]
    found, truth = collections.defaultdict(list), brute(rows)
    for q, near in search(table(spark, rows)).items():
        found[q] = [(v, round(s, 12)) for _, v, s in near]
    twice = found.pop(50)
    assert sorted(twice) == sorted(truth.pop(50) * 2)
    both = found.pop(0)
    del truth[0]
    assert len(both) == 10 and {v for v, _ in both} >= {1, 2, 3}
    assert dict(found) == truth


def test_a_group_of_equal_vectors_is_dealt_out(spark):
    rows = gaussian(600, width=8) + [(i, [1.0] * 8) for i in range(600, 1400)]
    near = search(table(spark, rows), block_rows=100)
    for q in range(600, 1400, 50):
        least = [i for i in range(600, 1400) if i != q][:5]
        assert [v for _, v, _ in near[q]] == least


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, float("inf")])]
    rows += [(7, []), (8, [1.0, 2.0, 3.0]), (50, [0.0, 0.0]), (100, None)]
    found = search(table(spark, rows))
    assert dict(found) == {0: [(1, 1, 0.0)]}
    assert search(table(spark, rows[2:7])) == {}
    assert search(table(spark, [(50, [3.0, 4.0])])) == {}
    assert search(table(spark, [])) == {}


def test_large_and_small_components(spark):
    rows = [(0, [1e308, 1e308]), (1, [1e-300, 0.0]), (2, [-5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = search(df)
    assert [v for _, v, _ in found[0]] == [1, 2]
    assert [s for _, _, s in found[0]] == pytest.approx([0.5**0.5, -(0.5**0.5)], abs=1e-15)


def test_the_fit_holds_no_square_of_its_sample():
    x = N.units(np.random.Generator(np.random.PCG64(1)).standard_normal((3000, 8)))
    tracemalloc.start()
    lists = N.neighbour_lists(x, 4)
    some = N.neighbour_lists(x, 4, np.arange(5, 3000, 8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3000 * 3000 * 8 / 4
    near = x @ x.T
    np.fill_diagonal(near, -2)
    best = np.sort(np.argsort(-near, axis=1)[:, :4], axis=1)
    assert (np.sort(lists, axis=1) == best).all() and (np.sort(some, axis=1) == best[5::8]).all()
