from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm.negatives import encoded, hard_negatives, intervals, op11_hard_negatives


def plain(rows, positives=5, negatives=3, band=(50, 95)):
    """(anchor, positive, rank, negative, scores) by the definition; rows are (id, label, vector)."""
    rows = [r for r in dict.fromkeys((i, label, None if v is None else tuple(v)) for i, label, v in rows)
            if r[1] is not None and r[2] is not None and None not in r[2]]
    named = lambda i: (i is None, i or 0)
    out = []
    for i, label, v in rows:
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), named(j), j, other) for j, other, w in rows
                         if len(w) == len(v)), key=lambda s: s[:2])
        for score, _, j, _ in [s for s in scored if s[3] == label and s[2] != i][:positives]:
            found = [s for s in scored if s[3] != label and band[0] * -score <= 100 * -s[0] <= band[1] * -score][:negatives]
            out += [(i, j, n, k, -score, -s) for n, (s, _, k, _) in enumerate(found, 1)]
    return sorted(out, key=repr)


def found(spark, items, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in items], "vec_id long, label int, vector array<bigint>, slice string, words string")
    got = hard_negatives(frame, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)), **options).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.fixture(scope="module")
def vectors():
    random.seed(4)
    centres = [[random.randint(-100, 100) for _ in range(20)] for _ in range(12)]
    return [(i, random.choice((0, 0, 0, 1, 2, 3)), [c + random.randint(-60, 60) for c in random.choice(centres)]) for i in range(900)]


@pytest.mark.parametrize("options", [{}, {"rows": 100, "anchors": 4}])
def test_equals_brute_force_whatever_the_cells(spark, vectors, options):
    assert found(spark, vectors, **options) == plain(vectors)


def test_ties_and_odd_rows(spark):
    same = [(i, i % 2, [3, 4, 5]) for i in range(200)] + [(i, 2, [2, 3, 4]) for i in range(200, 300)]
    odd = [(300, 0, None), (301, None, [1, 2, 3]), (302, 0, [1, None, 3]), (None, 0, [9, 9, 9]), (None, 1, [2, 3, 4]), (350, 0, []),
           (351, 0, []), (352, 1, []), (353, 0, [1]), (400, 7, [9, 1, 0]), (450, 0, [0, 0, 0]), (500, 0, [-3, -4, -5]), (50, 0, [3, 4, 6])]
    rows = [*same, *same[:20], *odd]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_intervals_hold_the_scores():
    rng = np.random.default_rng(1)
    for dim in (1, 7, 64, 130):
        rows, queries = rng.integers(-256, 257, (400, dim)), rng.integers(-256, 257, (30, dim))
        rows[:2], queries[0] = 0, 0
        low, high = intervals(encoded(rows), queries)
        exact = rows @ queries.T
        assert (low <= exact).all() and (exact <= high).all()
    # Four codes leave about an eighth of a vector: most pairs can be told apart without scoring them.
    size = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
    assert ((high - low)[2:, 1:] / size[2:, 1:]).mean() < 0.5


def test_components_that_are_not_finite(spark, tmp_path):
    rows = [(0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.125]), (2, 2, [0.25, 0.125]), (3, 2, [float("nan"), 1.0]), (4, 2, [float("inf"), 1.0]), (5, 2, [None, 1.0]), (6, 2, None)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    # The anchor's label becomes 2, so it has one positive and one negative too good for it.
    assert {r.anchor_id for r in op11_hard_negatives(spark, str(tmp_path)).collect()} <= {0}
