"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardrisk.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, strip string, v binary"


def plain(rows, k=5, m=10):
    valid = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        own = ((label + 1) % 10 if i % 7 == 0 else label, whole)
        valid[i] = min(valid.get(i, own), own)
    width = max((len(v) for _, v in valid.values()), default=0)
    valid = {i: (label, v + [0] * (width - len(v))) for i, (label, v) in valid.items()}
    out = []
    for a in sorted(i for i in valid if i % 100 == 0):
        scores = {i: sum(x * y for x, y in zip(valid[a][1], v)) for i, (_, v) in valid.items()}
        same = sorted((i for i in valid if i != a and valid[i][0] == valid[a][0]), key=lambda i: (-scores[i], i))[:k]
        others = sorted((i for i in valid if valid[i][0] != valid[a][0]), key=lambda i: (-scores[i], i))
        for p in same:
            near = [i for i in others if 30 * scores[p] <= 100 * scores[i] <= 90 * scores[p]][:m]
            out += [(a, p, r + 1, n, scores[p], scores[n]) for r, n in enumerate(near)]
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, "x", "y", None) for i, v, label in rows], SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(table, F.col("id") % 100 == 0, label, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def vectors(seed, n=900, dims=24, groups=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(groups)]
    return [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)], rng.randrange(groups)) for i in range(n)]


@pytest.mark.parametrize("seed,strip,block", [(0, 65536, 4096), (1, 100, 3), (2, 37, 4096)])
def test_against_brute_force(spark, seed, strip, block):
    """In one strip and in many, with one block of anchors and with several."""
    rows = vectors(seed)
    want = plain(rows)
    assert mined(spark, rows, strip=strip, block=block) == want and len(want) > 50


def test_ties_and_equal_vectors(spark):
    """A third of all rows have one vector, so scores tie and windows of positives coincide."""
    rows = vectors(3, 300)
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(150)]
    assert mined(spark, rows, strip=64) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(4, 250, dims=6) + [
        (300, None, 1), (400, [1.0] * 6, None), (500, [nan] + [1.0] * 5, 1), (600, [inf] * 6, 1), (700, [None] * 6, 1),
        (None, [0.5] * 6, 1), (800, [], 1), (801, [0.5], 2), (900, [0.0] * 6, 3), (100, [0.3] * 6, 9), (100, [0.3] * 6, 0),
        (1000, [-0.5] * 6, 2), (1100, [5.0] * 6, 8)]
    assert mined(spark, rows) == plain(rows)


def test_components_too_large_for_exact_sums_take_no_part(spark):
    rows = vectors(5, 120, dims=6)
    assert mined(spark, rows + [(200, [1e30] * 6, 1), (300, [-1e12] * 6, 1)]) == plain(rows)


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []
    rows = [(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2)]
    assert mined(spark, rows) == plain(rows) == [(100, 1, 1, 2, 65536, 32768)]


def test_the_scan_drops_rows_before_the_last_column():
    """Bounds are right at every step: what is left at the end is what a whole product finds."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    matrix = (rng.normal(size=(4000, 64)) * np.linspace(3, 0.01, 64) * 50).astype(np.int64)
    strip = hard_negatives.Strip(pa.table({"id": np.arange(4000), "label": np.zeros(4000, np.int32), "v": list(matrix)}))
    looked_at = []

    def keep(lowest, highest):
        looked_at.append(len(lowest))
        return highest >= hard_negatives.kth(lowest, 5)

    rows, scores = strip.scan(matrix[0], np.arange(4000), keep)
    whole = matrix @ matrix[0]
    assert set(np.argsort(-whole, kind="stable")[:5]) <= set(rows.tolist())
    assert (whole[rows] == scores).all() and looked_at[-1] < looked_at[0] / 10
