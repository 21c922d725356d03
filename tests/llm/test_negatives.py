"""Hard negatives against brute force, and the intervals that filter the candidates."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int, q long, score string, ids string, vector string"


def brute(rows, positives=5, count=5):
    sound = {
        (i, label, tuple(math.floor(256 * x) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, v in sorted(sound):
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, other) for j, other, w in sound if j != i)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [(n, j) for n, j, other in scored if other != label and 80 * -s <= 100 * -n <= 100 * -s][:count]
            out += [(i, p, k + 1, j, -s, -n) for k, (n, j) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, 1, "s", "i", "v") for i, v, label in rows], COLUMNS)
    found = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, **options)
    assert found.columns == [c.split()[0] for c in negatives.SCHEMA.split(", ")]
    return sorted(tuple(r) for r in found.collect())


def vectors(draw, n, dim, labels, spread=1.0):
    middle = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [float(np.float32(spread * (x + 0.4 * draw.gauss(0, 1)))) for x in draw.choice(middle)], draw.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(("dim", "labels", "n"), [(64, 4, 700), (3, 2, 500), (100, 30, 600), (1, 3, 250)])
def test_equal_brute_force(spark, dim, labels, n):
    rows = vectors(random.Random(dim), n, dim, labels)
    assert (got := mined(spark, rows)) == brute(rows)
    assert got or dim == 1


def test_odd_rows_ties_and_copies(spark):
    draw = random.Random(8)
    rows = vectors(draw, 400, 8, 3)
    same = [0.5, -0.25, 1.0, 0.0, 0.125, 0.5, 0.5, -1.0]
    rows += [(1000 + i, same, i % 7 % 3) for i in range(400)]  # copies under several labels, some of them anchors
    rows += [(2000 + i, [x + 1 / 300 * (i % 3) for x in same], 1) for i in range(200)]  # near copies: equal integers or close
    rows += [(3000, None, 1), (3100, same, None), (None, same, 1), (3200, [math.nan, *same[1:]], 1), (3300, [*same[1:], math.inf], 1), (3400, [None, *same[1:]], 2)]
    rows += [(3500, [], 1), (3600, [0.0] * 8, 2), (3700, [0.0] * 8, 1), (3800, [-x for x in same], 0), (3900, [3e38] * 8, 0)]
    rows += [rows[0], rows[401], rows[401]]
    sound = [r for r in rows if r[0] != 3900]  # its scores would leave 64 bits
    draw.shuffle(rows)
    assert mined(spark, rows) == brute(sound)


def test_options_and_edges(spark):
    rows = vectors(random.Random(4), 300, 16, 2)
    assert mined(spark, rows, positives=2, negatives=3) == brute(rows, 2, 3)
    assert mined(spark, []) == [] and mined(spark, [(100, None, 1)]) == [] and mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(i, [1.0], 0) for i in range(1, 50)]) == []  # no anchor
    with pytest.raises(ValueError, match="components"):
        mined(spark, [(100, [1.0], 1), (101, [1.0, 2.0], 1)])


def test_blocks_and_tiles_change_nothing(spark, monkeypatch):
    rows = vectors(random.Random(6), 900, 12, 3)
    monkeypatch.setattr(negatives, "BLOCK", 2)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "ROWS", 50)
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("dim", [1, 7, 64, 70, 200])
def test_every_score_is_in_its_intervals(dim):
    rng = np.random.default_rng(dim)
    whole = np.floor(rng.standard_normal((600, dim)) * rng.choice([1, 300, 10**6], (600, 1))).astype(np.int64)
    whole[:5] = 0
    whole[5] = whole[6]
    q, r = negatives.Planes(whole[:40]), negatives.Rows(whole, *negatives.encode(whole))
    true = whole[:40] @ whole.T
    estimate, width = negatives.coarse(q, slice(0, 40), r, slice(0, 600))
    assert (np.abs(true - estimate) <= width).all()
    x, y = (k.ravel() for k in np.mgrid[0:40, 0:600])
    middle, half = negatives.fine(q, x, r, y, estimate[x, y])
    assert (np.abs(true[x, y] - middle) <= half).all()
    assert (negatives.scores(q, x, r, y) == true[x, y]).all()
    if dim == 64:  # scores of random pairs deviate by 1 / 8
        lengths = np.sqrt((whole[:40] ** 2).sum(1))[x] * np.sqrt((whole**2).sum(1))[y]
        assert (half[lengths > 0] / lengths[lengths > 0]).mean() < 0.05
