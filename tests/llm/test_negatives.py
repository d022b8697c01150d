import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, most=5, low=80, high=100):
    """By plain loops over all pairs."""
    once: dict = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        once[i] = min(once.get(i, (lab, x)), (lab, x))
    out = []
    for a, (lab, x) in once.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), i, other == lab) for i, (other, y) in once.items() if i != a)
        for s, p, _ in [r for r in scored if r[2]][:positives]:
            fits = [(n, -t) for t, n, same in scored if not same and low * -s <= 100 * -t <= high * -s][:most]
            out += [(a, p, k + 1, n, -s, t) for k, (n, t) in enumerate(fits)]
    return sorted(out)


def check(spark, rows, step, **how):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("clash"), "v": F.lit(1), "asks": F.lit(2), "shard": F.lit(3)})
    found = negatives.hard_negatives(df.repartition(4), F.col("vec_id") % step == 0, F.col("label"), **how)
    got = sorted(map(tuple, found.collect()))
    assert got == brute(rows, lambda a: a % step == 0, **how)
    return got


def vectors(n, dims, labels, seed, rounded=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = np.abs(x) if rounded is None else np.round(np.abs(x), rounded)
    return [(i, v, int(rng.integers(labels))) for i, v in enumerate(x.astype(np.float32).tolist())]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 97)
    assert check(spark, vectors(700, 8, 3, 1), 20)
    # coarse components: many ties
    assert check(spark, vectors(500, 3, 2, 2, rounded=1), 10)
    assert check(spark, vectors(300, 4, 2, 3), 10, positives=2, most=1, low=50, high=95)


def test_copies_of_a_vector_and_a_hot_label(spark):
    rows = [(i, [0.5, 0.5], int(i % 9 == 0)) for i in range(400)] + [(1000 + i, [1.0, 0.25], 1) for i in range(50)]
    assert check(spark, rows, 40)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 2), (4, [None, 1.0], 2), (None, [1.0, 1.0], 1), (5, [1.0, 1.0], None), (6, [], 1), (7, [1.0], 1), (8, [1.0, 1.5, 4.0], 2), (9, [1.0, 1.9], 2), (9, [1.0, 1.9], 2), (10, [-1.0, -1.0], 1), (20, [0.0, 0.0], 2), (30, [-0.001, 0.001], 1), (0, [1.0, 2.0], 1), (11, [1.0, 1.8], 2), (11, [0.5, 1.8], 2)]
    assert check(spark, rows, 10)
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0, F.col("label")).collect() == []


def test_huge_components_do_not_overflow(spark):
    rows = [(0, [3e38, 1.0], 1), (1, [3e38, -3e38], 1), (2, [3e38, 1.0], 2), (3, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = negatives.hard_negatives(df, F.col("vec_id") == 0, F.col("label")).collect()
    assert all(abs(r["positive_score"]) < 1 << 57 for r in got)


def test_keys_sort_as_pairs():
    rows = [(-5, 3, 0, 9), (-5, 3, 1, -2), (-5, 3, 1, 8), (-5, -7, 0, 1), (2, 1 << 55, 0, 4), (2, 0, 1, 4), (2, -(1 << 55), 1, 0)]
    keys = [negatives.packed(np.array([a]), np.array([s]), k, np.array([i]))[0].as_py() for a, s, k, i in rows]
    assert keys == sorted(keys) and [negatives.unpacked(k) for k in keys] == rows


def test_an_equal_score_counts_whatever_the_id():
    # the positive's id is larger than that of the negative with its score
    rows = [(1, 9, negatives.POSITIVE, 7), (1, 9, negatives.NEGATIVE, 3), (1, 7, negatives.NEGATIVE, 2)]
    keys = [negatives.packed(np.array([a]), np.array([s]), k, np.array([i]))[0].as_py() for a, s, k, i in rows]
    assert list(negatives.mined(iter(keys), 5, 5, 80, 100)) == [(1, 7, 1, 3, 9, 9)]


@pytest.mark.parametrize("high", [101, -1])
def test_a_window_lies_below_its_positive(spark, high):
    with pytest.raises(ValueError):
        negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0, F.col("label"), high=high)
