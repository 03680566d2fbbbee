"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.llm import negatives

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, rank STRING"


def brute(rows, every=3):
    """All anchors against all rows, in whole numbers."""
    good = {
        (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for anchor in good:
        if anchor[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(anchor[2], r[2])), r[0], r[1], r) for r in good if len(r[2]) == len(anchor[2])]
        same = sorted(s for s in scored if s[2] == anchor[1] and s[3] != anchor)[:5]
        others = sorted(s for s in scored if s[2] != anchor[1])
        for positive in same:
            fits = [s for s in others if 80 * -positive[0] <= 100 * -s[0] <= 100 * -positive[0]][:5]
            out += [(anchor[0], positive[1], k + 1, s[1], -positive[0], -s[0]) for k, s in enumerate(fits)]
    return sorted(out)


def run(spark, rows, every=3):
    df = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, lambda i: i % every == 0).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(6, 20))
    out = []
    for i in range(400):
        v = centers[rng.integers(6)] + rng.normal(size=20) * 0.5
        out.append((i, (v * rng.choice([0.2, 1.0])).astype(np.float32).tolist(), int(rng.integers(4))))
    out += [(1000 + i, out[5][1], i % 3) for i in range(30)]
    out += [(2000 + i, rng.normal(size=7).astype(np.float32).tolist(), i % 2) for i in range(30)]
    return out


def test_against_all_pairs(spark, rows):
    found = run(spark, rows)
    assert found == brute(rows) and len(found) > 500


def test_groups_of_anchors_and_small_steps(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP_BYTES", 4000)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0], 1), (0, None, 1), (3, [1.0, None], 1), (6, [nan, 1.0], 1), (9, [inf, 1.0], 2), (12, [1.0, 1.0], None)]
    rows += [(15, [], 1), (16, [], 1), (17, [], 2), (18, [0.0, 0.0], 1), (19, [0.0, 0.0], 1), (20, [0.0, -0.0], 2)]
    rows += [(21, [-1.0, 1.0], 3), (22, [1.0, -1.0], 3), (23, [0.5, -0.5], 4), (-3, [0.3, 0.3], 1), (-4, [0.3, 0.3], 2), (-4, [0.2, 0.3], 2)]
    # Repeated rows, and different rows of one id.
    rows += rows[9:12] + [(18, [0.3, 0.4], 1), (18, [0.3, 0.4], 2)]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_double_precision(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=3) * 3e5).astype(np.float32).tolist(), i % 2) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_empty_tables_and_none_to_find(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert run(spark, [(3, [1.0], 1)]) == []


def test_bounds_hold_and_prune():
    """No pair of the range is ruled out; of smooth vectors most others are."""
    rng = np.random.default_rng(1)
    smooth = np.floor(256 * (np.repeat(rng.normal(size=(300, 8)), 8, axis=1) + rng.normal(size=(300, 64)) * 0.05))
    block = negatives.Block(np.arange(300), np.zeros(300, np.int64), np.zeros(300, np.int64), smooth)
    scores = smooth @ smooth.T
    low = np.quantile(scores, 0.99, axis=1)
    high = scores.max(axis=1)
    kept = negatives.surviving(block, block, np.ones_like(scores, bool), low, high)
    wanted = (scores >= low[:, None]) & (scores <= high[:, None])
    assert not (wanted & ~kept).any()
    assert kept.sum() < 3 * wanted.sum()


def test_query_over_given_vectors(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(df.withColumn("label", moved), lambda i: i % 100 == 0).collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in df.collect()]
    assert sorted(tuple(r) for r in found) == brute(rows, 100)
