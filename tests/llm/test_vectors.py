"""Near vectors against all pairs."""

import math

import numpy as np
import pytest

from keyfold.llm import vectordup

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, kept STRING"


def brute(rows):
    """Links and component by id, from all pairs of usable rows."""
    links, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    good = [
        (i, np.array(v, dtype=np.float32).astype(float), label)
        for i, v, label in rows
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    for n, (i, v, a) in enumerate(good):
        for j, w, b in good[:n]:
            if a == b and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] += 1
                links[j] += 1
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (links[i], find(i)) for i in links}


def run(spark, rows):
    df = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)
    found = vectordup.near_vectors(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    return found


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for _ in range(120):
        center = rng.normal(size=24)
        for _ in range(rng.integers(1, 7)):
            v = center + rng.normal(size=24) * rng.choice([0.0, 0.02, 0.1, 0.15])
            out.append((len(out), (v * rng.choice([1.0, 3.0])).astype(np.float32).tolist(), int(rng.integers(0, 3))))
    center = rng.normal(size=24)
    for i in range(90):
        out.append((len(out), (center + rng.normal(size=24) * 0.12).astype(np.float32).tolist(), 1))
    for i in range(40):
        out.append((len(out), center.astype(np.float32).tolist(), 1))
    return out


@pytest.mark.parametrize("block", [vectordup.BLOCK, 16])
def test_recall_and_no_wrong_link(spark, rows, monkeypatch, block):
    monkeypatch.setattr(vectordup, "BLOCK", block)
    wanted = brute(rows)
    found = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, rows)}
    assert all(found[i][0] <= wanted[i][0] for i in wanted)
    total = sum(n for n, _ in wanted.values())
    assert total > 5000
    assert sum(n for n, _ in found.values()) >= 0.99 * total
    assert sum(found[i][1] == wanted[i][1] for i in wanted) >= 0.99 * len(wanted)


def test_odd_rows(spark):
    one, nan, inf = [1.0, 2.0, 0.0], float("nan"), float("inf")
    rows = [
        (1, one, 1), (2, one, 1), (3, [2.0, 4.0, -0.0], 1), (4, one, 2), (5, one, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [1.0, None, 0.0], 1), (9, [nan, 1.0, 0.0], 1), (10, [inf, 1.0, 0.0], 1), (11, [], 1), (12, [1.0, 2.0], 1), (13, [1e-38, 2e-38, 0.0], 1),
        (14, [3e38, 3e38, 3e38], 1), (15, [-1.0, -2.0, 0.0], 1),
    ]
    found = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, rows)}
    linked = {1: (3, 1), 2: (3, 1), 3: (3, 1), 13: (3, 1)}
    assert found == {i: linked.get(i, (0, i)) for i in range(1, 16)}


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (9, [1.0, 0.1], 1)]
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in run(spark, rows)), key=repr)
    assert found == sorted([(None, 0, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)], key=repr)


def test_empty_table_and_only_odd_rows(spark):
    assert run(spark, []) == []
    assert [(r.n_links, r.component_id) for r in run(spark, [(3, None, 1)])] == [(0, 3)]


def test_given_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wanted = brute([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectordup.near_vectors(df).collect()} == wanted
