"""Mixing: targets, limits, nearness, reruns and odd rows. The SQL test compares every row."""

import random

import pytest
from pyspark.sql import functions as F

from keyfold.llm import mixing

SCHEMA = "doc_id BIGINT, text STRING, source STRING, size STRING"


def words(n):
    return " ".join(["w"] * n)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = [(i, words(int(rng.paretovariate(1) * 20) % 900), rng.choice(["b", "a", "é", None, "hot", "hot"]), "x") for i in range(1500)]
    rows += [(None, None, "a", "x"), (None, "", "b", "x"), (7, words(9), "a", "x"), (7, words(9), "a", "x")]
    rows += [(9000 + i, words(30), "tiny", "x") for i in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def targets(sizes, weights=(1, 2, 3), most=3):
    """By the rule as it is stated, one round after the other."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        left = {s: weight[s] for s in order if s not in full}
        level = (total - sum(full.values())) / (sum(left.values()) or 1)
        over = {s: most * sizes[s] for s in left if left[s] * level > most * sizes[s]}
        if not over:
            return full | {s: w * level for s, w in left.items()}
        full |= over


def test_targets_limits_and_nearness(spark, corpus):
    mixed = mixing.mix_sources(corpus)
    assert mixed.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies"]
    rows = mixed.collect()
    assert len(rows) == corpus.count()
    sizes = {}
    for r in rows:
        assert r.size == len((r.text or "").split())
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.copies <= 3 and (r.size or not r.copies)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for source in sizes:
        own = [r for r in rows if r.source == source]
        taken = sum(r.size * r.copies for r in own)
        # No further off than half of the document at which the sample ends.
        assert abs(taken - want[source]) <= max(r.size for r in own) / 2 + 1e-6


def test_reruns_agree_however_rows_are_dealt(spark, corpus):
    key = lambda df: sorted(map(tuple, mixing.mix_sources(df, keep=["doc_id"]).collect()), key=repr)
    assert key(corpus) == key(corpus.repartition(7).orderBy(F.desc("text")))


def test_copies_become_rows(spark, corpus):
    mixed = mixing.mix_sources(corpus)
    assert mixing.take_copies(mixed, ["doc_id"]).count() == mixed.agg(F.sum("copies")).first()[0]


def test_grades_change_inclusion(spark):
    """Among documents of one source, longer ones are taken more often."""
    rows = [(i, words(20 if i % 2 else 100), s, "x") for s in "abc" for i in range(400)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA))
    by = {r["size"]: r["c"] for r in mixed.filter("source = 'a'").groupBy("size").agg(F.avg("copies").alias("c")).collect()}
    assert by[100] > 1.5 * by[20]


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = mixing.mix_sources(spark.createDataFrame([(1, None, "a", ""), (2, " \n", None, "")], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.target, r.copies) for r in rows] == [(0, 0, 0.0, 0)] * 2


def test_documents_without_ids_are_drawn_by_their_texts(spark):
    """A hundred of one size: about as many words are taken as the target says, not all or none."""
    def rows(source, ids):
        return [(i if ids else None, " ".join(f"w{source}{i}x{j}" for j in range(11)), source) for i in range(100)]

    docs = spark.createDataFrame(rows("a", False) + rows("b", True) + rows("c", False), "doc_id BIGINT, text STRING, source STRING")
    for r in mixing.mix_sources(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("t")).collect():
        assert abs(r.n - r.t) <= 11 / 2 + 1e-6
