"""The pipeline's stages on the given documents, each against brute force."""

from collections import Counter

import public_tokenizers
import pytest
from test_mixing import targets
from test_neardup import brute as duplicates
from test_quality import brute as features
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline

NAMES = ["quality_rules", "near_duplicates", "mix_sources", "bpe"]


@pytest.fixture(scope="module")
def stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], folder).cache())
    return out


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(stages):
    rated = {r.doc_id: features(r.text) for r in stages[0].collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert not any(rated[i][-1] for i in kept)
    assert len(kept) > 0.9 * sum(not f[-1] and f[2] < 0.02 * f[0] for f in rated.values())


def test_near_duplicate_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    groups = {}
    for (doc_id, _), c in zip(rows, duplicates(rows), strict=True):
        groups.setdefault(c, []).append(doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(min(g) for g in groups.values())


def test_mix_stage(stages):
    before, after = stages[2].collect(), Counter(r.doc_id for r in stages[3].collect())
    size = {r.doc_id: len((r.text or "").split()) for r in before}
    of = {r.doc_id: r.source for r in before}
    sizes = Counter()
    for i, n in size.items():
        sizes[of[i]] += n
    want = targets(dict(sizes))
    assert set(after) <= set(size) and max(after.values()) <= 3
    for source in sizes:
        taken = sum(size[i] * n for i, n in after.items() if of[i] == source)
        assert abs(taken - want[source]) <= max(n for i, n in size.items() if of[i] == source) / 2 + 1e-6


def test_last_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in stages[3].collect()}
    rows = stages[4].collect()
    assert len(rows) == stages[3].count()
    for r in rows:
        assert r.ids == library.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_is_the_stages(spark, stages):
    found = entry_points.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, stages[-1].collect()), key=repr)


def test_odd_documents(spark):
    """Null ids and texts, repeated rows, an empty table, and columns named like the stages' own."""
    prose = "it is the way of all that was and of what will be in the end for them and us who saw it with our own eyes at last here"
    rows = [(None, None, None), (1, "", "a"), (2, prose, "a"), (2, prose, "a"), (None, prose + " more", None), (3, "x " * 50_000, "a")]
    schema = "doc_id BIGINT, text STRING, source STRING, n_words INT, posterior STRING, kept STRING, size STRING, copies DOUBLE, target INT, node STRING"
    docs = spark.createDataFrame([(*r, 77, "p", "k", "s", 0.5, 3, "n") for r in rows], schema)
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, "")
            assert table.dtypes == docs.dtypes
        last = corpus_pipeline.tokenize(spark, table, "")
        assert last.columns == [*docs.columns, "n_tokens", "ids"]
        assert all(tuple(r)[3:-2] == (77, "p", "k", "s", 0.5, 3, "n") and r.text for r in last.collect())
