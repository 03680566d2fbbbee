"""Language model scores against plain counting, and on held-out labels."""

from collections import Counter

import numpy as np
import pytest

from keyfold.llm import lmscore

SCHEMA = "doc_id BIGINT, text STRING, score STRING"


def brute(rows, target, words):
    """Losses by row from dictionaries of counts."""
    # One more for words that were never counted.
    size = len(words) + 1
    coded = [lmscore.tokens(text) for _, text, _ in rows]
    pairs = [list(zip([None, *c], c, strict=False)) for c in coded]
    every = Counter(p for own in pairs for p in own)
    wanted = Counter(p for (i, _, _), own in zip(rows, pairs, strict=True) if i in target for p in own)
    scale = sum(wanted.values()) / max(sum(every.values()), 1)
    models = []
    for counts in (wanted, Counter({p: n * scale for p, n in every.items()})):
        single, after = Counter(), Counter()
        for (a, b), n in counts.items():
            single[b] += n
            after[a] += n
        total = sum(single.values()) + lmscore.START * size

        def loss(a, b, counts=counts, single=single, after=after, total=total):
            return -np.log((counts[a, b] + lmscore.PRIOR * (single[b] + lmscore.START) / total) / (after[a] + lmscore.PRIOR))

        models.append(loss)
    return [[np.mean([m(*p) for p in own]) if own else None for m in models] for own in pairs]


def test_scores_equal_plain_counting(spark):
    rows = [(1, "The cat sat. The cat ran!", "x"), (2, "a dog_ sat, Ünder 3 trees", "x"), (3, None, "x"), (4, "", "x"), (None, "the the the", "x"), (1, "the cat", "x")]
    rows += [(10 + i, f"word{i} and the cat of {i}", "x") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([(1,), (1,), (None,), (12,), (999,)], "doc_id BIGINT")
    model = lmscore.fit_models(docs, target)
    words = {t for _, text, _ in rows for t in lmscore.tokens(text)}
    assert model.n_words == len(words)
    wanted = {text: losses for (_, text, _), losses in zip(rows, brute(rows, {1, 12}, words), strict=True)}
    # Many tasks and so many chunks, or one; both ways to the counts.
    found = [r for parts in (7, 1) for r in lmscore.score_corpus(docs.repartition(parts), target).collect()]
    found += [r for parts in (7, 1) for r in lmscore.score_documents(docs.repartition(parts), model).collect()]
    assert len(found) == 4 * len(rows)
    for r in found:
        a, b = wanted[r.text]
        if a is None:
            assert (r.n_tokens, r.loss_target, r.loss_background, r.score) == (0, None, None, None)
        else:
            assert (r.loss_target, r.loss_background) == pytest.approx((a, b), rel=1e-5)
            assert r.score == pytest.approx(a - b, abs=1e-4)


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = lmscore.fit_models(docs, lmscore.good_documents(labels.filter("doc_id % 2 = 0")))
    scored = lmscore.score_documents(docs, model, keep=["doc_id"]).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = scored.filter("score is not null").select("score", "quality").collect()
    good, bad = (np.array([r.score for r in rows if r.quality == q]) for q in (1, 0))
    assert (good[:, None] < bad[None, :]).mean() > 0.9


def test_no_target_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], SCHEMA)
    nothing = spark.createDataFrame([], "doc_id BIGINT")
    row = lmscore.score_documents(docs, lmscore.fit_models(docs, nothing)).first()
    assert row.score == 0.0 and row.loss_target == row.loss_background
    assert lmscore.score_corpus(docs, nothing).first() == row
    assert lmscore.score_corpus(docs.limit(0), nothing).count() == 0
    empty = docs.limit(0)
    assert lmscore.score_documents(empty, lmscore.fit_models(empty, nothing)).count() == 0


def test_blocks_grow_after_they_are_many():
    gb = 1 << 30
    assert [1 << lmscore.block_bits(n) for n in (0, gb, 30 * gb, 60 * gb, 1000 * gb)] == [64, 2048, 4096, 4096, 65536]


def test_contradicting_labels(spark):
    rows = [(1, 1, 0), (1, 1, 1), (2, 1, None), (3, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0), (5, 1, 0), (5, 1, 0)]
    found = lmscore.good_documents(spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")).collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [2, 5]


def test_every_word_has_cells_of_its_own(spark):
    """Rare words of the same ending differ, and what is counted grows with the words."""
    rows = [(i, f"common {'good' if i % 2 else 'bad'}{i}ing", "x") for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = docs.filter("doc_id % 2 = 1").select("doc_id")
    model = lmscore.fit_models(docs, target)
    assert (model.n_words, model.pairs, model.pairs_target) == (2001, 4000, 2000)
    half = lmscore.fit_models(docs.filter("doc_id < 1000"), target)
    assert (half.n_words, half.pairs) == (1001, 2000)
    scores = {r.doc_id: r.score for r in lmscore.score_documents(docs, model, keep=["doc_id"]).collect()}
    assert max(s for i, s in scores.items() if i % 2) < min(s for i, s in scores.items() if not i % 2)
    # Words and pairs that were never counted are the unknown class.
    new = spark.createDataFrame([(1, "neverseen otherword", "x")], SCHEMA)
    (row,) = lmscore.score_documents(new, model).collect()
    unknown = [lmscore.START / (n + lmscore.START * 2002) for n in (2000, 2000)]
    before = [lmscore.PRIOR * u / (1000 + lmscore.PRIOR) for u in unknown]
    wanted = [np.mean([-np.log(a), -np.log(b)]) for a, b in zip(before, unknown, strict=True)]
    assert (row.loss_target, row.loss_background) == pytest.approx(wanted)
