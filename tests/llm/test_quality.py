"""Quality features against plain Python, votes against labels."""

import random
import re

import pytest

from keyfold.llm import quality

PROSE = "it is the way of all that was and of what will be in the end for them and us who saw it with our own eyes at last "
TEXTS = [
    None,
    "",
    " \n\t\x0b ",
    "one two three",
    PROSE,
    PROSE + "\n" + PROSE,
    "a b c d e f g h " * 2,
    "a b c d e f g h",
    "x " * 5000,
    "line one\n\nline one\n \nline one \nother",
    "# * $ % & | < > é\xa0b c",
    "\n".join(["same line here"] * 9),
    " ".join(str(i) for i in range(20)),
    "y" * 100_000,
    " ".join(random.Random(i).choice("abc") for i in range(3000)),
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen, repeated = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {p + k for p in places for k in range(8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_features_equal_plain_python(spark, sf_dir):
    given = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*TEXTS, *TEXTS[:3], *given])], "doc_id BIGINT, text STRING, kept INT")
    rows = quality.rate_documents(docs)[0].collect()
    assert len(rows) == docs.count()
    for r in rows:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == brute(r.text), (r.text or "")[:80]
        assert not (r.base_failed and r.kept) and 0 <= r.posterior <= 1


def test_votes_agree_with_labels(spark):
    """No label is used to fit, so all of them are held out."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rated, model = quality.rate_documents(spark.read.parquet(f"{folder}/documents.parquet"), keep=["doc_id"])
    rows = rated.filter("not base_failed").join(labels, "doc_id").select("kept", "quality", "toxic").collect()
    assert len(rows) > 300
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0 and r.toxic == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.05 * len(bad)
    assert 0.7 < model.prior < 0.95


def test_estimation_finds_the_rates():
    rng = random.Random(6)
    good_rates = [(0.02, 0.2, 0.78), (0.05, 0.6, 0.35), (0.01, 0.69, 0.3), (0.1, 0.5, 0.4)]
    bad_rates = [(0.7, 0.2, 0.1), (0.5, 0.45, 0.05), (0.4, 0.55, 0.05), (0.6, 0.3, 0.1)]
    patterns, n = {}, 40_000
    for _ in range(n):
        rates = good_rates if rng.random() < 0.8 else bad_rates
        code = 0
        for r in rates:
            code = code * 3 + rng.choices((0, 1, 2), r)[0]
        patterns[code] = patterns.get(code, 0) + 1
    model = quality.fit_votes(patterns, 4)
    assert model.prior == pytest.approx(0.8, abs=0.03)
    for found, wanted in zip([*model.good, *model.bad], [*good_rates, *bad_rates], strict=True):
        assert found == pytest.approx(wanted, abs=0.05)


def test_empty_table_and_no_python(spark):
    rated, model = quality.rate_documents(spark.createDataFrame([], "doc_id BIGINT, text STRING"))
    assert rated.count() == 0 and model == quality.fit_votes({}, len(quality.default_rules()))
    assert "Python" not in rated._jdf.queryExecution().executedPlan().toString()
