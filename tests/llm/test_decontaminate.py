"""Benchmark passages against a search of every place."""

import random
import re

import numpy as np
import pytest

from keyfold.llm import decontaminate
from keyfold.llm.wumanber import Patterns, Words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, window=10):
    """Words, hit words and items of one text."""
    words, hit, found = split(text), set(), set()
    for item, item_text in items:
        own = split(item_text)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if own else ():
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def compare(spark, docs, items, **settings):
    rows = spark.createDataFrame(list(enumerate(docs)), "n_hit INT, text STRING").withColumnRenamed("n_hit", "place")
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = decontaminate.find_benchmark(rows, bench, keep=["place"], **settings).collect()
    assert len(found) == len(docs)
    for row in found:
        n_words, n_hit, names = brute(docs[row.place], items)
        assert (row.n_words, row.n_hit, row["items"]) == (n_words, n_hit, names)
        spans = np.array(row.spans).reshape(-1, 2)
        assert (spans[:, 1] - spans[:, 0]).sum() == n_hit


@pytest.fixture(scope="module")
def case():
    random.seed(5)
    vocabulary = ["a", "B", "cc", "Đd", "éa", "x1", "12", "漢字", "end", "the"]
    text = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, text(random.choice([3, 5, 9, 10, 11, 14, 30]))) for i in range(40)]
    items += [(None, text(12)), (7, text(12)), (90, items[5][1]), (91, None), (92, ""), (93, "only"), (94, "!!")]
    docs = [None, "", "?? ..", "a", "only", "Only-ONLY", text(3000)]
    for _ in range(60):
        parts = [text(random.randrange(40))]
        for _ in range(random.randrange(3)):
            own = split(random.choice(items)[1])
            low = random.randrange(max(1, len(own) - 9))
            parts += [random.choice(["-", " ", ". \n"]).join(own[low:]).upper(), text(random.randrange(30))]
        docs.append(random.choice([" ", ", "]).join(parts))
    return docs + docs[-3:], items


@pytest.mark.parametrize("most", [1 << 18, 40])
def test_every_place(spark, case, most):
    """With one set of tables and with many."""
    compare(spark, *case, most=most)


def test_long_text_and_passages_at_its_ends(spark):
    random.seed(6)
    item = " ".join(f"w{random.randrange(99)}" for _ in range(25))
    filler = " ".join(f"v{random.randrange(9999)}" for _ in range(200_000))
    compare(spark, [f"{item} {filler} {item}", filler, item[:40]], [(1, item)])


def test_a_passage_does_not_reach_into_the_next_text(spark):
    item = "one two three four five six seven eight nine ten"
    compare(spark, [item[:20], item[20:], item, "ten", ""], [(1, item)])


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([("x", "one two")], "n_words STRING, text STRING")
    bench = spark.createDataFrame([(1, "two")], "item_id BIGINT, text STRING")
    row = decontaminate.find_benchmark(docs, bench).first()
    assert (row.n_words, row.n_hit, row["items"], row.text) == (2, 1, ["1"], "one two")
    assert decontaminate.find_benchmark(docs, bench.limit(0)).first().n_hit == 0
    assert decontaminate.find_benchmark(docs.limit(0), bench).collect() == []


def test_one_word_test_strings_and_shared_slots():
    data = b"a b c a aa b c a"
    words = Words(np.frombuffer(data, np.uint8), np.array([0, 5, len(data)]))
    assert [words[i] for i in range(len(words))] == [b"a", b"b", b"c", b"a", b"aa", b"b", b"c", b"a"]
    found = sorted((m, int(p), int(n)) for m, begin, number in Patterns([b"a", b"b", b"c a"]).search(words) for p, n in zip(begin, number))
    assert found == [(1, 0, 0), (1, 1, 1), (1, 3, 0), (1, 5, 1), (1, 7, 0), (2, 6, 2)]


def test_impossible_places_are_skipped():
    """Most words are never looked at: a block that no string has is passed over at once."""
    strings = [" ".join(f"b{i}x{j}" for j in range(10)).encode() for i in range(500)]
    data = " ".join(f"w{i % 977}" for i in range(100_000)).encode()
    words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    (tables,) = (patterns := Patterns(strings)).lengths
    looked = 0
    blocks = tables.blocks

    def counted(hashes, ends):
        nonlocal looked
        looked += len(ends)
        return blocks(hashes, ends)

    tables.blocks = counted
    tables.candidates(words.hashes(patterns.seed), words.first)
    assert looked < 0.25 * len(words)
