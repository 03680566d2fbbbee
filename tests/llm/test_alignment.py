"""Alignment of two tokenizers against a byte-by-byte version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from keyfold.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """The rows wanted, from sets of bytes that a token has and loops over groups."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    decoder = {v: k for k, v in enumerate(alignment._byte_symbols())}
    docs = []
    for text in texts:
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        spelled = (
            [bytes(decoder[c] for c in a.id_to_token(i)) for i in ids[0]],
            [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids[1])],
        )
        wanted = b" " + (text or "").encode()
        if not text or any(b"".join(s) != wanted for s in spelled):
            docs.append(None)
            continue
        ends = [set(np.cumsum([len(t) for t in s]).tolist()) for s in spelled]
        groups, cut = [], sorted(ends[0] & ends[1])
        at = [0, 0]
        done = [0, 0]
        for end in cut:
            group = []
            for side in (0, 1):
                mine = []
                while done[side] < end:
                    mine.append(ids[side][at[side]])
                    done[side] += len(spelled[side][at[side]])
                    at[side] += 1
                group.append(mine)
            groups.append(group)
        docs.append((ids, groups))
    held = Counter()
    for doc in docs:
        if doc:
            held.update({(x, y) for g in doc[1] for x in g[0] for y in g[1]})
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc in docs:
        if not doc:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        (ids_a, ids_b), groups = doc
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        best = sum(held[p] == highest[p[0]] for p in links)
        total = sum(held[p] for p in links)
        out.append((len(ids_a), len(ids_b), len(groups), len(links), best, total, hashlib.sha256(text.encode()).hexdigest()))
    return out


def run(spark, texts, **settings):
    rows = spark.createDataFrame(list(enumerate(texts)), "n_a INT, text STRING").withColumnRenamed("n_a", "place").repartition(3)
    found = alignment.align_tokens(rows, A, B, keep=["place"], **settings).collect()
    assert len(found) == len(texts)
    return [
        (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in sorted(found, key=lambda r: r.place)
    ]


@pytest.fixture(scope="module")
def texts():
    random.seed(4)
    odd = ["", None, " ", "  two  spaces ", "\n\n", "<|endoftext|> <s>x</s> <0x41>", "▁mark", "a\x00b", "ﬁ é é Ａ", "​　 x"]
    odd += ["日本語のテキスト、とても長い。", "สวัสดีครับผมชื่อ", "👩‍👩‍👧 flags 🇩🇪", "don't I'LL 1234567 ...", "x" * 300, "=" * 500, "é" * 400]
    alphabet = "abcde ABC  .,'12é漢ไทย👍\n\t"
    odd += ["".join(random.choice(alphabet) for _ in range(random.randrange(1, 120))) for _ in range(60)]
    common = "The quick brown fox jumps over unbelievable internationalisation of the dogs".split()
    odd += [" ".join(random.choice(common) for _ in range(random.randrange(1, 60))) for _ in range(40)]
    return odd + odd[-5:] * 3


@pytest.mark.parametrize("chunk_pairs", [1 << 22, 50])
def test_all_kinds_of_text(spark, texts, chunk_pairs):
    assert run(spark, texts, chunk_pairs=chunk_pairs) == brute(texts)


def test_given_documents(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert run(spark, texts) == brute(texts)


def test_long_texts_are_cut_where_both_break(spark):
    random.seed(9)
    words = ["alpha", "beta's", "x1", "naïve", "don't", "漢字", "It", "  ", "\n", "."]
    long = " ".join(random.choice(words) for _ in range(60_000))
    pair = alignment._pair(A, B)
    assert pair.breaks and len(pair.cells(long)) > 3
    assert " ".join(pair.cells(long)) == long
    assert run(spark, [long, "y" * 200_000]) == brute([long, "y" * 200_000])


def test_wide_groups_are_counted_by_different_ids(monkeypatch, texts):
    pair = alignment._pair(A, B)
    texts = [t for t in texts if t]
    frames = pair.encode(texts)
    wanted = alignment.Aligned(*frames, len(texts), 32000).pairs()
    monkeypatch.setattr(alignment, "WIDE", 1)
    found = alignment.Aligned(*frames, len(texts), 32000).pairs()
    assert all((x == y).all() for x, y in zip(wanted, found, strict=True))


def test_packing():
    for places, times in (([], []), ([0], [1]), ([3, 9, 70000], [255, 256, 1 << 40])):
        got = alignment.unpack(alignment.pack(np.array(places, np.int64), np.array(times, np.int64)))
        assert [x.tolist() for x in got] == [places, times]


def test_empty_table_and_clashing_columns(spark):
    rows = spark.createDataFrame([("a b", "x", "y")], "text STRING, n_best STRING, other STRING")
    found = alignment.align_tokens(rows, A, B)
    assert found.columns == ["text", "other", *alignment.MADE]
    assert found.first().other == "y" and found.first().n_best >= 2
    assert alignment.align_tokens(rows.limit(0), A, B).collect() == []
