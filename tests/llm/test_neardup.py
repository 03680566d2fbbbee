"""Near-duplicates against all pairs, signatures against exact similarities."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from keyfold.llm import neardup
from keyfold.llm.graph import connected_components
from keyfold.llm.probminhash import Shingler, band_keys, marks, mix, signatures, weigh


def brute(rows):
    """Component of each row number, by the smallest row number, from all similar pairs."""
    shingler = Shingler()
    sets = [frozenset(shingler.shingles(t)[0].tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in where[s])
        for j, n in shared.items():
            if n * 10 >= 8 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in own:
            where[s].append(i)
    return [find(i) for i in range(len(rows))]


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id BIGINT, text STRING, kept STRING")
    found = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for (doc_id, _), c in zip(rows, brute(rows), strict=True):
        groups[c].append(doc_id)
    assert any(len(g) > 1 for g in groups.values())
    for group in groups.values():
        for doc_id in group:
            assert found[doc_id].component_id == min(group)
            assert found[doc_id].kept == (doc_id == min(group))


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_copies_and_near_copies(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 300))]
        rows += [(len(rows) + k, varied(rng, base, e)) for k, e in enumerate([0, 0, 1, 2, 4, len(base) // 12])]
    # Many near copies of one text, of which most are only near the text itself.
    base = [f"h{i}" for i in range(260)]
    rows += [(len(rows) + k, varied(rng, base, 5)) for k in range(120)]
    rng.shuffle(rows)
    check(spark, rows)


def test_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " .,! "), (4, "one"), (5, "ONE."), (6, "a b c d"), (7, "a b c e"),
        (8, "a a a a a a a"), (9, "a a a a a a a a a"), (10, long), (11, long + " end"), (12, "d c b a"), (13, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10, 12: 12, 13: 13}


def test_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(None, text), (5, text + " more"), (None, "alone in the world"), (None, "alone in the world"), (9, "x y z"), (9, "x y z"), (9, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=repr)
    assert found == sorted([(None, 5, False), (5, 5, True), *[(None, None, True)] * 2, *[(9, 9, True)] * 3], key=repr)
    # Of each group, and of each document, one row stays.
    left = neardup.keep_one(docs)
    assert left.columns == ["doc_id", "text"]
    assert sorted(r.text for r in left.collect()) == sorted([text + " more", "alone in the world", "x y z"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert neardup.near_duplicates(docs).count() == 0
    assert neardup.keep_one(docs).count() == 0


def test_registers_agree_with_the_probability_jaccard():
    rng = np.random.default_rng(0)
    a, b = np.arange(400, dtype=np.uint64) + 7, np.arange(100, 520, dtype=np.uint64) + 7
    weights = {int(x): float(w) for x, w in zip(np.union1d(a, b), rng.uniform(1, 4, 600), strict=False)}
    wa, wb = np.array([weights[int(x)] for x in a]), np.array([weights[int(x)] * (1 + (int(x) % 3 == 0)) for x in b])
    va, vb = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
    exact = sum(1 / sum(max(va.get(o, 0) / va[d], vb.get(o, 0) / vb[d]) for o in {*va, *vb}) for d in va.keys() & vb.keys())
    sa, sb = signatures([a, b], [wa, wb], registers=4096)
    assert (sa == sb).mean() == pytest.approx(exact, abs=4 * (exact * (1 - exact) / 4096) ** 0.5)


def test_signatures_do_not_depend_on_company():
    sets = [np.unique(np.random.default_rng(i).integers(0, 2**63, n).astype(np.uint64)) for i, n in enumerate([4, 900, 30])]
    ones = [np.ones(len(s)) for s in sets]
    together = signatures(sets, ones)
    for i in range(3):
        assert (signatures([sets[i]], [ones[i]])[0] == together[i]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(50)] + [(300, 300), (7, 6), (6, 7)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {200: 100, 300: 300}
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_marks_agree_where_registers_do(spark):
    sets = [np.arange(0, 300, dtype=np.uint64), np.arange(20, 310, dtype=np.uint64), np.arange(900, 1200, dtype=np.uint64)]
    signed = signatures(sets, [np.ones(len(s)) for s in sets])
    rows = np.hstack([band_keys(signed), marks(signed)])
    df = spark.createDataFrame([(i, j, rows[i].tolist(), rows[j].tolist()) for i in range(3) for j in range(3)], "i INT, j INT, a ARRAY<BIGINT>, b ARRAY<BIGINT>")
    four = mix(signed) & np.uint64(15)
    for r in df.select("i", "j", neardup._agree("a", "b").alias("n"), neardup._first_shared("a", "b").alias("band")).collect():
        assert r.n == (four[r.i] == four[r.j]).sum()
        same = np.flatnonzero(rows[r.i][:24] == rows[r.j][:24])
        assert r.band == (same[0] + 1 if len(same) else 0)


def test_repeated_passages_do_not_hide_a_pair(spark):
    """Sets are alike however often one text repeats a passage."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = [f"r{i}x{k}" for k in range(250)]
        part = words[100:150]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:100] + part * 100 + words[150:]))]
    rng.shuffle(rows)
    check(spark, rows)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    sketched = {r.id: r.bands for r in neardup.sketch(docs.select(*neardup.node_of(docs.doc_id, docs.text), "text")).collect()}
    shared = [np.array(sketched[2 * i])[: neardup.BANDS] == np.array(sketched[2 * i + 1])[: neardup.BANDS] for i in range(60)]
    assert min(s.sum() for s in shared) >= 12


def test_ids_of_all_sizes_and_one_id_with_different_texts(spark):
    """Every BIGINT is an id, and each text of a repeated id is compared."""
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "pq")
    big, low = (1 << 62) + 5, -(1 << 63)
    rows = [(big, one), ((1 << 63) - 1, one + " more"), (low, two), (7, one + " again"), (7, two + " again"), (7, "neither"), (7, None), (None, two)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    seen = []
    for parts in (1, 5):
        dealt = docs.repartition(parts)
        found = Counter((r.doc_id, r.component_id) for r in neardup.near_duplicates(dealt).collect())
        assert found == Counter([(big, 7), ((1 << 63) - 1, 7), (low, low), (7, 7), (7, low), (7, 7), (7, 7), (None, low)])
        seen.append(sorted(repr((r.doc_id, r.text)) for r in neardup.keep_one(dealt).collect()))
    assert seen[0] == seen[1] == sorted(map(repr, [(7, one + " again"), (low, two), (7, "neither"), (7, None)]))


def test_of_rows_alike_in_id_and_text_one_stays_whatever_the_order(spark):
    docs = spark.createDataFrame([(3, "a b c", "x"), (3, "a b c", "y"), (3, "a b c", "z")], "doc_id BIGINT, text STRING, source STRING")
    assert len({neardup.keep_one(docs.repartition(n)).first().source for n in (1, 3)}) == 1


def test_weighted_pairs_at_the_threshold_share_bands_and_registers():
    """The worst case: what is shared is short words, what differs long ones."""
    rng = np.random.default_rng(3)
    lost, gated, trials = 0, 0, 400
    for _ in range(trials):
        shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (160, 20, 20))
        sets = [np.concatenate([shared, own]) for own in (a, b)]
        signed = signatures(sets, [weigh(np.repeat([0, 5], [160, 20]))] * 2)
        bands = band_keys(signed)
        lost += not (bands[0] == bands[1]).any()
        four = mix(signed) & np.uint64(15)
        gated += (four[0] == four[1]).sum() < neardup.AGREE[-1]
    assert lost <= 5 and gated <= 2


def test_no_pairs_within_a_group_are_formed(spark):
    """Rows of one component do not meet, and each pair across components meets once."""
    rows = [(0, 1, rep, 50, 0 if rep < 40 else rep) for rep in range(43)]
    crowded = spark.createDataFrame([r[:4] for r in rows], "bucket BIGINT, band INT, rep BIGINT, n BIGINT")
    found = spark.createDataFrame([(rep, 0) for rep in range(40)], "node BIGINT, component BIGINT")
    signed = spark.createDataFrame([(rep, [7] * 42) for rep in range(43)], "rep BIGINT, bands ARRAY<BIGINT>")
    pairs = [(r.a, r.b) for r in neardup._pairs_across(crowded, found, signed, 0).collect()]
    assert sorted(pairs) == sorted((a, b) for a in range(43) for b in range(40, 43) if a < b)


def test_texts_near_the_middle_but_not_each_other_cost_in_proportion(spark, monkeypatch):
    """Most texts of the group differ from its middle by too much, and in pairs by still more."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, varied(rng, base, rng.randint(1, 10))) for i in range(500)]
    # Two that are near each other, far from the middle.
    far = varied(rng, base, 8).split()
    rows += [(600 + k, varied(rng, far, 1)) for k in range(2)]
    compared, verified = [], neardup._verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(neardup, "_verified", counted)
    check(spark, rows)
    assert 0 < sum(compared) <= 4 * len(rows)


@pytest.mark.parametrize("alphabet", [10**9, 3])
def test_pairs_by_difference_are_all_similar_pairs(spark, alphabet):
    """Whatever is removed, added or common to many, and however far the hub is."""
    rng = random.Random(alphabet)
    base = list(range(60))
    sets = {0: set(base)}
    for rep in range(1, 160):
        # Some start from a text that is itself not near the hub.
        own = set(base) if rep % 3 else set(base[9:]) | {100 + i for i in range(9)}
        own -= set(rng.sample(base, rng.randint(0, 9)))
        sets[rep] = own | {1000 + 100 * rng.randrange(40) + rng.randrange(alphabet) for _ in range(rng.randint(0, 9))}
    similar = lambda a, b: len(sets[a] & sets[b]) * 10 >= 8 * len(sets[a] | sets[b])
    # Every class but those near the hub is a component of its own, or one of a few.
    for component in (lambda r: r, lambda r: 1 + r % 4):
        of = {r: 0 if not r or (similar(r, 0) and r % 2) else component(r) for r in sets}
        around = spark.createDataFrame([(r, 0, of[r], of[r] != 0) for r in sets if r], "a BIGINT, b BIGINT, component BIGINT, foreign BOOLEAN")
        made = spark.createDataFrame([(r, sorted(s)) for r, s in sets.items()], "rep BIGINT, shingles ARRAY<BIGINT>")
        found = {(r.a, r.b) for r in neardup._pairs_by_difference(around, made).collect()}
        near = {r for r in sets if similar(r, 0)}
        wanted = {(a, b) for a in sets for b in sets if a < b and of[a] != of[b] and similar(a, b) and not {a, b} <= near - {0}}
        assert wanted and wanted <= found
        assert len({p for p in wanted if p[0]}) > 20
