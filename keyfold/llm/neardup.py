"""Near-duplicates by ProbMinHash signatures, banding and verification.

Documents with equal shingle sets fall into a class by a hash of the set, so
copies are never paired. Each class has one representative with a signature cut
into bands; representatives that agree in a band share a bucket. In a bucket all
are compared with the one that has most company in all its buckets, the middle of
a group, which finds most groups with as many pairs as documents. Then, where a
bucket still holds several groups, pairs across groups are compared: in a small
bucket those whose signatures agree in enough registers; in a larger one those that
share rare shingles in what sets them apart from the hub of the group, which every
similar pair does. So a group of texts that are near its hub, but not each other,
costs in proportion to its texts. The groups of a bucket are numbered, and rows meet
by the lowest binary digit in which the numbers of their groups differ, so pairs
within a group are never formed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from ..storage import store
from .common import join_measured
from .graph import connected_components, ends_of
from .probminhash import BANDS, FEWEST, REGISTERS, Shingler, band_keys, marks, mix, signatures, weigh
from .tokencount import batches_of

# A rational threshold, so that the comparison is exact.
SIMILAR, OF = 8, 10
# Of 288 registers, by four bits each, 234 agree on average at a similarity of 0.8.
# Weights of at most 9/8 may lower 0.8 to 0.78 at worst, where fewer than the last
# agree once in ten thousand times.
AGREE = (203,)
# Bytes of text whose signatures are drawn together: what a worker's memory grows with.
SKETCH_CHARS = 1 << 20
# In buckets of at most so many classes pairs meet directly, by their registers.
FEW = 8
# What a document is known by, in the order in which one stands for its group: those
# with an id first, by id, then by a hash of the text.
NODE = ("no_id", "id", "digest")


def node_of(doc_id: Column, text: Column) -> list[Column]:
    """``NODE``: whether the id is missing, the id or a hash of the text, and another hash of the text."""
    whole = F.coalesce(text, F.lit(""))
    given = doc_id.cast("bigint")
    return [
        given.isNull().alias("no_id"),
        F.coalesce(given, F.xxhash64(whole)).alias("id"),
        F.xxhash64(F.lit(1), whole).alias("digest"),
    ]


@lru_cache(maxsize=1)
def _shingler() -> Shingler:
    return Shingler()


def _set_key(shingles: np.ndarray, salt: int) -> int:
    """The same for equal sets; the sum does not depend on order."""
    return int(mix(shingles ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) if len(shingles) else 0


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in batches_of(batch.column("text"), SKETCH_CHARS):
            yield batch.slice(start, end - start)


def sketch(docs: DataFrame) -> DataFrame:
    """``NODE`` and ``text`` to ``NODE, k1, k2, n, bands``: the key of the shingle set, its size, its bands and marks.

    ``bands`` has the marks of the registers behind the bands. A text without words
    is a set of its id's own. Sets of fewer than four have no bands.
    """
    long = LongType()
    names = ("id", "digest", "k1", "k2", "n")
    schema = StructType([StructField("no_id", BooleanType()), *[StructField(n, long) for n in names], StructField("bands", ArrayType(long))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler()
        for part in _texts(batches):
            owners = zip(part.column("id").to_pylist(), part.column("no_id").to_pylist(), strict=True)
            sets = [shingler.shingles(t) for t in part.column("text").to_pylist()]
            keys = [(_set_key(s, 1), _set_key(s, 2)) if len(s) else (own, int(none)) for (own, none), (s, _) in zip(owners, sets, strict=True)]
            large = [i for i, (s, _) in enumerate(sets) if len(s) >= FEWEST]
            bands: list[np.ndarray | None] = [None] * len(sets)
            if large:
                signed = signatures([sets[i][0] for i in large], [weigh(sets[i][1]) for i in large])
                found = np.hstack([band_keys(signed), marks(signed)])
                for i, row in zip(large, found, strict=True):
                    bands[i] = row
            columns = [[k[0] for k in keys], [k[1] for k in keys], [len(s) for s, _ in sets]]
            arrays = [*map(part.column, NODE), *[pa.array(c, pa.int64()) for c in columns], pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(*NODE, "text").mapInArrow(run, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``rep, text`` to ``rep, shingles``."""
    schema = StructType([StructField("rep", LongType()), StructField("shingles", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler()
        for part in _texts(batches):
            sets = [shingler.shingles(t)[0].view(np.int64) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.list_(pa.int64()))], names=schema.names)

    return docs.select("rep", "text").mapInArrow(run, schema)


def _comparable(a: str, b: str) -> Column:
    """Whether two sets of these sizes can be similar at all."""
    return F.least(a, b) * OF >= F.greatest(a, b) * SIMILAR


def _agree(a: str, b: str) -> Column:
    """In how many registers two rows of bands and marks agree, by the marks."""
    apart = F.lit(0)
    for i in range(BANDS, BANDS + REGISTERS // 16):
        bits = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 1))
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 2))
        apart = apart + F.bit_count(bits.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(REGISTERS) - apart


def _first_shared(a: str, b: str) -> Column:
    """The first band that two rows share, from 1."""
    bands = [F.slice(F.col(c), 1, BANDS) for c in (a, b)]
    return F.array_position(F.zip_with(*bands, lambda x, y: x == y), True)


def _sets(pairs: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, shingles``: the whole shingle sets of the classes in pairs ``a, b``."""
    ends = ends_of(pairs).withColumnRenamed("node", "rep")
    wanted = store(classes.select("rep", "node.*").join(ends, "rep"), "wanted")
    texts = join_measured(nodes, wanted, list(NODE), "inner", 64)
    return store(shingle_sets(texts).dropDuplicates(["rep"]), "sets")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` with their sets ``a_set, b_set``."""
    side = lambda name: sets.select(F.col("rep").alias(name), F.col("shingles").alias(f"{name}_set"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _similar(shared: Column | str, total: Column | str) -> Column:
    """Whether sets are similar that share so many shingles and have so many in all, each counted."""
    shared, total = (F.col(c) if isinstance(c, str) else c for c in (shared, total))
    return shared * OF >= (total - shared) * SIMILAR


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of classes whose shingle sets are similar, compared as whole sets."""
    shared = F.size(F.array_intersect("a_set", "b_set"))
    counted = _with_sets(pairs, sets).select("a", "b", shared.alias("shared"), (F.size("a_set") + F.size("b_set")).alias("total"))
    return counted.filter(_similar("shared", "total")).select("a", "b")


def _dealt(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``keys, component, ...`` of buckets with several components, by ``digit, below, bit``.

    Rows of one bucket meet, once a pair and never within a component, where they
    agree in ``digit`` and ``below`` and differ in ``bit``.
    """
    groups = store(grouped.select(*keys, "component").distinct(), "groups")
    split = groups.groupBy(*keys).agg(F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    numbered = groups.join(split, keys).withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy("component")) - 1)
    # Two numbers differ for the first time in one binary digit, below which they are alike.
    digits = F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("groups") - 1)) - 1)).alias("digit")
    dealt = grouped.join(numbered, [*keys, "component"]).select(*grouped.columns, "number", digits)
    return dealt.withColumn("below", F.expr("number & (shiftleft(1, digit) - 1)")).withColumn("bit", F.expr("shiftright(number, digit) & 1"))


def _sorted_pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))


def _pairs_across(crowded: DataFrame, found: DataFrame, signed: DataFrame, least: int) -> DataFrame:
    """``a, b``: the pairs in one bucket but in two components that agree in enough registers."""
    grouped = crowded.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    grouped = store(grouped.select("bucket", "band", "rep", "n", F.coalesce("component", "rep").alias("component")), "grouped")
    apart = store(_dealt(grouped, ["bucket"]).join(signed.select("rep", "bands"), "rep"), "apart")
    meet = ["bucket", "digit", "below"]
    one = apart.filter("bit = 0").select(*meet, "band", *[F.col(c).alias(f"a_{c}") for c in ("rep", "n", "bands")])
    two = apart.filter("bit = 1").select(*meet, *[F.col(c).alias(f"b_{c}") for c in ("rep", "n", "bands")])
    across = (
        _comparable("a_n", "b_n")
        & (_agree("a_bands", "b_bands") >= least)
        # A pair that meets in several buckets counts in one.
        & (_first_shared("a_bands", "b_bands") == F.col("band"))
    )
    return _sorted_pairs(one.join(two, meet).filter(across)).distinct()


def _around(crowded: DataFrame, middle: DataFrame, company: DataFrame, found: DataFrame) -> DataFrame:
    """``a, b, component, foreign``: each class ``a`` of the buckets with the hub ``b`` it is described by.

    The hub is the class of most company in the component of a bucket's middle, so
    the many buckets of one group share it. ``foreign`` tells that ``a`` is of another component.
    """
    component = found.withColumnRenamed("node", "rep")
    of = lambda rep, name: F.coalesce(F.col("component"), F.col(rep)).alias(name)
    ranked = company.join(component, "rep", "left").select("rep", "company", of("rep", "own"))
    first = F.max(F.struct(F.col("company"), (-F.col("rep")).alias("minus"), "rep")).alias("h")
    hubs = store(ranked.groupBy("own").agg(first).select("own", F.col("h.rep").alias("b")), "hubs")
    centers = middle.select("bucket", F.col("m").alias("rep")).join(component, "rep", "left").select("bucket", of("rep", "own"))
    centers = join_measured(centers, hubs, "own", "inner", 64)
    members = crowded.select("bucket", "rep").join(component, "rep", "left").select("bucket", "rep", of("rep", "component"))
    described = members.join(centers, "bucket").filter("rep <> b")
    return described.select(F.col("rep").alias("a"), "b", "component", (F.col("component") != F.col("own")).alias("foreign")).distinct()


def _pairs_by_difference(around: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: the pairs across components that may be similar, among the classes described by one hub.

    A class is described by its difference from the hub, the shingles that one of
    them has and the other has not. Similar sets x and y have at most a ninth of
    their sizes' sum apart, so their differences of d(x) and d(y) shingles share at
    least (d(x) + d(y) - (n(x) + n(y)) / 9) / 2. If one of them is not similar to the hub
    this is more than zero, and if both are they are of one component. So each
    difference is sorted with the shingles that are rarest in the hub's differences
    first, and two meet by a shingle within the first ones of either, of which there are so many
    that a pair which shares none in them cannot share enough. Nothing is lost.
    """
    shared, n, hub = F.size(F.array_intersect("a_set", "b_set")), F.size("a_set"), F.size("b_set")
    apart = F.concat(F.array_except("a_set", "b_set"), F.array_except("b_set", "a_set"))
    told = _with_sets(around, sets).select(
        F.col("b").alias("hub"), F.col("a").alias("rep"), "component", "foreign", n.alias("n"), hub.alias("hub_n"),
        apart.alias("apart"), _similar(shared, n + hub).alias("near"),
    )
    told = told.withColumn("d", F.size("apart"))
    # Fewest shared shingles with any set similar to this one, and if one of both is not
    # near the hub and the other, which is not this one, neither or this one is.
    always = F.expr("greatest(1, d - n div 4)")
    one_far = F.greatest(always, F.floor((F.col("d") * 9 + F.col("hub_n") - F.col("n")) / 18) + 1)
    first = F.col("d") + 1
    told = store(told.withColumn("short", first - one_far).withColumn("long", first - always).drop("hub_n"), "around")
    meet = ["hub", "shingle"]
    each = told.select("hub", "rep", F.explode("apart").alias("shingle"))
    common = each.groupBy(*meet).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    own = Window.partitionBy("hub", "rep")
    # The shingles of one difference alone come first and meet nothing.
    kept = each.join(common, meet).withColumn("rank", F.row_number().over(own.orderBy("times", "shingle"))).withColumn("common", F.count(F.lit(1)).over(own))
    row = told.drop("apart")
    placed = kept.join(row, ["hub", "rep"]).withColumn("place", F.col("d") - F.col("common") + F.col("rank") - 1)
    placed = placed.filter(F.col("place") < F.when(F.col("near"), F.col("short")).otherwise(F.greatest("short", "long")))
    placed = store(placed.select(*meet, "rep", "component", "foreign", "near", "n", "d", "place", "short"), "placed")

    side = lambda df, name: df.select(*[F.col(c) if c in (*meet, "digit", "below") else F.col(c).alias(f"{name}_{c}") for c in df.columns])
    far = store(_dealt(placed.filter("NOT near AND place < short"), meet), "far")
    both_far = side(far.filter("bit = 0").drop("bit"), "a").join(side(far.filter("bit = 1").drop("bit"), "b"), [*meet, "digit", "below"])
    one_near = side(placed.filter("near"), "a").join(side(placed.filter("NOT near AND foreign"), "b"), meet)
    # What can be shared from the first common shingle on is enough.
    after = F.least(F.col("a_d") - F.col("a_place"), F.col("b_d") - F.col("b_place"))
    enough = after * 18 >= (F.col("a_d") + F.col("b_d")) * 9 - (F.col("a_n") + F.col("b_n"))
    pairs = [_sorted_pairs(p.filter(_comparable("a_n", "b_n") & enough)) for p in (both_far, one_near)]
    # Classes near the hub have to be of its component.
    joined = _sorted_pairs(told.filter("near AND foreign").select(F.col("rep").alias("a_rep"), F.col("hub").alias("b_rep")))
    return pairs[0].unionByName(pairs[1]).unionByName(joined).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``NODE``, ``component_id, kept``, one row a row of ``docs``.

    Documents whose sets of five-word shingles have a Jaccard similarity of at
    least 0.8 are linked; ``component_id`` is the smallest id that links lead to,
    its own included, and ``kept`` tells whether the row stands for its group: it
    has this id, and of several texts with it the one of the smallest hash. Texts of
    fewer than five words are one shingle. Null and empty texts, and texts without
    words, link with nothing. Any BIGINT is an id. Rows alike in id and text are one
    document and agree in all columns; rows of one id but different texts are
    documents of their own, each compared by its text. A row without an id takes
    part by its text; its ``component_id`` is null if no other has an id. An empty
    table stays so.
    """
    nodes = docs.select(*node_of(F.col(doc_id), F.col(text)), F.col(text).alias("text"))
    sketched = store(sketch(nodes), "sketched")
    node = F.struct(*NODE)
    grouped = sketched.groupBy("k1", "k2", "n").agg(F.min(node).alias("node"), F.first("bands").alias("bands"))
    # A number for each class, fixed as the table is written.
    classes = store(grouped.sortWithinPartitions("k1", "k2", "n").withColumn("rep", F.monotonically_increasing_id()), "classes")
    signed = classes.filter("bands IS NOT NULL")
    buckets = signed.select("rep", "n", F.posexplode(F.slice("bands", 1, BANDS)).alias("band", "bucket"))
    buckets = store(buckets.withColumn("band", F.col("band") + 1), "buckets")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    crowded = store(buckets.join(sizes, "bucket"), "crowded")
    company = store(crowded.groupBy("rep").agg(F.sum("size").alias("company")), "company")
    most = F.max(F.struct(F.col("company"), (-F.col("rep")).alias("minus"), "rep", "n")).alias("m")
    middle = crowded.join(company, "rep").groupBy("bucket").agg(most).select("bucket", F.col("m.rep").alias("m"), F.col("m.n").alias("m_n"))
    middle = store(middle, "middle")
    star = crowded.join(middle, "bucket").filter((F.col("rep") != F.col("m")) & _comparable("n", "m_n"))
    star = store(star.select(F.least("rep", "m").alias("a"), F.greatest("rep", "m").alias("b")).distinct(), "pairs")
    links = store(_verified(star, _sets(star, nodes, classes)), "links")
    found = connected_components(links)

    # Where a bucket holds several groups beside its middle, the pairs across them.
    beside = crowded.join(middle, "bucket").filter("rep <> m").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    group = F.coalesce("component", "rep")
    split = beside.groupBy("bucket").agg(F.min(group).alias("low"), F.max(group).alias("high")).filter("low <> high").select("bucket")
    several = store(crowded.join(split, "bucket"), "several")
    few = store(_pairs_across(several.filter(F.col("size") <= FEW), found, signed, AGREE[-1]).join(star, ["a", "b"], "left_anti"), "few")
    around = store(_around(several.filter(F.col("size") > FEW), middle, company, found), "described")
    sets = _sets(few.unionByName(around.select("a", "b")), nodes, classes)
    rest = few.unionByName(_pairs_by_difference(around, sets)).distinct().join(star, ["a", "b"], "left_anti")
    rest = store(rest, "rest")
    more = store(_verified(rest, sets), "more")
    if not more.isEmpty():
        links = store(links.unionByName(more), "links")
        found = connected_components(links)

    # The first node of each component; a class without links is its own.
    linked = store(found.withColumnRenamed("node", "rep").join(classes.select("rep", "node"), "rep"), "linked")
    firsts = store(linked.groupBy("component").agg(F.min("node").alias("first")), "firsts")
    firsts = join_measured(linked.select("rep", "component"), firsts, "component").select("rep", "first")
    final = classes.select("k1", "k2", "n", "rep", "node").join(firsts, "rep", "left")
    final = final.select("k1", "k2", "n", F.coalesce("first", "node").alias("first"))
    rows = sketched.select(*NODE, "k1", "k2", "n").join(final, ["k1", "k2", "n"])
    return rows.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"),
        *NODE,
        F.when(~F.col("first.no_id"), F.col("first.id")).alias("component_id"),
        (node == F.col("first")).alias("kept"),
    )


def keep_one(docs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group, each document once.

    Of rows alike in id and text the one stays whose other columns have the smallest hash.
    """
    columns = docs.columns if columns is None else columns
    node = list(NODE)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), *node_of(F.col("doc_id"), F.col("text")))
    dropped = store(near_duplicates(docs).filter(~F.col("kept")).select(*node).distinct(), "dropped")
    left = join_measured(marked, dropped, node, "left_anti", 64)
    repeated = store(left.groupBy(*node).count().filter("count > 1").select(*node), "repeated")
    if repeated.isEmpty():
        return left.select("doc.*")
    once = join_measured(left, repeated, node, "left_anti", 64).select("doc")
    several = join_measured(left, repeated, node, "left_semi", 64)
    first = F.min_by("doc", F.xxhash64("doc"))
    return once.unionByName(several.groupBy(*node).agg(first.alias("doc")).select("doc")).select("doc.*")
