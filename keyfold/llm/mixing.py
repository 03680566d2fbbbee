"""Mixing sources to target weights by Pareto order sampling.

Targets, in words, share the size of all documents among the sources by weight;
no target exceeds ``most`` times its source. Within a source, the copies that a
document is expected to get follow its grade, up to ``most``: the whole part is
certain, the rest is an inclusion probability. Documents are ranked by random
odds over inclusion odds, and the sample is the beginning of that ranking whose
words come nearest to what the target leaves after the certain copies.

A hot source is never ranked as a whole: the sizes are summed by bucket of the
ranking variable, and only the bucket in which the sample ends is ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..storage import store
from .common import count_words, join_measured

BUCKETS = 4096
# Grades by size in words. A longer document is worth more copies.
GRADES = ((50, 1), (500, 2), (None, 3))


def grade_of(size: Column) -> Column:
    grade = F.lit(GRADES[-1][1])
    for below, value in reversed(GRADES[:-1]):
        grade = F.when(size < below, value).otherwise(grade)
    return grade


def mark_of(doc_id: Column, text: Column) -> Column:
    """What tells a document from others: its id, or its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))


def uniform(mark: Column, size: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", mark, size.cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` a source.

    Sources in the order of their code points, null last, take the weights in
    turn. What a target would have above ``most`` times its source's size goes to
    the others by weight, until none is above.
    """
    numbered, n = number_rows(sizes, F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod("row_no", F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * most
    sources = store(numbered.select("source", "source_size", weight.alias("weight"), cap.alias("cap")), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, n_capped = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("cap")
        got = sources.agg(
            F.count_if(capped),
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
        ).first()
        if got[0] == n_capped or not got[2]:
            break
        n_capped, level = got[0], float(total - got[1]) / float(got[2])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level or 0.0))
    return store(sources.select("source", "source_size", target.alias("target")), "targets")


def _shares(graded: GroupedData, most: int) -> DataFrame:
    """``rate``: a document of grade g is expected ``least(most, rate * g)`` times."""
    values = [value for _, value in GRADES]
    sums = graded.agg(*[F.coalesce(F.sum(F.when(F.col("grade") == v, F.col("words"))), F.lit(0)).alias(f"s{v}") for v in values])
    rate = F.lit(float(most))
    # With the top grades at ``most``, the rest share what is left.
    for capped in range(len(values) - 1, -1, -1):
        rest, full = values[: len(values) - capped], values[len(values) - capped :]
        left = F.col("target") - sum((F.col(f"s{v}") * most for v in full), F.lit(0))
        sizes = sum((F.col(f"s{v}") * v for v in rest), F.lit(0))
        own = left / F.when(sizes > 0, sizes.cast("double"))
        rate = F.when(own * rest[-1] <= most, own).otherwise(rate)
    return sums.withColumn("rate", rate)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: int = 7,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``.

    ``docs`` has ``doc_id``, ``text`` and ``source``; ``keep`` names the columns
    to return, all unless given. ``copies`` is how often the mix takes the
    document: 0 to ``most``. Null text and text without words have size 0 and no
    copies. Null sources are one source. A document without an id goes by its text.
    Rows alike in id (or text), size and source are taken alike, so reruns agree
    however rows are dealt out; a source may miss its target by half of what such
    rows add up to. Columns of the four names are replaced. An empty table stays so.
    """
    made = ("size", "source_size", "target", "copies")
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c not in made]
    size = count_words(F.col("text"))
    sized = store(
        docs.select(
            F.struct(*kept).alias("doc"),
            F.col("doc_id").alias("id"),
            mark_of(F.col("doc_id"), F.col("text")).alias("mark"),
            F.col("source").alias("source"),
            size.alias("size"),
        ),
        "sized",
    ).withColumn("grade", grade_of(F.col("size")))
    by_grade = store(sized.groupBy("source", "grade").agg(F.sum("size").alias("words")), "grades")
    sizes = by_grade.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    graded = targets.alias("t").join(by_grade.alias("g"), F.col("t.source").eqNullSafe(F.col("g.source")))
    graded = graded.select("t.*", "grade", "words").groupBy("source", "source_size", "target")
    shares = store(_shares(graded, most), "shares")
    expected = F.least(F.lit(float(most)), F.col("rate") * F.col("grade"))
    rated = (
        join_measured(sized.alias("d"), shares.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.*", "source_size", "target", "rate")
        .withColumn("whole", F.floor(expected).cast("int"))
        .withColumn("chance", expected - F.col("whole"))
        .withColumn("u", uniform(F.col("mark"), F.col("size"), seed))
        # Random odds over inclusion odds, q, as q / (1 + q).
        .withColumn("out", F.col("u") * (1 - F.col("chance")))
        .withColumn("rank", F.col("out") / (F.col("out") + (1 - F.col("u")) * F.col("chance")))
    )
    drawn = rated.filter((F.col("chance") > 0) & (F.col("size") > 0))
    bucket = F.floor(F.col("rank") * BUCKETS).cast("int")
    # The certain copies and the residual, from sums over all rows.
    certain = rated.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("certain"))
    sums = drawn.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket")
    ends = store(
        sums.alias("b")
        .join(certain.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")))
        .select("b.source", "bucket", "words", (F.col("target") - F.col("certain")).alias("residual"))
        .withColumn("upto", F.sum("words").over(upto))
        # Rounding must not put the end beyond the last bucket.
        .withColumn("residual", F.least("residual", F.sum("words").over(Window.partitionBy("source"))))
        .filter((F.col("upto") >= F.col("residual")) & (F.col("upto") - F.col("words") < F.col("residual")))
        .select("source", "bucket", "residual", (F.col("upto") - F.col("words")).alias("before")),
        "ends",
    )
    last = (
        join_measured(
            drawn.withColumn("bucket", bucket).alias("d"),
            ends.alias("e"),
            F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.bucket") == F.col("e.bucket")),
        )
        .select("d.source", "rank", "id", "size", "residual", "before")
        .groupBy("source", "rank", "id", "size", "residual", "before")
        .agg((F.count(F.lit(1)) * F.col("size")).alias("words"))
    )
    in_order = Window.partitionBy("source").orderBy("rank", "id", "size")
    cut = (
        last.withColumn("upto", F.col("before") + F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        # The row that passes the residual is in if that comes nearer.
        .filter(F.col("upto") - F.col("words") < F.col("residual"))
        .filter(F.col("upto") - F.col("residual") <= F.col("residual") - (F.col("upto") - F.col("words")))
        .groupBy("source")
        .agg(F.max(F.struct("rank", F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "size")).alias("cut"))
    )
    # No row of the last bucket may be in; then the sample ends before it.
    cuts = store(
        ends.alias("e").join(cut.alias("c"), F.col("e.source").eqNullSafe(F.col("c.source")), "left").select("e.source", "bucket", "cut"),
        "cuts",
    )
    key = F.struct("rank", F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "size")
    sampled = (
        F.when((F.col("chance") <= 0) | (F.col("size") == 0) | F.col("e.bucket").isNull(), F.lit(False))
        .when(bucket < F.col("e.bucket"), F.lit(True))
        .when(bucket > F.col("e.bucket"), F.lit(False))
        .otherwise(F.coalesce(key <= F.col("cut"), F.lit(False)))
    )
    copies = F.when(F.col("size") > 0, F.col("whole") + sampled.cast("int")).otherwise(0)
    return join_measured(rated.alias("d"), cuts.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")), "left").select(
        "doc.*", "size", "source_size", "target", copies.alias("copies")
    )


def take_copies(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each row as often as its ``copies`` say."""
    times = F.array_repeat(F.lit(0), F.col("copies"))
    return mixed.select(*[F.col(f"`{c}`") for c in columns], F.explode(times).alias("_copy")).drop("_copy")
