"""Quality rules as weak supervision: rules vote or abstain, no single rule decides.

Expectation-maximisation estimates how each rule votes on good and on bad
documents, and the share of good ones, from the votes alone. A document is kept if the
posterior probability that it is good reaches one half. The votes of all
documents are counted by pattern, of which there are at most ``3 ** rules``,
whatever the number of documents; that table is what the estimation reads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import store
from .common import SPACE_RUN, SPACES, let

WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was as with be by on not he this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no"
    " der die und den das von ist des mit sich auf für nicht ein eine als auch es werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei"
    " le la les et des du un une que est pour dans qui au par pas sur plus ce ne se sont avec il mais ou aux son cette elle ont ses été être nous comme leur"
    " el los las y del una por con para su al lo más o pero sus como este ha sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos"
).split()


def features(text: Column) -> list[tuple[str, Column]]:
    """Columns to make one after the other; a later one may use those before it.

    Null text counts as empty. Words are runs of anything but ASCII white space.
    """
    c = F.col
    trimmed = F.btrim(c("_text"), F.lit(SPACES))
    lines = F.filter(F.split(c("_text"), "\n", -1), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    letters = r"[\p{Lu}]"
    count = lambda pattern: F.regexp_count(c("_text"), F.lit(pattern)).cast("bigint")
    stop = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))])
    return [
        ("_text", F.coalesce(text, F.lit(""))),
        ("_words", F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN, -1)).otherwise(F.array().cast("array<string>"))),
        ("n_words", F.size("_words").cast("bigint")),
        ("word_chars", F.length(F.array_join("_words", "")).cast("bigint")),
        ("n_symbols", count(r"[#*$%&|<>]")),
        ("n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")),
        ("n_repeat_words", repeat_words(c("_words"))),
        ("n_upper", count(letters)),
        ("n_shouts", count(r"!!|\?\?|\.\.\.|…")),
        ("n_stop_kinds", F.size(F.array_intersect(F.array_distinct("_words"), stop)).cast("bigint")),
    ]


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of ``window`` words that occurs at least twice."""
    starts = F.sequence(F.lit(1), F.size(words) - (window - 1))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return let(placed, count_covered)

    def count_covered(placed: Column) -> Column:
        twice = F.filter(
            placed,
            lambda x, i: F.coalesce(F.get(placed, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(placed, i + 1)["h"] == x["h"], F.lit(False)),
        )
        places = F.sort_array(F.transform(twice, lambda x: x["at"]))
        # Up to the next such run, and no further than the run is long.
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda at, i: F.least(F.lit(window), F.get(p, i + 1) - at)),
                F.lit(0).cast("bigint"),
                lambda total, n: total + n,
            ),
        )

    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, window)))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))
    return F.when(F.size(words) <= window, F.lit(0).cast("bigint")).otherwise(found)


@dataclass(frozen=True)
class VoteRule:
    """Votes bad (-1) where ``bad`` holds, else good (1) where ``good`` holds, else abstains (0)."""

    name: str
    bad: Column | None = None
    good: Column | None = None

    def vote(self) -> Column:
        never = F.lit(False)
        bad, good = (F.coalesce(c, never) if c is not None else never for c in (self.bad, self.good))
        return F.when(bad, -1).when(good, 1).otherwise(0)


def default_rules() -> list[VoteRule]:
    """Seven rules each know one defect and abstain on the rest; ``plain`` knows the opposite."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    letters = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    symbols, shouts, lines = F.col("n_symbols") / words, F.col("n_shouts") / words, F.col("n_dup_lines") / words
    capitals, repeats, length = F.col("n_upper") / letters, F.col("n_repeat_words") / words, letters / words
    return [
        VoteRule("symbols", symbols >= 0.1),
        VoteRule("shouts", shouts >= 0.1),
        VoteRule("capitals", capitals >= 0.3),
        VoteRule("repeats", repeats >= 0.25),
        VoteRule("lines", (lines >= 0.05) & (F.col("n_dup_lines") >= 3)),
        VoteRule("word_length", (length <= 2.5) | (length >= 14)),
        VoteRule("stop_words", (F.col("n_words") >= 40) & (F.col("n_stop_kinds") <= 1), F.col("n_stop_kinds") >= 5),
        VoteRule("plain", None, (symbols <= 0.03) & (shouts <= 0.03) & (capitals <= 0.12) & (repeats <= 0.25)),
    ]


def _code(rules: Sequence[VoteRule]) -> Column:
    """The votes as one number in base 3."""
    code = F.lit(0).cast("bigint")
    for rule in rules:
        code = code * 3 + (rule.vote() + 1)
    return code


def _votes(code: int, n: int) -> list[int]:
    return [code // 3 ** (n - 1 - i) % 3 - 1 for i in range(n)]


@dataclass(frozen=True)
class VoteModel:
    """``prior``: share of good documents. ``good[rule][vote + 1]``, ``bad[rule][vote + 1]``:
    how often a rule votes so on good and on bad documents, abstentions included."""

    prior: float
    good: list[list[float]]
    bad: list[list[float]]

    def weight(self, rule: int, vote: int) -> float:
        return log(self.good[rule][vote + 1] / self.bad[rule][vote + 1])

    def log_odds(self, votes: Sequence[int]) -> float:
        return log(self.prior / (1 - self.prior)) + sum(self.weight(i, v) for i, v in enumerate(votes))

    def posterior(self, votes: Sequence[int]) -> float:
        odds = self.log_odds(votes)
        return 1 / (1 + exp(-odds)) if odds > -700 else 0.0


def _ordered(good: list[float], bad: list[float]) -> None:
    """A bad vote is no more frequent on good documents than on bad ones, a good vote no less."""
    for vote, wrong in ((0, good[0] > bad[0]), (2, good[2] < bad[2])):
        if wrong:
            good[vote] = bad[vote] = (good[vote] + bad[vote]) / 2
    for rates in (good, bad):
        rates[1] = max(1e-6, 1 - rates[0] - rates[2])


def fit_votes(patterns: dict[int, int], n_rules: int, rounds: int = 80) -> VoteModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from rules that are somewhat right. ``_ordered`` holds throughout,
    which also fixes which of the two classes is the good one. Without documents
    the start is returned.
    """
    seen = [(_votes(code, n_rules), n) for code, n in sorted(patterns.items())]
    start_good, start_bad = [0.02, 0.48, 0.5], [0.3, 0.6, 0.1]
    model = VoteModel(0.8, [list(start_good) for _ in range(n_rules)], [list(start_bad) for _ in range(n_rules)])
    total = sum(n for _, n in seen)
    for _ in range(rounds if total else 0):
        # One vote's worth of the start keeps every rate above zero.
        good = [list(start_good) for _ in range(n_rules)]
        bad = [list(start_bad) for _ in range(n_rules)]
        n_good = 0.0
        for votes, n in seen:
            p = model.posterior(votes)
            n_good += n * p
            for i, v in enumerate(votes):
                good[i][v + 1] += n * p
                bad[i][v + 1] += n * (1 - p)
        for side in (good, bad):
            for rates in side:
                weight = sum(rates)
                rates[:] = [r / weight for r in rates]
        for i in range(n_rules):
            _ordered(good[i], bad[i])
        model = VoteModel(min(0.99, max(0.3, n_good / total)), good, bad)
    return model


def rate_documents(
    docs: DataFrame, keep: Sequence[str] | None = None, rules: Sequence[VoteRule] | None = None
) -> tuple[DataFrame, VoteModel]:
    """``docs`` with its features, ``base_failed``, ``posterior`` and ``kept``; and the model.

    ``base_failed`` is fewer than 20 words, or more than 30 % of the words in
    repeated windows of eight words. ``kept`` is false for those, and else true
    where the posterior is at least one half. ``keep`` names the columns of
    ``docs`` to return, all unless given; features of the same name replace
    them. Null and empty texts have no words and so fail. Repeated rows are rated
    each. An empty table stays so. Features are computed once and stored.
    """
    rules = list(default_rules() if rules is None else rules)
    made = features(F.col("doc.text"))
    names = [name for name, _ in made if not name.startswith("_")]
    own = (*names, "base_failed", "posterior", "kept")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in own]
    # The text is needed for the features even where it is not returned.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, "text"])]).alias("doc"))
    for name, value in made:
        rows = rows.withColumn(name, value)
    doc = F.struct(*[F.col("doc")[c].alias(c) for c in kept]).alias("doc")
    rated = store(rows.select(doc, *names).withColumn("_code", _code(rules)), "rated")
    patterns = {r["_code"]: r["count"] for r in rated.groupBy("_code").count().collect()}
    model = fit_votes(patterns, len(rules))
    odds = F.lit(log(model.prior / (1 - model.prior)))
    for i, rule in enumerate(rules):
        weights = F.array(*[F.lit(model.weight(i, v)) for v in (-1, 0, 1)])
        odds = odds + F.get(weights, rule.vote() + 1)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = rated.withColumn("base_failed", failed).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    kept_now = (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept")
    return scored.select("doc.*", *names, "base_failed", "posterior", kept_now), model
