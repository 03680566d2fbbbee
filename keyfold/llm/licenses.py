"""License scans: signature rules over words, gated by keywords, with suppression.

Texts become words of one space before and one after each, so that a pattern of
words needs no look-around. Rules are the product of license names and the
phrases around them. A rule's pattern is only tried on texts that have its
keyword, and no rule on texts without any of the few gate words. Of detections
that overlap, one is dropped if it lies within another of at least its priority.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that always count, with their label.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, keyword, pattern of the name, short identifier.
NAMES = (
    ("mit", "mit", "mit(?: x11)? license", "mit"),
    ("mit-0", "attribution", "mit no attribution(?: license)?", "mit 0"),
    ("isc", "isc", "isc license", "isc"),
    ("apache-2", "apache", "apache(?: software)? license(?: version)? 2(?: 0)?", "apache 2 0"),
    ("apache-1", "apache", "apache(?: software)? license(?: version)? 1(?: [01])?", "apache 1 [01]"),
    ("apache", "apache", "apache(?: software)? license", "apache"),
    ("bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)(?: license)?", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?", "bsd 4 clause"),
    ("bsd-0", "bsd", "(?:zero clause bsd|bsd zero clause|0bsd)(?: license)?", "0bsd"),
    ("bsd", "bsd", "bsd(?: style)? license", "bsd"),
    ("gpl-1", "general", "gnu general public license version 1", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "general", "gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) ?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "general", "gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) ?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl", "general", "(?:gnu )?general public license", "gpl"),
    ("gpl-2", "gpl", "(?:gnu )?(?:gplv2|gpl v2|gpl version 2)", "gplv2"),
    ("gpl-3", "gpl", "(?:gnu )?(?:gplv3|gpl v3|gpl version 3)", "gplv3"),
    ("gpl", "gpl", "gnu gpl", "gpl"),
    ("lgpl-2", "general", "gnu (?:lesser|library) general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) ?2(?: [01])?", "lgpl 2 [01](?: only| or later)?"),
    ("lgpl-3", "lesser", "gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) ?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", "general", "(?:gnu )?(?:lesser|library) general public license", "lgpl"),
    ("lgpl", "lgpl", "gnu lgpl", "lgpl"),
    ("agpl-3", "affero", "gnu affero general public license(?: version| v) ?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl", "affero", "(?:gnu )?affero general public license", "agpl"),
    ("fdl", "documentation", "gnu free documentation license(?: version 1(?: [0-3])?)?", "gfdl 1 [123](?: only| or later)?"),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    ("mpl-1", "mozilla", "mozilla public license(?: version| v)? ?1(?: [01])?", "mpl 1 [01]"),
    ("mpl", "mozilla", "mozilla public license", "mpl"),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?", "epl 2 0"),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?", "epl 1 0"),
    ("cddl", "distribution", "common development and distribution license(?: version)?(?: 1(?: [01])?)?", "cddl 1 [01]"),
    ("cddl", "cddl", "cddl(?: version)?(?: 1(?: [01])?)?", "cddl"),
    ("cpl", "common", "common public license(?: version)?(?: 1(?: 0)?)?", "cpl 1 0"),
    ("eupl", "european", "european union public licen[cs]e(?: version)?(?: 1(?: [012])?)?", "eupl 1 [012]"),
    ("artistic-2", "artistic", "artistic license(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "artistic license", "artistic 1 0"),
    ("bsl-1", "boost", "boost software license(?: version)?(?: 1(?: 0)?)?", "bsl 1 0"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib"),
    ("psf-2", "python", "python software foundation license(?: version)?(?: 2)?", "psf 2 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1", "font", "(?:sil )?open font license(?: version)?(?: 1(?: [01])?)?", "ofl 1 [01]"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [0-9])?", "cc by nc nd [1-4] [0-9]"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [0-9])?", "cc by nc sa [1-4] [0-9]"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [0-9])?", "cc by nc [1-4] [0-9]"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [0-9])?", "cc by nd [1-4] [0-9]"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [0-9])?", "cc by sa [1-4] [0-9]"),
    ("cc-by", "cc", "cc by(?: [1-4] [0-9])?", "cc by [1-4] [0-9]"),
    ("cc-by-nc-nd", "noncommercial", "creative commons attribution noncommercial no ?derivatives(?: [1-4] [0-9])?", "cc by nc nd"),
    ("cc-by-nc-sa", "noncommercial", "creative commons attribution noncommercial share ?alike(?: [1-4] [0-9])?", "cc by nc sa"),
    ("cc-by-nc", "noncommercial", "creative commons attribution noncommercial(?: [1-4] [0-9])?", "cc by nc"),
    ("cc-by-sa", "attribution", "creative commons attribution share ?alike(?: [1-4] [0-9])?", "cc by sa"),
    ("cc-by-nd", "attribution", "creative commons attribution no ?derivatives(?: [1-4] [0-9])?", "cc by nd"),
    ("cc-by", "attribution", "creative commons attribution(?: [1-4] [0-9])?", "cc by"),
    ("odbl", "database", "open (?:data commons open )?database licen[cs]e", "odbl 1 0"),
    ("public-domain", "domain", "(?:dedicated to|released into|placed in|in) the public domain", "public domain"),
)
# Name of the frame, priority, confidence, pattern with {name} and {id}.
FRAMES = (
    ("identifier", 3, 1.0, "spdx license identifier {id}"),
    ("grant", 3, 0.95, "(?:licensed|released|distributed|available|published|provided|redistributed|shared)(?: to you)? under (?:an? |the )?(?:terms of )?(?:an? |the )?{name}(?: license)?"),
    ("terms", 2, 0.9, "(?:subject to|governed by|covered by|under|accept) (?:the )?(?:terms|conditions|terms and conditions) of (?:the )?{name}"),
    ("notice", 2, 0.8, "(?:a copy of|see|read|full text of) (?:the )?{name}"),
    ("field", 2, 0.8, "(?:license|licence|copying) (?:is )?(?:the )?{name}"),
    ("name", 1, 0.6, "{name}"),
)
# Every pattern has one of these, so texts without any are not looked at.
GATES = ("licen", " cc ", " cc0 ", "gpl", " bsd ", " 0bsd ", " freebsd ", "creative  commons", "wtfpl", "public  domain", " cddl ", "attribution")


@dataclass(frozen=True)
class LicenseRule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


def _spaced(pattern: str) -> str:
    """The pattern for words that have a space before and one after."""
    return f" {pattern} ".replace(" ?", "\0").replace(" ", "  ")[1:-1].replace("\0", "(?:  )?")


def default_rules() -> list[LicenseRule]:
    rules = {}
    for label, keyword, name, short in NAMES:
        for frame, priority, confidence, pattern in FRAMES:
            gate = "spdx" if frame == "identifier" else keyword
            text = _spaced(pattern.replace("{name}", name).replace("{id}", short))
            rules.setdefault((label, text), LicenseRule(label, gate, text, priority, confidence))
    return list(rules.values())


def spaced_words(text: Column) -> Column:
    """The words of the text, each with a space before and after; one space if there is none."""
    words = F.btrim(F.regexp_replace(ascii_lower(text), NO_WORD, "  "), F.lit(" "))
    return F.when(words == "", " ").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


SPANS = "array<struct<start:bigint,minus_end:bigint,minus_priority:int,no:int,label:string,confidence:double>>"
# A list that grows by one is copied each time, so lists grow within blocks of so many.
_BLOCK = 128


def _gathered(values: Column, start: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column]) -> Column:
    """What ``emit`` gives, as arrays, for each value and the state before it; ``step`` gives the next state.

    The work is in proportion to the number of values.
    """
    empty = F.array().cast(SPANS)
    last = F.floor((F.size(values) - 1) / _BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * _BLOCK + 1, F.lit(_BLOCK)))

    def within(state: Column, x: Column) -> Column:
        return F.struct(step(state["now"], x).alias("now"), F.concat(state["out"], emit(state["now"], x)).alias("out"))

    def over(state: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(state["now"].alias("now"), empty.alias("out")), within)
        return let(done, lambda d: F.struct(d["now"].alias("now"), F.concat(state["out"], F.array(d["out"])).alias("out")))

    zero = F.struct(start.alias("now"), F.array().cast(f"array<{SPANS}>").alias("out"))
    found = F.flatten(F.aggregate(blocks, zero, over)["out"])
    return F.when(F.size(values) > 0, found).otherwise(empty)


def _spans(text: Column, rule: Column) -> Column:
    """``rule`` at each place of its pattern, with start and end as word numbers."""
    # Between the matches lie the parts of the split; their lengths give the places.
    def placed(found: Column) -> Column:
        parts = F.split(text, rule["pattern"], -1)

        def begin(at: Column, x: Column, parts: Column) -> Column:
            return at + _spaces(F.get(parts, x["i"]))

        def span(at: Column, x: Column, parts: Column) -> Column:
            # A word has two spaces; a match ends before the space of its last word.
            first = begin(at, x, parts)
            return F.array(
                F.struct(
                    F.floor(first / 2).alias("start"),
                    (-F.floor((first + _spaces(x["m"]) + 1) / 2)).alias("minus_end"),
                    (-rule["priority"]).alias("minus_priority"),
                    rule["no"].alias("no"),
                    rule["label"].alias("label"),
                    rule["confidence"].alias("confidence"),
                )
            )

        numbered = F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i")))

        def along(parts: Column) -> Column:
            after = lambda at, x: begin(at, x, parts) + _spaces(x["m"])
            return let(numbered, lambda n: _gathered(n, F.lit(0).cast("bigint"), after, lambda at, x: span(at, x, parts)))

        return let(parts, along)

    found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    return let(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(F.array().cast(SPANS)))


def _suppressed(spans: Column) -> Column:
    """The spans not within another of at least their priority; of equal ones the first rule stays."""
    # In this order whatever holds a span comes before it; so the furthest end
    # so far, by priority, tells whether there is one.
    start = F.struct(*[F.lit(0).cast("bigint").alias(f"p{p}") for p in (1, 2, 3)])

    def step(far: Column, x: Column) -> Column:
        reach = lambda p: F.when(-x["minus_priority"] == p, F.greatest(far[f"p{p}"], -x["minus_end"]))
        return F.struct(*[reach(p).otherwise(far[f"p{p}"]).alias(f"p{p}") for p in (1, 2, 3)])

    def left(far: Column, x: Column) -> Column:
        end, priority = -x["minus_end"], -x["minus_priority"]
        furthest = F.when(priority == 3, far["p3"]).when(priority == 2, F.greatest(far["p2"], far["p3"]))
        furthest = furthest.otherwise(F.greatest(far["p1"], far["p2"], far["p3"]))
        return F.when(furthest >= end, F.array().cast(SPANS)).otherwise(F.array(x))

    return let(F.sort_array(spans), lambda ordered: _gathered(ordered, start, step, left))


def scan_licenses(
    docs: DataFrame, keep: Sequence[str] | None = None, text: str = "text", rules: Sequence[LicenseRule] | None = None
) -> DataFrame:
    """``docs`` with what was found; one row a document.

    ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of the
    base phrases; ``detections``, the rules left after suppression, as start and
    end (word numbers, the end excluded), label and confidence; ``labels`` of both;
    ``score``, the highest confidence, 1 for a base phrase and 0 for none. Null
    text counts as empty. Whole texts are scanned, in time in proportion to what is
    found. Repeated rows are scanned each, and an empty table stays so. ``keep`` names the columns to
    return, all unless given; columns of the new names are replaced.
    """
    rules = list(default_rules() if rules is None else rules)
    made = ("n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score")
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(F.struct(*kept).alias("doc"), spaced_words(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    t = F.col("t")

    places, firsts, lasts, base_labels = F.lit(0).cast("bigint"), [], [], []
    for phrase, label in BASE:
        spaced = _spaced(phrase)
        there = F.contains(t, F.lit(spaced))
        places = places + F.when(there, F.regexp_count(t, F.lit(spaced))).otherwise(0)
        at = F.instr(t, spaced)
        from_end = F.length(t) - F.locate(spaced[::-1], F.reverse(t)) - len(spaced) + 2
        before = lambda place: F.floor(_spaces(F.substring(t, F.lit(1), place - 1)) / 2)
        firsts.append(F.when(there, before(at)))
        lasts.append(F.when(there, before(from_end)))
        base_labels.append(F.when(there, label))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(t, F.lit(word))
    known = F.array(
        *[
            F.struct(F.lit(i).alias("no"), *[F.lit(v).alias(k) for k, v in vars(r).items()])
            for i, r in enumerate(rules)
        ]
    )
    tried = F.filter(known, lambda r: F.contains(t, r["keyword"]))
    spans = F.flatten(F.transform(tried, lambda r: _spans(t, r)))
    detections = F.when(gate, _suppressed(spans)).otherwise(F.array().cast(SPANS))
    distinct = lambda labels: F.array_sort(F.array_distinct(labels))
    found = rows.select(
        "doc",
        F.floor(_spaces(t) / 2).alias("n_words"),
        places.alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_compact(F.array(*base_labels)).alias("base"),
        detections.alias("found"),
    )
    spans = F.transform(
        "found", lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence"))
    )
    best = F.coalesce(F.array_max(F.col("found.confidence")), F.lit(0.0))
    return found.select(
        "doc.*",
        *["n_words", "n_base", "first_word", "last_word"],
        F.array_join(distinct(F.col("base")), ",").alias("base_labels"),
        spans.alias("detections"),
        F.array_join(distinct(F.concat("base", F.col("found.label"))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
    )
