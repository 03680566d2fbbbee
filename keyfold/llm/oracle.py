"""The queries as SQL, where SQL can express them."""

from __future__ import annotations

from . import licenses
from .queries import LISTED_WORDS

HOST = r"translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH split AS (
    SELECT page_id,
           CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parsed AS (SELECT page_id, {HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
listed AS (
    SELECT *, list_has_any(string_split_regex(host, '[.-]'), {list(LISTED_WORDS)!r}) AS listed,
           (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' AS net_en,
           (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' AS com_de,
           (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' AS net,
           (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' AS org_fr
    FROM parsed),
ruled AS (
    SELECT *, CASE WHEN net_en THEN 'example.net/en/' WHEN com_de THEN 'example.com/de/'
                   WHEN org_fr THEN 'org/fr/' WHEN net THEN 'net/' END AS rule
    FROM listed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR listed THEN 'block'
            ELSE 'allow' END AS verdict,
       listed
FROM ruled
"""

_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP2 = rf"""
WITH sized AS (
    SELECT doc_id, source, {_SIZE}::BIGINT AS size,
           coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS mark
    FROM documents),
graded AS (
    SELECT *, CASE WHEN size < 50 THEN 1 WHEN size < 500 THEN 2 ELSE 3 END AS grade,
           ((('0x' || substr(md5(mark || ':' || size::VARCHAR || ':7'), 1, 13))::BIGINT)::DOUBLE
            + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
    FROM sized),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, (3 * sum(size))::BIGINT AS cap,
           sum(size) FILTER (grade = 1)::BIGINT AS s1, sum(size) FILTER (grade = 2)::BIGINT AS s2,
           sum(size) FILTER (grade = 3)::BIGINT AS s3,
           ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
    FROM graded GROUP BY source),
by_room AS (
    SELECT *, sum(source_size) OVER () AS total,
           coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_caps,
           sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM sources),
levels AS (SELECT *, (total - full_caps)::DOUBLE / open_weight::DOUBLE AS level FROM by_room),
water AS (SELECT arg_min(level, cap::DOUBLE / weight) FILTER (weight * level <= cap) AS level FROM levels),
targets AS (
    SELECT source, source_size, least(cap::DOUBLE, weight * w.level) AS target,
           coalesce(s1, 0) AS s1, coalesce(s2, 0) AS s2, coalesce(s3, 0) AS s3
    FROM sources, water w),
rates0 AS (
    SELECT *, CASE WHEN s1 + s2 * 2 + s3 * 3 > 0 THEN target / (s1 + s2 * 2 + s3 * 3)::DOUBLE END AS r0,
           CASE WHEN s1 + s2 * 2 > 0 THEN (target - s3 * 3) / (s1 + s2 * 2)::DOUBLE END AS r1,
           CASE WHEN s1 > 0 THEN (target - (s2 * 3 + s3 * 3)) / s1::DOUBLE END AS r2
    FROM targets),
rates AS (
    SELECT source, source_size, target,
           CASE WHEN r0 * 3 <= 3 THEN r0 WHEN r1 * 2 <= 3 THEN r1 WHEN r2 * 1 <= 3 THEN r2 ELSE 3.0::DOUBLE END AS rate
    FROM rates0),
rated AS (
    SELECT g.*, r.source_size, r.target, floor(least(3.0::DOUBLE, r.rate * g.grade))::BIGINT AS whole,
           least(3.0::DOUBLE, r.rate * g.grade) - floor(least(3.0::DOUBLE, r.rate * g.grade)) AS chance
    FROM graded g JOIN rates r ON g.source IS NOT DISTINCT FROM r.source),
ranked AS (
    SELECT *, CASE WHEN chance > 0 AND size > 0
              THEN u * (1 - chance) / (u * (1 - chance) + (1 - u) * chance) END AS place,
           target - sum(whole * size) OVER (PARTITION BY source) AS residual
    FROM rated),
run AS (
    SELECT *, sum(CASE WHEN place IS NOT NULL THEN size END) OVER (
                PARTITION BY source ORDER BY place NULLS LAST, doc_id NULLS FIRST, size
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
           sum(size) OVER (PARTITION BY source, place, doc_id, size) AS words
    FROM ranked)
SELECT doc_id, size, source_size, target,
       (size * copies)::BIGINT AS taken, copies::INTEGER AS copies
FROM (SELECT *, CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN place IS NOT NULL AND upto - words < residual
                AND upto - residual <= residual - (upto - words) THEN 1 ELSE 0 END END AS copies FROM run)
"""



def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _spaces(value: str) -> str:
    return f"(length({value}) - length(replace({value}, ' ', '')))"


def _licenses() -> str:
    rules = ",\n".join(
        f"({i}, {_text(r.label)}, {_text(r.keyword)}, {_text(r.pattern)}, {r.priority}, {r.confidence}::DOUBLE)"
        for i, r in enumerate(licenses.default_rules())
    )
    phrases = [(licenses._spaced(phrase), label) for phrase, label in licenses.BASE]
    places = " + ".join(f"(length(t) - length(replace(t, {_text(p)}, ''))) // {len(p)}" for p, _ in phrases)
    there = lambda p, value: f"CASE WHEN contains(t, {_text(p)}) THEN {value} END"
    first = ", ".join(there(p, _spaces(f"substr(t, 1, strpos(t, {_text(p)}) - 1)") + " // 2") for p, _ in phrases)
    tail = lambda p: f"string_split(t, {_text(p)})[-1]"
    last = ", ".join(there(p, f"({_spaces('t')} - {_spaces(tail(p))} - {p.count(' ')}) // 2") for p, _ in phrases)
    base = ", ".join(there(p, _text(label)) for p, label in phrases)
    ends = f"({_spaces('m')} + pos + 1) // 2"
    return rf"""
WITH rules(no, label, keyword, pattern, priority, confidence) AS (VALUES
{rules}),
bare AS (
    SELECT row_number() OVER () AS rid, doc_id,
           trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '{licenses.NO_WORD}', '  ', 'g'), ' ') AS w
    FROM documents),
texts AS (SELECT rid, doc_id, CASE WHEN w = '' THEN ' ' ELSE ' ' || w || ' ' END AS t FROM bare),
based AS (
    SELECT rid, doc_id, {_spaces("t")} // 2 AS n_words, {places} AS n_base,
           least({first}) AS first_word, greatest({last}) AS last_word,
           [x FOR x IN [{base}] IF x IS NOT NULL] AS base
    FROM texts),
hits AS (
    SELECT rid, rules.*, regexp_extract_all(t, pattern) AS found, string_split_regex(t, pattern) AS parts
    FROM texts JOIN rules ON contains(t, keyword) AND regexp_matches(t, pattern)),
each AS (SELECT *, unnest(generate_series(1, len(found))) AS k FROM hits),
placed AS (
    SELECT rid, no, label, priority, confidence, found[k] AS m,
           list_sum([{_spaces("x")} FOR x IN parts[1:k]])
           + coalesce(list_sum([{_spaces("x")} FOR x IN found[1:k - 1]]), 0) AS pos
    FROM each),
spans AS (SELECT rid, no, label, priority, confidence, (pos // 2)::BIGINT AS low, ({ends})::BIGINT AS high FROM placed),
kept AS (
    SELECT * FROM spans a WHERE NOT EXISTS (
        SELECT 1 FROM spans b
        WHERE b.rid = a.rid AND b.low <= a.low AND b.high >= a.high AND b.priority >= a.priority
          AND (b.low <> a.low OR b.high <> a.high OR b.priority > a.priority OR b.no < a.no))),
labelled AS (SELECT rid, list(label) AS labels, max(confidence) AS confidence, count(*) AS n FROM kept GROUP BY rid)
SELECT doc_id, n_words::BIGINT AS n_words, n_base::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
       CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(confidence, 0.0::DOUBLE) END AS score,
       coalesce(n, 0)::INTEGER AS n_detections
FROM based LEFT JOIN labelled USING (rid)
"""


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
bench AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
begins AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM bench WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[p:p + 9], ' ') AS s FROM begins),
sizes AS (SELECT DISTINCT m FROM windows),
starts AS (
    SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p FROM docs, sizes WHERE len(w) >= m),
places AS (SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS s FROM starts),
found AS (SELECT r, m, p, item_id FROM places JOIN windows USING (m, s)),
hits AS (
    SELECT r, count(DISTINCT q) AS n_hit
    FROM (SELECT DISTINCT r, unnest(generate_series(p, p + m - 1)) AS q FROM found) GROUP BY r),
names AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""

OP13 = """
WITH rows AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) for x in embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
           list_dot_product(a.q, r.q)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.q) = len(r.q)),
positives AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE same)
    WHERE place <= 5),
ranked AS (
    SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

ORACLE = {
    "op1_url_filter": OP1,
    "op2_mix_sources": OP2,
    "op4_license_scan": _licenses(),
    "op11_decontaminate": OP11,
    "op13_hard_negatives": OP13,
}
