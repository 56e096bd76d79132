"""DuckDB SQL of the document queries that SQL can express.

Written from the contracts, with plain grouping, windows and recounts, not
from the Spark plans.
"""

from __future__ import annotations

from . import line_runs, mixing, quality, secrets

WORDS = r"[^\x20\x09-\x0D]+"
STRIP = r"concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _upper_to_lower(value: str) -> str:
    return f"translate({value}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op5() -> str:
    key = _upper_to_lower(f"trim(line, {STRIP})")
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, rid, unnest(string_split(t, chr(10))) AS line,
             generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, {key} AS key FROM l),
heavy AS (SELECT key FROM k WHERE key <> '' GROUP BY key
          HAVING count(DISTINCT rid) >= {line_runs.MIN_DOCS}),
j AS (SELECT k.*, heavy.key IS NOT NULL AS gone FROM k LEFT JOIN heavy USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
           AS kept_sha256
FROM j GROUP BY rid"""


def op3() -> str:
    line = f"""replace(lower(regexp_replace(regexp_replace(trim(line, {STRIP}),
        '[\\x20\\x09-\\x0D]+', ' ', 'g'), '[0-9]', '0', 'g')), chr(0), chr(0))"""
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, source, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{WORDS}') AS w FROM d),
n AS (SELECT rid, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars FROM w),
g AS (SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM
      (SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g)
          WHERE c > 1),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM
      (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
l AS (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT rid, source, t, line, {line} AS key,
              len(regexp_extract_all(line, '{WORDS}')) AS n
       FROM l WHERE regexp_matches(line, '{WORDS}')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY rid),
heavy AS (SELECT source, key FROM lw GROUP BY source, key
          HAVING count(DISTINCT t) > {quality.MAX_DOCS}),
gone AS (SELECT rid, sum(n) AS gone FROM lw JOIN heavy
         ON lw.key = heavy.key AND lw.source IS NOT DISTINCT FROM heavy.source GROUP BY rid),
x AS (SELECT d.doc_id, n.n_words, n.word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(gone, 0) AS n_boilerplate_words
  FROM d JOIN n USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN r USING (rid)
  LEFT JOIN gone USING (rid)),
f AS (SELECT *, n_words < {quality.MIN_WORDS}
         OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM x)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_boilerplate_words >= {quality.MIN_LEFT} * n_words AS kept,
  CAST(n_boilerplate_words AS BIGINT) AS n_boilerplate_words
FROM f"""


def _inverse(part: str, knots) -> str:
    spans = list(zip(knots, knots[1:]))
    areas = [(a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in spans]
    total, done, cases = sum(areas), 0.0, []
    for ((t0, w0), (t1, w1)), area in zip(spans, areas):
        slope = (w1 - w0) / (t1 - t0)
        rest = f"({part} * {total!r} - {done!r})"
        done += area
        root = f"({w0!r} + sqrt(greatest({w0 * w0!r} + {rest} * {2 * slope!r}, 0.0)))"
        here = f"CASE WHEN {root} > 0 THEN {t0!r} + {rest} * 2 / {root} ELSE {t0!r} END"
        cases.append((f"{part} * {total!r} < {done!r}", here))
    body = " ".join(f"WHEN {c} THEN {h}" for c, h in cases[:-1])
    last = cases[-1][1]
    value = f"CASE {body} ELSE {last} END" if body else f"({last})"
    return f"round(least(greatest({value}, 0.0), 1.0), 6)"


def op8() -> str:
    pick = " ".join(f"WHEN {w} THEN {_inverse('p', k)}" for w, k in mixing.SCHEDULES.items())
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'no id ' || md5(coalesce(text, '')))) AS h,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size FROM documents),
s AS MATERIALIZED (SELECT source, sum(size) AS n, [5, 2, 1][CAST((row_number() OVER (
        ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w FROM d GROUP BY source),
-- reshare until nobody is above the cap: capped sources leave, the rest share again
share(k, level) AS (
    SELECT 0, (SELECT {mixing.SHARE} * sum(n) / sum(w) FROM s)
    UNION ALL
    SELECT k + 1, ((SELECT {mixing.SHARE} * sum(n) FROM s)
            - (SELECT coalesce(sum({mixing.REPEATS}.0 * n), 0) FROM s WHERE w * level > {mixing.REPEATS}.0 * n))
        / (SELECT sum(w) FROM s WHERE w * level <= {mixing.REPEATS}.0 * n)
    FROM share WHERE k < 60),
t AS (SELECT source, n, w, least(w * (SELECT level FROM share WHERE k = 60),
        {mixing.REPEATS}.0 * n) AS target FROM s),
a AS (SELECT d.doc_id, size, n, w, CAST(target AS DOUBLE) AS target,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS mid
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, list_transform(list_filter([mid, mid + n], lambda m: size > 0 AND m <= target),
        lambda m: m / target) AS parts FROM a),
c AS (SELECT *, list_transform(parts, lambda p: CASE w {pick} END) AS positions FROM b)
SELECT doc_id, size, CAST(n AS BIGINT) AS source_size, target,
       CAST(size * len(parts) AS BIGINT) AS taken, positions[1] AS position, positions[2] AS position_2 FROM c"""


def op1() -> str:
    def found(kind: str, rank: int, pattern: str) -> str:
        p = _quoted(pattern)
        return f"""SELECT rid, {_quoted(kind)} AS kind, {rank} AS rank, i, ms[i] AS m,
            CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x)))
                + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS a
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT rid,
              regexp_extract_all(t, {p}) AS ms, string_split_regex(t, {p}) AS gaps
              FROM d WHERE regexp_matches(t, {p})))"""

    any_case = "".join(c for c in secrets.ASSIGN)
    for word in ("password", "passwd", "secret", "token", "api_?key"):
        any_case = any_case.replace(word, "".join(
            f"[{c.upper()}{c}]" if c.isalpha() else c for c in word), 1)
    any_case = any_case.replace("(?i:", "(?:")
    base = " UNION ALL ".join(found(k, i, p) for i, (k, p) in enumerate(
        [("assign", any_case), ("access", secrets.ACCESS), ("hex", secrets.HEX)]))
    allow = " OR ".join(f"regexp_matches(m, {_quoted(p)})" for p in secrets.ALLOW)
    masked = "m"
    for word in secrets.FILLERS:
        masked = f"regexp_replace({masked}, '{word}', repeat(chr(1), {len(word)}), 'gi')"
    candidates = " UNION ALL ".join(
        f"SELECT *, {c.window} AS size, {c.most} AS most FROM ({found(c.kind, 3 + i, c.pattern)})"
        for i, c in enumerate(secrets.ENTROPY))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t
                        FROM documents),
base AS MATERIALIZED (SELECT rid, kind, rank, a, a + len(m) AS b FROM ({base})
    WHERE kind <> 'assign' OR len(regexp_extract(m, {_quoted(any_case)}, 2)) >= {secrets.MIN_VALUE}),
cand AS MATERIALIZED (SELECT * REPLACE ({masked} AS m) FROM ({candidates}) WHERE NOT ({allow})),
win AS (SELECT rid, kind, rank, a, i, size, most, m, unnest(range(0, len(m) - size + 1)) AS j
        FROM cand),
ch AS (SELECT rid, kind, rank, a, i, size, most, j, ch, count(*) AS c FROM
       (SELECT *, substr(m, CAST(j + unnest(range(1, size + 1)) AS BIGINT), 1) AS ch FROM win)
       GROUP BY ALL),
hot AS (SELECT rid, kind, rank, a, i, size, j FROM ch GROUP BY rid, kind, rank, a, i, size, j, most
        HAVING sum(CASE WHEN c < 2 THEN 0 ELSE CAST(round(c * log2(c) * 1e6) AS BIGINT) END) <= most
            AND count(*) FILTER (ch = chr(1)) = 0),
isl AS (SELECT *, sum(CASE WHEN gap > size THEN 1 ELSE 0 END) OVER (
            PARTITION BY rid, kind, i ORDER BY j) AS part FROM (
        SELECT *, j - lag(j, 1, j) OVER (PARTITION BY rid, kind, i ORDER BY j) AS gap FROM hot)),
ent AS (SELECT rid, kind, rank, any_value(a) + min(j) AS a, any_value(a) + max(j) + any_value(size) AS b
        FROM isl GROUP BY rid, kind, rank, i, part),
added AS (SELECT * FROM ent WHERE NOT EXISTS (SELECT 1 FROM base
          WHERE base.rid = ent.rid AND base.a <= ent.a AND base.b >= ent.b)),
sp AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM added),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign,
        count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (is_base) AS base,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans
      FROM sp GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""


def op12() -> str:
    return """WITH v AS (SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM v),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
        CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
      FROM q a JOIN q r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank,
       s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5"""


ORACLES: dict[str, str] = {
    "op1_secret_scan": op1(),
    "op3_quality_rules": op3(),
    "op5_line_dedup": op5(),
    "op8_mixing": op8(),
    "op12_hard_negatives": op12(),
}
