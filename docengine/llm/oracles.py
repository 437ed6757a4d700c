"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

import math

from docengine.llm import mixing, quality_rules

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, row_number() OVER g AS rank, first_value(doc_id) OVER g AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, rank = 1 AS kept, text_sha256 FROM r
"""


def _draw(k: int) -> str:
    digest = f"md5('{k // 4}:' || coalesce(doc_id::VARCHAR, ''))"
    return f"(('0x' || substr({digest}, {1 + 8 * (k % 4)}, 8))::BIGINT / 4294967296.0)"


def mixed(documents: str) -> str:
    """Rows of ``documents`` with size, source_size, target and copies, as mixing.mix makes them."""
    draws = range(mixing.DRAWS)
    return rf"""
sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {documents}
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight FROM per_source
), ordered AS (
  SELECT *, sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source ROWS UNBOUNDED PRECEDING) AS spent,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source ROWS UNBOUNDED PRECEDING) AS open
  FROM ranked WHERE source_size > 0
), levels AS (
  SELECT 0 AS k, 0 AS spent, sum(weight) AS open FROM ordered
  UNION ALL SELECT row_number() OVER (ORDER BY spent), spent, open FROM ordered
), best AS (
  -- the first level whose theta caps no further source
  SELECT min(l.k) AS k FROM levels l
  WHERE l.open > 0 AND NOT EXISTS (
    SELECT 1 FROM (SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS at FROM ordered) o
    WHERE o.at > l.k AND 2 * o.source_size < o.weight * ((3 * (SELECT sum(source_size) FROM per_source) - 2 * l.spent)::DOUBLE / (2 * l.open)::DOUBLE))
), goal AS (
  SELECT source, source_size,
         least((2 * source_size)::DOUBLE, weight * (SELECT (3 * (SELECT sum(source_size) FROM per_source) - 2 * l.spent)::DOUBLE / (2 * l.open)::DOUBLE
                                                    FROM levels l JOIN best USING (k))) AS target
  FROM ranked
), rated AS (
  SELECT d.*, g.source_size, coalesce(g.target, (2 * g.source_size)::DOUBLE) AS target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source
), drawn AS (
  SELECT *, {", ".join(f"(floor(rate) + CASE WHEN {_draw(k)} < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS c{k}" for k in draws)} FROM rated
), off AS (
  SELECT source AS of, {", ".join(f"abs(sum(c{k} * size) - first(target)) AS e{k}" for k in draws)} FROM drawn GROUP BY source
), picked AS (
  SELECT of, CASE {" ".join(f"WHEN e{k} = least({', '.join(f'e{j}' for j in draws)}) THEN {k}" for k in draws)} END AS draw FROM off
), mixed AS (
  SELECT d.*, CASE draw {" ".join(f"WHEN {k} THEN c{k}" for k in draws)} END AS copies
  FROM drawn d JOIN picked p ON d.source IS NOT DISTINCT FROM p.of
)
"""


MIX = f"WITH {mixed('documents')} SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"


def _fence_sql() -> str:
    q = quality_rules
    gamma = math.log(q.GAMMA)
    value = lambda b: f"((pow({q.GAMMA}::DOUBLE, {b} + 0.5::DOUBLE) - 1) / {q.UNIT}::DOUBLE)"
    bucket = lambda v: f"floor(ln(1.0::DOUBLE + {q.UNIT}::DOUBLE * {v}) / {gamma!r}::DOUBLE)::INT"
    names = [*[(m, side) for m in q.MIDDLED for side in ("low", "high")], *[(m, "cut") for m in q.RATES]]
    edges = ", ".join(f"max(CASE WHEN metric = '{m}' THEN {side} END) AS {m}_{side}" for m, side in names)
    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {bucket(m)} AS bucket FROM rated WHERE NOT base_failed" for m in q.METRICS)
    of = lambda c: f"CASE WHEN f0.docs >= {q.SMALL} THEN f0.{c} WHEN f1.docs >= {q.SMALL} THEN f1.{c} ELSE f2.{c} END"
    inside = " AND ".join([
        *[f"coalesce({m} >= {of(m + '_low')} AND {m} <= {of(m + '_high')}, true)" for m in q.MIDDLED], *[f"coalesce({bucket(m)} <= {of(m + '_cut')}, true)" for m in q.RATES],
    ])
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM t
), win AS (
  SELECT rid, i, words[i:i+4] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid
), base AS (
  SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), rated AS (
  SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed,
         word_chars::DOUBLE / greatest(n_words, 1) AS mean_word, n_symbols::DOUBLE / greatest(n_words, 1) AS symbol_rate,
         n_dup_lines::DOUBLE / greatest(n_words, 1) * 10.0::DOUBLE AS dup_line_rate, n_repeat_words::DOUBLE / greatest(n_words, 1) AS repeat_rate
  FROM base
), long AS ({long}),
cells AS (SELECT lang, source, metric, bucket, count(*) AS n FROM long GROUP BY ALL),
merged AS (
  SELECT 0 AS level, lang, source, metric, bucket, n FROM cells
  UNION ALL SELECT 1, lang, NULL, metric, bucket, sum(n) FROM cells GROUP BY lang, metric, bucket
  UNION ALL SELECT 2, NULL, NULL, metric, bucket, sum(n) FROM cells GROUP BY metric, bucket
), run AS (
  SELECT *, lead(bucket) OVER up AS after, sum(n) OVER up AS c1, sum(n * bucket) OVER up AS s1, sum(n * bucket * bucket) OVER up AS q1,
         sum(n) OVER g AS c0, sum(n * bucket) OVER g AS s0, sum(n * bucket * bucket) OVER g AS q0
  FROM merged WINDOW g AS (PARTITION BY level, lang, source, metric), up AS (PARTITION BY level, lang, source, metric ORDER BY bucket ROWS UNBOUNDED PRECEDING)
), split AS (
  SELECT *, CASE WHEN after IS NOT NULL THEN (c0::DOUBLE * s1::DOUBLE - c1::DOUBLE * s0::DOUBLE) * (c0::DOUBLE * s1::DOUBLE - c1::DOUBLE * s0::DOUBLE) / (c1::DOUBLE * (c0 - c1)::DOUBLE) END AS b FROM run
), best AS (
  SELECT level, lang, source, metric, bucket, after, c0, c1::DOUBLE AS n1, (c0 - c1)::DOUBLE AS n2, s1 / c1::DOUBLE AS m1, (s0 - s1) / (c0 - c1)::DOUBLE AS m2, q1 / c1::DOUBLE AS r1, (q0 - q1) / (c0 - c1)::DOUBLE AS r2
  FROM split WHERE b IS NOT NULL QUALIFY row_number() OVER (PARTITION BY level, lang, source, metric ORDER BY b DESC, bucket) = 1
), cuts AS (
  SELECT *, floor((bucket + after) / 2.0)::INT AS cut FROM best
  WHERE n2 * {q.MINORITY} <= c0 AND 2.0 * (m2 - m1) * (m2 - m1) >= {q.SEPARATION * q.SEPARATION!r}::DOUBLE * (r1 - m1 * m1 + r2 - m2 * m2 + {float(q.BLUR * q.BLUR)}::DOUBLE)
), quart AS (
  SELECT level, lang, source, metric, max(c0) AS docs, min(CASE WHEN c1 * 4 >= c0 THEN bucket END) AS b1, min(CASE WHEN c1 * 4 >= c0 * 3 THEN bucket END) AS b3 FROM run GROUP BY ALL
), fence AS (
  SELECT quart.*, cuts.cut, {value('b1')} - {q.SPREAD}::DOUBLE * ({value('b3')} - {value('b1')}) AS low, {value('b3')} + {q.SPREAD}::DOUBLE * ({value('b3')} - {value('b1')}) AS high
  FROM quart LEFT JOIN cuts ON quart.level = cuts.level AND quart.lang IS NOT DISTINCT FROM cuts.lang AND quart.source IS NOT DISTINCT FROM cuts.source AND quart.metric = cuts.metric
), f AS (SELECT level, lang, source, max(docs) AS docs, {edges} FROM fence GROUP BY level, lang, source)
SELECT r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, NOT r.base_failed AND {inside} AS kept
FROM rated r
LEFT JOIN (SELECT * FROM f WHERE level = 0) f0 ON r.lang IS NOT DISTINCT FROM f0.lang AND r.source IS NOT DISTINCT FROM f0.source
LEFT JOIN (SELECT * FROM f WHERE level = 1) f1 ON r.lang IS NOT DISTINCT FROM f1.lang
LEFT JOIN (SELECT * FROM f WHERE level = 2) f2 ON true
"""


NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, words[i:i+4] AS g FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), linked AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)
), edges AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x
)
SELECT a AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id, min(b) = a AS kept
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""


#: CRC-32 by its byte table, which SQL makes from the rule.
_TABLE = "tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"


def _crc(text: str) -> str:
    data = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _features(table: str, key: str) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
  SELECT key, len(w) AS n_words, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM (SELECT {key} AS key, regexp_extract_all(coalesce({lower}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"""


IMPORTANCE = rf"""
WITH {_TABLE},
df AS ({_features("documents", "doc_id")}), bf AS ({_features("benchmark", "item_id")}),
bucket AS (SELECT f, {_crc("f")} % 10000 AS b FROM (SELECT f FROM df UNION SELECT f FROM bf), tab),
s AS (SELECT b, count(*) AS n FROM df JOIN bucket USING (f) GROUP BY b), t AS (SELECT b, count(*) AS n FROM bf JOIN bucket USING (f) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM s) + 10000))::DOUBLE / ((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))::DOUBLE)) AS gain
  FROM s LEFT JOIN t USING (b)
), weighed AS (SELECT key AS doc_id, max(n_words) AS n_words, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight FROM df JOIN bucket USING (f) JOIN gain USING (b) GROUP BY key),
scored AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weighed USING (doc_id)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 25 * n // 100 THEN r END AS rank FROM ranked
"""


def _field(name: str, more: str = "") -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode(({name}{more})::VARCHAR)) || ':' || ({name}{more})::VARCHAR END"


def _leaf(more: str) -> str:
    return "sha256(" + " || ".join(_field(c, more if c == "n_chars" else "") for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"


MERKLE = rf"""
WITH RECURSIVE {_TABLE},
leaves AS (
  SELECT doc_id, lang, {_leaf("")} AS leaf, CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf(" + 1")} ELSE {_leaf("")} END AS other FROM documents, tab
), placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (
  SELECT lang, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY lang, level, pos // 2, n
), sub AS (SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, h, n FROM sub
  UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n
), heights AS (SELECT lang, level FROM up WHERE n > 1 GROUP BY lang, level), steps AS (SELECT DISTINCT level FROM top WHERE n > 1),
sides AS (
  SELECT p.lang, p.pos, h.level AS step, (p.pos >> h.level) & 1 AS odd, coalesce(u.h, '') AS h
  FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang LEFT JOIN up u ON u.lang IS NOT DISTINCT FROM p.lang AND u.level = h.level AND u.pos = xor(p.pos >> h.level, 1)
  UNION ALL SELECT p.lang, p.pos, 1000 + e.level, (s.pos >> e.level) & 1, coalesce(t.h, '')
  FROM placed p JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN steps e LEFT JOIN top t ON t.level = e.level AND t.pos = xor(s.pos >> e.level, 1)
), paths AS (SELECT lang, pos, list(CASE odd WHEN 1 THEN 'L' ELSE 'R' END || h ORDER BY step) AS path, string_agg(h, '' ORDER BY step) AS flat FROM sides GROUP BY lang, pos),
folded AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(q.flat, '')) AS proof_sha256,
         list_reduce(list_prepend(p.other, coalesce(q.path, [])), lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN substr(x, 2) || a ELSE a || substr(x, 2) END)) AS folded_root
  FROM placed p JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths q ON p.lang IS NOT DISTINCT FROM q.lang AND p.pos = q.pos
)
SELECT *, folded_root = root AS verified FROM folded
"""

SUFFIX = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT doc_id, p, array_slice(x, p + 1, p + 50) AS s FROM d, unnest(range(0, octet_length(x) - 49)) u(p)),
g AS (SELECT doc_id, p FROM w JOIN (SELECT s, min(doc_id) AS low FROM w GROUP BY s) USING (s) WHERE low < doc_id),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh FROM g)),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM r GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(s.b), 0), max(octet_length(x)) FROM d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id
), kept AS (SELECT doc_id, sha256(unhex(string_agg(hex(array_slice(x, a + 1, b)), '' ORDER BY a))) AS kept_sha256 FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, octet_length(x) AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id) USING (doc_id)
"""


ORACLES = {
    "op2_quality_rules": _fence_sql(),
    "op3_mix_sources": MIX,
    "op4_exact_dedup": EXACT_DEDUP,
    "op8_near_dedup": NEAR_DEDUP,
    "op11_importance": IMPORTANCE,
    "op12_merkle": MERKLE,
    "op13_suffix_dedup": SUFFIX,
}
