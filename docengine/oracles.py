"""DuckDB SQL for the registered queries, written for DuckDB from their definitions."""

from __future__ import annotations

from docengine.functions import labels as L
from docengine.functions import text as T
from docengine.plans import fixtures as X

_SP = T.SPACE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sub(e: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({e}, {_q(pattern)}, {_q(to)}, '{flags}')"


def _strip(e: str) -> str:
    return _sub(e, f"^[{_SP}]+|[{_SP}]+$")


def _norm(e: str) -> str:
    return _sub(_sub(f"lower({_strip(e)})", T.ZERO_WIDTH), rf"[^\p{{L}}\p{{N}}_{T.TAMIL}]+")


def _match(e: str) -> str:
    return f"replace({_norm(e)}, '0', 'o')"


def _line(e: str) -> str:
    return _sub(_sub(_strip(e), T.ZERO_WIDTH), f"[{_SP}]+", " ")


def _after(e: str, label: str) -> str:
    found = f"regexp_extract({_line(e)}, {_q(rf'(?i)(?:{label})\s*{T.DASH}?\s*{T.DASH}\s*(.+?)(?:\s*[\-–—]\s*$|\s*$)')}, 1)"
    return _strip(_sub(_sub(_strip(found), r"\s*[\-–—]\s*$"), rf"(?i)\s*(?:{L.VALUE_CUT}).*$"))


def _any(test, values) -> str:
    return "(" + " OR ".join(test(v) for v in values) + ")"


def _photo(e: str) -> str:
    m = _match(e)
    return _any(lambda v: f"contains({m}, {_q(T.match_py(v))})", L.PHOTO_MARKERS)


def _first(values: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif({v}, '')" for v in values) + ", '')"


_LINES = ["l0", "l1", "l2", "l3", "l4"]


def _name(e: str) -> str:
    low = f"lower({_line(e)})"
    return f"CASE WHEN NOT regexp_matches({low}, {_q('(?i)' + L.RELATION_WORDS)}) AND regexp_matches({low}, {_q('(?i)' + L.NAME_LINE)}) THEN {_after(e, L.NAME_PATTERN)} ELSE '' END"


def _relative(e: str, kind: str) -> str:
    v = _sub(_after(e, L.RELATION_PATTERNS[kind]), rf"^பெயர்\s*{T.DASH}?\s*", "", "")
    return _strip(_sub(v, rf"(?i)^name\s*{T.DASH}?\s*", "", ""))


def _house(e: str) -> str:
    v = _sub(_sub(_after(e, L.HOUSE_PATTERN), rf"(?i)(?:{L.VALUE_CUT}).*"), f"[{_SP}]+")
    number = f"regexp_extract({v}, {_q(r'^(\p{Nd}[\p{Nd}A-Za-z/\-]{0,15})')}, 1)"
    rest = _sub(v, r"[^\p{Nd}A-Za-z/\-]")
    return f"CASE WHEN {number} <> '' THEN {number} WHEN length({rest}) <= 15 THEN {rest} ELSE '' END"


def _age(e: str) -> str:
    return f"regexp_extract({_line(e)}, {_q(rf'(?i)(?:{L.AGE_PATTERN})\s*{T.DASH}?\s*(\p{{Nd}}{{1,3}})')}, 1)"


def _gender(e: str, strict: bool = False) -> str:
    raw = f"regexp_extract({_line(e)}, {_q(rf'(?i)(?:{L.GENDER_PATTERN})\s*{T.DASH}?\s*(\S+)')}, 1)"
    values = sorted(L.GENDER_VALUES, key=lambda kv: -len(kv[0])) if strict else L.GENDER_VALUES
    cases = " ".join(f"WHEN contains(lower({raw}), {_q(k)}) OR contains({_q(k)}, lower({raw})) THEN {_q(v)}" for k, v in values)
    return f"CASE WHEN {raw} = '' THEN '' {cases} WHEN length({raw}) < 15 THEN {raw} ELSE '' END"


def _epic(e: str) -> str:
    kept = f"upper({_sub(e, '[^A-Za-z0-9]')})"
    return f"CASE WHEN length({kept}) >= 3 THEN translate(substr({kept}, 1, 3), '01258', 'OIZSB') || translate(substr({kept}, 4), 'OIZSB', '01258') ELSE {kept} END"


_VALID = "regexp_full_match({0}, '[A-Z]{{3}}[0-9]+')"

_RELATIONS = [(e, kind) for e in _LINES for kind in L.RELATION_PATTERNS]
_STEPS = f"""
rec AS ({X.RECORDS}),
got AS (
  SELECT *, {", ".join(f"{_relative(e, kind)} AS {kind}_{e}" for e, kind in _RELATIONS)},
    {_first([_name(e) for e in _LINES])} AS name, {_first([_house(e) for e in _LINES])} AS house_no, {_first([_age(e) for e in _LINES])} AS age, {_first([_gender(e) for e in _LINES])} AS gender,
    CASE WHEN k % 10 = 0 THEN '' ELSE {_epic("'ab' || k::VARCHAR || ' O1'")} END AS epic_no
  FROM rec
), records AS (
  SELECT k, file, page, image, k::VARCHAR AS serial_no, epic_no, {_VALID.format('epic_no')} AS epic_valid, name,
    CASE {" ".join(f"WHEN {kind}_{e} <> '' THEN '{kind}'" for e, kind in _RELATIONS)} ELSE '' END AS relation_type,
    CASE {" ".join(f"WHEN {kind}_{e} <> '' THEN {kind}_{e}" for e, kind in _RELATIONS)} ELSE '' END AS relation_name, house_no, age, gender
  FROM got
)"""

_MISSING = {"name": "name", "epic": "epic_no", "house": "house_no", "age": "age", "gender": "gender"}
_REPORT = "SELECT file, page, count(*) AS total, count(*) FILTER (epic_valid) AS epic_valid_count, " + ", ".join(f"count(*) FILTER ({_strip(c)} = '') AS missing_{n}" for n, c in _MISSING.items()) + " FROM records GROUP BY file, page"

_WORDS = """
doc AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_num FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT doc_id, line_num, i, word AS text, (doc_id * 31 + line_num * 7 + i * 13) % 100 - 1 AS conf, i * 10 AS x FROM (
    SELECT doc_id, line_num, unnest(string_split(line, ' ')) AS word, generate_subscripts(string_split(line, ' '), 1) - 1 AS i FROM doc)
)"""
_REC_WORDS = """
lines AS (SELECT k, unnest([l0, l1, l2, l3, l4]) AS line, unnest([0, 1, 2, 3, 4]) AS line_num FROM rec),
rw AS (
  SELECT k, line_num, pos, line_num * 100 + pos AS i, word AS text, 90 AS conf, pos * 60 AS x, line_num * 30 AS y, length(word) * 5 AS w, 20 AS h FROM (
    SELECT k, line_num, unnest(string_split(line, ' ')) AS word, generate_subscripts(string_split(line, ' '), 1) - 1 AS pos FROM lines)
)"""


def _md(e: str) -> str:
    return _strip(f"replace(replace({_sub(e, chr(13) + chr(10) + '?', chr(10))}, '|', '\\|'), chr(10), '<br>')")


def _row(cells: list[str]) -> str:
    return "'| ' || " + " || ' | ' || ".join(cells) + " || ' |'"


def _text(parts: list[str]) -> str:
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


_FILES = f"files AS (SELECT *, stem || '.' || ext AS name, file || '/' || kind || '/' || stem || '.' || ext AS path, regexp_replace(stem, '(?i)(?:[-_]img[-_]?\\p{{Nd}}+)$', '') AS page FROM ({X.FILES}))"
_known = lambda column: f"{column} IN ({', '.join(map(_q, L.PAGE_EXTENSIONS))})"

_CODE_DIGITS = _sub("raw", "[^0-9]")
_LAST4 = f"CASE WHEN length({_CODE_DIGITS}) > 4 THEN right({_CODE_DIGITS}, 4) ELSE {_CODE_DIGITS} END"
_bare = lambda e: f"CASE WHEN ltrim({e}, '0') = '' THEN {e} ELSE ltrim({e}, '0') END"
_fold = lambda best, r: f"CASE WHEN length({r}) BETWEEN 1 AND 4 AND ({best} = '' OR length({r}) > length({best})) THEN {_bare(r)} ELSE {best} END"

_STOPS = sorted({T.match_py(s) for s in L.STOP_LABELS} - {""})
_MARKS = [T.match_py(m) for m in L.PHOTO_MARKERS]
_BOX_TEST = f"w * h BETWEEN {L.CANVAS[0] * L.CANVAS[1] * L.BOX_AREA[0]!r}::DOUBLE AND {L.CANVAS[0] * L.CANVAS[1] * L.BOX_AREA[1]!r}::DOUBLE AND w / h::DOUBLE BETWEEN {L.BOX_ASPECT[0]}::DOUBLE AND {L.BOX_ASPECT[1]}::DOUBLE AND n_vertices >= 4"


def _contained(table: str) -> str:
    return f"""SELECT a.* FROM {table} a WHERE NOT EXISTS (SELECT 1 FROM {table} b WHERE a.page = b.page AND a.x >= b.x + 6 AND a.y >= b.y + 6 AND a.x + a.w <= b.x + b.w - 6
  AND a.y + a.h <= b.y + b.h - 6 AND a.w * a.h / greatest(1, b.w * b.h)::DOUBLE <= 0.7::DOUBLE)"""


def _order(table: str) -> str:
    return f"""SELECT * EXCLUDE (lim, jump), sum(jump) OVER (PARTITION BY page ORDER BY y, x ROWS UNBOUNDED PRECEDING)::BIGINT AS row_id FROM (
  SELECT *, CASE WHEN abs(y - lag(y) OVER (PARTITION BY page ORDER BY y, x)) > lim THEN 1 ELSE 0 END AS jump FROM (
    SELECT b.*, greatest(10, trunc(m.hs[m.n // 2 + 1] * 0.55::DOUBLE)) AS lim FROM {table} b JOIN (SELECT page, list_sort(list(h)) AS hs, count(*) AS n FROM {table} GROUP BY page) m USING (page)))"""


_DEDUPE = """SELECT page, unnest(kept, recursive := true) FROM (
  SELECT page, list_reduce(list_prepend([]::STRUCT(x INT, y INT, w INT, h INT)[], list_transform(list_sort(list({'x': x, 'y': y, 'w': w, 'h': h})), lambda b: [b])),
    lambda acc, one: CASE WHEN len(list_filter(acc, lambda q: abs(q.x - one[1].x) < 6 AND abs(q.y - one[1].y) < 6 AND abs(q.w - one[1].w) < 6 AND abs(q.h - one[1].h) < 6)) > 0 THEN acc ELSE list_concat(acc, one) END) AS kept
  FROM %s GROUP BY page)"""

_OK = "(ink_frac BETWEEN 0.008::DOUBLE AND 0.28::DOUBLE AND line_ratio <= 0.60::DOUBLE AND small_components >= 35 AND largest_cc_ratio <= 0.22::DOUBLE AND edge_frac >= 0.02::DOUBLE)"
_PICK = f"""
scored AS (SELECT *, count(*) OVER (PARTITION BY folder) AS n, row_number() OVER (PARTITION BY folder ORDER BY pos DESC) AS back FROM ({X.SCORES})),
cand AS (SELECT * FROM scored WHERE back <= 6 AND readable),
best AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY table_line_ratio DESC, ink_ratio DESC, back) AS r FROM cand),
picked AS (
  SELECT s.folder, max(s.n) AS n_images, min(s.pos) AS front,
    coalesce((SELECT max(pos) FROM cand c WHERE c.folder = s.folder AND ink_ratio >= 0.006::DOUBLE AND table_line_ratio >= 0.002::DOUBLE),
             (SELECT CASE WHEN ink_ratio < 0.006::DOUBLE THEN NULL ELSE pos END FROM best b WHERE b.folder = s.folder AND r = 1), max(s.pos) FILTER (back = 2)) AS back
  FROM scored s GROUP BY s.folder HAVING max(s.n) >= 2
)"""

_PAGE_ROWS = _row(["row_number() OVER (PARTITION BY file, page ORDER BY image)", *[_md(c) for c in ("image", "serial_no", "epic_no")], "CASE WHEN epic_valid THEN 'Y' ELSE 'N' END", *[_md(c) for c in ("name", "relation_type", "relation_name", "house_no", "age", "gender")]])
_MD_LINES = f"""
li AS (SELECT k, line_num, '- **b1/p1/l' || line_num || '**: ' || {_md("string_agg(t, ' ' ORDER BY x, pos)")} AS item FROM (SELECT *, {_strip('text')} AS t FROM rw) WHERE t <> '' GROUP BY k, line_num),
items AS (SELECT k, string_agg(item, chr(10) ORDER BY line_num) AS items FROM li GROUP BY k)"""
_RAW = f"""raw AS (SELECT 'f' || k // 500 AS file, 'p' || (k % 50) AS page, k::VARCHAR AS image, {_text(["'## p' || (k % 50) || ' / ' || k", "''", "'- **File**: f' || k // 500", "'- **Languages**: eng'", "'- **Tesseract config**: `--psm 6`'", "''", "'### Text by line'", "''", "items", "''"])} AS markdown FROM items)"""
_PAGES = "pages AS (SELECT file, page, count(*) AS n FROM records GROUP BY file, page)"
_URL = "SELECT id, CASE WHEN id % 11 = 0 THEN ' ' ELSE CASE WHEN id % 3 = 0 THEN ' ' ELSE '' END || 'https://h/v1' || CASE WHEN id % 2 = 0 THEN '/openai' ELSE '' END || CASE WHEN id % 5 = 0 THEN '/chat/completions' ELSE '' END || CASE WHEN id % 7 = 0 THEN '//' ELSE '' END END AS url FROM (" + X.FILES + ")"
_TRIMMED = "rtrim(trim(url), '/')"


def _house_tokens(e: str) -> str:
    """House-like tokens of a raw value before its first photo marker."""
    cut = f"list_min(list_filter([{', '.join(f'instr({_match(e)}, {_q(m)})' for m in _MARKS)}], lambda p: p > 0))"
    head = f"upper(CASE WHEN {cut} IS NULL THEN {e} ELSE {_strip(f'substr({e}, 1, {cut} - 1)')} END)"
    parts = f"regexp_split_to_array(translate({_sub(head, f'[^A-Z0-9/{chr(92)}-{_SP}]', ' ')}, 'OI', '01'), {_q(f'[{_SP}]+')})"
    bare = f"list_transform({parts}, lambda t: regexp_replace(t, '^[/-]+|[/-]+$', '', 'g'))"
    return f"list_filter({bare}, lambda t: regexp_full_match(t, '[0-9][0-9A-Z/\\-]{{0,11}}') AND NOT {_any(lambda b: f'contains(t, {_q(b)})', L.HOUSE_BAD_SUBSTRINGS)})"


def _house_value(e: str) -> str:
    """The token with most digits, then the longest, then the first."""
    ranked = f"list_transform({_house_tokens(e)}, lambda t, i: {{'d': length(regexp_replace(t, '[^0-9]', '', 'g')), 'n': length(t), 'i': -i, 't': t}})"
    return f"coalesce(list_max({ranked}).t, '')"


_MALE = lambda g: _any(lambda v: f"contains({g}, {_q(v)})", ("male", "ஆண்", "ஆண"))
_FEMALE = lambda g: _any(lambda v: f"contains({g}, {_q(v)})", ("female", "பெண்", "பெண"))



def _gender_value(e: str) -> str:
    low = f"lower({e})"
    return f"""CASE WHEN {e} = '' OR {_photo(e)} THEN '' WHEN {_MALE(low)} THEN 'Male' WHEN {_FEMALE(low)} THEN 'Female' WHEN {_strip(low)} = 'm' THEN 'Male' WHEN {_strip(low)} = 'f' THEN 'Female' ELSE '' END"""


def _bare_name(e: str) -> str:
    return _strip(_sub(_sub(_strip(e), f"(?i)^(?:name)[{_SP}]*{T.DASH}?[{_SP}]*", "", ""), f"^(?:பெயர்)[{_SP}]*{T.DASH}?[{_SP}]*", "", ""))


def _tokens() -> str:
    """(field, most, vi, ti, n, token) of every label variant."""
    from docengine.functions.fields import tokenize_label

    wanted = {"name": (L.NAME_LABELS, 80), "house": (L.HOUSE_LABELS, 80), "age": (L.AGE_LABELS, 6), "gender": (L.GENDER_LABELS, 12), **{k: (v, 80) for k, v in L.RELATION_LABELS.items()}}
    rows = [
        f"({_q(f)}, {most}, {vi}, {ti}, {len(tokens)}, {_q(t)})"
        for f, (variants, most) in wanted.items() for vi, tokens in enumerate(map(tokenize_label, variants)) for ti, t in enumerate(tokens)
    ]
    return "tok(field, most, vi, ti, n, token) AS (VALUES " + ", ".join(rows) + ")"


def _value(source: str, start: str) -> str:
    """Words of ``source`` (field, k, most, t, stop, x, i) from a start on, up to the first that stops or overflows."""
    return f"""(SELECT field, k, string_agg(t, ' ' ORDER BY x, i) AS v FROM (
  SELECT *, bool_or(stop OR total > most) OVER (PARTITION BY field, k ORDER BY x, i) AS ended FROM (
    SELECT *, sum(length(t) + 1) OVER (PARTITION BY field, k ORDER BY x, i) AS total FROM {source} WHERE x >= {start} AND t NOT IN ({', '.join(map(_q, L.LABEL_SEPARATORS))})))
  WHERE NOT ended GROUP BY field, k)"""


_MARKED = "(" + " OR ".join(f"contains(replace({{0}}, '0', 'o'), {_q(m)})" for m in _MARKS) + ")"
_SPANS = f"""
rec AS ({X.RECORDS}), {_REC_WORDS}, {_tokens()},
w AS (
  SELECT *, row_number() OVER (PARTITION BY k, line_num ORDER BY x, i) AS p, min(i) OVER (PARTITION BY k, line_num) AS first_i FROM (
    SELECT k, line_num, i, x, y, w, h, t, {_norm('t')} AS norm, {_match('t')} <> '' AND {_any(lambda q: f"contains({_match('t')}, {_q(q)}) OR contains({_q(q)}, {_match('t')})", _STOPS)} AS stop
    FROM (SELECT *, {_strip('text')} AS t FROM rw) WHERE t <> '')
), hit AS (
  SELECT field, most, k, line_num, first_i, vi, n, p - ti AS spot FROM w JOIN tok ON norm <> '' AND (contains(norm, token) OR contains(token, norm)) GROUP BY ALL HAVING count(DISTINCT ti) = n
), span AS (
  SELECT h.field, h.most, h.k, h.line_num, a.i AS first, a.y, a.h, b.i AS last, greatest(0, b.x + b.w - 5) AS start
  FROM (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY field, k ORDER BY first_i, vi, spot) = 1) h
  JOIN w a ON a.k = h.k AND a.line_num = h.line_num AND a.p = h.spot JOIN w b ON b.k = h.k AND b.line_num = h.line_num AND b.p = h.spot + h.n - 1
)"""
_LABELLED = f"""{_SPANS},
own AS (SELECT s.field, s.most, s.start, w.* FROM span s JOIN w ON w.k = s.k AND w.line_num = s.line_num),
below AS (SELECT s.field, s.most, w.*, min(w.y) OVER (PARTITION BY s.field, s.k) AS top FROM span s JOIN w ON w.k = s.k AND w.y > s.y + trunc(s.h * 0.6::DOUBLE) AND w.y <= s.y + trunc(s.h * 0.6::DOUBLE) + 60),
near AS (SELECT * FROM below WHERE abs(y - top) <= 10),
own_photo AS (SELECT field, k, {_MARKED.format("string_agg(norm, '' ORDER BY x, i)")} AS photo FROM own GROUP BY field, k),
near_photo AS (SELECT field, k, {_MARKED.format("string_agg(norm, '' ORDER BY x, i)")} AS photo FROM near GROUP BY field, k),
val AS (
  SELECT s.field, s.k, CASE WHEN o.photo THEN '' WHEN a.v <> '' THEN a.v WHEN q.photo THEN '' ELSE coalesce(b.v, '') END AS v
  FROM span s JOIN own_photo o USING (field, k) LEFT JOIN near_photo q USING (field, k) LEFT JOIN {_value('own', 'start')} a USING (field, k) LEFT JOIN {_value('near', '0')} b USING (field, k)
), raw_fields AS (
  SELECT k.k, {", ".join(f"coalesce((SELECT v FROM val WHERE val.k = k.k AND field = '{f}'), '') AS v_{f}" for f in ("name", "house", "age", "gender", *L.RELATION_LABELS))} FROM (SELECT DISTINCT k FROM w) k
), by_words AS (
  SELECT k, v_name AS name, {_house_value('v_house')} AS house_no, regexp_replace(v_age, '[^0-9]', '', 'g') AS age, {_gender_value('v_gender')} AS gender,
    CASE {" ".join(f"WHEN {_bare_name(f'v_{f}')} <> '' THEN '{f}'" for f in L.RELATION_LABELS)} ELSE '' END AS relation_type,
    {_first([_bare_name(f"v_{f}") for f in L.RELATION_LABELS])} AS relation_name
  FROM raw_fields
)"""
_JOINED = _STEPS.replace(f"rec AS ({X.RECORDS}),", "", 1)

_ANSWERS = f"ans AS ({X.RESPONSES}), got AS (SELECT event_id, content, event_id % 6 NOT IN (3) AS parsed, CASE event_id % 6 WHEN 4 THEN '[1, {{\"a\": \"}}\"}}]' WHEN 3 THEN NULL ELSE regexp_extract(content, '(\\{{\"k\".*\\}})', 1) END AS json FROM ans)"

_SECONDS = "k % 64 / 8.0::DOUBLE"
_INT = lambda e: f"CASE WHEN json_type({e}) NOT IN ('OBJECT', 'ARRAY') AND regexp_full_match(replace(json_extract_string({e}, '$'), ',', ''), '[+-]?[0-9]+') THEN replace(json_extract_string({e}, '$'), ',', '')::BIGINT END"
_BOOL = lambda e: f"CASE WHEN lower(json_extract_string({e}, '$')) IN ('true', 'yes', '1') THEN true WHEN lower(json_extract_string({e}, '$')) IN ('false', 'no', '0') THEN false END"
_TYPED_FIELDS = {
    "year": ("document_metadata.electoral_roll_year", None, _INT), "page": ("document_metadata.page_number_current", "document_metadata.page_number", _INT),
    "assembly": ("constituency_details.assembly_constituency_number", "constituency.assembly_constituency_number", _INT),
    "electors": ("detailed_elector_summary.net_total.total", "elector_summary.total_electors", _INT), "signed": ("authority_verification.signature_present", "authority.signature_present", _BOOL),
}


def _typed_value(path: str, older: str | None) -> str:
    at = [f"CASE WHEN json_type(doc, '$.{p}') <> 'NULL' THEN json_extract(doc, '$.{p}') END" for p in (path, older) if p]
    return f"coalesce({', '.join(at)})"


_TYPED = f"""WITH m AS (SELECT k, CASE WHEN json_valid(document) THEN document::JSON END AS doc FROM ({X.METADATA})),
v AS (SELECT k, doc IS NOT NULL AS parsed, {', '.join(f"{_typed_value(p, o)} AS v_{n}" for n, (p, o, _) in _TYPED_FIELDS.items())} FROM m),
t AS (SELECT *, {', '.join(f"{kind(f'v_{n}')} AS {n}" for n, (_, _, kind) in _TYPED_FIELDS.items())} FROM v)
SELECT k, parsed, {', '.join(f"{n}::VARCHAR AS {n}" if n == "signed" else n for n in _TYPED_FIELDS)}, concat_ws(';', {', '.join(f"CASE WHEN v_{n} IS NOT NULL AND {n} IS NULL THEN {_q(p + '=')} || v_{n}::VARCHAR END" for n, (p, _, _) in _TYPED_FIELDS.items())}) AS misfit FROM t"""
_CHANGED = f"""WITH r AS (SELECT * FROM ({X.RECORDS})), now AS (SELECT file, page, string_agg(image || ':' || k, ',' ORDER BY image) AS f FROM r GROUP BY file, page),
b AS (SELECT file, page, image, k + CASE WHEN k % 170 = 3 THEN 1 ELSE 0 END AS n FROM r WHERE file <> 'file-1' UNION ALL SELECT file, page || '-old', image, k FROM r WHERE k % 37 = 0),
l AS (SELECT file, page, string_agg(image || ':' || n, ',' ORDER BY image) AS f FROM b WHERE file <> 'file-2' GROUP BY file, page)
SELECT file, page, CASE WHEN l.f IS NULL THEN 'new' WHEN now.f IS NULL THEN 'gone' ELSE 'changed' END AS change FROM now FULL JOIN l USING (file, page) WHERE now.f IS DISTINCT FROM l.f"""
_NAMES_AGAIN = f"""WITH RECURSIVE {_FILES}, c AS (SELECT file, page AS page_id, stem AS page_base, id AS path_pos, unnest([1, 2]) AS i FROM files WHERE kind <> 'text'),
w AS (SELECT *, ltrim(substr(page_base, length(page_id) + 1), '-_') AS extra, page_id || printf('-%03d.png', i) AS plain FROM c),
e AS (SELECT *, row_number() OVER (PARTITION BY file, page_id, i ORDER BY path_pos) AS r FROM w WHERE path_pos % 3 = 0),
old AS (SELECT DISTINCT file, page_id, CASE WHEN r > 1 AND extra <> '' THEN page_id || '-' || extra || printf('-%03d.png', i) ELSE plain END AS name FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY file, page_id, i ORDER BY path_pos) AS r, extra <> '' AND page_base <> page_id AS able, page_id || '-' || extra || printf('-%03d.png', i) AS longer FROM w),
-- crop by crop, with the names on disk as state
s AS (
  SELECT o.*, old.name IS NOT NULL AS there FROM o LEFT JOIN old ON o.file = old.file AND o.page_id = old.page_id AND o.plain = old.name WHERE r = 1
  UNION ALL SELECT o.*, s.there OR NOT (s.there AND s.able) FROM s JOIN o ON o.file = s.file AND o.page_id = s.page_id AND o.i = s.i AND o.r = s.r + 1
), m AS (SELECT *, CASE WHEN there AND able THEN longer ELSE plain END AS crop_name FROM s)
SELECT file, page_id, path_pos, i, crop_name FROM m QUALIFY row_number() OVER (PARTITION BY file, page_id, crop_name ORDER BY path_pos DESC) = 1"""

ORACLES = {
    "page_report": f"WITH {_STEPS} {_REPORT}",
    "records": f"WITH {_STEPS} SELECT * FROM records",
    "strict_gender": f"WITH rec AS ({X.RECORDS}) SELECT k, {_first([_gender(e, True) for e in _LINES])} AS gender FROM rec",
    "files_safe_stem": f"SELECT id, regexp_replace(folder_name, '[^\\p{{L}}\\p{{N}}\\-_.]', '_', 'g') AS safe_stem FROM ({X.FILES})",
    "files_page_id": f"WITH {_FILES} SELECT id, page AS page_id FROM files",
    "files_page_images": f"WITH {_FILES} SELECT id, path FROM files WHERE kind = 'images' AND ({_known('ext')} OR (ext = upper(ext) AND {_known('lower(ext)')}))",
    "files_crop_images": f"WITH {_FILES} SELECT id, path FROM files WHERE lower(ext) IN ({', '.join(map(_q, L.CROP_EXTENSIONS))})",
    "files_scan_images": f"WITH {_FILES} SELECT id, file, row_number() OVER (PARTITION BY file ORDER BY lower(name || '#' || id), name || '#' || id) AS pos FROM files WHERE kind = 'images' AND {_known('lower(ext)')}",
    "files_folders": f"WITH {_FILES} SELECT DISTINCT file, kind FROM files WHERE kind IN ('images', 'crops')",
    "files_page_folders": f"WITH {_FILES} SELECT DISTINCT file, page FROM files WHERE kind = 'crops'",
    "files_resolved": f"WITH {_FILES} SELECT id, file, page FROM files f WHERE in_images = (SELECT max(in_images) FROM files g WHERE g.file = f.file AND g.page = f.page)",
    "files_names": f"SELECT id, printf('page-%03d-img-%02d.%s', id % 1200, id % 150, CASE WHEN id % 7 = 0 THEN 'bin' ELSE lower(ext) END) AS embedded, printf('page-%03d.png', id % 1200) AS rendered FROM ({X.FILES})",
    "files_combined_text": "SELECT conv_id::VARCHAR AS input_pdf, length(string_agg(text, chr(10) ORDER BY turn, text)) AS n_combined, md5(string_agg(text, chr(10) ORDER BY turn, text)) AS digest, count(*) AS pages, sum(length(text)) AS chars FROM conversations GROUP BY conv_id",
    "files_manifest": """WITH p AS (SELECT DISTINCT conv_id::VARCHAR AS input_pdf, turn::INT AS page FROM conversations)
SELECT input_pdf, count(*) AS pages, string_agg(printf('page-%03d.png', page), ',' ORDER BY page) AS rendered,
  string_agg(printf('embedded_images/page-%03d-img-01.%s', page, CASE WHEN page % 3 = 0 THEN 'bin' ELSE 'png' END), ',' ORDER BY page) FILTER (page % 4 > 0) AS images FROM p GROUP BY input_pdf""",
    "files_data_url": f"SELECT id, 'data:image/' || CASE WHEN lower(ext) IN ('jpg', 'jpeg') THEN 'jpeg' ELSE lower(ext) END || ';base64,' || base64(stem::BLOB) AS url FROM ({X.FILES})",
    "files_crop_names": f"""WITH {_FILES}, c AS (SELECT file, page AS page_id, stem AS page_base, id AS path_pos, unnest([1, 2]) AS i FROM files WHERE kind <> 'text'),
n AS (SELECT *, row_number() OVER (PARTITION BY file, page_id, i ORDER BY path_pos) AS r, ltrim(substr(page_base, length(page_id) + 1), '-_') AS extra FROM c),
m AS (SELECT *, page_id || CASE WHEN r > 1 AND page_base <> page_id AND extra <> '' THEN '-' || extra ELSE '' END || printf('-%03d.png', i) AS crop_name FROM n)
SELECT file, page_id, path_pos, i, crop_name FROM m QUALIFY row_number() OVER (PARTITION BY file, page_id, crop_name ORDER BY path_pos DESC) = 1""",
    "words_confident": f"WITH {_WORDS} SELECT doc_id, count(*) AS n, count(*) FILTER ((conf = -1 OR conf >= 20 OR regexp_matches(text, '[{T.TAMIL}]')) AND {_strip('text')} <> '') AS n_usable FROM words GROUP BY doc_id",
    "words_lines": f"WITH {_WORDS} SELECT doc_id, line_num, md5(string_agg(t, ' ' ORDER BY x, i)) AS line FROM (SELECT *, {_strip('text')} AS t FROM words) WHERE t <> '' GROUP BY doc_id, line_num",
    "words_group_lines": f"WITH {_WORDS}, l AS (SELECT doc_id, line_num, sum(length(t)) + count(*) - 1 AS n FROM (SELECT *, {_strip('text')} AS t FROM words) WHERE t <> '' GROUP BY ALL) SELECT doc_id, count(*) AS lines, sum(n) AS chars FROM l GROUP BY doc_id",
    "words_exploded": f"WITH {_WORDS}, p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_num, i) - 1 AS place FROM words) SELECT doc_id, count(*) AS n, max(place) AS last, sum(place * x) AS weighed, sum(conf) AS conf FROM p GROUP BY doc_id",
    "words_next_line": f"""WITH rec AS ({X.RECORDS}), {_REC_WORDS}, w AS (SELECT *, {_strip('text')} AS t FROM rw WHERE text <> ''), f AS (SELECT k, min(i) AS i FROM w WHERE t <> '' GROUP BY k),
h AS (SELECT w.k, w.y + 12 AS cut FROM w JOIN f USING (k, i)), b AS (SELECT w.*, min(y) OVER (PARTITION BY w.k) AS top FROM w JOIN h USING (k) WHERE t <> '' AND y > cut AND y <= cut + 60)
SELECT f.k, coalesce((SELECT string_agg(t, ' ' ORDER BY x, i) FROM b WHERE b.k = f.k AND abs(y - top) <= 10), '') AS line FROM f""",
    "codes_epic": f"SELECT k, {_epic('raw')} AS epic_no, {_VALID.format(_epic('raw'))} AS epic_valid FROM ({X.CODES})",
    "codes_serial": f"SELECT k, {_bare(_LAST4)} AS serial, {_fold('b2', 'r2')} AS folded FROM (SELECT *, {_fold('b1', 'r1')} AS b2 FROM (SELECT *, {_fold(chr(39) * 2, 'r0')} AS b1 FROM ({X.CODES})))",
    "codes_numbers": f"SELECT k, coalesce(trunc(TRY_CAST(number AS DOUBLE))::INT, -1) AS number, {_CODE_DIGITS} AS digits, translate({_sub('upper(raw)', '[^A-Z0-9/-]')}, 'OI', '01') AS house FROM ({X.CODES})",
    "text_normalized": f"""SELECT k, {_norm('l0')} AS n0, {_match('l2')} AS m2, {_line('l0')} AS line,
  {_strip(_sub(_sub(_strip('l0'), f'(?i)^(?:name)[{_SP}]*{T.DASH}?[{_SP}]*', '', ''), f'^(?:பெயர்)[{_SP}]*{T.DASH}?[{_SP}]*', '', ''))} AS bare, {_md("l0 || '|' || l2 || chr(13) || chr(10) || ' '")} AS md FROM ({X.RECORDS})""",
    "text_markers": f"SELECT k, {_photo('l0')} AS photo, {_match('l2')} <> '' AND {_any(lambda s: f'contains({_match("l2")}, {_q(s)}) OR contains({_q(s)}, {_match("l2")})', _STOPS)} AS stop, CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS yn FROM ({X.RECORDS})",
    "text_value_after_colon": f"SELECT k, {_after('l0', L.NAME_PATTERN)} AS name, {_after('l2', L.HOUSE_PATTERN)} AS house FROM ({X.RECORDS})",
    "text_house_value": f"""SELECT k, {_house_value('l2')} AS house, {_gender_value('l3')} AS gender,
  CASE WHEN {_MALE('lower(l3)')} THEN 'Male' WHEN {_FEMALE('lower(l3)')} THEN 'Female' ELSE {_strip('l3')} END AS gender_raw FROM ({X.RECORDS})""",
    "text_urls": f"SELECT id, CASE WHEN {_TRIMMED} LIKE '%/openai' THEN {_TRIMMED} || '/chat/completions' ELSE {_TRIMMED} END AS chat, CASE WHEN trim(url) = '' THEN '' ELSE rtrim(regexp_replace({_TRIMMED}, '/chat/completions$', ''), '/') || '/' END AS base FROM ({_URL})",
    "boxes_plausible": f"SELECT page, count(*) AS n, sum(x) AS x FROM ({X.BOXES}) WHERE {_BOX_TEST} GROUP BY page",
    "boxes_deduped": f"WITH b AS ({X.BOXES}) {_DEDUPE % 'b'}",
    "boxes_contained": f"WITH b AS ({X.BOXES}) {_contained('b')}",
    "boxes_order": f"WITH b AS (SELECT DISTINCT * FROM ({X.BOXES})), o AS ({_order('b')}) SELECT *, min(r) OVER (PARTITION BY page, x, y, w, h) AS ord FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY row_id, x, y, w, h) AS r FROM o)".replace("SELECT *, min(r)", "SELECT * EXCLUDE (r), min(r)"),
    "boxes_numbered": f"""WITH b AS (SELECT page, x, y, w, h, max(n_vertices) AS n_vertices FROM ({X.BOXES}) GROUP BY ALL), o AS ({_order('b')}), n AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY row_id, x, y, w, h) AS i FROM o)
SELECT page, i, greatest(0, x - 3) AS x1, greatest(0, y - 3) AS y1, least(700, x + w + 3) AS x2, least(900, y + h + 3) AS y2 FROM n WHERE least(700, x + w + 3) > greatest(0, x - 3) AND least(900, y + h + 3) > greatest(0, y - 3)""",
    "boxes_detected": f"WITH p AS (SELECT * FROM ({X.BOXES}) WHERE {_BOX_TEST}), d AS ({_DEDUPE % 'p'}), c AS ({_contained('d')}), o AS ({_order('c')}) SELECT *, row_number() OVER (PARTITION BY page ORDER BY row_id, x, y, w, h) AS ord FROM o",
    "boxes_scaled": f"SELECT page, {', '.join(f'round_even({c} * 2.5::DOUBLE, 0)::INT AS {c}' for c in 'xywh')} FROM ({X.BOXES})",
    "boxes_region": f"""SELECT page, w, h, greatest(0, least(w - 1, round_even(0.15::DOUBLE * w, 0)::INT)) AS X1, greatest(1, least(w, round_even(0.329::DOUBLE * w, 0)::INT)) AS X2,
  greatest(0, least(h - 1, round_even(0.06::DOUBLE * h, 0)::INT)) AS Y1, greatest(1, least(h, round_even(0.2::DOUBLE * h, 0)::INT)) AS Y2 FROM ({X.BOXES})""",
    "crops_strict": f"SELECT page, count(*) AS n, sum(i) AS i FROM ({X.METRICS}) WHERE {_OK} GROUP BY page",
    "crops_auto": f"""WITH m AS (SELECT *, {_OK} AS ok FROM ({X.METRICS})), p AS (SELECT page, bool_or(ok) AS kept, avg(small_components) <= 14 OR avg(line_ratio) >= 0.70::DOUBLE OR avg(largest_cc_ratio) >= 0.35::DOUBLE OR avg(edge_frac) <= 0.015::DOUBLE AS clear FROM m GROUP BY page)
SELECT page, count(*) AS n, sum(i) AS i FROM m JOIN p USING (page) WHERE ok OR (NOT kept AND NOT clear) GROUP BY page""",
    "crops_post": f"SELECT page, count(*) AS n, sum(i) AS i FROM ({X.METRICS}) WHERE post_edge_frac >= 0.02::DOUBLE GROUP BY page",
    "pages_back": f"WITH {_PICK} SELECT * FROM picked",
    "pages_dry_run": f"WITH {_PICK} SELECT *, '(default)' AS provider FROM picked",
    "pages_limit": f"WITH rec AS ({X.RECORDS}) SELECT file, count(*) AS n FROM rec WHERE file IN (SELECT DISTINCT file FROM rec ORDER BY file LIMIT 3) GROUP BY file",
    "pages_limit_pages": f"WITH rec AS ({X.RECORDS}) SELECT file, page, count(*) AS n FROM rec WHERE file = 'file-3' AND page IN (SELECT DISTINCT page FROM rec WHERE file = 'file-3' ORDER BY page LIMIT 2) GROUP BY file, page",
    "pages_resume": f"WITH rec AS ({X.RECORDS}) SELECT file, count(*) AS n FROM rec WHERE file NOT IN (SELECT file FROM rec WHERE page = 'page-7' AND k % 7 = 0) GROUP BY file",
    "model_cost": f"""SELECT k, CASE WHEN has_usage AND (input_cost IS NOT NULL OR output_cost IS NOT NULL) THEN 0.0::DOUBLE
  + CASE WHEN input_cost IS NOT NULL THEN coalesce(prompt_tokens, 0) / 1000000.0::DOUBLE * input_cost::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN output_cost IS NOT NULL THEN coalesce(completion_tokens, 0) / 1000000.0::DOUBLE * output_cost::DOUBLE ELSE 0.0::DOUBLE END END AS cost FROM ({X.USAGE})""",
    "model_json": f"WITH {_ANSWERS} SELECT event_id, parsed, CASE WHEN event_id % 6 = 4 THEN NULL ELSE json_extract_string(json, '$.k') END AS value FROM got",
    "model_documents": f"WITH {_ANSWERS} SELECT event_id, 'm' AS model, '6515' AS tokens, CASE WHEN event_id % 6 = 4 THEN '1' END AS data FROM got WHERE parsed",
    "model_failures": f"WITH {_ANSWERS} SELECT event_id, content FROM got WHERE NOT parsed",
    "model_sidecars": f"WITH {_ANSWERS} SELECT event_id::VARCHAR AS file, concat_ws(chr(10), {_q('ERROR: ' + L.NO_JSON)}, 'front=1', 'back=' || (event_id % 5 + 2), '', '--- MODEL OUTPUT (raw) ---', content) AS text FROM got WHERE NOT parsed",
    "model_files": f"WITH {_ANSWERS} SELECT event_id || CASE WHEN parsed THEN '.json' ELSE '.raw.txt' END AS path FROM got",
    "grid_records": f"""WITH r AS (SELECT k::VARCHAR AS image, {_sub('r0', '[^0-9]')} AS serial_no, {_epic('raw')} AS epic_no, 'N' || k AS name, 'F' AS father_name,
  translate({_sub('upper(raw)', '[^A-Z0-9/-]')}, 'OI', '01') AS house_no, {_sub('number', '[^0-9]')} AS age, CASE k % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Male' WHEN 2 THEN 'x' ELSE '' END AS gender FROM ({X.CODES}))
SELECT *, '- Serial No: **' || serial_no || '**' || chr(10) || '- EPIC No: **' || epic_no || '**' || CASE WHEN epic_no = '' OR {_VALID.format('epic_no')} THEN '' ELSE '  *(check EPIC)*' END
  || chr(10) || '- Name: ' || name || chr(10) || '- Father Name: ' || father_name || chr(10) || '- House No: ' || house_no || chr(10) || '- Age: ' || age || chr(10) || '- Gender: ' || gender || chr(10) AS markdown FROM r""",
    "page_texts": f"SELECT k, CASE WHEN k % 7 = 0 THEN {_q(L.READ_ERROR)} || 'boom ' || k || ']' WHEN k % 3 = 0 OR {_strip('raw')} = '' THEN {_q(L.NO_TEXT)} ELSE {_strip('raw')} END AS text FROM ({X.CODES})",
    "words_older_label": f"WITH {_SPANS} SELECT k, min(i) FILTER (norm <> '' AND {_any(lambda q: f'contains(norm, {_q(q)}) OR contains({_q(q)}, norm)', sorted({T.normalize_py(v) for v in L.HOUSE_LABELS} - {''}))}) AS i FROM w GROUP BY k",
    "crops_cut": """WITH s AS (SELECT 'f' || s_suppkey // 20 AS file, printf('page-%03d', s_suppkey % 20) AS page, s_suppkey AS path_pos, unnest(generate_series(1, (s_suppkey % 3 + 1) * 2)) AS i FROM supplier)
SELECT *, page || printf('-%03d.png', i) AS crop_name FROM s""",
    "output_pages": f"WITH {_STEPS} SELECT file, page, count(*) AS images_count, 0.65::DOUBLE AS x1, string_agg(concat_ws(',', image, epic_no, house_no), ';' ORDER BY image) AS records FROM records GROUP BY file, page",
    "output_files": f"WITH {_STEPS}, {_PAGES} SELECT file AS folder, count(*) AS pages_count, sum(n) AS images_count, string_agg(page || ':' || n, ';' ORDER BY page) AS pages FROM pages GROUP BY file",
    "output_page_markdown": f"""WITH {_STEPS}, rep AS ({_REPORT}), rows AS (SELECT file, page, image, {_PAGE_ROWS} AS r FROM records), body AS (SELECT file, page, string_agg(r, chr(10) ORDER BY image) AS body FROM rows GROUP BY file, page)
SELECT file, page, {_text(["'# OCR Preview'", "''", "'- **File**: ' || file", "'- **Page**: ' || page", "'- **Images**: ' || total", "'- **Languages**: eng+tam'", "'- **Allow next line**: Y'", "'- **Records**: ' || total", "''", "'## Quick stats'", "''",
    "'- EPIC valid: ' || epic_valid_count || '/' || total", *[f"'- Missing {t}: ' || missing_{c} || '/' || total" for t, c in (("name", "name"), ("EPIC", "epic"), ("house no", "house"), ("age", "age"), ("gender", "gender"))], "''", "'## Records'", "''",
    "'| # | image | serial | epic | epic_valid | name | relation_type | relation_name | house_no | age | gender |'", "'|---:|---|---|---|:---:|---|---|---|---|---|---|'", "body", "''"])} AS markdown FROM rep JOIN body USING (file, page)""",
    "output_file_markdown": f"""WITH {_STEPS}, {_PAGES} SELECT file AS folder, {_text(["'# OCR Preview (File)'", "''", "'- **Folder**: ' || file", "'- **Pages**: ' || count(*)", "'- **Images**: ' || sum(n)", "'- **Languages**: eng+tam'", "'- **Allow next line**: Y'", "''", "'## Pages'", "''",
    "'| page | images_processed | avg_seconds_per_image | records | page_json |'", "'|---|---:|---:|---:|---|'", "string_agg('| ' || page || ' | ' || n || ' | 0.0 | ' || n || ' | page_wise/' || page || '.json |', chr(10) ORDER BY page)", "''"])} AS markdown FROM pages GROUP BY file""",
    "output_raw_text": f"WITH rec AS ({X.RECORDS}), {_REC_WORDS}, {_MD_LINES}, {_RAW} SELECT * FROM raw",
    "output_raw_detail": f"""WITH rec AS ({X.RECORDS}), {_REC_WORDS}, {_MD_LINES},
tok AS (SELECT k, count(*) AS n, string_agg(CASE WHEN {_strip('text')} <> '' THEN {_row(["i", _md(_strip('text')), "conf", "x", "y", "w", "h", "1", "1", "line_num", "pos + 1"])} END, chr(10) ORDER BY i) AS rows FROM rw GROUP BY k)
SELECT k::VARCHAR AS image, {_text(["'# Raw OCR Dump (Detailed)'", "''", "'- **File**: f' || k // 500", "'- **Page**: p' || (k % 50)", "'- **Image**: ' || k", "'- **Languages**: eng'", "'- **Tesseract config**: `--psm 6`'", "'- **Token rows**: ' || n", "'- **Conf (min..max)**: 90..90'", "''",
    "'## Text by line (as Tesseract tokens)'", "''", "items", "''", "'## Tokens'", "''", "'| i | text | conf | left | top | width | height | block | par | line | word |'", "'|---:|---|---:|---:|---:|---:|---:|---:|---:|---:|---:|'", "rows", "''"])} AS markdown FROM tok LEFT JOIN items USING (k)""",
    "output_raw_file": f"""WITH rec AS ({X.RECORDS}), {_REC_WORDS}, {_MD_LINES}, {_RAW}, one AS (SELECT file, '# Raw OCR (Text Only)' || chr(10) || chr(10) || '- **File**: ' || file || chr(10) || '- **Languages**: eng' || chr(10) || '- **Tesseract config**: `--psm 6`' || chr(10) || string_agg(markdown, '' ORDER BY page, image) AS markdown FROM raw GROUP BY file)
SELECT file, length(markdown) AS chars, md5(markdown) AS digest FROM one""",
    "stats_timing": f"SELECT file, page, count(*) AS images_processed, round(sum(k % 64 / 8.0::DOUBLE), 4) AS total_seconds, round(sum(k % 64 / 8.0::DOUBLE) / count(*), 4) AS avg_seconds_per_image FROM ({X.RECORDS}) GROUP BY file, page",
    "stats_run": f"WITH f AS (SELECT file, count(*) AS n, round(sum(k % 64 / 8.0::DOUBLE), 4) AS s FROM ({X.RECORDS}) GROUP BY file) SELECT count(*) AS files, sum(n)::BIGINT AS images, round(sum(s) / sum(n), 4) AS avg_seconds FROM f",
    "words_label_span": f"WITH {_SPANS} SELECT k, s.first, s.last FROM (SELECT DISTINCT k FROM w) LEFT JOIN (SELECT * FROM span WHERE field = 'house') s USING (k)",
    "words_join_value": f"""WITH {_SPANS}, three AS (SELECT 'x' AS field, 24 AS most, * FROM w WHERE line_num = 3)
SELECT k, coalesce(v, '') AS value FROM (SELECT DISTINCT k FROM w) LEFT JOIN {_value('three', '60')} USING (k)""",
    "words_fields": f"WITH {_LABELLED} SELECT * FROM by_words",
    "words_records": f"""WITH {_LABELLED}, {_JOINED},
pick AS (
  SELECT r.k, CASE WHEN r.k % 97 = 0 THEN 'OCR failed: x' END AS error, {_epic("'xy8 ' || r.k")} AS epic_no, {_fold(_fold(chr(39) * 2, "'0'"), "right(r.k::VARCHAR, 2)")} AS folded, r.k::VARCHAR AS whole,
    coalesce(nullif(r.name, ''), b.name) AS name, CASE WHEN r.relation_name <> '' THEN r.relation_type ELSE b.relation_type END AS rt,
    {_bare_name("CASE WHEN r.relation_name <> '' THEN r.relation_name ELSE b.relation_name END")} AS rn,
    {_first(["r.house_no", "b.house_no", _house_value("('12o/' || r.k)")])} AS house_no, {_first(["r.age", "b.age"])} AS age, {_first(["r.gender", "b.gender"])} AS gender
  FROM records r JOIN by_words b USING (k)
)
SELECT k, error, coalesce(nullif(folded, ''), {_bare("right(whole, 4)")}) AS serial_no, epic_no, {_VALID.format('epic_no')} AS epic_valid, CASE WHEN error IS NULL THEN name END AS name,
  CASE WHEN error IS NULL THEN CASE WHEN rn <> '' AND {_photo('rn')} THEN '' ELSE rt END END AS relation_type, CASE WHEN error IS NULL THEN CASE WHEN rn <> '' AND {_photo('rn')} THEN '' ELSE rn END END AS relation_name,
  CASE WHEN error IS NULL THEN house_no END AS house_no, CASE WHEN error IS NULL THEN age END AS age, CASE WHEN error IS NULL THEN gender END AS gender
FROM pick""",
    "files_chosen": f"""WITH {_FILES}, c AS (SELECT * FROM files WHERE lower(ext) IN ({', '.join(map(_q, L.CROP_EXTENSIONS))})),
f AS (SELECT * FROM c WHERE file IN (SELECT DISTINCT file FROM c ORDER BY file LIMIT 25)), p AS (SELECT *, dense_rank() OVER (PARTITION BY file ORDER BY page) AS n FROM f)
SELECT id, file, page, path FROM p WHERE n <= 6 AND NOT EXISTS (SELECT 1 FROM files d WHERE d.id % 11 = 0 AND d.file = p.file AND d.page = p.page)""",
    "files_crop_names_again": _NAMES_AGAIN,
    "pages_changed": _CHANGED,
    "stats_levels": f"""WITH r AS (SELECT file, page, {_SECONDS} AS s, k % 9 <> 0 AS good FROM ({X.RECORDS}))
SELECT CASE WHEN grouping(file) = 1 THEN 'run' WHEN grouping(page) = 1 THEN 'file' ELSE 'page' END AS level, file, page, count(*) AS images, count(*) FILTER (good) AS ok, count(*) FILTER (NOT good) AS failed,
  round(sum(s), 4) AS total_seconds, round(sum(s) / count(*), 4) AS avg_seconds_per_image, round(CASE WHEN count(*) FILTER (good) > 0 THEN sum(s) / count(*) FILTER (good) ELSE 0 END * 1000, 1) AS ms_per_ok
FROM r GROUP BY GROUPING SETS ((file, page), (file), ())""",
    "output_raw_index": f"""WITH rec AS ({X.RECORDS}), {_REC_WORDS}, {_MD_LINES}, {_RAW},
p AS (
  SELECT DISTINCT file || '.md' AS path, 0 AS section, '' AS page, '' AS image, octet_length(encode('# Raw OCR (Text Only)' || chr(10) || chr(10) || '- **File**: ' || file || chr(10) || '- **Languages**: eng' || chr(10) || '- **Tesseract config**: `--psm 6`' || chr(10))) AS bytes FROM raw
  UNION ALL SELECT file || '.md', 1, page, image, octet_length(encode(markdown)) FROM raw
) SELECT path, page, image, (sum(bytes) OVER (PARTITION BY path ORDER BY section, page, image) - bytes)::BIGINT AS start, bytes FROM p""",
    "model_typed": _TYPED,
}
