"""DuckDB SQL for the operators that SQL can express: line dedup, near-duplicate classes, spelling variants, mixing."""

from __future__ import annotations

_BLANKS = r"[ \t\n\x0B\f\r]+"

#: Characters of scripts that are written without blanks.
_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"

LINE_DEDUP = rf"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, CAST(i AS INTEGER) AS line_no,
                 list_filter(regexp_split_to_array(regexp_replace(parts[i + 1], '({_UNSPACED})', ' \1 ', 'g'), '{_BLANKS}'), lambda x: x <> '') AS w
          FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM split) t),
long AS (SELECT * FROM lines WHERE len(w) >= 1),
firsts AS (SELECT w, min({{'d': doc_id, 'n': line_no}}) AS first FROM long GROUP BY w),
cut AS (SELECT w, first, len(w) AS n, i, w[1:i - 1] || w[i + 1:] AS rest
        FROM (SELECT w, first, unnest(range(1, len(w) + 1)) AS i FROM firsts WHERE len(w) >= 8) t),
near AS (
  SELECT a.w FROM cut a JOIN (SELECT rest, i, n, min(first) AS first FROM cut GROUP BY ALL) b USING (rest, i, n) WHERE b.first < a.first
  UNION SELECT CASE WHEN a.first < b.first THEN b.w ELSE a.w END FROM cut a JOIN firsts b ON a.rest = b.w WHERE len(b.w) >= 8),
dropped AS (
  SELECT l.doc_id, list(l.line_no) AS gone, count(*) FILTER (n.w IS NULL) AS n_equal, count(*) FILTER (n.w IS NOT NULL) AS n_near
  FROM long l JOIN firsts f ON l.w = f.w LEFT JOIN near n ON l.w = n.w
  WHERE n.w IS NOT NULL OR f.first <> {{'d': l.doc_id, 'n': l.line_no}} GROUP BY l.doc_id)
SELECT s.doc_id, CAST(len(parts) AS BIGINT) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near,
       array_to_string(list_filter(parts, lambda x, i: NOT coalesce(list_contains(gone, i - 1), false)), chr(10)) AS kept_text
FROM split s LEFT JOIN dropped d USING (doc_id)"""

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANKS}'),
                             lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                             ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k
           FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM reach r JOIN edges e ON r.id = e.a WHERE r.root < e.b),
classes AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN classes ON doc_id = id"""

#: CRC-32 by its table of 256 values, which follows from the polynomial.
_CRC = """
crc(t) AS (SELECT list(v ORDER BY i) FROM (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    codes = f"list_transform(range(octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295))"


SPELLING = rf"""
WITH RECURSIVE {_CRC},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
                translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
uses AS (SELECT d, r, count(*) AS c FROM runs WHERE length(r) >= 7 GROUP BY ALL),
summed AS (SELECT r, c, {_crc32("d || ':' || r")} AS h FROM uses, crc),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, sum(c) AS n
          FROM summed GROUP BY 1),
counts AS (SELECT word, CAST(n AS BIGINT) AS n FROM words WHERE length(word) >= 7 AND n >= 2),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counts),
gaps AS (SELECT word, n, i, substr(word, 1, i - 1) AS p, substr(word, i + 1) AS s FROM cut),
links AS (
  SELECT a.word AS a, b.word AS b, b.n AS n FROM gaps a JOIN gaps b ON a.p = b.p AND a.s = b.s WHERE a.word <> b.word
  UNION SELECT c.word, g.word, g.n FROM gaps g JOIN counts c ON g.p || g.s = c.word
  UNION SELECT g.word, c.word, c.n FROM gaps g JOIN counts c ON g.p || g.s = c.word),
near AS (SELECT a, count(*) AS n_near, min({{'n': -n, 'b': b}}) AS best FROM links GROUP BY a),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 10 * n THEN best.b END AS form,
                  CASE WHEN -best.n >= 10 * n THEN -best.n END AS form_n FROM counts LEFT JOIN near ON a = word),
steps(word, stop, k) AS (SELECT word, word, 0 FROM formed
                       UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN formed f ON s.stop = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, CAST(form_n AS BIGINT) AS form_n
FROM formed f JOIN (SELECT word, arg_max(stop, k) AS root FROM steps GROUP BY word) r USING (word)"""


def _mixing() -> str:
    cuts, state = [], "ranked"
    for k in range(2):
        fits = "NOT taken AND rank IS NOT NULL" + (" AND size * 8 <= rest" if k else "")
        cuts.append(f"""
run{k} AS (SELECT *, CASE WHEN {fits} THEN sum(CASE WHEN {fits} THEN size ELSE 0 END) OVER (
             PARTITION BY source ORDER BY rank, id, size, row ROWS UNBOUNDED PRECEDING) END AS upto{k} FROM {state}),
cut{k} AS (SELECT * REPLACE (taken OR coalesce(upto{k} <= rest, false) AS taken,
                             rest - coalesce(max(upto{k}) FILTER (upto{k} <= rest) OVER (PARTITION BY source), 0) AS rest) FROM run{k}),""")
        state = f"cut{k}"
    return rf"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '{_BLANKS}'), lambda x: x <> '')), 0) AS size,
                      row_number() OVER () AS row FROM documents),
sources AS (SELECT source, sum(size) AS s_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM sizes GROUP BY source),
filled AS (SELECT *, (1.5::DOUBLE * total - (held - cap)) / (open_w + w) AS level, row_number() OVER (ORDER BY s_size / w, source) AS k FROM (
  SELECT *, sum(s_size) OVER () AS total, 2.0::DOUBLE * s_size AS cap, sum(2.0::DOUBLE * s_size) OVER lower AS held, sum(w) OVER () - sum(w) OVER lower AS open_w
  FROM sources WINDOW lower AS (ORDER BY s_size / w, source ROWS UNBOUNDED PRECEDING)) t),
levels AS (SELECT arg_min(level, k) FILTER (cap >= level * w) AS level FROM filled),
targets AS (SELECT source, s_size, least(cap, levels.level * w) AS target FROM filled, levels),
parts AS (SELECT *, CASE WHEN s_size > 0 THEN CAST(floor(target / s_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
rests AS (SELECT *, target - whole * s_size AS rest, CASE WHEN s_size > 0 THEN (target - whole * s_size) / s_size ELSE 0.0 END AS p FROM parts),
ids AS (SELECT *, (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
               coalesce(CAST(doc_id AS VARCHAR), '') AS id FROM sizes),
ranked AS (SELECT i.*, s_size, target, whole, rest, false AS taken, CASE WHEN size > 0 AND p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS rank
           FROM ids i JOIN rests r ON i.source IS NOT DISTINCT FROM r.source),{"".join(cuts)}
lasts AS (SELECT source, min({{'off': abs(rest - size), 'rank': rank, 'id': id, 'size': size, 'row': row}}).row AS last FROM {state}
          WHERE NOT taken AND rank IS NOT NULL AND abs(rest - size) < rest GROUP BY source)
SELECT doc_id, size, CAST(s_size AS BIGINT) AS source_size, target,
       CAST((whole + CASE WHEN taken OR coalesce(row = last, false) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM {state} c LEFT JOIN lasts l ON c.source IS NOT DISTINCT FROM l.source"""


ORACLES: dict[str, str] = {"op3_line_dedup": LINE_DEDUP, "op8_near_dedup": NEAR_DEDUP, "op12_spelling_variants": SPELLING, "op13_source_mixing": _mixing()}
