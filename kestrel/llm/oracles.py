"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from kestrel.llm.chat import MARKS, OTHER, SEP
from kestrel.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, SYMBOLS

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS s
  FROM w, range(0, greatest(len(w) - 4, 1)) r(i) WHERE len(w) > 0 AND i < greatest(len(w) - 4, 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.v, r.c FROM reach r JOIN links l ON l.u = r.doc_id WHERE r.c < l.v),
least AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, l.c AS component_id, d.doc_id = l.c AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_BITS = ("array_to_string(list_transform(range(1, 41), lambda i: ['" + "','".join(f"{k:04b}" for k in range(16))
         + "'][strpos('0123456789abcdef', substr(h, i, 1))]), '')")
_FIVE = " + ".join(f"{16 >> k} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INTEGER)" for k in range(5))

WARC = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, {_BITS} AS bits, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', {_FIVE} + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM b
"""

SUFFIX = """
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
a AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM d),
b AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x,
    CASE WHEN 2 * p + 200 <= length(h) THEN hash(substr(h, 2 * p + 1, 200)) END AS w FROM a),
f AS (
  SELECT doc_id, p, x, w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1 AS again FROM b),
c AS (
  SELECT doc_id, p, x, coalesce(p - max(CASE WHEN again THEN p END) OVER (PARTITION BY doc_id ORDER BY p) < 100, false) AS gone
  FROM f),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS starts FROM c),
k AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r, count(*) FILTER (starts) AS s,
    coalesce(string_agg(x, '' ORDER BY p) FILTER (NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_bytes, coalesce(r, 0) AS n_removed, coalesce(s, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""


def _quoted(mark: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in mark)


_CONTROL = "|".join(_quoted(m) for m in [*(x for _, a, b in MARKS for x in (a, b)), *OTHER, SEP])


def _escaped(col: str) -> str:
    return f"regexp_replace({col}, '(\\\\*)({_CONTROL})', '\\\\\\1\\2', 'g')"


_FRAME = "CASE role " + " ".join(f"WHEN '{r}' THEN {len(a) + len(b) + 2}" for r, a, b in MARKS) + (
    f" ELSE {len(OTHER[0]) + len(OTHER[1]) + len(SEP) + 4} + length({_escaped('role')}) END")

CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(length({_escaped('text')}) + {_FRAME}) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  true AS identical FROM l
"""

_STOP = ", ".join(f"'{v}'" for v in sorted({v for s in STOP_WORDS for v in (s, s.capitalize(), s.upper())}))
_RATIO = {
    "mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "n_words"),
    "stop_word_ratio": ("n_stop", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines")}


def _rule(measure: str, op: str, bound: float) -> str:
    a, b = _RATIO[measure]
    return f"(CASE WHEN {b} > 0 THEN {a} / CAST({b} AS DOUBLE) ELSE 0.0 END {op} CAST({bound} AS DOUBLE))"


QUALITY = rf"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM documents),
u AS (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM t),
v AS (SELECT k, i, array_to_string(w[i : i + 2], ' ') AS s FROM u),
d AS (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS n FROM v),
r AS (
  SELECT k, count(DISTINCT i + j) AS n FROM d, range(0, 3) o(j) WHERE d.n > 1 GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    CAST(len(l) AS BIGINT) AS n_lines, len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop
  FROM t LEFT JOIN r ON r.k = t.k),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({' OR '.join(_rule(*x) for x in RULES)}) AS kept
FROM b
"""


def _field(c: str, value: str | None = None) -> str:
    v = value or f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({v})) || ':' || {v} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join([_field("doc_id"), _field("source"), _field("lang"), _field("n_chars", n_chars),
                                    _field("text")]) + ")"


#: crc32 of the decimal id, bit by bit: each byte, then eight shifts.
_CRC = """(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(i) + 1),
      lambda k: CAST(ord(substr(i, k, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(0, 8), lambda z: CAST(z AS BIGINT))),
      lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))))"""

_FOLD = """CASE WHEN f.idx % 2 = 1 THEN sha256(s.h || f.h) WHEN s.h IS NULL THEN sha256(f.h) ELSE sha256(f.h || s.h) END"""


def _tree(name: str, source: str) -> str:
    """All levels of the trees over ``source`` (g, idx, n, h)."""
    return f"""
{name}(g, level, idx, n, h) AS (
  SELECT g, 0, idx, n, h FROM {source}
  UNION ALL
  SELECT g, level + 1, idx // 2, (n + 1) // 2, p FROM (
    SELECT g, level, idx, n,
      sha256(h || coalesce(lead(h) OVER (PARTITION BY g ORDER BY idx), '')) AS p FROM {name} WHERE n > 1)
  WHERE idx % 2 = 0)"""


def _folded(name: str, source: str, tree: str) -> str:
    """Paths of ``source`` (k, g, idx, h) up their tree, with the siblings met on the way."""
    return f"""
{name}(k, g, level, idx, h, proof) AS (
  SELECT k, g, 0, idx, h, '' FROM {source}
  UNION ALL
  SELECT f.k, f.g, f.level + 1, f.idx // 2, {_FOLD}, f.proof || coalesce(s.h, '')
  FROM {name} f JOIN {tree} o ON o.g = f.g AND o.level = f.level AND o.idx = f.idx AND o.n > 1
  LEFT JOIN {tree} s ON s.g = f.g AND s.level = f.level AND s.idx = xor(f.idx, 1))"""


MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {_leaf('CAST(n_chars AS VARCHAR)')} AS h,
    {_leaf('CAST(n_chars + 1 AS VARCHAR)')} AS other, coalesce(CAST(doc_id AS VARCHAR), '') AS i FROM documents),
c AS (SELECT * EXCLUDE (i), doc_id IS NOT NULL AND xor({_CRC}, CAST(4294967295 AS BIGINT)) % 7 = 0 AS bad FROM d),
p AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n, row_number() OVER () AS k FROM c),
{_tree('a', 'p')},
r AS (SELECT g, h FROM a WHERE n = 1),
q AS (SELECT 1 AS g, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n, h, g AS k FROM r),
{_tree('b', 'q')},
e AS (SELECT k, g, idx, CASE WHEN bad THEN other ELSE h END AS h FROM p),
{_folded('f', 'e', 'a')},
t AS (SELECT k, g, h, proof FROM f QUALIFY row_number() OVER (PARTITION BY k ORDER BY level DESC) = 1),
u AS (SELECT t.k, 1 AS g, q.idx, t.h FROM t JOIN q ON q.k = t.g),
{_folded('v', 'u', 'b')},
w AS (SELECT k, h, proof FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY level DESC) = 1)
SELECT p.doc_id, p.h AS leaf, r.h AS subroot, z.h AS root, sha256(t.proof || w.proof) AS proof_sha256,
  w.h AS folded_root, w.h = z.h AS verified
FROM p JOIN r ON r.g = p.g JOIN t ON t.k = p.k JOIN w ON w.k = p.k JOIN b z ON z.n = 1
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
n AS (SELECT k, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
t AS (SELECT k, t, count(*) AS tf FROM (SELECT k, unnest(w) AS t FROM d) GROUP BY k, t),
f AS (SELECT t, count(*) AS df FROM t GROUP BY t),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
m AS (SELECT k, doc_id, 100 - 90 + ((90 * n * n_docs) // n_terms) AS m FROM n, c),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
w AS (
  SELECT item_id, t, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM q JOIN f USING (t), c),
s AS (
  SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM w JOIN t USING (t) JOIN m USING (k) GROUP BY item_id, k, doc_id)
SELECT item_id, CAST(row_number() OVER r AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW r AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER r <= 10
"""
