"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

import re

from tickforge.llm import chat, quality, urls


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rules() -> tuple[str, str]:
    rows = sorted(urls.RULES, key=lambda r: -len(r[0]))
    when = [
        (f"(host = {_q(at)} OR ends_with(host, {_q('.' + at)})) AND starts_with(path, {_q('/' + rest)})", rule, kind)
        for rule, kind in rows
        for at, _, rest in [rule.partition("/")]
    ]
    return tuple("CASE " + " ".join(f"WHEN {c} THEN {_q(x[i])}" for c, *x in when) + " END" for i in (0, 1))


_LO, _HI = urls.STRENGTHS


def _strength(level: str) -> str:
    return f"""(SELECT CASE WHEN coalesce(N, 0) = 0 OR k < 2 OR g / N * (1 - g / N) <= 0 THEN {_HI} WHEN rho > 0 THEN least({_HI}, greatest({_LO}, 1 / rho - 1)) ELSE {_HI} END
  FROM (SELECT *, (r - N * (g / N) * (g / N) - (k - 1) * (g / N * (1 - g / N))) / coalesce(nullif((N - nn / N - (k - 1)) * (g / N * (1 - g / N)), 0), 1) AS rho
    FROM (SELECT sum(n)::DOUBLE AS N, sum(good)::DOUBLE AS g, count(*)::DOUBLE AS k, sum(n * n)::DOUBLE AS nn, sum(good::DOUBLE * good / n) AS r FROM {level})))"""


_TWO = ", ".join(map(_q, urls.TWO_LABEL_SUFFIXES))
_DOMAIN = f"""CASE WHEN array_to_string(list_slice(p, -2, -1), '.') IN ({_TWO}) THEN 2 ELSE 1 END"""
_BOUND = re.sub(r"(?<=\d)D\b", "", urls.bound_sql("a", "b"))

OP1 = f"""
WITH base AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM (SELECT page_id, CASE WHEN coalesce(strpos(url, '://'), 0) > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
lab AS (SELECT doc_id, bool_and(coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, count(*) AS n, count_if(good) AS good, string_split(host, '.') AS p FROM base JOIN lab ON page_id = doc_id GROUP BY host),
hosts3 AS (SELECT host, n, good, array_to_string(list_slice(p, -({_DOMAIN}) - 1, -1), '.') AS domain, array_to_string(list_slice(p, -({_DOMAIN}), -1), '.') AS suffix FROM hosts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts3 GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY ALL),
par AS (SELECT (SELECT coalesce((sum(good) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE), 0.5) FROM suffixes) AS m0, {_strength('suffixes')} AS k1, {_strength('domains')} AS k2, {_strength('hosts3')} AS k3),
s AS (SELECT suffix, (good + k1 * m0) / (n + k1) AS m1 FROM suffixes, par),
d AS (SELECT domain, suffix, (good + k2 * m1) / (n + k2) AS m2 FROM domains JOIN s USING (suffix), par),
h AS (SELECT host, good + k3 * m2 AS a, n - good + k3 * (1 - m2) AS b FROM hosts3 JOIN d USING (domain), par),
b0 AS (SELECT host, {_BOUND} AS x0 FROM h),
b1 AS (SELECT domain, {_BOUND} AS x1 FROM (SELECT domain, k3 * m2 AS a, k3 * (1 - m2) AS b FROM d, par)),
b2 AS (SELECT suffix, {_BOUND} AS x2 FROM (SELECT suffix, k2 * m1 AS a, k2 * (1 - m1) AS b FROM s, par)),
b3 AS (SELECT {_BOUND} AS x3 FROM (SELECT k1 * m0 AS a, k1 * (1 - m0) AS b FROM par)),
parts AS (SELECT *, string_split(host, '.') AS p FROM base),
named AS (SELECT page_id, host, path, array_to_string(list_slice(p, -({_DOMAIN}) - 1, -1), '.') AS domain, array_to_string(list_slice(p, -({_DOMAIN}), -1), '.') AS suffix FROM parts)
SELECT page_id, host, path, {_rules()[0]} AS rule, coalesce({_rules()[1]}, CASE WHEN coalesce(x0, x1, x2, x3) >= {urls.THRESHOLD} THEN 'allow' ELSE 'block' END) AS verdict
FROM named LEFT JOIN b0 USING (host) LEFT JOIN b1 USING (domain) LEFT JOIN b2 USING (suffix), b3
"""



def _count(text: str, part: str) -> str:
    return f"(length({text}) - length(replace({text}, {_q(part)}, ''))) // {len(part)}"


# no control string overlaps itself, and no two begin at one place
_ESCAPES = " + ".join(_count("text", c) for c in (*chat.CONTROL, chat.ESCAPE))
_FIXED = len(chat.TURN_OPEN) + len("|>") + 1 + len(chat.TURN_CLOSE) + 1
_SAID = "</s>[INST] ok [/INST]"

OP4 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_q(_SAID)} UNION ALL SELECT -1, 1, 'assistant', {_q(_SAID)})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_FIXED} + 2 * length(role) - length(translate(role, '\\|<[', '')) + length(text) + {_ESCAPES})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINE = f"trim(translate(l, {_SPACES}, '     '))"


def _line_rules() -> str:
    rules = quality.line_rules("ln", "lower(ln)", "nw")
    text = " OR ".join(f"({r})" for r in rules.values())
    return text.replace("\\'", "''")


OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
win AS (SELECT k, unnest(generate_series(1, len(w) - 2)) AS i, w FROM w WHERE len(w) > 2),
win2 AS (SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS c FROM win),
rep AS (SELECT k, count(DISTINCT i + o) AS n FROM win2, (VALUES (0), (1), (2)) AS v(o) WHERE c > 1 GROUP BY k),
lines AS (SELECT k, l, {_LINE} AS ln, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS nw FROM (SELECT k, unnest(string_split(t, chr(10))) AS l FROM d)),
judged AS (SELECT k, count(*) FILTER (nw > 0) - count(DISTINCT l) FILTER (nw > 0) AS dup, coalesce(sum(nw) FILTER (nw > 0 AND ({_line_rules()})), 0) AS lost FROM lines GROUP BY k),
base AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, {_SPACES} || ' ', ''))::BIGINT AS word_chars, length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS n_symbols,
  dup AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, lost::BIGINT AS n_lost_words FROM w JOIN judged USING (k) LEFT JOIN rep USING (k))
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) AND 100 * n_lost_words <= {quality.MAX_LOST_PERCENT} * n_words AS kept
FROM base
"""

from tickforge.llm import lines  # noqa: E402

OP8 = f"""
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (SELECT * FROM l WHERE trim(translate(line, {_SPACES}, '     ')) <> ''),
firsts AS (SELECT line, min((doc_id, pos)) AS fst, length(line) AS n FROM w GROUP BY line),
f AS (SELECT *, line[1:n // 2] AS a, line[n - n // 2 + 1:] AS b, line[1:(n - 1) // 2] AS a1, line[n - (n - 1) // 2 + 1:] AS b1 FROM firsts WHERE n >= {lines.MIN_CHARS}),
cand AS (
  SELECT x.line AS x, y.line AS y, x.fst AS ax, y.fst AS ay FROM f x JOIN f y ON x.n = y.n AND x.a = y.a AND x.line <> y.line
  UNION SELECT x.line, y.line, x.fst, y.fst FROM f x JOIN f y ON x.n = y.n AND x.b = y.b AND x.line <> y.line
  UNION SELECT x.line, y.line, x.fst, y.fst FROM f x JOIN f y ON x.n + 1 = y.n AND x.a = y.a1
  UNION SELECT x.line, y.line, x.fst, y.fst FROM f x JOIN f y ON x.n + 1 = y.n AND x.b = y.b1),
diff AS (SELECT *, coalesce(list_position([x[i::INT] = y[i::INT] FOR i IN generate_series(1, length(x))], false), length(x) + 1) AS p FROM cand),
near AS (SELECT * FROM diff WHERE (length(x) = length(y) AND x[p + 1:] = y[p + 1:]) OR (length(x) < length(y) AND x[p:] = y[p + 1:])),
gone AS (SELECT x AS line FROM near WHERE ay < ax UNION SELECT y FROM near WHERE ax < ay),
bad AS (SELECT w.doc_id, w.pos FROM w JOIN firsts USING (line) LEFT JOIN gone ON gone.line = w.line WHERE (w.doc_id, w.pos) > fst OR gone.line IS NOT NULL),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t FROM l WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.doc_id = l.doc_id AND bad.pos = l.pos) GROUP BY doc_id)
SELECT doc_id, (SELECT count(*) FROM w WHERE w.doc_id = d.doc_id) AS n_lines, (SELECT count(*) FROM bad WHERE bad.doc_id = d.doc_id) AS n_removed,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""

from tickforge.llm import near  # noqa: E402

_RULE7 = "100 * x.c >= 85 * (x.na + x.nb - x.c)"
OP7 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ') ELSE array_to_string(w, ' ') END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - {near.WORDS - 1}, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(na.n) AS na, any_value(nb.n) AS nb FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM x WHERE {_RULE7}),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

_TERMS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS.format("text")} AS w FROM documents),
q AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_TERMS.format("text")}) AS w FROM benchmark),
asked AS (SELECT q, item_id, unnest(w) AS term FROM q),
n AS (SELECT k, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
stat AS (SELECT count(*)::BIGINT AS N, sum(n)::BIGINT AS L FROM n),
tf AS (SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * stat.N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, stat GROUP BY term, stat.N),
impacts AS (SELECT k, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n.n * stat.N) // stat.L))) AS x FROM tf JOIN weights USING (term) JOIN n USING (k), stat),
scores AS (SELECT q, item_id, k, sum(x)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL),
best AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score FROM scores JOIN n USING (k) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 50
"""

OP12 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))),
links AS (SELECT a.k AS a, b.k AS b FROM ok AS a JOIN ok AS b ON a.k <> b.k AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
reach(k, to_k) AS (SELECT k, k FROM v UNION SELECT k, b FROM reach JOIN links ON to_k = a),
least AS (SELECT reach.k, first(v.vec_id ORDER BY v.vec_id NULLS FIRST) AS component_id FROM reach JOIN v ON v.k = to_k GROUP BY reach.k)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.k)::BIGINT AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN least USING (k)
"""


def _enc(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


_ABOVE = "SELECT {key}, i // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)), lvl + 1 FROM {name} WHERE n > 1 GROUP BY {key}, i // 3, lvl"
# crc32 by its definition, a byte at a time over the decimal id's ASCII digits
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, c: list_reduce([xor(a, c), 1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""

OP13 = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS k, *, (4294967295 - {_CRC}) % 2 = 0 AS odd_out FROM documents),
leaves AS (SELECT k, doc_id, source, sha256({_enc("doc_id")} || {_enc("source")} || {_enc("lang")} || {_enc("n_chars")} || {_enc("text")}) AS h,
  CASE WHEN odd_out THEN sha256({_enc("doc_id")} || {_enc("source")} || {_enc("lang")} || {_enc("n_chars")} || {_enc("replace(text, chr(10), '')")}) END AS other FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves),
tree(source, i, n, h, lvl) AS (SELECT source, i, n, h, 0 FROM placed UNION ALL {_ABOVE.format(key="source", name="tree")}),
subs AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
upper_tree(one, i, n, h, lvl) AS (SELECT 1, i, n, h, 0 FROM subs UNION ALL {_ABOVE.format(key="one", name="upper_tree")}),
path(k, at_top, source, i, n, lvl, proof, folded) AS (
  SELECT k, false, source, i, n, 0, '', coalesce(other, h) FROM placed
  UNION ALL
  SELECT k, at_top OR p.n = 1, p.source, CASE WHEN p.n = 1 THEN s.i ELSE p.i // 3 END, CASE WHEN p.n = 1 THEN s.n ELSE (p.n + 2) // 3 END, CASE WHEN p.n = 1 THEN 0 ELSE lvl + 1 END,
    CASE WHEN p.n = 1 THEN proof ELSE proof || coalesce(l, '') || coalesce(r, '') END, CASE WHEN p.n = 1 THEN folded ELSE sha256(coalesce(l, '') || folded || coalesce(r, '')) END
  FROM path AS p JOIN subs AS s ON p.source IS NOT DISTINCT FROM s.source
  LEFT JOIN (SELECT a.at_top AS t2, a.source AS s2, a.lvl AS lvl2, a.i AS i2, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i) AS l, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i) AS r
    FROM (SELECT false AS at_top, source, i, n, h, lvl FROM tree UNION ALL SELECT true, NULL, i, n, h, lvl FROM upper_tree) AS a
    JOIN (SELECT false AS at_top, source, i, n, h, lvl FROM tree UNION ALL SELECT true, NULL, i, n, h, lvl FROM upper_tree) AS b
    ON a.at_top = b.at_top AND a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.i // 3 = b.i // 3 GROUP BY ALL) AS x
  ON t2 = at_top AND (at_top OR s2 IS NOT DISTINCT FROM p.source) AND lvl2 = lvl AND i2 = p.i
  WHERE NOT (at_top AND p.n = 1))
SELECT doc_id, placed.h AS leaf, subs.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = top.h AS verified
FROM path JOIN placed USING (k) JOIN subs ON placed.source IS NOT DISTINCT FROM subs.source, (SELECT h FROM upper_tree WHERE n = 1) AS top
WHERE at_top AND path.n = 1
"""
