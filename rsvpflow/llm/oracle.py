"""DuckDB SQL for the queries of this subpackage that SQL can express.

Written from the definitions of the results (exact sets, all pairs that share a shingle, windows as lists), not from the
way the operators find them.
"""

from __future__ import annotations

_BLANKS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_PY_BLANK = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_STRIP = " || ".join(f"chr({n})" for n in _PY_BLANK)
_PROBE = "</s>[INST] ok [/INST]"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NOTICES = (r"(?i)(all rights reserved|©|\(c\) ?\d{4}|copyright|licensed under|released under|cookie|privacy policy|terms of (use|service)"
            r"|subscribe|sign (in|up)|log ?in|click here|read more|share (this|on)|javascript|follow us|newsletter)")
_SEPARATORS = "['|', '>', '<', '»', '›', '·', '•', '/', '-', '::']"

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
 w AS (SELECT rid, doc_id, text, regexp_extract_all(text, {_text(_WORD)}) AS ws FROM d),
 win AS (SELECT rid, i, ws[i:i + 7] AS k FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
 twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
 rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(i, i + 7)) AS p FROM twice) GROUP BY rid),
 l0 AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
 l AS (SELECT rid, line, trim(line, {_STRIP}) AS body, regexp_extract_all(line, {_text(_WORD)}) AS ws FROM l0
       WHERE regexp_matches(line, {_text(_WORD)})),
 j AS (SELECT rid, line, len(ws) AS n,
        (NOT regexp_matches(body, '\p{{L}}')
         OR 10 * length(regexp_replace(body, '[^#*$%&|<>~^=_{{}}\\]', '', 'g')) > length(body)
         OR (len(ws) >= 4 AND 3 * len(list_filter(ws, lambda x: regexp_matches(x, '(!!|\?\?|\*\*\*|###|%%%|\$\$\$|&&&)$'))) > len(ws))
         OR (len(ws) >= 6 AND 5 * len(list_filter(generate_series(1, len(ws) - 1), lambda i: ws[i] = ws[i + 1])) > 2 * len(ws))
         OR (len(ws) >= 3 AND 4 * len(list_filter(ws, lambda x: list_contains({_SEPARATORS}, x))) >= len(ws))
         OR (len(ws) < 6 AND NOT regexp_matches(body, '[.!?…:;"”»''\)\]。！？]$'))
         OR (len(ws) <= 20 AND regexp_matches(body, {_text(_NOTICES)}))) AS bad FROM l),
 s AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup, count_if(bad) AS n_bad, sum(CASE WHEN bad THEN n ELSE 0 END) AS lost
       FROM j GROUP BY rid),
 a AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, {_text(_BLANKS)}, '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
        CAST(coalesce(n_bad, 0) AS BIGINT) AS n_bad_lines, CAST(coalesce(lost, 0) AS BIGINT) AS lost_words
       FROM w LEFT JOIN rep USING (rid) LEFT JOIN s USING (rid))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
 (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_words <= 0.4 * n_words) AS kept FROM a
"""

_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
_ESC = r"replace(replace({x}, '\', '\\'), '<|', '\x3c|')"
OP9 = f"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', {_text(_PROBE)}), (-1, 1, 'assistant', {_text(_PROBE)})),
 r AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' {_ORDER})) AS turns_sha256,
 CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
 sha256(string_agg(CASE WHEN r = 'assistant' THEN x ELSE '' END, '' {_ORDER})) AS loss_sha256,
 CAST(sum(23 + length({_ESC.format(x='r')}) + length({_ESC.format(x='x')})) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


def _shingles(words: str, size: int, whole: bool) -> str:
    few = f"CASE WHEN len({words}) < {size} THEN [{words}] ELSE " if whole else "("
    end = " END" if whole else ")"
    return f"{few}list_transform(generate_series(1, len({words}) - {size - 1}), lambda i: {words}[i:i + {size - 1}]){end}"


OP5 = f"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM documents),
 bw AS (SELECT row_number() OVER () AS bid, item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM benchmark),
 ds AS (SELECT DISTINCT rid, doc_id, unnest({_shingles('ws', 5, False)}) AS s FROM dw WHERE len(ws) >= 5),
 bs AS (SELECT DISTINCT bid, item_id, unnest({_shingles('ws', 5, False)}) AS s FROM bw WHERE len(ws) >= 5),
 n AS (SELECT bid, item_id, count(*) AS n_item FROM bs GROUP BY ALL),
 j AS (SELECT rid, doc_id, bid, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM j JOIN n USING (bid) WHERE n_shared >= 0.8 * n_item - 1e-9
"""

OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_text(_WORD)}) AS ws
                     FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest({_shingles('ws', 4, True)}) AS s FROM w WHERE len(ws) > 0),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
 e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
 g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
 reach(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, g.b FROM reach JOIN g ON reach.r = g.a),
 c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.id = d.doc_id
"""



def _crc(hexed: str) -> str:
    """CRC-32 of bytes given as hex text, bit by bit."""
    nib = lambda at: f"(strpos('0123456789ABCDEF', substr({hexed}, {at}, 1)) - 1)"
    byte = f"(16 * {nib('k')} + {nib('k + 1')})::BIGINT"
    step = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    return (f"xor(4294967295::BIGINT, list_reduce(list_transform(generate_series(1, length({hexed}) - 1, 2), lambda k: {byte}), "
            f"lambda a, b: list_reduce([0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {step}, xor(a, b)), 4294967295::BIGINT))")


_FIELD = lambda x: f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over (tree, i, n, h), level by level."""
    return f"""{name} AS (SELECT tree, 0 AS level, i AS idx, n AS size, h FROM {leaves}
   UNION ALL SELECT tree, level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE size > 1
   GROUP BY tree, level + 1, idx // 8, (size + 7) // 8)"""


OP11 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS h, {_leaf(_LOWER)} AS low FROM documents),
 c AS (SELECT doc_id, {_crc('x')} % 3 = 0 AS tampered FROM (SELECT DISTINCT doc_id, hex(doc_id::VARCHAR) AS x FROM documents WHERE doc_id IS NOT NULL)),
 l AS MATERIALIZED (SELECT row_number() OVER () AS rid, d.doc_id, tree, h, CASE WHEN tampered THEN low ELSE h END AS found,
   row_number() OVER (PARTITION BY tree ORDER BY d.doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
   FROM d LEFT JOIN c ON c.doc_id = d.doc_id),
 {_tree('nodes', 'l')},
 subs AS MATERIALIZED (SELECT '#' AS tree, tree AS of, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h FROM nodes WHERE size = 1),
 {_tree('tops', 'subs')},
 every AS MATERIALIZED (SELECT * FROM nodes UNION ALL SELECT * FROM tops),
 depth AS (SELECT tree, max(level) AS top FROM every GROUP BY tree),
 path AS (SELECT rid, l.tree, lv AS level, lv AS step, i // (8 ** lv)::BIGINT AS idx FROM (SELECT l.*, unnest(generate_series(0, top - 1)) AS lv FROM l JOIN depth USING (tree)) l
   UNION ALL SELECT rid, '#', lv, own + lv, i // (8 ** lv)::BIGINT FROM (SELECT rid, s.i, d.top AS own, unnest(generate_series(0, t.top - 1)) AS lv FROM l
     JOIN subs s ON s.of = l.tree JOIN depth d ON d.tree = l.tree JOIN depth t ON t.tree = '#')),
 sib AS MATERIALIZED (SELECT rid, step, coalesce(string_agg(e.h, '' ORDER BY e.idx) FILTER (e.idx < p.idx), '') AS before,
   coalesce(string_agg(e.h, '' ORDER BY e.idx) FILTER (e.idx > p.idx), '') AS after
   FROM path p JOIN every e ON e.tree = p.tree AND e.level = p.level AND e.idx // 8 = p.idx // 8 GROUP BY rid, step),
 proof AS (SELECT rid, string_agg(before || after, '' ORDER BY step) AS p FROM sib GROUP BY rid),
 fold AS (SELECT rid, 0 AS step, found AS h FROM l UNION ALL SELECT f.rid, f.step + 1, sha256(before || h || after) FROM fold f JOIN sib ON sib.rid = f.rid AND sib.step = f.step),
 folded AS (SELECT rid, arg_max(h, step) AS h FROM fold GROUP BY rid)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM l JOIN subs s ON s.of = l.tree CROSS JOIN (SELECT h FROM tops WHERE size = 1) r LEFT JOIN proof p USING (rid) JOIN folded f USING (rid)
"""

_RUN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all({_LOWER}, {_RUN}), []) AS ws FROM documents),
 dw AS (SELECT rid, unnest(ws) AS w FROM d),
 bw AS (SELECT unnest(regexp_extract_all({_LOWER}, {_RUN})) AS w FROM benchmark),
 b AS MATERIALIZED (SELECT w, {_crc('x')} % 10000 AS bucket FROM (SELECT w, hex(w) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw))),
 s AS (SELECT bucket, count(*) AS s FROM dw JOIN b USING (w) GROUP BY bucket),
 t AS (SELECT bucket, count(*) AS t FROM bw JOIN b USING (w) GROUP BY bucket),
 n AS (SELECT (SELECT count(*) FROM dw)::DOUBLE AS s_all, (SELECT count(*) FROM bw)::DOUBLE AS t_all),
 g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + 10000)))) AS BIGINT) AS gain
   FROM s FULL JOIN t USING (bucket) CROSS JOIN n),
 m AS (SELECT rid, sum(gain) AS total FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY rid),
 x AS (SELECT d.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce((total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws), 0) AS BIGINT) AS weight,
   ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (rid)),
 y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
 z AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS r, count(*) OVER () AS eligible FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= eligible * 10 // 100 THEN r END AS rank FROM y LEFT JOIN z USING (rid)
"""

OP13 = """
WITH u AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
 p AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
 r AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) v(verdict, h, f)),
 best AS (SELECT rid, arg_max(h || f, length(h || f)) AS rule, arg_max(verdict, length(h || f)) AS verdict FROM p JOIN r
   ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, f) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (rid)
"""

ORACLE_SQL = {"op5_decontaminate": OP5, "op8_quality": OP8, "op9_chat": OP9, "op10_neardup": OP10, "op11_manifest": OP11, "op12_resample": OP12,
              "op13_urls": OP13}
