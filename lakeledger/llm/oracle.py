"""DuckDB SQL for those queries that SQL can state."""

#: crc32 of a decimal string, bit by bit (reflected polynomial 0xEDB88320).
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({s}, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"""

OP13 = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) - 1 AS pos, token, length(text) AS chars FROM said),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32.format(s="conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM said)),
rebuilt AS (
  SELECT i.conv_id, 0 AS part, o.pos, o.token, o.chars FROM ids i JOIN own o ON o.conv_id = i.base AND o.pos < i.h
  UNION ALL SELECT i.conv_id, 1, o.pos, o.token, o.chars FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos >= i.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, token, chars FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, chars, string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
nodes AS (SELECT path, depth, min(conv_id) AS top, count(*) AS n, min(chars) AS chars FROM prefixes GROUP BY path, depth),
passes AS (SELECT p.conv_id, p.depth, n.top FROM prefixes p JOIN nodes n ON n.path = p.path AND n.depth = p.depth),
parents AS (SELECT n.top, n.depth, p.top AS parent FROM nodes n JOIN passes p ON p.conv_id = n.top AND p.depth = n.depth - 1),
children AS (SELECT parent AS top, depth - 1 AS depth, count(*) AS n FROM parents GROUP BY 1, 2),
ended AS (SELECT p.top, p.depth, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
          FROM passes p JOIN lengths l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY 1, 2),
below AS (
  SELECT a.top, a.depth, sum((n.n - 1) * n.chars) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM nodes n JOIN passes a ON a.conv_id = n.top AND a.depth <= n.depth
  LEFT JOIN children c ON c.top = n.top AND c.depth = n.depth GROUP BY 1, 2)
SELECT n.top AS conv_id, n.depth::BIGINT AS depth, p.parent AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN parents p ON p.top = n.top AND p.depth = n.depth LEFT JOIN children c ON c.top = n.top AND c.depth = n.depth
LEFT JOIN ended e ON e.top = n.top AND e.depth = n.depth JOIN below b ON b.top = n.top AND b.depth = n.depth
"""

#: A word is a run of anything but these white space characters.
_WORD = r"[^\x20\x09-\x0D]"

OP4 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w FROM documents),
places AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM docs),
triples AS (SELECT r, i, x, lead(x) OVER own AS y, lead(x, 2) OVER own AS z FROM places WINDOW own AS (PARTITION BY r ORDER BY i)),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) AS n FROM triples WHERE z IS NOT NULL),
repeated AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE n > 1) GROUP BY r),
measured AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines,
    coalesce(p.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g')) AS n_letters, length(t) - length(replace(t, '!', '')) AS n_exclaims
  FROM docs d LEFT JOIN repeated p ON p.r = d.r),
counted AS (SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM measured),
judged AS (
  SELECT *, CASE WHEN n_words < 50 THEN 'short' WHEN 100 * n_repeat_words > 50 * n_words THEN 'repetitive'
    WHEN 10 * n_symbols > n_words THEN 'symbols' WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 'word_length'
    WHEN 2 * n_dup_lines > n_lines THEN 'dup_lines' WHEN 2 * n_upper > n_letters THEN 'capitals'
    WHEN 2 * n_exclaims > n_words THEN 'exclaims' END AS failed_rule
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_rule IS NULL AS kept, failed_rule
FROM judged
"""

#: Every pair of documents that share a shingle is counted, so this is SQL for small scales.
OP7 = f"""
WITH RECURSIVE said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS w
  FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM said),
pairs AS (SELECT doc_id, n, x, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS y FROM words),
shingles AS (SELECT DISTINCT doc_id, concat(x, ' ', y) AS s FROM pairs WHERE y IS NOT NULL OR n = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON b.s = a.s AND b.doc_id <> a.doc_id GROUP BY 1, 2),
links AS (
  SELECT p.a, p.b FROM both_have p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
  WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT c.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM components c LEFT JOIN sizes s ON s.doc_id = c.doc_id
"""

OP9 = """
WITH turns AS (
  SELECT conv_id, turn, replace(coalesce(role, ''), '<', '<-') AS role, replace(coalesce(text, ''), '<', '<-') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<-/s>[INST] ok [/INST]' FROM range(2) t(i)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM turns),
marked AS (
  SELECT *, CASE WHEN role = lag(role) OVER chat THEN '<|part|>' ELSE '<|turn|>' || role || '<|text|>' END AS before,
    CASE WHEN role = lead(role) OVER chat THEN '' ELSE '<|end|>' END AS after
  FROM placed WINDOW chat AS (PARTITION BY conv_id ORDER BY i)),
chats AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(before || text || after, '' ORDER BY i) AS formatted,
    string_agg(replace(role || chr(10) || text || chr(10), '<-', '<'), '' ORDER BY i) AS said,
    coalesce(string_agg(replace(text, '<-', '<'), '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  length(formatted) AS formatted_chars
FROM chats
"""

ORACLE = {"op4_quality": OP4, "op7_neardup": OP7, "op9_chat": OP9, "op13_zfast": OP13}
