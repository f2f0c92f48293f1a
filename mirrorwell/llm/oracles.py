"""DuckDB SQL for the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last_doc AS dropped
  FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP5 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP6 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, greatest(len(words) - 18, 1))) AS pos, words FROM w),
hashed AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS h FROM windows),
late AS (SELECT doc_id, pos FROM hashed
  QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM late),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
judged AS (SELECT p.*, g.pos IS NOT NULL AS dropped FROM placed p LEFT JOIN gone g USING (doc_id, pos)),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (dropped) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT dropped), '') AS text
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept k USING (doc_id)
"""

_PROBE = "'</s>[INST] ok [/INST]'"
OP7 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_PROBE} UNION ALL SELECT -1, 1, 'assistant', {_PROBE}),
escaped AS (
  SELECT *, length(role) + length(text) + length('<|turn|>') + length('<|says|>') + length('<|end|>')
    + length(role || text) - length(replace(role || text, chr(92), ''))
    + len(regexp_extract_all(role || chr(10) || text,
                             '<[|]|</?s>|<</?SYS>>|\\[/?INST\\]')) AS shown
  FROM turns),
told AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(shown)::bigint AS formatted_chars
  FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM told
"""

_TERMS = ("regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
          + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP11 = f"""
WITH held AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY 1, 2),
sizes AS (SELECT doc_id, sum(tf)::bigint AS n FROM counts GROUP BY 1),
totals AS (SELECT count(*) AS docs, sum(n)::bigint AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint AS w
  FROM counts, totals GROUP BY term),
lengths AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM sizes, totals),
asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY 1, 2),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY 1, 2)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

# CRC-32 of a conv_id's digits, bit by bit: the start value, then every bit of every byte from
# the lowest on.
_BITS = "flatten(list_transform(string_split(conv_id::varchar, ''), lambda ch: list_transform(range(8), lambda b: (ascii(ch)::bigint >> b) & 1)))"
_CRC = f"""xor(4294967295::bigint, list_reduce(list_concat([4294967295::bigint], {_BITS}),
  lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END))"""

OP12 = f"""
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
named AS (SELECT *, dense_rank() OVER (ORDER BY role, text) AS tid, length(text) AS len FROM said),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h
          FROM (SELECT DISTINCT conv_id FROM said)),
built AS (
  SELECT c.conv_id, n.pos, n.tid, n.len FROM convs c JOIN named n ON n.conv_id = c.base AND n.pos <= c.h
  UNION ALL
  SELECT c.conv_id, n.pos - c.h + least(c.h, coalesce(b.turns, 0)), n.tid, n.len
  FROM convs c JOIN named n ON n.conv_id = c.conv_id AND n.pos > c.h
  LEFT JOIN (SELECT conv_id, count(*) AS turns FROM named GROUP BY 1) b ON b.conv_id = c.base),
steps AS (
  SELECT conv_id, pos AS depth, len,
         string_agg(tid::varchar, ',') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix
  FROM built
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS turns FROM steps GROUP BY 1),
nodes AS (
  SELECT prefix, depth, min(s.conv_id) AS conv_id, count(*) AS n_convs, min(len) AS len,
         sha256(coalesce(string_agg(s.conv_id::varchar, ',' ORDER BY s.conv_id)
           FILTER (l.turns = s.depth), '')) AS ends_sha256
  FROM steps s JOIN lengths l USING (conv_id) GROUP BY prefix, depth),
linked AS (
  SELECT n.*, p.prefix AS over, p.conv_id AS parent_conv_id
  FROM nodes n
  LEFT JOIN steps s ON s.conv_id = n.conv_id AND s.depth = n.depth - 1
  LEFT JOIN nodes p ON p.prefix = s.prefix AND p.depth = s.depth),
kids AS (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked
         WHERE depth > 0 GROUP BY 1, 2),
facts AS (
  SELECT l.*, coalesce(k.n_children, 0) AS n_children
  FROM linked l LEFT JOIN kids k ON k.parent_conv_id = l.conv_id AND k.depth = l.depth),
sums AS (
  SELECT s.prefix, s.depth, sum((f.n_convs - 1) * f.len) AS saved,
         count(*) FILTER (f.n_children = 0) AS leaves
  FROM facts f JOIN steps s ON s.conv_id = f.conv_id AND s.depth <= f.depth GROUP BY 1, 2)
SELECT f.conv_id, f.depth::bigint AS depth, f.parent_conv_id, f.n_convs, f.n_children,
       s.leaves AS n_leaves, s.saved::bigint AS saved_tokens, f.ends_sha256
FROM facts f JOIN sums s ON s.prefix = f.prefix AND s.depth = f.depth
"""

ORACLES = {
    "op1_line_dedup": OP1,
    "op5_exact_dedup": OP5,
    "op6_substring_dedup": OP6,
    "op7_chat_format": OP7,
    "op11_lexical_search": OP11,
    "op12_conversation_trie": OP12,
}
