"""SQL twins of the text queries that SQL can express."""

import corpus_pipeline

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

op3_decontamination = f"""
WITH item AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)
),
hit AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hit) GROUP BY 1),
ids AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY 1
)
SELECT doc.doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
  sha256(coalesce(ids.list, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

op6_line_dedup = f"""
WITH line AS (
  SELECT doc_id, i, lines[i] AS line, {_LOWER.format(f"trim(lines[i], {_BLANKS})")} AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
),
often AS (
  SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT line.*, often.key IS NOT NULL AND doc_id <> last AS gone FROM line LEFT JOIN often ON line.key = often.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

op7_substring_dedup = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM doc WHERE len(w) >= 20)
),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM win) WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later),
word AS (SELECT doc_id, j, w[j] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM doc)),
kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY word.j) AS text
  FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY 1
)
SELECT doc.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""



def _crc32(c: str) -> str:
    """The unsigned CRC-32 of an ASCII string, bit by bit."""
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split({c}, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda bits, z: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)))"""


op12_turn_repair = rf"""
WITH RECURSIVE src AS (
  SELECT coalesce('c' || conv_id, 'n') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f
  FROM conversations
),
bad AS (
  SELECT k, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src, (SELECT unnest([1, 2]) AS copy) WHERE f <> 0 AND (copy = 1 OR f = 3)
),
num AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS p,
    count(*) OVER (PARTITION BY k) AS n FROM bad
),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY p) AS again,
    left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY k ORDER BY p) || left(role, 1) AS pair FROM num
),
flt AS (
  SELECT *, fault IN (0, 3) AS may_stay, CASE fault WHEN 3 THEN 3 ELSE 0 END AS stay FROM (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN again > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 3 ELSE 0 END AS fault FROM seen
  )
),
back AS (
  SELECT k, n + 1 AS p, [0, 6, 3, 0] AS c FROM flt WHERE p = 1
  UNION ALL
  SELECT k, p, [least(x[1], 3 + x[3], 6 + x[4]), least(x[2], 3 + x[3], 6 + x[4]), least(x[3], 3 + x[4]), least(x[4], 3 + x[3])]
  FROM (
    SELECT flt.k, flt.p, [
      least(4 + c[1], CASE WHEN may_stay THEN stay + 3 + c[3] END, CASE WHEN may_stay AND i = 's' THEN stay + c[2] WHEN may_stay AND i = 'u' THEN stay + c[3] END),
      least(4 + c[2], CASE WHEN may_stay THEN stay + 3 + c[3] END, CASE WHEN may_stay AND i = 'u' THEN stay + c[3] END),
      least(4 + c[3], CASE WHEN may_stay THEN stay + 3 + c[4] END, CASE WHEN may_stay AND i = 'a' THEN stay + c[4] END),
      least(4 + c[4], CASE WHEN may_stay THEN stay + 3 + c[3] END, CASE WHEN may_stay AND i = 'u' THEN stay + c[3] END)] AS x
    FROM back JOIN flt ON flt.k = back.k AND flt.p = back.p - 1
  )
),
walk AS (
  SELECT k, 1::BIGINT AS p, n, 1 AS s, '' AS audit, []::VARCHAR[] AS out FROM flt WHERE p = 1
  UNION ALL
  SELECT k, CASE WHEN e = 'I' THEN p ELSE p + 1 END, n,
    CASE e WHEN 'D' THEN s WHEN 'K' THEN CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END ELSE next END,
    audit || e,
    CASE e WHEN 'D' THEN out WHEN 'K' THEN list_append(out, role || ':' || text)
      ELSE list_append(out, CASE next WHEN 3 THEN 'user' ELSE 'assistant' END || ':' || CASE e WHEN 'I' THEN '' ELSE text END) END
  FROM (
    SELECT w.k, w.p, w.n, w.s, w.next, w.audit, w.out, i, role, text, CASE
      WHEN w.p <= w.n AND 4 + after.c[s] = here.c[s] THEN 'D'
      WHEN 3 + here.c[next] = here.c[s] THEN 'I'
      WHEN may_stay AND ((i = 's' AND s = 1 AND stay + after.c[2] = here.c[s]) OR (i = 'u' AND s <> 3 AND stay + after.c[3] = here.c[s])
        OR (i = 'a' AND s = 3 AND stay + after.c[4] = here.c[s])) THEN 'K'
      ELSE 'R' END AS e
    FROM (SELECT *, CASE s WHEN 3 THEN 4 ELSE 3 END AS next FROM walk) w
    JOIN back here ON here.k = w.k AND here.p = w.p
    LEFT JOIN back after ON after.k = w.k AND after.p = w.p + 1
    LEFT JOIN flt ON flt.k = w.k AND flt.p = w.p
    WHERE w.p <= w.n OR here.c[s] > 0
  )
),
done AS (SELECT walk.k, audit, out FROM walk JOIN back ON back.k = walk.k AND back.p = walk.p WHERE walk.p = n + 1 AND back.c[s] = 0),
found AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM flt GROUP BY k
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(back.c[1] AS BIGINT), 0) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('c' || conv_id, 'n') AS k FROM conversations) ids
LEFT JOIN found USING (k) LEFT JOIN done USING (k) LEFT JOIN back ON back.k = ids.k AND back.p = 1
"""

op13_prefix_trie = rf"""
WITH src AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS r
  FROM conversations WHERE conv_id IS NOT NULL
),
conv AS (SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 4 AS h, c - c % 20 AS b, count(*) AS n FROM src GROUP BY c),
plan AS (SELECT conv.*, least(conv.h, coalesce(base.n, 0)) AS shared FROM conv LEFT JOIN conv base ON base.c = conv.b),
turns AS (
  SELECT c, r - h + shared + 1 AS d, role, text FROM src JOIN plan USING (c) WHERE r >= h
  UNION ALL
  SELECT plan.c, r + 1, role, text FROM plan JOIN src ON src.c = plan.b WHERE r < shared
),
path AS (
  SELECT c, d, list({{'role': role, 'text': text}}) OVER (PARTITION BY c ORDER BY d) AS p,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns
  UNION ALL
  SELECT c, 0, [], 0 FROM conv
),
node AS (SELECT p, d, min(c) AS owner, count(*) AS n, max(words) AS words FROM path GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
whole AS (SELECT node.*, coalesce(kids.n, 0) AS children FROM node LEFT JOIN kids USING (p)),
below AS (
  SELECT p[1:up] AS p, sum((n - 1) * words) AS saved, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM whole) GROUP BY 1
),
ends AS (
  SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS hash
  FROM (SELECT c, arg_max(p, d) AS p FROM path GROUP BY c) GROUP BY p
)
SELECT x.owner AS conv_id, CAST(x.d AS BIGINT) AS depth, up.owner AS parent_conv_id, x.n AS n_convs, x.children AS n_children,
  CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(ends.hash, sha256('')) AS ends_sha256
FROM whole x LEFT JOIN node up ON x.d > 0 AND up.p = x.p[1:x.d - 1] JOIN below ON below.p = x.p LEFT JOIN ends ON ends.p = x.p
"""

ALL: dict[str, str] = {
    "op13_prefix_trie": op13_prefix_trie,
    "op12_turn_repair": op12_turn_repair,
    "op3_decontamination": op3_decontamination,
    "op6_line_dedup": op6_line_dedup,
    "op7_substring_dedup": op7_substring_dedup,
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
