"""DuckDB twins of the operator queries that SQL can express.

The others have none: 3 and 6 return scores and fingerprints of their method,
9 and 10 learn. Their tests compare with plain Python or held-out labels.
"""

LLM_ORACLE: dict[str, str] = {}

SPACE = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str, pattern: str, lower: bool) -> str:
    folded = f"translate({text}, '{UPPER}', '{LOWER}')" if lower else text
    return f"coalesce(regexp_extract_all({folded}, '{pattern}'), [])"


LLM_ORACLE["op1_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words('text', SPACE, True)} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, w[i:i + 3] AS g FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id
           GROUP BY ALL),
links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
          WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON pairs.a = reach.r)
SELECT documents.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, any_value(e.c) AS n_equal
FROM documents JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id)
  JOIN (SELECT x.doc_id, CASE WHEN s IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY s) END AS c
        FROM documents x LEFT JOIN (SELECT doc_id, list(g ORDER BY g) AS s FROM sets GROUP BY doc_id) y USING (doc_id)) e USING (doc_id)
GROUP BY documents.doc_id"""

LLM_ORACLE["op2_decontaminate"] = f"""
WITH items AS (SELECT item_id, {words('text', ALNUM, True)} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
spots AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cut),
windows AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS g FROM spots),
docs AS (SELECT doc_id, {words('text', ALNUM, True)} AS w FROM documents),
places AS (SELECT doc_id, w, l.n, unnest(range(1, len(w) - l.n + 2)) AS i FROM docs JOIN (SELECT DISTINCT n FROM windows) l
           ON len(w) >= l.n),
found AS (SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, n, i, w[i:i + n - 1] AS g FROM places) p
          JOIN windows USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

LLM_ORACLE["op4_warc_fixity"] = """
WITH records AS (
  SELECT page_id, CAST(page_id // 1000 AS BIGINT) AS archive, CAST('0x' || substr(md5(url), 1, 2) AS INTEGER) % 128 AS rule,
         CAST(strlen(concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:',
           page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', strlen(html),
           chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10))) AS BIGINT) AS length
  FROM pages),
placed AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM records)
SELECT archive, "offset", page_id, CASE rule WHEN 1 THEN 'missing' ELSE 'changed' END AS kind, length,
       CASE rule WHEN 0 THEN length WHEN 2 THEN length - 1 END AS replica_length
FROM placed WHERE rule < 3"""

LLM_ORACLE["op5_preference_format"] = """
WITH replies AS (SELECT conv_id AS pair_id, max(turn) AS last_turn, arg_max(text, turn) AS reply FROM conversations
                 WHERE role = 'assistant' GROUP BY conv_id),
swap AS (SELECT pair_id, last_turn, coalesce(lead(reply) OVER g, first_value(reply) OVER g) AS reply FROM replies
         WINDOW g AS (PARTITION BY pair_id // 1000 ORDER BY pair_id)),
chosen AS (SELECT pair_id, turn, role, text FROM conversations JOIN swap ON conv_id = pair_id),
rejected AS (SELECT pair_id, turn, role, text FROM conversations JOIN swap ON conv_id = pair_id WHERE turn < last_turn
             UNION ALL SELECT pair_id, last_turn, 'assistant', reply FROM swap),
ends AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id,
                min(CASE WHEN c.role = r.role AND c.text = r.text THEN NULL ELSE coalesce(c.turn, r.turn) END) AS stop
         FROM chosen c FULL JOIN rejected r ON c.pair_id = r.pair_id AND c.turn = r.turn GROUP BY 1),
sides AS (
  SELECT pair_id, CASE WHEN stop IS NULL OR turn < stop THEN 'prompt' ELSE 'chosen' END AS segment, turn, role, text
  FROM chosen JOIN ends USING (pair_id)
  UNION ALL SELECT pair_id, 'rejected', turn, role, text FROM rejected JOIN ends USING (pair_id) WHERE turn >= stop),
shown AS (SELECT *, turn // 64 AS part, concat('<|', role, '|>', chr(10), text, '<|end|>', chr(10)) AS line FROM sides),
places AS (SELECT *, sum(length(line)) OVER (PARTITION BY pair_id, segment, part ORDER BY turn) AS stop FROM shown),
counts AS (SELECT pair_id, count(*) AS n FROM sides WHERE segment = 'prompt' GROUP BY pair_id)
SELECT pair_id, segment, CAST(part AS BIGINT) AS part, count(*) AS n_turns, coalesce(any_value(n), 0) AS n_prompt,
       string_agg(line, '' ORDER BY turn) AS text,
       coalesce(string_agg(CASE WHEN role = 'assistant' AND segment <> 'prompt'
         THEN concat(CAST(stop - length(line) + length(role) + 5 AS BIGINT), '-', CAST(stop - 1 AS BIGINT)) END, ',' ORDER BY turn), '')
         AS mask
FROM places LEFT JOIN counts USING (pair_id) GROUP BY pair_id, segment, part"""

LLM_ORACLE["op7_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {words('text', SPACE, False)} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w[i:i + 19] ORDER BY doc_id, i) AS nth FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM windows WHERE nth > 1),
each AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(w[j], ' ' ORDER BY j) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, j)
         GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

LLM_ORACLE["op8_source_mix"] = f"""
WITH sized AS (SELECT doc_id, source, CAST(len({words('text', SPACE, False)}) AS BIGINT) AS size,
                      substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS ticket FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
         FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][(place - 1) % 3 + 1] AS w, [2, 6, 3][(place - 1) % 3 + 1] * s AS ratio,
                   CAST(sum(s) OVER () AS BIGINT) AS total FROM sums),
filled AS (SELECT *, 3 * total - 4 * coalesce(sum(s) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                       AS budget,
                  sum(w) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM weighed),
marked AS (SELECT *, budget * w >= 4 * s * rest AS stops FROM filled),
level AS (SELECT budget AS b, rest AS r FROM marked WHERE NOT stops ORDER BY ratio, place LIMIT 1),
targets AS (SELECT source, place, s, total, CASE WHEN stops THEN CAST(2 * s AS DOUBLE) ELSE CAST(b * w AS DOUBLE) / CAST(r * 2 AS DOUBLE) END
            AS target FROM marked LEFT JOIN level ON true),
served AS (SELECT sized.*, place, s, total, target, CAST(sum(size) OVER (PARTITION BY sized.source ORDER BY ticket, doc_id NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
           FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
queue AS (SELECT *, CASE WHEN target > 0 THEN CAST(copy * s + upto AS DOUBLE) / target ELSE CAST(0 AS DOUBLE) END AS finish
          FROM served, (SELECT unnest([0, 1]) AS copy)),
ordered AS (SELECT *, sum(size) OVER (ORDER BY finish, place, ticket, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
            FROM queue)
SELECT doc_id, source, size, any_value(s) AS source_size, any_value(target) AS target,
       CAST(sum(CASE WHEN 2 * used <= 3 * total THEN size ELSE 0 END) AS BIGINT) AS taken
FROM ordered GROUP BY doc_id, source, size"""

CLASSES = {"space": r"[\x20\x09-\x0D]", "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "sentence": r"[.,;:!?''\x22()\-]",
           "control": r"[\x00-\x08\x0E-\x1F\x7F]", "symbol": r"[#-&*+/<=>@\[-`{-~]", "two": r"[\x{80}-\x{7FF}]", "three": r"[\x{800}-\x{FFFF}]",
           "four": r"[\x{10000}-\x{10FFFF}]"}
# A distance is sqrt((terms + share of the reference outside the text) / 2), see distribution_rules.distance.
TERM = "(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"

LLM_ORACLE["op11_distribution_rules"] = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
classes AS ({' UNION ALL '.join(f"SELECT doc_id, lang, '{k}' AS c, length(regexp_replace(text, '{v}', 'xx', 'g')) - length(text) AS n FROM d"
                                for k, v in CLASSES.items())}),
tokens AS (SELECT doc_id, lang, {words('text', ALNUM, True)} AS w FROM d),
counts AS (SELECT doc_id, lang, t, count(*) AS n FROM (SELECT doc_id, lang, unnest(w) AS t FROM tokens) GROUP BY ALL),
sizes AS (SELECT lang, sum(len(w)) AS n FROM tokens GROUP BY lang),
langs AS (SELECT lang, n FROM sizes WHERE lang IS NOT NULL AND n >= 2000 AND n >= 0.005 * (SELECT sum(n) FROM sizes)),
ref AS (SELECT lang, t, sum(c.n) / any_value(langs.n) AS p FROM counts c JOIN langs USING (lang) WHERE strlen(t) <= 40 GROUP BY lang, t
        HAVING sum(c.n) >= 0.001 * any_value(langs.n)),
ref_class AS (SELECT lang, c, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS p FROM classes SEMI JOIN langs USING (lang) GROUP BY lang, c),
chars AS (SELECT doc_id, sum(n) AS chars FROM classes GROUP BY doc_id),
by_class AS (SELECT doc_id, ref_class.lang, sqrt(sum({TERM.format(p='p', q='(CAST(n AS DOUBLE) / chars)')}) / 2) AS x
             FROM classes JOIN chars USING (doc_id) JOIN ref_class USING (c) WHERE chars > 0 GROUP BY ALL),
judged AS (SELECT doc_id, lang AS own, len(w) AS n FROM tokens WHERE len(w) >= 50),
met AS (SELECT c.doc_id, ref.lang, p, c.n / CAST(judged.n AS DOUBLE) AS q FROM counts c JOIN judged USING (doc_id) JOIN ref USING (t)),
known AS (SELECT doc_id, lang, sum(p) AS sp, sum(q) AS sq, sum({TERM.format(p='p', q='q')}) AS x FROM met GROUP BY ALL),
rest AS (SELECT lang, 1 - sum(p) AS r FROM ref GROUP BY lang),
by_word AS (SELECT judged.doc_id, own, rest.lang, n,
              sqrt((coalesce(x, 0) + {TERM.format(p='r', q='(1 - coalesce(sq, 0))')} + 1 - r - coalesce(sp, 0)) / 2) AS x
            FROM judged CROSS JOIN rest LEFT JOIN known ON known.doc_id = judged.doc_id AND known.lang = rest.lang),
fits AS (SELECT w.doc_id, bool_or(NOT (chars >= 300 AND c.x > 0.30 OR w.x > 0.30 + 2 / sqrt(n))) AS fit
         FROM by_word w JOIN by_class c ON c.doc_id = w.doc_id AND c.lang = w.lang JOIN chars ON chars.doc_id = w.doc_id
         WHERE own IS NULL OR own IN (SELECT lang FROM langs) GROUP BY w.doc_id),
split AS (SELECT doc_id, {words('text', SPACE, False)} AS w FROM d),
spots AS (SELECT doc_id, len(w) AS last, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM split),
runs AS (SELECT doc_id, i, i + 7 <= last AS whole, concat_ws(' ', t, {', '.join(f'lead(t, {k}) OVER o' for k in range(1, 8))}) AS g FROM spots
         WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM runs WHERE whole),
repeats AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM windows WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{SPACE}') GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
         FROM d JOIN split USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id))
SELECT base.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND coalesce(fit, true) AS kept
FROM base LEFT JOIN fits USING (doc_id)"""

# A state of the repair is text: the cost in six digits, then the audit; less is better. CRC-32 is taken bit by bit.
CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({key}, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: "
       "list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")


def _edit(state: str, cost: str, letter: str) -> str:
    return f"printf('%06d', CAST(substr({state}, 1, 6) AS INTEGER) + {cost}) || substr({state}, 7) || '{letter}'"


STATES = ("n", "s", "u", "a")
FAULT = (r"CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, place) > 1 THEN 'd' "
         "WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE 'f' END")
STAYS = "fault NOT IN ('b', 'd')"
MORE = "CASE fault WHEN 't' THEN 1 ELSE 0 END"

LLM_ORACLE["op12_conversation_repair"] = f"""
WITH RECURSIVE ruled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC.format(key="concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS rule
  FROM conversations),
hurt AS (SELECT conv_id, turn, CASE rule WHEN 4 THEN 'user' ELSE role END AS role,
                CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE rule WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM ruled WHERE rule <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place,
                  regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS last FROM hurt),
rows AS (SELECT conv_id, turn, place, role, text, left(role, 1) AS i, {FAULT} AS fault,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed),
walk AS (
  SELECT conv_id, 0::BIGINT AS place, '000000' AS n, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT conv_id, place, {_edit('n', '3', 'D')},
         least({_edit('s', '3', 'D')}, CASE WHEN {STAYS} AND i = 's' THEN {_edit('n', MORE, 'K')} END),
         least({_edit('u', '3', 'D')}, CASE WHEN {STAYS} AND i = 'u' THEN least({', '.join(_edit(x, MORE, 'K') for x in 'nsa')}) END,
               CASE WHEN {STAYS} THEN least({', '.join(_edit(x, f'2 + {MORE}', 'R') for x in 'nsa')}) END),
         least({_edit('a', '3', 'D')}, CASE WHEN {STAYS} AND i = 'a' THEN {_edit('u', MORE, 'K')} END,
               CASE WHEN {STAYS} THEN {_edit('u', f'2 + {MORE}', 'R')} END)
  FROM (SELECT * REPLACE (least(a, {_edit('u', '2', 'I')}) AS a) FROM
         (SELECT w.conv_id, r.place, r.i, r.fault, n, s, a, least(u, {', '.join(_edit(x, '2', 'I') for x in 'nsa')}) AS u
          FROM walk w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.place = w.place + 1))),
best AS (SELECT walk.conv_id, least(n, a, {_edit('u', '2', 'I')}, {_edit('s', '4', 'II')}) AS w
         FROM walk JOIN (SELECT conv_id, max(place) AS place FROM rows GROUP BY conv_id) m
           ON walk.conv_id IS NOT DISTINCT FROM m.conv_id AND walk.place = m.place),
letters AS (SELECT conv_id, unnest(string_split(substr(w, 7), '')) AS l, generate_subscripts(string_split(substr(w, 7), ''), 1) AS j FROM best),
edits AS (SELECT *, count(*) FILTER (l <> 'I') OVER o AS place, count(*) FILTER (l <> 'D') OVER o AS nth FROM letters
          WINDOW o AS (PARTITION BY conv_id ORDER BY j)),
kept AS (SELECT e.conv_id, l, nth, r.role, r.text, bool_or(nth = 1 AND l = 'K' AND r.i = 's') OVER (PARTITION BY e.conv_id) AS system
         FROM edits e LEFT JOIN rows r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.place = r.place AND l <> 'I' WHERE l <> 'D'),
repaired AS (SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN (nth % 2 = 1) <> system THEN 'user' ELSE 'assistant' END || ':' ||
                                        CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY nth) AS text FROM kept GROUP BY conv_id),
counts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                  count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(substr(w, 1, 6), '0') AS BIGINT) AS cost,
       coalesce(substr(w, 7), '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
  LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id"""

LLM_ORACLE["op13_lexical_search"] = f"""
WITH docs AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM (SELECT doc_id, {words('text', ALNUM, True)} AS w FROM documents)),
corpus AS (SELECT CAST(count(*) FILTER (n > 0) AS BIGINT) AS cn, CAST(sum(n) AS BIGINT) AS cl FROM docs),
terms AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest({words('text', ALNUM, True)}) AS t FROM benchmark) GROUP BY ALL),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM docs) SEMI JOIN terms USING (t) GROUP BY ALL),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * cn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wt
            FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), corpus),
gains AS (SELECT doc_id, t, wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * cn) // cl))) AS gain
          FROM tfs JOIN docs USING (doc_id) JOIN weights USING (t), corpus),
scored AS (SELECT item_id, doc_id, CAST(sum(q * gain) AS BIGINT) AS score FROM gains JOIN terms USING (t) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""
