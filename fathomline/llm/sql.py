"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

#: op3: conversations without tool calls in JSON, as all of these tables; each exchange is a link.
TOOL_CALLS = r"""
WITH msg AS (
  SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL
), calls AS (
  SELECT conv_id, turn, 'turn:' || CAST(turn AS VARCHAR) AS call_id, to_json({'prompt': text, 'speaker': role}) AS arguments
  FROM msg WHERE role <> 'assistant'
), results AS (
  SELECT conv_id, 'turn:' || CAST(turn - 1 AS VARCHAR) AS call_id, min(turn) AS result_turn, arg_min(text, (turn, text)) AS result, count(*) AS n_results
  FROM msg WHERE role = 'assistant' GROUP BY ALL
), others AS (
  SELECT DISTINCT m.conv_id, m.turn, r.call_id, m.text, r.n_results FROM msg m JOIN results r ON r.conv_id = m.conv_id AND r.call_id = 'turn:' || CAST(m.turn - 1 AS VARCHAR)
  WHERE m.role = 'assistant' AND (m.turn <> r.result_turn OR m.text <> r.result)
), linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.result_turn) AS turn, CASE WHEN c.turn IS NULL THEN -1 ELSE 0 END AS seq,
         coalesce(c.call_id, r.call_id) AS call_id, CASE WHEN c.turn IS NOT NULL THEN 'respond' END AS name, c.turn IS NOT NULL AS valid,
         coalesce(r.n_results, 0) AS n_results, r.result_turn, c.arguments, r.result
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
  UNION ALL SELECT conv_id, turn, -1, call_id, NULL, false, n_results, turn, NULL, text FROM others
)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, seq, call_id, name NULLS FIRST, arguments NULLS FIRST, result) AS place, 0 AS level, turn, CAST(seq AS INTEGER) AS seq, call_id, name, valid,
       coalesce(result_turn >= turn, true) AS ordered, n_results, result_turn,
       '{' || concat_ws(',', '"arguments":' || to_json(CAST(arguments AS VARCHAR)), '"id":' || to_json(call_id), '"name":' || to_json(name), '"result":' || to_json(result), '"valid":' || CASE WHEN valid THEN 'true' ELSE 'false' END) || '}' AS line
FROM linked
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: op6: every window of an item, looked up in every window of as many words of a document.
CONTAMINATION = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
 iw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
 dw AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
 h AS (SELECT dw.r, dw.i, dw.n, iw.item FROM dw JOIN iw ON iw.n = dw.n AND iw.s = dw.s),
 p AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM h) GROUP BY r),
 t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""

#: op12: the checksum of a word is folded over its bytes with the table of the checksum's polynomial, made by its rule.
IMPORTANCE = f"""
WITH RECURSIVE step(i, k, v) AS (SELECT i, 0, i FROM range(256) AS r(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
 tab AS (SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8),
 d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents), b AS (SELECT {_WORDS} AS w FROM benchmark),
 dw AS (SELECT r, unnest(w) AS x FROM d), bw AS (SELECT unnest(w) AS x FROM b),
 v AS (SELECT DISTINCT x FROM (SELECT x FROM dw UNION ALL SELECT x FROM bw)),
 c AS (SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, CAST(strlen(x) AS BIGINT) * 2, 2), lambda i: CAST(concat('0x', substr(hex(encode(x)), CAST(i AS INTEGER), 2)) AS BIGINT))), lambda p, y: xor(p >> 8, tab[(xor(p, y) & 255) + 1])), 4294967295) % 10000 AS k FROM v, tab),
 s AS (SELECT k, count(*) AS n FROM dw JOIN c USING (x) GROUP BY k), t AS (SELECT k, count(*) AS n FROM bw JOIN c USING (x) GROUP BY k),
 g AS (SELECT q.k, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM range(10000) AS q(k) LEFT JOIN s ON s.k = q.k LEFT JOIN t ON t.k = q.k),
 m AS (SELECT r, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n FROM dw JOIN c USING (x) JOIN g USING (k) GROUP BY r),
 u AS (SELECT doc_id, r, coalesce(n, 0) AS n, CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight, CAST(concat('0x', substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN m USING (r)),
 f AS (SELECT doc_id, r, n, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM u),
 o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM f WHERE n >= 20)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score, CASE WHEN place <= (10 * fit) // 100 THEN CAST(place AS BIGINT) END AS rank FROM f LEFT JOIN o USING (r)
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: op11: every document that holds a term of an item is scored.
LEXICAL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents), q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS x FROM benchmark),
 a AS (SELECT count(*) AS total_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
 p AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(w) AS x FROM d) SEMI JOIN q USING (x) GROUP BY r, x),
 f AS (SELECT x, CAST(floor(1000 * ln((2 * total_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM p, a GROUP BY x, total_docs),
 m AS (SELECT r, doc_id, 10 + (90 * CAST(len(w) AS BIGINT) * total_docs) // total AS m FROM d, a WHERE len(w) > 0),
 s AS (SELECT item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN p USING (x) JOIN f USING (x) JOIN m USING (r) GROUP BY ALL),
 o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""

ORACLE = {"op3_tool_call_linking": TOOL_CALLS, "op6_decontaminate_winnowing": CONTAMINATION, "op11_block_max_wand": LEXICAL, "op12_importance_resampling": IMPORTANCE}
