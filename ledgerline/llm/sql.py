"""SQL for DuckDB whose rows the queries must equal."""



def crc32(text: str) -> str:
    """The unsigned CRC-32 of a string's UTF-8 bytes: a step a bit, each byte mixed in at its first."""
    byte = f"('0x' || substr(hex({text}), 2 * i - 1, 2))::BIGINT"
    bits = f"flatten(list_transform(range(1, strlen({text}) + 1), lambda i: [{byte}, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: {step}), 4294967295::BIGINT)"


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIXED = r"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS rank FROM totals
), weighed AS (
  SELECT *, rank % 3 AS kind, [3.0, 1.0, 2.0][rank % 3 + 1]::DOUBLE AS weight,
         (source_size * 2)::DOUBLE AS full_size
  FROM ranked
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(full_size) OVER (ORDER BY full_size / weight, rank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY full_size / weight, rank
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), aims AS (
  SELECT source, source_size, kind,
         least(full_size, coalesce(max(CASE WHEN full_size / weight >= level THEN level END)
               OVER (), 'inf'::DOUBLE) * weight) AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.size, a.source_size, a.kind, a.target, CAST(coalesce(sum(d.size) OVER (
           PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
), parts AS (
  SELECT *, CASE WHEN target > 0 THEN start / target ELSE 2.0 END AS part FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(CAST(round(target) AS BIGINT) - start, 0), size)
            + least(greatest(CAST(round(target) AS BIGINT) - start - source_size, 0), size)
            AS BIGINT) AS taken,
       round(CASE WHEN part > 1 THEN part
            WHEN kind = 0 THEN (sqrt(16.0 - part * 12.0) - 4.0) / -2.0
            WHEN kind = 1 THEN part
            WHEN part * 2.0 <= 0.75 THEN (sqrt(1.0 + part * 8.0) - 1.0) / 2.0
            ELSE 0.5 + (sqrt(4.0 + (part * 2.0 - 0.75) * 4.0) - 2.0) / 2.0 END, 9) + 0.0 AS position
FROM parts
"""

EXACT = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(normal) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS normal FROM documents)
WINDOW w AS (PARTITION BY normal)
"""

REPAIRED = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged
), faults AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, place,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault
  FROM placed
), pairs AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM faults
), counts AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id
), inserts(before, step, price, state, body) AS (
  VALUES (0, '', 0, 0, ''), (0, 'I', 2, 2, 'user:' || chr(10)), (0, 'II', 4, 3, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (1, '', 0, 1, ''), (1, 'I', 2, 2, 'user:' || chr(10)), (1, 'II', 4, 3, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (2, '', 0, 2, ''), (2, 'I', 2, 3, 'assistant:' || chr(10)), (2, 'II', 4, 2, 'assistant:' || chr(10) || 'user:' || chr(10)),
         (3, '', 0, 3, ''), (3, 'I', 2, 2, 'user:' || chr(10)), (3, 'II', 4, 3, 'user:' || chr(10) || 'assistant:' || chr(10))
), edits(edit, price) AS (VALUES ('K', 0), ('R', 2), ('D', 3)
), paths AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, 0 AS state, struct_pack(cost := 0::BIGINT, audit := '', body := '') AS best
  FROM conversations
  UNION ALL
  SELECT conv_id, place, state, min(way) AS best FROM (
    SELECT p.conv_id, f.place,
           CASE WHEN e.edit = 'D' THEN i.state WHEN e.edit = 'K' AND f.initial = 's' THEN 1
                WHEN i.state = 2 THEN 3 ELSE 2 END AS state,
           struct_pack(cost := p.best.cost + i.price + e.price + CASE WHEN f.fault = 3 AND e.edit <> 'D' THEN 1 ELSE 0 END,
             audit := p.best.audit || i.step || e.edit,
             body := p.best.body || i.body || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
               ELSE CASE WHEN i.state = 2 THEN 'assistant:' ELSE 'user:' END || f.text || chr(10) END) AS way
    FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = p.place + 1
    JOIN inserts i ON i.before = p.state CROSS JOIN edits e
    WHERE e.edit = 'D' OR (f.fault NOT IN (1, 2) AND (e.edit = 'R'
      OR (f.initial = 's' AND i.state = 0) OR (f.initial = 'u' AND i.state <> 2) OR (f.initial = 'a' AND i.state = 2)))
  ) GROUP BY conv_id, place, state
), ends(state, step, body) AS (
  VALUES (0, '', ''), (3, '', ''), (2, 'I', 'assistant:' || chr(10)), (1, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))
), finished AS (
  SELECT p.conv_id, min(struct_pack(cost := p.best.cost + 2 * length(e.step), audit := p.best.audit || e.step,
         body := p.best.body || e.body)) AS best
  FROM paths p JOIN ends e ON e.state = p.state
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id
  WHERE p.place = coalesce(c.n, 0) GROUP BY p.conv_id
)
SELECT f.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(CASE WHEN best.body = '' THEN '' ELSE substr(best.body, 1, length(best.body) - 1) END) AS repaired_sha256
FROM finished f LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM f.conv_id
"""

VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM runs WHERE length(run) >= 7
), hashed AS (
  SELECT run, {crc32("(id || ':' || run)")} AS h FROM lowered
), spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
              || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.rest
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(n := -other_n, other := encode(other))) AS top FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN -top.n >= 10 * w.n THEN decode(top.other) END AS form,
         CASE WHEN -top.n >= 10 * w.n THEN -top.n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS reached, 0 AS links FROM words
  UNION ALL
  SELECT c.word, f.form, c.links + 1 FROM chains c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN (SELECT word, arg_max(reached, links) AS root FROM chains GROUP BY word) r USING (word)
"""
