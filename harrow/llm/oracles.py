"""DuckDB SQL for the operators that SQL can express."""

#: Every line of every document, its word set, and all pairs of sets with a Jaccard similarity of 0.8.
LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents
), sets AS (
  SELECT doc_id, pos, line, list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[ \t\r\x0b\f]+'), lambda w: w <> ''))) AS ws
  FROM lines
), firsts AS (
  SELECT ws, min((doc_id, pos)) AS place, row_number() OVER (ORDER BY min((doc_id, pos))) AS k, len(ws) AS n
  FROM sets WHERE len(ws) > 0 GROUP BY ws
), words AS (
  SELECT k, n, unnest(ws) AS w FROM firsts
), pairs AS (
  SELECT a.k AS a, b.k AS b
  FROM words a JOIN words b ON a.w = b.w AND a.k < b.k AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4
  GROUP BY a.k, b.k, a.n, b.n
  HAVING count(*) * 5 >= 4 * (a.n + b.n - count(*))
), marked AS (
  SELECT s.doc_id, s.pos, s.line,
         len(s.ws) = 0 OR ((s.doc_id, s.pos) = f.place AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.b = f.k)) AS stays
  FROM sets s LEFT JOIN firsts f ON s.ws = f.ws
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '') AS text
FROM marked GROUP BY doc_id
"""

#: Every line-up of an item and a document that agrees in all places of a mask, then the best run of 20 places.
SEED_OVERLAPS = r"""
WITH items AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\pL\pM\pN]+'), lambda w: w <> '') AS item FROM benchmark
), docs AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\pL\pM\pN]+'), lambda w: w <> '') AS ws FROM documents
), masks(k, span, o, lengths) AS (
  VALUES (0, 5, [0, 1, 2, 3, 4], NULL), (1, 7, [0, 1, 3, 5, 6], NULL), (2, 9, [0, 1, 4, 6, 8], NULL), (3, 3, [0, 1, 2], [5, 6, 7, 10]), (4, 5, [0, 1, 3, 4], [5]), (5, 4, [0, 1, 2, 3], [8, 9])
), item_seeds AS (
  SELECT DISTINCT item_id, k, i, list_transform(o, lambda x: item[i + x]) AS seed
  FROM (SELECT item_id, item, k, o, unnest(range(1, greatest(len(item) - span + 2, 1))) AS i FROM items, masks WHERE len(item) >= 5 AND (lengths IS NULL OR list_contains(lengths, len(item))))
), doc_seeds AS (
  SELECT doc_id, k, i, list_transform(o, lambda x: ws[i + x]) AS seed
  FROM (SELECT doc_id, ws, k, o, unnest(range(1, greatest(len(ws) - span + 2, 1))) AS i FROM docs, masks WHERE k IN (SELECT k FROM item_seeds))
), shifts AS (
  SELECT DISTINCT d.doc_id, s.item_id, d.i - s.i AS shift FROM doc_seeds d JOIN item_seeds s ON d.k = s.k AND d.seed = s.seed
), places AS (
  SELECT doc_id, item_id, shift, p, least(len(item), 20) AS run, CAST(item[p] = ws[p + shift] AS INT) AS same
  FROM (SELECT s.*, ws, item, unnest(range(greatest(1 - shift, 1), least(len(item), len(ws) - shift) + 1)) AS p
        FROM shifts s JOIN items USING (item_id) JOIN docs USING (doc_id))
), runs AS (
  SELECT doc_id, item_id, shift, p, run, sum(same) OVER w AS same, count(*) OVER w AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY p) AS r FROM places)
  WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), short_runs AS (
  SELECT doc_id, item_id, shift, min(p) AS p, run, sum(same) AS same, count(*) AS n FROM places WHERE run < 20 GROUP BY ALL
), whole AS (
  SELECT * FROM runs WHERE run = 20 AND n = 20 UNION ALL SELECT doc_id, item_id, shift, p, run, same, n FROM short_runs WHERE n = run
), best AS (
  SELECT doc_id, item_id, shift, p + shift - 1 AS start, run, same / run AS similarity FROM whole WHERE same / run >= 0.8
)
SELECT doc_id, item_id, count(DISTINCT shift) AS n_places, max(similarity) AS similarity,
       CAST(arg_min(start, (-similarity, -run, start)) AS BIGINT) AS start, CAST(arg_min(run, (-similarity, -run, start)) AS BIGINT) AS length
FROM best GROUP BY doc_id, item_id
"""

#: The cuts drawn from the digest of the id; the text rebuilt is the text itself.
FILL_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         list_transform([1, 9, 17, 25], lambda i: ('0x' || sha256('42:' || doc_id)[i:i + 7])::BIGINT) AS h
  FROM documents
), cuts AS (
  SELECT doc_id, text, u, len(u) AS n, list_sort([h[1] % (len(u) + 1), h[2] % (len(u) + 1)]) AS c,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), sizes AS (
  SELECT *, coalesce(list_sum(list_transform(u[:c[1]], lambda x: length(x))), 0)::BIGINT AS p, coalesce(list_sum(list_transform(u[c[1] + 1:c[2]], lambda x: length(x))), 0)::BIGINT AS m FROM cuts
), parts AS (
  SELECT *, left(text, p) AS prefix, substr(text, p + 1, m) AS middle, substr(text, p + m + 1) AS suffix FROM sizes
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

#: CRC-32 over the UTF-8 bytes of each distinct word by a table of 256 values, then bucket gains, weights and the draw.
IMPORTANCE = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), words AS (
  SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 'b', NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), bytes AS (
  SELECT w, list_transform(range(len(hex(encode(w))) // 2), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS b FROM (SELECT DISTINCT w FROM words)
), buckets AS (
  SELECT w, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc_table
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN buckets USING (w) GROUP BY bucket
), totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts, totals
), sums AS (
  SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS g FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce((g - ((g % n + n) % n)) // n, 0) AS weight,
         coalesce((g - ((g % n + n) % n)) // n, 0) + CAST(floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN sums USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS eligible FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * eligible // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""
