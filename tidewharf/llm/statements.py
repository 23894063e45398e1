"""SQL for DuckDB, written from the operators' contracts."""

DECONTAMINATION = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), item AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 12) AS q
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(q) AS n FROM win
), place AS (
  SELECT r, n, i, list_slice(w, i, i + n - 1) AS q
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)
), hit AS (
  SELECT r, i, n, item_id FROM place JOIN win USING (q)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

MIXING = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(concat_ws('|', CAST(doc_id AS VARCHAR), md5(text))) AS turn,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 0.5 END::DOUBLE AS at_start,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 1.0 ELSE 1.5 END::DOUBLE AS at_end
  FROM doc GROUP BY source
), filled AS (
  SELECT *, source_size / weight AS fill,
    (SELECT CAST(sum(source_size) AS DOUBLE) FROM src) * 1.5 - coalesce(sum(2 * source_size) OVER w, 0) AS rest,
    (SELECT sum(weight) FROM src) - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM src
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest, weight_left FROM filled WHERE rest * weight < 2 * source_size * weight_left
  ORDER BY fill, source NULLS LAST LIMIT 1
), aim AS (
  SELECT source, source_size, at_start, at_end,
    coalesce(CASE WHEN rest * weight >= 2 * source_size * weight_left THEN CAST(2 * source_size AS DOUBLE)
      ELSE (SELECT rest FROM level) * weight / (SELECT weight_left FROM level) END, 0) AS target
  FROM filled
), placed AS (
  SELECT doc_id, size, source_size, target, at_start * target AS a, at_end * target - at_start * target AS bend,
    CAST(round(target) AS BIGINT) AS whole,
    CAST(coalesce(sum(size) OVER (PARTITION BY doc.source ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM doc JOIN aim ON doc.source IS NOT DISTINCT FROM aim.source
), cut AS (
  SELECT *, greatest(least(size, whole - start), 0) AS once, greatest(least(size, whole - start - source_size), 0) AS twice
  FROM placed
)
-- the share runs from one value to the other, so the demand is a parabola, whose root is the position
SELECT doc_id, size, source_size, target, CAST(once + twice AS BIGINT) AS taken,
  CASE WHEN once + twice > 0 THEN least(2.0::DOUBLE * need / (a + sqrt(greatest(a * a + 2.0::DOUBLE * bend * need, 0))), 1) END AS first_position,
  CASE WHEN once + twice > 0 THEN least(2.0::DOUBLE * again / (a + sqrt(greatest(a * a + 2.0::DOUBLE * bend * again, 0))), 1) END AS last_position
FROM (SELECT *, CAST(start AS DOUBLE) AS need, CAST(start + CASE WHEN twice > 0 THEN source_size ELSE 0 END AS DOUBLE) AS again FROM cut)
"""

WARC = r"""
WITH page AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), copy AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM page
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to, true AS verified
FROM copy
"""

JACCARD = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2),
      lambda i: array_to_string(list_slice(w, i, i + 3), ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM doc
), each AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

FILL_IN_MIDDLE = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), draw AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4
  FROM doc
), cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draw
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
    ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents WHERE text IS NOT NULL
), seq AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM seq GROUP BY lang
), gram AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM seq, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS c FROM gram GROUP BY ALL HAVING count(*) >= 30
), cand AS (
  SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(list_slice(w, 1, cut), ' ') AS first, array_to_string(list_slice(w, cut + 1, k), ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
), scored AS (
  SELECT cuts.*, x.c AS l, y.c AS r, CAST((2000000 * CAST(a AS HUGEINT)) // (CAST(x.c AS HUGEINT) + y.c) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.first JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, sub, max(a) AS longer FROM (
    SELECT lang, a, unnest(list_transform(range(1, k - s + 2), lambda i: array_to_string(list_slice(w, i, i + s - 1), ' '))) AS sub
    FROM cand, (SELECT unnest([2, 3]) AS s) WHERE s < k
  ) GROUP BY lang, sub
)
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best JOIN total ON total.lang = best.lang LEFT JOIN inside ON inside.lang = best.lang AND inside.sub = best.phrase
WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""
