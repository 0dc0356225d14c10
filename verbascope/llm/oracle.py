"""DuckDB SQL for the operators that SQL can express, over the whole given tables."""

# Words are runs of anything but ASCII white space; lists in DuckDB count from 1.
_QUALITY = r"""
WITH texts AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS place,
         unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS piece
  FROM texts WHERE len(words) >= 5),
repeated AS (
  SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, piece) > 1),
covered AS (
  SELECT doc_id, count(*) AS n FROM
    (SELECT DISTINCT doc_id, place + step AS place FROM repeated, (SELECT unnest(range(0, 5)) AS step)) GROUP BY doc_id),
measured AS (
  SELECT t.doc_id, host, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id),
failed AS (
  SELECT host, rule, count(*) AS n_docs, count_if(bad) AS n_bad FROM (
    SELECT host, unnest(['few_words', 'repeats', 'symbols', 'dup_lines', 'word_length']) AS rule,
           unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > n_words,
                   10 * n_dup_lines > 3 * n_lines, word_chars < 2 * n_words OR word_chars > 15 * n_words]) AS bad
    FROM measured) GROUP BY host, rule),
prior AS (
  SELECT rule, avg(n_bad / n_docs) AS mean,
         var_pop(n_bad / n_docs) - avg((n_bad / n_docs) * (1 - n_bad / n_docs) / n_docs) AS var
  FROM failed GROUP BY rule),
strength AS (
  SELECT rule, mean,
         CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 1.0), 1e6) ELSE 1e6 END AS strength
  FROM prior),
rates AS (
  SELECT host, round(max((n_bad + mean * strength) / (n_docs + strength)), 6) AS host_rate
  FROM failed JOIN strength USING (rule) GROUP BY host),
judged AS (
  SELECT m.*, host_rate, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM measured m JOIN rates r ON m.host IS NOT DISTINCT FROM r.host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate <= 0.5 AS kept, host, host_rate
FROM judged
"""

# The level of the fill: with the k sources of least bound per weight full, those and no others are above their bounds.
_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS hash
  FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
bounded AS (
  SELECT *, 3 * source_size AS bound, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place
  FROM sums),
levels AS (
  SELECT k, ((SELECT sum(source_size) FROM sums) - coalesce(sum(bound) FILTER (place <= k), 0))
            / (sum(weight) FILTER (place > k)) AS level
  FROM bounded, (SELECT unnest(range(0, (SELECT count(*) FROM sums))) AS k) GROUP BY k),
stable AS (
  SELECT k, level FROM levels l
  WHERE (SELECT count(*) FROM bounded b WHERE b.weight * l.level > b.bound) = k ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, CAST(least(weight * level, bound) AS DOUBLE) AS target FROM bounded, stable),
placed AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN budget // source_size * size
                 + greatest(0, least(size, budget - budget // source_size * source_size - ahead)) ELSE 0 END AS BIGINT) AS taken
FROM placed
"""

# Every bucket of every depth is summed; a row's shard is the first that fits.
_SHARDS = r"""
WITH keyed AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS bits
  FROM documents),
buckets AS (
  SELECT doc_id, n_bytes, depth, bits >> (60 - depth) AS prefix FROM keyed, (SELECT unnest(range(0, 61)) AS depth)),
summed AS (
  SELECT *, CAST(sum(n_bytes) OVER b AS BIGINT) AS shard_bytes, count(*) OVER b AS shard_docs
  FROM buckets WINDOW b AS (PARTITION BY depth, prefix)),
first_fit AS (
  SELECT * FROM summed WHERE shard_bytes <= 8388608 OR shard_docs < 2 OR depth = 60
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard, shard_bytes, shard_docs
FROM first_fit
"""

# Two sets at 75 % share one of the n - ceil(0.75 n) + 1 rarest shingles of either; such pairs are counted in full.
_NEAR = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
  FROM texts),
named AS (SELECT doc_id, len(shingles) AS n_shingles, md5(array_to_string(shingles, chr(10))) AS name FROM sets),
classes AS (
  SELECT min(s.doc_id) AS id, n.name, any_value(n_shingles) AS n
  FROM sets s JOIN named n USING (doc_id) WHERE n_shingles > 0 GROUP BY n.name),
members AS (SELECT id, n, unnest(shingles) AS shingle FROM classes JOIN sets ON id = doc_id),
rarest AS (
  SELECT id, shingle FROM (SELECT *, count(*) OVER (PARTITION BY shingle) AS docs FROM members)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY docs, shingle) <= n - ceil(0.75 * n) + 1),
pairs AS (SELECT DISTINCT a.id AS u, b.id AS v FROM rarest a JOIN rarest b ON a.shingle = b.shingle AND a.id < b.id),
counted AS (
  SELECT u, v, len(a.shingles) AS m, len(b.shingles) AS n, len(list_intersect(a.shingles, b.shingles)) AS common
  FROM pairs JOIN sets a ON u = a.doc_id JOIN sets b ON v = b.doc_id
  WHERE 100 * least(len(a.shingles), len(b.shingles)) >= 75 * greatest(len(a.shingles), len(b.shingles))),
links AS (SELECT u, v FROM counted WHERE 100 * common >= 75 * (m + n - common)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached AS (
  SELECT id, id AS other FROM classes UNION SELECT r.id, b.v FROM reached r JOIN both_ways b ON r.other = b.u),
least_ids AS (SELECT name, min(other) AS component_id FROM reached JOIN classes USING (id) GROUP BY name)
SELECT doc_id, n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM named LEFT JOIN least_ids USING (name)
"""

# Every pair of an anchor and another row; windows are cut from all of them.
_HARD = r"""
WITH usable AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.n <> r.n AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5),
windows AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.vec_id ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor = s.anchor AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5
"""

_WARC = r"""
WITH records AS (
  SELECT row_number() OVER () AS n, page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
placed AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first_id
  FROM records WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, n))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN place = 1 OR payload_bytes < 100 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place = 1 OR payload_bytes < 100 THEN NULL ELSE first_id END AS refers_to
FROM placed
"""

# crc32 bit by bit over the digits of an id. Levels are lists of nodes; a step of a proof is what stands left and right
# of a row's node on one level, the levels of its source first.
_MERKLE = r"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS n, doc_id, source, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
         text, CASE WHEN xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 2 = 0
         THEN replace(text, chr(10), '') ELSE text END AS altered
  FROM documents),
leaves AS (
  SELECT n, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS altered
  FROM fields),
levels AS (
  SELECT source, 0 AS level, list(leaf ORDER BY doc_id NULLS FIRST, leaf, n) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
  FROM levels WHERE len(nodes) > 1),
subroots AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS number FROM levels WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY number) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
  FROM tops WHERE len(nodes) > 1),
placed AS (
  SELECT l.*, subroot, number, row_number() OVER (PARTITION BY number ORDER BY doc_id NULLS FIRST, leaf, n) - 1 AS place
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
ways AS (
  SELECT n, level, place // CAST(pow(3, level) AS BIGINT) AS own, nodes
  FROM placed p JOIN levels v ON p.source IS NOT DISTINCT FROM v.source WHERE len(nodes) > 1
  UNION ALL SELECT n, 1000 + level, number // CAST(pow(3, level) AS BIGINT), nodes FROM placed, tops WHERE len(nodes) > 1),
steps AS (
  SELECT n, row_number() OVER (PARTITION BY n ORDER BY level) AS step, array_to_string(nodes[own // 3 * 3 + 1:own], '') AS before,
         array_to_string(nodes[own + 2:own // 3 * 3 + 3], '') AS after
  FROM ways),
folded AS (
  SELECT n, 1 AS step, altered AS node FROM placed
  UNION ALL SELECT f.n, f.step + 1, sha256(before || node || after) FROM folded f JOIN steps s ON f.n = s.n AND f.step = s.step),
ends AS (SELECT n, arg_max(node, step) AS folded_root FROM folded GROUP BY n),
proofs AS (SELECT n, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY n),
whole AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN ends USING (n) LEFT JOIN proofs USING (n) CROSS JOIN whole
"""

SQL: dict[str, str] = {
    "op1_host_quality": _QUALITY,
    "op2_source_mix": _MIX,
    "op5_extendible_shards": _SHARDS,
    "op10_minmax_near_dedup": _NEAR,
    "op11_hard_negatives": _HARD,
    "op12_warc_revisits": _WARC,
    "op13_merkle_manifest": _MERKLE,
}
