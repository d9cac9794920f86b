"""DuckDB SQL for the queries that SQL can express."""

OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM shingles),
elements AS (SELECT doc_id, unnest(s) AS e FROM shingles),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
  JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id AND nb.n * 10 >= na.n * 9 AND na.n * 10 >= nb.n * 9
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS start, doc_id AS node FROM sizes
  UNION
  SELECT reach.start, links.b FROM reach JOIN links ON links.a = reach.node
)
SELECT sizes.doc_id, n AS n_shingles, min(node) AS component_id
FROM sizes JOIN reach ON reach.start = sizes.doc_id
GROUP BY sizes.doc_id, n
"""

# CRC32 a nibble at a time; shard i begins at the first key with i shards' bytes below.
OP4 = """
WITH digits AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    regexp_replace(hex(encode(coalesce(text, ''))), '(.)(.)', '\\2\\1', 'g') AS low_first
  FROM documents
), crc AS (
  SELECT doc_id, size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      list_filter(string_split(low_first, ''), lambda d: d <> ''),
      lambda d: instr('0123456789ABCDEF', d) - 1)),
      lambda c, x: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
        3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][
        (xor(c, x) & 15) + 1])), 4294967295) AS text_crc32
  FROM digits
), run AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS below, sum(size) OVER () AS total FROM crc
), dealt AS (SELECT *, least(39, floor(below * 40.0 / total))::INTEGER AS shard FROM run)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""

OP7 = r"""
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT AS h
  FROM documents
), totals AS (SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src),
weighed AS (
  SELECT src, source_size, source_size * 3 AS cap,
    [5, 2, 1][((row_number() OVER (ORDER BY src)) - 1) % 3 + 1] AS weight
  FROM totals
), levels AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
    ((sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (SELECT arg_min(level, (ratio, src)) AS share FROM levels WHERE cap > level * weight),
targets AS (
  SELECT src, source_size, least(cap::DOUBLE, coalesce(share * weight, cap::DOUBLE)) AS target
  FROM levels LEFT JOIN final ON true
), rounds AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS full_rounds FROM targets
), hashes AS (SELECT src, h, sum(size) AS words FROM sized GROUP BY src, h),
summed AS (SELECT *, sum(words) OVER (PARTITION BY src ORDER BY h) AS upto FROM hashes),
taken AS (
  SELECT s.src, h, full_rounds + (upto + upto - words < 2 * (target - full_rounds * source_size))::INT AS copies
  FROM summed s JOIN rounds r ON r.src = s.src
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken
FROM sized JOIN taken USING (src, h) JOIN rounds USING (src)
"""

# The transcripts are written from the table, so parsing has to give the table back.
OP2 = """
SELECT conv_id, floor(turn / 64)::BIGINT AS piece,
  row_number() OVER (PARTITION BY conv_id, floor(turn / 64) ORDER BY turn) - 1 AS turn, role,
  len(string_split(text, chr(10))) AS n_lines,
  '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' AS rendered
FROM conversations
"""

OP11 = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), held AS (SELECT doc_id, len(w)::BIGINT AS n FROM tokens WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM held),
counts AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM tokens) GROUP BY ALL),
wanted AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, whole GROUP BY term, docs
), scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN held USING (doc_id), whole
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""

# Trees level by level, then every leaf climbs to its subroot and on to the root.
OP13 = """
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text, concat(
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'),
    coalesce(octet_length(encode(source)) || ':' || source, '-'),
    coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
    coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')) AS head,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      list_filter(string_split(regexp_replace(hex(encode(doc_id::VARCHAR)), '(.)(.)', '\\2\\1', 'g'), ''), lambda d: d <> ''),
      lambda d: instr('0123456789ABCDEF', d) - 1)),
      lambda c, x: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
        3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][
        (xor(c, x) & 15) + 1])) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(text)) || ':' ||
      CASE WHEN xor(crc, 4294967295) % 5 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS shown
  FROM fields
), lower AS (
  SELECT 0 AS level, tree, idx, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT level + 1, tree, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM lower WHERE n > 1 GROUP BY level, tree, idx // 16
), subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
  FROM lower WHERE n = 1
), upper AS (
  SELECT 0 AS level, idx, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM upper WHERE n > 1 GROUP BY level, idx // 16
), lower_runs AS (
  SELECT level, tree, idx // 16 AS run, list(digest ORDER BY idx) AS run_nodes FROM lower WHERE n > 1 GROUP BY ALL
), upper_runs AS (
  SELECT level, idx // 16 AS run, list(digest ORDER BY idx) AS run_nodes FROM upper WHERE n > 1 GROUP BY ALL
), climb AS (
  SELECT 0 AS level, doc_id, tree, idx, shown AS folded, '' AS proof, n FROM leaves
  UNION ALL
  SELECT c.level + 1, doc_id, c.tree, idx // 16,
    sha256(array_to_string(run_nodes[:idx % 16], '') || folded || array_to_string(run_nodes[idx % 16 + 2:], '')),
    proof || array_to_string(run_nodes[:idx % 16], '') || array_to_string(run_nodes[idx % 16 + 2:], ''), (n + 15) // 16
  FROM climb c JOIN lower_runs r ON r.level = c.level AND r.tree = c.tree AND r.run = c.idx // 16
  WHERE n > 1
), climb_on AS (
  SELECT 0 AS level, doc_id, tree, s.idx, folded, proof, s.n FROM climb JOIN subroots s USING (tree) WHERE climb.n = 1
  UNION ALL
  SELECT c.level + 1, doc_id, tree, idx // 16,
    sha256(array_to_string(run_nodes[:idx % 16], '') || folded || array_to_string(run_nodes[idx % 16 + 2:], '')),
    proof || array_to_string(run_nodes[:idx % 16], '') || array_to_string(run_nodes[idx % 16 + 2:], ''), (n + 15) // 16
  FROM climb_on c JOIN upper_runs r ON r.level = c.level AND r.run = c.idx // 16
  WHERE n > 1
)
SELECT doc_id, leaf, subroot, u.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = u.digest AS verified
FROM climb_on c JOIN leaves USING (doc_id, tree) JOIN subroots USING (tree), (SELECT digest FROM upper WHERE n = 1) u
WHERE c.n = 1
"""
