"""The queries as SQL for DuckDB, where SQL can express them.

Hashes of 64 bits (2), learned models (1, 5, pipeline) and tokenizers (10, 11) are beyond SQL; tests hold those queries against
brute force.
"""

from __future__ import annotations

_BLANKS = r"\x20\x09-\x0D"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES = rf"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, line_no, line, trim(regexp_replace(lower(line), '[{_BLANKS}]+', ' ', 'g'), ' ') AS norm FROM numbered
), contents AS (
  SELECT norm, min({{'doc': doc_id, 'line': line_no}}) AS place, len(string_split(norm, ' ')) >= 5 AS by_words FROM lines WHERE norm <> '' GROUP BY norm
), units AS (
  SELECT norm, place, by_words, CASE WHEN by_words THEN string_split(norm, ' ')
    ELSE list_transform(range(1, length(norm) + 1), lambda i: substr(norm, i, 1)) END AS units
  FROM contents WHERE by_words OR length(norm) >= 5
), variants AS (
  SELECT norm, place, by_words, len(units) AS n, unnest(range(1, len(units) + 1)) AS gap, units FROM units
), gaps AS (
  SELECT norm, place, by_words, n, gap,
    CASE WHEN by_words THEN array_to_string(list_concat(units[:gap - 1], units[gap + 1:]), ' ')
      ELSE substr(norm, 1, gap - 1) || substr(norm, gap + 1) END AS rest FROM variants
), near AS (
  SELECT a.norm FROM gaps a JOIN (SELECT by_words, n, gap, rest, min(place) AS place FROM gaps GROUP BY ALL) b USING (by_words, n, gap, rest)
  WHERE b.place < a.place
  UNION SELECT a.norm FROM gaps a JOIN units b ON a.rest = b.norm AND a.by_words = b.by_words WHERE b.place < a.place
  UNION SELECT b.norm FROM gaps a JOIN units b ON a.rest = b.norm AND a.by_words = b.by_words WHERE a.place < b.place
), judged AS (
  SELECT l.doc_id, l.line_no, l.line,
    l.norm = '' OR (n.norm IS NULL AND c.place = {{'doc': l.doc_id, 'line': l.line_no}}) AS stays
  FROM lines l LEFT JOIN contents c USING (norm) LEFT JOIN near n USING (norm)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (stays) AS n_kept,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_CRC_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"


def _crc_table() -> str:
    """The 256 remainders of the checksum, from its polynomial: eight shifts of each byte."""
    steps = "n"
    for _ in range(8):
        steps = f"list_transform([{steps}], lambda v: {_CRC_STEP.format('v')})[1]"
    return f"(SELECT list({steps} ORDER BY n) AS remainders FROM range(256) t(n))"


_SHARDS = f"""
WITH bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS digits FROM documents
), sums AS (
  SELECT doc_id, size, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
    lambda sum, byte: xor(sum >> 8, remainders[(xor(sum, byte) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM bytes, {_crc_table()}
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM sums
), cut AS (
  SELECT *, (((2 * start + size) * 16) // (2 * total))::INT AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM cut
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CONTAMINATION = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS length,
    array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS part
  FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS i FROM items WHERE len(words) > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents
), found AS (
  SELECT DISTINCT d.doc_id, d.i, d.length, w.item_id FROM (
    SELECT doc_id, length, i, array_to_string(words[i:i + length - 1], ' ') AS part FROM (
      SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS i
      FROM docs, (SELECT DISTINCT length FROM windows) WHERE len(words) >= length)
  ) d JOIN windows w USING (length, part)
), hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + length)) AS spot FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_QUALITY = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{_BLANKS}]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS part FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM docs WHERE len(words) >= 8)
), repeated AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS spot FROM windows JOIN (SELECT doc_id, part FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, part)
  ) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, line, regexp_extract_all(line, '[^{_BLANKS}]+') AS words FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM docs)
), equal AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE len(words) > 0 GROUP BY doc_id
), normal AS (
  SELECT doc_id, host, len(words) AS n, regexp_replace(array_to_string(
    regexp_extract_all({_LOWER.replace("text", "line")}, '[^{_BLANKS}]+'), ' '), '[0-9]+', '0', 'g') AS line
  FROM lines WHERE len(words) > 0
), frequent AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT doc_id) AS n FROM normal GROUP BY ALL)
  JOIN (SELECT host, count(DISTINCT doc_id) AS of_host FROM docs GROUP BY host) USING (host) WHERE n > 10 AND 20 * n > of_host
), gone AS (
  SELECT doc_id, sum(n) AS n FROM normal JOIN frequent USING (host, line) GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(e.n, 0)::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0)::BIGINT AS n_frequent_words
  FROM docs d LEFT JOIN repeated r USING (doc_id) LEFT JOIN equal e USING (doc_id) LEFT JOIN gone g USING (doc_id)
), failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND 2 * n_frequent_words <= n_words AND n_words - n_frequent_words >= 20 AS kept FROM failed
"""

_PREFERENCE = """
WITH chosen AS (
  SELECT conv_id AS pair_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS position, turn, role, text FROM conversations
), last AS (
  SELECT conv_id AS pair_id, max(turn) AS turn, max_by(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), rejected AS (
  SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role) - 1 AS position, role, text FROM (
    SELECT c.conv_id AS pair_id, c.turn, c.role, CASE WHEN l.turn IS NULL THEN c.text ELSE o.text END AS text,
      l.turn IS NOT NULL AND o.pair_id IS NULL AS left_out
    FROM conversations c LEFT JOIN last l ON l.pair_id = c.conv_id AND l.turn = c.turn AND c.role = 'assistant'
    LEFT JOIN last o ON o.pair_id = xor(c.conv_id, 1)
  ) WHERE NOT left_out
), forks AS (
  SELECT pair_id, min(position) AS fork FROM chosen c FULL JOIN rejected r USING (pair_id, position)
  WHERE c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text GROUP BY pair_id
), parts AS (
  SELECT c.pair_id, CASE WHEN fork IS NULL OR position < fork THEN 'prompt' ELSE 'chosen' END AS part, position, role, text
  FROM chosen c LEFT JOIN forks USING (pair_id)
  UNION ALL SELECT r.pair_id, 'rejected', position, role, text FROM rejected r JOIN forks USING (pair_id) WHERE position >= fork
), written AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered FROM parts
), placed AS (
  SELECT *, (sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY position) - length(rendered))::BIGINT AS start FROM written
)
SELECT pair_id, part, position, role, rendered, start,
  start + CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 ELSE 0 END AS learn_from,
  start + CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(rendered) ELSE 0 END AS learn_to
FROM placed
"""

_SUBSTRINGS = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_BLANKS}]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS part FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS spot FROM windows JOIN (SELECT part, min(doc_id) AS least FROM windows GROUP BY part) USING (part) WHERE doc_id > least
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS spot FROM docs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS words, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, (len(d.words) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.words, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

_HARD_NEGATIVES = """
WITH fit AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), long AS (
  SELECT vec_id, label, unnest(vector) AS x, unnest(range(len(vector))) AS i FROM fit
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, sum(a.x * r.x)::BIGINT AS score
  FROM long a JOIN long r USING (i) WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""

_TRIE = f"""
WITH convs AS (
  SELECT conv_id, count(*) AS n, hex(encode(conv_id::VARCHAR)) AS digits, len(conv_id::VARCHAR) AS size
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS donor, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(size), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
    lambda sum, byte: xor(sum >> 8, remainders[(xor(sum, byte) & 255) + 1])), 4294967295::BIGINT) % 9 AS head
  FROM convs, {_crc_table()}
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos,
    octet_length(encode(coalesce(text, ''))) AS bytes, md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations
), spliced AS (
  SELECT c.conv_id, pos AS depth, bytes, digest FROM heads c JOIN turns t ON t.conv_id = c.donor AND pos <= head
  UNION ALL
  SELECT c.conv_id, pos - head + least(head, coalesce(d.n, 0)), bytes, digest
  FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND pos > head LEFT JOIN convs d ON d.conv_id = c.donor
), paths AS (
  SELECT conv_id, depth, bytes, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM spliced
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT path, min(conv_id) AS conv_id, min(depth) AS depth, min(bytes) AS bytes, count(*) AS n_convs FROM paths GROUP BY path
), families AS (
  SELECT left(path, 32 * (depth - 1)::INT) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), sums AS (
  SELECT p.path, sum((n_convs - 1) * n.bytes) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
  FROM nodes n LEFT JOIN families f ON f.path = n.path JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.path
), ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
  FROM (SELECT conv_id, path FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s ON s.path = n.path LEFT JOIN families f ON f.path = n.path LEFT JOIN ends e ON e.path = n.path
LEFT JOIN nodes u ON n.depth > 0 AND u.path = left(n.path, 32 * (n.depth - 1)::INT)
"""

ORACLE: dict[str, str] = {
    "op3_line_dedup": _LINES,
    "op4_sharding": _SHARDS,
    "op6_decontamination": _CONTAMINATION,
    "op7_quality": _QUALITY,
    "op8_preference": _PREFERENCE,
    "op9_substrings": _SUBSTRINGS,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_prefix_trie": _TRIE,
}
