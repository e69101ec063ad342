"""DuckDB SQL with the same result as the query of the same name."""

TOKENS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Windows are compared as joined strings, positions are unnested, and the
# verdict is spelled out rule by rule.
op9_quality_rules = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {TOKENS} AS w FROM documents),
win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS j
    FROM win JOIN (SELECT r, g FROM win GROUP BY ALL HAVING count(*) > 1) USING (r, g)) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM (
    SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (
  SELECT doc_id, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS wc,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(t, '[^!]', '', 'g')) AS bangs,
    length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS uppers,
    len(list_filter(w, lambda x: x IN (
      'the','and','of','to','in','is','that','for','on','with','as','at','by','be','this','der','die','das',
      'und','von','zu','den','mit','ist','ein','eine','für','le','la','les','de','des','et','un','une','que',
      'en','dans','pour','est','el','los','las','y','del','por','con','una','se','no','es'))) AS stops
  FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
v AS (
  SELECT *, coalesce(wc, 0) AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND n_symbols <= 0.5 * n_words
    AND uppers <= 0.5 * wc AND bangs <= 0.5 * n_words AND n_dup_lines <= 0.6 * n_lines
    AND n_repeat_words <= 0.5 * n_words AND stops >= 0.01 * n_words AS kept
FROM v
"""

# Every document position is tried with every window length that the benchmark has.
op4_winnowing = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
place AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (
  SELECT r, i, p.n, item_id FROM place AS p JOIN win ON p.n = win.n AND array_to_string(w[i:i + p.n - 1], ' ') = g),
cov AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hit) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""

# The same targets and seeded blocks; seats go to the highest of all quotients, and words are taken block by block and
# document by document.
op6_sainte_lague = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len({TOKENS})::BIGINT AS size,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos, sum(source_size) OVER ()::BIGINT AS total FROM s0),
s2 AS (SELECT *, [3, 1, 2][pos % 3 + 1] AS weight, 2 * source_size AS cap FROM s1),
s3 AS (
  SELECT *, cap / weight AS ratio,
    (1.5::DOUBLE * total - coalesce(sum(cap) OVER q, 0)::BIGINT)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER q, 0))::BIGINT AS lv
  FROM s2 WINDOW q AS (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT coalesce(arg_min(lv, (ratio, pos)), 0) AS l FROM s3 WHERE lv <= ratio),
s AS (
  SELECT source, pos, source_size, least(cap::DOUBLE, l * weight) AS target,
    greatest(65536, ceil(total / 16384)) AS shard_words FROM s3, lv),
dealt AS (
  SELECT *, ('0x' || substr(own, 1, 8))::BIGINT % greatest(ceil(source_size / shard_words)::BIGINT, 1) AS shard FROM (
    SELECT r, doc_id, size, pos, source_size, target, shard_words, CASE WHEN sum(size) OVER c > shard_words
      THEN md5('mix-1:' || key || ':' || (row_number() OVER c2 - 1)) ELSE key END AS own
    FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
    WINDOW c AS (PARTITION BY pos, key), c2 AS (PARTITION BY pos, key ORDER BY r))),
line AS (
  SELECT *, sum(size) OVER (PARTITION BY pos, shard ORDER BY own, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM dealt),
sh0 AS (
  SELECT pos, shard, sum(size)::BIGINT AS words, any_value(target) AS target, any_value(source_size) AS ss
  FROM dealt GROUP BY pos, shard HAVING sum(size) > 0),
sh1 AS (
  SELECT *, (words + 63) // 64 AS blocks, floor(target * ((words + 63) // 64) / ss * 1024)::BIGINT AS want FROM sh0),
won AS (
  SELECT pos, shard, count(*) AS quota FROM (
    SELECT pos, shard, row_number() OVER (ORDER BY want / (2 * k + 1) DESC, pos, shard, k) AS rk
    FROM (SELECT *, unnest(range(0, 2 * blocks)) AS k FROM sh1 WHERE want > 0))
  WHERE rk <= (SELECT (sum(want)::BIGINT + 512) // 1024 FROM sh1) GROUP BY pos, shard),
q AS (SELECT sh1.pos, sh1.shard, words, blocks, coalesce(quota, 0) AS quota FROM sh1 LEFT JOIN won USING (pos, shard)),
b AS (
  SELECT *, row_number() OVER (PARTITION BY pos, shard ORDER BY md5('mix-1:' || pos || ':' || shard || ':' || block), block)
    AS turn FROM (SELECT *, unnest(range(0, blocks)) AS block FROM q)),
t AS (
  SELECT pos, shard, (block * words) // blocks AS lo, ((block + 1) * words) // blocks AS hi,
    quota // blocks + (turn <= quota % blocks)::BIGINT AS times FROM b),
taken AS (
  SELECT r, sum((least(stop, hi) - greatest(stop - size, lo)) * times)::BIGINT AS taken
  FROM line JOIN t ON line.pos = t.pos AND line.shard = t.shard AND lo < stop AND hi > stop - size GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM line LEFT JOIN taken USING (r)
"""

# Prefixes are compared as whole rendered strings.
op3_snapshot_collapse = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (
  SELECT conv_id, row_number() OVER w AS pos, '<|' || role || '|>' || chr(10) || text || chr(10) AS line
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (
  SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n,
    string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS upto FROM l),
h AS (SELECT n, upto, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE pos = n GROUP BY n, upto)
SELECT conv_id, n::BIGINT AS n_turns, n_copies::BIGINT AS n_copies, upto AS rendered FROM h
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = h.n AND p.upto = h.upto)
"""

# Lines are compared as text; documents are rows.
op12_line_runs = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT r, i, ls[i] AS line, translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
c AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
m AS (SELECT l.*, c.k IS NOT NULL AS gone FROM l LEFT JOIN c ON l.k = c.k),
g AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256
FROM d JOIN g USING (r)
"""

# Every document that shares a term with an item is scored in full.
op13_nra_search = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (
  SELECT i, item_id, t, count(*)::BIGINT AS times FROM (
    SELECT i, item_id, unnest({WORDS}) AS t FROM (SELECT row_number() OVER () AS i, * FROM
      (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY ALL),
wt AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, c WHERE t IN (SELECT t FROM q) GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 75 + (25 * len(w)::BIGINT * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0),
s AS (
  SELECT i, item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY i, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

# Nodes are whole prefixes as lists; every node adds its figures to each node on its path.  The CRC-32 of an id's
# decimal digits is taken bit by bit: each digit's code, then eight shifts (marked -1).
op11_veb_trie = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    [coalesce(role, ''), coalesce(text, '')] AS said
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS len FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, len, conv_id - conv_id % 20 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
    4294967295) % 4 AS h FROM n),
p AS (SELECT h.*, least(h, coalesce(n.len, 0)) AS copied FROM h LEFT JOIN n ON n.conv_id = h.base),
s AS (
  SELECT p.conv_id, pos - h + copied AS pos, said FROM p JOIN t ON t.conv_id = p.conv_id AND pos > h
  UNION ALL SELECT p.conv_id, pos, said FROM p JOIN t ON t.conv_id = base AND pos <= copied),
x AS (SELECT conv_id, pos AS depth, said, list(said) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM s),
nm AS (SELECT conv_id, depth, said, min(conv_id) OVER (PARTITION BY prefix) AS name FROM x
  UNION ALL SELECT conv_id, 0, NULL, (SELECT min(conv_id) FROM p) FROM p),
v AS (
  SELECT name, depth, count(*) AS n_convs,
    (count(*) - 1) * len(regexp_extract_all(any_value(said)[2], '[^\x20\x09-\x0D]+')) AS tokens
  FROM nm GROUP BY name, depth),
up AS (SELECT v.name, v.depth, nm.name AS parent FROM v JOIN nm ON nm.conv_id = v.name AND nm.depth = v.depth - 1),
ch AS (SELECT parent AS name, depth - 1 AS depth, count(*) AS n_children FROM up GROUP BY ALL),
sub AS (
  SELECT nm.name, nm.depth, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(coalesce(tokens, 0)) AS saved
  FROM v LEFT JOIN ch USING (name, depth) JOIN nm ON nm.conv_id = v.name AND nm.depth <= v.depth GROUP BY ALL),
e AS (
  SELECT name, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM nm WHERE depth = (SELECT count(*) FROM s WHERE s.conv_id = nm.conv_id) GROUP BY ALL)
SELECT name AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM v LEFT JOIN up USING (name, depth) LEFT JOIN ch USING (name, depth) JOIN sub USING (name, depth)
LEFT JOIN e USING (name, depth)
"""
