"""DuckDB SQL that some operator queries must equal, over the whole tables.

The other operators have none: substring dedup, the Jaccard join and the license scan need window comparisons that take
SQL too long on whole tables, the language model, language ID, media, chat and WARC round trips aren't relational. Their
queries are tested against brute force.
"""

OP5 = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
grams AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM wins) AS sizes WHERE len(w) >= n)),
found AS (SELECT r, i, grams.n, item_id FROM grams JOIN wins ON grams.n = wins.n AND grams.win = wins.win),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""



def _halved(level: int) -> str:
    """The tickets of a level's nodes, ranked by hash; the smaller half goes to the left node of the next level."""
    h = f"('0x' || md5(node || ':' || coalesce(source, '') || ':' || i)[1:8])::BIGINT"
    return f"""
t{level} AS (SELECT node, source, unnest(range(1, quota + 1)) AS i FROM q{level}),
r{level} AS (
  SELECT node, source, count(*) OVER (PARTITION BY node) AS total, row_number() OVER (PARTITION BY node ORDER BY {h}, source COLLATE C ASC NULLS LAST, i) AS rn
  FROM t{level}),
q{level + 1} AS (SELECT node * 2 + CASE WHEN rn <= (total + node % 2) // 2 THEN 0 ELSE 1 END AS node, source, count(*) AS quota FROM r{level} GROUP BY 1, 2),"""


OP9 = r"""
WITH light AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, md5(text), '') AS name
  FROM documents),
dealt AS (SELECT *, (('0x' || md5(name)[1:8])::BIGINT % 256)::INTEGER AS block, (('0x' || md5(name)[9:16])::BIGINT % 256)::INTEGER AS part FROM light),
blocks AS (SELECT source, block, sum(size)::BIGINT AS words FROM dealt GROUP BY ALL),
sizes AS (SELECT source, sum(words)::BIGINT AS source_size FROM blocks GROUP BY ALL),
weighed AS (
  SELECT source, source_size, 2 * source_size AS cap, [5, 2, 1][((row_number() OVER (ORDER BY source COLLATE C ASC NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM sizes),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)::BIGINT) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source COLLATE C ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels),
ordered AS (
  SELECT b.source, b.block, words, source_size, target, ('0x' || md5(coalesce(b.source, '') || ':' || b.block)[1:8])::BIGINT AS hashed, count(*) OVER (PARTITION BY b.source) AS n_blocks
  FROM blocks b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, row_number() OVER line - 1 AS rank, coalesce(sum(words) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM ordered WINDOW line AS (PARTITION BY source ORDER BY hashed, block)),
drawn AS (
  SELECT source, block, pass, pass * n_blocks + rank AS draw
  FROM ranked, (SELECT unnest([0, 1]) AS pass) WHERE words > 0 AND round(target)::BIGINT - pass * source_size - ahead > 0),
q0 AS (SELECT 1 AS node, source, max(draw) + 1 AS quota FROM drawn GROUP BY source),""" + "".join(_halved(i) for i in range(3)) + r"""
shards AS (SELECT source, node - 8 AS shard, sum(quota) OVER (PARTITION BY source ORDER BY node) AS upto, quota FROM q3),
sent AS (SELECT d.source, d.block, d.pass, s.shard FROM drawn d JOIN shards s ON d.source IS NOT DISTINCT FROM s.source AND d.draw >= s.upto - s.quota AND d.draw < s.upto),
by_block AS (SELECT source, block, max(shard) FILTER (pass = 0) AS s0, max(shard) FILTER (pass = 1) AS s1 FROM sent GROUP BY ALL),
placed AS (
  SELECT d.*, source_size, target, round(target)::BIGINT AS room, s0, s1,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY r.hashed, d.block, d.part, ('0x' || md5('doc:' || name)[1:8])::BIGINT, name, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_doc
  FROM dealt d JOIN ranked r ON d.source IS NOT DISTINCT FROM r.source AND d.block = r.block
  LEFT JOIN by_block b ON d.source IS NOT DISTINCT FROM b.source AND d.block = b.block),
halves AS (SELECT *, greatest(0, least(size, room - before_doc)) AS t0, greatest(0, least(size, room - source_size - before_doc)) AS t1 FROM placed)
SELECT doc_id, size, source_size, target, (t0 + t1)::BIGINT AS taken,
       concat_ws(',', CASE WHEN t0 > 0 THEN s0 || ':' || t0 END, CASE WHEN t1 > 0 THEN s1 || ':' || t1 END) AS shards
FROM halves
"""

OP11 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents)),
failed AS (
  SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER same, min(doc_id) OVER same IS NOT NULL)::INT AS mask
  FROM docs WINDOW same AS (PARTITION BY text)),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY 1),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT substr('ABCDE', i::INT, 1) AS f, (1 << (i - 1))::INT AS bit FROM range(1, 6) r(i)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS filter, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) r(step)),
counted AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM steps, cells GROUP BY ALL)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM counted
"""


OP12 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, i, lines[i] AS line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM docs)),
held AS (
  SELECT key, max(doc_id) AS last, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS n FROM lines WHERE len(key) >= 20 GROUP BY 1),
judged AS (
  SELECT r, i, line, coalesce(n >= 3 AND l.doc_id IS DISTINCT FROM last, FALSE) AS gone FROM lines l LEFT JOIN held USING (key))
SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs JOIN (SELECT r, count(*) FILTER (WHERE gone) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM judged GROUP BY 1) USING (r)
"""


OP13 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs),
terms AS (SELECT lang, term, count(*) AS n FROM words GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
posted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN terms USING (lang, term) GROUP BY 1, 2, 3),
vocabulary AS (SELECT lang, count(*) AS v, sum(n) AS total FROM terms GROUP BY 1),
sized AS (
  SELECT g.lang, g.source, coalesce(sum(p.n), 0)::HUGEINT + any_value(v.v) AS size, any_value(v.total)::HUGEINT + any_value(v.v) AS lang_size
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN vocabulary v USING (lang) LEFT JOIN posted p ON p.lang = g.lang AND p.source = g.source GROUP BY 1, 2),
dense AS (
  SELECT s.lang, s.source, term, coalesce(p.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(p.n, 0) + 1)) // size AS p,
         1 + (1000000000::HUGEINT * (t.n + 1)) // lang_size AS q
  FROM sized s JOIN terms t USING (lang) LEFT JOIN posted p USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(((a.p - b.p) * (a.p - b.p)) // b.p), 0)::BIGINT AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
lone AS (
  SELECT a.lang, a.source, b.source AS item, 0::BIGINT AS value FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM vocabulary)),
named AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE C ASC) AS rank
  FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'pair' FROM lone UNION ALL SELECT *, 'term' FROM named))
WHERE part = 'pair' OR rank <= 200
"""

SQL = {"op5_decontamination": OP5, "op9_source_mixing": OP9, "op11_filter_audit": OP11, "op12_line_dedup": OP12, "op13_source_divergence": OP13}
