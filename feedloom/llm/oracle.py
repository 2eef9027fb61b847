"""DuckDB SQL for the driver queries that SQL can express on whole tables.

The others have none: token ids and hashed models are no SQL, the mix depends on
seeded hashes, spans of successive matches have no places in DuckDB, and every
100-byte string of every text is too much there.  tests/llm checks those against
brute force, exact round trips and held-out accuracy.
"""

#: Components: ids that reach each other over ``links`` (a, b), both ways round.
_REACH = """reach AS (
  SELECT id, id AS r FROM nodes
  UNION
  SELECT l.a, reach.r FROM reach JOIN links l ON reach.id = l.b),
components AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

ORACLE: dict[str, str] = {
    "op3_warc": """WITH hashed AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
placed AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS f FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(h, CAST(i * 5 + 1 AS BIGINT), 5) AS INTEGER) >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to
FROM placed""",
    "op5_jaccard_join": f"""WITH RECURSIVE worded AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingled AS (
  SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3]) END) AS s FROM worded),
nodes AS (SELECT id, CAST(len(s) AS BIGINT) AS n FROM shingled),
flat AS (SELECT id, unnest(s) AS g FROM shingled),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM flat x JOIN flat y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN nodes x ON x.id = a JOIN nodes y ON y.id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_REACH}
SELECT id AS doc_id, n AS n_shingles, component_id FROM nodes JOIN components USING (id)""",
    "op6_embedding_dedup": f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fit AS (
  SELECT * FROM nodes WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.id AS a, y.id AS b FROM fit x JOIN fit y ON x.label = y.label AND x.id <> y.id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.93),
{_REACH},
degrees AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, id = component_id AS kept
FROM components LEFT JOIN degrees USING (id)""",
    "op11_spelling_variants": r"""WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
runs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
own AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
drawn AS (
  SELECT run, n, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) AS BIGINT) - 64] END))),
    lambda s, b: xor(s >> 8, t[CAST((xor(s, b) & 255) + 1 AS BIGINT)])), 4294967295) AS h FROM own, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n FROM drawn GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.d
  UNION SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.d),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * words.n THEN most END AS form_n,
    CASE WHEN most >= 5 * words.n THEN (SELECT min(other) FROM near WHERE near.word = words.word AND near.n = most) END AS form
  FROM words LEFT JOIN best ON words.word = best.word),
chain AS (
  SELECT word, word AS reached, 0 AS steps FROM forms
  UNION ALL
  SELECT chain.word, forms.form, steps + 1 FROM chain JOIN forms ON forms.word = chain.reached WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)""",
    "op12_line_dedup": r"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS lost FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
