"""SQL pieces that several queries share."""

#: A table ``crc`` with the one row ``step``: what each byte value adds to a CRC-32 (reflected polynomial 0xEDB88320).
CRC = """
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS step)"""


def crc32(text: str) -> str:
    """The CRC-32 of a string, where ``crc`` is in the FROM clause."""
    codes = f"list_transform(range(0, strlen(hex(encode({text}))) // 2), lambda b: CAST(('0x' || substr(hex(encode({text})), CAST(2 * b + 1 AS BIGINT), 2)) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: xor(c >> 8, crc.step[CAST(xor(c & 255, b) + 1 AS BIGINT)])), 4294967295)"


#: Runs by all pairs of equal words in a document.
RUNS = f"""
WITH {CRC},
d AS (
  SELECT doc_id, ws, CAST(len(ws) AS BIGINT) AS n, {crc32('CAST(doc_id AS VARCHAR)')} AS h
  FROM (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents), crc),
e AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM d),
w AS (
  SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM e)),
same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same) GROUP BY doc_id, q, g),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
r AS (
  SELECT doc_id, count(*) AS n_runs, arg_min(start, (-length, start, period)) AS start, max(length) AS length,
    arg_min(period, (-length, start, period)) AS period, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


#: Near words by deleting one letter at each place.
SPELLING = f"""
WITH RECURSIVE {CRC},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
hashed AS (SELECT run, {crc32("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM runs, crc WHERE length(run) >= 7),
words AS (
  SELECT word, count(*) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS near, y.n FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.rest = y.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM near GROUP BY word),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * words.n THEN near END AS form, CASE WHEN near_n >= 10 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL SELECT formed.word, chain.root FROM formed JOIN chain ON formed.form = chain.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""


#: Links by the shingles that two documents share, and everything that can be reached over them.
NGRAM_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1), lambda i: array_to_string(ws[i : i + 2], ' '))) AS sh FROM w),
one AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least_b, doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS least_b FROM reach GROUP BY a) ON a = doc_id
"""


#: Every 400-byte string by its hash; texts as hexadecimal digits, two for a byte.
SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, i, hash(h[2 * i + 1 : 2 * i + 800]) AS k FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 399)) AS i FROM d)),
hits AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM starts SEMI JOIN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1) USING (k)),
numbered AS (SELECT *, sum(CAST(before IS NULL OR i > before + 400 AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, run),
cuts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, list(b ORDER BY a) AS ends, list(a ORDER BY a) AS begins FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN ends IS NULL THEN h ELSE list_reduce(list_prepend('', list_transform(range(0, len(ends) + 1),
    lambda k: h[CASE WHEN k = 0 THEN 1 ELSE 2 * ends[k] + 1 END : CASE WHEN k = len(ends) THEN strlen(h) ELSE 2 * begins[k + 1] END])), lambda x, y: x || y) END)) AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)
"""
