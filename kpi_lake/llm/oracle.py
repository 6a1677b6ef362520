"""DuckDB SQL of the registered queries that SQL can express.

None is given for the suffix tree, the tokenization automaton, the url model, the suffix-array
verdict, the resampling and the token files: their tests hold them against plain versions.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Five hexadecimal digits are four base-32 digits; a SHA-1 is eight such parts.
_BASE32 = """
array_to_string(list_transform(range(0, 8), lambda k:
  array_to_string(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST(('0x' || substr(sha1(payload), 5 * k + 1, 5)) AS BIGINT) >> (15 - 5 * j)) & 31 AS INTEGER), 1)), '')), '')
"""

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
r AS (SELECT payload, max(page_id) AS response FROM p GROUP BY payload)
SELECT p.page_id, CAST(octet_length(encode(p.payload)) AS BIGINT) AS payload_bytes, {_BASE32.replace('payload', 'p.payload').strip()} AS payload_digest,
       CASE WHEN p.page_id = r.response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> r.response THEN r.response END AS refers_to
FROM p JOIN r ON p.payload = r.payload
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM sides UNION SELECT reach.doc_id, sides.b FROM reach JOIN sides ON sides.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(least.component_id, d.doc_id) AS component_id,
       coalesce(least.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""

SUFFIX_SORT = """
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
),
pieces AS (SELECT doc_id, n, c, substr(h, 400 * c + 1, 800) AS piece FROM (SELECT doc_id, h, n, unnest(range(0, n // 200)) AS c FROM b WHERE n >= 200)),
w AS (
  SELECT doc_id, 200 * c + j + 1 AS i, md5(substr(piece, 2 * j + 1, 400)) AS k
  FROM (SELECT doc_id, n, c, piece, unnest(range(0, 200)) AS j FROM pieces) WHERE 200 * c + j <= n - 200
),
r AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
e AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER o <= 200 THEN 0 ELSE 1 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e),
runs AS (SELECT doc_id, run, min(i) AS first, max(i) + 199 AS last FROM g GROUP BY doc_id, run),
gaps AS (
  SELECT runs.doc_id, first, last, lead(first) OVER (PARTITION BY runs.doc_id ORDER BY first) AS next, run FROM runs
),
cut AS (
  SELECT gaps.doc_id, sum(last - first + 1) AS removed, count(*) AS spans,
         string_agg((CASE WHEN run = 1 THEN substr(h, 1, 2 * (first - 1)) ELSE '' END)
                    || substr(h, 2 * last + 1, 2 * (coalesce(next, n + 1) - last - 1)), '' ORDER BY first) AS kept
  FROM gaps JOIN b ON b.doc_id = gaps.doc_id GROUP BY gaps.doc_id
)
SELECT b.doc_id, CAST(b.n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN cut ON cut.doc_id = b.doc_id
"""

DECONTAMINATE = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents
),
q AS (
  SELECT item_id, list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM q WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, item_id, places.size, i FROM places JOIN windows ON windows.size = places.size AND windows.win = places.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
c AS (
  SELECT *, 14 + length(regexp_replace(role, '(\\|###|:|\n)', '\\\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) AS size
  FROM given
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

SPELLING = r"""
WITH RECURSIVE poly AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS t
),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL),
lowered AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS x FROM lowered
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: CAST(('0x' || substr(x, 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM bytes, poly
),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n) AS n FROM hashed GROUP BY 1
),
v AS (SELECT word, CAST(n AS BIGINT) AS n FROM words WHERE length(word) >= 6 AND n >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN v b ON a.rest = b.word
),
near AS (
  SELECT a AS word, count(*) AS n_near, min(struct_pack(m := -v.n, w := encode(b))) AS best FROM pairs JOIN v ON v.word = b GROUP BY a
),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * v.n THEN decode(best.w) END AS form, CASE WHEN -best.m >= 5 * v.n THEN -best.m END AS form_n
  FROM v LEFT JOIN near ON near.word = v.word
),
steps AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT steps.word, formed.form FROM steps JOIN formed ON formed.word = steps.at WHERE formed.form IS NOT NULL
),
ends AS (SELECT steps.word, steps.at AS root FROM steps JOIN formed ON formed.word = steps.at WHERE formed.form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN ends ON ends.word = formed.word
"""

RANKED = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY ALL
),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, totals),
scores AS (
  SELECT item_id, tf.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf ON tf.term = asked.term JOIN weights ON weights.term = asked.term JOIN sizes ON sizes.doc_id = tf.doc_id, totals
  GROUP BY item_id, tf.doc_id
),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLE: dict[str, str] = {
    "op3_warc_shards": WARC,
    "op6_bbit_minhash": NEAR_DUPLICATES,
    "op7_suffix_sort": SUFFIX_SORT,
    "op8_decontaminate": DECONTAMINATE,
    "op9_chat_events": CHAT,
    "op11_frequency_trie": SPELLING,
    "op12_k2_treap": RANKED,
}
