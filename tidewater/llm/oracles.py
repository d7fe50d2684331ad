"""DuckDB SQL of the operators that SQL can express."""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk
  FROM d GROUP BY source),
weighed AS (
  SELECT *, CASE rk % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CAST(source_size * 3 AS DOUBLE) AS lim
  FROM named),
filled AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(lim) OVER before, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS step
  FROM weighed
  WINDOW before AS (ORDER BY lim / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(lim, max(step) OVER () * weight) AS target,
         CAST(('0x' || substr(md5('mix-1' || coalesce(':' || source, '')), 1, 6)) AS BIGINT) / 16777216.0::DOUBLE AS u
  FROM filled),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS pos
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, least(CAST(floor(pos * rate + u) - floor((pos - 1) * rate + u) AS BIGINT), 3) AS copies FROM placed)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken
"""

WARC = r"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hexed
  FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST((CAST('0x' || substr(hexed, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)
           FOR i IN range(32)], '') AS payload_digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

TOPK = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

VARIANTS = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
  FROM range(256) AS r(b)),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
per AS (SELECT id, run, count(*) AS k, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run),
summed AS (
  SELECT run, k, xor(4294967295, list_reduce(
           list_transform(range(1, len(x), 2), lambda i: CAST(CAST('0x' || substr(x, i, 2) AS UTINYINT) AS BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) AS h
  FROM per, steps),
made AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, k FROM summed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM made WHERE len(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest, substr(word, i + 1, 1) AS c
  FROM (SELECT word, unnest(range(len(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.c <> b.c
  UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = cut.rest
  UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = cut.rest),
ranked AS (
  SELECT a, b, words.n AS bn, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY words.n DESC, b) AS rk
  FROM pairs JOIN words ON words.word = b),
forms AS (
  SELECT word, n, CASE WHEN bn >= 2 * n THEN b END AS form, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * n THEN bn END AS form_n
  FROM words LEFT JOIN ranked ON a = word AND rk = 1),
chain AS (
  SELECT word, word AS node FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.node WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, chain.node AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chain ON chain.word = forms.word JOIN forms AS last ON last.word = chain.node AND last.form IS NULL
"""

COLLOCATIONS = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, 1 AS k, w[i] AS phrase FROM placed
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM cand WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN longer g ON c.k = 2 AND g.lang = c.lang AND g.phrase = c.phrase
  WHERE g.a IS NULL OR 100 * g.a < 50 * c.a),
cuts AS (
  SELECT lang, k, phrase, a, unnest(range(1, k)) AS pos, w FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cuts.pos, x.n AS l, y.n AS r,
         CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(list_slice(w, 1, cuts.pos), ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(list_slice(w, pos + 1, cuts.k), ' ')),
least_cut AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) AS pick FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut WHERE pick = 1)
SELECT ranked.lang, rank, phrase, a, l, r, total.n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, len(regexp_replace(text, '([<\[])(\\*)(/?(?:s|SYS|ROLE|END)>|/?INST\])', '\1\\\2\3', 'g')) AS n,
         len(regexp_replace(role, '([<\[])(\\*)(/?(?:s|SYS|ROLE|END)>|/?INST\])', '\1\\\2\3', 'g')) AS rn
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS loss_sha256,
       CAST(3 + sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 13 ELSE 20 + rn END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

ORACLES = {
    "op12_chat_format": CHAT,
    "op13_collocations": COLLOCATIONS,
    "op11_spelling_variants": VARIANTS,
    "op2_exact_topk": TOPK,
    "op10_warc": WARC,
    "op3_source_mix": MIX,
}
