"""DuckDB SQL for the queries that SQL can express; nothing here runs in Spark."""

from __future__ import annotations

_URL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC) AS n
  FROM parts, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.page_id = fits.page_id AND n = 1
"""

_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_LM = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
  SELECT r, i, ws[i] AS w1, CASE WHEN i > 1 THEN ws[i - 1] END AS w2, CASE WHEN i > 2 THEN ws[i - 2] END AS w3
  FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)
), c AS (
  SELECT r, i, w2, w3, count(*) OVER () AS c0, count(*) OVER (PARTITION BY w1) AS c1,
    count(*) OVER (PARTITION BY w2, w1) AS c2, count(*) OVER (PARTITION BY w3, w2, w1) AS c3 FROM w
), s AS (
  SELECT r, i, w2, w3, c1, c2, c3, c0, lag(c1) OVER p AS x1, lag(CASE WHEN w2 IS NOT NULL THEN c2 END) OVER p AS x2 FROM c WINDOW p AS (PARTITION BY r ORDER BY i)
), t AS (
  SELECT r, w3, c3, x2, CASE WHEN w2 IS NULL THEN ln(c1) - ln(c0) WHEN c2 >= 2 THEN ln(c2) - ln(x1) ELSE ln(0.4) + ln(c1) - ln(c0) END AS two FROM s
), u AS (
  SELECT r, sum(CASE WHEN w3 IS NULL THEN two WHEN c3 >= 2 THEN ln(c3) - ln(x2) ELSE ln(0.4) + two END) AS total FROM t GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(coalesce(total, 0.0), 4)::DOUBLE AS log_score FROM d LEFT JOIN u USING (r)
"""

_MIX = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), h AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || size::VARCHAR), 1, 6))::BIGINT AS hash FROM d), s AS (
  SELECT source, n, pos, [3.0, 1.0, 2.0][pos % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * n AS cap, ceil(n / 128.0)::BIGINT AS blocks
  FROM (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS pos FROM d GROUP BY source)
), l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(n) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY cap / w, pos) AS k FROM s WHERE cap > 0
), f AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM l WHERE level * w <= cap), t AS (
  SELECT s.*, coalesce(CASE WHEN l.k >= (SELECT k FROM f) THEN (SELECT level FROM f) * s.w ELSE l.cap END, 0.0) AS target FROM s LEFT JOIN l USING (pos)
), n AS (SELECT floor(1.5 * sum(n) / 128 + 0.5)::BIGINT AS seats FROM s), q AS (
  SELECT pos, seat.range AS seat, row_number() OVER (ORDER BY target / (2 * seat.range + 1) DESC, pos) AS place FROM t, range((SELECT 2 * max(blocks) FROM t)) seat WHERE seat.range < 2 * blocks AND target > 0
), g AS (
  SELECT pos, seat, (SELECT count(*) FROM range(16) k WHERE place > seats * (k.range + 1) // 16) AS shard FROM q, n WHERE place <= seats
), m AS (
  SELECT *, (7 * 1000003 * (pos + 1)) % greatest(blocks, 1) AS shift, CASE WHEN blocks % 1000003 <> 0 THEN 1000003 WHEN blocks % 999983 <> 0 THEN 999983 ELSE 1 END AS step FROM t
), p AS (
  SELECT r, doc_id, size, m.pos, m.n, m.target, m.blocks, m.step, m.shift, sum(size) OVER (PARTITION BY m.pos ORDER BY hash, doc_id NULLS FIRST, size, r ROWS UNBOUNDED PRECEDING) - size AS spot
  FROM h JOIN m ON h.source IS NOT DISTINCT FROM m.source
), b AS (SELECT *, unnest(range((spot // 128)::BIGINT, ((spot + size - 1) // 128)::BIGINT + 1)) AS k FROM p WHERE size > 0), e AS (
  SELECT r, shard, sum(least((k + 1) * 128, spot + size) - greatest(k * 128, spot))::BIGINT AS words
  FROM b, range(2) turn JOIN g ON g.pos = b.pos AND g.seat = turn.range * blocks + (k * step + shift) % blocks GROUP BY r, shard
), x AS (SELECT r, sum(words)::BIGINT AS taken, string_agg(shard || ':' || words, ',' ORDER BY shard) AS shard_words FROM e GROUP BY r)
SELECT doc_id, size, n AS source_size, target, coalesce(taken, 0) AS taken, coalesce(shard_words, '') AS shard_words FROM p LEFT JOIN x USING (r)
"""

_NEAR = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS shingle FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT node AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(root) AS component_id FROM r LEFT JOIN n ON n.doc_id = node GROUP BY node
"""

_SHARDS = r"""
WITH RECURSIVE slots(n, c, i) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1 FROM slots WHERE i < 8
), crc AS (SELECT list(c ORDER BY n) AS t FROM slots WHERE i = 8), d AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) + 1 AS size, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda b: ('0x' || b)::BIGINT) AS bytes FROM documents
), k AS (
  SELECT r, doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, crc
), j(r, state, jump, chunk, a, b, i) AS (
  SELECT r, (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616, 0::BIGINT, NULL::BIGINT, 0::BIGINT, 0::BIGINT, 0 FROM k
  UNION ALL
  SELECT r, next, CASE WHEN jump < 17 THEN least(floor((jump + 1)::DOUBLE * (2147483648.0::DOUBLE / (draw + 1)::DOUBLE)), 17)::BIGINT ELSE jump END, coalesce(chunk, draw),
    CASE WHEN jump < 16 THEN jump ELSE a END, CASE WHEN jump < 17 THEN jump ELSE b END, i + 1
  FROM (SELECT *, (next // 8589934592)::BIGINT AS draw FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM j)) WHERE i < 18
)
SELECT doc_id, size, text_crc32, 'key' AS law, a::INTEGER AS shard, row_number() OVER (PARTITION BY a ORDER BY chunk % 1024, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, b::INTEGER AS grown_shard
FROM k JOIN j USING (r) WHERE i = 18
"""

_REPEATS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents), cut AS (
  SELECT r, 512 * k AS base, least(512, n - 399 - 512 * k) AS starts, substr(h, 1024 * k + 1, 1822) AS h FROM (SELECT r, h, n, unnest(range(0, (n - 400) // 512 + 1)) AS k FROM d WHERE n >= 400)
), w AS MATERIALIZED (SELECT r, base + j AS i, md5_number(substr(h, 2 * j + 1, 800)) AS m FROM (SELECT r, base, h, unnest(range(0, starts)) AS j FROM cut)), hit AS (SELECT r, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)), s AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS first FROM hit
), g AS (SELECT r, i, sum(first) OVER (PARTITION BY r ORDER BY i) AS run FROM s), runs AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY r, run), parts AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM runs UNION ALL SELECT r, max(b), n FROM runs JOIN d USING (r) GROUP BY r, n
), kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM parts JOIN d USING (r) GROUP BY r), gone AS (
  SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY r
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM d LEFT JOIN kept USING (r) LEFT JOIN gone USING (r)
"""

_PRINTS = r"""
WITH d AS (
  SELECT row_number() OVER o AS r, doc_id, coalesce(text, '') AS t, coalesce(lead(text) OVER o, CASE WHEN lead(1) OVER o IS NULL THEN first_value(text) OVER o END, '') AS next FROM documents
  WINDOW o AS (ORDER BY doc_id NULLS FIRST, coalesce(text, '') ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), x AS (
  SELECT r, 0 AS e, t FROM d UNION ALL SELECT r, 1, left(t, length(t) - length(t) // 2) || left(next, length(t) // 2) FROM d
), b AS (
  SELECT r, e, i, ('0x' || h)::BIGINT AS b0 FROM (SELECT r, e, unnest(h) AS h, unnest(range(1, len(h) + 1)) AS i FROM (SELECT r, e, regexp_extract_all(hex(t), '..') AS h FROM x))
), five AS (
  SELECT r, e, b0, lead(b0, 1) OVER p AS b1, lead(b0, 2) OVER p AS b2, lead(b0, 3) OVER p AS b3, lead(b0, 4) OVER p AS b4 FROM b WINDOW p AS (PARTITION BY r, e ORDER BY i)
), three AS (
  SELECT r, e, unnest([
    xor((b0 * 40503 + b1 * 31153) & 65535, (b2 * 34283) & 65535), xor((b0 * 49843 + b1 * 10197) & 65535, (b3 * 5719) & 65535), xor((b0 * 46413 + b2 * 15471) & 65535, (b3 * 42319) & 65535),
    xor((b0 * 20751 + b1 * 39685) & 65535, (b4 * 8067) & 65535), xor((b0 * 52155 + b2 * 25243) & 65535, (b4 * 37209) & 65535), xor((b0 * 5423 + b3 * 26419) & 65535, (b4 * 36533) & 65535)]) AS h
  FROM five WHERE b4 IS NOT NULL
), c AS (
  SELECT r, e, ((h * 40501) & 65535) >> 6 AS bucket, count(*) AS n FROM three GROUP BY ALL
  UNION ALL SELECT DISTINCT r, e, b0, 1 FROM b WHERE (r, e) IN (SELECT (r, e) FROM b GROUP BY r, e HAVING count(*) < 5)
), f AS (SELECT x.r, x.e, k.range AS bucket, coalesce(n, 0) AS n FROM x CROSS JOIN range(1024) k LEFT JOIN c ON c.r = x.r AND c.e = x.e AND c.bucket = k.range), q AS (
  SELECT r, e, s[257] AS q1, s[513] AS q2, s[769] AS q3 FROM (SELECT r, e, list_sort(list(n)) AS s FROM f GROUP BY r, e)
), code AS MATERIALIZED (SELECT r, e, bucket, (n > q1)::INT + (n > q2)::INT + (n > q3)::INT AS code FROM f JOIN q USING (r, e)), lists AS (SELECT r, e, list(CASE WHEN code >= k.range + 1 THEN 1.0 ELSE 0.0 END::DOUBLE ORDER BY bucket, k.range) AS codes FROM code CROSS JOIN range(3) k GROUP BY r, e), body AS (
  SELECT r, e, string_agg(printf('%02x', v), '' ORDER BY k) AS body FROM (SELECT r, e, bucket // 4 AS k, sum(code << (2 * (bucket % 4))::INT)::INT AS v FROM code GROUP BY ALL) GROUP BY r, e
), head AS (
  SELECT r, e, least(255, round_even(12 * log2(strlen(t) + 1) / 1.5::DOUBLE, 0))::INT AS len, substr(sha256(t), 1, 2) AS chk, sha256(t) AS sha FROM x
), p AS MATERIALIZED (SELECT r, e, len, chk, sha, printf('%02x', len) || chk || body AS print, codes FROM head JOIN body USING (r, e) JOIN lists USING (r, e)), pair AS (
  SELECT r, 0 AS ae, r AS br, 1 AS be, 'edited' AS what FROM d UNION ALL SELECT r, 0, CASE WHEN r = (SELECT max(r) FROM d) THEN 1 ELSE r + 1 END, 0, 'next' FROM d
), near AS (
  SELECT pair.r, pair.what, CASE WHEN a.print = b.print THEN 1.0::DOUBLE
    ELSE 1 - least(round(list_distance(a.codes, b.codes) ** 2) + 4 * least(32, abs(a.len - b.len)) + (a.chk <> b.chk)::INT, 1280)::DOUBLE / 1280 END AS likeness
  FROM pair JOIN p a ON a.r = pair.r AND a.e = ae JOIN p b ON b.r = br AND b.e = be
)
SELECT doc_id, length(t)::BIGINT AS n_chars, ed.sha AS edited_sha256, own.print AS fingerprint, ed.print AS edited_fingerprint, e.likeness AS near_edited, x.likeness AS near_next
FROM d JOIN p own ON own.r = d.r AND own.e = 0 JOIN p ed ON ed.r = d.r AND ed.e = 1 JOIN near e ON e.r = d.r AND e.what = 'edited' JOIN near x ON x.r = d.r AND x.what = 'next'
"""

_REPAIR = r"""
WITH RECURSIVE slots(n, c, i) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1 FROM slots WHERE i < 8
), crc AS (SELECT list(c ORDER BY n) AS t FROM slots WHERE i = 8), k AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(regexp_extract_all(hex(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')), '..'), lambda b: ('0x' || b)::BIGINT) AS bytes FROM conversations
), m AS (
  SELECT r, conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS what FROM k, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE WHEN what = 1 THEN '' WHEN what = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS copy, r FROM m WHERE what <> 0
), f AS (
  SELECT conv_id, turn, role, text, row_number() OVER c AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r, copy) AS seen, left(role, 1) AS initial,
    lag(left(role, 1)) OVER c AS before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut FROM d WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, r, copy)
), o AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault FROM f
), every AS (SELECT DISTINCT conv_id FROM conversations), ins(p, k, mid) AS (
  VALUES ('-', 0, '-'), ('-', 1, 'u'), ('-', 2, 'a'), ('-', 3, 'u'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'), ('u', 0, 'u'), ('u', 1, 'a'), ('u', 2, 'u'), ('a', 0, 'a'), ('a', 1, 'u'), ('a', 2, 'a')
), edit(mid, q, letter, price) AS (
  SELECT s, s, 'D', 3 FROM (VALUES ('-'), ('s'), ('u'), ('a')) v(s) UNION ALL SELECT s, CASE WHEN s = 'u' THEN 'a' ELSE 'u' END, 'R', 2 FROM (VALUES ('-'), ('s'), ('u'), ('a')) v(s)
  UNION ALL SELECT s, CASE WHEN s = 'u' THEN 'a' ELSE 'u' END, 'K', 0 FROM (VALUES ('-'), ('s'), ('u'), ('a')) v(s) UNION ALL SELECT '-', 's', 'K', 0
), r(conv_id, i, q, cost, audit) AS (
  SELECT conv_id, 0::BIGINT, '-', 0::BIGINT, '' FROM every UNION ALL
  SELECT conv_id, i, q, cost, audit FROM (
    SELECT r.conv_id, o.i, edit.q, r.cost + 2 * k + price + (fault = 'truncated' AND letter <> 'D')::BIGINT AS cost, r.audit || repeat('I', k) || letter AS audit
    FROM r JOIN o ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.i = r.i + 1 JOIN ins ON ins.p = r.q JOIN edit ON edit.mid = ins.mid
    WHERE letter = 'D' OR fault NOT IN ('blank', 'duplicate') AND (letter = 'R' OR edit.q = initial)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1
), total AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY conv_id
), best AS (
  SELECT r.conv_id, cost + 2 * length(tail) AS cost, audit || tail AS audit FROM (SELECT *, CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS tail FROM r) r
  JOIN total ON total.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = n QUALIFY row_number() OVER (PARTITION BY r.conv_id ORDER BY cost + 2 * length(tail), audit || tail) = 1
), l AS (
  SELECT conv_id, j, letter, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w - 1 AS place
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(length(audit))) AS j FROM best WHERE audit <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), x AS (
  SELECT l.conv_id, j, letter, place, role, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, bool_or(letter = 'K' AND place = 0 AND initial = 's') OVER (PARTITION BY l.conv_id) AS led
  FROM l LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM l.conv_id AND o.i = l.i WHERE letter <> 'D'
), h AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - led::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j)) AS sha FROM x GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM every e LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM e.conv_id
"""

_VARIANTS = r"""
WITH RECURSIVE slots(n, c, i) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1 FROM slots WHERE i < 8
), crc AS (SELECT list(c ORDER BY n) AS t FROM slots WHERE i = 8), found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
), once AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(coalesce(doc_id::VARCHAR, '') || ':' || run), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM once, crc
), said AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed
), w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2), skip AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM skip a JOIN skip b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM skip a JOIN w ON a.rest = w.word UNION SELECT w.word, a.word, a.n FROM skip a JOIN w ON a.rest = w.word
), best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word), form AS (
  SELECT near.word, min(other) AS form, any_value(near.n) AS form_n FROM near JOIN best ON best.word = near.word AND best.top = near.n JOIN w ON w.word = near.word WHERE near.n >= 10 * w.n GROUP BY near.word
), chain(word, root) AS (SELECT word, form FROM form UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON form.word = chain.root), last AS (
  SELECT word, root FROM chain ANTI JOIN form ON form.word = chain.root
)
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0) AS n_near, form_n FROM w LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN last USING (word)
"""

_TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (SELECT q.r, q.vec_id AS query_id, v.r AS other, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score FROM s WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id, other) QUALIFY row_number() OVER best <= 10
"""

ORACLES: dict[str, str] = {"op2_lm_scoring": _LM, "op4_sharding": _SHARDS, "op5_jaccard_join": _NEAR, "op3_fingerprint": _PRINTS, "op7_mixing": _MIX, "op8_suffix_dedup": _REPEATS, "op6_url_filter": _URL, "op10_exact_dedup": _DEDUP, "op11_top_k_search": _TOP_K, "op12_spelling_variants": _VARIANTS, "op13_conversation_repair": _REPAIR}
