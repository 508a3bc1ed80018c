"""The registered queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from salesloom.llm.urls import PATTERN_RULES

ORACLE: dict[str, str] = {}

ORACLE["op1_warc_archive"] = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, payload,
           sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS newest
    FROM payloads
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
           (list_sum(list_transform(range(0, 5), lambda b: (
               (strpos('0123456789abcdef', substr(hex, 1 + ((5 * i + b) // 4)::INT, 1)) - 1)
               >> (3 - (5 * i + b) % 4)::INT & 1) << (4 - b)::INT)))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM digests
"""

_WORDS = "|".join(rule.name for rule in PATTERN_RULES)
ORACLE["op8_url_filter"] = rf"""
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules(rule, verdict, host_part, path_part) AS (
    VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
           ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
           ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')
), best AS (
    SELECT s.page_id, s.host, s.path, arg_max(r.rule, length(r.rule)) AS rule,
           arg_max(r.verdict, length(r.rule)) AS verdict
    FROM split s LEFT JOIN rules r
      ON (s.host = r.host_part OR suffix(s.host, '.' || r.host_part)) AND prefix(s.path, r.path_part)
    GROUP BY s.page_id, s.host, s.path
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(translate(host || chr(10) || path,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(^|[./\n_-])({_WORDS})([./\n_-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""

# A window is a list of words; an item of fewer words than a window is one window.
ORACLE["op9_decontamination"] = r"""
WITH doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), item_words AS (
    SELECT item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark
), item_windows AS (
    SELECT item_id, least(13, len(words)) AS size,
           unnest(list_transform(range(1, greatest(1, len(words) - 12) + 1),
               lambda i: array_to_string(list_slice(words, i, i + least(13, len(words)) - 1), ' '))) AS shingle
    FROM item_words WHERE len(words) > 0
), doc_windows AS (
    SELECT doc_id, start, size, array_to_string(list_slice(words, start, start + size - 1), ' ') AS shingle
    FROM (
        SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
        FROM doc_words, (SELECT DISTINCT size FROM item_windows) WHERE len(words) >= size
    )
), found AS (
    SELECT d.doc_id, d.start, d.size, i.item_id
    FROM doc_windows d JOIN item_windows i ON d.shingle = i.shingle AND d.size = i.size
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + size)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE C) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.words) AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

ORACLE["op3_substring_dedup"] = r"""
WITH doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), spans AS (
    SELECT doc_id, start, array_to_string(list_slice(words, start, start + 19), ' ') AS span
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM doc_words WHERE len(words) >= 20)
), repeated AS (
    SELECT doc_id, start
    FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY span ORDER BY doc_id, start) AS n FROM spans)
    WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM repeated
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM doc_words
), kept AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text, count(*) AS n
    FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place
    GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, (len(d.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op7_embedding_dedup"] = """
WITH RECURSIVE unit AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
), usable AS (
    SELECT * FROM unit WHERE len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND list_dot_product(v, v) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(vec_id, seen) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.seen = l.a
), least AS (
    SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id
), counted AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT l.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN counted c ON l.vec_id = c.a
"""

_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(
        string_split(doc_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda sum, step: CASE WHEN step >= 0 THEN xor(sum, step) ELSE xor(sum >> 1, 3988292384 * (sum & 1)) END))"""

ORACLE["op11_periodic_runs"] = rf"""
WITH split AS (
  SELECT row_number() OVER () AS id, doc_id, {_CRC32} AS h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sized AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split),
stepped AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM sized),
planted AS (
  SELECT id, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(
    range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM stepped),
words AS (SELECT id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM planted),
pairs AS (
  SELECT x.id, y.i - x.i AS q, x.i FROM words x JOIN words y
  ON x.id = y.id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
placed AS (SELECT *, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT id, q, min(i) AS start, count(*) + q AS length FROM placed GROUP BY id, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT id, start, length, min(q) AS period FROM stretches GROUP BY id, start, length),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY length::double / period DESC, start, period) AS place
  FROM runs),
listed AS (
  SELECT id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)
    AS lines FROM runs GROUP BY id),
dropped AS (
  SELECT DISTINCT id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (id, i) GROUP BY id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (id) LEFT JOIN kept USING (id)
LEFT JOIN (SELECT * FROM ranked WHERE place = 1) best USING (id)
"""

ORACLE["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (
  SELECT row_number() OVER () AS id, lang,
    list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT id, lang, unnest(w) AS w1, unnest(range(0, len(w))) AS i FROM split),
windows AS (
  SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3, lead(w1, 3) OVER piece AS w4
  FROM words WINDOW piece AS (PARTITION BY id ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM windows GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM windows WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM windows WHERE w3 IS NOT NULL
    GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM windows WHERE w4 IS NOT NULL
    GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE k > 1),
placed AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
parts AS (
  SELECT *, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest FROM placed),
cuts AS (
  SELECT p.lang, p.phrase, p.a, p.cut, l.f AS l, r.f AS r, (2000000::HUGEINT * p.a // (l.f + r.f))::BIGINT AS score
  FROM parts p JOIN counts l ON l.lang = p.lang AND l.phrase = p.first
  JOIN counts r ON r.lang = p.lang AND r.phrase = p.rest),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, a, unnest([array_to_string(w[:k - 1], ' '), array_to_string(w[2:], ' '),
    CASE WHEN k = 4 THEN array_to_string(w[1:2], ' ') END, CASE WHEN k = 4 THEN array_to_string(w[2:3], ' ') END,
    CASE WHEN k = 4 THEN array_to_string(w[3:4], ' ') END]) AS phrase FROM candidates WHERE k > 2),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inside WHERE phrase IS NOT NULL GROUP BY ALL),
stay AS (
  SELECT lowest.* FROM lowest LEFT JOIN longest USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM stay JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
