"""DuckDB SQL for the queries that SQL can express, written from the contract
and not from the operators' plans."""

from __future__ import annotations

from starbi.llm.rules import STOP_WORDS

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD8 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP8 = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '{_WORD8}') AS w
  FROM benchmark),
gram AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
  FROM item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i)
  WHERE len(w) > 0),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '{_WORD8}') AS w
  FROM documents),
placed AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM doc, (SELECT DISTINCT size FROM gram) AS s, unnest(range(1, len(w) - size + 2)) AS t(i)),
hit AS (
  SELECT p.r, p.i, p.size, g.item_id FROM placed AS p JOIN gram AS g USING (words, size)),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + size)) AS t(p) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
                    ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hit GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM doc AS d LEFT JOIN hit_words AS h USING (r) LEFT JOIN hit_items AS i USING (r)
"""

OP3 = rf"""
WITH page AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), {_LETTERS}) AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rule(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page.*, (
    SELECT arg_max(struct_pack(r := h || p, v := v), length(h || p)) FROM rule
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS b
  FROM page),
listed AS (
  SELECT host FROM best GROUP BY host
  HAVING 10 * count(*) FILTER (b.v = 'block') >= count(*)
      OR list_has_any(string_split_regex(host, '[.-]'),
                      ['ads', 'adult', 'bets', 'casino', 'pills', 'spam']))
SELECT page_id, host, path, b.r AS rule,
       coalesce(b.v, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END)
         AS verdict
FROM best
"""

OP6 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
         replace(coalesce(text, ''), '<|im_', '<\|im_') AS body FROM conversations),
viewer AS (SELECT DISTINCT conv_id, speaker AS viewer FROM said WHERE speaker <> 'system'),
line AS (
  SELECT conv_id, viewer, turn, s.speaker, body,
         '<|im_start|>' || CASE WHEN s.speaker = 'system' THEN 'system'
           WHEN s.speaker = viewer THEN 'assistant'
           ELSE 'user name=' || regexp_replace(s.speaker, '[^A-Za-z0-9_-]', '_', 'g') END
           || chr(10) AS head
  FROM said AS s JOIN viewer USING (conv_id)),
placed AS (
  SELECT *, length(head) + length(body) + 11 AS n, sum(length(head) + length(body) + 11) OVER (
           PARTITION BY conv_id, viewer ORDER BY turn NULLS FIRST, speaker, body
           ROWS UNBOUNDED PRECEDING) - (length(head) + length(body) + 11) AS pos
  FROM line),
cut AS (SELECT *, pos // 65536 AS part, min(pos) OVER (PARTITION BY conv_id, viewer, pos // 65536) AS o
        FROM placed)
SELECT conv_id, viewer AS speaker, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text,
       coalesce(string_agg(CAST(CAST(pos - o + length(head) AS BIGINT) AS VARCHAR) || ':' ||
                           CAST(CAST(pos - o + n - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
                FILTER (speaker = viewer), '') AS masks
FROM cut GROUP BY conv_id, viewer, part
"""

OP9 = """
WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
rec AS (
  SELECT page_id, body, strlen(body) AS n, max(page_id) OVER (PARTITION BY body) AS newest FROM page)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM rec
"""

OP12 = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
pair AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM usable AS a, usable AS b WHERE a.vec_id % 50 = 0 AND a.r <> b.r),
positive AS (
  SELECT a, b, id, score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5),
negative AS (
  SELECT n.anchor_id, p.id AS positive_id,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id) AS place,
         n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positive AS p JOIN pair AS n ON n.a = p.a AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM negative WHERE place <= 3
"""

_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP13 = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT r, i, w[i] AS word, w[i:i + 2] AS run, len(w) AS n
         FROM doc, unnest(range(1, len(w) + 1)) AS t(i)),
often AS (SELECT r, run FROM word WHERE i <= n - 2 GROUP BY r, run HAVING count(*) > 1),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM word JOIN often USING (r, run), unnest(range(3)) AS t(k)
  WHERE word.i <= word.n - 2 GROUP BY r),
by_word AS (
  SELECT r, count(*) AS n, sum(length(word)) AS chars,
         count(*) FILTER (trim(lower(word), '.,;:!?()[]"''') IN ({_STOPS})) AS stops
  FROM word GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM doc),
by_line AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS again
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS (
  SELECT doc_id, CAST(coalesce(b.n, 0) AS BIGINT) AS n_words,
         CAST(coalesce(b.chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.again, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(b.stops, 0) AS BIGINT) AS n_stop_words
  FROM doc LEFT JOIN by_word AS b USING (r) LEFT JOIN by_line AS l USING (r)
       LEFT JOIN repeated AS p USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND 100 * n_symbols <= 30 * n_words
       AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_stop_words >= 6 * n_words AS kept
FROM counted
"""

ORACLE: dict[str, str] = {"op3_url_filter": OP3, "op6_chat_perspectives": OP6,
                          "op8_decontamination": OP8, "op9_warc": OP9,
                          "op12_hard_negatives": OP12, "op13_rules": OP13}
