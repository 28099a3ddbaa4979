"""DuckDB SQL for the queries of operators that SQL can express."""

from __future__ import annotations

from sessionvol.llm.quality import BOILERPLATE, MIN_SENTENCE_WORDS

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _without(text: str, characters: str) -> str:
    return f"length({text}) - length(translate({text}, '{characters}', ''))"


def _quality() -> str:
    phrases = " OR ".join(f"contains(lower(line), '{x}')" for x in BOILERPLATE)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, regexp_extract_all(text, '{_WORD}') AS w FROM docs
), windows AS (
  SELECT r, i, list_slice(w, i, i + 7) AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), starts AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1
), again AS (
  SELECT r, sum(least(8, coalesce(following - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM starts) GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), judged AS (
  SELECT r, line, len(regexp_extract_all(line, '{_WORD}')) AS n,
    length(regexp_replace(line, '{_SPACE}', '', 'g')) AS chars
  FROM lines WHERE regexp_matches(line, '{_WORD}')
), left_over AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, coalesce(sum(chars) FILTER (NOT (
      4 * (length(line) - length(regexp_replace(line, '[#*$%&<>]', '', 'g'))) > n
      OR 3 * (length(line) - length(regexp_replace(line, '[!?]', '', 'g'))) > n
      OR 3 * (length(line) - length(regexp_replace(line, '[|]', '', 'g'))) >= n
      OR (n >= {MIN_SENTENCE_WORDS} AND NOT regexp_matches(line, '[.!?…:;。！？]'))
      OR {phrases}
    )), 0) AS chars
  FROM judged GROUP BY r
), base AS (
  SELECT d.r, doc_id, len(w.w)::BIGINT AS n_words,
    length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(a.n, 0)::BIGINT AS n_repeat_words, coalesce(l.chars, 0)::BIGINT AS left_chars
  FROM docs d JOIN words w USING (r) LEFT JOIN again a USING (r) LEFT JOIN left_over l USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, left_chars,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND left_chars >= 0.5 * word_chars AS kept
FROM base"""


def _repeats() -> str:
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT r, i, list_slice(w, i, i + 34) AS x FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
), starts AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY x) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, i + k AS i FROM starts, range(35) t(k)
), kept AS (
  SELECT d.r, string_agg(d.word, ' ' ORDER BY d.i) AS text, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs) d
  LEFT JOIN gone g ON g.r = d.r AND g.i = d.i WHERE g.i IS NULL GROUP BY d.r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept k USING (r)"""




def _benchmarks(window: int = 10) -> str:
    upper, word = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}')"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, w, least({window}, len(w)) AS n
  FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item, n, list_slice(w, i, i + n - 1) AS x
  FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), doc_windows AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS x
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)
), found AS (
  SELECT r, i, n, item FROM doc_windows JOIN item_windows USING (n, x)
), words_hit AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(0, n)) AS k FROM found) GROUP BY r
), items_hit AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words_hit h USING (r) LEFT JOIN items_hit i USING (r)"""


def _hard_negatives() -> str:
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT a, b, anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, id)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s USING (a, anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, id) <= 5"""


def _interaction() -> str:
    letters = "ABCDE"
    bit = "CASE {} WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 4 WHEN 'D' THEN 8 ELSE 16 END"
    orders = ", ".join(f"(SELECT unnest(string_split('{letters}', '')) AS x) {x}" for x in "abcde")
    differ = " AND ".join(f"{x}.x <> {y}.x" for i, x in enumerate("abcde") for y in "abcde"[i + 1 :])
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS least FROM docs GROUP BY text
), judged AS (
  SELECT part,
    (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN least < d.doc_id THEN 16 ELSE 0 END) AS bits,
    d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM docs d JOIN firsts f ON d.text = f.text
), cells AS (
  SELECT part, bits, good, toxic, count(*) AS n FROM judged GROUP BY ALL
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM {orders} WHERE {differ}
), steps AS (
  SELECT filter_order, step, {bit.format("substr(filter_order, step, 1)")} AS own,
    list_sum([0] || list_transform(string_split(substr(filter_order, 1, step - 1), ''), lambda x: CASE x WHEN '' THEN 0 WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 4 WHEN 'D' THEN 8 ELSE 16 END))::INTEGER AS before
  FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
), counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & own = 0 AND bits & before = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN bits & own <> 0 AND bits & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM counted"""


def registered() -> dict[str, str]:
    return {"op3_quality": _quality(), "op4_repeats": _repeats(), "op9_benchmarks": _benchmarks(), "op11_hard_negatives": _hard_negatives(), "op13_interaction": _interaction()}
