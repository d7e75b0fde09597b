"""DuckDB SQL with the results of those queries that SQL can express."""

from __future__ import annotations

from merchantlake.llm.quality_rules import RULES, STOP_WORDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STOPS = ", ".join(f"'{form}'" for w in STOP_WORDS for form in dict.fromkeys((w, w.capitalize())))


def _failed(rule) -> str:
    value = rule.part if rule.whole is None else f"({rule.part} / nullif({rule.whole}, 0))"
    limits = [f"{value} < {rule.low}"] * (rule.low is not None) + [f"{value} > {rule.high}"] * (rule.high is not None)
    return f"(n_words >= {rule.from_words} AND coalesce({' OR '.join(limits)}, false))"


QUALITY_RULES = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents
), e AS (
  SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: trim(x, {_WHITE}) <> '') AS l FROM d
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i : i + 4]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM e WHERE len(w) >= 5)
), repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place FROM windows WHERE times > 1
  ) GROUP BY doc_id
), counted AS (
  SELECT e.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop_words, len(l) AS n_lines,
    len(list_filter(l, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS n_ellipsis_lines,
    len(list_filter(l, lambda x: ltrim(x)[1] IN ('-', '*', '•'))) AS n_bullet_lines
  FROM e LEFT JOIN repeats r ON e.doc_id IS NOT DISTINCT FROM r.doc_id
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(map(_failed, RULES))}) AS kept
FROM judged
"""

SOURCE_MIX = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')), 1, 12))::BIGINT AS hash
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
    3.0::DOUBLE * source_size AS cap
  FROM totals
), leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
), shared AS (
  SELECT *, max(CASE WHEN cap / weight > level THEN level END) OVER () AS level_of_rest FROM leveled
), targets AS (
  SELECT source, source_size,
    CASE WHEN weight * level_of_rest < cap THEN weight * level_of_rest ELSE cap END AS target
  FROM shared
), plan AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS passes FROM targets
), cells AS (
  SELECT source, hash, sum(size)::BIGINT AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS upto
  FROM d GROUP BY source, hash
), ends AS (
  SELECT p.source, min(struct_pack(hash := c.hash, size := c.size, upto := c.upto)) AS c,
    any_value(p.target - p.passes * p.source_size) AS budget
  FROM plan p JOIN cells c ON p.source IS NOT DISTINCT FROM c.source
  WHERE p.target - p.passes * p.source_size > 0 AND c.upto >= p.target - p.passes * p.source_size
  GROUP BY p.source
), cuts AS (
  SELECT source, c.hash + CASE WHEN (budget - c.upto + c.size) * 2 > c.size THEN 1 ELSE 0 END AS cut FROM ends
)
SELECT d.doc_id, d.size, p.source_size, p.target,
  (d.size * (p.passes + CASE WHEN d.hash < k.cut THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts k ON d.source IS NOT DISTINCT FROM k.source
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ARCHIVED_PAGES = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: '{_BASE32}'[
    (('0x' || digest[5 * (k // 4) + 1 : 5 * (k // 4) + 5])::INT >> (15 - 5 * (k % 4))::INT) % 32 + 1]), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * r.v[k]))::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER o)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER o <= 5
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), hits AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS first_id FROM windows) WHERE first_id < doc_id
), removed AS (
  SELECT doc_id, list(DISTINCT place) AS places FROM (SELECT doc_id, unnest(range(i, i + 13)) AS place FROM hits) GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, w, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(places, k)) END AS k
  FROM d LEFT JOIN removed r USING (doc_id)
)
SELECT doc_id, len(w)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""

CONVERSATION_REPAIR = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), checked AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm
  FROM named, crc
), harmed AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(0, CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM checked WHERE harm <> 0
), ordered AS (
  SELECT *, role[1] AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER o AS i, lag(role[1]) OVER o AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time
  FROM harmed WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)
), judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
    WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), turned (q, next, role) AS (VALUES ('', 'u', 'user:'), ('s', 'u', 'user:'), ('u', 'a', 'assistant:'), ('a', 'u', 'user:')
), moves AS (
  -- from a state, after an empty turn or none: state, its cost, letters and text
  SELECT q, q AS then, 0 AS cost, '' AS letters, [] :: VARCHAR[] AS lines FROM turned
  UNION ALL SELECT q, next, 3, 'I', [role] FROM turned
), dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS q, {'cost': 0, 'letters': '', 'lines': [] :: VARCHAR[]} AS best FROM judged
  UNION ALL
  SELECT d.conv_id, d.i + 1, e.q, min({'cost': d.best.cost + m.cost + e.cost, 'letters': d.best.letters || m.letters || e.letter,
    'lines': d.best.lines || m.lines || e.lines})
  FROM dp d JOIN judged j ON j.conv_id IS NOT DISTINCT FROM d.conv_id AND j.i = d.i + 1 JOIN moves m ON m.q = d.q JOIN turned t ON t.q = m.then,
    LATERAL (
      SELECT m.then AS q, 4 AS cost, 'D' AS letter, [] :: VARCHAR[] AS lines
      UNION ALL SELECT j.initial, CASE j.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [j.role || ':' || j.text]
      WHERE j.fault NOT IN ('blank', 'duplicate') AND (j.initial = t.next OR m.then = '' AND j.initial = 's')
      UNION ALL SELECT t.next, CASE j.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [t.role || j.text]
      WHERE j.fault NOT IN ('blank', 'duplicate')
    ) e
  GROUP BY d.conv_id, d.i + 1, e.q
), ended AS (
  SELECT d.conv_id, min({'cost': d.best.cost + e.cost, 'letters': d.best.letters || e.letters, 'lines': d.best.lines || e.lines}) AS best
  FROM dp d JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.n = d.i
  JOIN (VALUES ('', 0, '', [] :: VARCHAR[]), ('a', 0, '', []), ('u', 3, 'I', ['assistant:']), ('s', 6, 'II', ['user:', 'assistant:'])) e (q, cost, letters, lines)
    ON e.q = d.q
  GROUP BY d.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.letters, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
