"""The registered queries as SQL, where SQL can express them."""

from __future__ import annotations

from .common import WORD
from .secrets import KINDS


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_HITS = " UNION ALL ".join(
    f"""SELECT r, {number} AS kind, {least} AS least,
        regexp_split_to_array(t, {_quoted(pattern)}) AS gaps,
        regexp_extract_all(t, {_quoted(pattern)}) AS wholes,
        regexp_extract_all(t, {_quoted(pattern)}, {group}) AS vals FROM d WHERE regexp_matches(t, {_quoted(pattern)})"""
    for number, (_, pattern, group, least) in enumerate(KINDS)
)

OP2_SECRETS = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source, concat_ws('/', source, lang) AS repository
    FROM documents
), hits AS ({_HITS}),
each AS (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM hits),
found AS (
    SELECT r, kind, vals[i] AS value, length(wholes[i]) AS size,
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0) AS start
    FROM each WHERE length(vals[i]) >= least
), held AS (SELECT DISTINCT value, source, repository FROM found JOIN d USING (r)),
spread AS (
    SELECT value, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT repository) AS repositories
    FROM held GROUP BY value
), judged AS (
    SELECT *, owners <= 1 AND repositories <= 2 AS live,
        CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' ELSE 'hex' END AS name
    FROM found JOIN spread USING (value)
), base AS (
    SELECT r, string_agg(name || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, kind) AS base,
        count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        count(*) FILTER (live) AS n_live, max(owners) AS most_owners
    FROM judged GROUP BY r
), marks AS (
    SELECT r, start, kind, start + size AS stop, name FROM judged
    UNION
    SELECT r, start, 3, start + size, 'live' FROM judged WHERE live
), joined AS (
    SELECT r, string_agg(name || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind, stop) AS spans
    FROM marks GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_live, 0) AS n_live, coalesce(most_owners, 0) AS most_owners
FROM d LEFT JOIN base USING (r) LEFT JOIN joined USING (r)
"""

OP1_PREFERENCES = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place FROM t
), sizes AS (
    SELECT conv_id, max(place) AS size, max(place) FILTER (role = 'assistant') AS reply_at,
        count(*) FILTER (role = 'assistant') AS replies
    FROM n GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant') > 0
), ring AS (
    SELECT *, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS next FROM sizes
), numbered AS (
    SELECT conv_id, place, row_number() OVER (PARTITION BY conv_id ORDER BY place) - 1 AS number FROM n WHERE role = 'assistant'
), pairs AS (
    SELECT r.conv_id, r.size, r.next, numbered.place AS parts_at, other.reply_at AS reply_at
    FROM ring r JOIN sizes other ON other.conv_id = r.next
    JOIN numbered ON numbered.conv_id = r.conv_id AND number = (r.conv_id % r.replies + r.replies) % r.replies
), sides AS (
    SELECT 'chosen' AS side, conv_id, place, role, text FROM pairs JOIN n USING (conv_id)
    UNION ALL
    SELECT 'rejected', conv_id, place, role, text FROM pairs JOIN n USING (conv_id) WHERE place < parts_at
    UNION ALL
    SELECT 'rejected', p.conv_id, n.place - reply_at + parts_at, role, text FROM pairs p JOIN n ON n.conv_id = p.next AND n.place >= reply_at
), differing AS (
    SELECT conv_id, min(place) - 1 AS prefix_turns FROM (
        SELECT conv_id, place FROM sides GROUP BY conv_id, place HAVING count(*) = 1 OR min(role) <> max(role) OR min(text) <> max(text)
    ) GROUP BY conv_id
), counted AS (
    SELECT conv_id, coalesce(prefix_turns, size) AS prefix_turns FROM pairs LEFT JOIN differing USING (conv_id)
), marked AS (
    SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
        CASE WHEN role = 'assistant' THEN '01' ELSE '00' END AS mask
    FROM sides JOIN counted USING (conv_id)
)
SELECT conv_id, any_value(prefix_turns)::INTEGER AS prefix_turns,
    coalesce(string_agg(shown, '' ORDER BY place) FILTER (side = 'chosen' AND place <= prefix_turns), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY place) FILTER (side = 'chosen' AND place > prefix_turns), '') AS chosen,
    coalesce(string_agg(mask, '' ORDER BY place) FILTER (side = 'chosen' AND place > prefix_turns), '') AS chosen_mask,
    coalesce(string_agg(shown, '' ORDER BY place) FILTER (side = 'rejected' AND place > prefix_turns), '') AS rejected,
    coalesce(string_agg(mask, '' ORDER BY place) FILTER (side = 'rejected' AND place > prefix_turns), '') AS rejected_mask
FROM marked GROUP BY conv_id
"""

OP6_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), q AS (
    SELECT row_number() OVER () AS query_row, * FROM (SELECT DISTINCT vec_id AS query_id, e FROM v WHERE vec_id % 100 = 0)
), c AS (SELECT row_number() OVER () AS candidate_row, * FROM v),
qx AS (SELECT query_row, query_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM q),
cx AS (SELECT candidate_row, vec_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM c),
s AS (
    SELECT query_row, query_id, candidate_row, vec_id, sum(qx.x * cx.x)::BIGINT AS score
    FROM qx JOIN cx ON qx.i = cx.i AND query_id <> vec_id GROUP BY query_row, query_id, candidate_row, vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

OP10_MIXING = f"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_quoted(WORD)})) AS size,
        ('0x' || md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))[1:15])::BIGINT AS hash
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM d GROUP BY source
), by_cap AS (
    SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS place FROM s
), shares AS (
    SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(cap) OVER before, 0) AS twice_left,
        2 * sum(weight) OVER since AS twice_weight
    FROM by_cap
    WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        since AS (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), first_open AS (
    SELECT * FROM shares WHERE weight * twice_left <= cap * twice_weight ORDER BY place LIMIT 1
), targets AS (
    SELECT s.source, s.source_size,
        CASE WHEN s.place < f.place THEN s.cap::DOUBLE
        ELSE (s.weight * f.twice_left)::DOUBLE / f.twice_weight::DOUBLE END AS target,
        CASE WHEN s.place < f.place THEN s.cap ELSE (s.weight * f.twice_left) // f.twice_weight END AS quota
    FROM by_cap s CROSS JOIN first_open f
), placed AS (
    SELECT d.*, source_size, target,
        CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS times,
        CASE WHEN source_size > 0 THEN quota % source_size ELSE 0 END AS extra,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY hash, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
    (times * size + greatest(0, least(size, extra - before)))::BIGINT AS taken
FROM placed
"""

OP11_FILL_IN_MIDDLE = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), g AS (
    SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), f AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM g
), p AS (
    SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1, n - b) AS suffix FROM f
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

OP13_FILTER_AUDIT = f"""
WITH RECURSIVE letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
    SELECT letter AS filter_order FROM letters
    UNION ALL
    SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)
), steps AS (
    SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5
), d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), {_quoted(WORD)}) AS words, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), l AS (
    SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id
), fails AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN least < doc_id THEN 'E' ELSE '' END AS failed
    FROM d LEFT JOIN l USING (doc_id)
), counted AS (
    SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed
), judged AS (
    SELECT *, contains(failed, letter) AS failing, translate(failed, before, '') = failed AS reached FROM counted, steps
), summed AS (
    SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (reached AND NOT failing), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (reached AND failing), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (NOT reached AND failing), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (failed = letter), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (reached AND failing), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (reached AND failing), 0)::BIGINT AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed
"""

ORACLE: dict[str, str] = {
    "op1_preferences": OP1_PREFERENCES,
    "op2_secrets": OP2_SECRETS,
    "op6_top_k": OP6_TOP_K,
    "op10_mixing": OP10_MIXING,
    "op11_fill_in_middle": OP11_FILL_IN_MIDDLE,
    "op13_filter_audit": OP13_FILTER_AUDIT,
}
