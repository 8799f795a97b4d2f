"""SQL for DuckDB that states what the queries of this subpackage return."""

from __future__ import annotations

URL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), named AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
    SELECT n.page_id, n.host, n.path, r.rule_host || r.rule_path AS rule, r.verdict
    FROM named n LEFT JOIN rules r
      ON (n.host = r.rule_host OR ends_with(n.host, '.' || r.rule_host)) AND starts_with(n.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM fitting
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""

_LEVEL = """
, {name}_nodes AS (
    SELECT {keys}, sum(supply)::HUGEINT AS supply, any_value({weight}) AS weight
    FROM leaves GROUP BY {keys}
), {name}_ordered AS (
    SELECT n.*, p.budget,
           p.budget - coalesce(sum(supply) OVER ({part} ORDER BY supply::DOUBLE / weight, {key}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining, sum(weight) OVER (
               {part} ORDER BY supply::DOUBLE / weight, {key} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM {name}_nodes n JOIN {above} p {using}
), {name}_marked AS (
    SELECT *, supply * weights <= weight * remaining AS exhausted FROM {name}_ordered
), {name}_open AS (
    SELECT *, budget - sum(CASE WHEN exhausted THEN supply ELSE 0 END) OVER ({part}) AS rest,
           sum(CASE WHEN exhausted THEN 0 ELSE weight END) OVER ({part}) AS total,
           sum(CASE WHEN exhausted THEN 0 ELSE weight END)
             OVER ({part} ORDER BY supply::DOUBLE / weight, {key} ROWS UNBOUNDED PRECEDING) AS running
    FROM {name}_marked
), {name}_budgets AS (
    SELECT {keys}, (CASE WHEN exhausted THEN supply
           ELSE rest * running // total - rest * (running - weight) // total END)::HUGEINT AS budget
    FROM {name}_open
)"""

_WEIGHT = {
    "domain": "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END",
    "lang": "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END",
    "source": "1",
}


def _level(depth: int) -> str:
    names = ["domain", "lang", "source"]
    above = names[:depth]
    return _LEVEL.format(
        name=names[depth],
        key=names[depth],
        keys=", ".join(names[: depth + 1]),
        weight=_WEIGHT[names[depth]],
        above=f"{names[depth - 1]}_budgets" if above else "root",
        using=f"USING ({', '.join(above)})" if above else "ON true",
        part=f"PARTITION BY {', '.join(above)}" if above else "",
    )


MIXING = (
    r"""
WITH counted AS (
    SELECT doc_id, coalesce('domain' || (try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INT) % 4), '') AS domain,
           coalesce(lang, '') AS lang, coalesce(source, '') AS source, lang AS raw_lang, source AS raw_source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens
    FROM documents
), leaves AS (
    SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * 2 AS supply
    FROM counted GROUP BY ALL
), root AS (
    SELECT least(sum(tokens), sum(supply))::HUGEINT AS budget FROM leaves
)"""
    + "".join(_level(depth) for depth in range(3))
    + r"""
, plan AS (
    SELECT domain, lang, source, budget // tokens AS full_epochs, budget % tokens AS rest
    FROM source_budgets JOIN leaves USING (domain, lang, source) WHERE budget > 0
), ordered AS (
    SELECT c.*, p.full_epochs, p.rest,
           sum(tokens) OVER (PARTITION BY domain, lang, source
               ORDER BY md5('7:' || p.full_epochs::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, tokens
               ROWS UNBOUNDED PRECEDING) - tokens AS before
    FROM counted c JOIN plan p USING (domain, lang, source)
), drawn AS (
    SELECT *, unnest(range(full_epochs::BIGINT + (CASE WHEN before < rest THEN 1 ELSE 0 END))) AS epoch FROM ordered
)
SELECT doc_id, domain, raw_lang AS lang, raw_source AS source, epoch, tokens,
       (CASE WHEN epoch < full_epochs THEN tokens ELSE least(tokens, rest - before) END)::BIGINT AS taken_tokens
FROM drawn
"""
)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM split
), rows_ AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM rows_ x JOIN rows_ y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), edges AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b
), named AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN named USING (doc_id)
"""

WINNOWING = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), items AS (
    SELECT item_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM (SELECT *, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
), met AS (
    SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, k)
), hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM met) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM met) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""


HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
           list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i]))::BIGINT AS score
    FROM vectors a JOIN vectors r ON a.id <> r.id WHERE a.id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_url_filter": URL,
        "op4_superminhash": NEAR_DUPLICATES,
        "op7_winnowing": WINNOWING,
        "op9_source_mixing": MIXING,
        "op12_hard_negatives": HARD_NEGATIVES,
    }
