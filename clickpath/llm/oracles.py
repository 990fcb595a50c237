"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from clickpath.llm.licenses import LEAST_SHARE, SLACK, WORD, template_rows


def _value(x: object) -> str:
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


#: A-Z only, whatever the locale.
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LICENSES = f"""
WITH templates(template, label, base, t_words, t_grams, place, a, b) AS (
    VALUES {", ".join("(" + ", ".join(map(_value, r)) + ")" for r in template_rows()[1:])}),
texts AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER.format('text')}, '{WORD}') AS words FROM documents),
grams AS (
    SELECT row, unnest(range(len(words))) AS spot, unnest(words) AS a, unnest(list_concat(words[2:], [''])) AS b FROM texts),
votes AS (
    SELECT row, template, label, base, t_words, t_grams, spot - place AS diagonal, count(*) AS votes, min(spot) AS first_at, max(spot) AS last_at
    FROM grams JOIN templates USING (a, b) GROUP BY ALL),
steps AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) > {SLACK} THEN 1 ELSE 0 END AS far
    FROM votes WHERE NOT base),
bands AS (
    SELECT *, sum(far) OVER (PARTITION BY row, template ORDER BY diagonal) AS band FROM steps),
merged AS (
    SELECT row, label, t_words, least(1.0, sum(votes) / t_grams) AS share, max(last_at) + 2 - min(first_at) AS width
    FROM bands GROUP BY row, template, label, t_words, t_grams, band),
found AS (
    SELECT row, label, true AS base, diagonal AS place, 1.0::DOUBLE AS share FROM votes WHERE base AND votes = t_grams
    UNION ALL
    SELECT row, label, false, NULL, share FROM merged WHERE width <= t_words + {2 * SLACK} AND share >= {LEAST_SHARE}),
summed AS (
    SELECT row, count(place) AS n_base, min(place) AS first_word, max(place) AS last_word, max(share) AS score,
           array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
    FROM found GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN summed USING (row)
"""

CONTAMINATION = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER.format('text')}, '{WORD}') AS words FROM documents),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '{WORD}') AS words FROM benchmark),
phrases AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[k + 1:k + least(len(words), 13)], ' ') AS phrase
    FROM (SELECT item_id, words, unnest(range(greatest(len(words) - 12, 1))) AS k FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
    SELECT row, size, k, array_to_string(words[k + 1:k + size], ' ') AS phrase
    FROM (SELECT row, words, size, unnest(range(len(words) - size + 1)) AS k FROM docs, sizes WHERE len(words) >= size)),
hits AS (SELECT row, k, size, item_id FROM windows JOIN phrases USING (size, phrase)),
words_hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(k, k + size)) AS place FROM hits) GROUP BY row),
items_hit AS (SELECT row, list_sort(list_distinct(list(item_id::VARCHAR))) AS ids FROM hits GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words)) AS contaminated
FROM docs LEFT JOIN words_hit USING (row) LEFT JOIN items_hit USING (row)
"""

#: The stated rules by suffix and prefix tests, the library's patterns as two lists of expressions.
URL_RULES = f"""
WITH cut AS (
    SELECT page_id, coalesce(url, '') AS url, {_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages),
rules(rule, rule_host, rule_path, rule_verdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
hosts AS (SELECT DISTINCT host FROM cut),
fitting AS (
    SELECT host, rule, rule_path, rule_verdict FROM hosts JOIN rules ON host = rule_host OR ends_with(host, '.' || rule_host)),
chosen AS (
    SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(rule_verdict, length(rule)) AS rule_verdict
    FROM (SELECT DISTINCT host, path FROM cut) JOIN fitting USING (host) WHERE starts_with(path, rule_path) GROUP BY ALL),
words AS (
    SELECT *, regexp_replace(host, '[^A-Za-z0-9]', '^', 'g') AS marked, regexp_extract(url, '(?s)^[^:/?#]*://(.*)$', 1) AS rest FROM cut)
SELECT page_id, words.host, words.path, rule,
       CASE WHEN rule IS NOT NULL THEN rule_verdict
            WHEN regexp_matches(words.host, '(^|[^a-z0-9])(adult-(education|learning)|anti-spam|fast-track|spam-research)([^a-z0-9]|$)') THEN 'allow'
            WHEN len(list_intersect(string_split(marked, '^'), ['ads', 'adserver', 'adult', 'banners', 'bets', 'betting', 'casino', 'click', 'clicks',
                 'doubleclick', 'gambling', 'malware', 'phishing', 'pills', 'poker', 'porn', 'spam', 'track', 'tracker', 'tracking', 'viagra', 'warez', 'xxx'])) > 0 THEN 'block'
            WHEN regexp_matches(rest, '(?is)/(cart|checkout|login|logout|signin|signup|wp-admin|wp-login)([^a-z0-9]|$)') THEN 'block'
            WHEN regexp_matches(rest, '(?is)[.](apk|exe|gif|iso|jpg|mp3|mp4|png|rar|zip)$') THEN 'block'
            ELSE 'allow' END AS verdict
FROM words LEFT JOIN chosen ON words.host = chosen.host AND words.path = chosen.path
"""

#: A CRC-32 bit by bit; prefixes as whole strings of marks; totals over all ancestors of a node.
PREFIX_TREE = """
WITH ids AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 5 AS family FROM conversations WHERE conv_id IS NOT NULL),
crcs AS (
    SELECT c, family, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda a, step: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc
    FROM ids),
heads AS (SELECT c, family, xor(crc, 4294967295) % 9 AS h FROM crcs),
marked AS (
    SELECT conv_id AS c, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS mark, strlen(coalesce(text, '')) AS size
    FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, mark, size) - 1 AS nth, mark, size FROM marked),
rebuilt AS (
    SELECT heads.c, 0 AS part, nth, mark, size FROM heads JOIN turns ON turns.c = heads.family WHERE nth < h
    UNION ALL
    SELECT heads.c, 1, nth, mark, size FROM heads JOIN turns ON turns.c = heads.c WHERE nth >= h),
prefixes AS (
    SELECT c, row_number() OVER w AS d, string_agg(mark, '') OVER w AS key, size FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, nth)
    UNION ALL
    SELECT c, 0, '', 0 FROM ids),
lengths AS (SELECT c, max(d) AS len FROM prefixes GROUP BY c),
nodes AS (
    SELECT key, d, min(c) AS rep, count(*) AS n_convs, any_value(size) AS size, list(c ORDER BY c) FILTER (WHERE d = len) AS ending
    FROM prefixes JOIN lengths USING (c) GROUP BY key, d),
parents AS (SELECT key[:length(key) - 32] AS up, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
tree AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN parents ON parents.up = nodes.key),
totals AS (
    SELECT prefixes.key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * tree.size) AS saved_tokens
    FROM tree JOIN prefixes ON prefixes.c = tree.rep AND prefixes.d <= tree.d GROUP BY prefixes.key)
SELECT tree.rep AS conv_id, tree.d::BIGINT AS depth, up.rep AS parent_conv_id, tree.n_convs, tree.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(array_to_string(tree.ending, ','), '')) AS ends_sha256
FROM tree JOIN totals USING (key) LEFT JOIN nodes AS up ON tree.d > 0 AND up.key = tree.key[:length(tree.key) - 32]
"""
