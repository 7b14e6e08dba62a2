"""The queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages
), q AS (
    SELECT page_id, strlen(html) AS payload_bytes, digest, min(page_id) OVER (PARTITION BY digest) AS first FROM p
)
SELECT page_id, payload_bytes, digest AS payload_digest,
    CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM q
"""

HOSTS = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS body FROM documents
), w AS (
    SELECT doc_id, source, body,
        regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), windows AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS phrase
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, phrase) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), m AS (
    SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
        length(translate(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
        (length(body) - length(translate(body, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(lines)::BIGINT AS n_lines
    FROM w LEFT JOIN covered USING (doc_id)
), f AS (
    SELECT source, rule, count(*) AS n, sum(failed::INT) AS k
    FROM (
        SELECT source, unnest(['few_words', 'repeated_words', 'symbols', 'repeated_lines', 'word_length']) AS rule,
            unnest([
                n_words < 50,
                100 * n_repeat_words > 50 * n_words,
                10 * n_symbols > n_words,
                2 * n_dup_lines > n_lines,
                word_chars < 3 * n_words OR word_chars > 12 * n_words
            ]) AS failed
        FROM m
    ) GROUP BY source, rule
), pooled AS (
    SELECT rule, sum(k) / sum(n) AS rate, sum(n) AS docs, count(*) AS hosts, sum(n * n) AS squares FROM f GROUP BY rule
), spread AS (
    SELECT rule, any_value(rate) AS rate, any_value(rate) * (1 - any_value(rate)) AS noise,
        (sum(n * pow(k / n - rate, 2)) - (any_value(hosts) - 1) * any_value(rate) * (1 - any_value(rate)))
            / nullif(any_value(docs) - any_value(squares) / any_value(docs), 0) AS extra
    FROM f JOIN pooled USING (rule) GROUP BY rule
), prior AS (
    SELECT rule, rate, CASE WHEN extra > 0 THEN least(greatest(noise / extra - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM spread
), verdicts AS (
    SELECT source, max((k + rate * strength) / (n + strength)) <= 0.5 AS host_kept FROM f JOIN prior USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND host_kept AS kept
FROM m JOIN verdicts ON m.source IS NOT DISTINCT FROM verdicts.source
"""


def _words(x: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate(coalesce({x}, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


LEAKS = f"""
WITH i AS (
    SELECT item_id, {_words('text')} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id::VARCHAR AS item, w[k : k + 9] AS words
    FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s(k) WHERE len(w) > 0
), d AS (
    SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents
), lengths AS (
    SELECT DISTINCT len(words) AS n FROM windows
), places AS (
    SELECT r, k, n, w[k : k + n - 1] AS words FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS s(k)
), hits AS (
    SELECT r, k, n, item FROM places JOIN windows USING (words)
), covered AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + n)) AS s(p) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def _leaf(text: str) -> str:
    part = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: CRC-32 of the decimal id, bit by bit.
_CRC = """list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
    lambda crc, b: list_reduce([xor(crc, b)] || [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""

MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
        CASE WHEN xor({_CRC}, 4294967295) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS now
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), tree AS (
    SELECT source, 0 AS level, i, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM placed
    UNION ALL
    SELECT source, level + 1, i // 3, sha256(string_agg(node, '' ORDER BY i)), (n + 2) // 3
    FROM tree WHERE n > 1 GROUP BY source, level, i // 3, n
), subroots AS (
    SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM tree WHERE n = 1
), over AS (
    SELECT 0 AS level, i, subroot AS node, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, i // 3, sha256(string_agg(node, '' ORDER BY i)), (n + 2) // 3 FROM over WHERE n > 1 GROUP BY level, i // 3, n
), inner_siblings AS (
    SELECT a.source, a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
        coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
    FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.i // 3 = b.i // 3
    WHERE a.n > 1 GROUP BY ALL
), outer_siblings AS (
    SELECT a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
        coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
    FROM over a JOIN over b ON a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL
), steps AS (
    SELECT p.source, p.i, s.level AS step, s.before, s.after
    FROM placed p JOIN inner_siblings s ON p.source IS NOT DISTINCT FROM s.source AND s.i = p.i // (3 ** s.level)::BIGINT
    UNION ALL
    SELECT p.source, p.i, 100 + s.level, s.before, s.after
    FROM placed p JOIN subroots r ON p.source IS NOT DISTINCT FROM r.source JOIN outer_siblings s ON s.i = r.i // (3 ** s.level)::BIGINT
), whole AS (
    SELECT node AS root FROM over WHERE n = 1
), proofs AS (
    SELECT source, i, list({{'b': before, 'a': after}} ORDER BY step) AS path FROM steps GROUP BY source, i
)
SELECT doc_id, leaf, subroot, root,
    sha256(coalesce(array_to_string(list_transform(path, lambda s: s.b || s.a), ''), '')) AS proof_sha256,
    list_reduce([now] || list_transform(coalesce(path, []), lambda s: s.b || ':' || s.a),
        lambda h, s: sha256(split_part(s, ':', 1) || h || split_part(s, ':', 2))) AS folded_root,
    folded_root = root AS verified
FROM placed p JOIN subroots r ON p.source IS NOT DISTINCT FROM r.source CROSS JOIN whole
LEFT JOIN proofs f ON p.source IS NOT DISTINCT FROM f.source AND p.i = f.i
"""

ORACLE: dict[str, str] = {
    "op5_warc": WARC,
    "op7_host_rules": HOSTS,
    "op11_merkle_manifest": MANIFEST,
    "op12_benchmark_decontamination": LEAKS,
}
