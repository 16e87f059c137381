"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from clickweir.llm import urls
from clickweir.llm.quality import MIN_WORDS, RULES, STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"

_WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT page_id, html, list_transform(range(0, 40), lambda i:
           strpos('0123456789abcdef', hex[i + 1]) - 1) AS nibbles FROM payloads
), digests AS (
  SELECT page_id, html, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((nibbles[i * 5 // 4 + 1] * 256 + coalesce(nibbles[i * 5 // 4 + 2], 0) * 16
         + coalesce(nibbles[i * 5 // 4 + 3], 0)) >> (7 - (i * 5) % 4)) & 31)::BIGINT + 1, 1)),
    '') AS payload_digest
  FROM bits
), held AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM digests)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM held
"""


def _quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    ratio = [f"coalesce({r.numerator} / nullif({r.denominator}, 0), 0.0)" for r in RULES]
    broken = ", ".join(
        "CASE WHEN " + " OR ".join(
            ([f"{x} < {r.low}"] if r.low is not None else [])
            + ([f"{x} > {r.high}"] if r.high is not None else [])
        ) + f" THEN '{r.name}' END"
        for r, x in zip(RULES, ratio)
    )
    return f"""
WITH t AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows)
  WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), measures AS (
  SELECT doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
         len(list_filter(w, lambda x: ends_with(x, '!!'))) AS n_shouted
  FROM t LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         array_to_string(list_filter([{broken}], lambda x: x IS NOT NULL), ',') AS broken
  FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND broken = '' AS kept, broken
FROM judged
"""


def _url_filters() -> str:
    def strength(groups: str, n: str, k: str, parent_n: str, parent_k: str, parent: str) -> str:
        mean = f"({parent_k} / {parent_n})"
        return f"""
SELECT CASE WHEN coalesce(total, 0) = 0 OR coalesce(variance, 0) = 0 THEN {urls.MAX_STRENGTH}
            WHEN excess <= 0 THEN {urls.MAX_STRENGTH}
            ELSE least({urls.MAX_STRENGTH}, greatest({urls.MIN_STRENGTH}, 1 / excess - 1)) END AS s
FROM (
  SELECT *, CASE WHEN room > 0 THEN (spread - v * free) / room ELSE 0.0 END AS excess FROM (
    SELECT *, v * (total - squares - free) AS room FROM (
      SELECT spread, variance, total, squares, variance / nullif(total, 0) AS v,
             groups - parents AS free
      FROM (SELECT sum({n} * pow({k} / {n} - {mean}, 2)) AS spread,
                   sum({n} * {mean} * (1 - {mean})) AS variance, sum({n}) AS total,
                   sum({n} * {n} / {parent_n}) AS squares, count(*) AS groups,
                   count(DISTINCT {parent}) AS parents
            FROM {groups} WHERE {n} > 0))))"""

    two = ", ".join(f"'{s}'" for s in urls.TWO_LABEL_SUFFIXES)
    rule = "NULL"
    for r in sorted(urls.RULES, key=lambda r: (len(r.pattern), r.pattern)):
        rule = (f"CASE WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND "
                f"starts_with(path, '{r.path}') THEN '{r.pattern}' ELSE {rule} END")
    verdict = " ".join(f"WHEN rule = '{r.pattern}' THEN '{r.verdict}'" for r in urls.RULES)
    parts = "string_split(host, '.')"
    last = f"array_to_string({parts}[-2:], '.')"
    return f"""
WITH split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), worst AS (
  SELECT doc_id AS page_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY 1
), hosts AS (
  SELECT *,
    CASE WHEN {last} IN ({two}) AND {last} <> host THEN array_to_string({parts}[-3:], '.')
         ELSE {last} END AS domain,
    CASE WHEN {last} IN ({two}) AND {last} <> host THEN {last} ELSE {parts}[-1] END AS suffix
  FROM (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
        FROM split LEFT JOIN worst USING (page_id) GROUP BY host)
), domains AS (
  SELECT domain, suffix, sum(n) AS domain_n, sum(k) AS domain_k FROM hosts GROUP BY 1, 2
), suffixes AS (
  SELECT suffix, sum(domain_n) AS suffix_n, sum(domain_k) AS suffix_k, 0 AS every,
         sum(sum(domain_n)) OVER () AS all_n, sum(sum(domain_k)) OVER () AS all_k
  FROM domains GROUP BY 1
), per_domain AS (SELECT * FROM domains JOIN suffixes USING (suffix)
), per_host AS (SELECT * FROM hosts JOIN domains USING (domain, suffix)
), of_suffix AS ({strength("suffixes", "suffix_n", "suffix_k", "all_n", "all_k", "every")}
), of_domain AS ({strength("per_domain", "domain_n", "domain_k", "suffix_n", "suffix_k", "suffix")}
), of_host AS ({strength("per_host", "n", "k", "domain_n", "domain_k", "domain")}
), suffix_level AS (
  SELECT *, 
    (s * CASE WHEN all_n > 0 THEN all_k / all_n ELSE 0.0 END + suffix_k) / (s + suffix_n)
    AS suffix_mean
  FROM per_domain, of_suffix
), domain_level AS (
  SELECT domain, suffix, (d.s * suffix_mean + domain_k) / (d.s + domain_n) AS domain_mean
  FROM suffix_level, of_domain AS d
), host_level AS (
  SELECT host, n, s, (s * domain_mean + k) / (s + n) AS mean
  FROM hosts JOIN domain_level USING (domain, suffix), of_host
), known AS (
  SELECT host, greatest(0.0, mean - {urls.BOUND} * sqrt(mean * (1 - mean) / (s + n + 1)))
    AS bad_low FROM host_level
), ruled AS (SELECT *, {rule} AS rule FROM split LEFT JOIN known USING (host))
SELECT page_id, host, path, rule,
       CASE {verdict} WHEN bad_low >= {urls.THRESHOLD} AND host <> '' THEN 'block'
            ELSE 'allow' END AS verdict,
       round(bad_low, 9) AS bad_low
FROM ruled
"""


# crc32 by its table, which 8 steps of the polynomial make from each byte.
_MERKLE = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t
  FROM (SELECT unnest(range(256)) AS k)
), checked AS (
  SELECT d.*, xor(list_reduce([4294967295::BIGINT] || list_transform(
           string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents AS d, crc_table
), encoded AS (
  SELECT doc_id, lang, crc, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS e1,
         coalesce(strlen(source) || ':' || source, '-') AS e2,
         coalesce(strlen(lang) || ':' || lang, '-') AS e3,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS e4,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS e5,
         coalesce(strlen(text) || ':' || text, '-') AS e6
  FROM checked
), leaves AS (
  SELECT doc_id, lang, sha256(e1 || e2 || e3 || e4 || e6) AS leaf,
         sha256(e1 || e2 || e3 || CASE WHEN crc % 7 = 0 THEN e5 ELSE e4 END || e6) AS claimed
  FROM encoded
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS size FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, place AS k, size AS n, leaf AS digest FROM ranked
  UNION ALL
  SELECT lang, level + 1, k // 2, any_value((n + 1) // 2),
         sha256(string_agg(digest, '' ORDER BY k))
  FROM nodes WHERE n > 1 GROUP BY lang, level, k // 2
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS k,
         count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, k, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, k // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY k))
  FROM tops WHERE n > 1 GROUP BY level, k // 2
), climb AS (
  SELECT doc_id, lang, leaf, 0 AS level, place AS k, size AS n, '' AS proof, claimed AS digest
  FROM ranked
  UNION ALL
  SELECT c.doc_id, c.lang, c.leaf, c.level + 1, c.k // 2, (c.n + 1) // 2,
         c.proof || coalesce(s.digest, ''),
         sha256(CASE WHEN c.k % 2 = 1 THEN s.digest || c.digest
                     ELSE c.digest || coalesce(s.digest, '') END)
  FROM climb AS c LEFT JOIN nodes AS s
    ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.k = xor(c.k, 1)
  WHERE c.n > 1
), climb_top AS (
  SELECT c.doc_id, c.leaf, s.subroot, 0 AS level, s.k, s.n, c.proof, c.digest
  FROM climb AS c JOIN subroots AS s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.k // 2, (c.n + 1) // 2,
         c.proof || coalesce(t.digest, ''),
         sha256(CASE WHEN c.k % 2 = 1 THEN t.digest || c.digest
                     ELSE c.digest || coalesce(t.digest, '') END)
  FROM climb_top AS c LEFT JOIN tops AS t ON t.level = c.level AND t.k = xor(c.k, 1)
  WHERE c.n > 1
)
SELECT c.doc_id, c.leaf, c.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256,
       c.digest AS folded_root, c.digest = t.digest AS verified
FROM climb_top AS c JOIN tops AS t ON t.n = 1 WHERE c.n = 1
"""


_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang
), places AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM (SELECT lang, w, unnest(range(1, 6)) AS size FROM lists)
), counted AS (
  SELECT lang, size, w[i : i + size - 1] AS words, count(*)::BIGINT AS a FROM places
  GROUP BY ALL HAVING count(*) >= 100
), candidates AS (SELECT * FROM counted WHERE size > 1
), cuts AS (
  SELECT lang, size, words, a, k, words[1 : k] AS first_part, words[k + 1 : size] AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scores AS (
  SELECT c.lang, c.size, c.words, c.a, f.a AS l, r.a AS r, n, c.k,
         (1000::HUGEINT * c.a * n // (f.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts AS c JOIN counted AS f ON f.lang = c.lang AND f.words = first_part
  JOIN counted AS r ON r.lang = c.lang AND r.words = rest
  JOIN totals AS t ON t.lang = c.lang
), weakest AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, a, words[i : i + short - 1] AS words
  FROM (SELECT *, unnest(range(1, size - short + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS short FROM candidates))
), kept AS (
  SELECT * FROM weakest AS w WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrases AS i
    WHERE i.lang = w.lang AND i.words = w.words AND 100 * i.a >= 100 * w.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
         AS rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(words, ' ') AS phrase FROM kept)
QUALIFY rank <= 2000
"""


ORACLE_SQL = {
    "op1_warc": _WARC,
    "op4_quality_rules": _quality_rules(),
    "op6_url_filters": _url_filters(),
    "op12_collocations": _COLLOCATIONS,
    "op13_merkle_manifest": _MERKLE,
}
