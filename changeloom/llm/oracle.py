"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""

OP6 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM g
"""

OP8 = r"""
WITH rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

# Targets: the water level is the first one, by cap per weight, that is not filled.
OP7 = f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_rows FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
              ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         source_size * 2.0::DOUBLE AS cap FROM per),
levels AS (
  SELECT *, cap / weight AS level, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM weighted),
rests AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY level, source ASC NULLS LAST
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY level, source ASC NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM levels),
targets AS (
  SELECT source, source_size, source_rows,
         CASE WHEN w IS NULL THEN cap ELSE least(cap, w * weight) END AS target
  FROM rests, (SELECT arg_min(rest, row(level, source)) AS w FROM rests WHERE rest < level)),
placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, floor(sqrt(d.size::DOUBLE))::BIGINT AS stratum,
         ('0x' || substr(md5('17|block|' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT
           % ceil(t.source_rows / 50000.0)::BIGINT AS block
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY stratum, block, size, doc_id NULLS LAST)::DOUBLE AS k,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('17|offset|' || coalesce(source, chr(0))), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM placed)
SELECT doc_id, size, source_size, target,
       (least(floor(k * rate + u) - floor((k - 1) * rate + u), ceil(rate)) * size)::BIGINT AS taken
FROM ranked
"""

OP10 = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS words FROM documents),
grams AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS g
  FROM w, unnest(generate_series(1, len(words) - 7)) AS s(i)),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (
  SELECT doc_id, sum(least(8, nxt - i)) AS n
  FROM (SELECT *, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 8) AS nxt FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN repeats r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 5 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""

def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
                                   for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, levels: int) -> str:
    """CTEs of a tree over ``<name>0`` (tree, id, r, total, h, f): per level the
    runs of up to three nodes, then every leaf's proof text and folded digest."""
    out = [f"{name}n0 AS MATERIALIZED (SELECT tree, r AS idx, total, h FROM {name}0)",
           f"{name}p0 AS MATERIALIZED (SELECT *, '' AS proof FROM {name}0)"]
    for k in range(levels):
        out.append(f"""{name}g{k} AS MATERIALIZED (
  SELECT tree, idx // 3 AS idx, any_value(total) AS total, list(h ORDER BY idx) AS hs
  FROM {name}n{k} GROUP BY tree, idx // 3)""")
        out.append(f"""{name}n{k + 1} AS MATERIALIZED (
  SELECT tree, idx, total, CASE WHEN total > {3 ** k} THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h
  FROM {name}g{k})""")
        out.append(f"""{name}p{k + 1} AS MATERIALIZED (
  SELECT p.* EXCLUDE (proof, f, lft, rgt),
         CASE WHEN p.total > {3 ** k} THEN proof || lft || rgt ELSE proof END AS proof,
         CASE WHEN p.total > {3 ** k} THEN sha256(lft || f || rgt) ELSE f END AS f
  FROM (SELECT p.*, coalesce(array_to_string(hs[1:(r // {3 ** k}) % 3], ''), '') AS lft,
               coalesce(array_to_string(hs[(r // {3 ** k}) % 3 + 2:], ''), '') AS rgt
        FROM {name}p{k} p JOIN {name}g{k} g
          ON g.tree IS NOT DISTINCT FROM p.tree AND g.idx = p.r // {3 ** (k + 1)}) p)""")
    return ",\n".join(out)


# 3^13 documents a source and 3^8 sources; a level above a tree's own depth changes nothing.
DOC_LEVELS, SOURCE_LEVELS = 13, 8
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8)))"""
OP11 = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
leaves AS MATERIALIZED (
  SELECT source AS tree, source, doc_id, lang, n_chars, {_leaf_sql("text")} AS h,
         CASE WHEN {CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t
  FROM documents, crc),
d0 AS MATERIALIZED (
  SELECT tree, doc_id, h, h AS leaf, {_leaf_sql("t")} AS f,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS r,
         count(*) OVER (PARTITION BY tree) AS total FROM leaves),
{_tree_sql("d", DOC_LEVELS)},
s0 AS MATERIALIZED (
  SELECT 0 AS tree, tree AS source, h, h AS f, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS r,
         count(*) OVER () AS total FROM dn{DOC_LEVELS}),
{_tree_sql("s", SOURCE_LEVELS)},
-- The way above the subroot holds for every leaf of the source; a tampered leaf folds up it anew.
f0 AS MATERIALIZED (
  SELECT d.doc_id, d.leaf, d.f, d.proof AS below, s.proof AS above, s.h AS subroot, s.r, s.total, 0 AS tree
  FROM dp{DOC_LEVELS} d JOIN sp{SOURCE_LEVELS} s ON s.source IS NOT DISTINCT FROM d.tree),
{",".join(f"""
f{k + 1} AS MATERIALIZED (
  SELECT f.* EXCLUDE (f), CASE WHEN f.total > {3 ** k} THEN sha256(
           coalesce(array_to_string(hs[1:(r // {3 ** k}) % 3], ''), '') || f
           || coalesce(array_to_string(hs[(r // {3 ** k}) % 3 + 2:], ''), '')) ELSE f END AS f
  FROM f{k} f JOIN sg{k} g ON g.idx = f.r // {3 ** (k + 1)})""" for k in range(SOURCE_LEVELS))}
SELECT doc_id, leaf, subroot, root, sha256(below || above) AS proof_sha256, f AS folded_root, f = root AS verified
FROM f{SOURCE_LEVELS}, (SELECT h AS root FROM sn{SOURCE_LEVELS})
"""

ORACLE_SQL = {"op5_exact_dedup": OP5, "op6_warc": OP6, "op8_url_filter": OP8,
              "op7_mix_sources": OP7, "op10_quality_rules": OP10,
              "op11_merkle_manifest": OP11}
