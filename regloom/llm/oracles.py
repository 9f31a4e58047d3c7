"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

from . import licenses, mixing, quality

_HASH = "('0x' || substr(md5({0}), 1, 15))::BIGINT"
WORD = r"[^\x20\x09-\x0D]+"


# DuckDB has no crc32, so the first operator is held against zlib and a plain jump in the tests.

OP2 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: x IN ({", ".join("'" + w + "'" for w in quality.STOP_FORMS)})))::BIGINT AS n_stop_words,
    len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (doc_id)),
b AS (
  SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
    nullif(concat_ws(',', {", ".join(
        "CASE WHEN " + bottom + " > 0 AND (" + " OR ".join(
            ([f"100 * {top} < {least} * {bottom}"] if least is not None else [])
            + ([f"100 * {top} > {most} * {bottom}"] if most is not None else [])) + f") THEN '{name}' END"
        for name, top, bottom, least, most in quality.RULES)}), '') AS broken
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND broken IS NULL AS kept, n_stop_words, n_lines, broken FROM b
"""

_W = mixing.WEIGHTS
OP4 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
          row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
r AS (SELECT *, [{", ".join(map(str, _W))}][(rank % {len(_W)} + 1)::INT] AS w, source_size * {mixing.MOST_COPIES} AS cap FROM per),
l AS (SELECT *, cap::DOUBLE / w AS ratio,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE
        / (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE AS level
      FROM r WINDOW o AS (ORDER BY cap::DOUBLE / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, w * (SELECT arg_min(level, (ratio, rank)) FROM l WHERE ratio >= level)) AS target,
        ('0x' || substr(md5('20|' || coalesce(source, '')), 1, 8))::BIGINT // 2 AS u
      FROM l),
p AS (SELECT d.doc_id, d.source, d.size, source_size, target, u,
        CASE WHEN source_size > 0 THEN floor(target / source_size * {mixing.ONE})::HUGEINT ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size,
          {_HASH.format("coalesce(d.doc_id::VARCHAR, 'null') || '|' || d.size::VARCHAR")}, d.doc_id) - 1 AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, ((u + rate * (pos + 1)) // {mixing.ONE} - (u + rate * pos) // {mixing.ONE})::BIGINT AS copies FROM p)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM c
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS s FROM p),
b AS (SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, s) AS best FROM g)
SELECT page_id, payload_bytes,
  translate(array_to_string(list_transform(range(8), lambda i:
    lpad(to_base(('0x' || substr(s, (1 + 5 * i)::INT, 5))::BIGINT, 32), 4, '0')), ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to
FROM b
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LWORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEMPLATES = ", ".join(
    f"('{label}', [{', '.join(chr(39) + w.decode() + chr(39) for w in sorted(set(licenses.words(text))))}])"
    for label, text in licenses.TEMPLATES)
OP9 = rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{_LWORD}') AS words, t FROM d),
starts AS (
  SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
    (VALUES {", ".join(f"({p.split()}, '{label}')" for p, label in licenses.PHRASES.items())}) v(phrase, label)
  WHERE words[i] = phrase[1] AND words[i:i + len(phrase) - 1] = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    list(DISTINCT label) AS labels FROM starts GROUP BY doc_id),
blocks AS (SELECT DISTINCT doc_id, list_distinct(regexp_extract_all(line, '{_LWORD}')) AS own
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
met AS (
  SELECT doc_id, label, max(len(list_intersect(own, words)) / len(words)) AS share
  FROM blocks, (VALUES {_TEMPLATES}) v(label, words)
  WHERE 100 * len(list_intersect(own, words)) >= {licenses.PERCENT} * len(words) GROUP BY doc_id, label),
more AS (SELECT doc_id, list(label) AS labels, max(share) AS share FROM met GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""

OP10 = rf"""
WITH l AS (
  SELECT r, doc_id, i, x[i] AS line, translate(regexp_replace(x[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_AZ}) AS key
  FROM (SELECT r, doc_id, x, unnest(range(1, len(x) + 1)) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
f AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM f)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
FROM l GROUP BY r, doc_id
"""

ORACLE = {"op2_quality_rules": OP2, "op4_source_mixing": OP4, "op5_warc_round_trip": OP5,
          "op9_license_scan": OP9, "op10_line_dedup": OP10}
