"""The same results in DuckDB SQL, for the queries that SQL can express.

Token ids, DOM trees, span offsets and lattice sums are none of SQL's; the tests compare those
queries with plain versions instead.
"""

from __future__ import annotations

from jobsignals.llm import (
    conversation_trie, hard_negatives, mixing, near_dedup, quality_rules, substring_dedup,
)

WORD = r"[^\x20\x09-\x0D]+"
LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz')")


def _rules(strict: bool) -> str:
    over = {"symbols": ("n_symbols", "n_words"), "lines": ("n_dup_lines", "n_lines"),
            "capitals": ("n_capitals", "word_chars"), "shouts": ("n_exclaims", "n_words"),
            "repeats": ("n_repeat_words", "n_words")}
    return " + ".join(f"(100 * {a} > {quality_rules.LIMITS[rule][strict]} * {b})::BIGINT"
                      for rule, (a, b) in over.items())


QUALITY = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents),
pos AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
tri AS (
  SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS k FROM pos
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM tri WHERE k IS NOT NULL),
rep AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, i AS j FROM dup WHERE c > 1
    UNION ALL SELECT doc_id, i + 1 FROM dup WHERE c > 1
    UNION ALL SELECT doc_id, i + 2 FROM dup WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
         len(regexp_extract_all(text, '!'))::BIGINT AS n_exclaims
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
f AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS}
            OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed,
         {_rules(False)} AS ordinary, {_rules(True)} AS strict FROM m),
h AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR ordinary > 0) AS bad
  FROM f GROUP BY source),
g AS (SELECT least(greatest(avg(bad / n), 0.001), 0.999) AS mean, var_pop(bad / n) AS v FROM h),
p AS (
  SELECT mean, CASE WHEN v > 0 THEN least(greatest(mean * (1 - mean) / v - 1, 1.0), 1000.0)
                    ELSE 1.0 END AS strength FROM g),
r AS (SELECT source, (bad + mean * strength) / (n + strength) AS host_rate FROM h, p),
v AS (
  SELECT *, CASE WHEN host_rate >= {quality_rules.CONDEMNED} THEN 'condemned'
                 WHEN host_rate >= {quality_rules.DOUBTFUL} THEN 'doubtful'
                 ELSE 'trusted' END AS verdict FROM r),
j AS (
  SELECT f.*, host_rate, verdict,
         CASE WHEN verdict = 'doubtful' THEN strict ELSE ordinary END AS n_rules_failed
  FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND verdict <> 'condemned' AND n_rules_failed = 0 AS kept,
       n_rules_failed, round(host_rate, 6) AS host_rate, verdict FROM j
"""

W = substring_dedup.WIDTH
SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
pos AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i, len(words) AS n FROM d),
win AS (
  SELECT doc_id, i, w, CASE WHEN i + {W} <= n THEN string_agg(w, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING) END AS k
  FROM pos),
twice AS (SELECT k FROM win WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1),
hit AS (
  SELECT doc_id, i, w, (k IS NOT NULL AND k IN (SELECT k FROM twice))::INT AS h FROM win),
cov AS (
  SELECT doc_id, i, w, max(h) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM hit),
kept AS (
  SELECT doc_id, count(*) AS n, sum(gone) AS r,
         string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS t FROM cov GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM documents),
pos AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM d
        WHERE len(words) >= 5),
grams AS (
  SELECT doc_id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' '
         || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM pos
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sets AS (
  SELECT DISTINCT doc_id, g FROM grams WHERE g IS NOT NULL
  UNION ALL
  SELECT doc_id, array_to_string(words, ' ') FROM d WHERE len(words) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM both_ JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * both_.n >= {near_dedup.PERCENT} * (x.n + y.n - both_.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a),
least_ AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT l.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id,
       l.doc_id = component_id AS kept
FROM least_ l LEFT JOIN sizes ON l.doc_id = sizes.doc_id
"""

EXACT = rf"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

MIX = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens
  FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM t GROUP BY source),
m AS (SELECT max(tokens)::DOUBLE AS most, (min(tokens) FILTER (tokens > 0))::DOUBLE AS few FROM s),
b(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT i, lo, hi, (lo + hi) / 2 AS mid,
           pow(few / most, (lo + hi) / 2 - 1) <= {mixing.MAX_REPEATS} AS ok
    FROM b, m WHERE i < 40)),
e AS (SELECT hi AS a FROM b WHERE i = 40),
z AS (SELECT sum(pow(tokens / most, a)) FILTER (tokens > 0) AS z FROM s, m, e),
g AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / most, a) / z ELSE 0 END AS weight,
         CASE WHEN tokens > 0 THEN round(pow(tokens / most, a - 1) * tokens)::BIGINT
              ELSE 0 END AS budget
  FROM s, m, e, z),
k AS (
  SELECT source, weight, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS whole,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM g),
x AS (
  SELECT doc_id, t.source, n_tokens, weight, whole, rest, unnest(range(0, whole + 1)) AS block
  FROM t JOIN k ON t.source = k.source),
o AS (
  SELECT *, coalesce(sum(n_tokens) OVER (
    PARTITION BY source, block
    ORDER BY md5('{mixing.SEED}:' || block || ':' || doc_id), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM x WHERE block < whole OR rest > 0)
SELECT doc_id, source, block::BIGINT AS block, start, n_tokens, round(weight, 6) AS weight
FROM o WHERE block < whole OR start < rest
"""


def _crc_table() -> list[int]:
    """CRC-32 (reflected polynomial 0xEDB88320) of every byte value, built by its rule."""
    table = []
    for byte in range(256):
        c = byte
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


def crc32(decimal: str) -> str:
    """DuckDB expression: unsigned CRC-32 of an ASCII string expression."""
    table = "[" + ", ".join(map(str, _crc_table())) + "]::BIGINT[]"
    return (f"xor(list_reduce(list_transform(string_split({decimal}, ''), lambda ch: ascii(ch)), "
            f"lambda acc, x: xor(({table})[(xor(acc, x::BIGINT) & 255) + 1], acc >> 8), "
            f"4294967295::BIGINT), 4294967295::BIGINT)")


TRIE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, {crc32("c::VARCHAR")} % {conversation_trie.HEADS} AS h,
         c - c % {conversation_trie.GROUP} AS b
  FROM (SELECT DISTINCT conv_id AS c FROM t)),
r AS (
  SELECT ids.c, 0 AS part, t.pos, t.role, t.text FROM ids JOIN t ON t.conv_id = ids.b AND t.pos < ids.h
  UNION ALL
  SELECT ids.c, 1, t.pos, t.role, t.text FROM ids JOIN t ON t.conv_id = ids.c AND t.pos >= ids.h),
seq AS (
  SELECT ids.c, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY r.part, r.pos)
                         FILTER (WHERE r.pos IS NOT NULL), []) AS turns
  FROM ids LEFT JOIN r ON r.c = ids.c GROUP BY ids.c),
m AS (
  SELECT c, d, turns[1:d] AS p, len(turns) AS l,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(turns[d].text, '{WORD}')) END AS w,
         CASE WHEN len(turns) > d THEN turns[d + 1] END AS nxt
  FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM seq)),
node AS (
  SELECT p, any_value(d)::BIGINT AS depth, min(c)::BIGINT AS conv_id, count(*)::BIGINT AS n_convs,
         any_value(w)::BIGINT AS w, count(DISTINCT nxt)::BIGINT AS n_children,
         coalesce(sha256(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE l = d)),
                  sha256('')) AS ends_sha256
  FROM m GROUP BY p),
up AS (
  SELECT p[1:j] AS a, own, leaf FROM (
    SELECT p, (n_convs - 1) * w AS own, (n_children = 0)::BIGINT AS leaf,
           unnest(range(depth + 1)) AS j FROM node)),
sub AS (SELECT a, sum(own)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM up GROUP BY a)
SELECT node.conv_id, node.depth, par.conv_id AS parent_conv_id, node.n_convs, node.n_children,
       sub.n_leaves, sub.saved_tokens, node.ends_sha256
FROM node JOIN sub ON sub.a = node.p
LEFT JOIN node AS par ON node.depth > 0 AND par.p = node.p[1:node.depth - 1]
"""

NEGATIVES = rf"""
WITH e AS (
  SELECT vec_id::BIGINT AS vec_id,
         CASE WHEN vec_id % {hard_negatives.RELABEL_EVERY} = 0
              THEN (label::BIGINT + 1) % {hard_negatives.LABELS} ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {hard_negatives.SCALE})::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) <= {hard_negatives.MOST_DIMS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x)
                        OR NOT abs(x::DOUBLE * {hard_negatives.SCALE}) < {hard_negatives.MOST_COMPONENT})) = 0),
v AS (SELECT vec_id, min(struct_pack(label := label, q := q)) AS r FROM e GROUP BY vec_id),
w AS (SELECT vec_id, r.label AS label, r.q AS q FROM v),
a AS (SELECT vec_id AS anchor_id, label AS al, q AS aq FROM w WHERE vec_id % {hard_negatives.ANCHOR_EVERY} = 0),
s AS (
  SELECT anchor_id, al, w.vec_id, w.label,
         coalesce(list_sum(list_transform(range(1, least(len(aq), len(q)) + 1),
                                          lambda i: aq[i] * q[i])), 0)::BIGINT AS score
  FROM a JOIN w ON w.vec_id <> a.anchor_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
    FROM s WHERE label = al) WHERE r <= {hard_negatives.POSITIVES}),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id,
         s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                            ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.al
  WHERE {hard_negatives.LOW} * p.positive_score <= 100 * s.score
    AND 100 * s.score <= {hard_negatives.HIGH} * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {hard_negatives.NEGATIVES}
"""

ORACLES: dict[str, str] = {
    "op2_quality_rules": QUALITY, "op4_substring_dedup": SUBSTRINGS,
    "op5_temperature_mixing": MIX, "op6_minhash_near_dedup": NEAR, "op9_exact_dedup": EXACT,
    "op11_conversation_trie": TRIE, "op12_hard_negatives": NEGATIVES,
}
