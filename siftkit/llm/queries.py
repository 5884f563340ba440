"""Named queries of the numbered operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from .exactdup import op13_content_sort
from .html import op7_host_suffix_text
from .licenses import MIN_DICE_PCT, forms, op5_license_dice
from .mixing import op2_source_mix
from .neardup import op9_bayes_minhash
from .packing import op10_swap_packing
from .pii import op8_contextual_pii
from .quality import (
    BOILERPLATE,
    LONG_LINE,
    MAX_LOST_PCT,
    MAX_SYMBOL_PCT,
    NAV_SEPARATORS,
    SEPARATORS,
    SHOUT_PCT,
    STOCK_LINE,
    op3_line_quality,
)
from .resampling import BUCKETS, DRAW_PCT, MIN_WORDS, SEED, op12_importance_draw
from .sharding import op1_byte_shards
from .toxicity import op4_toxicity
from .vectors import op6_projection_passes
from .whitening import op11_rank_one_whitening

QUERIES = {f.__name__: f for f in (
    op1_byte_shards, op2_source_mix, op3_line_quality, op4_toxicity, op5_license_dice, op6_projection_passes,
    op7_host_suffix_text, op8_contextual_pii, op9_bayes_minhash, op10_swap_packing,
    op11_rank_one_whitening, op12_importance_draw, op13_content_sort)}


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def quality_sql() -> str:
    stock = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
tok AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
gram AS (
  SELECT rid, p, list(word) OVER win AS g, count(*) OVER win AS n FROM tok
  WINDOW win AS (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM gram WHERE n = 8) WHERE c > 1),
rep AS (
  SELECT rid, sum(least(8, coalesce(nxt - p, 8)))::BIGINT AS n_repeat
  FROM (SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS nxt FROM twice) GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT rid, line, length(line) AS n,
                 len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
                 len(list_filter(regexp_split_to_array(line, '{space}+'), lambda x: x IN ({_quoted(SEPARATORS)}))) AS menu,
                 len(regexp_extract_all(line, '\p{{Lu}}')) AS capitals
          FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (SELECT *, (symbols >= 3 AND symbols * 100 > n * {MAX_SYMBOL_PCT})
                  OR (n >= {LONG_LINE} AND NOT regexp_matches(line, '[.!?…。;:]'))
                  OR menu >= {NAV_SEPARATORS} OR capitals * 100 > n * {SHOUT_PCT}
                  OR (n <= {STOCK_LINE} AND ({stock})) AS fails FROM lines),
agg AS (SELECT rid, count(*) - count(DISTINCT line) AS dup, sum(symbols) AS symbols, sum(n) AS n,
               sum(CASE WHEN fails THEN n ELSE 0 END) AS lost FROM judged GROUP BY rid),
base AS (
  SELECT d.doc_id, len(w.words)::BIGINT AS n_words, length(array_to_string(w.words, ''))::BIGINT AS word_chars,
         coalesce(agg.symbols, 0)::BIGINT AS n_symbols, coalesce(agg.dup, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(agg.n, 0) AS n, coalesce(agg.lost, 0) AS lost
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN agg USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost * 100 <= n * {MAX_LOST_PCT} AS kept
FROM base"""


def license_sql() -> str:
    rows = ", ".join(f"({k}, '{name}', {n}, [{_quoted(b)}])" for k, (name, n, b) in enumerate(forms()))
    return rf"""
WITH t(tid, name, n, b) AS (VALUES {rows}),
tb AS (SELECT tid, unnest(b) AS pair FROM t),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+(?:\.[0-9]+)*') AS words FROM documents),
p AS (SELECT rid, unnest(range(1, len(words))) AS i, unnest(list_zip(words[:-2], words[2:])) AS w
      FROM d WHERE len(words) > 1),
pairs AS (SELECT rid, i, w[1] || ' ' || w[2] AS pair FROM p),
held AS (SELECT rid, tid, i, pair FROM pairs JOIN tb USING (pair)),
starts AS (  -- runs of a template's pairs, in documents that hold enough of them
  SELECT rid, tid, i AS s FROM (SELECT rid, tid, i, lag(i) OVER (PARTITION BY rid, tid ORDER BY i) AS before FROM held)
  JOIN (SELECT rid, tid FROM held JOIN t USING (tid) GROUP BY rid, tid, len(b)
        HAVING count(DISTINCT pair) * {200 - MIN_DICE_PCT} >= len(b) * {MIN_DICE_PCT}) USING (rid, tid)
  WHERE before IS NULL OR before < i - 1),
windows AS (
  SELECT s.rid, s.tid, s.s, 200 * count(DISTINCT CASE WHEN list_contains(t.b, q.pair) THEN q.pair END)
         // (count(DISTINCT q.pair) + len(t.b)) AS dice
  FROM starts s JOIN t USING (tid) JOIN pairs q ON q.rid = s.rid AND q.i BETWEEN s.s AND s.s + t.n - 1
  GROUP BY s.rid, s.tid, s.s, t.b),
best AS (SELECT rid, min({{'rank': -dice, 'name': name}}) AS top, count(*) AS n
         FROM windows JOIN t USING (tid) WHERE dice >= {MIN_DICE_PCT} GROUP BY rid)
SELECT d.doc_id, top.name AS license, -top.rank AS dice, coalesce(best.n, 0) AS n_windows FROM d LEFT JOIN best USING (rid)"""


def resampling_sql() -> str:
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    return rf"""
WITH RECURSIVE crc AS (  -- the byte table of CRC-32
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 1, 2, 3, 4, 5, 6, 7],
                          lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS b))),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS words FROM documents),
dw AS (SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(words) AS word FROM d) GROUP BY ALL),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY ALL),
bytes AS (SELECT word, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::BIGINT) AS x
          FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
k AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, x),
                                   lambda c, y: xor(c // 256, crc.t[xor(c % 256, y) + 1])), 4294967295) % {BUCKETS} AS bucket
      FROM bytes, crc),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN k USING (word) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN k USING (word) GROUP BY 1),
total AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s, coalesce((SELECT sum(n) FROM t), 0) AS t),
gain AS (SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (total.s + {BUCKETS}))::DOUBLE
                                          / ((s.n + 1) * (total.t + {BUCKETS}))::DOUBLE))::BIGINT AS g
         FROM s LEFT JOIN t USING (bucket), total),
weight AS (SELECT rid, sum(n * g)::BIGINT AS g, sum(n)::BIGINT AS n FROM dw JOIN k USING (word) JOIN gain USING (bucket)
           GROUP BY rid),
scored AS (
  SELECT d.rid, doc_id, len(words) AS n_words, len(words)::BIGINT AS n_features,
         coalesce(g // n - CASE WHEN g % n < 0 THEN 1 ELSE 0 END, 0) AS weight,
         floor(-1000 * ln(-ln((('0x' || left(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 8))::BIGINT + 0.5::DOUBLE)
                              / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM d LEFT JOIN weight USING (rid)),
placed AS (SELECT *, weight + noise AS score, row_number() OVER (
             PARTITION BY n_words >= {MIN_WORDS} ORDER BY weight + noise DESC, doc_id) AS place,
             count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND place <= {DRAW_PCT} * n // 100 THEN place END AS rank
FROM placed"""


# exact duplicates: classes by text, the largest id stays
CONTENT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(text) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) WINDOW w AS (PARTITION BY text)"""

ORACLE = {"op3_line_quality": quality_sql(), "op5_license_dice": license_sql(),
          "op12_importance_draw": resampling_sql(), "op13_content_sort": CONTENT_SQL}
