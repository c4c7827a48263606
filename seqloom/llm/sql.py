"""DuckDB SQL for those opN_ queries that SQL can express on whole tables."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size,
             ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS weight
      FROM d GROUP BY source),
s AS (SELECT *, sum(source_size) OVER () AS total,
             sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS w_left,
             coalesce(sum(source_size) OVER w, 0) AS s_before
      FROM t WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, source
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total::DOUBLE - 3.0::DOUBLE * s_before::DOUBLE) / w_left::DOUBLE AS level FROM s),
f AS (SELECT *, 3.0::DOUBLE * source_size <= level * weight AS is_full FROM l),
g AS (SELECT *, arg_max(level, w_left) FILTER (WHERE NOT is_full) OVER () AS open_level FROM f),
r AS (SELECT source, source_size,
             CASE WHEN is_full THEN 3.0::DOUBLE * source_size ELSE open_level * weight END AS target FROM g),
q AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS rate FROM r)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN
          ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':17'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE
          < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
"""

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, {_WORDS} AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
u AS (SELECT rid, generate_subscripts(ws, 1) AS i, ws FROM w),
g AS (SELECT rid, i, array_to_string(ws[i:i+4], ' ') AS win FROM u WHERE i <= len(ws) - 4),
p AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
r AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
      FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM p) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, ((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
             | (CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END) | (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
             | (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END))::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""

ORACLES: dict[str, str] = {"op3_mixing": OP3, "op10_quality": OP10}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
