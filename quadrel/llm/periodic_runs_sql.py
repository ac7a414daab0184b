"""The query of :mod:`quadrel.llm.periodic_runs` as DuckDB SQL: equal words of a document, joined and gathered into islands."""

from __future__ import annotations

from quadrel.llm.periodic_runs import LEAST, PERIODS


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string of up to 20 characters, bit by bit."""
    step = "list_reduce(list_prepend({state}, range(1, 9)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    one = step.format(state="xor(acc, code)")
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(unicode(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda acc, code: {one}), 4294967295)"


def digests_sql(least: int = LEAST, periods: int = PERIODS) -> str:
    """SQL of :func:`quadrel.llm.periodic_runs.digests` over ``documents``; for small tables, as it joins all equal words of a document."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, coalesce(CAST(doc_id AS VARCHAR), '') AS digits
  FROM documents),
h AS (SELECT r, doc_id, w, len(w) AS n, {_crc32("digits")} AS h FROM d),
p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS times FROM h),
words AS (
  SELECT r, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % (1 + (n - a) // times) END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM p)),
equal AS (
  SELECT x.r, y.i - x.i AS period, x.i AS i
  FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND {periods} * (y.i - x.i) <= x.n
  WHERE x.n >= {least}),
islands AS (SELECT r, period, i, i - row_number() OVER (PARTITION BY r, period ORDER BY i) AS island FROM equal),
stretches AS (SELECT r, period, min(i) AS start, count(*) + period AS length FROM islands GROUP BY r, period, island),
runs AS (
  SELECT r, start, length, min(period) AS period FROM stretches WHERE length >= greatest({least}, {periods} * period) GROUP BY r, start, length),
best AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         first({{'start': start, 'length': length, 'period': period}} ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS top
  FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period,
       CAST(1000 * top.length // top.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM h LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
