"""DuckDB SQL for classes of near copies by SimHash: XXH64 in unsigned arithmetic, all pairs of fingerprints, reachability."""

from __future__ import annotations

#: The five primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)

SEED = 42
FULL = 1 << 64


def _times(a: str, b: int) -> str:
    return f"CAST(CAST({a} AS UHUGEINT) * CAST({b} AS UHUGEINT) % CAST({FULL} AS UHUGEINT) AS UBIGINT)"


def _plus(*terms: str) -> str:
    return f"CAST(({' + '.join(f'CAST({t} AS UHUGEINT)' for t in terms)}) % CAST({FULL} AS UHUGEINT) AS UBIGINT)"


def _turned(x: str, bits: int) -> str:
    return f"({_times(x, 1 << bits)} | ({x} >> {64 - bits}))"


def _number(at: str, size: int) -> str:
    """The little-endian number of ``size`` bytes from byte ``at`` on of the hexadecimal ``digits``."""
    return "CAST('0x' || " + " || ".join(f"substr(digits, 2 * ({at}) + {2 * k + 1}, 2)" for k in reversed(range(size))) + " AS UBIGINT)"


def _hashed() -> str:
    """CTEs from ``shingles(shingle)`` to ``hashed(shingle, h)``."""
    p1, p2, p3, p4, p5 = PRIMES
    starts = [(SEED + p1 + p2) % FULL, (SEED + p2) % FULL, SEED, (SEED - p1) % FULL]
    runs = [
        f"list_reduce([x FOR x, i IN scaled IF i % 4 = {(k + 1) % 4} AND i <= blocks * 4], lambda v, x: {_times(_turned(_plus('v', 'x'), 31), p1)}, CAST({start} AS UBIGINT)) AS v{k}"
        for k, start in enumerate(starts)
    ]
    opened = _plus(*(_turned(f"v{k}", bits) for k, bits in enumerate((1, 7, 12, 18))))
    rounds = ", ".join(_times(_turned(_times(f"v{k}", p2), 31), p1) for k in range(4))
    bytes_of = f"[{_number('n - n % 4 + k', 1)} FOR k IN range(n % 4)]"
    return f"""
coded AS (SELECT shingle, hex(encode(shingle)) AS digits, CAST(octet_length(encode(shingle)) AS BIGINT) AS n FROM shingles),
laned AS (
  SELECT shingle, digits, n, n // 32 AS blocks, [{_times(_number('8 * k', 8), p2)} FOR k IN range(n // 8)] AS scaled,
         CASE WHEN n % 8 >= 4 THEN [{_number('n // 8 * 8', 4)}] ELSE [] END AS quads, {bytes_of} AS singles
  FROM coded),
striped AS (SELECT *, {', '.join(runs)}, [{_times(_turned('x', 31), p1)} FOR x, i IN scaled IF i > blocks * 4] AS rest FROM laned),
merged AS (
  SELECT *, CASE WHEN n < 32 THEN CAST({(SEED + p5) % FULL} AS UBIGINT)
    ELSE list_reduce([{rounds}], lambda h, r: {_plus(_times('xor(h, r)', p1), str(p4))}, {opened}) END AS h0 FROM striped),
long_run AS (SELECT *, list_reduce(rest, lambda h, r: {_plus(_times(_turned('xor(h, r)', 27), p1), str(p4))}, {_plus('h0', 'n')}) AS h1 FROM merged),
short_run AS (SELECT *, list_reduce(quads, lambda h, q: {_plus(_times(_turned(f"xor(h, {_times('q', p1)})", 23), p2), str(p3))}, h1) AS h2 FROM long_run),
byte_run AS (SELECT *, list_reduce(singles, lambda h, b: {_times(_turned(f"xor(h, {_times('b', p5)})", 11), p1)}, h2) AS h3 FROM short_run),
mixed AS (SELECT shingle, {_times('xor(h3, h3 >> 33)', p2)} AS h4 FROM byte_run),
mixed_again AS (SELECT shingle, {_times('xor(h4, h4 >> 29)', p3)} AS h5 FROM mixed),
hashed AS (SELECT shingle, xor(h5, h5 >> 32) AS h FROM mixed_again)"""


def near_classes_sql(words: int = 3, within: int = 2) -> str:
    """SQL of (doc_id, fingerprint, component_id) over ``documents``, for a small table: it compares all fingerprints."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    following = " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, words))])
    bits = " + ".join(f"CASE WHEN 2 * sum(times * CAST((h >> {b}) & 1 AS BIGINT)) > sum(times) THEN CAST({1 << b} AS UHUGEINT) ELSE 0 END" for b in range(64))
    return rf"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM listed WHERE len(words) >= {words}),
shingled AS (
  SELECT doc_id, {following} AS shingle FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY place)
  UNION ALL
  SELECT doc_id, array_to_string(words, ' ') FROM listed WHERE len(words) BETWEEN 1 AND {words - 1}),
counted AS (SELECT doc_id, shingle, count(*) AS times FROM shingled WHERE shingle IS NOT NULL GROUP BY ALL),
shingles AS (SELECT DISTINCT shingle FROM counted),{_hashed()},
printed AS (SELECT doc_id, CAST({bits} AS UBIGINT) AS print FROM counted JOIN hashed USING (shingle) GROUP BY doc_id),
prints AS (SELECT doc_id, coalesce(print, 0) AS print FROM listed LEFT JOIN printed USING (doc_id)),
owners AS (SELECT print, min(doc_id) AS owner FROM prints GROUP BY print),
links AS (SELECT a.owner AS one, b.owner AS two FROM owners a JOIN owners b ON bit_count(xor(a.print, b.print)) <= {within}),
reached AS (SELECT one, two FROM links UNION SELECT r.one, l.two FROM reached r JOIN links l ON l.one = r.two),
least AS (SELECT one, min(two) AS component_id FROM reached GROUP BY one)
SELECT doc_id, lower(lpad(printf('%x', print), 16, '0')) AS fingerprint, component_id
FROM prints JOIN owners USING (print) JOIN least ON least.one = owner
"""
