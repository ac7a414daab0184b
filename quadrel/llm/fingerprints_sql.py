"""DuckDB SQL for the table of document fingerprints: closed syncmers by windows over words, hashes in unsigned arithmetic."""

from __future__ import annotations

from quadrel.llm.fingerprints import PARTS, SKETCH
from quadrel.llm.simhash_sql import PRIMES, SEED, _hashed, _plus, _times, _turned

K = 5


def _chained(name: str, source: str, rounds: list[str], out: str) -> str:
    """CTEs from ``source`` to ``name``: the hash, each word's hash the seed of the next, of the words of ``rounds``; null words are passed over."""
    p1, p2, p3, p4, p5 = PRIMES
    ctes, before, seed = [], source, f"CAST({SEED} AS UBIGINT)"
    for i, k in enumerate(rounds):
        mixed = f"xor({_plus('seed', str((p5 + 8) % (1 << 64)))}, {k})"
        stages = [
            ("seed", seed),
            ("x", _plus(_times(_turned(mixed, 27), p1), str(p4))),
            ("y", _times("xor(x, x >> 33)", p2)),
            ("z", _times("xor(y, y >> 29)", p3)),
            ("seed", f"CASE WHEN {k} IS NULL THEN seed ELSE xor(z, z >> 32) END"),
        ][i > 0 :]
        for j, (column, value) in enumerate(stages):
            last = i == len(rounds) - 1 and j == len(stages) - 1
            here = name if last else f"{name}_{i}_{j}"
            gone = " EXCLUDE (seed, x, y, z)" if j == len(stages) - 1 else ""
            ctes.append(f"{here} AS (SELECT *{gone}, {value} AS {out if last else column} FROM {before})")
            before = here
    return ",\n".join(ctes)


def fingerprint_table_sql() -> str:
    """SQL of all columns of the fingerprints' table over ``documents``, for k-mers of five words and inner substrings of two."""
    signed = "CASE WHEN run >= CAST(9223372036854775808 AS UBIGINT) THEN CAST(run AS HUGEINT) - 18446744073709551616 ELSE CAST(run AS HUGEINT) END"
    ahead = ", ".join(f"lead(word_round, {i}) OVER w AS k{i}" for i in range(1, K))
    inner = ", ".join(f"lead(run_signed, {i}) OVER w AS r{i}" for i in range(1, K - 1))
    near = lambda a, b: f"""CASE WHEN len({a}.entries) = 0 AND len({b}.entries) = 0 THEN 1.0 ELSE (
    SELECT CAST(len(list_intersect(p, q)) AS DOUBLE) / (len(p) + len(q) - len(list_intersect(p, q))) FROM (
      SELECT [e FOR e IN {a}.entries IF e <= least({a}.bound, {b}.bound)] AS p, [e FOR e IN {b}.entries IF e <= least({a}.bound, {b}.bound)] AS q)) END"""  # noqa: E731
    return rf"""
WITH whole AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
followed AS (
  SELECT doc_id, text, length(text) AS n_chars, length(text) // 2 AS half,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id,
         coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text
  FROM whole),
edits AS (SELECT *, substr(text, 1, n_chars - half) || substr(next_text, 1, half) AS edited FROM followed),
texts AS (SELECT doc_id, 0 AS edition, text FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits),
listed AS (SELECT doc_id, edition, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
placed AS (SELECT doc_id, edition, len(words) AS n_words, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM listed),
shingles AS (SELECT DISTINCT word AS shingle FROM placed),{_hashed()},
word_rounds AS (SELECT shingle, {_times(_turned(_times('h', PRIMES[1]), 31), PRIMES[0])} AS word_round FROM hashed),
led AS (
  SELECT doc_id, edition, n_words, place, word_round AS k0, {ahead} FROM placed JOIN word_rounds ON shingle = word
  WINDOW w AS (PARTITION BY doc_id, edition ORDER BY place)),
{_chained('runs', 'led', ['k0', 'k1'], 'run')},
inner_runs AS (
  SELECT *, {inner} FROM (SELECT *, {signed} AS run_signed FROM runs) WINDOW w AS (PARTITION BY doc_id, edition ORDER BY place)),
closed AS (
  SELECT doc_id, edition, place, k0, k1, k2, k3, k4 FROM inner_runs
  WHERE CASE WHEN n_words < {K} THEN place = 0 ELSE place <= n_words - {K} AND least(run_signed, r3) <= least(r1, r2) END),
{_chained('anchored', 'closed', [f'k{i}' for i in range(K)], 'hash')},
once AS (SELECT doc_id, edition, CAST(hash & 4294967295 AS BIGINT) AS code, min(place) AS place FROM anchored GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, edition ORDER BY code) AS nth, count(*) OVER (PARTITION BY doc_id, edition) AS many,
         greatest({SKETCH}, count(*) FILTER (code < {(1 << 32) // PARTS}) OVER (PARTITION BY doc_id, edition)) AS most
  FROM once),
sketched AS (
  SELECT doc_id, edition, list(code ORDER BY code) AS entries, CASE WHEN any_value(many <= most) THEN {1 << 32} ELSE max(code) END AS bound,
         string_agg(lpad(printf('%x', code), 8, '0') || '@' || printf('%x', place), ' ' ORDER BY code) AS fingerprint
  FROM ranked WHERE nth <= most GROUP BY doc_id, edition),
prints AS (
  SELECT t.doc_id, t.edition, coalesce(entries, []) AS entries, coalesce(bound, {1 << 32}) AS bound, coalesce(fingerprint, '') AS fingerprint
  FROM texts t LEFT JOIN sketched s ON s.doc_id = t.doc_id AND s.edition = t.edition)
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, o.fingerprint, c.fingerprint AS edited_fingerprint,
       {near('o', 'c')} AS near_edited, {near('o', 'n')} AS near_next
FROM edits e JOIN prints o ON o.doc_id = e.doc_id AND o.edition = 0 JOIN prints c ON c.doc_id = e.doc_id AND c.edition = 1
JOIN prints n ON n.doc_id = e.next_id AND n.edition = 0
"""
