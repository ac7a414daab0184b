import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quadrel.llm import periodic_runs

SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(w, least=24, periods=3):
    """(start, length, period) by start, then period: for each period, the stretches of words that equal the word a period on."""
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, periods * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda x: (x[0], x[2]))


def brute_kept(w, runs):
    gone = set()
    for s, n, q in runs:
        gone |= set(range(s + q, s + n))
    return [x for i, x in enumerate(w) if i not in gone]


def brute_planted(ident, text):
    w = SPACE.findall(text or "")
    h = zlib.crc32(("" if ident is None else str(ident)).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def loops(r, words, pieces):
    w = []
    for _ in range(r.randint(0, pieces)):
        p = [r.choice(words) for _ in range(r.randint(1, 25))]
        w += (p * r.randint(1, 12))[: r.randint(1, 120)]
    return w


def test_grids_leave_no_run_out():
    for least, periods in ((24, 3), (4, 2), (10, 3), (24, 5)):
        for q in range(1, 300):
            level, step = periodic_runs.grid(q, least, periods)
            agree = max(least, periods * q) - q
            assert level >= 0 and step >= 1
            for first in range(step):  # of the grid's places at or behind a run's start
                assert agree - first >= 1 << level


@pytest.mark.parametrize(("least", "periods", "alphabet"), [(24, 3, "ab"), (24, 3, "abcde"), (6, 2, "ab"), (8, 4, "abc")])
def test_runs_equal_brute_force(make, monkeypatch, least, periods, alphabet):
    r = random.Random(least + len(alphabet))
    rows = [(i, " ".join(loops(r, alphabet, 6))) for i in range(250)]
    rows += [(900, "a " * 3000), (901, "a b " * 1500 + "c " + "b a " * 40), (902, " ".join(alphabet[bin(i).count("1") % 2] for i in range(2048)))]
    monkeypatch.setattr(periodic_runs, "BATCH", 3000)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 500)
    got = {x.doc_id: x for x in periodic_runs.periodic_runs(make(rows), least=least, periods=periods).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = t.split()
        want = brute_runs(w, least, periods)
        assert [tuple(x) for x in got[i].runs] == want, t
        assert (got[i].n_words, got[i].collapsed) == (len(w), " ".join(brute_kept(w, want)))


def test_candidates_taken_in_parts_give_the_same(monkeypatch):
    words = np.array([1, 2] * 400 + [3] + [1] * 300 + [4])
    sizes = np.array([len(words) - 1])
    whole = periodic_runs.runs_of(words, sizes)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 7)
    assert (periodic_runs.runs_of(words, sizes) == whole).all() and len(whole) == 2


def test_query_equals_brute_force(make, odd_rows, none):
    r = random.Random(5)
    rows = odd_rows + [(100 + i, " \t".join(loops(r, ["x", "y", "zé", "漢 b", "\x1c"], 5))) for i in range(150)]
    want = []
    for i, t in rows:
        w = brute_planted(i, t)
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(brute_kept(w, runs)) if runs or brute_planted(i, t) != SPACE.findall(t or "") else " ".join(w)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append(repr((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest(lines), digest(kept))))
    assert sum("None, None" not in x for x in want) > 20
    assert sorted(repr(tuple(x)) for x in periodic_runs.digests(make(rows)).collect()) == sorted(want)
    assert periodic_runs.digests(none).count() == 0


def test_too_few_periods_are_refused(none):
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.periodic_runs(none, periods=1)
