import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quadrel.llm import induced, suffix_dedup


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80))
def test_suffix_array_and_common_prefixes(values):
    s = np.array([*values, 0], np.uint16)
    sa = induced.suffix_array(s, 200)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    shared = induced.common_prefixes(s, sa, 200)
    for a, b in zip(sa[:-1], sa[1:]):
        k = 0
        while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        assert shared[b] == k


def brute(rows, length):
    count = Counter()
    for _, t in rows:
        data = (t or "").encode()
        count.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if count[data[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [20_000, 0])
def test_matches_brute_force(odd, odd_rows, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = suffix_dedup.remove_repeats(odd).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(odd_rows, 200)


def test_long_texts_are_cut_in_overlapping_blocks(make, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 900)
    r = random.Random(5)
    letters = "".join(r.choice("abcd") for _ in range(6000))
    rows = [(1, letters), (2, letters[850:2000] + "x" + letters[3000:3300]), (3, "é" + letters[100:299] + "é")]
    got = suffix_dedup.remove_repeats(make(rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows, 200)


def test_no_rows(none):
    assert suffix_dedup.remove_repeats(none).count() == 0
