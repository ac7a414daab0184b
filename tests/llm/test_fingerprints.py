import hashlib
import re
import struct

import xxhash

from quadrel.llm import fingerprints as fp


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def of_text(s):
    return signed(xxhash.xxh64_intdigest(s.encode(), 42))


def of_longs(*longs):
    seed = 42
    for x in longs:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return signed(seed)


def sketch(text):
    """{hash: first position} of the sampled anchors, and whether they are all."""
    h = [of_text(w) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if len(h) >= 5:
        m = [of_longs(a, b) for a, b in zip(h, h[1:])]
        found = [(p, of_longs(*h[p : p + 5])) for p in range(len(h) - 4) if min(m[p], m[p + 3]) <= min(m[p + 1], m[p + 2])]
    else:
        found = [(0, of_longs(*h))] if h else []
    first = {}
    for p, x in found:
        first.setdefault(x & 0xFFFFFFFF, p)
    low = sum(x < 2**32 // 16 for x in first)
    kept = sorted(first)[: max(64, low)]
    return {x: first[x] for x in kept}, len(kept) == len(first)


def likeness(a, b):
    (a, whole_a), (b, whole_b) = a, b
    if not a and not b:
        return 1.0
    bound = min(2**32 if whole_a else max(a), 2**32 if whole_b else max(b))
    a, b = ({x for x in s if x <= bound} for s in (a, b))
    return len(a & b) / len(a | b)


def check(got, rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, of_text(r[1])))
    got = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = sketch(t), sketch(edited), sketch(after)
        text = lambda s: " ".join(f"{x:08x}@{p:x}" for x, p in s[0].items())
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), likeness(a, b), likeness(a, c)))
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r) for r in got] == want


def test_matches_brute_force_on_odd_rows(odd, odd_rows):
    for stretches in (1, 7):
        check(fp.fingerprint_table(odd, stretches=stretches).collect(), odd_rows)


def test_single_row_and_no_rows(make, none):
    check(fp.fingerprint_table(make([(4, "one two three four five six")])).collect(), [(4, "one two three four five six")])
    assert fp.fingerprint_table(none).count() == 0


def test_offsets_of_a_shared_passage(spark):
    from pyspark.sql import functions as F

    passage = " ".join(f"w{i * i}" for i in range(40))
    df = spark.createDataFrame([("x y z " + passage, passage + " end")], "a string, b string")
    best = df.select(fp.offsets(fp.anchors(F.col("a")), fp.anchors(F.col("b"))).alias("o")).first().o
    assert max(best, key=lambda x: x.shared).shift == -3
