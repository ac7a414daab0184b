import random
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrel.llm import shared, simhash
from quadrel.llm.components import components


def plain_fingerprint(t, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    if not w:
        return 0
    parts = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_rows):
    for _, t in odd_rows:
        for k in (1, 2, 3, 5):
            if t is None or len(t) < 20_000:
                assert simhash.fingerprint(t, k) == plain_fingerprint(t, k)


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, step=997, dtype=np.uint32)
    low, high, errors = simhash._golay()
    flips = errors[low[words & 0xFFF] ^ high[words >> 12]]
    assert np.bitwise_count(flips).max() <= 3
    fixed = words ^ flips
    assert not (low[fixed & 0xFFF] ^ high[fixed >> 12]).any()


def test_prints_within_two_bits_share_a_key():
    r = random.Random(3)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
        _, ka = simhash.keys_of(np.array([a], np.uint64))
        _, kb = simhash.keys_of(np.array([b], np.uint64))
        assert set(ka) & set(kb)


def parts(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(ids)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bucket", [4096, 2])
def test_links_of_planted_prints(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = random.Random(bucket)
    prints = set()
    for _ in range(60):
        p = r.getrandbits(64)
        for _ in range(r.randint(1, 8)):
            prints.add(p)
            p ^= 1 << r.randrange(64) if r.random() < 0.7 else (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
    center = r.getrandbits(64)
    prints |= {center ^ (1 << b) for b in range(64)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    close = lambda a, b, n: ((a ^ b) & (1 << 64) - 1).bit_count() <= n
    want = parts(signed, lambda a, b: close(a, b, 2))
    got = {x.node: x.root for x in components(simhash.links(df)).collect()}
    assert all(got.get(p, p) == want[p] for p in signed)


def test_near_classes_on_odd_rows(odd, odd_rows, none):
    prints = {(i, t): plain_fingerprint(t) if t is None or len(t) < 20_000 else simhash.fingerprint(t) for i, t in odd_rows}
    distinct = set(prints.values())
    root = parts(distinct, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), p in prints.items():
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    got = simhash.near_classes(odd).collect()
    assert len(got) == len(odd_rows)
    for x in got:
        assert x.component == least[root[x.print & (1 << 64) - 1]]
    assert simhash.near_classes(none).count() == 0


def test_deduplicate_by_similarity(make, none, odd_rows):
    r = random.Random(9)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    a, b = words(400), words(300)
    near = a[:200] + ["changed"] + a[201:]
    rows = [(5, " ".join(a)), (3, " ".join(near)), (9, " ".join(a[:150] + b)), (1, " ".join(b)), (7, None), (8, ""), (None, " ".join(words(50)))]
    got = simhash.deduplicate(make(rows))
    assert sorted(str(x.doc_id) for x in got.collect()) == sorted(["3", "9", "1", "7", "None"])
    assert got.columns == make(rows).columns
    assert simhash.deduplicate(none).count() == 0


def test_deduplicate_keeps_one_row_where_ids_are_null_or_repeat(make):
    r = random.Random(10)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    a, b, c = words(200), words(200), words(50)
    rows = [(None, " ".join(a)), (None, " ".join([*a, "x"])), (2, " ".join(b)), (2, " ".join([*b, "y"])), (3, " ".join([*b, "z"])), (None, " ".join(c)), (9, " ".join([*c, "v"]))]
    assert sorted(str(x.doc_id) for x in simhash.deduplicate(make(rows)).collect()) == ["2", "9", "None"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 150), (None, 5), (7, None)]
    got = {x.node: x.root for x in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 150: 150, 200: 150}


def brute_components(texts):
    sets = {i: simhash.shingle_set(t or "") for i, t in texts}
    return parts(sets, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))


def edited_copies(r, words):
    """Copies that keep a Jaccard similarity of about 0.8: added to, cut, and with a block replaced."""
    n, new = len(words), [f"n{r.randrange(10**9)}" for _ in range(len(words))]
    at = r.randrange(n * 4 // 5)
    return [words + new[: n * 23 // 100], new[: n * 20 // 100] + words, words[: n * 81 // 100], words[:at] + new[: n // 11] + words[at + n // 11 :]]


@pytest.mark.parametrize("bucket, crowded", [(4096, 16), (4, 2)])
def test_similar_classes_find_all_pairs_of_crowded_families(make, bucket, crowded, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    r = random.Random(bucket)
    texts = []
    for _ in range(4):  # a template of which texts keep about three quarters, and near copies of these
        template = [f"w{r.randrange(10**6)}" for _ in range(120)]
        for _ in range(25):
            own = list(template)
            for at in r.sample(range(0, 120, 6), r.randint(1, 5)):
                own[at] = f"o{r.randrange(10**6)}"
            texts.append(" ".join(own))
            if r.random() < 0.4:
                texts.append(" ".join(own + [f"o{r.randrange(10**6)}" for _ in range(r.randint(1, 30))]))
    rows = list(enumerate(texts))
    want = brute_components(rows)
    got = {x.ident: x.component for x in simhash.similar_classes(make(rows)).collect()}
    assert len(set(want.values())) > 8 and got == want


def test_similar_classes_find_copies_edited_to_the_limit(make, odd_rows):
    r = random.Random(21)
    rows = []
    for n in (6, 9, 30, 100, 400, 900) * 8:
        words = [f"w{r.randrange(10**6)}" for _ in range(n)]
        rows += [(len(rows) + k, " ".join(w)) for k, w in enumerate([words, *edited_copies(r, words)])]
    rows += [(len(rows) + k, t) for k, (_, t) in enumerate(odd_rows)]
    want = brute_components(rows)
    got = {x.ident: x.component for x in simhash.similar_classes(make(rows)).collect()}
    assert got == want


def test_what_orders_and_what_comes_first_leaves_no_similar_pair_out(make, monkeypatch):
    """The sampled order of shingles decides cost alone, and pairs that fingerprints miss or bring together wrongly change no class."""
    r = random.Random(43)
    rows = []
    template = [f"t{r.randrange(10**6)}" for _ in range(60)]
    for n in (8, 40, 150) * 4:
        words = template[: r.randrange(60)] + [f"w{r.randrange(10**6)}" for _ in range(n)]
        rows += [(len(rows) + k, " ".join(w)) for k, w in enumerate([words, *edited_copies(r, words)])]
    want = brute_components(rows)
    for name, value in {"ORDERING": 8, "SAMPLED": 4, "OFTEN": 1, "FREQUENT": 40}.items():
        monkeypatch.setattr(simhash, name, value)
    wrong = lambda prints: prints.select(F.col("row").alias("one"), F.lead("row").over(Window.orderBy("row")).alias("two")).where("two IS NOT NULL")
    monkeypatch.setattr(simhash, "golay_pairs", wrong)
    got = {x.ident: x.component for x in simhash.similar_classes(make(rows)).collect()}
    assert got == want and 12 <= len(set(want.values())) < len(rows)


def family(n, shared, own, seed=3):
    """Pages of one template: ``shared`` words that all have, in one block, and ``own`` words of each page's own."""
    r = random.Random(seed)
    template = " ".join(f"t{r.randrange(10**6)}" for _ in range(shared))
    return [template + " " + " ".join(f"w{i}x{k}" for k in range(own)) for i in range(n)]


def test_rows_of_a_template_family_grow_in_proportion(spark):
    """Pages of one template at a similarity of 0.74 share the first of their common shingles too far behind to be similar."""
    made = {}
    for n in (400, 4000):
        texts = family(n, 104, 18)
        sets = [simhash.shingle_hashes(t) for t in texts]
        assert 0.7 < len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1])) < 0.78
        hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts > 2
        rows = [
            (int(t), i, place, len(s), simhash.parity_of(s), i)
            for i, s in enumerate(sets)
            for place, t in enumerate(simhash.front_of(s, hashes[often], counts[often], 0.8).view(np.int64))
        ]
        members = spark.createDataFrame(rows, "token long, row long, place int, size int, parity binary, root long")
        made[n] = simhash.bucket_runs(members, 0.8).count()
        assert simhash.similar_pairs(members, 0.8).count() == 0
    assert made[4000] <= 10 * max(made[400], 40)


def test_early_members_in_chunks_give_every_pair(make, monkeypatch):
    """Buckets of many chunks, early members and others of several sizes, against all pairs."""
    monkeypatch.setattr(simhash, "BUCKET", 8)
    monkeypatch.setattr(simhash, "CROWDED", 10_000)
    r = random.Random(12)
    base = [f"b{k}" for k in range(60)]
    texts = [" ".join(base[: r.randint(44, 60)] + [f"u{i}k{k}" for k in range(r.randint(4, 10))]) for i in range(90)]
    sets = [simhash.shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {x.ident: x.component for x in simhash.similar_classes(make(list(enumerate(texts)))).collect()}
    assert got == {i: find(i) for i in range(len(texts))} and len(set(got.values())) > 1


def test_near_dedup_takes_pairs_of_fingerprints_first(make, spark, monkeypatch):
    """Rows joined through Golay keys are those that fingerprints link, and similar texts are looked for among them."""
    r = random.Random(31)
    base = [f"w{r.randrange(10**6)}" for _ in range(600)]
    texts = [" ".join(base), " ".join(base).upper(), " ".join([*base, "end"]), " ".join(base[1:]), " ".join(base[:300]), "", None]
    prints = [simhash.fingerprint(t) for t in texts]
    rows = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)], "row long, print long")
    want = parts(dict(enumerate(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    roots = {x.node: x.root for x in components(simhash.golay_pairs(rows).toDF("a", "b")).collect()}
    assert {i: roots.get(i, i) for i in range(len(texts))} == want and len(set(want.values())) < len(texts)
    made, golay = [], simhash.golay_pairs
    monkeypatch.setattr(simhash, "golay_pairs", lambda prints: made.append(golay(prints).count()) or golay(prints))
    got = {x.ident: x.component for x in simhash.similar_classes(make(list(enumerate(texts)))).collect()}
    assert got == brute_components(list(enumerate(texts))) and made[0] >= 2


def test_rows_of_shared_tokens_come_once():
    """Rows that repeat are no others, wherever a batch ends, and need no exchange of their own to go."""
    r = random.Random(17)
    rows = sorted((r.randrange(40), r.randrange(6), 0) for _ in range(150))
    rows = [(t, w, (t + w) % 5) for t, w, _ in rows]
    holders = {}
    for t, w, _ in rows:
        holders.setdefault(t, set()).add(w)
    want = sorted({x for x in rows if len(holders[x[0]]) > 1})
    assert len(want) < len(set(rows)) < len(rows)
    for size in (1, 2, 7, 200):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*p, strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["token", "row", "place"]) for p in parts]
        got = [x for b in simhash._shared(batches) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert got == want


def test_shuffle_files_end_with_the_write_that_needed_them(spark):
    """What a written table was shuffled through doesn't wait for the driver's garbage to be collected."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    files = lambda: {p.name for f in folders for p in Path(f.getPath()).rglob("shuffle_*")}
    before, was = files(), spark.conf.get(shared.CLEANUP)
    table = shared.written(spark.range(20_000).repartition(5, "id").groupBy("id").count(), "shuffled")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and table.count() == 20_000
    assert spark.conf.get(shared.CLEANUP) == was
