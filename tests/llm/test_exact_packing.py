import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quadrel.llm import exact_packing

BYTE = str(P.path("byte_bpe_50k.json"))


def test_encoder_equals_the_tokenizer_on_every_character():
    reference, own = Tokenizer.from_file(BYTE), exact_packing.Encoder(BYTE)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 7 == 0)]
    texts = [f"a{chr(c)}b1{chr(c)}2 {chr(c)}!{chr(c)}? {chr(c)} {chr(c)}{chr(c)}x" for c in points]
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        for t, e in zip(part, reference.encode_batch_fast(part, add_special_tokens=False)):
            assert own.ids(t).tolist() == e.ids, t


def test_encoder_equals_the_tokenizer_on_odd_texts(odd_rows):
    reference, own = Tokenizer.from_file(BYTE), exact_packing.Encoder(BYTE)
    texts = [t or "" for _, t in odd_rows] + ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", " " * 1_000_000 + "x", "\n" * 300_000, "a" * 50_000]
    for t in texts:
        assert own.ids(t).tolist() == reference.encode(t, add_special_tokens=False).ids


def fills(histogram, made):
    """Tokens in each sequence of a plan; each piece is dealt once."""
    fill = np.zeros(made.sequences, np.int64)
    rows, _ = made.table()
    for x in range(1, len(histogram)):
        slots = rows[rows[:, 0] == x]
        ends = [*slots[1:, 1], histogram[x]]
        assert [0, *ends][: len(slots)] == slots[:, 1].tolist() or histogram[x] == 0
        for (_, first, k, sequence, at), end in zip(slots.tolist(), ends):
            times = (end - first) // k
            assert times * k == end - first
            fill[sequence : sequence + times] += k * x
    return fill


@pytest.mark.parametrize("window", [16, 64, 2048])
def test_plan_deals_every_piece_once_and_never_overfills(window):
    r = np.random.default_rng(window)
    for _ in range(60 if window < 100 else 4):
        histogram = np.zeros(window, np.int64)
        for x in r.integers(1, window, r.integers(0, 400)):
            histogram[x] += r.integers(1, 50)
        made = exact_packing.plan(histogram)
        fill = fills(histogram, made)
        assert fill.sum() == (histogram * np.arange(window)).sum() and fill.max(initial=0) <= window
        # Best fit leaves no two sequences half full, so this many at most.
        assert made.sequences <= 2 * fill.sum() // window + 1


def test_complements_are_found_if_there_are_any():
    r = random.Random(3)
    for _ in range(300):
        window = r.randint(4, 40)
        histogram = np.array([0] + [r.choice((0, 0, 1, 2, 3)) for _ in range(window - 1)])
        sums = exact_packing.Sums(histogram)
        for _ in range(3):  # lengths that run out
            x = r.randrange(window)
            sums.take(x, int(r.choice((0, sums.left[x]))))
        have = {a: int(n) for a, n in enumerate(sums.left) if n}
        used = np.zeros(window, np.int64)
        for a in have:
            used[a] = r.randint(0, have[a])
        have = {a: n - int(used[a]) for a, n in have.items()}
        ones = [a for a, n in have.items() for _ in range(min(n, 3))]
        gap = r.randint(1, window - 1)
        sets = {(a,) for a in ones} | {tuple(sorted((ones[i], ones[j]))) for i in range(len(ones)) for j in range(i)}
        sets |= {tuple(sorted((ones[i], ones[j], ones[k]))) for i in range(len(ones)) for j in range(i) for k in range(j)}
        exact = [s for s in sets if sum(s) == gap]
        found = sums.complement(gap, used)
        assert (found is None) == (not exact)
        if found is not None:
            assert tuple(sorted(found)) in exact and len(found) == min(map(len, exact))


def test_histograms_of_small_pieces_fill_their_windows():
    r = np.random.default_rng(1)
    histogram = np.bincount(np.minimum(2047, r.lognormal(5.5, 1.2, 20_000)).astype(int), minlength=2048)
    histogram[0] = 0
    made = exact_packing.plan(histogram)
    total = int((histogram * np.arange(2048)).sum())
    assert made.sequences <= -(-total // 2048) * 1.01
    assert len(made.slots) < 20_000 and len(exact_packing.plan(histogram * 1000).slots) < 20_000


def check(rows, got, window):
    reference = Tokenizer.from_file(BYTE)
    want = [[*reference.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows]
    assert sum(r.length for r in got) == sum(map(len, want))
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for (i, _), ids in zip(rows, want):
        if sum(j == i for j, _ in rows) > 1:
            continue
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // window)))
        at = 0
        for k, r in enumerate(pieces):
            assert r.start == at and r.length <= window and (r.length == window or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            if "ids" in r:
                assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), -(-sum(map(len, want)) // window)


@pytest.mark.parametrize("window", [2048, 64])
def test_packing(odd, odd_rows, window):
    check(odd_rows, exact_packing.pack(odd, BYTE, window=window).collect(), window)


def test_packing_of_many_and_of_none(make, none):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(("the", "tion", "x1", "hello")) for _ in range(r.randrange(0, 100)))) for i in range(600)]
    used, least = check(rows, exact_packing.pack(make(rows), BYTE, window=256, with_ids=True).collect(), 256)
    assert used <= least + 2
    # The window itself, one less and one more, once and twice.
    edge = [(1, " a" * 255), (2, " a" * 256), (3, " a" * 254), (4, " a" * 511), (5, " a" * 512)]
    assert check(edge, exact_packing.pack(make(edge), BYTE, window=256).collect(), 256) == (8, 8)
    assert exact_packing.pack(none, BYTE).count() == 0
