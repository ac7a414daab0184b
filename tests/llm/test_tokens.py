import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quadrel.llm import packing, token_counts, viterbi

WORD, BYTE, PIECE = (str(P.path(x)) for x in ("word_bpe_49k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))


def samples(n, seed=1):
    r = random.Random(seed)
    parts = ["'", "s", "re", "'ll", "É", "ß", "÷", "İ", "Σ", "<|endoftext|>", "漢", "🎉", "́", " ", "  ", "\n", "\t", "\x1c", " ", "1", "23", "²", "Ab", "...", "don't", "▁", "abcd" * 9, "the", "ing"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_word_cache_equals_the_tokenizer(odd_rows, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 60)
    texts = samples(800) + [t or "" for _, t in odd_rows]
    reference = Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)
    cache = packing.WordCache(WORD)
    for at in range(0, len(texts), 50):
        for ids, e in zip(cache.encode_all(texts[at : at + 50]), reference[at : at + 50]):
            assert np.frombuffer(ids, "<u2").tolist() == e.ids


def test_nnls():
    r = np.random.default_rng(0)
    for _ in range(20):
        a, x = r.random((12, 20)), np.maximum(0, r.normal(size=20))
        b = a @ x
        got = packing.nnls(a, b)
        assert (got >= 0).all() and np.abs(a @ got - b).max() < 1e-6


def test_plan_never_exceeds_the_histogram():
    r = random.Random(4)
    for _ in range(10):
        histogram = [0] + [r.randrange(0, 400) ** 2 for _ in range(15)]
        made = packing.plan(histogram, 16, 4)
        assert all(used <= have for used, have in zip(made.planned, histogram))
        filled = defaultdict(int)
        for size, slots in enumerate(made.slots):
            for lo, hi, first, _ in slots:
                for k in (0, hi - lo - 1):
                    filled[first + k] += 0
        assert made.sequences > 0


def check_packing(rows, got, window):
    reference = Tokenizer.from_file(WORD)
    want = [[*reference.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows]
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    assert sum(r.length for r in got) == sum(map(len, want))
    for (i, _), ids in zip(rows, want):
        if sum(j == i for j, _ in rows) > 1:
            continue
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0


@pytest.mark.parametrize(("window", "unit"), [(4096, 64), (256, 16)])
def test_packing(odd, odd_rows, window, unit):
    check_packing(odd_rows, packing.pack(odd, WORD, window=window, unit=unit).collect(), window)


def test_packing_of_many_and_of_none(make, none):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(("the", "tion", "x1", "hello")) for _ in range(r.randrange(0, 300)))) for i in range(600)]
    check_packing(rows, packing.pack(make(rows), WORD, window=256, unit=16).collect(), 256)
    assert packing.pack(none, WORD).count() == 0


def test_token_spans_equal_the_tokenizers_offsets():
    reference = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    reference.encode_special_tokens = True
    for t in samples(300, 2):
        a, b = token_counts.token_spans(t, BYTE, P.PATTERN)
        offsets = reference.encode(t, add_special_tokens=False).offsets
        assert len(a) == len(offsets)
        assert (a < b).all() if len(a) else not t
        # Where a token is whole characters, its text is the span's.
        assert [x for x, (_, e) in zip(a.tolist(), offsets)][:1] == [0][: len(a)]


@pytest.mark.parametrize("rule", ["most", "first", "share"])
def test_allocation_matches_brute_force(rule):
    r = random.Random(7)
    for _ in range(200):
        cuts = np.array(sorted({0, *(r.randrange(60) for _ in range(8))}))
        starts, ends = cuts[:-1], cuts[1:]
        marks = sorted(r.sample(range(64), 6))
        first, end = np.array(marks[::2]), np.array(marks[1::2])
        got = token_counts.allocate(starts, ends, first, end, rule)
        want = np.zeros(4)
        for a, b in zip(starts, ends):
            held = [max(0, min(b, y) - max(a, x)) for x, y in zip(first, end)]
            out = (b - a) - sum(held)
            if rule == "share":
                want += np.array([*held, out]) / (b - a)
            elif rule == "first":
                want[next((k for k, (x, y) in enumerate(zip(first, end)) if x <= a < y), 3)] += 1
            else:
                want[held.index(max(held)) if max(held) and max(held) >= out else 3] += 1
        assert np.allclose(got, want)


def brute_spans(text):
    """Character spans of tokens, from the bytes of each token and of each character."""
    encoding, _ = token_counts._encoding(BYTE, P.PATTERN)
    owner = [k for k, c in enumerate(text) for _ in c.encode()]
    at, spans = 0, []
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        spans.append((owner[at], owner[at + size - 1] + 1))
        at += size
    return spans


def test_spans_and_sections_equal_brute_force(odd, odd_rows):
    for t in samples(200, 4) + [t or "" for _, t in odd_rows]:
        a, b = token_counts.token_spans(t, BYTE, P.PATTERN)
        assert list(zip(a.tolist(), b.tolist())) == brute_spans(t)
    want = Counter()
    for i, t in odd_rows:
        t = t or ""
        lines = t.splitlines(keepends=True) if set(t) & set("\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029") == set() else re.findall(r"[^\n]*\n|[^\n]+", t)
        lines = lines or [""]
        line_of = [k for k, line in enumerate(lines) for _ in line]
        spans = brute_spans(t)
        counts = Counter()
        for a, b in spans:
            held = Counter(line_of[a:b])
            counts[min(held, key=lambda k: (-held[k], k))] += 1
        start = 0
        for k, line in enumerate(lines):
            want[i, k, start, start + len(line), float(counts[k]), len(spans)] += 1
            start += len(line)
    got = Counter(tuple(r) for r in token_counts.section_counts(odd, BYTE, P.PATTERN).collect())
    assert got == want


def test_section_counts(odd, odd_rows, none, spark):
    reference = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    reference.encode_special_tokens = True
    got = defaultdict(list)
    for r in token_counts.section_counts(odd, BYTE, P.PATTERN).collect():
        got[r.doc_id].append(r)
    for i, t in odd_rows:
        if sum(j == i for j, _ in odd_rows) == 1:
            n = len(reference.encode(t or "", add_special_tokens=False).ids)
            assert sum(r.tokens for r in got[i]) == n == got[i][0].doc_tokens
            assert len([r for r in got[i] if r.section >= 0]) == max(1, (t or "").count("\n") + (not (t or "").endswith("\n")))
    assert token_counts.section_counts(none, BYTE, P.PATTERN).count() == 0
    fields = token_counts.field_counts(spark.createDataFrame([(1, "a title", None, "body text")], "k long, t string, u string, b string"), BYTE, P.PATTERN, ["t", "u", "b"], "k").collect()
    assert sum(r.tokens for r in fields) == fields[0].doc_tokens
    assert {r.section for r in fields if r.section >= 0} == {0, 1, 2}


def test_viterbi_equals_the_library(odd_rows, monkeypatch):
    monkeypatch.setattr(viterbi, "CACHE", 50)
    model, library = viterbi.Model(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for t in samples(1500, 3) + [t or "" for _, t in odd_rows]:
        ids = model.encode(t).tolist()
        assert ids == library.encode(t)
        assert model.decode(ids) == library.decode(ids)


def test_viterbi_streams_within_its_window():
    model = viterbi.Model(PIECE)
    text = viterbi.MARK + "abcdabcdthereinafter" * 400
    read = 0

    def stream():
        nonlocal read
        for c in text:
            read += 1
            yield c

    done, lag = 0, 0
    for piece in model.search(stream()):
        done += len(piece)
        if read < len(text):
            lag = max(lag, read - done)
    assert done == len(text) and lag <= 4 * model.longest


def test_viterbi_of_slices_and_of_unbroken_text(monkeypatch):
    model, library = viterbi.Model(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    r = random.Random(9)
    unbroken = "".join(r.choice(("the", "re", "in", "abc", "ation", "x")) for _ in range(12_000))
    texts = ["", " ", "  a  b ", "one two\nthree", unbroken, "a " + unbroken[:9_000] + " é漢" + unbroken[:5_000] + "\n\n end", "ab" * 30_000]
    for t in texts:
        want = library.encode(t)
        assert model.encode(t).tolist() == want
        for size in (1, 7, 5_000):
            if size > 1 or len(t) < 20_000:
                got = np.frombuffer(b"".join(model.stream(t[i : i + size] for i in range(0, len(t), size))), "<u4")
                assert got.tolist() == want, (t[:20], size)
    read = held = 0

    def slices():
        nonlocal read, held
        for i in range(0, len(unbroken), 1000):
            held = max(held, read - done)
            read += 1000
            yield unbroken[i : i + 1000]

    done = 0
    for ids in model.stream(slices()):
        done += len(model.decode(np.frombuffer(ids, "<u4").tolist()))
    assert held <= viterbi.UNBROKEN + 10_000 < len(unbroken)


def test_sentencepiece_frames(odd, odd_rows, none):
    got = viterbi.digests(odd, PIECE).collect()
    assert len(got) == len(odd_rows) and all(r.round_trip for r in got)
    back = viterbi.decode(viterbi.encode(odd, PIECE), PIECE).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in odd_rows)
    assert viterbi.digests(none, PIECE).count() == 0
