"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

*Kernel.*  Two words, each with a mark at its start and its end, are as alike as the
three-letter subsequences that they share, gaps allowed, each weighted by ``DECAY`` to the
power of the stretch that it spans; the kernel is normalised.  A letter put into an insult,
or a longer gap, thus weakens a match but doesn't break it, and a word with a known stem and
a new ending stays close to others of the stem.  Latin letters have codes of their own, all
others share them by code point, so that every script can be read, whatever the sample holds;
letters of one alphabet rarely fall together.

*Units.*  A text is taken word by word: white space parts words, letters stand for the
look-alike signs of obfuscated spelling, all else that is no letter is taken out, and runs
of single letters are joined, so that "l.o.s.e.r" and "l o s e r" are one word.  A word
longer than ``LONGEST`` is read in overlapping windows.  A sentence is as toxic as its worst
word, its witness; a text is judged by the ``WORST`` highest values among its distinct words.

*Training on sentences.*  Labels are of documents, so sentences are labelled by multiple
instances.  All sentences of clean documents are clean.  A sentence of a toxic document is
first taken as toxic if it holds a word that toxic documents, or one of whose stems, they
have more often than clean ones beyond what chance allows among so many words (a log-likelihood
ratio); the word for which the evidence is strongest is its witness.  Toxic documents without
such a word are searched again by themselves; their other sentences have no label.  The
machine is trained on the sentences, each by its witness, toxic ones also with a letter put
in.  It then tells the witnesses of the clean sentences, ``ROUNDS`` times: those that come
within the margin join the working set, and all others have no loss.  Kernel values to landmarks from both kinds, whitened
by the landmarks' own kernel matrix, are the features of a linear machine with squared hinge
loss, solved by Newton steps.  Logistic regression on the labelled documents' worst words
gives the final score from 0 to 1.

As the features are linear in a word's subsequences, the trained machine is one table with
a weight for each subsequence, two megabytes, whatever the corpus; a word is scored by adding
up its subsequences' weights over its norm.  Workers remember words' scores.

Bounds on what is trained on, and on nothing else: ``SAMPLE`` labelled documents of each
class, those with the least hash of their id, as far as their texts have ``SAMPLE_BYTES``;
``LANDMARKS`` and the ``WORKING`` set of witnesses on the margin.  The machine is fitted in
one task from that sample.  All documents are scored, whole.

Defined cases: null or empty texts have no words and get the score of an empty text (low);
very long texts are read whole, a million characters of words at a time; rows that repeat
get the same score; words scored alike share a place among the worst; witnesses scored alike
are taken in the order of letters; null labels and labels without a document are left out; a
document with contradicting labels counts as toxic; a null id isn't held out; if there are no labels of one
class, every score is the share of toxic labels, at most just under ``THRESHOLD`` (zero
without labels); an empty table gives an empty result; the input's columns go through as one
struct, so that their names can't clash with ours.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from math import erfc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrel.llm.shared import text_of

DECAY = 0.7
LONGEST = 20
LANDMARKS = 400
#: Labelled documents of each class that are trained on, and the bytes that their texts may have.
SAMPLE = 1500
SAMPLE_BYTES = 24 << 20
#: Share of the words taken as evidence that may be there by chance, by the procedure of Benjamini and Hochberg.
FALSE_EVIDENCE = 0.01
#: Clean documents' share of a witness, at most, against toxic documents' share.
PURITY = 0.02
ROUNDS = 3
#: Witnesses of clean sentences, and of toxic ones, that the machine is trained on at once.
WORKING = 6000
LETTERS = 64
STEMS = (4, 5, 6)
THRESHOLD = 0.3
WORST = 3
CACHE = 600_000
#: Fixed value: letters of Western European spelling, which have codes of their own.
LATIN = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
#: Signs that stand for letters in obfuscated words.
LOOKALIKES = str.maketrans("0134578@$!|", "oieastbasil")
SENTENCE = re.compile(r"[.!?]+\s+|\n+")
_NO_LETTER = re.compile(r"[\W\d_]+")
_ODD = re.compile(r"[0134578@$!|]")
_SPACED = re.compile(r"(?:(?<=\s)|^)(?:[^\W\d_]\s+){3,}[^\W\d_](?=\s|$|[.,!?;:])")


def unit(chunk: str) -> str:
    """The letters of a stretch without white space, look-alikes read as letters if it has letters."""
    low = chunk.lower()
    if low.isalpha():
        return low
    bare = low.strip(".,;:!?\"'()[]")
    if _ODD.search(bare) and any(c.isalpha() for c in bare):
        bare = bare.translate(LOOKALIKES)
    return _NO_LETTER.sub("", bare)


def chunks(text: str) -> set[str]:
    """The distinct stretches of a text, runs of single letters also joined."""
    out = set(text.split())
    out.update("".join(m.split()) for m in _SPACED.findall(text))
    return out


def windows(word: str) -> list[str]:
    """The word, or windows that overlap by half if it is long."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


@lru_cache(LONGEST + 3)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of three letters of a word of ``n``, and their weights."""
    at = np.array(list(itertools.combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return at, (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float64)


def _norms(codes: np.ndarray) -> np.ndarray:
    """Square root of the kernel of each word, a row of ``codes``, with itself, by the recursion over prefixes."""
    n, size = codes.shape
    same = (codes[:, :, None] == codes[:, None, :]).astype(np.float64)
    # Two letters first: level[a][b] sums over pairs of prefixes of a and b letters.
    level = np.ones((size + 1, size + 1, n))
    for _ in range(2):
        new = np.zeros((size + 1, size + 1, n))
        for a in range(1, size + 1):
            run = np.zeros(n)
            for b in range(1, size + 1):
                run = DECAY * run + DECAY**2 * same[:, a - 1, b - 1] * level[a - 1, b - 1]
                new[a, b] = DECAY * new[a - 1, b] + run
        level = new
    return np.sqrt(np.einsum("nab,abn->n", same, level[:-1, :-1]) * DECAY**2)


class _Codes(dict):
    """Code of each letter: its place among the Latin letters, or its code point modulo what there is room for; the marks of start and end come first."""

    def __missing__(self, letter: str) -> int:
        at = LATIN.find(letter)
        code = 3 + (at if at >= 0 else ord(letter) % (LETTERS - 3))
        self[letter] = code
        return code


_CODES = _Codes({"^": 1, "$": 2})


def codes_of(words: list[str]) -> np.ndarray:
    """Codes of words of one length, a row each, with the marks."""
    get = _CODES.__getitem__
    return np.array([[1, *map(get, w), 2] for w in words], np.int64)


def _places(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Place in a table of all subsequences of the letters that stand ``at``."""
    return (codes[:, at[:, 0]] * LETTERS + codes[:, at[:, 1]]) * LETTERS + codes[:, at[:, 2]]


@dataclass
class Machine:
    """The weight of each subsequence, the bias, and the logistic regression (its last entry the shift)."""

    weights: np.ndarray
    bias: float
    curve: np.ndarray
    constant: float | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word of up to ``LONGEST`` letters."""
        out = np.full(len(words), self.bias)
        for size, at in _by_length(words):
            places, weights = _triples(size)
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                codes = codes_of([words[i] for i in part])
                out[part] += (self.weights[_places(codes, places)] @ weights) / np.maximum(_norms(codes), 1e-12)
        return out

    def unit_scores(self, words: list[str]) -> np.ndarray:
        """As :meth:`word_scores`, long words by their worst window."""
        parts = [windows(w) for w in words]
        flat = self.word_scores([p for ps in parts for p in ps])
        first = np.cumsum([0, *map(len, parts)])[:-1]
        return np.maximum.reduceat(flat, first) if len(words) else flat

    def worst(self, values) -> list[float]:
        """The highest of a text's word values; the bias, the value of no word, fills up."""
        return (heapq.nlargest(WORST, values) + [self.bias] * WORST)[:WORST]

    def probability(self, worst: np.ndarray) -> np.ndarray:
        """The score of texts by their worst words, a row each."""
        if self.constant is not None:
            return np.full(len(worst), self.constant)
        return 1 / (1 + np.exp(-np.clip(worst @ self.curve[:-1] + self.curve[-1], -50, 50)))


def _by_length(words: list[str]):
    """Number of letters with the marks, and places of the words that have it; words without letters are left out."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(lengths):
        if size:
            yield int(size) + 2, np.nonzero(lengths == size)[0]


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of words against landmarks."""
    rows, columns, values = [], [], []
    for size, at in _by_length(landmarks):
        places, weights = _triples(size)
        codes = codes_of([landmarks[i] for i in at])
        index = _places(codes, places)
        rows.append(np.broadcast_to(at[:, None], index.shape).ravel())
        columns.append(index.ravel())
        values.append((weights[None, :] / _norms(codes)[:, None]).ravel())
    used, place = np.unique(np.concatenate(columns), return_inverse=True)
    narrow = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(narrow, (place + 1, np.concatenate(rows)), np.concatenate(values).astype(np.float32))
    column = np.zeros(LETTERS**3, np.int32)
    column[used] = np.arange(1, len(used) + 1)
    out = np.zeros((len(words), len(landmarks)))
    for size, at in _by_length(words):
        places, weights = _triples(size)
        for lo in range(0, len(at), 256):
            part = at[lo : lo + 256]
            codes = codes_of([words[i] for i in part])
            # One row for each word, of its subsequences that some landmark has.
            dense = np.zeros((len(part), len(narrow)), np.float32)
            np.add.at(dense, (np.arange(len(part))[:, None], column[_places(codes, places)]), weights.astype(np.float32)[None, :])
            out[part] = (dense @ narrow) / np.maximum(_norms(codes), 1e-12)[:, None]
    return out


def subsequence_weights(landmarks: list[str], alpha: np.ndarray) -> np.ndarray:
    """The table whose sum over a word's subsequences is the kernel expansion ``alpha`` over the landmarks."""
    out = np.zeros(LETTERS**3)
    for size, at in _by_length(landmarks):
        places, weights = _triples(size)
        codes = codes_of([landmarks[i] for i in at])
        for row, index, norm in zip(at, _places(codes, places), _norms(codes), strict=True):
            np.add.at(out, index, alpha[row] * weights / norm)
    return out


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 60) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine, by Newton steps with halving on the rows within the margin."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9

    def loss(w: np.ndarray) -> float:
        return float(ridge @ w**2 + weight @ np.maximum(0, 1 - y * (x @ w)) ** 2)

    now = loss(w)
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa, ya, ca = x[active], y[active], weight[active]
        scaled = xa * ca[:, None]
        step = np.linalg.solve(scaled.T @ xa + np.diag(ridge), scaled.T @ ya) - w
        size = 1.0
        while (then := loss(w + size * step)) > now and size > 1e-4:
            size /= 2
        if then >= now * (1 - 1e-7):
            break
        w, now = w + size * step, then
    return w


def log_likelihood_ratio(toxic: int, clean: int, toxics: int, cleans: int) -> float:
    """Evidence that documents with something are toxic more often than the others; negative if less often."""

    def part(k: float, n: float, p: float) -> float:
        out = 0.0
        if k:
            out += k * np.log(p)
        if n - k:
            out += (n - k) * np.log(1 - p)
        return out

    share = (toxic + clean) / (toxics + cleans)
    value = 2 * (part(toxic, toxics, toxic / toxics) + part(clean, cleans, clean / cleans) - part(toxic, toxics, share) - part(clean, cleans, share))
    return value if toxic * cleans > clean * toxics else -value


def without_copies(docs: list[set[str]]) -> list[set[str]]:
    """One of each group of documents with much the same long words, by bands of two min-hashes."""
    seen: set[tuple[int, int, int]] = set()
    out = []
    for words in docs:
        if not words:
            continue
        telling = {w for w in words if len(w) > 6} or words
        codes = np.fromiter((zlib.crc32(w.encode()) for w in telling), np.uint64, len(telling))
        least = [int(((codes * np.uint64(2 * k + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).min()) for k in range(1, 13)]
        bands = {(k, least[k], least[k + 1]) for k in range(0, 12, 2)}
        if not bands & seen:
            out.append(words)
        seen |= bands
    return out


def _marks(word: str) -> list[str]:
    """The word and its stems."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def evidence(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """For words of toxic documents, how far beyond chance toxic documents have them, or a stem of them, where clean ones hardly have."""
    if not toxic or not clean:
        return {}
    often = Counter(x for words in toxic for x in {m for w in words for m in _marks(w)})
    also = Counter(x for words in clean for x in {m for w in words for m in _marks(w)} if x in often)
    strong = {x: log_likelihood_ratio(t, also[x], len(toxic), len(clean)) for x, t in often.items() if also[x] * len(toxic) < PURITY * t * len(clean)}
    ranked = sorted(strong.values(), reverse=True)
    # The chance of a ratio as high, against what its rank among all words allows.
    passed = [r for i, r in enumerate(ranked, 1) if r > 0 and erfc((r / 2) ** 0.5) / 2 <= FALSE_EVIDENCE * i / len(often)]
    return {x: strong[x] for x in strong if passed and strong[x] >= passed[-1]}


def insults_of(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """Words of toxic documents that evidence speaks for, and how strongly; documents that it doesn't explain are searched again by themselves.  Copies count once."""
    toxic, clean = without_copies(toxic), without_copies(clean)
    found: dict[str, float] = {}
    left = toxic
    for _ in range(ROUNDS):
        strong = evidence(left, clean)
        new = {w: e for words in left for w in words if (e := max(strong.get(x, 0.0) for x in _marks(w)))}
        if not new:
            break
        found |= new
        left = [words for words in left if not words & found.keys()]
    if not found and toxic and clean:  # few labels: the words that most toxic documents have and no clean one
        counts = Counter(w for words in toxic for w in words)
        for words in clean:
            for w in words & counts.keys():
                del counts[w]
        most = max(counts.values(), default=0)
        found = {w: 1.0 for w, n in counts.items() if n == most}
    return found


def _with_letter(word: str, number: int) -> str:
    """The word with a letter put in, place and letter by number."""
    at = 1 + number % max(1, len(word) - 1)
    return word[:at] + chr(97 + (number * 7 + len(word)) % 26) + word[at:]


def _spread(items: list[str], n: int) -> list[str]:
    """``n`` of the items at equal distances."""
    return [items[i * len(items) // n] for i in range(n)] if len(items) > n else items


class _Sentences:
    """The sentences of some documents as sets of word numbers, and each sentence's witness by given values of the words."""

    def __init__(self, documents: list[list[set[str]]]):
        parts = [sorted({p for w in words for p in windows(w)}) for sentences in documents for words in sentences]
        parts = [p for p in parts if p]
        self.words = sorted(set(itertools.chain.from_iterable(parts)))
        number = {w: i for i, w in enumerate(self.words)}
        self.flat = np.fromiter((number[w] for p in parts for w in p), np.int64)
        self.first = np.cumsum([0, *map(len, parts)])[:-1]

    def witnesses(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each sentence's best word, the first on a tie, and its value."""
        if not len(self.first):
            return np.zeros(0, np.int64), np.zeros(0)
        own = values[self.flat]
        best = np.maximum.reduceat(own, self.first)
        sizes = np.diff(np.append(self.first, len(self.flat)))
        at = np.where(own == np.repeat(best, sizes), np.arange(len(own)), len(own))
        return self.flat[np.minimum.reduceat(at, self.first)], best


def train(texts: list[str], labels: list[int]) -> Machine:
    """Fit a machine on whole labelled texts."""
    share = sum(labels) / len(labels) if labels else 0.0
    constant = Machine(np.zeros(LETTERS**3), 0.0, np.zeros(WORST + 1), min(share, THRESHOLD * (1 - 1e-9)))
    if share in (0.0, 1.0):
        return constant
    known: dict[str, str] = {}

    def units(text: str) -> set[str]:
        found = (known.get(c) or known.setdefault(c, unit(c)) for c in chunks(text))
        return {u for u in found if len(u) > 2}

    bags = [[units(s) for s in SENTENCE.split(t)] for t in texts]
    flat = [set().union(*sentences) for sentences in bags]
    toxic, clean = (_Sentences([b for b, y in zip(bags, labels, strict=True) if bool(y) == kind]) for kind in (True, False))
    telling = insults_of(*([w for w, y in zip(flat, labels, strict=True) if bool(y) == kind] for kind in (True, False)))
    if not telling or not clean.words:
        return constant
    known_innocent = set(clean.words)
    guilty = {p: e for w, e in telling.items() for p in windows(w)}
    machine = Machine(np.zeros(LETTERS**3), 0.0, np.zeros(WORST + 1))

    witness, value = toxic.witnesses(np.array([guilty.get(w, 0.0) for w in toxic.words]))
    weight = np.bincount(witness, value > 0, len(toxic.words))
    negative = Counter(dict.fromkeys(_spread(clean.words, WORKING // 2), 1.0))
    tally = np.bincount(clean.flat, minlength=len(clean.words))
    for i in np.argsort(-tally, kind="stable")[: WORKING // 6]:
        negative[clean.words[i]] = float(tally[i])
    near: list[str] = []  # clean witnesses that come closest
    for turn in range(ROUNDS):
        order = [i for i in np.argsort(-weight, kind="stable")[:WORKING].tolist() if weight[i] > 0]
        positive = {toxic.words[i]: float(weight[i]) for i in order}
        for i, w in enumerate(list(positive)):
            for altered in (_with_letter(w, i), _with_letter(w, 3 * i + 1)):
                if len(altered) <= LONGEST and altered not in known_innocent:
                    positive.setdefault(altered, positive[w] / 4)
        insults = sorted(toxic.words[i] for i in order)
        landmarks = sorted({*_spread(insults, LANDMARKS // 4), *_spread(clean.words, LANDMARKS // 4), *_spread(near, LANDMARKS // 2)})
        values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
        keep = values > 1e-3  # below, single precision
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        words = [*positive, *(w for w in sorted(negative) if w not in positive)]
        y = np.where(np.arange(len(words)) < len(positive), 1.0, -1.0)
        cost = np.array([positive.get(w) or negative[w] for w in words], float)
        cost /= cost[y > 0].sum()
        w = squared_hinge(kernel(words, landmarks) @ whiten, y, cost)
        machine.weights = subsequence_weights(landmarks, whiten @ w[:-1])
        machine.bias = float(w[-1])
        if turn < ROUNDS - 1:
            witness, value = clean.witnesses(machine.word_scores(clean.words))
            inside = np.argsort(-value, kind="stable")
            inside = inside[value[inside] > -1][: 8 * WORKING]
            close = Counter(witness[inside].tolist())
            best = sorted(close, key=lambda i: (-close[i], i))[:WORKING]
            for i in best:
                negative[clean.words[i]] = float(max(close[i], negative.get(clean.words[i], 0)))
            near = sorted(clean.words[i] for i in dict.fromkeys(witness[inside].tolist()) if i in close)[:WORKING]
    every = sorted(set().union(*flat))
    scored = dict(zip(every, machine.unit_scores(every).tolist(), strict=True))
    machine.curve = _logistic(np.array([[*machine.worst(map(scored.__getitem__, w)), 1.0] for w in flat]), np.array(labels, float))
    return machine


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression, none but the shift (the last) below zero: a worse word never lowers the score.

    Platt's targets keep the coefficients finite where the classes are apart.
    """
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    used = np.ones(x.shape[1], bool)
    while True:
        part, curve = x[:, used], np.zeros(int(used.sum()))
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(part @ curve, -50, 50)))
            step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part + 1e-3 * np.eye(len(curve)), part.T @ (goal - p) - 1e-3 * curve)
            curve = curve + step / max(1.0, np.abs(step).max() / 3)
            if np.abs(step).max() < 1e-8:
                break
        out = np.zeros(x.shape[1])
        out[used] = curve
        if (out[:-1] >= 0).all():
            return out
        used[int(np.argmin(out[:-1]))] = False


def score_text(machine: Machine, text: str) -> float:
    """The score of one text."""
    words = sorted({unit(c) for c in chunks(text)})
    return float(machine.probability(np.array([machine.worst(machine.unit_scores(words).tolist())]))[0])


def held_out(ident: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Machine:
    """Train on at most ``sample`` labelled documents of each class that aren't held out, of at most ``sample_bytes`` together for each class.

    A text longer than an eighth of ``sample_bytes`` is left out, so that no text can keep the others of its class out.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col(ident).isNotNull() & ~held_out(F.col(ident)))
    known = known.groupBy(F.col(ident).alias("ident")).agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("label"))
    some = [known.where(F.col("label") == label).orderBy(F.xxhash64("ident"), "ident").limit(sample) for label in (0, 1)]
    # At most ``sample`` ids of each class, by the limit.
    taken = documents.select(F.col(ident).alias("ident"), text_of(text).alias("text")).join(F.broadcast(some[0].unionByName(some[1])), "ident")
    taken = taken.groupBy("ident", "label").agg(F.min("text").alias("text")).where(F.octet_length("text") <= sample_bytes // 8)
    so_far = F.sum(F.octet_length("text").cast("long")).over(Window.partitionBy("label").orderBy(F.xxhash64("ident"), "ident"))
    bounded = taken.withColumn("so_far", so_far).where(F.col("so_far") <= sample_bytes).select("ident", "text", "label")

    def learn(batches):
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train([r[1] for r in rows], [r[2] for r in rows]))], pa.binary())], names=["machine"])

    learned = bounded.repartition(1).mapInArrow(learn, "machine binary").first()
    return pickle.loads(learned["machine"]) if learned else train([], [])


_known: dict[int, tuple[Machine, dict[str, float]]] = {}


def score(df: DataFrame, machine: Machine, text: str = "text", ident: str | None = "doc_id") -> DataFrame:
    """(ident, score) of each row; with ``ident`` None, all columns and ``score`` within (whole, score)."""
    shared = df.sparkSession.sparkContext.broadcast(machine)
    number = shared._jbroadcast.id()

    def run(batches):
        if number not in _known:
            _known.clear()
            _known[number] = (shared.value, {})
        own, cache = _known[number]
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            worst = np.full((len(texts), WORST), own.bias)
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 1_000_000):
                    size += len(texts[end])
                    end += 1
                cut = [chunks(t) for t in texts[at:end]]
                every = set().union(*cut)
                if len(cache) + len(every) > CACHE:
                    cache.clear()
                new = [x for x in every if x not in cache]
                if new:
                    units = [unit(x) for x in new]
                    distinct = list(dict.fromkeys(units))
                    found = dict(zip(distinct, own.unit_scores(distinct).tolist(), strict=True))
                    cache.update(zip(new, map(found.__getitem__, units), strict=True))
                for i, words in enumerate(cut, at):
                    worst[i] = own.worst(map(cache.__getitem__, words))
                at = end
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own.probability(worst))], names=[*b.schema.names[:-1], "score"])

    if ident is None:
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), text_of(f"`{text}`").alias("text"))
        kind = rows.schema["whole"].dataType.simpleString()
        return rows.mapInArrow(run, f"whole {kind}, score double")
    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident), text_of(text).alias("text")).mapInArrow(run, f"{ident} {kind}, score double")
