"""SentencePiece encoding and decoding by a streaming Viterbi search.

The model is a SentencePiece BPE: starting from characters, the adjacent pair whose join
is the best-scored piece is merged, leftmost first, until none is left.  That result is
the one path through the lattice of pieces on which every two neighbouring pieces are
*stable*: merging their join from its characters gives just these two.  The search
therefore walks the text once, left to right, and keeps for each position the best last
piece among those that are stable after the best last piece where they begin; pieces
scored alike are decided for the longer one.

Only the positions of one window, as long as the longest piece, can still be extended.
Whenever all of them trace back to one boundary, the ids before it are final: they are
handed on and the lattice before the boundary is dropped.  Scores decide which merges there
are; the search itself compares no sums of scores.

Borders that no piece crosses (before a space mark that follows another character, and
between characters that are neighbours in no piece) are places where all paths meet;
they are read off the vocabulary.  A text is read in slices; stretches between borders are
encoded alone, and their ids are remembered for when they come again.  A stretch without a
border goes through the window character by character as it is read.  What is held of a text
is thus a slice and a window, besides its ids.

Characters that no piece has become their UTF-8 bytes.  Decoding joins pieces and bytes,
reads space marks as spaces and drops the first.  A space mark in the text itself
decodes to a space, as in the original library.

Defined cases: null text is empty and gives no ids; very long texts, and very long stretches
without a space, are streamed; pieces scored alike are merged leftmost first; repeated rows are encoded each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import text_of

#: Fixed value: the character that stands for a space.
MARK = "▁"
#: Stretches whose ids a worker remembers at most, and the longest that is remembered.
CACHE = 1_000_000
CACHE_CHARS = 64
#: Characters of a text that are looked at together, and those without a border after which the search takes over.
SLICE = 1 << 16
UNBROKEN = 1 << 12

_models: dict[str, Model] = {}


class Model:
    """Pieces of a model file, and the search over them."""

    def __init__(self, path: str):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes = [b""] * read.get_piece_size()
        self.byte_ids = [0] * 256
        self.unknown = read.unk_id()
        for i in range(read.get_piece_size()):
            piece = read.id_to_piece(i)
            if read.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes[i] = bytes([int(piece[1:-1], 16)])
            elif not (read.is_control(i) or read.is_unknown(i) or read.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = read.get_score(i)
                self.bytes[i] = piece.replace(MARK, " ").encode("utf-8")
        self.is_byte = np.array([bool(read.is_byte(i)) for i in range(read.get_piece_size())])
        self.longest = max(map(len, self.ids), default=1)
        longer = [p for p in self.ids if len(p) > 1]
        self.inner = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        self.mark_begins = not any(MARK in p.lstrip(MARK) for p in longer)
        self.line_stands_alone = not any("\n" in pair for pair in self.inner)
        self.stable_pairs: dict[tuple[str, str], bool] = {}
        self.reached = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}  # pieces that merging their characters gives
        self.known: dict[str, bytes] = {}
        self.stretches = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.line_stands_alone else f"{MARK}*[^{MARK}]+|{MARK}+")

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging pairs, the definition; used on joins of two pieces only."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stable(self, left: str, right: str) -> bool:
        pair = (left, right)
        if pair not in self.stable_pairs:
            if len(self.stable_pairs) > CACHE:
                self.stable_pairs.clear()
            self.stable_pairs[pair] = self.merge(left + right) == [left, right]
        return self.stable_pairs[pair]

    def search(self, characters: Iterable[str]) -> Iterator[str]:
        """Pieces of a stream of characters, each handed on as soon as it is final."""
        held = ""  # characters from the last final boundary on
        last = [""]  # the last piece of the path to each place of held; of the first, the piece before it
        reached, known, longest, end = self.reached, self.stable_pairs.get, self.longest, 0
        for c in characters:
            held += c
            end += 1
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                piece = held[start:end]
                if piece in reached or start == end - 1:
                    left = last[start]
                    if not left or ((found := known((left, piece))) is None and self.stable(left, piece)) or found:
                        break  # the only stable one that ends here
            last.append(piece)
            if end >= 2 * longest and (final := self._converged(last, end)):
                yield from final
                cut = sum(map(len, final))
                held, last, end = held[cut:], [final[-1], *last[cut + 1 :]], end - cut
        yield from self._trace(last, len(held))

    def _trace(self, last: list[str], end: int) -> list[str]:
        """The path to a place, from the first place on."""
        out = []
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _converged(self, last: list[str], end: int) -> list[str]:
        """Pieces that the paths to all places from which a piece can still begin have in common."""
        paths = [self._trace(last, e) for e in range(end - self.longest + 1, end + 1)]
        common = []
        for pieces in zip(*paths, strict=False):
            if any(p != pieces[0] for p in pieces):
                break
            common.append(pieces[0])
        return common

    def ids_of(self, pieces: Iterable[str]) -> bytes:
        """Little-endian 32-bit ids; a character without a piece gives its bytes' ids."""
        out = []
        for p in pieces:
            if (i := self.ids.get(p)) is not None:
                out.append(i)
            else:
                out += [self.byte_ids[x] or self.unknown for x in p.encode("utf-8")]
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return np.frombuffer(b"".join(self.stream(text[i : i + SLICE] for i in range(0, len(text), SLICE))), "<u4")

    def stream(self, slices: Iterable[str]) -> Iterator[bytes]:
        """Ids of a text that comes in slices, handed on as they become final.

        What stands before the last border seen is final.  Where no border comes for
        ``UNBROKEN`` characters, the search runs over the slices themselves and commits
        through its window.
        """
        slices, rest, inner, known = iter(slices), MARK, self.inner, self.known

        def unbroken() -> Iterator[str]:
            """The characters up to the next border."""
            nonlocal rest
            last = ""
            while rest:
                for i, c in enumerate(rest):
                    if last and last + c not in inner:
                        rest = rest[i:]
                        return
                    last = c
                    yield c
                rest = next(slices, "").replace(" ", MARK)

        started = False
        while True:
            more = next(slices, "")
            if not more and not started:
                return
            started = True
            rest += more.replace(" ", MARK)
            stretches = self.stretches.findall(rest) if self.mark_begins else self.parts(rest)
            rest = stretches.pop() if more and stretches else ""
            for x in stretches:
                found = known.get(x)
                if found is None:
                    found = self._remember(x, b"".join([known.get(y) or self._remember(y, self.ids_of(self.search(y))) for y in self.parts(x)]))
                yield found
            if not more:
                return
            if len(rest) > UNBROKEN:
                *final, rest = self.parts(rest)
                yield from (known.get(y) or self._remember(y, self.ids_of(self.search(y))) for y in final)
            if len(rest) > UNBROKEN:
                pieces = self.search(unbroken())
                while some := list(islice(pieces, 1024)):
                    yield self.ids_of(some)

    def parts(self, stretch: str) -> list[str]:
        """Cut where two characters stand side by side that do so in no piece."""
        inner, cuts = self.inner, [0]
        cuts += [i for i in range(1, len(stretch)) if stretch[i - 1 : i + 1] not in inner]
        return [stretch[a:b] for a, b in zip(cuts, [*cuts[1:], len(stretch)], strict=True)]

    def _remember(self, stretch: str, ids: bytes) -> bytes:
        if len(stretch) <= CACHE_CHARS:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[stretch] = ids
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; invalid UTF-8 from bytes reads as U+FFFD."""
        table = self.bytes
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
        return text.removeprefix(" ")


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode(df: DataFrame, path: str, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of each row."""

    def run(batches):
        own = model(path)
        for b in batches:
            ids = [own.encode(t.as_py()).astype(np.int32) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", ident: str = "doc_id") -> DataFrame:
    """(doc_id, text) of each row; null ids are none."""

    def run(batches):
        own = model(path)
        for b in batches:
            texts = [own.decode(x.as_py() or []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("doc_id"), F.col(ids)).mapInArrow(run, f"doc_id {kind}, text string")


DIGEST = "doc_id {kind}, n_ids long, n_byte_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


def digests(df: DataFrame, path: str, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Encode and decode each row; digests of the ids (little-endian 32-bit) and of the decoded text."""

    def run(batches):
        own = model(path)
        for b in batches:
            rows = []
            for t in b.column(1):
                t = t.as_py()
                ids = own.encode(t)
                back = own.decode(ids.tolist())
                rows.append((len(ids), int(own.is_byte[ids].sum()), zlib.crc32(ids), hashlib.sha256(back.encode()).hexdigest(), back == t))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[x.split()[0] for x in DIGEST.split(", ")])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, DIGEST.format(kind=kind))
