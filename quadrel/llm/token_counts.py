"""Token counts of sections by offset-mapped attribution.

A whole document is encoded once with a byte-level BPE, whose tokens' bytes concatenate
to the document's bytes.  The running sum of the tokens' byte lengths, looked up in a
table of the vocabulary, is each token's span; byte offsets become character offsets by
counting the bytes that begin a character.  Token spans and section spans, both in
rising order, are then joined as intervals by binary search, and each token is allocated:

``most``   to the section that holds most of its characters, the earlier one on a tie;
``first``  to the section that holds its first character;
``share``  to every section that it meets, in proportion to the characters in each.

A token within a character (a character may take several tokens) spans that character.
Characters outside all sections are counted in section -1, so that the counts of a
document's sections always sum to its tokens.  Sections may touch; they must not overlap.

Encoding a document's sections apart gives other counts, as tokens may not cross their
borders then; these are counts of the document as it is trained on.

Defined cases: a null text is empty; an empty text has its sections, all with zero
tokens; null fields are empty fields; texts of any length are encoded whole; repeated
rows are counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import text_of

OUTSIDE = -1


@lru_cache(4)
def _encoding(path: str, pattern: str):
    """A tiktoken encoding from a file of ranks, and the byte length of each id."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end character of every token of ``text``."""
    encoding, lengths = _encoding(path, pattern)
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    ids = np.fromiter(encoding.encode_ordinary(text), np.int64)
    ends = np.cumsum(lengths[ids])
    begun = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters begun before each byte
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return begun[np.minimum(starts + 1, len(data))] - 1 if len(ends) else starts, begun[ends]


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sections that are the lines of a text; a line's break belongs to it.  An empty text is one empty line."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array([0, *ends[:-1]], np.int64), np.array(ends, np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, end: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section, and of what is outside as the last entry."""
    n = len(first)
    counts = np.zeros(n + 1)
    if not len(starts):
        return counts
    if not n:
        counts[0] = len(starts)
        return counts
    at = np.searchsorted(end, starts, side="right")  # the first section that ends after the token's first character
    inside = (at < n) & (first[np.minimum(at, n - 1)] <= starts)
    whole = inside & (ends <= end[np.minimum(at, n - 1)])
    counts[:n] += np.bincount(at[whole], minlength=n)[:n]
    if rule == "first":
        rest = ~whole & inside
        counts[:n] += np.bincount(at[rest], minlength=n)[:n]
        counts[n] += np.count_nonzero(~inside)
        return counts
    for t in np.nonzero(~whole)[0]:
        size, k, met = ends[t] - starts[t], int(at[t]), []
        while k < n and first[k] < ends[t]:
            if share := min(end[k], ends[t]) - max(first[k], starts[t]):
                met.append((share, k))
            k += 1
        out = size - sum(s for s, _ in met)
        if rule == "share":
            for share, k in met:
                counts[k] += share / size
            counts[n] += out / size
        else:
            share, k = max(met, key=lambda x: x[0], default=(0, n))
            counts[k if share >= out else n] += 1
    return counts


def section_counts(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ident: str = "doc_id", sections: str | None = None, rule: str = "most") -> DataFrame:
    """(doc_id, section, start, end, tokens, doc_tokens) for each section of each row.

    ``sections`` names a column of array<struct<start, end>>, in rising order and apart;
    without it a text's lines are its sections.  Row -1 stands for what is outside all
    sections and is given only where that has tokens.
    """
    if rule not in ("most", "first", "share"):
        raise ValueError(f"no such rule: {rule}")

    def run(batches):
        for b in batches:
            docs = b.column(0)
            out = {k: [] for k in ("row", "section", "start", "end", "tokens", "doc_tokens")}
            size = 0
            for i, t in enumerate(b.column(1)):
                t = t.as_py()
                if sections:
                    spans = sorted((s["start"], s["end"]) for s in (b.column(2)[i].as_py() or []) if s is not None)
                    first, end = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
                else:
                    first, end = line_spans(t)
                starts, ends = token_spans(t, vocabulary, pattern)
                counts = allocate(starts, ends, first, end, rule)
                n = len(first) + bool(counts[-1])
                out["row"].append(np.full(n, i))
                out["section"].append(np.concatenate((np.arange(len(first)), [OUTSIDE]))[:n])
                out["start"].append(np.concatenate((first, [0]))[:n])
                out["end"].append(np.concatenate((end, [0]))[:n])
                out["tokens"].append(counts[:n])
                out["doc_tokens"].append(np.full(n, len(starts)))
                size += n
                if size > 50_000:
                    yield _batch(docs, out)
                    out, size = {k: [] for k in out}, 0
            if size:
                yield _batch(docs, out)

    def _batch(docs, out):
        whole = {k: np.concatenate(v) for k, v in out.items()}
        return pa.RecordBatch.from_arrays(
            [docs.take(pa.array(whole["row"])), pa.array(whole["section"].astype(np.int32)), *(pa.array(whole[k]) for k in ("start", "end", "tokens", "doc_tokens"))],
            names=["doc_id", "section", "start", "end", "tokens", "doc_tokens"],
        )

    kind = df.schema[ident].dataType.simpleString()
    columns = [F.col(ident).alias("doc_id"), text_of(text).alias("text"), *([F.col(sections).alias("sections")] if sections else [])]
    return df.select(*columns).mapInArrow(run, f"doc_id {kind}, section int, start long, end long, tokens double, doc_tokens long")


def field_counts(df: DataFrame, vocabulary: str, pattern: str, fields: list[str], ident: str, separator: str = "\n", rule: str = "most") -> DataFrame:
    """Token counts of each field of a record that is encoded as one text, fields joined by ``separator``.

    The separators are outside all fields, and so counted in section -1, unless a token
    joins them to a field.
    """
    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    spans, at = [], F.lit(0).cast("long")
    for t in texts:
        end = at + F.char_length(t)
        spans.append(F.struct(at.alias("start"), end.alias("end")))
        at = end + len(separator)
    joined = df.select(F.col(ident).alias("ident"), F.concat_ws(separator, *texts).alias("whole"), F.array(*spans).alias("spans"))
    return section_counts(joined, vocabulary, pattern, "whole", "ident", "spans", rule)
