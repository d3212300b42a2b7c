"""Splitting oversized texts at natural boundaries chosen by lexical cohesion."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.session import ship

#: What a boundary's kind adds to its depth; less than what depths differ by, it decides between valleys of like depth only: a paragraph's end, a line's, a sentence's.
KIND_BONUS = {3: 0.1, 2: 0.05, 1: 0.0}
#: Tokens before and behind a cut whose words are compared.
BLOCK = 80
SENTENCE = re.compile(r"[.!?…。:;][\"'»”)\]]*(?=\s)")
# A character's place in the tables below; those of the higher planes are looked up one by one.
PLANE = 1 << 16


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each character: 0 white space, 1 letter, digit or underscore, 2 other; and the number of its lower case."""
    chars = [chr(i) for i in range(PLANE)]
    kinds = np.array([1 if re.match(r"\w", c) else 0 if c.isspace() else 2 for c in chars], np.uint8)
    return kinds, np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], np.uint32)


@cache
def _powers(n: int = 4096) -> np.ndarray:
    """Powers of an odd number, modulo 2 ** 64."""
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, np.uint64(0x9E3779B97F4A7C15), np.uint64)])


@dataclass
class Tokens:
    """The tokens of a text: first and end character of each, a number that is the same for the same word in either case, and the line ends before it."""

    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    lines: np.ndarray

    @staticmethod
    def of(text: str) -> Tokens:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, lower = tables()
        low = np.minimum(codes, PLANE - 1)
        kind, small = kinds[low], lower[low]
        for i in np.flatnonzero(codes >= PLANE):
            c = text[i]
            kind[i], small[i] = 1 if re.match(r"\w", c) else 0 if c.isspace() else 2, ord(c.lower()[0])
        change = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
        first = np.flatnonzero(kind[change] > 0)
        starts, ends = change[first], np.r_[change, len(codes)][first + 1]
        if not len(starts):
            return Tokens(starts, ends, np.zeros(0, np.uint64), starts)
        within = np.arange(len(codes)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(codes)]))
        powers = _powers()
        worth = np.where(kind > 0, (small.astype(np.uint64) + np.uint64(1)) * powers[within % len(powers)], np.uint64(0))
        seen = np.r_[0, np.cumsum(codes == 10)]
        return Tokens(starts, ends, np.add.reduceat(worth, starts), np.r_[0, seen[starts[1:]] - seen[ends[:-1]]])


def boundaries(text: str, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Token positions before which a text may be cut naturally, rising, with the kind of what ends there: 3 paragraph, 2 line, 1 sentence."""
    kinds = np.where(tokens.lines > 1, 3, np.where(tokens.lines > 0, 2, 0))
    at = np.searchsorted(tokens.starts, [m.end() for m in SENTENCE.finditer(text)])
    for k in at[at < len(kinds)].tolist():
        if not kinds[k] and not text[tokens.starts[k]].islower():
            kinds[k] = 1
    kinds[:1] = 0
    cuts = np.flatnonzero(kinds)
    return cuts, kinds[cuts]


def cohesion(words: np.ndarray, cuts: np.ndarray, begin: np.ndarray, end: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Cosine of the words in the blocks before and behind each cut, neither beyond the cut's text, which spans begin..end - 1.

    Dot products and lengths of the blocks' counts are numbers of equal pairs of words; pairs at one distance in a stretch are a difference of running
    counts, so the cost is one pass over the words for each distance within two blocks, all in whole arrays; the words of many texts go through at once.
    """
    k = cuts
    first, last = np.maximum(k - block, begin), np.minimum(k + block, end)
    dot, left, right = np.zeros(len(k), np.int64), k - first, last - k
    words = np.unique(words, return_inverse=True)[1].astype(np.int32)
    for far in range(1, min(2 * block, len(words))):
        run = np.zeros(len(words) + 1, np.int32)  # equal pairs (i, i + far) of all i before
        np.cumsum(words[far:] == words[:-far], out=run[1 : len(words) - far + 1])
        a, b = np.maximum(first, k - far), np.minimum(k, last - far)
        dot += np.where(b > a, run[b] - run[a], 0)
        if far < block:
            a, b = k - far, last - far
            left += 2 * np.where(a > first, run[a] - run[first], 0)
            right += 2 * np.where(b > k, run[b] - run[k], 0)
    return np.where((left > 0) & (right > 0), dot / np.sqrt(np.maximum(left * right, 1)), 0.0)


def depths(words: np.ndarray, cuts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Depth of the similarity valley at each cut of one text: how far its cohesion lies below the peaks on either side."""
    k = np.asarray(cuts, int)
    return valleys(cohesion(words, k, np.zeros_like(k), np.full_like(k, len(words)), block).tolist())


def valleys(values: list[float]) -> np.ndarray:
    """How far each value lies below the highest points that the values climb to on its left and on its right."""
    up, down, peak = [], [], -1.0
    for i, s in enumerate(values):
        peak = s if i == 0 or values[i - 1] < s else max(peak, values[i - 1])
        up.append(max(peak, s))
    for i in range(len(values) - 1, -1, -1):
        s = values[i]
        peak = s if i == len(values) - 1 or values[i + 1] < s else max(peak, values[i + 1])
        down.append(max(peak, s))
    return np.array(up) + np.array(down[::-1]) - 2 * np.array(values)


def pieces_of(tokens: Tokens, cuts: np.ndarray, rank: np.ndarray, most: int, overlap: int, fill: float) -> list[tuple[int, int, int]]:
    """See split_texts; rank: what cuts are chosen by."""
    n, out, start = len(tokens.starts), [], 0
    overlap = max(0, min(overlap, most - 1))
    while n - start > most:
        low, high = start + max(int(most * fill), overlap + 1), start + most
        a, b, c = np.searchsorted(cuts, [start + overlap + 1, low, high + 1])
        if b < c:
            end = int(cuts[c - 1 - np.argmax(rank[b:c][::-1])])  # of equal ones the last
        else:
            end = int(cuts[c - 1]) if a < c else high
        out.append((int(tokens.starts[start]), int(tokens.ends[end - 1]), end - start))
        start = end - overlap
    return [*out, (int(tokens.starts[start]), int(tokens.ends[-1]), n - start)] if n else out


def split_texts(texts: list[str], most: int, overlap: int, fill: float = 0.5, only_oversized: bool = False, together: int = 60_000) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """(number of the text, [(first character, end, tokens)...]) of the texts' pieces: one piece (none with only_oversized) if a text is within `most` tokens, none without a token.

    A piece takes from its start at most `most` tokens; among the natural boundaries that fill at least `fill` of it the deepest
    valley is its end, the kind of boundary deciding between valleys of like depth; if there is none, the last natural boundary that still moves on; else the
    size itself. The next piece starts `overlap` tokens before that end. The last piece ends with the text. together: tokens that are worked on at once.
    """
    held: list[tuple[int, Tokens, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        if not held:
            return
        at = np.cumsum([0, *(len(t.starts) for _, t, _, _ in held)])
        lens = [len(c) for _, _, c, _ in held]
        begin, end = np.repeat(at[:-1], lens), np.repeat(at[1:], lens)
        cuts = np.concatenate([c for _, _, c, _ in held])
        close = cohesion(np.concatenate([t.words for _, t, _, _ in held]), cuts + begin, begin, end)
        for (i, t, c, kinds), k in zip(held, np.cumsum(lens)):
            rank = valleys(close[k - len(c) : k].tolist()) + np.array([KIND_BONUS[x] for x in kinds.tolist()])
            yield i, pieces_of(t, c, rank, most, overlap, fill)
        held.clear()

    for i, text in enumerate(texts):
        if not text or only_oversized and len(text) <= most:
            continue
        tokens = Tokens.of(text)
        n = len(tokens.starts)
        if n <= most:
            if n and not only_oversized:
                yield i, [(int(tokens.starts[0]), int(tokens.ends[-1]), n)]
            continue
        held.append((i, tokens, *boundaries(text, tokens)))
        size += n
        if size >= together:
            yield from flush()
            size = 0
    yield from flush()


def split_text(text: str, most: int, overlap: int, fill: float = 0.5) -> list[tuple[int, int, int]]:
    """The pieces of one text, see split_texts."""
    return next(split_texts([text], most, overlap, fill), (0, []))[1]


def split_documents(docs: DataFrame, most: int, overlap: int, only_oversized: bool = True) -> DataFrame:
    """(doc_id, piece_no, first_char, end_char, n_tokens, text) of docs (doc_id, text) above `most` tokens: ordered pieces within it.

    Pieces are exact parts of the text; neighbours share `overlap` tokens, and without them the pieces make up the whole text. Texts within
    the budget give no row, or one piece with only_oversized=False; null texts and texts without a token none. Repeated rows give
    their pieces each. Texts too short to have that many tokens are dropped by length in the scan. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    docs = docs.selectExpr("cast(doc_id as long) as doc_id", "text").where(F.col("text").isNotNull())
    if only_oversized:
        docs = docs.where(F.length("text") > most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, got in split_texts(texts, most, overlap, only_oversized=only_oversized):
                rows += [(ids[i], k, a, e, n, texts[i][a:e]) for k, (a, e, n) in enumerate(got, 1)]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.string())], names=["doc_id", "piece_no", "first_char", "end_char", "n_tokens", "text"])

    return docs.mapInArrow(run, "doc_id long, piece_no long, first_char long, end_char long, n_tokens long, text string")
