"""Passages of held-out items inside a corpus: shared seeds, then greedy string tiling by running Karp-Rabin."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.addresses import osa, skeleton
from tallyweave.llm.language import normal
from tallyweave.session import ship

#: Pieces of a seed, and how many seeds of each stretch of an item are looked up, the rarest first.
SEED, PER_STRETCH = 3, 8
#: Characters of item texts that one pass takes as a broadcast; more items are taken in further passes over the corpus.
BLOCK_CHARS = 16_000_000
#: What an item's word that the document lacks takes off a passage's score, times its weight; a passage ends where what follows is worth less.
LACKING = 3.0
PIECE = re.compile(r"\w+")
SHAPE = str.maketrans("015829l", "oisbzgi")


def tokens(text: str) -> list[str]:
    """Runs of letters and digits of a text in lower case without accents, so that marks may stand, change or become blanks."""
    return PIECE.findall(normal(text))


def split_words(text: str) -> list[tuple[str, ...]]:
    """The white-space words of a text, each as its pieces; marks alone are no words."""
    return [tuple(p) for w in normal(text).split() if (p := PIECE.findall(w))]


def seeds(pieces: list[str]) -> list[tuple[str, ...]]:
    return list(zip(*(pieces[k:] for k in range(SEED))))


def held_by(texts: Iterable[str]) -> tuple[Counter, Counter, int]:
    """How many of the texts hold each word, and each seed, and how many texts there are."""
    words, found, n = Counter(), Counter(), 0
    for t in texts:
        ws = split_words(t)
        words.update(set(ws))
        found.update(set(seeds([p for w in ws for p in w])))
        n += 1
    return words, found, n


def telling(pieces: list[str], held: Counter, stretch: int) -> set[int]:
    """Places of the seeds to look up: of each run of `stretch` pieces the PER_STRETCH rarest (all, if it has fewer), so no run goes without."""
    all_seeds = seeds(pieces)
    span = max(1, stretch - SEED + 1)
    runs = max(1, len(all_seeds) - span + 1)
    have, out = [0] * runs, set()
    for k in sorted(range(len(all_seeds)), key=lambda k: (held[all_seeds[k]], k)):
        own = range(max(0, k - span + 1), min(runs - 1, k) + 1)
        if any(have[r] < PER_STRETCH for r in own):
            out.add(k)
            for r in own:
                have[r] += 1
    return out


@dataclass
class Item:
    """An item's pieces, the word that each belongs to, the pieces of each word and its weight: the fewer items hold a word, the more it tells."""

    pieces: list[str]
    word_of: list[int]
    words: list[tuple[str, ...]]
    weights: list[float]

    @staticmethod
    def of(text: str, held: Counter, n: int) -> Item:
        words = split_words(text)
        return Item([p for w in words for p in w], [k for k, w in enumerate(words) for _ in w], words, [math.log(1 + n / max(1, held[w])) for w in words])


def seed_codes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A number for each three word numbers; equal ones get the same, others rarely, and tiling tells those apart."""
    p = np.uint64(0x9E3779B97F4A7C15)
    return (a.astype(np.uint64) * p + b.astype(np.uint64)) * p + c.astype(np.uint64)


@dataclass
class Index:
    """Items, the numbers of the pieces of their telling seeds, and these seeds as sorted codes with the items that hold them."""

    items: list[Item] = field(default_factory=list)
    numbers: dict[str, int] = field(default_factory=dict)
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    holders: list[list[int]] = field(default_factory=list)

    @staticmethod
    def of(texts: list[str], held: tuple[Counter, Counter, int], words: int) -> Index:
        """held: held_by all items, of which texts may be a part, so what is found does not depend on the parts."""
        index, at = Index([Item.of(t, held[0], held[2]) for t in texts]), defaultdict(set)
        for n, item in enumerate(index.items):
            if len(item.words) < words:
                continue
            places = telling(item.pieces, held[1], words)
            for k in places:
                at[tuple(index.numbers.setdefault(p, len(index.numbers)) for p in item.pieces[k : k + SEED])].add(n)
        if at:
            keys = np.array(list(at), np.int64)
            codes = seed_codes(keys[:, 0], keys[:, 1], keys[:, 2])
            order = np.argsort(codes)
            index.codes, held_in = codes[order], list(at.values())
            index.holders = [sorted(held_in[k]) for k in order]
        return index


def shortened(word: str) -> set[str]:
    """word and what is left of it without one letter."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def keys(word: str) -> set[str]:
    """Texts of which two words share one if one is the other slightly misread."""
    out = {"=" + word.translate(SHAPE)}
    if len(word) >= 4:
        out |= shortened(word) | {"~" + skeleton(word)}
    elif any(c.isdigit() for c in word):
        out |= shortened(word)
    return out


def like(word: str, other: str) -> bool:
    """word is `other` slightly misread: one edit or swap, or letters that scanners confuse.

    Another digit is another number; look-alikes, swapped digits, a letter among digits and, in long numbers, a digit too many or too few are misread.
    """
    if word.translate(SHAPE) == other.translate(SHAPE):
        return True
    if any(c.isdigit() for c in other):
        if osa(word, other, 1) > 1:
            return False
        return sorted(word) == sorted(other) or (len(other) >= 2 and not word.isdigit()) or (len(other) >= 4 and len(word) != len(other))
    if len(other) < 4:
        return False
    return skeleton(word) == skeleton(other) or osa(word, other, 1) <= 1


class Words:
    """The distinct pieces of an item as numbers, found also when misread, and its words of several pieces, found also when written as one."""

    def __init__(self, item: Item) -> None:
        self.known = {w: i for i, w in enumerate(dict.fromkeys(item.pieces))}
        self.ids = [self.known[w] for w in item.pieces]
        self.joined = {"".join(w): [self.known[p] for p in w] for w in item.words if len(w) > 1}
        self.by_key: dict[str, list[str]] = defaultdict(list)
        for w in self.known:
            for k in keys(w):
                self.by_key[k].append(w)
        self.seen: dict[str, int | None] = {}

    def number(self, word: str) -> int | None:
        if word in self.known:
            return self.known[word]
        if word not in self.seen:
            if len(self.seen) > 20_000:
                self.seen.clear()
            near = (w for k in keys(word) for w in self.by_key.get(k, ()) if like(word, w))
            self.seen[word] = min((self.known[w] for w in near), default=None)
        return self.seen[word]

    def read(self, doc: list[str]) -> list[int]:
        """doc's pieces as numbers of the item's, negative where it has none; two pieces that make up one of the item's count as that."""
        out: list[int] = []
        k = 0
        while k < len(doc):
            w = doc[k]
            if w not in self.known and w in self.joined:
                out += self.joined[w]
            elif k + 1 < len(doc) and w not in self.known and (w + doc[k + 1]) in self.known:
                out.append(self.known[w + doc[k + 1]])
                k += 1
            else:
                n = self.number(w)
                out.append(-1 - k if n is None else n)
            k += 1
        return out


def tiles(a: list[int], b: list[int], least: int = 2, longest: int = 16) -> list[tuple[int, int, int]]:
    """Greedy string tiling of a and b: (start in a, start in b, length), no piece in two tiles, none shorter than `least`.

    Search lengths start at `longest` and fall; at each length the unmarked windows of b are hashed by running Karp-Rabin and those of a looked
    up, matches extended as far as they go, and the longest marked first.
    """
    base, mod = 1_000_003, (1 << 61) - 1
    free_a, free_b, out = [True] * len(a), [True] * len(b), []

    def windows(s: list[int], free: list[bool], n: int) -> Iterator[tuple[int, int]]:
        top, h, run = pow(base, n - 1, mod), 0, 0
        for k, x in enumerate(s):
            if not free[k] or x < 0:
                h = run = 0
                continue
            if run >= n:
                h = (h - (s[k - n] + 7) * top) % mod
            h = (h * base + x + 7) % mod
            run += 1
            if run >= n:
                yield k - n + 1, h

    n = min(len(a), len(b), longest)
    while n >= least:
        at = defaultdict(list)
        for k, h in windows(b, free_b, n):
            at[h].append(k)
        found = []
        if at:
            for k, h in windows(a, free_a, n):
                for q in at.get(h, ()):
                    m = 0
                    while k + m < len(a) and q + m < len(b) and free_a[k + m] and free_b[q + m] and a[k + m] == b[q + m]:
                        m += 1
                    if m >= n:
                        found.append((m, k, q))
        for m, k, q in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_a[k : k + m]) and all(free_b[q : q + m]):
                free_a[k : k + m] = [False] * m
                free_b[q : q + m] = [False] * m
                out.append((k, q, m))
        n = n - 1 if n <= 4 else max(4, n // 2)
    return sorted(out)


def covered(item: Item, parts: Iterable[tuple[int, int, int]]) -> tuple[int, float]:
    """(words, share): the item's words that the tiles hold (half of their pieces at least), and the share of their weight in that of all words from the first to the last."""
    places = {k + i for k, _, m in parts for i in range(m)}
    if not places:
        return 0, 0.0
    got = [w for w, n in Counter(item.word_of[p] for p in places).items() if 2 * n >= len(item.words[w])]
    if not got:
        return 0, 0.0
    return len(got), sum(item.weights[w] for w in got) / sum(item.weights[min(got) : max(got) + 1])


def passage(item: Item, words: Words, doc: list[str], gap: int = 60) -> tuple[tuple[int, float], tuple[int, float]]:
    """What doc holds of the item in the item's order and in one place, and what it holds in any order: (words, share) each, see covered.

    Pieces that misread an item's count as that piece. In order, tiles follow each other in both texts with at most `gap` other pieces of doc
    between them; the best chain has the greatest weight, less LACKING times that of the item's pieces left out between them. In any order, tiles of at least
    three pieces count.
    """
    a, b = words.ids, words.read(doc)
    found = tiles(a, b)
    loose = [t for t in found if t[2] >= 3]
    # a lone piece counts where it stands at the right place beside a tile
    used_a, used_b = {k + i for k, _, m in found for i in range(m)}, {q + i for _, q, m in found for i in range(m)}
    for k, q, m in list(found):
        for da, db in ((m, m), (m + 1, m + 1), (m + 1, m), (m, m + 1), (-1, -1), (-2, -2)):
            x, y = k + da, q + db
            if 0 <= x < len(a) and 0 <= y < len(b) and x not in used_a and y not in used_b and a[x] == b[y]:
                found.append((x, y, 1))
                used_a.add(x)
                used_b.add(y)
    found.sort()
    upto = [0.0]
    for w in item.word_of:
        upto.append(upto[-1] + item.weights[w] / len(item.words[w]))
    best: list[tuple[float, int]] = []
    for i, (k, q, m) in enumerate(found):
        own = upto[k + m] - upto[k]
        score, back = own, -1
        for j in range(i):
            k0, q0, m0 = found[j]
            if k0 + m0 <= k and 0 <= q - q0 - m0 <= gap and best[j][0] + own - LACKING * (upto[k] - upto[k0 + m0]) > score:
                score, back = best[j][0] + own - LACKING * (upto[k] - upto[k0 + m0]), j
        best.append((score, back))
    chain, i = [], max(range(len(best)), key=lambda i: best[i][0], default=-1)
    while i >= 0:
        chain.append(found[i])
        i = best[i][1]
    return covered(item, chain), covered(item, loose)


def leaks(items: DataFrame, docs: DataFrame, words: int = 25, share: float = 0.75, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, doc_id, n_words, coverage, any_order) of items (item_id, item_text) and docs (doc_id, text): documents that hold a passage.

    n_words: words of the item in its order and in one place (0 if they are too few, the row then stands for a reordered passage); coverage: their part of
    the item's words; any_order: words held in whatever order. A
    row is given if either is at least `words` and has at least `share` of the weight of the item's words from its first to its last: a word weighs the
    more the fewer items hold it, so sentences of the same build with other facts have less. Documents are tiled that share two telling seeds
    with an item; each stretch of `words` pieces of an item has its rarest seeds looked up, however many items hold them (see telling). Whole texts are
    searched, and a text with such seeds in several places is tiled at each.

    Items of fewer than `words` words, null and empty texts give no row. Repeated documents each give a row, and so do items of equal text,
    which count as one. What is telling is counted over all items before they are split: they are a stated query set that goes to the tasks in blocks of
    at most `block_chars` characters, so a broadcast has a fixed bound, and blocks change no result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    same: dict[str, list[int]] = {}
    for r in items.select("item_id", "item_text").toLocalIterator():
        if r[0] is not None and r[1]:
            same.setdefault(" ".join("".join(w) if len(w) == 1 else "-".join(w) for w in split_words(r[1])), []).append(r[0])
    held = held_by(same)
    blocks, size = [], block_chars
    for text, ids in same.items():
        if size + len(text) > block_chars or not blocks:
            blocks.append(([], []))
            size = 0
        blocks[-1][0].append(text)
        blocks[-1][1].append(ids)
        size += len(text)
    out = None
    for texts, ids_of in blocks or [([], [])]:
        shared = spark.sparkContext.broadcast((Index.of(texts, held, words), ids_of))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix, item_ids = shared.value
            words_of: dict[int, Words] = {}
            for b in batches:
                doc_ids, get, flat, docs_, starts = b.column(0).to_pylist(), ix.numbers.get, [], [], []
                for t in b.column(1).to_pylist():
                    ws = tokens(t) if t else []
                    docs_.append(ws)
                    starts.append(len(flat))
                    flat += [get(w, -1) for w in ws]
                    flat += (-1,) * SEED
                res: list[tuple[int, int, int, float, int]] = []
                if len(flat) > SEED and len(ix.codes):
                    x = np.array(flat, np.int64)
                    whole = np.flatnonzero((x[:-2] >= 0) & (x[1:-1] >= 0) & (x[2:] >= 0))
                    code = seed_codes(x[whole], x[whole + 1], x[whole + 2])
                    pos = np.minimum(np.searchsorted(ix.codes, code), len(ix.codes) - 1)
                    hit = np.flatnonzero(ix.codes[pos] == code)
                    places = whole[hit]
                    where = defaultdict(list)
                    for h, k, p in zip(places.tolist(), (np.searchsorted(starts, places, side="right") - 1).tolist(), pos[hit].tolist()):
                        for item in ix.holders[p]:
                            where[k, item].append((h - starts[k], p))
                    for (k, n), at in where.items():
                        if len(at) < 2:
                            continue
                        item = ix.items[n]
                        reach = len(item.pieces) + 80
                        groups = [[at[0]]]
                        for p in at[1:]:
                            if p[0] - groups[-1][-1][0] > reach:
                                groups.append([])
                            groups[-1].append(p)
                        top = (0, 0)
                        for g in groups:
                            if len({p for _, p in g}) < 2:
                                continue
                            if n not in words_of:
                                words_of[n] = Words(item)
                            straight, loose = passage(item, words_of[n], docs_[k][max(0, g[0][0] - reach) : g[-1][0] + reach])
                            ok = [n if n >= words and part >= share else 0 for n, part in (straight, loose)]
                            top = max(top, (ok[0], max(ok)))
                        if top[1]:
                            res += [(i, doc_ids[k], top[0], top[0] / len(item.words), top[1]) for i in item_ids[n]]
                cols = list(zip(*res)) if res else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["item_id", "doc_id", "n_words", "coverage", "any_order"])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "item_id long, doc_id long, n_words long, coverage double, any_order long")
        out = found if out is None else out.unionByName(found)
    return out
