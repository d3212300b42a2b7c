"""Language of documents and paragraphs: averaged hashed subword embeddings under a linear softmax, with calibrated rejection."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.sampling import least_hashes
from tallyweave.session import ship

# The languages and the names they go by in labels.
LANGUAGES = ("en", "de", "fr", "pt", "es", "nl", "et", "th")
NAMES = {
    "en": "en eng english anglais englisch", "de": "de deu ger german deutsch", "fr": "fr fra fre french francais français", "pt": "pt por portuguese portugues português",
    "es": "es spa spanish espanol español castellano", "nl": "nl nld dut dutch nederlands", "et": "et est estonian eesti", "th": "th tha thai ไทย ภาษาไทย",
}
LABELS = {name: lang for lang, names in NAMES.items() for name in names.split()}
WORD = re.compile(r"[^\W\d_]+(?:[ัิ-ฺ็-๎]+[^\W\d_]*)*")
MARKS = re.compile("[̀-ͯ]+")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")


def label(col: Column) -> Column:
    """The language that a label names in any notation (code, code with region, English or own name), else null."""
    names = F.create_map(*(F.lit(x) for pair in LABELS.items() for x in pair))
    text = F.lower(F.trim(F.regexp_replace(col, r"\s+", " ")))
    return F.coalesce(names[text], names[F.regexp_extract(text, r"^([a-z]{2,3})[-_ ]", 1)])


def normal(text: str) -> str:
    """text in lower case, composed, without accents on letters."""
    if not text.isascii():
        text = MARKS.sub("", unicodedata.normalize("NFKD", text))
    return text.lower()


def subwords(word: str, buckets: int) -> list[int]:
    """Hash buckets of a word: itself and its runs of two to four letters, marked at both ends."""
    w = f"<{word}>"
    grams = [w] + [w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) % buckets for g in grams[:160]]


def words(text: str) -> list[str]:
    """Runs of letters of a normal text; long runs (scripts without blanks) in pieces of eight."""
    found = WORD.findall(text)
    if max(map(len, found), default=0) > 24:
        found = [p for w in found for p in ([w] if len(w) <= 24 else [w[i : i + 8] for i in range(0, len(w), 8)])]
    return found


@dataclass
class Model:
    """Embeddings of hash buckets, softmax weights, and the calibration of its log odds."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    scale: float = 1.0
    reject: float = 0.9

    def word_scores(self, word: str) -> np.ndarray:
        """A word's share in the class scores: the sum of its subwords' embeddings under the softmax weights, and behind it their number."""
        s = subwords(word, len(self.embeddings))
        return np.append(self.embeddings[s].sum(0) @ self.weights, len(s))


def _rows(texts: list[str], buckets: int, cache: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat subword indices, their weights and the start of each text."""
    idx, wt, starts, at = [], [], [], 0
    for t in texts:
        starts.append(at)
        for w in words(t):
            if w not in cache:
                cache[w] = np.array(subwords(w, buckets))
            idx.append(cache[w])
            at += len(cache[w])
        wt.append(np.full(at - starts[-1], 1 / (at - starts[-1])))
    return np.concatenate(idx), np.concatenate(wt), np.array(starts)


def fit(texts: list[str], langs: list[int], buckets: int = 1 << 14, dim: int = 12, epochs: int = 4, rate: float = 6.0, batch: int = 128, seed: int = 7) -> Model:
    """A model by stochastic gradient descent on normal texts with class numbers."""
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.3, (buckets, dim)).astype(np.float32), rng.normal(0, 0.3, (dim, len(LANGUAGES))).astype(np.float32), np.zeros(len(LANGUAGES), np.float32)
    y, cache = np.array(langs), {}
    batches = []
    order = rng.permutation(len(texts))
    for k in range(0, len(order), batch):
        part = order[k : k + batch]
        batches.append((*_rows([texts[i] for i in part], buckets, cache), y[part]))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(batches)):
            idx, wt, starts, target = batches[k]
            h = np.add.reduceat(e[idx] * wt[:, None].astype(np.float32), starts)
            z = h @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(target)), target] -= 1
            p /= len(target)
            back = p @ w.T
            w -= step * 0.2 * h.T @ p
            b -= step * 0.05 * p.sum(0)
            owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(idx)]))
            sort = np.argsort(idx, kind="stable")
            unique, first = np.unique(idx[sort], return_index=True)
            e[unique] -= 40 * step * np.add.reduceat((back[owner] * wt[:, None].astype(np.float32))[sort], first)
    return Model(e, w, b)


def scores(model: Model, texts: list[str], table: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Mean class scores and number of subwords of normal texts (no word: zero scores)."""
    table = {} if table is None else table
    total = np.zeros((len(texts), len(LANGUAGES) + 1))
    rows = []
    for t in texts:
        ws = words(t)
        rows.append(ws)
        for w in ws:
            if w not in table:
                table[w] = model.word_scores(w)
    flat = [table[w] for ws in rows for w in ws]
    if flat:
        flat = np.array(flat)
        lens = np.array([len(ws) for ws in rows])
        some = lens > 0
        total[some] = np.add.reduceat(flat, np.r_[0, np.cumsum(lens[some])[:-1]])
    count, total = total[:, -1], total[:, :-1]
    return total / np.maximum(count, 1)[:, None] + model.bias * (count > 0)[:, None], count


def confidences(model: Model, mean: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Calibrated probabilities: scores sharpened by the square root of the number of subwords."""
    z = mean * (model.scale * np.sqrt(np.minimum(count, 4000) / 10))[:, None]
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


TRAIN_DOCS = 1_600


def train(docs: DataFrame, sample: int = TRAIN_DOCS, error: float = 0.01) -> Model:
    """A model from the labels of at most `sample` labelled documents (least hashes of id and label, one text of each), wrong labels among them included.

    A first model is fitted to all paragraphs; those whose label it finds unlikely are left out of the second fit. A fifth of the documents is
    held out for the calibration: the scale that makes confidences most likely, and the least confidence at which no more than
    `error` of the kept paragraphs differ from their (likely) label. Without any labelled document, texts are told apart by nothing
    and every paragraph is rejected.
    """
    # ids and labels are picked without their texts, which are then read once
    ids = least_hashes(docs.select(F.col("doc_id").alias("_id"), label(F.col("lang")).alias("_said")).where("_said is not null"), F.concat_ws("|", F.col("_id").cast("string"), "_said"), sample)
    texts = docs.select("doc_id", "text", label(F.col("lang")).alias("lang")).where("lang is not null and text is not null")
    texts = texts.join(F.broadcast(ids), (F.col("lang") == F.col("_said")) & (F.col("doc_id") == F.col("_id")), "left_semi")
    picked = sorted(texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    texts, langs, held = [], [], []
    for i, r in enumerate(picked):
        for p in PARAGRAPH.split(normal(r["text"])):
            if len(words(p)) >= 3:
                texts.append(p)
                langs.append(LANGUAGES.index(r["lang"]))
                held.append(i % 5 == 0)
    if len(set(langs)) < 2:
        return Model(np.zeros((1, 1), np.float32), np.zeros((1, len(LANGUAGES)), np.float32), np.zeros(len(LANGUAGES), np.float32), 1.0, 2.0)
    y, held = np.array(langs), np.array(held)
    rest = np.flatnonzero(~held)
    model = fit([texts[i] for i in rest], [langs[i] for i in rest], epochs=2)
    mean, count = scores(model, texts)
    p = confidences(model, mean, count)
    agree = p[np.arange(len(y)), y] >= 0.3
    rest = np.flatnonzero(~held & agree)
    model = fit([texts[i] for i in rest], [langs[i] for i in rest])
    test = np.flatnonzero(held & agree)
    mean, count = scores(model, [texts[i] for i in test])
    best = None
    for scale in (0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 5.0):
        model.scale = scale
        p = confidences(model, mean, count)
        loss = -np.log(np.maximum(p[np.arange(len(test)), y[test]], 1e-9)).mean()
        if best is None or loss < best[0]:
            best = (loss, scale, p)
    _, model.scale, p = best
    top, wrong = p.max(1), p.argmax(1) != y[test]
    order = np.argsort(-top)
    rate = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    ok = np.flatnonzero(rate <= error)
    model.reject = float(min(0.99, max(0.6, top[order][ok[-1]] if len(ok) else 0.99)))
    return model


def by_document(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, said, lang, confidence, segs) of docs (doc_id, text, lang), one row each; segs holds (seg_no, lang, confidence) of the paragraphs.

    Paragraphs are parted by blank lines. One that the model rejects (names, numbers, a few words) takes the main language, which is
    that of most letters of the accepted ones (of all, if none is). A text without letters has a null language and confidence 0, as
    have null and empty texts. Whole texts are read; nothing is shuffled. The model is fitted to docs' own labels unless given.
    """
    ship(docs.sparkSession)
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: buckets x dim
    seg = pa.list_(pa.struct([("seg_no", pa.int64()), ("lang", pa.string()), ("confidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, table = shared.value, {}
        for b in batches:
            texts = b.column(1).to_pylist()
            parts: list[str] = []
            ends = []
            for t in texts:
                if t:
                    parts += PARAGRAPH.split(normal(t))
                ends.append(len(parts))
            if len(table) > 400_000:
                table = {}
            mean, count = scores(m, parts, table)
            prob = confidences(m, mean, count) if parts else mean
            best, conf = (prob.argmax(1).tolist(), prob.max(1).tolist()) if parts else ([], [])
            main_of, sure_of, segs_of, at = [], [], [], 0
            for end in ends:
                span = range(at, end)
                weight, sure = [0.0] * len(LANGUAGES), [0.0] * len(LANGUAGES)
                for i in span:
                    if count[i]:
                        weight[best[i]] += len(parts[i]) * conf[i]
                        if conf[i] >= m.reject:
                            sure[best[i]] += len(parts[i])
                use = sure if any(sure) else weight
                if any(use):
                    main = max(range(len(LANGUAGES)), key=use.__getitem__)
                    own = [(conf[i], len(parts[i])) for i in span if count[i] and best[i] == main]
                    main_of.append(LANGUAGES[main])
                    sure_of.append(sum(c * n for c, n in own) / max(1, sum(n for _, n in own)))
                    taken = [best[i] if count[i] and conf[i] >= m.reject else main for i in span]
                    segs_of.append([{"seg_no": n, "lang": LANGUAGES[t], "confidence": float(prob[i][t]) if count[i] else 0.0} for n, (i, t) in enumerate(zip(span, taken), 1)])
                else:
                    main_of.append(None)
                    sure_of.append(0.0)
                    segs_of.append([{"seg_no": n, "lang": None, "confidence": 0.0} for n in range(1, len(span) + 1)])
                at = end
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(main_of, pa.string()), pa.array(sure_of, pa.float64()), pa.array(segs_of, seg)], names=["doc_id", "said", "lang", "confidence", "segs"])

    schema = "doc_id long, said string, lang string, confidence double, segs array<struct<seg_no:long,lang:string,confidence:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").mapInArrow(run, schema)


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, seg_no, lang, confidence): seg_no 0 is the document's main language, 1 and up its paragraphs' (see by_document)."""
    return by_document(docs, model).selectExpr("doc_id", "inline(concat(array(struct(0L as seg_no, lang, confidence)), segs))")


def label_findings(docs: DataFrame, inventory: DataFrame, model: Model | None = None) -> DataFrame:
    """(label_kind, doc_id, seg_no, lang): documents whose label (lang) or inventory hints (language_hints) do not name the main language, and all paragraphs of mixed documents.

    Documents without a recognisable language give no row; nor do inventory rows with a null doc_id or without their document. A document that
    the inventory lists several times is reported if any of its rows does not name the language; null hints name none.
    """
    named = F.transform(F.split(F.coalesce("language_hints", F.lit("")), r"[|,;/]"), label)
    mask = F.aggregate(F.array_distinct(named), F.lit(0), lambda acc, x: acc + F.coalesce(sum((F.when(x == c, 1 << i).otherwise(0) for i, c in enumerate(LANGUAGES)), F.lit(0)), F.lit(0)))
    hints = inventory.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.bit_and(mask).alias("named"))
    mixed = F.size(F.array_distinct(F.transform("segs", lambda s: s["lang"]))) > 1
    found = by_document(docs, model).where("lang is not null").select("doc_id", "lang", label(F.col("said")).alias("said"), F.when(mixed, F.transform("segs", lambda s: F.struct(F.lit("segment").alias("label_kind"), s["seg_no"].alias("seg_no"), s["lang"].alias("lang")))).alias("segs"))
    bit = F.create_map(*(F.lit(x) for i, c in enumerate(LANGUAGES) for x in (c, 1 << i)))[F.col("lang")]

    def row(kind: str, when: Column) -> Column:
        return F.when(when, F.array(F.struct(F.lit(kind).alias("label_kind"), F.lit(0).cast("long").alias("seg_no"), F.col("lang")))).otherwise(F.expr("cast(array() as array<struct<label_kind:string,seg_no:bigint,lang:string>>)"))

    rows = F.concat(
        row("lang", F.coalesce(F.col("said") != F.col("lang"), F.lit(True))),
        row("language_hints", F.col("named").isNotNull() & (F.col("named").bitwiseAND(bit) == 0)),
        F.coalesce("segs", F.expr("cast(array() as array<struct<label_kind:string,seg_no:bigint,lang:string>>)")),
    )
    return found.join(hints, "doc_id", "left").select("doc_id", F.inline(rows)).select("label_kind", "doc_id", "seg_no", "lang")
