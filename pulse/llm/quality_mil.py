"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded: shares of character
classes and of pairs of neighbouring classes, word lengths, and how many of its words and word pairs are
repeated in the passage and in the document. The model is trained from document labels only: passage
vectors pass a hidden layer, gated attention (tanh times sigmoid) gives each passage a weight that sums to
one over its document, and the weighted mean goes through a logistic unit. It scores every passage of every
whole text.

Learning uses a bounded, documented sample of labelled documents, the same one at any partitioning: at most
``TRAIN_DOCS`` per class, those with the smallest hash of doc_id, and of these, in that order, as many as fit into
``TRAIN_PASSAGES`` passages in all. A document is learned from whole or not at all; scoring has no such bound. The
training set, some 90 MB at most, is fitted with numpy on the driver, in full batches with fixed
seeds. Class weights are even, and the intercept is corrected afterwards for the labels' real shares, so the
score is a probability.

Defined results: null, empty and blank texts are a bag of one empty passage and get a score like any other; with
no labels, or labels of one class only, every score is the smoothed share of label 1; labels other than
0 and 1 and null labels are not learned from; of several labels of a document the largest counts, of several texts of
a labelled doc_id the one with the smallest hash; very long texts are scored whole; null doc_id is held out; repeated rows each get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import blocks, ensure_columns, map_arrow, written
from pulse.llm.line_dedup import mix

PASSAGE_WORDS = 64
TRAIN_DOCS, TRAIN_PASSAGES = 2000, 120_000
HIDDEN, GATE, STEPS, RATE, DECAY, SEED = 24, 12, 150, 0.02, 1e-3, 11
THRESHOLD = 0.3
# Classes of characters: white space, lower, upper, digit, other letters, then punctuation by kind (fixed values).
_KINDS = ["\t\n\x0b\x0c\r \x85\xa0 　", ".!?", ",;:", "'\"`´‘’“”«»", "()[]{}", "<>|\\/", "#*$%&@^~", "-_+="]
_WORD = re.compile(f"[^{_KINDS[0]}]+")
CLASSES = 5 + len(_KINDS)
EXTRA = 9
FEATURES = CLASSES + CLASSES * CLASSES + EXTRA


def _class_table() -> np.ndarray:
    """Class of every code point below 65536; a supplementary one counts as another letter."""
    table = np.full(0x10000, 4, np.uint8)
    for c in range(0x250):
        x = chr(c)
        table[c] = 1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else 4 if x.isalpha() else CLASSES - 1
    for k, chars in enumerate(_KINDS):
        for x in chars:
            table[ord(x)] = 0 if k == 0 else 4 + k
    return table


_CLASS: list[np.ndarray] = []


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of all texts, one after the other, and the number of passages of each (at least
    one). Array work over the code points of all texts together."""
    if not _CLASS:
        _CLASS.append(_class_table())
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    doc_end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    kind = _CLASS[0][np.minimum(codes, 0xFFFF)]
    blank = kind == 0
    begin = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))  # words
    end = np.flatnonzero(~blank & np.concatenate((blank[1:], [True]))) + 1
    word_doc = np.searchsorted(doc_end, begin, side="right")
    words_of = np.bincount(word_doc, minlength=len(texts))
    passages = np.maximum(1, -(-words_of // PASSAGE_WORDS))
    first_word = np.cumsum(words_of) - words_of
    first_passage = np.cumsum(passages) - passages
    total = int(passages.sum())
    x = np.zeros((total, FEATURES), np.float32)
    if not len(begin):
        return x, passages
    word_passage = first_passage[word_doc] + (np.arange(len(begin)) - first_word[word_doc]) // PASSAGE_WORDS
    # characters of words, and the one blank behind each
    size = end - begin
    # a passage's characters run from its first word to its last word's end
    p_first = np.flatnonzero(np.concatenate(([True], word_passage[1:] != word_passage[:-1])))
    which = word_passage[p_first]
    a, b = begin[p_first], end[np.append(p_first[1:], len(begin)) - 1]
    char_passage = np.full(len(codes), -1, np.int64)
    char_passage[a] = which  # spread each passage over its characters
    marks = np.zeros(len(codes) + 1, np.int64)
    marks[a] += 1
    np.add.at(marks, b, -1)
    inside = np.cumsum(marks[:-1]) > 0
    run = np.searchsorted(a, np.flatnonzero(inside), side="right") - 1
    owner, kinds = which[run], kind[inside].astype(np.int64)
    length = np.bincount(owner, minlength=total).astype(np.float64)
    share = np.maximum(length, 1)[:, None]
    x[:, :CLASSES] = np.bincount(owner * CLASSES + kinds, minlength=total * CLASSES).reshape(total, CLASSES) / share
    same = owner[1:] == owner[:-1]
    pair = (owner[1:] * CLASSES + kinds[:-1]) * CLASSES + kinds[1:]
    cells = CLASSES * CLASSES
    x[:, CLASSES:CLASSES + cells] = np.bincount(pair[same], minlength=total * cells).reshape(total, cells) / share
    # words: a hash each, their lengths and repetitions
    with np.errstate(over="ignore"):
        spread = mix(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        power = np.cumprod(np.full(int(size.max()) + 1, 0xD1342543DE82EF95, np.uint64), dtype=np.uint64)
        place = np.zeros(len(codes), np.int64)
        place[~blank] = np.arange(len(codes))[~blank] - np.repeat(begin, size)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(np.where(blank, np.uint64(0), spread * power[place]), dtype=np.uint64)))
        word = mix(sums[end] - sums[begin])
        two = mix(word[:-1] * np.uint64(0xD1342543DE82EF95) + word[1:]) if len(word) > 1 else word[:0]
    n = np.bincount(word_passage, minlength=total).astype(np.float64)
    n1 = np.maximum(n, 1)
    e = CLASSES + cells
    mean = np.bincount(word_passage, size, total) / n1
    x[:, e] = np.minimum(mean, 30) / 10
    x[:, e + 1] = np.sqrt(np.maximum(np.bincount(word_passage, size.astype(np.float64) ** 2, total) / n1 - mean ** 2, 0)).clip(0, 30) / 10
    x[:, e + 2] = np.log1p(n) / 4
    one_doc = word_doc[1:] == word_doc[:-1]
    for k, (value, group, where) in enumerate(((word, word_passage, word_passage), (word, word_doc, word_passage),
                                               (two[one_doc], word_passage[:-1][one_doc], word_passage[:-1][one_doc]),
                                               (two[one_doc], word_doc[:-1][one_doc], word_passage[:-1][one_doc]))):
        if len(value):
            x[:, e + 3 + k] = np.bincount(where, _again(value, group), total) / n1
    x[:, e + 7] = (np.bincount(word_passage, size <= 2, total) / n1)
    x[:, e + 8] = np.log1p(np.repeat(words_of, passages)) / 8
    return x, passages


def _again(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """1 where an equal value stands in the same group elsewhere."""
    with np.errstate(over="ignore"):
        key = mix(value + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    s = key[order]
    eq = s[1:] == s[:-1]
    out = np.zeros(len(key), np.float64)
    out[order[1:][eq]] = 1
    out[order[:-1][eq]] = 1
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]
    shift: float
    constant: float | None = None  # nothing to learn from

    def score(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(sizes), self.constant)
        out = _forward(self.w, ((x - self.mean) / self.scale).clip(-8, 8), sizes)
        return 1 / (1 + np.exp(-(out["logit"].astype(np.float64) + self.shift).clip(-40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    starts = np.cumsum(sizes) - sizes
    h = np.tanh(x @ w["wh"] + w["bh"])
    t, g = np.tanh(h @ w["v"] + w["bv"]), 1 / (1 + np.exp(-(h @ w["u"] + w["bu"])))
    a = (t * g) @ w["a"]
    a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), sizes))
    a = a / np.repeat(np.add.reduceat(a, starts), sizes)
    z = np.add.reduceat(h * a[:, None], starts, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ w["c"] + w["b"][0]}


def fit(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, positive: float) -> Model:
    """Gated attention pooling, full-batch Adam. ``positive``: the labels' real share of 1."""
    mean, scale = x.mean(axis=0, dtype=np.float64).astype(np.float32), x.std(axis=0, dtype=np.float64).astype(np.float32)
    scale = np.where(scale > 1e-4, scale, np.float32(1))
    x = ((x - mean) / scale).clip(-8, 8)
    rng = np.random.Generator(np.random.PCG64(SEED))
    init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    w = {"wh": init(x.shape[1], HIDDEN), "bh": np.zeros(HIDDEN, np.float32), "v": init(HIDDEN, GATE), "bv": np.zeros(GATE, np.float32),
         "u": init(HIDDEN, GATE), "bu": np.zeros(GATE, np.float32), "a": init(GATE), "c": init(HIDDEN), "b": np.zeros(1, np.float32)}
    share = y.mean()
    weight = (np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)).astype(np.float32)
    m = {k: np.zeros_like(p) for k, p in w.items()}
    s = {k: np.zeros_like(p) for k, p in w.items()}
    for step in range(1, STEPS + 1):
        o = _forward(w, x, sizes)
        d = ((1 / (1 + np.exp(-o["logit"].clip(-40, 40))) - y) * weight).astype(np.float32)
        dz = np.outer(d, w["c"])
        dz_each = np.repeat(dz, sizes, axis=0)
        dh = dz_each * o["a"][:, None]
        da = (dz_each * o["h"]).sum(axis=1)
        da = o["a"] * (da - np.repeat(np.add.reduceat(da * o["a"], np.cumsum(sizes) - sizes), sizes))
        dtg = np.outer(da, w["a"])
        dt, dg = dtg * o["g"] * (1 - o["t"] ** 2), dtg * o["t"] * o["g"] * (1 - o["g"])
        dh = (dh + dt @ w["v"].T + dg @ w["u"].T) * (1 - o["h"] ** 2)
        grads = {"wh": x.T @ dh, "bh": dh.sum(0), "v": o["h"].T @ dt, "bv": dt.sum(0), "u": o["h"].T @ dg, "bu": dg.sum(0),
                 "a": (o["t"] * o["g"]).T @ da, "c": o["z"].T @ d, "b": np.array([d.sum()])}
        for k, grad in grads.items():
            if w[k].ndim == 2 or k == "c":
                grad = grad + DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            s[k] = 0.999 * s[k] + 0.001 * grad ** 2
            w[k] = w[k] - np.float32(RATE) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, w, float(np.log(positive / (1 - positive))))


def held_out() -> F.Column:
    """crc32(doc_id as text) mod 5 is 0; such labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """A model from the labels of documents that are not held out."""
    labels = (ensure_columns(labels, {"doc_id": "long", "quality": "int"}).where(~held_out() & F.col("quality").isin(0, 1))
              .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    labels = written(labels, "labels")
    number = {r["quality"]: r["n"] for r in labels.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = number.get(1, 0), number.get(0, 0)
    if not ones or not zeros:
        return Model(np.zeros(0), np.zeros(0), {}, 0.0, (ones + 1) / (ones + zeros + 2))
    chosen = None
    for q in (0, 1):  # a top-k by hash per class: bounded whatever the number of labels
        part = labels.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(written(chosen, "chosen"))  # at most 2 * train_docs rows
    rows = ensure_columns(docs, {"doc_id": "long", "text": "string"}).join(chosen, "doc_id")
    rows = (rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
            .select("doc_id", "quality", "one.text"))
    rows = written(rows, "chosen-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sizes = [max(1, -(-len(_WORD.findall(t)) // PASSAGE_WORDS)) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": block.column("doc_id"), "k": block.column("k"), "n": pa.array(sizes, pa.int64())})

    room, taken = TRAIN_PASSAGES, []
    found = map_arrow(rows.select("doc_id", F.xxhash64("doc_id").alias("k"), "text"), count, "doc_id long, k long, n long")
    for r in sorted(found.collect(), key=lambda r: (r["k"], r["doc_id"])):  # at most 2 * train_docs rows
        if r["n"] <= room:
            room -= r["n"]
            taken.append(r["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            x, sizes = encode(block.column("text").to_pylist())
            ends = np.cumsum(sizes)
            vectors = [x[e - n:e].astype(np.float32).tobytes() for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_pydict({"doc_id": block.column("doc_id"), "quality": block.column("quality"), "x": pa.array(vectors, pa.binary())})

    learned = rows.where(F.col("doc_id").isin(taken)).select("doc_id", "quality", "text")
    got = map_arrow(learned, run, "doc_id long, quality int, x binary").collect()
    got.sort(key=lambda r: r["doc_id"])  # the same order at any partitioning
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in got]
    y = np.array([r["quality"] for r in got], np.float64)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0), np.zeros(0), {}, 0.0, (ones + 1) / (ones + zeros + 2))
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]), y, ones / (ones + zeros))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted, n_passages) of all documents, from whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for block in blocks(batches, "text", 2 << 20):
            x, sizes = encode(block.column("text").to_pylist())
            s = model.score(x, sizes)
            yield pa.RecordBatch.from_pydict({"doc_id": block.column("doc_id"), "held_out": block.column("held_out"), "score": pa.array(s, pa.float64()),
                                              "predicted": pa.array((s >= threshold).astype(np.int32)), "n_passages": pa.array(sizes, pa.int64())})

    rows = ensure_columns(docs, {"doc_id": "long", "text": "string"}).withColumn("held_out", held_out())
    return map_arrow(rows, run, "doc_id long, held_out boolean, score double, predicted int, n_passages long")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
