"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (a function of its code point). A trigram is bound from
its letters: the first vector rotated by two places, the second by one, the third as it is,
multiplied. A text is the sum of its trigram vectors (runs of non-letters count as one blank), a
language the sum of its learning texts. The prediction is the language with the largest cosine.

Learning adds up integers, so its result does not depend on partitions: every task adds the
vectors of its texts per language, Spark sums them per language and dimension, and the driver holds
``DIMENSIONS`` numbers per language. The number of languages is checked (``MAX_LANGUAGES``).

Defined results: a text that is null or has no letter is ``und`` with score 0, so is every text when
nothing can be learned; ties go to the language that sorts first; repeated rows and null doc_id get a
row each (a null doc_id counts as held out, for it has no digest); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import blocks, ensure_columns, map_arrow, worker_state

DIMENSIONS, SEED, MAX_LANGUAGES = 1024, 20240115, 5000
BLOCK_BYTES, DENSE_CELLS, VOCABULARY = 2 << 20, 4 << 20, 4096
UNKNOWN = "und"


class Letters:
    """Numbers and vectors of the letters met so far; 0 is the blank. One per Python worker."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.number = np.full(0x110000, -1, np.int32)  # -1: not met yet
        self.vectors = np.empty((64, dimensions), np.float32)
        self.known = 0
        self._add(0)

    def _add(self, code: int) -> int:
        if self.known == len(self.vectors):
            self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
        bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(0, 2, self.dimensions, np.int8)
        self.vectors[self.known] = 2 * bits - 1
        self.known += 1
        return self.known - 1

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        got = self.number[codes]
        if (got < 0).any():
            for c in np.unique(codes[got < 0]).tolist():
                self.number[c] = self._add(c) if chr(c).isalpha() else 0
            got = self.number[codes]
        return got

    def trigrams(self, keys: np.ndarray) -> np.ndarray:
        """Bound vectors of trigrams (letter numbers a, b, c as a << 42 | b << 21 | c)."""
        a, b, c = keys >> 42, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF
        return np.roll(self.vectors[a], 2, 1) * np.roll(self.vectors[b], 1, 1) * self.vectors[c]


def letters(dimensions: int, seed: int) -> Letters:
    """One table for each Python worker; begun anew when a worker has met very many letters."""
    table = worker_state(("letters", dimensions, seed), lambda: Letters(dimensions, seed))
    if table.known > 50_000:
        table.__init__(dimensions, seed)
    return table


def counts(texts: list[str | None], table: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct trigrams of some texts, and per (text, trigram) the count: keys, text, index
    into keys, count. Whole texts; a text without letters has none."""
    lowered = [(x or "").lower() for x in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    ends = np.cumsum(sizes + 2) if len(sizes) else sizes
    # a blank before and after each text
    flat = table.numbers(np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le"), np.uint32)).astype(np.int64)
    owner = np.repeat(np.arange(len(lowered)), sizes + 2)
    keep = np.concatenate(([True], (flat[1:] != 0) | (flat[:-1] != 0) | (owner[1:] != owner[:-1])))  # blanks run together
    flat, owner = flat[keep], owner[keep]
    if len(flat) < 3:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    whole = owner[2:] == owner[:-2]
    # numbers of at most 2^21 letters, so three fit in 63 bits
    size = int(flat.max()) + 1
    key = (flat[:-2] << 42 | flat[1:-1] << 21 | flat[2:])[whole]
    owner = owner[2:][whole]
    if size ** 3 <= DENSE_CELLS:  # few letters: number the trigrams by a table instead of a sort
        small = ((flat[:-2] * size + flat[1:-1]) * size + flat[2:])[whole]
        seen = np.bincount(small, minlength=size ** 3) > 0
        keys = np.flatnonzero(seen)
        place = np.cumsum(seen)[small] - 1
        keys = (keys // (size * size)) << 42 | (keys // size % size) << 21 | keys % size
    else:
        keys, place = np.unique(key, return_inverse=True)
    width = len(keys)
    if width * len(texts) <= 4 * DENSE_CELLS:
        cells = np.bincount(owner * width + place, minlength=width * len(texts))
        cell = np.flatnonzero(cells)
        number = cells[cell]
    else:
        cell, number = np.unique(owner * width + place, return_counts=True)
    return keys, cell // max(width, 1), cell % max(width, 1), number


def _weighted(keys, row, col, number, rows: int, table: Letters, only: np.ndarray | None = None) -> np.ndarray:
    """Sum of count times trigram vector per row, a slice of the trigrams at a time."""
    out = np.zeros((rows, table.dimensions), np.float64)
    order = np.argsort(col, kind="stable")
    row, col, number = row[order], col[order], number[order]
    for lo in range(0, len(keys), VOCABULARY):
        hi = min(lo + VOCABULARY, len(keys))
        a, b = np.searchsorted(col, [lo, hi])
        for r in range(0, rows, 512):  # bounded dense blocks
            pick = (row[a:b] >= r) & (row[a:b] < r + 512)
            if pick.any():
                dense = np.zeros((min(512, rows - r), hi - lo), np.float32)
                dense[row[a:b][pick] - r, col[a:b][pick] - lo] = number[a:b][pick]
                out[r:r + 512] += dense @ table.trigrams(keys[lo:hi])
    return out


def bundles(texts: list[str | None], table: Letters) -> np.ndarray:
    """The hyperdimensional vector of each text."""
    return _weighted(*counts(texts, table), len(texts), table)


def learning_rows() -> F.Column:
    """Documents whose language may be learned from: crc32(doc_id as text) mod 3 is not 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.lit(False))


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Language -> prototype, from all rows of ``docs`` (text, lang) with a language."""
    rows = ensure_columns(docs, {"text": "string", "lang": "string"}).where("text is not null and lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = letters(dimensions, seed), {}
        for block in blocks(batches, "text", BLOCK_BYTES):
            langs = block.column("lang").to_pylist()
            names = sorted(set(langs))
            keys, row, col, number = counts(block.column("text").to_pylist(), table)
            at = {x: k for k, x in enumerate(names)}
            place = np.fromiter((at[x] for x in langs), np.int64, len(langs))
            cell = place[row] * max(len(keys), 1) + col  # the counts of a language, added up first
            cells, inv = np.unique(cell, return_inverse=True)
            total = np.bincount(inv, number).astype(np.int64) if len(cell) else cells
            got = _weighted(keys, cells // max(len(keys), 1), cells % max(len(keys), 1), total, len(names), table)
            for x, v in zip(names, np.rint(got).astype(np.int64)):
                sums[x] = sums[x] + v if x in sums else v
            if len(sums) > 256:  # many languages: hand on what there is
                yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": pa.array(list(sums.values()), pa.list_(pa.int64()))})
                sums = {}
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": pa.array(list(sums.values()), pa.list_(pa.int64()))})

    parts = map_arrow(rows, run, "lang string, v array<bigint>", state=True).select("lang", F.posexplode("v").alias("i", "x"))
    summed = parts.groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found = summed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))
    got = found.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is lang a language?")
    return {r["lang"]: np.array(r["v"], np.float64) for r in got if any(r["v"])}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score): the whole text against all prototypes."""
    names = sorted(prototypes)
    unit = np.array([prototypes[x] / np.linalg.norm(prototypes[x]) for x in names]) if names else np.zeros((0, dimensions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters(dimensions, seed)
        for block in blocks(batches, "text", BLOCK_BYTES):
            texts = block.column("text").to_pylist()
            lettered = np.fromiter((any(map(str.isalpha, x)) for x in texts), bool, len(texts))
            vectors = bundles(texts, table)
            norms = np.linalg.norm(vectors, axis=1)
            known = lettered & (norms > 0) & bool(names)
            cosine = (vectors @ unit.T) / np.maximum(norms, 1e-9)[:, None] if names else np.zeros((len(texts), 1))
            best = cosine.argmax(axis=1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": block.column("doc_id"), "held_out": block.column("held_out"),
                "lang_pred": [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())],
                "score": pa.array(np.where(known, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0))})

    rows = ensure_columns(docs, {"doc_id": "long", "text": "string"}).withColumn("held_out", ~learning_rows())
    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double", state=True)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the learning rows of ``docs`` and predicts all of its rows."""
    return predict(docs, learn(docs.where(learning_rows())))
