"""Spelling variant grouping: words one edit apart, found by probing generated edits against Bloom filters.

The vocabulary is a table. Per length its words fill a shard of a blocked Bloom filter (``BITS`` a word, one
block of 256 bits a word); the shards are broadcast. Every word generates its one-letter deletions, which are
probed in the shard of the shorter length, and its replacements by later letters, probed in its own; an insertion
is the other word's deletion, so each pair is generated once. Only edits that a filter lets pass are built as
strings and shuffled to the exact join with the vocabulary, which drops what the filters let pass by chance.

Bounds: the filters of a pass hold ``FILTER_BYTES``; a larger vocabulary is probed in several passes, each
against a slice of it by hash, one broadcast alive at a time. The driver gets those filters, the word count per
length (lengths from ``LONGEST`` on share a shard) and the letters that occur. Forms double the count at each
step, so roots are found in six joins at most.

Defined results: null and empty texts have no words; a null doc_id is written as nothing before the colon; very
long texts are read whole and very long runs are words like others; rows that repeat count again; of several
nearest forms with the largest n the smallest in code-point order is taken; other columns stay out of the plan;
an empty table gives no rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import blocks, ensure_columns, map_arrow, written

LEAST_LETTERS = 5
LEAST_COUNT = 3
TYPO_EVERY = 97          # a run whose hash is divisible by it loses a letter

BITS = 16                # of the filter per word
LANES = 8                # of 32 bits: a block; each word sets one bit in each lane
FILTER_BYTES = 32 << 20  # of the filters of one pass
LONGEST = 64             # lengths from here on share a shard
FLUSH = 200_000          # words that a task counts before it hands them on
EDITS = 1 << 21          # edits that are probed at once

# One byte a letter: every code point of the runs is below 256, all others become "?".
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LETTERS)
_BASE = np.uint64(0x100000001B3)  # odd
_ODD = (np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


# --- vocabulary ---------------------------------------------------------------------------

def words_of(doc_id: int | None, text: str) -> Counter:
    """Occurrences of the words of one text, after the deletions that the hash orders."""
    found = Counter(_RUN.findall(text.encode("latin-1", "replace").lower()))
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    shorter = []
    for run in found:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % TYPO_EVERY == 0:
            shorter.append((run, h % len(run)))
    moved = [(run[:at] + run[at + 1:], found.pop(run)) for run, at in shorter]
    for word, n in moved:
        if len(word) >= LEAST_LETTERS:
            found[word] += n
    return found


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``least`` times or more in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        for batch in blocks(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                # words that stand in the same text twice after a deletion are added up
                counts.update(words_of(doc_id, text))
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    rows = ensure_columns(docs, {"doc_id": "long", "text": "string"})
    words = map_arrow(rows, run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- filters --------------------------------------------------------------------------------

def mixed(h: np.ndarray, length: int) -> np.ndarray:
    """Spreads a polynomial hash over 64 bits."""
    h = (h + np.uint64(length)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    """``_BASE`` to the powers n - 1 ... 0, modulo 2**64."""
    return np.concatenate((np.cumprod(np.full(max(0, n - 1), _BASE, np.uint64))[::-1], np.ones(min(n, 1), np.uint64)))


def by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in ``words``, matrix of their letters)."""
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        yield int(length), at, np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), length)


class Shards:
    """Where the blocks of each length lie in one array of blocks."""

    def __init__(self, counts: dict[int, int], slices: int):
        self.slices, self.first, self.size, at = slices, {}, {}, 0
        for length, n in sorted(counts.items()):
            self.first[length], self.size[length] = at, max(1, -(-n * BITS // (32 * LANES * slices)))
            at += self.size[length]
        self.blocks = at

    def part(self, h: np.ndarray) -> np.ndarray:
        """The slice of the vocabulary that a hash belongs to."""
        return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)) % np.uint64(self.slices)

    def block(self, h: np.ndarray, length: int) -> np.ndarray:
        shard = min(length, LONGEST)
        return self.first[shard] + ((h >> np.uint64(32)) * np.uint64(self.size[shard]) >> np.uint64(32)).astype(np.int64)


def lane_bits(h: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << (h.astype(np.uint32) * _ODD[lane] >> np.uint32(27))


def passing(filters: np.ndarray, shards: Shards, h: np.ndarray, length: int, number: int) -> np.ndarray:
    """Places of the hashes that the filters of slice ``number`` let pass."""
    if min(length, LONGEST) not in shards.first:
        return np.zeros(0, np.int64)
    at = np.arange(len(h)) if shards.slices == 1 else np.flatnonzero(shards.part(h) == number)
    h = h[at]
    block = shards.block(h, length)
    for lane in range(LANES):
        ok = (filters[block, lane] & lane_bits(h, lane)) != 0
        at, h, block = at[ok], h[ok], block[ok]
    return at


def build(words: DataFrame, shards: Shards, number: int) -> np.ndarray:
    """The filters of slice ``number``: every word sets its bits, equal blocks are or-ed in Spark."""
    lanes = [f"l{k}" for k in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for length, _, m in by_length([w.encode("latin-1") for w in batch.column("word").to_pylist()]):
                h = mixed((m * powers(length)).sum(1, dtype=np.uint64), length)
                h = h[shards.part(h) == number]
                parts.append((shards.block(h, length), [lane_bits(h, k).view(np.int32) for k in range(LANES)]))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[0] for p in parts]))] + [pa.array(np.concatenate([p[1][k] for p in parts])) for k in range(LANES)],
                    ["block", *lanes])

    rows = map_arrow(words.select("word"), run, "block long, " + ", ".join(f"{c} int" for c in lanes))
    got = rows.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in lanes]).toArrow()  # FILTER_BYTES at most
    filters = np.zeros((max(1, shards.blocks), LANES), np.uint32)
    for k, c in enumerate(lanes):
        filters[got.column("block").to_numpy(), k] = got.column(c).to_numpy().view(np.uint32)
    return filters


# --- edits ----------------------------------------------------------------------------------

def deletions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every row without its letter i, and whether (row, i) counts: of equal neighbours
    only the first is deleted."""
    n, length = m.shape
    wide = m.astype(np.uint64)
    front = np.zeros((n, length), np.uint64)
    if length > 1:
        front[:, 1:] = np.cumsum(wide[:, :-1] * powers(length - 1), axis=1, dtype=np.uint64)
    own = wide * powers(length)
    back = own.sum(1, dtype=np.uint64)[:, None] - np.cumsum(own, axis=1, dtype=np.uint64)
    first = np.ones((n, length), bool)
    first[:, 1:] = m[:, 1:] != m[:, :-1]
    return mixed(front + back, length - 1), first


def probe(m: np.ndarray, letters: np.ndarray, filters: np.ndarray, shards: Shards, number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, edited letters as a matrix) of the edits of the rows of ``m`` that pass."""
    n, length = m.shape
    h, counts = deletions(m)
    row, col = np.nonzero(counts)
    got = passing(filters, shards, h[row, col], length - 1, number)
    row, col = row[got], col[got]
    keep = np.arange(length - 1)[None, :]
    yield row, m[row[:, None], keep + (keep >= col[:, None])]
    scale = powers(length)
    whole = (m * scale).sum(1, dtype=np.uint64)
    step = max(1, EDITS // max(1, n * len(letters)))  # positions at once
    for lo in range(0, length, step):
        part = m[:, lo:lo + step]
        row, col, new = np.nonzero(letters[None, None, :] > part[:, :, None])
        change = letters[new].astype(np.uint64) - part[row, col].astype(np.uint64)
        got = passing(filters, shards, mixed(whole[row] + change * scale[lo + col], length), length, number)
        row, col, new = row[got], col[got] + lo, new[got]
        edited = m[row]
        edited[np.arange(len(row)), col] = letters[new]
        yield row, edited


def candidates(words: DataFrame, letters: np.ndarray, filters: Broadcast, shards: Shards, number: int) -> DataFrame:
    """(word, n, edit): the edits of every word that pass the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filters.value
        for batch in batches:
            n = batch.column("n").to_numpy()
            own = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            for length, at, all_rows in by_length(own):
                step = max(1, EDITS // (length * max(1, len(letters))))
                for lo in range(0, len(at), step):
                    for row, edited in probe(all_rows[lo:lo + step], letters, bits, shards, number):
                        if len(row):
                            text, wide = edited.tobytes().decode("latin-1"), edited.shape[1]
                            from_ = at[lo + row]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([own[i].decode("latin-1") for i in from_], pa.string()), pa.array(n[from_]),
                                 pa.array([text[k:k + wide] for k in range(0, len(text), wide)], pa.string())], ["word", "n", "edit"])

    return map_arrow(words.select("word", "n"), run, "word string, n long, edit string")


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of words of the vocabulary one edit apart, once. ``words``
    is a written table (word, n)."""
    size = F.least(F.length("word"), F.lit(LONGEST))
    counts = {r["len"]: r["n"] for r in words.groupBy(size.alias("len")).agg(F.count(F.lit(1)).alias("n")).collect()}  # LONGEST rows

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(256, bool)
        for batch in batches:
            marks[np.frombuffer("".join(batch.column("word").to_pylist()).encode("latin-1"), np.uint8)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(marks))], ["letter"])

    found = map_arrow(words.select("word"), seen, "letter long").distinct().collect()  # 256 rows at most
    letters = np.array(sorted(r["letter"] for r in found), np.uint8)
    slices = max(1, -(-sum(counts.values()) * BITS // (8 * filter_bytes)))
    shards = Shards(counts, slices)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    out = None
    for number in range(slices):
        filters = words.sparkSession.sparkContext.broadcast(build(words, shards, number))
        some = candidates(words, letters, filters, shards, number).join(exact, F.col("edit") == F.col("near"))
        pairs = written(some.select("word", "n", "near", "near_n"), "near-words")
        filters.destroy()
        out = pairs if out is None else out.unionByName(pairs)
    return out


# --- forms and roots --------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form): forms followed to the last, by pointer
    doubling. Each step doubles n, a 64-bit count, so six rounds reach every root."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(6):
        onward = at.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        step = at.join(onward, at["root"] == onward["_word"], "left")
        after = written(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_on")), "roots")
        at = after.select("word", "root")
        if after.where("_on").limit(1).count() == 0:
            break
    return at


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary of ``docs``."""
    words = written(vocabulary(docs), "vocabulary")
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("_best"))
    large = -F.col("_best.k") >= 2 * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, F.col("_best.near")).alias("form"), F.when(large, -F.col("_best.k")).alias("form_n"))
    found = written(found, "forms")
    last = roots(found.where(F.col("form").isNotNull()))
    return found.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
