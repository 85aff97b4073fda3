"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are words (split at white space, punctuation at their ends cut, lower case; each letter of a
script written without spaces is a word). An item of n words is found where some run of a text's words is
within ``floor(max_rate * n)`` word edits of it; an item of fewer than ``min_item_words`` words where a run
equals it (at the default rate that is the same), by hashes of all runs of its size, compared word by word.

Where a window has fewer word pairs of items than that bound leaves in common with an item (an edit destroys
two pairs at most), it is passed over; this loses nothing.
For the others the CGK random walk maps edit distance to Hamming distance: step j shows the word the walk
stands on and moves on if a random bit of (j, word) says so, so two texts run in step again after an edit.
Windows have the items' sizes, in classes; one walk serves all classes, as a smaller window's walk is a
prefix. A table samples ``BITS`` steps; ``tables`` many, so that a window whose steps agree at a rate of
``AGREEMENT`` meets its item with probability ``recall``. Windows and items that share a key are verified
by the exact edit distance of the item to any run of the words around the window.

Items go to the tasks in blocks of at most ``BLOCK_CHARS`` characters (the text is read once per block), so
a task's memory does not grow with the benchmark. No shuffle: whole texts are searched where they are read.

Defined results: null or empty texts match nothing; items without words
match nothing; equal items are found as one each; repeated rows and null ids give rows like any
other; empty tables give no rows; other columns are ignored (or pass through, in :func:`clean`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import blocks, encode_words, ensure_columns, map_arrow, worker_state, written
from pulse.llm.line_dedup import _TRIM, mix, normal_words, split_words

MAX_RATE, MIN_ITEM_WORDS = 0.2, 5
RECALL, AGREEMENT, BITS, WALKS, SEED = 0.99, 0.45, 3, 2, 7
BLOCK_CHARS = 32 << 20
_Q = np.uint64(0x9E3779B97F4A7C15)


class Items:
    """What a task needs of a block of items: word and pair vocabularies, and the LSH tables."""

    def __init__(self, rows: list[tuple[int | None, str | None]], max_rate: float = MAX_RATE, recall: float = RECALL,
                 min_words: int = MIN_ITEM_WORDS):
        self.ids, self.words, seen = [], [], set()
        for item, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
            words = normal_words(text or "")
            if words and (item, tuple(words)) not in seen:
                seen.add((item, tuple(words)))
                self.ids.append(item)
                self.words.append(words)
        names = sorted({w for ws in self.words for w in ws})
        self.number = {w: k + 2 for k, w in enumerate(names)}  # 0: a word of no item, 1: behind the end
        self.codes = [np.array([self.number[w] for w in ws], np.int64) for ws in self.words]
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.floor(max_rate * self.sizes + 1e-9).astype(np.int64)
        if not self.ids:
            return
        self.span = len(names) + 2
        self.short = {}  # size -> (hashes of the items of that size, sorted; the items)
        for size in np.unique(self.sizes[self.sizes < min_words]).tolist():
            mine = np.flatnonzero(self.sizes == size)
            self.edits[mine] = 0
            keys = self.run_keys(np.concatenate([self.codes[i] for i in mine]), size)[::size]
            order = np.argsort(keys, kind="stable")
            self.short[size] = keys[order], mine[order]
        long = np.flatnonzero(self.sizes >= min_words)
        self.classes = []
        if not len(long):
            return
        self.pairs = np.unique(np.concatenate([self.codes[i][:-1] * self.span + self.codes[i][1:] for i in long]))
        # size classes, a quarter apart; an item is embedded by its first words, as many as its class has
        size = int(self.sizes[long].min())
        while size <= self.sizes.max():
            self.classes.append(size)
            size = max(size + 1, size * 5 // 4)
        self.class_of = np.searchsorted(self.classes, self.sizes, side="right") - 1
        # A run within k edits of an item of n words has at most n + k words and keeps n - 1 - 2k of the
        # item's pairs. For each class: the fewest such pairs, and the widest such run.
        of = [(self.class_of == k) & (self.sizes >= min_words) for k in range(len(self.classes))]
        self.least = [max(1, int((self.sizes[m] - 1 - 2 * self.edits[m]).min())) if m.any() else 1 << 30 for m in of]
        self.reach = [int((self.sizes[m] + self.edits[m]).max()) if m.any() else 1 for m in of]
        self.tables = math.ceil(math.log(1 - recall) / math.log(1 - AGREEMENT ** BITS) / WALKS)
        rng = np.random.Generator(np.random.PCG64(SEED))
        self.steps = [[np.sort(rng.choice(2 * c, BITS, replace=False)) for _ in range(self.tables * WALKS)] for c in self.classes]
        keys, owner = [], []
        for k in range(len(self.classes)):
            mine = np.flatnonzero(of[k])
            if len(mine):
                flat = np.concatenate([self.codes[i] for i in mine])
                ends = np.cumsum(self.sizes[mine])
                got = self.embed(flat, ends - self.sizes[mine], ends, k)
                keys.append(got.ravel())
                owner.append(np.tile(mine, len(got)))
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        bits = min(26, max(16, int(len(keys)).bit_length() + 4))
        self.sieve, self.sieve_shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
        self.sieve[self.keys >> self.sieve_shift] = True

    def embed(self, words: np.ndarray, starts: np.ndarray, limits: np.ndarray, k: int) -> np.ndarray:
        """The LSH keys (table, window) of the windows at ``starts`` for class ``k``. ``limits``: the end
        of the text that each window is in."""
        size, number = self.classes[k], self.tables * WALKS
        out = np.zeros((number, len(starts)), np.uint64)
        # behind the words, and behind the window, the walk stands on the end mark
        inside = np.minimum(limits, starts + size)
        padded = np.append(words, 1).astype(np.uint64) * _Q
        end = len(words)
        with np.errstate(over="ignore"):
            for walk in range(WALKS):
                wanted: dict[int, list[int]] = {}
                for t in range(walk * self.tables, (walk + 1) * self.tables):
                    for j in self.steps[k][t].tolist():
                        wanted.setdefault(j, []).append(t)
                at = starts.copy()
                for j in range(max(wanted) + 1):
                    shown = mix(padded[np.where(at < inside, at, end)] + np.uint64(j * WALKS + walk))
                    for t in wanted.get(j, ()):
                        out[t] *= _Q
                        out[t] += shown
                    at += (shown >> np.uint64(17) & np.uint64(1)).astype(np.int64)
            return mix(out + mix(np.arange(number, dtype=np.uint64) + np.uint64(1000 * (k + 1)))[:, None])

    def run_keys(self, words: np.ndarray, size: int) -> np.ndarray:
        """A hash of each run of ``size`` words."""
        n = max(0, len(words) - size + 1)
        out = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                out = mix(out * _Q + words[k:k + n].astype(np.uint64))
        return out

    def exact(self, words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """The rows of :meth:`search` for the short items: the first run that equals the item."""
        begins = np.concatenate(([0], ends[:-1]))
        first: dict[tuple[int, int], int] = {}
        for size, (keys, owner) in self.short.items():
            run = self.run_keys(words, size)
            left, right = np.searchsorted(keys, run, side="left"), np.searchsorted(keys, run, side="right")
            at = np.flatnonzero(right > left)
            text = np.searchsorted(ends, at, side="right")
            inside = at + size <= ends[text]
            at, text = at[inside], text[inside]
            _, once = np.unique(np.stack((text, run[at].view(np.int64)), 1), axis=0, return_index=True)  # the first of each text and run
            for s, t in zip(at[once].tolist(), text[once].tolist()):
                for item in owner[left[s]:right[s]].tolist():
                    places = [s] if np.array_equal(words[s:s + size], self.codes[item]) else at[(text == t) & (run[at] == run[s])]
                    hit = next((int(a) for a in places if np.array_equal(words[a:a + size], self.codes[item])), None)
                    if hit is not None:
                        first[t, item] = hit - int(begins[t])
        return [(t, item, 0, a, a + int(self.sizes[item])) for (t, item), a in sorted(first.items())]

    def windows(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Starts of the windows that may hold an item, and for each class which of them. ``words``: codes
        of all texts, ``ends``: where each text ends."""
        n = len(words)
        known = np.zeros(n, np.int64)
        both = np.flatnonzero((words[:-1] > 1) & (words[1:] > 1)) if n > 1 else np.zeros(0, np.int64)
        if len(both):
            pair = words[both] * self.span + words[both + 1]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            both = both[self.pairs[place] == pair]
            known[both] = 1
            known[ends[(ends > 0) & (ends <= n)] - 1] = 0  # not across texts
        sums = np.concatenate(([0], np.cumsum(known)))
        if not sums[-1]:
            return both[:0], []
        starts = np.flatnonzero(sums[np.minimum(np.arange(n) + max(self.reach), n)] - sums[:-1] >= min(self.least))
        fits = [sums[np.minimum(starts + reach - 1, n)] - sums[starts] >= least for reach, least in zip(self.reach, self.least)]
        some = np.logical_or.reduce(fits) if len(starts) else np.zeros(0, bool)
        return starts[some], [f[some] for f in fits]

    def search(self, words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified (text, item, edits, first word, end) of all texts: the best run per text and item."""
        if not self.classes:
            return self.exact(words, ends)
        starts, fits = self.windows(words, ends)
        found: dict[tuple[int, int], set[int]] = {}
        for lo in range(0, len(starts), 1 << 15):
            at = starts[lo:lo + (1 << 15)]
            text = np.searchsorted(ends, at, side="right")
            classes = [k for k in range(len(self.classes)) if self.least[k] < 1 << 30 and fits[k][lo:lo + (1 << 15)].any()]
            for k in classes:
                pick = np.flatnonzero(fits[k][lo:lo + (1 << 15)])
                keys = self.embed(words, at[pick], ends[text[pick]], k)
                t, w = np.nonzero(self.sieve[keys >> self.sieve_shift])
                key = keys[t, w]
                left, right = np.searchsorted(self.keys, key, side="left"), np.searchsorted(self.keys, key, side="right")
                for x in np.flatnonzero(right > left).tolist():
                    s = int(at[pick[w[x]]])
                    for item in set(self.owner[left[x]:right[x]].tolist()):
                        found.setdefault((int(text[pick[w[x]]]), item), set()).add(s)
        begins = np.concatenate(([0], ends[:-1]))
        out = self.exact(words, ends)
        for (text, item), places in sorted(found.items()):
            n, edits, best = int(self.sizes[item]), int(self.edits[item]), None
            reach = 0  # windows that overlap are verified as one region
            region: list[int] = []
            for s in [*sorted(places), 1 << 62]:
                if region and s > reach:
                    a = max(int(begins[text]), region[0] - n)
                    b = min(int(ends[text]), region[-1] + 2 * n + edits)
                    hit = nearest_run(self.codes[item], words[a:b], edits)
                    if hit and (best is None or hit[0] < best[0]):
                        best = (hit[0], a + hit[1] - int(begins[text]), a + hit[2] - int(begins[text]))
                    region = []
                region.append(s)
                reach = s + n
            if best:
                out.append((text, item, *best))
        return out


def nearest_run(item: np.ndarray, words: np.ndarray, bound: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the run of ``words`` nearest to ``item`` by edit distance, if within
    ``bound``; the first of several."""
    n, m = len(item), len(words)
    cost = np.zeros(m + 1, np.int64)  # an empty prefix of the item ends anywhere for nothing
    begin = np.arange(m + 1)
    for i in range(1, n + 1):
        diagonal = np.concatenate(([1 << 30], cost[:-1] + (words != item[i - 1])))
        down = cost + 1
        new = np.minimum(diagonal, down)
        start = np.where(diagonal <= down, np.concatenate(([0], begin[:-1])), begin)
        # a step to the right costs one: running minimum of (cost - column)
        slope = new - np.arange(m + 1)
        low = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == low, np.arange(m + 1), 0))
        better = low < slope
        begin = np.where(better, start[source], start)
        cost = np.where(better, low + np.arange(m + 1), new)
        if cost.min() > bound:
            return None
    end = int(cost.argmin())
    return (int(cost[end]), int(begin[end]), end) if cost[end] <= bound else None


def _codes(texts: pa.Array, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Item word numbers of all texts, one after the other, and where each text ends."""
    split = split_words(texts)
    ends = split.offsets.to_numpy().astype(np.int64)
    codes, words = encode_words(split.values.slice(ends[0], ends[-1] - ends[0]))
    table = np.empty(len(words), np.int64)
    get = items.number.get
    for k, w in enumerate(words.to_pylist()):
        w = w.strip(_TRIM)
        table[k] = get(w.lower(), 0) if w else -1
    got = table[codes] if len(codes) else np.zeros(0, np.int64)
    real = got >= 0
    return got[real], np.concatenate(([0], np.cumsum(real)))[ends - ends[0]][1:]


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[tuple[list[tuple[int | None, str | None]], bool]]:
    """The items (item_id, text) in blocks of about ``block_chars`` characters, and whether there are several."""
    items = ensure_columns(items, {"item_id": "long", "text": "string"}).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    number = max(1, -(-total // block_chars))
    for b in range(number):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == b)
        yield [(r["item_id"], r["text"]) for r in part.collect()], number > 1


def search(docs: DataFrame, items: DataFrame, max_rate: float = MAX_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (doc_id, item_id, edits, item_words, first_word, end_word): each document and item found in
    it, with the nearest run of words. A benchmark of several blocks takes a pass over the documents for each; its
    results are written and its broadcast is dropped before the next, so one block is in memory at a time."""
    docs = ensure_columns(docs, {"doc_id": "long", "text": "string"})
    schema = "doc_id long, item_id long, edits int, item_words int, first_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for rows, several in item_blocks(items, block_chars):
        run, shared = _searcher(docs, rows, max_rate, pairs=True)
        found = map_arrow(docs, run, schema, state=True)
        if several:
            found = written(found, "found")
            shared.destroy()
        out = out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, max_rate: float = MAX_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item is found; of several blocks one is in memory
    at a time."""
    for rows, several in item_blocks(items, block_chars):
        run, shared = _searcher(docs, rows, max_rate, pairs=False)
        docs = map_arrow(docs, run, docs.schema, state=True)
        if several:
            docs = written(docs, "clean")
            shared.destroy()
    return docs


def _searcher(docs: DataFrame, rows: list, max_rate: float, pairs: bool):
    import hashlib
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    key = hashlib.sha256(repr((rows, max_rate)).encode()).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = worker_state(("items", key), lambda: Items(shared.value, max_rate))
        for block in blocks(batches, "text", keep_nulls=True):
            hits = items.search(*_codes(block.column("text").fill_null(""), items)) if items.ids else []
            if not pairs:
                keep = np.ones(len(block), bool)
                keep[[h[0] for h in hits]] = False
                yield block.filter(pa.array(keep))
            elif hits:
                text, item, edits, first, end = zip(*hits)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": block.column("doc_id").take(pa.array(text)), "item_id": pa.array([items.ids[i] for i in item], pa.int64()),
                    "edits": pa.array(edits, pa.int32()), "item_words": pa.array(items.sizes[list(item)], pa.int32()),
                    "first_word": pa.array(first, pa.int64()), "end_word": pa.array(end, pa.int64())})

    return run, shared
