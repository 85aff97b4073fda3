"""Secret scans: rules for known forms, and Markov models of characters for the others.

Two first-order models over the characters of keys and identifiers are trained on samples that the rules
label: what the rules find in the table are random strings, every other run of these characters is an ordinary
identifier, word or number. A run of ``MIN_RANDOM`` or more characters that no rule has found is a secret of kind
``random`` if its log-likelihood ratio (random over ordinary, the boundaries included) exceeds ``THRESHOLD``.

Training counts all transitions of all texts; per task one matrix of counts leaves the worker, so what reaches the
driver is a table of transitions (at most 2 * 68 * 68 rows). The random model is half the trained one and half
uniform, so it stays defined when the rules find nothing and covers alphabets that the samples lack.

Defined results: null and empty texts have no spans; a very long text is a block of its own and is scanned whole;
repeated rows and null doc_ids are rows like others; ties (a ratio equal to the threshold) are ordinary; other
columns stay out of the plan; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import blocks, ensure_columns, map_arrow

# The base rules, in their order, and what a match must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 16
KINDS = ("assign", "access", "hex", "random")
# A text without any of these (lower-cased) has no assignment.
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

# Characters of keys and identifiers; every other character is the boundary, state 0.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(LETTERS) + 1
MIN_RANDOM = 16
THRESHOLD = 12.0

_STATE = np.zeros(256, np.uint8)
_STATE[np.frombuffer(LETTERS.encode(), np.uint8)] = np.arange(1, STATES)
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


@dataclass
class Block:
    """The texts of a block as one run of bytes, a line feed after each, and their base spans in bytes."""

    data: np.ndarray      # bytes
    starts: np.ndarray    # where each text begins; one more for the end
    rows: np.ndarray      # per span: the text,
    kinds: np.ndarray     # the kind,
    begins: np.ndarray    # the first byte,
    ends: np.ndarray      # and the byte after the last
    values: np.ndarray    # where the secret itself begins


def runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values with ``least`` or more of them."""
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = b - a >= least
    return a[long], b[long]


def base_spans(batch: pa.RecordBatch) -> Block:
    """Finds what the rules find. All characters of the rules are ASCII, so byte positions do."""
    texts = [t.encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    found: list[tuple[int, int, int, int]] = []
    low = joined.lower()
    if any(k.encode() in low for k in KEYWORDS):
        for i, text in enumerate(texts):
            one = low[starts[i]:starts[i + 1]]
            if any(k.encode() in one for k in KEYWORDS):
                for m in _ASSIGN_BYTES.finditer(text):
                    if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                        found.append((0, starts[i] + m.start(), starts[i] + m.end(), starts[i] + m.start(2)))
    if b"AKIA" in joined:
        for m in _ACCESS_BYTES.finditer(joined):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append((1, m.start(), m.end(), m.start()))
    a, b = runs(_HEX_BYTE[data], HEX_LEAST)
    spans = np.array(found, np.int64).reshape(-1, 4)
    spans = np.concatenate((spans, np.stack((np.full(len(a), 2), a, b, a), 1).astype(np.int64)))
    return Block(data, starts, np.searchsorted(starts, spans[:, 1], side="right") - 1, spans[:, 0], spans[:, 1], spans[:, 2], spans[:, 3])


_ASSIGN_BYTES = re.compile(ASSIGN.pattern.encode(), re.IGNORECASE)
_ACCESS_BYTES = re.compile(ACCESS.pattern.encode())


def covered(size: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in a span."""
    mark = np.zeros(size + 1, np.int64)
    np.add.at(mark, begins, 1)
    np.add.at(mark, ends, -1)
    return np.cumsum(mark[:-1]) > 0


def transitions(states: np.ndarray) -> np.ndarray:
    """Counts of (state, next state) along ``states``; from boundary to boundary is none."""
    counts = np.bincount(states[:-1].astype(np.int64) * STATES + states[1:], minlength=STATES * STATES)
    counts[0] = 0
    return counts


def sample_counts(docs: DataFrame) -> DataFrame:
    """(random, a, b, n): transitions of the samples that the rules label as random strings, and of all
    the other runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, STATES * STATES), np.int64)
        for batch in blocks(batches, "text"):
            block = base_spans(batch)
            states = _STATE[block.data]
            secret = covered(len(states), block.values, block.ends)
            rule = covered(len(states), block.begins, block.ends)
            total[1] += transitions(np.concatenate(([0], np.where(secret, states, 0))))
            total[0] += transitions(np.concatenate(([0], np.where(rule, 0, states))))
        kind, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(bool)), pa.array(pair // STATES, pa.int32()), pa.array(pair % STATES, pa.int32()),
                                          pa.array(total[kind, pair])], ["random", "a", "b", "n"])

    texts = ensure_columns(docs, {"text": "string"})
    counts = map_arrow(texts, run, "random boolean, a int, b int, n long")
    return counts.groupBy("random", "a", "b").agg(F.sum("n").alias("n"))


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Per transition: log P(random) - log P(ordinary). ``counts[1]`` are those of random strings."""
    uniform = 1.0 / STATES

    def chances(n):
        return (n + uniform) / (n.sum(1, keepdims=True) + 1.0)
    return np.log(0.5 * chances(counts[1]) + 0.5 * uniform) - np.log(chances(counts[0]))


def train(docs: DataFrame) -> np.ndarray:
    """The matrix of log-likelihood ratios, from all texts of ``docs``."""
    counts = np.zeros((2, STATES, STATES))
    for r in sample_counts(docs).collect():  # at most 2 * STATES * STATES rows
        counts[int(r["random"]), r["a"], r["b"]] = r["n"]
    return log_ratio(counts)


def random_runs(block: Block, ratio: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that no rule has touched and that look random."""
    states = _STATE[block.data]
    a, b = runs(states > 0, MIN_RANDOM)
    if not len(a):
        return a, b
    rule = np.concatenate(([0], np.cumsum(covered(len(states), block.begins, block.ends))))
    free = rule[a] == rule[b]
    a, b = a[free], b[free]
    # a run's steps go from the boundary before it to the boundary after it
    padded = np.concatenate(([0], states, [0]))
    steps = np.concatenate(([0.0], np.cumsum(ratio[padded[:-1], padded[1:]])))
    score = steps[b + 1] - steps[a]
    return a[score > threshold], b[score > threshold]


def scan(docs: DataFrame, threshold: float = THRESHOLD, ratio: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document; the models are trained
    on ``docs`` itself unless ``ratio`` (:func:`train`) is given."""
    weights = train(docs) if ratio is None else ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            block = base_spans(batch)
            a, b = random_runs(block, weights, threshold)
            kinds = np.concatenate((block.kinds, np.full(len(a), 3)))
            begins, ends = np.concatenate((block.begins, a)), np.concatenate((block.ends, b))
            rows = np.searchsorted(block.starts, begins, side="right") - 1
            points = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))  # code points before a byte
            origin = points[block.starts[rows]]
            begins, ends = points[begins] - origin, points[ends] - origin
            n = len(batch)
            base, spans = [""] * n, [""] * n
            order = np.lexsort((kinds, begins, rows))
            edges = np.searchsorted(rows[order], np.arange(n + 1))
            for i in np.unique(rows):
                own = [(k, f"{KINDS[k]}:{s}:{e}") for k, s, e in zip(*(x[order[edges[i]:edges[i + 1]]].tolist() for x in (kinds, begins, ends)))]
                spans[i] = ",".join(t for _, t in own)
                base[i] = ",".join(t for k, t in own if k < 3)
            counts = [pa.array(np.bincount(rows[kinds == k], minlength=n), pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array([hashlib.sha256(t.encode()).hexdigest() for t in base]), pa.array(spans)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = ensure_columns(docs, {"doc_id": "long", "text": "string"})
    return map_arrow(rows, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
