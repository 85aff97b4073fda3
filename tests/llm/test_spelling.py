"""Spelling variants against all pairs of the vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulse.llm import spelling

LOW = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = words(docs)
    form, out = {}, []
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out.append((w, len(others)))

    def last(w):
        return w if form[w] is None else last(form[w])
    return [(w, n[w], k, form[w], None if form[w] is None else n[form[w]], last(w)) for w, k in out]


def typo(rng, w):
    i, c = rng.randrange(len(w)), rng.choice("aeiouéÿÀ÷zbs")
    return rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w + c, w])


def documents(seed=3, n=250):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdeéls") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["bookkeeper", "aaaaa", "aaaaaa", "Ünïcode"]
    weight = [1 / (1 + k) for k in range(len(stock))]
    return [(i, rng.choice([" ", "\n", "-", "1", "日"]).join(
        typo(rng, w) if rng.random() < 0.3 else w.upper() if rng.random() < 0.1 else w for w in rng.choices(stock, weight, k=rng.randint(0, 60))))
        for i in range(n)]


def result(df):
    return [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]


def test_as_brute_force(spark, frame, same_rows):
    docs = documents() + [(None, "bookkeeper bookkeepr bookkeepr bookkeepr"), (5, None), (6, ""), (6, "aaaaa " * 50)]
    docs += [docs[0]] * 3 + [(800, "z" * 70_000 + " " + "z" * 69_999), (801, "z" * 70_000 + " " + "z" * 69_999), (802, ("z" * 70_000 + " ") * 3 + "z" * 69_999)]
    docs += [(900, "stepone " * 40), (901, "stepon " * 12 + "stepen " * 4)]
    want = brute(docs)
    assert sum(w[3] is not None for w in want) > 50 and any(w[5] not in (w[0], w[3]) for w in want)
    same_rows(result(spelling.variants(frame(docs).repartition(4))), want)


def test_slices_of_the_vocabulary(spark, frame, same_rows):
    """A vocabulary larger than the filters: several passes, the same pairs."""
    rows = spark.createDataFrame([(w, n) for w, n in words(documents()).items()], "word string, n long")
    pair = lambda df: [tuple(sorted((r.word, r.near))) for r in df.collect()]
    one = pair(spelling.near_pairs(rows))
    assert len(one) == len(set(one))
    same_rows(pair(spelling.near_pairs(rows, filter_bytes=128)), one)


def test_empty_and_other_columns(spark, frame):
    assert result(spelling.variants(frame([]))) == []
    df = frame([(1, "wordy " * 3 + "wordi " * 9, "x", 1)], "doc_id int, text string, word string, n int")
    assert sorted(result(spelling.variants(df))) == [("wordi", 9, 1, None, None, "wordi"), ("wordy", 3, 1, "wordi", 9, "wordi")]


@pytest.mark.parametrize("length", [1, 2, 6, 13])
def test_edit_hashes(length):
    """The hashes of edits, computed without building them, are those of the edited words."""
    rng = np.random.default_rng(length)
    m = rng.integers(97, 105, (20, length)).astype(np.uint8)
    hashes, first = spelling.deletions(m)
    for i, row in enumerate(m):
        for k in range(length):
            rest = np.delete(row, k)
            want = spelling.mixed((rest[None, :] * spelling.powers(length - 1)).sum(1, dtype=np.uint64), length - 1)[0]
            assert hashes[i, k] == want
            assert first[i, k] == (k == 0 or row[k] != row[k - 1])


def test_filters_hold_every_word_and_little_else(spark):
    rng = random.Random(1)
    own = {"".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(5000)}
    rows = spark.createDataFrame([(w, 3) for w in own], "word string, n long")
    shards = spelling.Shards({8: len(own)}, 1)
    filters = spelling.build(rows, shards, 0)
    assert filters.nbytes <= 5000 * spelling.BITS / 8 + 64

    def hits(ws):
        m = np.frombuffer("".join(ws).encode(), np.uint8).reshape(len(ws), 8)
        return len(spelling.passing(filters, shards, spelling.mixed((m * spelling.powers(8)).sum(1, dtype=np.uint64), 8), 8, 0))
    others = list({"".join(rng.choice("klmnopqrst") for _ in range(8)) for _ in range(20_000)})
    assert hits(sorted(own)) == len(own)
    assert hits(others) < 0.02 * len(others)
