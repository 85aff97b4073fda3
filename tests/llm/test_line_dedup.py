import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from conftest_llm import SF, with_clashes
from pulse.llm import line_dedup as L
from pulse.llm.queries import QUERIES


def brute(rows, min_words=4, near_words=10, edits=1):
    """{row: lines that go}: all lines against all earlier lines."""
    earlier, out = [], []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    gone = {}
    for k in order:
        gone[k] = []
        for i, line in enumerate((rows[k][1] or "").split("\n")):
            w = L.normal_words(line)
            if len(w) < min_words:
                continue
            if w in earlier or len(w) >= near_words and any(len(e) >= near_words and L.word_distance(w, e, edits) <= edits for e in earlier):
                gone[k].append(i)
            if w not in earlier:
                earlier.append(w)
    return [gone[k] for k in range(len(rows))]


def check(df, rows, **how):
    got = {(r["doc_id"], r["text"] is None): r for r in L.dedup_lines(df, **how).collect()}
    assert len(got) == len(rows)
    for (i, x), gone in zip(rows, brute(rows, how.get("min_words", 4), how.get("near_words", 10), how.get("max_edits", 1))):
        r = got[i, x is None]
        assert r["removed"] == gone, i
        if x is None:
            assert r["text"] is None and r["n_lines"] == 0
        else:
            lines = x.split("\n")
            assert r["text"] == "\n".join(s for k, s in enumerate(lines) if k not in set(gone)) and r["n_lines"] == len(lines)


def edited(rnd, words, edits, vocabulary):
    w = list(words)
    for _ in range(edits):
        p, op = rnd.randrange(len(w)), rnd.randrange(3)
        if op == 0:
            w[p] = rnd.choice(vocabulary)
        elif op == 1:
            w.insert(p, rnd.choice(vocabulary))
        else:
            del w[p]
    return w


def test_against_all_pairs(frame):
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(12)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(8, 16))] for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [" ".join(edited(rnd, rnd.choice(bases), rnd.randrange(4), vocabulary)) for _ in range(rnd.randrange(6))]
        rows.append((i, "\n".join(lines)))
    check(frame(rows), rows)
    check(frame(rows), rows, max_edits=0)


def test_odd_rows(frame):
    long = " ".join(f"word{k}" for k in range(30000))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a b c d"), (5, "A, b. c! (d)\n\nshort\nshort"), (6, long), (7, long + " more\nx"),
            (8, "漢字 かな 한글 abc"), (9, "漢字 かな 한글 abc\r"), (None, "a b c d\nnew line of words")]
    check(with_clashes(frame(rows)), rows)
    out = L.dedup_lines(with_clashes(frame(rows)))
    assert out.columns == [*with_clashes(frame(rows)).columns, "n_lines", "removed"]
    assert L.dedup_lines(frame([])).collect() == []
    twice = L.dedup_lines(frame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in twice) == [(1, "a b c d"), (1, "a b c d"), (2, "")]


def test_scripts_without_spaces(frame):
    """Each letter counts: copies and near copies of unspaced lines go; blocks with and without such letters agree."""
    rnd = random.Random(6)
    han, thai = ["".join(chr(rnd.randrange(a, b)) for _ in range(300)) for a, b in ((0x4E00, 0x9FA0), (0x0E01, 0x0E2F))]
    rows = [(1, f"{han}\n{thai}\nかなかな\n漢字"), (2, f"{thai}\n{han}。\n「かなかな」\n漢字"), (3, han[:150] + "x" + han[150:]),
            (4, han[:7] + thai[7:]), (5, thai[:99] + thai[100:]), (6, "plain “words” in a line"), (7, "plain words in a line")]
    check(frame(rows), rows)
    got = {r["doc_id"]: r["removed"] for r in L.dedup_lines(frame(rows)).collect()}
    assert got == {1: [], 2: [0, 1, 2], 3: [0], 4: [], 5: [0], 6: [], 7: [0]}


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB ,.。漢かกꞏ\u3000\u30fc\U00020001é\U0001F600"), max_size=12))
def test_words_of_both_kinds_agree(text):
    got = [w for x in L.split_words(pa.array(["x", text], pa.large_string()).slice(1))[0].as_py() if (w := x.strip(L._TRIM).lower())]
    assert got == L.normal_words(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), min_size=2, max_size=9), st.data())
def test_one_edit_shares_a_half_and_a_variant(words, data):
    rnd = random.Random(data.draw(st.integers(0, 10**6)))
    other = edited(rnd, words, 1, ["a", "b", "c", "x"])
    with np.errstate(over="ignore"):
        h = L.LineHashes(pa.array([" ".join(words), " ".join(other)], pa.large_string()))
        halves = np.stack(h.halves(np.arange(2)), 1)
        assert len(other) < 2 or set(halves[0].tolist()) & set(halves[1].tolist())
        (k1, c1), (k2, c2) = h.variants(0), h.variants(1)
    assert any(a == b and (x == y or 0 in (x, y)) for a, x in zip(k1.tolist(), c1.tolist()) for b, y in zip(k2.tolist(), c2.tolist()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=7), st.lists(st.integers(0, 3), max_size=7), st.integers(0, 3))
def test_word_distance(a, b, bound):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    assert L.word_distance([str(x) for x in a], [str(x) for x in b], bound) == min(row[-1], bound + 1)


def test_hot_line(frame):
    """A third of all lines are one line, and many differ from another in one word."""
    rows = [(i, "the very same line in every document\n" + f"a notice that differs in one word only which is word{i} and nothing else") for i in range(300)]
    got = {r["doc_id"]: r["removed"] for r in L.dedup_lines(frame(rows)).collect()}
    assert got == {i: [0, 1] if i else [] for i in range(300)}


def test_query(spark):
    import hashlib
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op1_line_dedup"](spark, SF).collect()}
    for (i, x), gone in zip(rows, brute(rows)):
        left = "\n".join(s for k, s in enumerate(x.split("\n")) if k not in set(gone))
        assert got[i]["removed"] == gone and got[i]["n_removed"] == len(gone)
        assert got[i]["text_sha256"] == hashlib.sha256(left.encode()).hexdigest() and got[i]["n_chars_left"] == len(left)
