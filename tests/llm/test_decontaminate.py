import random

import numpy as np
import pyarrow as pa

from conftest_llm import SF, with_clashes
from pulse.llm import decontaminate as D
from pulse.llm.line_dedup import normal_words
from pulse.llm.queries import QUERIES

ITEM = "item_id long, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_nearest_run():
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.randrange(4) for _ in range(rnd.randrange(1, 7))]
        b = [rnd.randrange(4) for _ in range(rnd.randrange(10))]
        best = min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        r = D.nearest_run(np.array(a), np.array(b, np.int64), 99)
        assert r[0] == best == distance(a, b[r[1]:r[2]])
        assert D.nearest_run(np.array(a), np.array(b, np.int64), best - 1) is None


def planted(rnd, items, words, rate):
    k = rnd.randrange(len(items))
    w = normal_words(items[k][1])
    for _ in range(int(rate * len(w))):
        p, op = rnd.randrange(len(w)), rnd.randrange(3)
        if op == 0:
            w[p] = rnd.choice(words)
        elif op == 1:
            w.insert(p, rnd.choice(words))
        else:
            del w[p]
    before, after = [[rnd.choice(words) for _ in range(rnd.randrange(80))] for _ in range(2)]
    return k, " ".join(before + w + after)


def test_recall_against_known_edits():
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 40
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randrange(8, 60)))) for k in range(150)]
    items = D.Items(rows)
    for rate in (0, 0.1, 0.2):
        made = [planted(rnd, rows, words, rate) for _ in range(300)]
        hits = {(h[0], h[1]) for h in items.search(*D._codes(pa.array([t for _, t in made], pa.large_string()), items))}
        recall = np.mean([(n, k) in hits for n, (k, _) in enumerate(made)])
        assert recall >= (1 if not rate else 0.97), (rate, recall)


def test_nothing_false_and_all_exact():
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(12))) for k in range(40)]
    items = D.Items(rows)
    texts = [" ".join(rnd.choice(words) for _ in range(300)) for _ in range(30)] + [planted(rnd, rows, words, 0.1)[1] for _ in range(30)]
    got = items.search(*D._codes(pa.array(texts, pa.large_string()), items))
    for text, item, edits, first, end in got:
        assert distance(items.words[item], normal_words(texts[text])[first:end]) == edits <= items.edits[item]


ROWS = [(1, "Lorem ipsum dolor sit amet consectetur"), (2, "x LOREM, ipsum! dolor (sit) amet consectetur y"), (3, "clean words that match no item at all"), (None, "lorem ipsum dolor sit amet consectetur"),
        (4, None), (5, ""), (6, "word " * 30000), (1, "Lorem ipsum dolor sit amet consectetur"), (7, "lorem ipsum dolor sit amet"), (8, "lorem lorem ipsum dolor sit amet consectetur " * 50)]


def test_table(frame):
    items = frame([(10, "lorem ipsum dolor sit amet consectetur"), (11, None), (12, ""), (13, "too short"), (None, "lorem ipsum dolor sit amet consectetur")], ITEM)
    got = D.search(with_clashes(frame(ROWS)), with_clashes(items)).collect()
    assert sorted(((r["doc_id"] or 0), (r["item_id"] or 0), r["edits"]) for r in got) == sorted(
        (i, k, e) for i, e in [(1, 0), (1, 0), (2, 0), (0, 0), (7, 1), (8, 0)] for k in (10, 0))
    assert D.search(frame([]), items).collect() == [] == D.search(frame(ROWS), frame([], ITEM)).collect()
    blocks = D.search(frame(ROWS), items, block_chars=20).collect()  # the items in several blocks
    assert sorted(map(str, blocks)) == sorted(map(str, D.search(frame(ROWS), items).collect()))
    docs = with_clashes(frame(ROWS))
    clean = D.clean(docs, items)
    assert sorted(map(str, D.clean(docs, items, block_chars=20).collect())) == sorted(map(str, clean.collect()))
    assert clean.columns == docs.columns
    kept = clean.collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 4, 5, 6] and [r["text"] for r in kept if r["doc_id"] == 4] == [None]
    assert D.clean(docs, frame([], ITEM)).count() == len(ROWS)


def test_short_items_and_scripts_without_spaces(frame):
    """Short items are found where a run equals them, items in unspaced scripts by their letters."""
    han = "今日は天気がとても良いので散歩に行きました"
    items = frame([(1, "two words"), (2, "Answer"), (3, han), (4, "w x y z"), (5, "漢字"), (6, "two words"), (7, "one two three four five six")], ITEM)
    docs = frame([(1, "here are two WORDS and two words"), (2, "two"), (3, "words two"), (4, "answers answer."), (5, "w x y"), (6, "z w x y z"),
                  (7, f"前の文。{han}。後の文"), (8, han[:9] + "雨" + han[10:]), (9, han[:12]), (10, "かな漢字かな"), (11, "one two three four five six")])
    got = {(r["doc_id"], r["item_id"], r["edits"], r["first_word"], r["end_word"]) for r in D.search(docs, items).collect()}
    assert {g[:3] for g in got} == {(1, 1, 0), (1, 6, 0), (4, 2, 0), (6, 4, 0), (7, 3, 0), (8, 3, 1), (10, 5, 0), (11, 7, 0)}
    assert {(1, 1, 0, 2, 4), (4, 2, 0, 1, 2), (6, 4, 0, 1, 5), (10, 5, 0, 2, 4)} <= got
    only = frame([(1, "two words")], ITEM)
    assert sorted(r["doc_id"] for r in D.clean(docs, only).collect()) == list(range(2, 12))


def test_query(spark):
    items = [(r["item_id"], normal_words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op5_cgk_decontamination"](spark, SF).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = normal_words(r["text"])
        text = " " + " ".join(words) + " "
        for item, w in items:
            exact = f" {' '.join(w)} " in text
            assert not exact or (r["doc_id"], item) in pairs
    texts = {r["doc_id"]: normal_words(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got:
        w = dict(items)[r["item_id"]]
        assert distance(w, texts[r["doc_id"]][r["first_word"]:r["end_word"]]) == r["edits"] <= 0.2 * len(w)
