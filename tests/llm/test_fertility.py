import collections
import math
import random
import re

import numpy as np
import sentencepiece

from conftest_llm import SF, with_clashes
from pulse.llm import fertility as Q
from pulse.llm.queries import PIECES, QUERIES, vocabulary

SP = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
SPACE = r"[\x20\x09-\x0D]"


def brute(text):
    """The base counts and the fertility, straight from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    ids = [i for w in words for i in SP.encode(w)]
    n = len(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in collections.Counter(ids).values()) if n else 0.0
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside), n,
            sum(SP.is_byte(i) for i in ids) / n if n else 0.0, entropy)


TEXTS = [None, "", " \n ", "a b c d e", "a b c d e a b c d e", "a b c d e f a b c d e\na b\na b\n\n\n", "##  $ a|b <x>", "one\x85two three four\x1cfive", "漢字 かな 🙂 é" * 3,
         "w " * 30000, "x" * 100000, "l\nl\nl\n l", "The same words here now. " * 6]


def test_counts(frame):
    rows = [(i, x, "en") for i, x in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in Q.metrics(with_clashes(frame(rows)), vocabulary(PIECES)).collect()}
    for i, x, _ in rows:
        want = brute(x)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_tokens"]) == want[:6], x
        assert math.isclose(r["byte_share"], want[6], abs_tol=1e-9) and math.isclose(r["entropy"], want[7], abs_tol=1e-6)


def test_rows(frame):
    good = "This is a plain text of more than ten words and nothing in it repeats at all."
    rows = [(1, good, "en"), (1, good, "en"), (None, good, None), (2, None, "en"), (3, "", None), (4, "too short", "en")]
    got = Q.quality_rules(with_clashes(frame(rows)), vocabulary(PIECES)).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or 0, r["base_failed"], r["kept"]) for r in got) == [(0, False, True), (1, False, True), (1, False, True), (2, True, False), (3, True, False), (4, True, False)]
    assert Q.quality_rules(frame([]), vocabulary(PIECES)).collect() == []
    docs = with_clashes(frame(rows))
    kept = Q.keep(docs, vocabulary(PIECES))
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [None, 1, 1]


def test_bands_of_a_language(frame):
    """A text whose tokens are unusually short for its language goes, also if it passes the base rules."""
    words = ["winter", "garden", "window", "letter", "summer", "people", "little", "number", "nation", "better", "market", "system"]
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(words, k=250 + i)), "en") for i in range(150)]
    odd = (999, " ".join(f"q{k}z7x{k * 37 % 91}" for k in range(400)), "en")
    got = {r["doc_id"]: r for r in Q.quality_rules(frame([*rows, odd]), vocabulary(PIECES)).collect()}
    assert not got[999]["base_failed"] and not got[999]["kept"]
    fine = [r for i, r in got.items() if i != 999 and not r["base_failed"]]
    assert fine and all(r["kept"] for r in fine)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_fertility_rules"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want[:5]
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r["base_failed"] and r["kept"])
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    clean = [r for r in got if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean)


def plain_bands(rows, prior=10.0, spread=4.0):
    """{lang or script: (low, high)} from lists with a characters-per-token value for every token."""
    fixed = Q.SCRIPT_BANDS["latin"]

    def quartiles(own):
        values = np.repeat([min(round(r["word_chars"] / r["n_tokens"], 3), 20.0) for r in own], [r["n_tokens"] for r in own])
        q1, m, q3 = np.percentile(values, [25, 50, 75])
        return m - spread * max(m - q1, 0.01 * m), m + spread * max(q3 - m, 0.01 * m), len(own) / (len(own) + prior)

    rows = [r for r in rows if r["n_words"] >= 10 and 100 * r["n_repeat_words"] <= 20 * r["n_words"] and r["n_tokens"]]
    low, high, share = quartiles(rows)
    wide = (share * low + (1 - share) * fixed[0], share * high + (1 - share) * fixed[1])
    out = {None: wide}
    for lang in {r["lang"] for r in rows} - {None}:
        low, high, share = quartiles([r for r in rows if r["lang"] == lang])
        out[lang] = (share * low + (1 - share) * wide[0], share * high + (1 - share) * wide[1])
    return out


def test_verdicts_as_by_hand(frame):
    """Languages of 1, 12 and 80 documents and documents without language: no size is a threshold."""
    rnd = random.Random(4)
    stock = {"aa": ["winter", "garden", "window", "letter", "summer"], "bb": ["zq", "xk", "vj", "qz", "jx", "kq"], "cc": ["internationalization", "government", "information"]}
    texts = []
    for lang, n in (("aa", 80), ("bb", 12), ("cc", 1), (None, 9)):
        for i in range(n):
            words = [rnd.choice(stock[lang or "aa"]) + rnd.choice(stock[lang or "aa"]) for _ in range(rnd.randrange(12, 300))]
            if i % 10 == 3:
                words = [f"q{k}z7x{k * 37 % 91}" for k in range(rnd.randrange(20, 200))]
            texts.append((len(texts), " ".join(words), lang))
    got = Q.quality_rules(frame(texts), vocabulary(PIECES)).collect()
    bands = plain_bands(got)
    rejected = 0
    for r in got:
        low, high = bands.get(r["lang"], bands[None])
        slack = 2 / math.sqrt(max(r["n_tokens"], 1))
        cpt = r["word_chars"] / r["n_tokens"]
        fine = (low * (1 - slack) <= cpt <= high * (1 + slack) and r["byte_share"] <= Q.SCRIPT_BANDS["latin"][2] + slack
                and 2.0 * (1 - slack) <= r["entropy"] <= 13.0 * (1 + slack))
        assert r["kept"] == (not r["base_failed"] and fine)
        rejected += not r["base_failed"] and not fine
    assert rejected >= 5 and len(bands) == 4


def test_a_language_has_nearly_the_same_band_in_a_tenth_of_the_corpus(spark):
    from pulse.llm.common import written
    found = []
    for sf in (SF, SF.replace("0.001", "0.01")):
        measured = written(Q.metrics(spark.read.parquet(f"{sf}/documents.parquet"), vocabulary(PIECES)), "measured")
        found.append({r["lang"]: r for r in Q.bands(measured).collect() if r["lang"]})
    for lang in found[0]:
        a, b = found[0][lang], found[1][lang]
        assert abs(a["low"] - b["low"]) < 0.15 and abs(a["high"] - b["high"]) < 0.5
