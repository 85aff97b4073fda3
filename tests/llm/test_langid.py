import zlib

import numpy as np

from conftest_llm import SF, with_clashes
from pulse.llm import langid
from pulse.llm.queries import QUERIES


def brute_vector(text, table):
    """Trigram by trigram, from the letters' vectors."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return np.zeros(table.dimensions)
    x = " " + " ".join(words) + " "
    table.numbers(np.frombuffer(x.encode("utf-32-le"), np.uint32))
    v = [table.vectors[table.number[ord(c)] if c != " " else 0].astype(np.float64) for c in x]
    return sum(np.roll(a, 2) * np.roll(b, 1) * c for a, b, c in zip(v, v[1:], v[2:]))


TEXTS = ["The cat sat", "", None, "a", "...!", " 12 a1b ", "ÀÉß ñ", "x" * 5000, "漢字かな 한글", "İstanbul", "a\nb\n\nc"]


def test_bundles_against_trigram_by_trigram():
    table = langid.letters(langid.DIMENSIONS, langid.SEED)
    got = langid.bundles(TEXTS, table)
    for x, v in zip(TEXTS, got):
        if x and any(c.isalpha() for c in x):
            assert np.abs(v - brute_vector(x, table)).max() == 0, x
    many = ["".join(chr(0x4E00 + (i * 37 + k * 11) % 3000) for k in range(400)) for i in range(5)]  # more trigrams than the table holds
    for x, v in zip(many, langid.bundles(many, table)):
        assert np.abs(v - brute_vector(x, table)).max() == 0


def test_table(frame):
    en, de = "the quick brown fox jumps over the lazy dog and runs away", "der schnelle braune fuchs springt über den faulen hund und rennt"
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(ids[0], en, "en"), (ids[1], de, "de"), (ids[2], None, "de"), (ids[3], "", "en"), (ids[4], "1234 !!", None), (None, en, None), (None, None, None), (ids[0], en, "en")]
    got = langid.identify(with_clashes(frame(rows))).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in by[ids[0]]} == {"en"} and by[ids[1]][0]["lang_pred"] == "de"
    assert [by[i][0]["lang_pred"] for i in ids[2:5]] == ["und"] * 3 and by[ids[2]][0]["score"] == 0
    assert sorted(r["lang_pred"] for r in by[None]) == ["en", "und"] and all(r["held_out"] for r in by[None])
    assert langid.identify(frame([])).collect() == []
    assert {r["lang_pred"] for r in langid.identify(frame([(1, en, None), (2, de, None)])).collect()} == {"und"}


def test_lang_and_ids_are_no_inputs(frame):
    rows = [(i, f"text number of the {w} kind", "en" if w == "first" else "de") for i, w in enumerate(["first", "second"] * 20)]
    model = langid.learn(frame(rows))
    a = langid.predict(frame([(1, "the first kind", "en")]), model).collect()[0]
    b = langid.predict(frame([(77, "the first kind", None)]), model).collect()[0]
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_query_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op3_hyperdimensional_langid"](spark, SF).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.95
