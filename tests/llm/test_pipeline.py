"""The stages one after the other, each against a brute-force version over its own input."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from conftest_llm import SF, with_clashes
from pulse.llm import bpe, simhash
from pulse.llm.common import written
from pulse.llm.line_dedup import normal_words
from pulse.llm.queries import PIECES, RANKS, vocabulary
from test_decontaminate import distance
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_fp

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        out.append(written(stage(spark, out[-1], SF), f"test-stage-{k}"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == COLUMNS


def test_quality_rules(spark, stages):
    from pulse.llm.queries import QUERIES
    kept = {r["doc_id"] for r in QUERIES["op10_fertility_rules"](spark, SF).where("kept").collect()}
    before = texts(stages[0])
    assert texts(stages[1]) == {i: before[i] for i in kept}


def test_line_dedup(stages):
    before = texts(stages[1])
    rows = sorted(before.items())
    want = {}
    for (i, x), gone in zip(rows, brute_lines(rows)):
        left = "\n".join(s for k, s in enumerate(x.split("\n")) if k not in set(gone))
        if not gone or left.strip():
            want[i] = left
    assert texts(stages[2]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_simhash(stages):
    before = texts(stages[2])
    ids = sorted(before)
    fps = sorted({brute_fp(before[i]) for i in ids})
    comp, seen, want = dict(zip(fps, brute_components(fps))), set(), {}
    for i in ids:
        c = comp[brute_fp(before[i])]
        if c not in seen:
            want[i] = before[i]
        seen.add(c)
    assert texts(stages[3]) == want


def test_decontamination(spark, stages):
    items = [normal_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    for i, x in before.items():
        words = normal_words(x)
        line = " " + " ".join(words) + " "
        if any(f" {' '.join(w)} " in line for w in items):
            assert i not in after
        if i not in after:  # nothing goes without an item within the bound
            assert any(min(distance(w, words[s:e]) for s in range(max(1, len(words) - 3)) for e in (s + len(w),)) <= 0.4 * len(w) for w in items)
    assert all(before[i] == x for i, x in after.items())


def test_bpe(stages):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(open(vocabulary(RANKS), "rb").read()))
    before = texts(stages[4])
    got = {r["doc_id"]: r for r in stages[5].collect()}
    assert set(got) == set(before)
    for i, x in before.items():
        assert got[i]["ids"] == enc.encode_ordinary(x) and got[i]["decoded_sha256"] == hashlib.sha256(x.encode()).hexdigest()


def test_run(spark, stages):
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in P.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in stages[5].collect())


GOOD = "A first line with a good number of words for the rules of this stage.\nAnother line follows it with ten or more words that differ."


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, GOOD, "en", "s", 5), (1, GOOD, "en", "s", 5), (None, GOOD, None, None, None), (2, "", None, "s", 0),
                                                                         (3, GOOD + "\n" + "word7 " * 20000, "en", "s", 1)]])
def test_odd_tables(spark, frame, rows):
    docs = with_clashes(frame(rows))
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns or name == P.STAGES[-1][0]
        out.collect()
    kept = written(frame(rows), "odd")
    for _, stage in P.STAGES:
        kept = written(stage(spark, kept, SF), "odd")
    assert kept.count() <= 2


def test_a_stage_drops_what_repeats(spark, frame):
    """Exact copies go in line dedup or the near-dedup, the first one stays."""
    docs = frame([(i, f"{GOOD} {i // 10}", "en", "s", 5) for i in range(40)])
    out = written(P.line_dedup_stage(spark, docs, SF), "a")
    out = P.simhash_near_dedup(spark, out, SF)
    assert {r["doc_id"] for r in out.collect()} <= {0, 10, 20, 30} and 0 in {r["doc_id"] for r in out.collect()}
    assert simhash.keep_one(docs).count() >= 1
    assert PIECES and vocabulary(PIECES)
