"""BPE by prefix tables against the library whose results it must give."""

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from conftest_llm import SF, with_clashes
from pulse.llm import bpe
from pulse.llm.queries import QUERIES, RANKS

DATA = open(public_tokenizers.path(RANKS), "rb").read()
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ours():
    return bpe.shared_bpe(DATA, PATTERN)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(DATA), special_tokens={})


ODD = ["", " ", "  ", "a  b", " x", "x ", "a\n b", "\n\n", "a \nb  c", "a　 b", "é  ñ", "aaaaaaaaaaaaaaa", "ab" * 400, "<|endoftext|>",
       "can't WON'T it's", "1234567 12", "\x1c \x1d x", "漢字かな", "🙂🙂 🙂", "a" * 5000]


def test_odd_texts(ours, theirs):
    ids, counts = ours.encode_block(pa.array(ODD, pa.large_string()))
    want = [theirs.encode_ordinary(x) for x in ODD]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert [ours.encode(x) for x in ODD] == want
    assert [ours.decode(w) for w in want] == [x.encode() for x in ODD]


def test_every_code_point(ours, theirs):
    for c in [*range(0, 0x3000), *range(0x3000, 0xD800, 7), *range(0xE000, 0x110000, 101)]:
        x = "a" + chr(c) + "b " + chr(c) + chr(c) + " b\n" + chr(c) + " c" + chr(c) + ","
        assert ours.encode(x) == theirs.encode_ordinary(x), hex(c)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aaaabbe  \n'stllre12.,!é漢", max_size=60))
def test_any_text(x):
    assert bpe.shared_bpe(DATA, PATTERN).encode(x) == tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(DATA), special_tokens={}).encode_ordinary(x)


def test_pairs_by_spines_as_by_merging(ours):
    v = ours.v
    ranks = sorted(v.bytes_of)[:: 1499]
    for u in ranks:
        for t in ranks:
            assert v.compatible(u, t) == (v.merged(v.bytes_of[u] + v.bytes_of[t]) == [v.bytes_of[u], v.bytes_of[t]])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab e\n'stl1.é", max_size=40), st.data())
def test_appends_and_edits(x, data):
    ours = bpe.shared_bpe(DATA, PATTERN)
    text = bpe.EncodedText(ours, x)
    for _ in range(3):
        now = text.text
        a = data.draw(st.integers(0, len(now)))
        b = data.draw(st.integers(a, len(now)))
        new = data.draw(st.text(alphabet="ab e\n'stl1.é", max_size=8))
        text.replace(a, b, new)
        want = now[:a] + new + now[b:]
        assert text.text == want and text.ids() == ours.encode(want)
    assert text.append(" the end").ids() == ours.encode(want + " the end")


def test_edit_of_a_long_piece(ours):
    piece = bpe.PrefixEncoder(ours.v, b"abcdefgh" * 100)
    for start, stop, new in [(3, 5, b"x"), (400, 400, b"yy"), (0, 1, b""), (790, 800, b"")]:
        data = piece.data[:start] + new + piece.data[stop:]
        piece.edit(start, stop, new)
        assert piece.data == data and piece.last == bpe.PrefixEncoder(ours.v, data).last


def test_table(spark, frame, theirs, same_rows):
    rows = [(1, "the cat"), (1, "the cat"), (None, "x"), (2, None), (3, ""), *[(10 + k, x) for k, x in enumerate(ODD)]]
    got = bpe.encode_decode(with_clashes(frame(rows)), public_tokenizers.path(RANKS), PATTERN, with_ids=True).collect()
    want = []
    for i, x in rows:
        ids = theirs.encode_ordinary(x or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest(), ids))
    same_rows([tuple(r) for r in got], want)
    assert bpe.encode_decode(frame([]), public_tokenizers.path(RANKS), PATTERN).collect() == []


def test_query(spark, theirs):
    got = {r["doc_id"]: r for r in QUERIES["op7_bpe_prefix"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = theirs.encode_ordinary(r["text"])
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
