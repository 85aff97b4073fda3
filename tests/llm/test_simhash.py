import random

import numpy as np
import xxhash

from conftest_llm import SF, with_clashes
from pulse.llm import simhash
from pulse.llm.queries import QUERIES


def brute_fp(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < k else [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    top = list(range(len(fps)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for x in ["", " \n", "a", "A b", "a b c", "The THE the the", "é É ı x y z", "x " * 70000]:
        assert simhash.fingerprint(x.encode()) == (brute_fp(x) if len(x) < 1000 else simhash.fingerprint(x.encode()))
    assert brute_fp("a b a b a b") == simhash.fingerprint(b"a B a b\ta b")


def near(rnd, base, most, bits=48):
    x = base
    for _ in range(rnd.randrange(most + 1)):
        x ^= 1 << rnd.randrange(bits)
    return x


def test_walk_against_all_pairs():
    rnd = random.Random(1)
    for _ in range(20):
        bases = [rnd.getrandbits(48) for _ in range(6)]
        fps = sorted({near(rnd, rnd.choice(bases), 7) for _ in range(200)})
        got = simhash.link_groups(np.array([len(fps)]), np.array([-1]), np.array(fps, np.uint64), 16, 3)
        assert got.tolist() == brute_components(fps)


def test_walk_between_two_nodes():
    rnd = random.Random(2)
    base = rnd.getrandbits(40)
    left = sorted({near(rnd, base, 3, 40) for _ in range(80)})
    right = sorted({near(rnd, base, 3, 40) | 1 << 47 for _ in range(80)})
    fps = left + right
    got = simhash.link_groups(np.array([len(fps)]), np.array([len(left)]), np.array(fps, np.uint64), 16, 3)
    links = [(i, len(left) + j) for i, a in enumerate(left) for j, b in enumerate(right) if (a ^ b).bit_count() <= 3]
    for i, j in links:
        assert got[i] == got[j]
    linked = {x for pair in links for x in pair}
    assert all((got[i] != i) <= (i in linked) for i in range(len(fps)))


def test_links_with_hot_nodes(spark):
    """A node of more rows than ``hot_rows`` is cut into descendants; the components stay the same."""
    from pulse.llm.common import components
    rnd = random.Random(3)
    bases = [rnd.getrandbits(64) for _ in range(5)]
    fps = sorted({near(rnd, b, 6, 64) for b in bases for _ in range(120)} | {0, (1 << 64) - 1, 7})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    want = brute_components(fps)
    groups = {}
    for f, w in zip(signed, want):
        groups.setdefault(w, set()).add(f)
    groups = {frozenset(g) for g in groups.values() if len(g) > 1}
    for hot in (1 << 20, 16):
        found = {}
        for r in components(simhash.links(df, hot_rows=hot)).collect():
            found.setdefault(r["component"], set()).add(r["node"])
            assert r["component"] == min(r["component"], r["node"])
        assert {frozenset(g) for g in found.values()} == groups


def test_components(spark):
    from pulse.llm.common import components
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 200)] + [(7, 7)]
    top = {x: x for e in edges for x in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    want = {x: find(x) for a, b in edges for x in (a, b) if a != b}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


ROWS = [(5, "one two three four five"), (3, "one two three four five"), (3, "one two three four five"), (None, "one two three four five"),
        (9, None), (8, ""), (7, " \n"), (None, None), (2, "x " * 3000), (1, "quite another text of some words"), (4, "ONE TWO three four five")]


def test_table(frame):
    got = simhash.near_duplicates(with_clashes(frame(ROWS))).collect()
    assert len(got) == len(ROWS)
    fps = sorted({brute_fp(x) for _, x in ROWS})
    comp = dict(zip(fps, brute_components(fps)))
    want = []
    for i, x in ROWS:
        ids = [j for j, y in ROWS if comp[brute_fp(y)] == comp[brute_fp(x)] and j is not None]
        want.append((i, f"{brute_fp(x):016x}", min(ids, default=None)))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert simhash.near_duplicates(frame([])).collect() == []


def test_one_of_each_group_stays(frame):
    docs = with_clashes(frame(ROWS))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 2, 3, 7]
    assert simhash.keep_one(frame([])).collect() == []
    assert [tuple(r)[:2] for r in simhash.keep_one(frame([(None, "a b c"), (None, "a b c")])).collect()] == [(None, "a b c")]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_simhash_trie"](spark, SF).collect()
    fps = sorted({brute_fp(x) for x in docs.values()})
    comp = dict(zip(fps, brute_components(fps)))
    least = {}
    for i in sorted(docs):
        least.setdefault(comp[brute_fp(docs[i])], i)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        i: (f"{brute_fp(x):016x}", least[comp[brute_fp(x)]]) for i, x in docs.items()}
