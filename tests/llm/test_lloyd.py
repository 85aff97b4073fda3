"""Resident Lloyd rounds against plain rounds over all parts."""

import hashlib
import math

import numpy as np
import pytest

from pulse.llm import lloyd

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """Codes, errors, label errors and digest, by the contract's words with Python integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    size = len(kept[0][1]) // parts
    books = [[k[1][p * size:(p + 1) * size] for k in kept[:entries]] for p in range(parts)]

    def assign(p):
        out = []
        for _, v, _ in kept:
            x = v[p * size:(p + 1) * size]
            d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        for p in range(parts):
            got = assign(p)
            for e in range(len(books[p])):
                own = [k[1][p * size:(p + 1) * size] for k, (_, at) in zip(kept, got) if at == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    final = [assign(p) for p in range(parts)]
    rows = [(k[0], k[2], "".join(f"{final[p][i][1]:02x}" for p in range(parts)), sum(final[p][i][0] for p in range(parts)))
            for i, k in enumerate(kept)]
    total = {}
    for _, label, _, error in rows:
        total[label] = total.get(label, 0) + error
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(i, code, error, total[label]) for i, label, code, error in rows], hashlib.sha256(text.encode()).hexdigest()


def result(df):
    rows = df.collect()
    return [(r.vec_id, r.code, r.error, r.label_error) for r in rows], {r.codebooks_sha256 for r in rows}


def vectors(n, dim=8, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(40, dim))
    return [(int(i), [float(np.float32(x)) for x in centres[r.integers(40)] + 0.3 * r.normal(size=dim)], int(r.integers(5))) for i in r.permutation(n)]


def test_as_brute_force(spark, frame, same_rows):
    rows = vectors(700)
    want, digest = brute(rows)
    got, digests = result(lloyd.compress(frame(rows, DDL).repartition(5)))
    same_rows(got, want)
    assert digests == {digest}


def test_odd_rows(spark, frame, same_rows):
    """Null, NaN and infinite components, null and repeated ids, null labels, ties, a hot vector, other columns."""
    hot = [0.5, -0.25, 0.0, 1.0]
    rows = [(None, hot, None), (3, hot, 1), (3, hot, 1), (1, None, 2), (2, [1.0, None, 0.0, 0.0], 2), (4, [float("nan"), 0.0, 0.0, 0.0], 1),
            (5, [float("inf"), 0.0, 0.0, 0.0], 1), (6, [-0.0001, 0.0001, -1.0, 2.0], None), (7, [], 1)] + [(100 + i, hot, None) for i in range(300)]
    rows += [(1000 + i, [i / 7, -i / 3, i % 5 / 9, 0.1], i % 3) for i in range(60)]
    want, digest = brute([r for r in rows if r[1] != []])
    df = frame([(*r, "x", 1) for r in rows], DDL + ", data string, entry int")
    got, digests = result(lloyd.compress(df))
    same_rows(got, want)
    assert digests == {digest}
    assert lloyd.compress(frame([], DDL)).count() == 0
    assert lloyd.compress(frame([(1, None, 1)], DDL)).count() == 0


def test_large_components_and_uneven_parts():
    r = np.random.default_rng(3)
    x, book = r.integers(-lloyd.LIMIT, lloyd.LIMIT, (50, 9)), r.integers(-lloyd.LIMIT, lloyd.LIMIT, (7, 9))
    to, dist = lloyd.nearest(x, book)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e)) for e in book] for v in x]
    assert to.tolist() == [w.index(min(w)) for w in want] and dist.tolist() == [min(w) for w in want]
    assert lloyd.cuts(10, 4) == [0, 3, 6, 8, 10]


def test_members_stay_with_their_owners(spark, frame, monkeypatch):
    """After every round each member lies in the partition of its (position, entry, salt), no member is
    lost, a hot entry lies with several owners, and fewer members move from round to round."""
    rows = vectors(600) + [(5000 + i, [0.5] * 8, 1) for i in range(400)]
    seen = []
    update = lloyd.Lloyd.update

    def watch(self, home):
        update(self, home)
        placed = home.mapPartitionsWithIndex(lambda i, rs: ((i, k, len(d)) for k, d in rs)).collect()
        seen.append((home.getNumPartitions(), placed, home.getCheckpointFile()))

    monkeypatch.setattr(lloyd.Lloyd, "update", watch)
    model = lloyd.Lloyd(lloyd.to_integers(frame(rows, DDL).repartition(8)), partitions=16)
    model.fit()
    assert len(seen) == 4
    for n, placed, file in seen:
        assert n == 16 and file
        assert all(i == lloyd.owner(k) % 16 for i, k, _ in placed)
        assert sum(size for *_, size in placed) == 1000 * 8 * model.dtype.itemsize
        by_entry = {}
        for i, (p, e, _), size in placed:
            by_entry.setdefault((p, e), {}).setdefault(i, 0)
            by_entry[p, e][i] += size
        hot = max(by_entry.values(), key=lambda x: sum(x.values()))
        assert len(hot) > 1
    assert len(model.moved) == 3 and model.moved[0] > model.moved[-1] and 0 < model.moved[0] < 4000


@pytest.mark.parametrize("partitions", [1, 7])
def test_same_at_any_partitioning(spark, frame, partitions):
    rows = vectors(300, seed=5)
    model = lloyd.Lloyd(lloyd.to_integers(frame(rows, DDL).repartition(3)), partitions=partitions)
    model.fit()
    assert model.digest() == brute(rows)[1]
