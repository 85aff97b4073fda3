"""SimHash near-duplicates: 64-bit fingerprints and a binary-trie self-join.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, shingles of
``shingle_words`` words joined by a space (repeats included; a shorter text is one shingle, a
text without words has fingerprint zero), XXH64 with seed 42 of each; a bit is 1 if more than
half of the hashes have it.

Self-join: fingerprints are the leaves of a binary trie. Pairs of nodes are traversed together
from the root, the bits in which they differ are added up, and a pair is dropped as soon as they
exceed the budget. Two fingerprints within d bits agree on one of d + 1 blocks of their bits, so
the trie is built once per rotation that brings a block to the top, and its levels of that block
are walked by a shuffle: rows of one block value are one node paired with itself. A task walks
the levels below, for all its nodes at once, level by level in arrays.

What keeps it in bounds: equal fingerprints are one leaf; a node pair whose two sides are already
connected is dropped (groups of many near copies are connected by 1-bit links first), and a task
returns at most one link per leaf; a node of more than ``HOT_ROWS`` leaves is cut into its
descendants some levels down, and their pairs within the budget become tasks of their own.

Defined results: null text has fingerprint zero like any text without words; a null doc_id never
becomes a component's id unless all its rows have none; repeated rows each get a row; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import blocks, components, ensure_columns, map_arrow, with_key, without, written

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
HOT_ROWS = 1 << 20
SLICE = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one UTF-8 text as an unsigned number."""
    from xxhash import xxh64_digest
    words = text.lower().split()  # of bytes: lowers A-Z and splits at ASCII white space only
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < shingle_words else map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
    hashes = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(seed))), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), SLICE):
        ones += np.unpackbits(hashes[lo:lo + SLICE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, _t, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            fps = [fingerprint(t.as_buffer().to_pybytes(), shingle_words) for t in block.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": block.column("doc_id"), "_t": block.column("_t"), "fp": pa.array(np.array(fps, np.uint64).view(np.int64))})

    return map_arrow(with_key(ensure_columns(docs, {"doc_id": "long", "text": "string"})), run, "doc_id long, _t long, fp long")


# --- the trie walk inside a task -----------------------------------------------------------

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: the smallest index of each component."""
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


class TrieWalk:
    """Pairs of trie nodes over sorted fingerprints; a node is a range of them."""

    def __init__(self, f: np.ndarray, most: int = 1 << 20):
        self.f, self.label, self.most = f, np.arange(len(f)), most

    def walk(self, pairs: np.ndarray, depth: int, budget: int) -> None:
        """``pairs``: columns lo, hi of one node, lo, hi of the other, differing bits so far; a
        node paired with itself has both ranges equal. Connects all leaves within the budget."""
        label = self.label
        same = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))  # changes of label up to each leaf
        links: list[tuple[np.ndarray, np.ndarray]] = []
        todo = [(depth, pairs)]
        ones: dict[int, np.ndarray] = {}
        while todo:
            d, p = todo.pop()
            if not len(p):
                continue
            if len(p) > self.most:  # keeps the frontier in bounds
                half = len(p) // 2
                todo += [(d, p[:half]), (d, p[half:])]
                continue
            one_piece = (same[p[:, 1] - 1] == same[p[:, 0]]) & (same[p[:, 3] - 1] == same[p[:, 2]]) & (label[p[:, 0]] == label[p[:, 2]])
            p = p[~one_piece]
            na, nb = p[:, 1] - p[:, 0], p[:, 3] - p[:, 2]
            leaf = (na == 1) & (nb == 1)
            if leaf.any():
                i, j = p[leaf, 0], p[leaf, 2]
                near = _popcount(self.f[i] ^ self.f[j]) <= budget
                links.append((i[near], j[near]))
                p = p[~leaf]
            if not len(p):
                continue
            if d not in ones:
                ones[d] = np.concatenate(([0], np.cumsum((self.f >> np.uint64(63 - d)) & np.uint64(1)))).astype(np.int64)
            n1 = ones[d]
            alo, ahi, blo, bhi, diff = p.T
            amid, bmid = ahi - (n1[ahi] - n1[alo]), bhi - (n1[bhi] - n1[blo])
            self_pair = alo == blo
            out = [np.stack(c, 1) for c in (
                (alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1))]
            cross = ~self_pair
            out.append(np.stack((amid[cross], ahi[cross], blo[cross], bmid[cross], diff[cross] + 1), 1))
            q = np.concatenate(out)
            q = q[(q[:, 0] < q[:, 1]) & (q[:, 2] < q[:, 3]) & (q[:, 4] <= budget) & ~((q[:, 0] == q[:, 2]) & (q[:, 1] - q[:, 0] == 1))]
            todo.append((d + 1, q))
        if links:
            self.label = settle(label, np.concatenate([x[0] for x in links]), np.concatenate([x[1] for x in links]))


def link_groups(group_ends: np.ndarray, middles: np.ndarray, f: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """For each leaf the leaf that stands for its component. Group k holds the sorted leaves up to
    ``group_ends[k]``: one node paired with itself, or, if ``middles[k]`` is not negative, the nodes
    before and from that position paired with each other."""
    walk = TrieWalk(f)
    lo = np.concatenate(([0], group_ends[:-1]))
    cross = middles >= 0
    pairs = np.stack((lo, np.where(cross, middles, group_ends), np.where(cross, middles, lo), group_ends, np.zeros(len(lo), np.int64)), 1)
    pairs = pairs[(pairs[:, 1] - pairs[:, 0] > 0) & (pairs[:, 3] - pairs[:, 2] > 0) & (cross | (group_ends - lo > 1))]
    large = pairs[:, 3] - pairs[:, 0] > 64
    for step in range(1, budget):  # nearest links first: later rounds skip what they connected
        walk.walk(pairs[large], depth, step)
    walk.walk(pairs, depth, budget)
    return walk.label


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows (a, b) that connect all distinct ``fp`` values within ``max_bits`` of each other: the
    same components as all such pairs, at most one row per value and rotation."""
    width = 64 // (max_bits + 1)  # bits of the block at the top
    turned = []
    for r in range(max_bits + 1):
        k = width * r
        f = F.shiftleft("fp", k).bitwiseOR(F.shiftrightunsigned("fp", 64 - k)) if k else F.col("fp")
        turned.append(F.struct(F.lit(r).alias("turn"), f.alias("f")))
    rows = (fps.select(F.explode(F.array(*turned)).alias("x")).select("x.*")
            .withColumn("node", F.shiftrightunsigned("f", 64 - width).bitwiseOR(F.shiftleft(F.col("turn").cast("long"), width))))
    zero = F.lit(0).cast("int")
    hot = written(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
                  .select("node", F.least(F.ceil(F.log2(F.col("n") / hot_rows)) + 1, F.lit(12)).cast("int").alias("levels")), "hot-nodes")
    tasks = rows.join(hot.select("node"), "node", "left_anti").select("node", zero.alias("x"), zero.alias("y"), zero.alias("side"), "f")
    # a large node: its descendants ``levels`` further down, each paired with those within the budget
    own = F.expr(f"cast(shiftrightunsigned(shiftleft(f, {width}), 64 - levels) as int)")
    other = F.expr(f"explode(filter(transform(sequence(0, cast(shiftleft(1, levels) as int) - 1), m -> own ^ m), p -> bit_count(p ^ own) <= {max_bits}))")
    large = (rows.join(hot, "node").withColumn("own", own).withColumn("other", other)
             .select("node", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "f"))
    tasks = tasks.unionByName(large).repartition("node", "x", "y").sortWithinPartitions("node", "x", "y", "side", "f")
    back = [width * r for r in range(max_bits + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def done(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            node, x, y, side, f = cols
            new = np.concatenate(([True], (node[1:] != node[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
            begins = np.flatnonzero(new)
            ends = np.append(begins[1:], len(node))
            right = np.concatenate(([0], np.cumsum(side)))
            middles = np.where(x[begins] != y[begins], ends - (right[ends] - right[begins]), -1)
            label = link_groups(ends, middles, f, width, max_bits)
            i = np.flatnonzero(label != np.arange(len(f)))
            k = np.array(back, np.uint64)[node[i] >> width]  # turned back: rotated right again
            plain = lambda v: ((v >> k) | (v << ((np.uint64(64) - k) % np.uint64(64)))).view(np.int64)
            return pa.RecordBatch.from_pydict({"a": plain(f[i]), "b": plain(f[label[i]])})

        for batch in batches:
            if not len(batch):
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "x", "y", "side", "f")]
            held.append((*cols[:4], cols[4].view(np.uint64)))
            if sum(len(h[0]) for h in held) >= 1 << 18:
                cols = tuple(np.concatenate(c) for c in zip(*held))
                same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
                cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
                if cut:  # whole groups only; the last one may go on in the next batch
                    yield done(tuple(c[:cut] for c in cols))
                held = [tuple(c[cut:] for c in cols)]
        if held and len(held[0][0]):
            yield done(tuple(np.concatenate(c) for c in zip(*held)))

    return map_arrow(tasks, run, "a long, b long")


def groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows (doc_id, _t, fp) of the documents, rows (fp, component, component_id) of the fingerprints):
    ``component`` is the smallest fingerprint reachable, ``component_id`` the smallest doc_id."""
    marked = written(fingerprints(docs, shingle_words), "fingerprints")
    leaves = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "leaves")
    linked = components(links(leaves.select("fp"), max_bits))
    found = leaves.join(linked.select(F.col("node").alias("fp"), "component"), "fp", "left")
    found = found.withColumn("component", F.coalesce("component", "fp"))
    firsts = found.groupBy("component").agg(F.min("first").alias("component_id"))
    # written, so that later joins have two plain sides and split a fingerprint with very many documents
    return marked, written(found.join(firsts, "component").select("fp", "component", "component_id"), "component-ids")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id of all documents that links of at most ``max_bits`` bits reach)."""
    marked, by_fp = groups(docs, shingle_words, max_bits)
    return (marked.join(by_fp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group: the smallest doc_id (null last), of
    several rows with it the one whose text hash is smallest, of equal rows one."""
    marked, by_fp = groups(docs, shingle_words, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_t")
    per_fp = marked.groupBy("fp").agg(F.min(order).alias("first"))
    stays = written(per_fp.join(by_fp, "fp").groupBy("component").agg(F.min("first").alias("first")), "stays")
    stay_fp = written(by_fp.join(stays, "component").select("fp", "first"), "stays-by-fingerprint")
    gone = written(marked.join(stay_fp, "fp").where(order != F.col("first")).select("doc_id", "_t").distinct(), "near-duplicates")
    twice = marked.groupBy("doc_id", "_t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "_t")
    return without(docs, gone, written(twice, "repeated-rows"))
