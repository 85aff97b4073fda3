"""Line deduplication over a corpus by a deletion-neighbourhood join.

A line is its words (split at white space, punctuation at their ends cut, lower case; each letter of a
script written without spaces, such as Han, Kana or Thai, is a word). A line within
one word edit (insert, delete, replace) of an earlier line goes; earlier means the smaller (doc_id, line
number). ``max_edits=0`` takes equal lines only. Lines of fewer than ``min_words`` words always stay,
lines of fewer than ``near_words`` words go only if an earlier line has the same words.

1. Every line gets two 64-bit hashes of its words; of lines with equal hashes the earliest is the first.
2. Candidates. Two lines one edit apart have either the front or the back half in common, so a first
   line is a candidate only if another first line has one of its halves (four keys per line cover both
   lengths). This loses no pair and spares the others their neighbourhood.
3. Neighbourhood join. A candidate emits hashed keys of itself and of all variants with one word deleted;
   lines within the bound share a key. Of the lines that share a key, those with the deletion at the same
   place differ by a replaced word, and the line that is the variant itself differs from all by a deletion.
   So a minimum per (key, place) and per key finds the earliest partner of each: no pairs are formed,
   whatever the size of a group.
4. Verification. The word edit distance of each line to the partner found is computed from the texts.
5. The lines that go are cut out of their documents.

Word hashes are polynomial prefix sums, so a variant costs a few array operations, not a copy of the line.
Documents meet the few lines that concern them by a join on the document; a bitmap of fixed size, broadcast,
keeps all other documents out of that shuffle.

Defined results: null text stays null; blank lines and their order stay; rows with a null doc_id count as the
latest; rows that repeat doc_id and text are one document, each row shows what it keeps; an empty table gives
no rows; other columns of the documents pass through.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bitmap, blocks, encode_words, map_arrow, may_hold, written

MAX_EDITS, MIN_WORDS, NEAR_WORDS = 1, 4, 10
LATEST = (1 << 63) - 1
_Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_TRIM = string.punctuation + "«»„“”‘’…–—¿¡" + "。、，．！？：；「」『』（）【】《》〈〉・～"
# Thai, Lao, Tibetan, Myanmar, Khmer, Kana, Han (fixed values). In UTF-8 they begin with a byte from E0 on, but not E2.
UNSPACED = ("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af])")
_UNSPACED = re.compile(UNSPACED)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_words(line: str) -> list[str]:
    return [w for x in _UNSPACED.sub(r" \1 ", line).split() if (w := x.strip(_TRIM).lower())]


def split_words(texts: pa.Array) -> pa.ListArray:
    """The words of the texts, not yet trimmed: split at white space and around every unspaced letter."""
    ends = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(texts) else np.zeros(0, np.uint8)
    if ((data >= 0xE0) & (data != 0xE2)).any():
        texts = pc.replace_substring_regex(texts, UNSPACED, r" \1 ")
    return pc.utf8_split_whitespace(texts)


class LineHashes:
    """Word hashes of many lines, one after the other, and hashes of any run of a line's words."""

    def __init__(self, lines: pa.Array):
        import xxhash
        split = split_words(lines)
        ends = split.offsets.to_numpy().astype(np.int64)
        codes, words = encode_words(split.values.slice(ends[0], ends[-1] - ends[0]))
        ends -= ends[0]
        table = np.zeros(len(words), np.uint64)
        for k, w in enumerate(words.to_pylist()):
            w = w.strip(_TRIM).lower()
            if w:
                table[k] = xxhash.xxh64_intdigest(w.encode()) | 1
        word = table[codes] if len(codes) else np.zeros(0, np.uint64)
        real = word != 0
        self.ends = np.concatenate(([0], np.cumsum(real)))[ends]
        self.word = word[real]
        self.start, self.size = self.ends[:-1], np.diff(self.ends)
        longest = int(self.size.max()) if len(self.size) else 0
        place = np.arange(len(self.word)) - np.repeat(self.start, self.size)
        self.sums, self.back = [], []
        with np.errstate(over="ignore"):
            for k, q in enumerate(_Q):
                power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(longest + 1, q))), dtype=np.uint64)
                inverse = np.uint64(pow(int(q), -1, 1 << 64))
                self.back.append(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(longest + 1, inverse))), dtype=np.uint64))
                h = self.word if k == 0 else mix(self.word)
                self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[place], dtype=np.uint64))))

    def run(self, line: np.ndarray, a: np.ndarray, b: np.ndarray, k: int = 0) -> np.ndarray:
        """Hash of words a to b (b not included) of the lines, as if they began at 0."""
        s = self.start[line]
        return (self.sums[k][s + b] - self.sums[k][s + a]) * self.back[k][a]

    def whole(self, line: np.ndarray, k: int) -> np.ndarray:
        return mix(self.run(line, np.zeros_like(line), self.size[line], k) + self.size[line].astype(np.uint64))

    def halves(self, line: np.ndarray) -> list[np.ndarray]:
        """Four keys per line: front and back half, as if the shorter of two lines had the line's
        length or one word less."""
        n, out = self.size[line], []
        for shorter in (n, n - 1):
            front = shorter // 2
            tag = (shorter.astype(np.uint64) << np.uint64(1))
            out.append(mix(self.run(line, np.zeros_like(n), front) + mix(tag)))
            out.append(mix(self.run(line, n - (shorter - front), n) + mix(tag + np.uint64(1))))
        return out

    def variants(self, line: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of a line and of its variants with one word deleted, and a code of the place deleted, 0
        for none."""
        n, s, total = int(self.size[line]), int(self.start[line]), self.sums[0]
        gone = np.arange(n)
        cut = (total[s + gone] - total[s]) + (total[s + n] - total[s + gone + 1]) * self.back[0][1]
        keys = np.concatenate((self.whole(np.array([line]), 0), mix(cut + np.uint64(n) - np.uint64(1))))
        return keys, np.concatenate((np.zeros(1, np.uint64), mix(gone.astype(np.uint64) + np.uint64(1))))


def line_table(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """A row per line of at least ``min_words`` words: document (d, t), line number, two hashes,
    the number of words, and the keys of its halves if it has ``near_words`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            with np.errstate(over="ignore"):
                split = pc.split_pattern(block.column("text"), "\n")
                ends = split.offsets.to_numpy().astype(np.int64)
                hashes = LineHashes(split.values.slice(ends[0], ends[-1] - ends[0]))
                ends -= ends[0]
                doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                number = np.arange(ends[-1]) - ends[:-1][doc]
                line = np.flatnonzero(hashes.size >= min_words)
                near = hashes.size[line] >= near_words
                halves = hashes.halves(line)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(halves, 1).ravel().view(np.int64)), 4) if len(line) else None
                out = {"d": block.column("d").take(pa.array(doc[line])), "t": block.column("t").take(pa.array(doc[line])),
                       "line": pa.array(number[line], pa.int32()), "words": pa.array(hashes.size[line], pa.int32()),
                       "h1": pa.array(hashes.whole(line, 0).view(np.int64)), "h2": pa.array(hashes.whole(line, 1).view(np.int64))}
                out["halves"] = pc.if_else(pa.array(near), keys.cast(pa.list_(pa.int64())), None) if keys is not None else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(out)

    return map_arrow(docs.select("d", "t", "text").where("text is not null"), run,
                     "d long, t long, line int, words int, h1 long, h2 long, halves array<bigint>")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with their place in the order of documents: d (doc_id, null last), t."""
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LATEST)), "t": F.xxhash64("text")})


def word_distance(a: list[str], b: list[str], bound: int) -> int:
    """Edit distance of two word lists, ``bound + 1`` if larger."""
    if abs(len(a) - len(b)) > bound:
        return bound + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - bound), min(len(b), i + bound)
        new = [bound + 1] * (len(b) + 1)
        new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        if min(new[lo - 1:hi + 1]) > bound:
            return bound + 1
        row = new
    return min(row[-1], bound + 1)


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The first lines (d, t, line) that are one word edit from an earlier one."""
    lines = firsts.where("halves is not null").select("d", "t", "line", "halves")
    keys = lines.select("d", "t", "line", F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    wanted = written(keys.join(shared, "key", "left_semi").select("d", "t", "line").distinct(), "candidates")
    of_doc = wanted.groupBy("d", "t").agg(F.collect_list("line").alias("lines"))
    near = may_hold(docs.select("d", "t", "text").withColumn("_k", F.xxhash64("d", "t")), bitmap(wanted.select(F.xxhash64("d", "t").alias("k"))))
    texts = (near.where("_hit").dropDuplicates(["d", "t"]).join(of_doc, ["d", "t"])
             .withColumn("all", F.split("text", "\n", -1)).select("d", "t", F.explode("lines").alias("line"), "all")
             .select("d", "t", "line", F.element_at("all", F.col("line") + 1).alias("text")))
    texts = written(texts, "candidate-lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 1 << 20):
            with np.errstate(over="ignore"):
                hashes = LineHashes(block.column("text"))
                got = [hashes.variants(k) for k in range(len(block))]
            row = pa.array(np.repeat(np.arange(len(got)), [len(g[0]) for g in got]))
            yield pa.RecordBatch.from_pydict({"d": block.column("d").take(row), "t": block.column("t").take(row), "line": block.column("line").take(row),
                                              "key": pa.array(np.concatenate([g[0] for g in got]).view(np.int64)),
                                              "gone": pa.array(np.concatenate([g[1] for g in got]).view(np.int64))})

    variants = map_arrow(texts, run, "d long, t long, line int, key long, gone long")
    # A variant with deletions meets those with the same deletions and the line that is the variant itself;
    # that line meets all. So each row counts for two sets and asks one or two.
    whole = F.col("gone") == 0
    place = F.struct("d", "t", "line")
    none = F.lit(None).cast("long")
    counts = F.array(F.xxhash64("key", "gone"), F.xxhash64("key", F.lit("any")))
    asks = F.array(F.when(whole, F.xxhash64("key", F.lit("any"))).otherwise(F.xxhash64("key", "gone")),
                   F.when(whole, none).otherwise(F.xxhash64("key", F.lit(0).cast("long"))))
    least = (variants.select(place.alias("place"), whole.alias("whole"), F.explode(counts).alias("set")).groupBy("set")
             .agg(F.min("place").alias("earliest"), F.max("place").alias("latest"), F.max("whole").alias("whole"))
             .where("whole or earliest < latest").select("set", "earliest"))  # a set of one answers others only if it is a whole line
    pairs = (variants.select(place.alias("place"), F.explode(asks).alias("set")).join(least, "set").where("earliest < place")
             .groupBy("place").agg(F.min("earliest").alias("earliest")))
    side = texts.select(F.struct("d", "t", "line").alias("p"), "text")
    pairs = (pairs.join(side.select(F.col("p").alias("place"), F.col("text").alias("a")), "place")
             .join(side.select(F.col("p").alias("earliest"), F.col("text").alias("b")), "earliest").select("place.*", "a", "b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [word_distance(normal_words(a), normal_words(b), 1) <= 1
                  for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            yield batch.select(["d", "t", "line"]).filter(pa.array(ok, pa.bool_()))

    return map_arrow(pairs, verify, "d long, t long, line int")


def repeated_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """Rows (d, t, line) of the lines that go, of documents with their keys (:func:`keyed`)."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    lines = written(line_table(docs, min_words, near_words), "lines")
    place = F.struct("d", "t", "line")
    firsts = written(lines.groupBy("h1", "h2").agg(F.min(F.struct("d", "t", "line", "halves")).alias("x")).select("h1", "h2", "x.*"), "firsts")
    later = (lines.select("h1", "h2", "d", "t", "line").join(firsts.select("h1", "h2", place.alias("first")), ["h1", "h2"])
             .where(place > F.col("first")).select("d", "t", "line"))
    return later.unionByName(near_lines(docs, firsts)) if max_edits else later


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any others) with repeated lines cut out of ``text``, and two more
    columns: n_lines (lines before) and removed (numbers of the lines that went, from 0)."""
    names = docs.columns
    docs = keyed(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id"), F.col("text").cast("string").alias("text")))
    gone = written(repeated_lines(docs, max_edits, min_words, near_words).groupBy("d", "t")
                   .agg(F.array_sort(F.collect_set("line")).alias("removed")), "removed")
    marked = may_hold(docs.withColumn("_k", F.xxhash64("d", "t")), bitmap(gone.select(F.xxhash64("d", "t").alias("k"))))
    hit = marked.where("_hit").join(gone, ["d", "t"], "left")
    miss = marked.where("not _hit").withColumn("removed", F.lit(None).cast("array<int>"))
    out = hit.select(*miss.columns).unionByName(miss)
    out = out.withColumn("_lines", F.split("text", "\n", -1))  # a column: inside a lambda it would be split once per line
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("removed")), lambda i: F.element_at("_lines", i + 1))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return out.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in names],
                      F.greatest(F.size("_lines"), F.lit(0)).alias("n_lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
