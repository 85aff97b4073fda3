"""Quality rules by tokeniser fertility.

Every whole text is cut into words ``[^\\x20\\x09-\\x0D]+`` and every word is encoded with a
public vocabulary (BPE pieces with byte fallback). Per document this gives characters per token,
the share of byte-fallback tokens and the entropy of the tokens. Bands reject a document whose
fertility leaves what is usual for its language (or script, where the language is unknown):

* characters per token: ``SPREAD`` times the distance of the quartiles from the median, over the tokens of all
  documents of the language that pass the base rules. A group's band is drawn towards a wider one by what its
  size lacks: a language of n documents has the weight n / (n + ``PRIOR``) against the band of its script, found the
  same way, and that against the script's fixed band. So every language has a band of its own and no size is a
  threshold; documents without language have that of their script. A text's band is widened by the share
  ``SLACK / sqrt(tokens)``, because a short text is a noisy measurement;
* byte-fallback share: an upper bound per script, widened the same way;
* token entropy: a lower and an upper bound in bits, widened the same way.

Defined results: null or empty text has no words, all counts 0, ``base_failed``; repeated rows
each get their own result row; null doc_id or lang stay null; an empty table gives no rows;
columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import ASCII_SPACE, blocks, encode_words, ensure_columns, map_arrow, ragged, with_key, without, worker_state, written

SPREAD, LEAST_SPREAD, PRIOR = 4.0, 0.01, 10.0
SLACK = 2.0
ENTROPY_LOW, ENTROPY_HIGH = 2.0, 13.0
# Bands per script: characters per token low and high, highest byte-fallback share (fixed values).
SCRIPT_BANDS = {"latin": (1.0, 12.0, 0.2), "cyrillic": (0.8, 12.0, 0.3), "greek": (0.6, 12.0, 0.5), "arabic": (0.5, 12.0, 0.6),
                "han": (0.3, 6.0, 0.9), "other": (0.3, 12.0, 0.95), "none": (0.3, 12.0, 0.95)}
SYMBOLS = "#*$%&|<>"
CACHE_WORDS, CACHE_WORD_CHARS = 120_000, 48  # some 30 MB at most

METRICS = ("doc_id long, lang string, _t long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_tokens long, byte_share double, entropy double, script string")
MEASURED = [x.split()[0] for x in METRICS.split(", ")]


class WordPieces:
    """Token ids of single words, remembered for short words; bounded by ``CACHE_WORDS``."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n = self.sp.get_piece_size()
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.n)])
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct words; those not known yet are encoded in one call."""
        got = list(map(self.known.get, words))
        new = [k for k, ids in enumerate(got) if ids is None]
        for k, ids in zip(new, self.sp.encode([words[k] for k in new], num_threads=1) if new else ()):
            got[k] = tuple(ids)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
        self.known.update((words[k], got[k]) for k in new[:CACHE_WORDS] if len(words[k]) <= CACHE_WORD_CHARS)
        return got


def repeated_words(ids: np.ndarray, width: int = 5) -> int:
    """Words inside a window of ``width`` words that occurs twice or more, the first included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    code = np.zeros(n, np.uint64)
    for k in range(width):
        code = (code ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    order = np.argsort(code, kind="stable")
    code = code[order]
    same = code[1:] == code[:-1]
    if not same.any():
        return 0
    a, b = order[1:][same], order[:-1][same]
    if not all((ids[a + k] == ids[b + k]).all() for k in range(width)):  # a hash collision: count exactly
        rows = np.lib.stride_tricks.sliding_window_view(ids, width)
        _, inv, cnt = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        twice = cnt[inv.ravel()] > 1
    else:
        twice = np.zeros(n, bool)
        twice[a] = twice[b] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def script_of(text: str) -> str:
    """The script of most letters of the text, by code-point ranges (fixed values)."""
    if text.isascii():
        return "latin" if any(map(text.__contains__, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")) else "none"
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = {"latin": int((((c | 32) >= 97) & ((c | 32) <= 122) & (c < 128)).sum() + ((c >= 0xC0) & (c <= 0x24F)).sum()),
         "greek": int(((c >= 0x370) & (c <= 0x3FF)).sum()), "cyrillic": int(((c >= 0x400) & (c <= 0x52F)).sum()),
         "arabic": int(((c >= 0x600) & (c <= 0x6FF)).sum()),
         "han": int(((c >= 0x3040) & (c <= 0x30FF)).sum() + ((c >= 0x3400) & (c <= 0x9FFF)).sum() + ((c >= 0xAC00) & (c <= 0xD7AF)).sum())}
    best = max(n, key=n.get)
    known = sum(n.values())
    letters = known or any(map(str.isalpha, text))
    return "none" if not letters else best if known else "other"


def fertility_of(tokens: np.ndarray, is_byte: np.ndarray) -> tuple[int, float, float]:
    """Number of tokens, byte-fallback share, entropy in bits."""
    n = len(tokens)
    if not n:
        return 0, 0.0, 0.0
    s = np.sort(tokens)
    c = np.diff(np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True]))))
    return n, float(is_byte[tokens].mean()), float(math.log2(n) - (c * np.log2(c)).sum() / n)


def measure_block(texts: pa.Array, tok: WordPieces) -> list[tuple]:
    """The base counts and the fertility of every text. Words are split and numbered by Arrow;
    each distinct word of the block is encoded once."""
    split = pc.ascii_split_whitespace(texts)
    ends = split.offsets.to_numpy()
    codes, words = encode_words(split.values.slice(ends[0], ends[-1] - ends[0]))
    ends = ends - ends[0]
    words = words.to_pylist()
    if "" in words:  # what white space at either end of a text leaves
        blank = codes == words.index("")
        ends = ends - np.concatenate(([0], np.cumsum(blank)))[ends]
        codes = codes[~blank]
    ids = tok.encode(words)
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lens.sum()))
    counts = lens[codes]
    tokens = ragged(flat, (np.cumsum(lens) - lens)[codes], counts)
    token_ends = np.concatenate(([0], np.cumsum(counts)))[ends]
    codes = codes.astype(np.uint64)
    rows = []
    for k, text in enumerate(texts.to_pylist()):
        lo, hi = ends[k], ends[k + 1]
        n_symbols = sum(map(text.count, SYMBOLS))
        if lo == hi:
            rows.append((0, 0, n_symbols, 0, 0, 0, 0.0, 0.0, "none"))
            continue
        lines = text.split("\n")
        dup = len(lines) - len(set(lines))
        if dup:
            lines = [x for x in lines if x.strip(ASCII_SPACE)]
            dup = len(lines) - len(set(lines))
        rows.append((int(hi - lo), len(text) - sum(map(text.count, ASCII_SPACE)), n_symbols, dup, repeated_words(codes[lo:hi]),
                     *fertility_of(tokens[token_ends[k]:token_ends[k + 1]], tok.is_byte), script_of(text)))
    return rows


def _pieces_for(model: bytes) -> WordPieces:
    """One tokeniser for each Python worker, kept between tasks."""
    return worker_state(("pieces", hash(model)), lambda: WordPieces(model))


def metrics(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Base counts and fertility of every document (``METRICS``), one row per row of ``docs``.

    ``vocabulary``: path of a SentencePiece model on the driver; its bytes travel to the
    executors (a public vocabulary file, under a MB)."""
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _pieces_for(shared.value)
        for block in blocks(batches, "text"):
            rows = measure_block(block.column("text"), tok)
            cols = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("lang"), block.column("_t"), *cols], names=MEASURED)

    rows = with_key(ensure_columns(docs, {"doc_id": "long", "lang": "string", "text": "string"}))
    return map_arrow(rows, run, METRICS, state=True)


def base_failed() -> F.Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bands(measured: DataFrame, spread: float = SPREAD, prior: float = PRIOR) -> DataFrame:
    """The usual characters per token: rows (script, lang, low, high), lang null for the script as a whole. The
    quartiles are taken over counts of tokens per thousandth of a character, so they are deterministic and
    need no sketch; a language's documents count for the script that most of its tokens are in."""
    cpt = F.least(F.round(F.col("word_chars") / F.col("n_tokens"), 3), F.lit(20.0)).alias("cpt")
    counts = (measured.where(~base_failed() & (F.col("n_tokens") > 0)).groupBy("script", "lang", cpt)
              .agg(F.sum("n_tokens").alias("w"), F.count(F.lit(1)).alias("n")))
    counts = written(counts, "fertility-counts")  # a row per script, language and thousandth

    def quartiles(rows: DataFrame, keys: list[str], *more) -> DataFrame:
        m, q1, q3 = (F.col("q")[k] for k in (1, 0, 2))
        found = rows.groupBy(*keys).agg(F.expr("percentile(cpt, array(0.25, 0.5, 0.75), w)").alias("q"), F.sum("n").alias("n"), *more)
        low, high = (m - spread * F.greatest(m - q1, LEAST_SPREAD * m), m + spread * F.greatest(q3 - m, LEAST_SPREAD * m))
        return found.withColumn("low", low).withColumn("high", high).withColumn("share", F.col("n") / (F.col("n") + prior))

    fixed = [F.when(F.col("script") == s, F.struct(F.lit(float(b[0])).alias("low"), F.lit(float(b[1])).alias("high"))) for s, b in SCRIPT_BANDS.items()]
    drawn = lambda own, wide: F.col("share") * own + (1 - F.col("share")) * wide
    whole = quartiles(counts, ["script"]).withColumn("_f", F.coalesce(*fixed)).select(
        "script", drawn(F.col("low"), F.col("_f.low")).alias("wide_low"), drawn(F.col("high"), F.col("_f.high")).alias("wide_high"))
    main = counts.where(F.col("lang").isNotNull()).groupBy("lang", "script").agg(F.sum("w").alias("w"))
    main = main.groupBy("lang").agg(F.max_by("script", F.struct("w", "script")).alias("script"))
    own = quartiles(counts.where(F.col("lang").isNotNull()), ["lang"]).join(main, "lang").join(whole, "script").select(
        "script", "lang", drawn(F.col("low"), F.col("wide_low")).alias("low"), drawn(F.col("high"), F.col("wide_high")).alias("high"))
    return own.unionByName(whole.select("script", F.lit(None).cast("string").alias("lang"), F.col("wide_low").alias("low"), F.col("wide_high").alias("high")))


def judge(measured: DataFrame) -> DataFrame:
    """Adds base_failed, chars_per_token and kept to the rows of :func:`metrics`."""
    by_script = [F.when(F.col("script") == s, F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(("low", "high", "bytes"), b)]))
                 for s, b in SCRIPT_BANDS.items()]
    rows = measured.withColumn("base_failed", base_failed())
    cpt = F.when(F.col("n_tokens") > 0, F.col("word_chars") / F.col("n_tokens"))
    rows = rows.withColumn("chars_per_token", cpt).withColumn("_s", F.coalesce(*by_script))
    # written first: a row per language and script, so the planner broadcasts them by their real size
    found = written(bands(measured), "bands")
    by_lang = found.where(F.col("lang").isNotNull()).select(F.col("lang").alias("_lang"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    by_whole = found.where(F.col("lang").isNull()).select(F.col("script").alias("_script"), F.col("low").alias("_wide_low"), F.col("high").alias("_wide_high"))
    rows = rows.join(by_lang, F.col("lang") == F.col("_lang"), "left").join(by_whole, F.col("script") == F.col("_script"), "left")
    slack = F.lit(SLACK) / F.sqrt(F.greatest(F.col("n_tokens"), F.lit(1)))
    low, high = F.coalesce("_low", "_wide_low", F.col("_s.low")), F.coalesce("_high", "_wide_high", F.col("_s.high"))
    fine = (F.col("chars_per_token").between(low * (1 - slack), high * (1 + slack))
            & (F.col("byte_share") <= F.col("_s.bytes") + slack)
            & F.col("entropy").between(ENTROPY_LOW * (1 - slack), ENTROPY_HIGH * (1 + slack)))
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(fine, F.lit(False))).drop("_s", "_lang", "_low", "_high", "_script", "_wide_low", "_wide_high")


def quality_rules(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: the counts, the fertility, ``base_failed`` and ``kept``.

    The measured rows are written to the shared folder, as both the bands and the verdicts
    read them; the texts are encoded once."""
    return judge(written(metrics(docs, vocabulary), "fertility"))


def keep(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep. The verdict on rows that repeat doc_id
    and text but not lang is that of the strictest."""
    return without(docs, written(quality_rules(docs, vocabulary).where("not kept").select("doc_id", "_t").distinct(), "rejected"))
