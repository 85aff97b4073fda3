"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end its encoding: the token
``t`` such that the prefix before it ends with a token ``u`` for which ``u, t`` stay as they are
when ``u + t`` is merged on its own. ``last[i]`` stores that token (no other can be valid there), so an encoding is read
backwards from the last prefix, bytes appended to a piece only add entries, and an edit leaves
the entries before it valid (:class:`PrefixEncoder`, :class:`EncodedText`).

A text is split by ``public_tokenizers.PATTERN`` first, each match on its own, no special tokens.
Splitting uses that a space followed by a non-space always begins a match, whatever is around it:
texts are cut there, and the ids of a cut part (a word with its space and punctuation) are
remembered in a bounded cache of each Python worker.

Defined results: null text counts as empty: no tokens, digest of the empty string; repeated rows
and null or repeated doc_id give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pulse.llm.common import blocks, encode_words, ensure_columns, map_arrow, ragged, worker_state

CACHE_PARTS, CACHE_PREFIXES, CACHE_FITS, CACHE_PART_CHARS = 200_000, 250_000, 300_000, 48  # some 90 MB at most
PUNCTUATION = frozenset(".,;:!?")
_SPACE_RUN = re.compile(r" (?:\s|\Z)")
# The same for Arrow, whose \s knows ASCII only (white space of Unicode, fixed values).
_SPACE_RUN_ARROW = (r" (?:[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|\z)")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a ``.tiktoken`` file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Vocabulary:
    """Ranks as a byte trie, and which two tokens may stand side by side.

    A merge of rank r happens at "time" r. While ``u`` and ``t`` grow from bytes, the symbol at the
    right end of ``u`` runs through its right spine and the symbol at the left end of ``t`` through
    its left spine. The boundary holds if no pair of symbols that meet there would merge before
    either of them is merged into the next symbol of its own side (of equal ranks, the left
    merge comes first)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.fits: dict[int, bool] = {}
        self.spines: dict[int, tuple[int, ...]] = {}
        self.root: dict = {}  # from the last byte back: byte -> node; -1 -> rank of the token
        for token, rank in ranks.items():
            node = self.root
            for x in reversed(token):
                node = node.setdefault(x, {})
            node[-1] = rank

    def merged(self, piece: bytes, least: int = 1) -> list[bytes]:
        """Plain merging of the lowest-ranked neighbours, until ``least`` parts are left."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > least:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def spine(self, token: int, right: bool) -> tuple[int, ...]:
        """The symbols at one end of a token as it grows, by rank; each is merged on at the time (the rank)
        of the next."""
        got = self.spines.get(2 * token + right)
        if got is None:
            data, got = self.bytes_of[token], (token,)
            if len(data) > 1:
                parts = self.merged(data, 2)
                if len(parts) == 2 and all(x in self.ranks for x in parts):
                    got = (*self.spine(self.ranks[parts[right]], right), token)
            self.spines[2 * token + right] = got
        return got

    def compatible(self, u: int, t: int) -> bool:
        """Whether token ``u`` (-1: none) then token ``t`` is the encoding of their bytes."""
        bytes_of, ranks = self.bytes_of, self.ranks
        if u < 0:
            return self.merged(bytes_of[t]) == [bytes_of[t]]
        left, right, i, j = self.spine(u, True), self.spine(t, False), 0, 0
        never = float("inf")
        while True:
            a_next = left[i + 1] if i + 1 < len(left) else never
            b_next = right[j + 1] if j + 1 < len(right) else never
            r = ranks.get(bytes_of[left[i]] + bytes_of[right[j]])
            if r is not None and r < a_next and r <= b_next:
                return False
            if a_next <= b_next:
                if a_next == never:
                    return True
                i += 1
            else:
                j += 1

    def last_token(self, data: bytes, end: int, last: list[int] | None, known: dict[bytes, int] | None = None) -> int:
        """The one token that can end the encoding of ``data[:end]``. The last token of a shorter
        prefix is ``last[i]``, or ``known`` has it by its bytes; -1 for the empty one."""
        node, fits = self.root, self.fits
        for begin in range(end - 1, -1, -1):
            node = node.get(data[begin])
            if node is None:
                break
            t = node.get(-1)
            if t is not None:
                u = last[begin] if known is None else known[data[:begin]]
                ok = fits.get(u << 32 | t)
                if ok is None:
                    if len(fits) > CACHE_FITS:
                        fits.clear()
                    ok = fits[u << 32 | t] = self.compatible(u, t)
                if ok:
                    return t
        raise ValueError(f"no token ends at byte {end}: the ranks lack a single byte")


class PrefixEncoder:
    """The table ``last`` of one piece. ``append`` is exact; ``edit`` redoes only what the edit
    changes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> PrefixEncoder:
        old, self.data = len(self.data), self.data + more
        for end in range(old + 1, len(self.data) + 1):
            self.last.append(self.v.last_token(self.data, end, self.last))
        return self

    def edit(self, start: int, stop: int, new: bytes) -> PrefixEncoder:
        """Replaces ``data[start:stop]``. Entries up to ``start`` stay; behind the edit, entries
        are taken over again once the old table and the new one agree for ``longest`` bytes."""
        old_data, old_last = self.data, self.last
        self.data, self.last = old_data[:start], old_last[:start + 1]
        self.append(new)
        behind, run = len(self.data), 0
        shift = stop - behind
        while len(self.data) + shift < len(old_data):
            at = len(self.data) + shift
            self.append(old_data[at:at + 1])
            here = len(self.data)
            run = run + 1 if self.last[here] == old_last[here + shift] else 0
            if run >= self.v.longest and here - behind >= 2 * self.v.longest:
                self.data += old_data[here + shift:]
                self.last += old_last[here + shift + 1:]
        return self

    def ids(self) -> list[int]:
        whole = self.v.ranks.get(self.data)
        if whole is not None:  # a piece that is a token is that token
            return [whole]
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.v.bytes_of[out[-1]])
        return out[::-1]


class Parts(dict):
    """Ids of cut parts of a text; encodes a missing part and remembers it if it is short. When half of
    ``CACHE_PARTS`` are new, those of before that were not asked for again are forgotten."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__()
        self.pattern = regex.compile(pattern)
        self.v, self.split, self.known, self.before = vocabulary, self.pattern.findall, {b"": -1}, {}

    def piece(self, piece: str) -> list[int]:
        """The tables of short pieces are kept in one mapping, prefix to last token: a piece goes
        on from its longest known prefix, as if appended to it."""
        data = piece.encode()
        whole = self.v.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > CACHE_PART_CHARS:
            return PrefixEncoder(self.v, data).ids()
        known, n = self.known, len(data)
        if data not in known:
            if len(known) > CACHE_PREFIXES:
                known.clear()
                known[b""] = -1
            have = n - 1
            while data[:have] not in known:
                have -= 1
            last_token = self.v.last_token
            for end in range(have + 1, n + 1):
                known[data[:end]] = last_token(data, end, None, known)
        out, end, bytes_of = [], n, self.v.bytes_of
        while end:
            t = known[data[:end]]
            out.append(t)
            end -= len(bytes_of[t])
        out.reverse()
        return out

    def __missing__(self, part: str) -> tuple[int, ...]:
        word = part[1:] if part[:1] == " " else part
        ids = self.before.pop(part, None)
        if ids is not None:
            pass
        elif word.isalpha():  # the pattern takes a run of letters and the space before it as one match
            ids = tuple(self.piece(part))
        elif word[-1:] in PUNCTUATION and word[:-1].isalpha():
            ids = (*self.piece(part[:-1]), *self.piece(part[-1]))
        else:
            ids = tuple(chain.from_iterable(map(self.piece, self.split(part))))
        if len(part) <= CACHE_PART_CHARS:
            if len(self) >= CACHE_PARTS // 2:
                self.before = dict(self)
                self.clear()
            self[part] = ids
        return ids


class ByteBpe:
    """Encodes and decodes whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.v = Vocabulary(ranks)
        self.parts = Parts(self.v, pattern)

    def cut(self, text: str) -> list[str]:
        """Parts whose encodings follow each other: cuts stand before a space that a non-space
        follows. ``" " + x`` for every x of a split at spaces, as long as no x is empty or
        begins with white space; else those are joined to the part before."""
        words = text.split(" ")
        if not _SPACE_RUN.search(text):
            return [words[0], *[" " + w for w in words[1:]]]
        out = [words[0]]
        for w in words[1:]:
            if w and not w[0].isspace():
                out.append(" " + w)
            else:
                out[-1] += " " + w
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.parts.__getitem__, self.cut(text)))) if text else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes_of.__getitem__, ids))

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each. Every distinct
        part is looked up once for the block; the rest is array work."""
        hard = pc.match_substring_regex(texts, _SPACE_RUN_ARROW).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy()
        codes, words = encode_words(split.values.slice(ends[0], ends[-1] - ends[0]))
        ends = ends - ends[0]
        sizes = np.diff(ends)
        # a text's first word has no space before it; hard texts are cut one by one
        first = ends[:-1][sizes > 0]
        inner = np.ones(len(codes), bool)
        inner[first] = False
        plain = np.repeat(~hard, sizes)
        number, words = len(words), words.to_pylist()
        spaced, bare = np.unique(codes[inner & plain]), np.unique(codes[~inner & plain])
        found: list = [()] * (2 * number)
        parts = self.parts
        for k in spaced.tolist():
            found[k] = parts[" " + words[k]]
        for k in bare.tolist():
            found[number + k] = parts[words[k]]
        codes = np.where(inner, codes, codes + number)
        extra = []
        for k in np.flatnonzero(hard).tolist():
            extra.append(tuple(self.encode(texts[k].as_py())))
        found += extra
        if extra:  # a hard text is one part
            codes = codes[plain]
            sizes = np.where(hard, 1, sizes)
            at = np.cumsum(np.where(hard, 0, sizes)) - np.where(hard, 0, sizes)
            codes = np.insert(codes, at[hard], 2 * number + np.arange(len(extra)))
        lens = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(lens.sum()))
        starts = np.cumsum(lens) - lens
        counts = lens[codes]
        per_text = np.add.reduceat(np.append(counts, 0), np.minimum(np.cumsum(sizes) - sizes, len(counts))) if len(sizes) else sizes
        return ragged(flat, starts[codes], counts), np.where(sizes > 0, per_text, 0)


class EncodedText:
    """A text with the prefix tables of its pieces, for appends and near edits.

    A match depends only on the text from its start on, and looks ahead by one character, so an
    edit splits anew from one piece before it until a piece begins where an old one began behind
    it. Pieces outside keep their tables; where one piece was changed, its table is edited."""

    def __init__(self, bpe: ByteBpe, text: str = ""):
        self.bpe = bpe
        self.texts: list[str] = []
        self.tables: list[PrefixEncoder] = []
        self.replace(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def append(self, more: str) -> EncodedText:
        n = sum(map(len, self.texts))
        return self.replace(n, n, more)

    def replace(self, start: int, stop: int, new: str) -> EncodedText:
        text = self.text
        edited, shift = text[:start] + new + text[stop:], len(new) - (stop - start)
        first = at = 0
        while first < len(self.texts) and at + len(self.texts[first]) < start:
            at += len(self.texts[first])
            first += 1
        if first:
            first -= 1
            at -= len(self.texts[first])
        begins, pos = {}, 0  # where old pieces behind the edit begin now
        for k, t in enumerate(self.texts):
            if pos >= stop:
                begins[pos + shift] = k
            pos += len(t)
        fresh, tail = [], len(self.texts)
        while at < len(edited):
            if at >= start + len(new) and at in begins:
                tail = begins[at]
                break
            fresh.append(self.bpe.parts.pattern.match(edited, at).group())
            at += len(fresh[-1])
        old = self.tables[first:tail]
        self.tables[first:tail] = [self._table(t.encode(), old[k] if len(old) == len(fresh) else None) for k, t in enumerate(fresh)]
        self.texts[first:tail] = fresh
        return self

    def _table(self, data: bytes, old: PrefixEncoder | None) -> PrefixEncoder:
        if old is None:
            return PrefixEncoder(self.bpe.v, data)
        if old.data == data:
            return old
        head = len(os.path.commonprefix([old.data, data]))
        most = min(len(old.data), len(data)) - head
        same = len(os.path.commonprefix([old.data[::-1], data[::-1]])[:most])
        return old.edit(head, len(old.data) - same, data[head:len(data) - same])

    def ids(self) -> list[int]:
        return list(chain.from_iterable(t.ids() for t in self.tables))


def shared_bpe(data: bytes, pattern: str) -> ByteBpe:
    """One encoder for each Python worker, kept between tasks."""
    return worker_state(("bpe", hashlib.sha256(data + pattern.encode()).digest()), lambda: ByteBpe(read_ranks(data), pattern))


def token_table(bpe: ByteBpe) -> pa.Array:
    """Token bytes by id."""
    return pa.array([bpe.v.bytes_of.get(i, b"") for i in range(max(bpe.v.bytes_of, default=-1) + 1)], pa.large_binary())


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    ``ranks_path`` is read on the driver and its bytes (a public file of under a MB) travel to
    the executors. No shuffle: each text is encoded where it is read, in blocks of some MB."""
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared_bpe(shared.value, pattern)
        tokens = token_table(bpe)
        digest = lambda values: pa.array([hashlib.sha256(v.as_buffer() or b"").hexdigest() for v in values], pa.string())
        for block in blocks(batches, "text"):
            ids, counts = bpe.encode_block(block.column("text"))
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int64())
            ids = pa.array(ids)
            decimal = pc.binary_join(pa.LargeListArray.from_arrays(offsets, pc.cast(ids, pa.large_string())), pa.scalar(",", pa.large_string()))
            decoded = pc.binary_join(pa.LargeListArray.from_arrays(offsets, tokens.take(ids)), pa.scalar(b"", pa.large_binary()))
            out = {"doc_id": block.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                   "ids_sha256": digest(decimal), "decoded_sha256": digest(decoded)}
            if with_ids:
                out["ids"] = pa.LargeListArray.from_arrays(offsets, ids).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_arrow(ensure_columns(docs, {"doc_id": "long", "text": "string"}), run, schema, state=True)
