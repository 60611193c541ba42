"""7. BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be merged, so a text may be cut
between them without changing its tokens. Two such cuts are used. Between a character that isn't white space and one
that is, the vocabulary has no token and the splitting pattern no piece either, so whole texts are first cut there
by one fast scan; each fragment is split by the pattern, and each piece is cut again at every forced pair. What
remains is merged by rank independently and concatenated. Fragments recur, so a worker remembers their tokens.
With the usual pattern and a vocabulary that has all bytes no Python object is made for a piece: classes of characters
give the ends of all pieces of a batch, each piece that differs is merged once a batch, a step of all of them at a
time, and the tokens are gathered. The result equals that of the plain encoder.

Defined results: a null text gives null tokens and count, an empty one an empty list; repeated rows give repeated
rows; text that isn't valid Unicode can't occur in a string column; special tokens' strings are ordinary text;
decoding an unknown id (negative, too
large or without a token) fails with a ValueError that names it; null lists, and lists with a null in them, decode to
null; ids of documents keep their type; other columns are ignored; an empty table gives an empty
result. Texts are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import tokens, util

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_REMEMBER = 400_000  #: fragments a worker remembers; results don't depend on it
_AT_ONCE = 4 << 20  #: bytes of pieces that are merged at once; results don't depend on it
_WHITE_CLASS, _OTHER, _LETTER, _NUMBER = range(4)
_coders: dict[int, Coder] = {}


@functools.cache
def classes() -> np.ndarray:
    """The class of every character, as the pattern has it."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_WHITE_CLASS, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[ord(every[m.start()]) : ord(every[m.end() - 1]) + 1] = kind
    return out


def piece_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First bytes of the pieces that ``PATTERN`` cuts some texts into; ``raw`` is UTF-8, ``off`` where texts begin."""
    n, table = len(raw), classes()
    kind = table[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        a = raw[lead].astype(np.int32)
        size = 2 + (a >= 0xE0) + (a >= 0xF0)
        code = a & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
        for k in range(1, 4):
            some = size > k
            code[some] = code[some] << 6 | raw[lead[some] + k] & 0x3F
        own = table[code]
        kind[lead] = own
        for k in range(1, 4):
            some = size > k
            kind[lead[some] + k] = own[some]
    start = np.zeros(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[off] = True
    # the last white space before something else: a blank goes with what follows, another one is a piece of its own
    ink = np.flatnonzero((kind[1:] != _WHITE_CLASS) & (kind[:-1] == _WHITE_CLASS)) + 1
    first = np.zeros(n + 1, bool)
    first[off] = True
    ink = ink[~first[ink]]
    last = ink - 1
    blank = raw[last] == 32
    start[ink[blank]] = False
    while (inside := (raw[last] & 0xC0) == 0x80).any():
        last[inside] -= 1
    start[last] = True
    # 's and the like, where a piece begins with the apostrophe
    quote = np.flatnonzero((raw == 39) & start[:n])
    if len(quote):
        end = off[np.searchsorted(off, quote, "right")]
        padded = np.append(raw, [0, 0]).astype(np.int32)
        one, two = padded[quote + 1], padded[quote + 1] << 8 | padded[quote + 2]
        short = (quote + 1 < end) & np.isin(one, [ord(c) for c in "sdmt"])
        long = (quote + 2 < end) & np.isin(two, [ord(c[0]) << 8 | ord(c[1]) for c in ("re", "ve", "ll")])
        for at, size in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            start[at + size] = True
    return np.flatnonzero(start[:n])


class Coder:
    def __init__(self, vocabulary: bytes, pattern: str = PATTERN) -> None:
        import regex

        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for t, r in self.rank.items():
            self.token[r] = t
        self.inside = np.zeros((256, 256), bool)
        for t in self.rank:
            for a, b in zip(t, t[1:]):
                self.inside[a, b] = True
        self.joined = self.inside.tobytes()
        self.never = len(self.token)
        self.pieces = regex.compile(pattern).findall
        blank = [9, 10, 11, 12, 13, 32]
        ink = [b for b in range(256) if b not in blank and not 28 <= b <= 31 and b != 0x85]
        self.forced_blank = not self.inside[np.ix_([b for b in ink if b < 128], blank)].any()
        # white space, then everything up to the next white space (as the pattern has it: White_Space of Unicode)
        self.fragments = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+").findall if self.forced_blank else lambda text: [text] if text else []
        self.memo: dict[str, bytes] = {}
        self.gaps = {i for i, t in enumerate(self.token) if not t}
        self.bytes = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.plain = pattern == PATTERN and bool((self.bytes >= 0).all())
        if self.plain:  # both halves of every token that can be cut into two: what a merge finds
            get = self.rank.get
            halves = sorted((a * self.never + b, r) for t, r in self.rank.items() for k in range(1, len(t)) if (a := get(t[:k])) is not None and (b := get(t[k:])) is not None)
            self.pair = np.array([h[0] for h in halves] + [-1], np.int64)
            self.pair_rank = np.array([h[1] for h in halves] + [self.never], np.int32)
            self.two = np.array([get(bytes([a, b]), self.never) for a in range(256) for b in range(256)], np.int32).reshape(256, 256)
            self.whole, self.whole_rank = pa.array(self.rank, pa.large_binary()), np.array(list(self.rank.values()), np.int32)

    def merge(self, piece: bytes) -> list[int]:
        """Tokens of a run of bytes by merging the pair of least rank, leftmost first, again and again."""
        get, never = self.rank.get, self.never
        whole = get(piece)
        if whole is not None:
            return [whole]
        cut = list(range(len(piece) + 1))
        ranks = [get(piece[i : i + 2], never) for i in range(len(piece) - 1)]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            del ranks[i], cut[i + 1]
            if i < len(ranks):
                ranks[i] = get(piece[cut[i] : cut[i + 2]], never)
            if i:
                ranks[i - 1] = get(piece[cut[i - 1] : cut[i + 1]], never)
        return [self.rank[piece[a:b]] for a, b in zip(cut, cut[1:])]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same in n log n time, for long runs."""
        import heapq

        n = len(piece)
        end = list(range(1, n + 1))
        left, alive = list(range(-1, n - 1)), [True] * n
        rank = self.rank.get

        def pair(i: int):
            j = end[i]
            return rank(piece[i : end[j]]) if j < n else None

        heap = [(r, i, end[end[i]]) for i in range(n) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, e = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != e or pair(i) != r:
                continue
            j = end[i]
            alive[j] = False
            end[i] = e
            if e < n:
                left[e] = i
            for k in (left[i], i):
                if k >= 0 and (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k, end[end[k]]))
        return [self.rank[piece[i : end[i]]] for i in range(n) if alive[i]]

    def found(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, ``never`` where they don't merge."""
        key = a.astype(np.int64) * self.never + b
        at = np.searchsorted(self.pair[:-1], key)
        return np.where(self.pair[at] == key, self.pair_rank[at], self.never).astype(np.int32)

    def merge_all(self, raw: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Tokens of runs of bytes as ``merge`` has them, at their first bytes and -1 at others. In each step every run
        merges its leftmost pair of least rank; runs that have none are done."""
        out = np.full(len(raw), -1, np.int32)
        start = start.copy()
        start[1:] |= ~self.inside[raw[:-1], raw[1:]]
        run, at, token = np.cumsum(start, dtype=np.int32), np.arange(len(raw), dtype=np.int32), self.bytes[raw]
        rank = np.full(len(raw), self.never, np.int32)
        joined = np.flatnonzero(run[:-1] == run[1:])
        rank[joined] = self.two[raw[joined], raw[joined + 1]]
        while len(run):
            begin = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            size = np.diff(np.append(begin, len(run)))
            least = np.minimum.reduceat(rank, begin)
            going = np.repeat(least < self.never, size)
            out[at[~going]] = token[~going]
            hit = np.flatnonzero(going & (rank == np.repeat(least, size)))
            i = hit[np.concatenate([[True], run[hit[1:]] != run[hit[:-1]]])] if len(hit) else hit
            token[i], rank[i] = rank[i], self.never
            right = i[i + 2 < len(run)]
            right = right[run[right + 2] == run[right]]
            rank[right] = self.found(token[right], token[right + 2])
            left = i[i > 0]
            left = left[run[left - 1] == run[left]]
            rank[left - 1] = self.found(token[left - 1], token[left])
            going[i + 1] = False
            run, at, token, rank = run[going], at[going], token[going], rank[going]
        return out

    def encode_unlike(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all the pieces, where each one's begin)."""
        raw, off = tokens.buffers(pieces)
        size = np.diff(off)
        known = pc.index_in(pieces, value_set=self.whole)
        whole = self.whole_rank[known.fill_null(0).to_numpy(zero_copy_only=False)]
        known = known.is_valid().to_numpy(zero_copy_only=False)
        n, got = np.where(known, 1, 0), np.where(known, whole, 0)
        short = ~known & (size < 64)
        here = np.repeat(short, size)
        first = np.concatenate([[0], np.cumsum(size[short])])
        start = np.zeros(first[-1], bool)
        start[first[:-1]] = True
        merged = self.merge_all(raw[here], start)
        n[short] = np.add.reduceat(merged >= 0, first[:-1]) if short.any() else 0
        long = {int(i): self.encode_piece(pieces[int(i)].as_py()) for i in np.flatnonzero(~known & ~short)}
        for i, t in long.items():
            n[i] = len(t)
        begin = np.concatenate([[0], np.cumsum(n)])
        out = np.zeros(begin[-1], np.int32)
        out[begin[:-1][known]] = got[known]
        out[np.repeat(short, n)] = merged[merged >= 0]
        for i, t in long.items():
            out[begin[i] : begin[i] + len(t)] = t
        return out, begin

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all texts, where each text's begin); null texts have none."""
        if not self.plain:
            got = [b"" if t is None else self.encode(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(got), np.int32), np.concatenate([[0], np.cumsum([len(g) // 4 for g in got])])
        raw, off = tokens.buffers(texts)
        cut = np.append(piece_starts(raw, off), len(raw)).astype(np.int64)
        flat, size, a = [], [np.zeros(1, np.int64)], 0
        while a < len(cut) - 1:
            b = max(a + 1, int(np.searchsorted(cut, cut[a] + _AT_ONCE, "right")) - 1)
            pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(cut[a : b + 1] - cut[a]), pa.py_buffer(raw[cut[a] : cut[b]])]).dictionary_encode()
            token, begin = self.encode_unlike(pieces.dictionary)
            which = pieces.indices.to_numpy()
            n = np.diff(begin)[which]
            end = np.cumsum(n)
            flat.append(token[np.repeat(begin[which] - (end - n), n) + np.arange(end[-1])])
            size.append(n)
            a = b
        total = np.cumsum(np.concatenate(size))
        return np.concatenate([np.zeros(0, np.int32), *flat]), total[np.searchsorted(cut[:-1], off)]

    def encode_piece(self, piece: bytes) -> list[int]:
        if len(piece) >= 64:
            raw = np.frombuffer(piece, np.uint8)
            forced = (np.flatnonzero(~self.inside[raw[:-1], raw[1:]]) + 1).tolist()
        else:
            joined = self.joined
            forced = [i + 1 for i in range(len(piece) - 1) if not joined[piece[i] << 8 | piece[i + 1]]]
        if not forced:
            return self.merge(piece) if len(piece) < 64 else self.merge_long(piece)
        out: list[int] = []
        for a, b in zip([0, *forced], [*forced, len(piece)]):
            out += (self.merge if b - a < 64 else self.merge_long)(piece[a:b])
        return out

    def encode_fragment(self, fragment: str) -> bytes:
        pieces = self.pieces(fragment)
        if len(pieces) > 1:
            get = self.memo.get
            got = b"".join([get(p) or self.encode_fragment(p) for p in pieces])
        else:
            got = array("i", self.encode_piece(fragment.encode())).tobytes()
        if len(fragment) <= 64:
            if len(self.memo) >= _REMEMBER:
                self.memo.clear()
            self.memo[fragment] = got
        return got

    def encode(self, text: str) -> bytes:
        """Tokens as packed 32-bit integers."""
        get = self.memo.get
        return b"".join([get(f) or self.encode_fragment(f) for f in self.fragments(text)])

    def decode(self, ids: list[int]) -> str:
        if ids and (min(ids) < 0 or max(ids) >= self.never or not self.gaps.isdisjoint(ids)):
            raise ValueError(f"ids that the vocabulary doesn't have: {sorted(i for i in set(ids) if not 0 <= i < self.never or i in self.gaps)[:10]}")
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


def coder(vocabulary: bytes, pattern: str) -> Coder:
    key = hash((vocabulary, pattern))
    if key not in _coders:
        _coders[key] = Coder(vocabulary, pattern)
    return _coders[key]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, check: bool = False) -> DataFrame:
    """doc_id, n_tokens, token_ids; with ``check`` also round_trip, whether decoding gives the text again. The
    vocabulary, of fixed size, is read on the driver and sent to the workers; one pass, no shuffle."""
    spark = docs.sparkSession
    util.make_importable(spark)
    held = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(held.value, pattern)
        c.memo.clear()
        for whole in batches:
            for batch in tokens.cut(whole, 2000):
                texts = batch.column(1)
                flat, pos = c.encode_texts(texts)
                missing = texts.is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(pos.astype(np.int32), mask=np.append(missing, False)), pa.array(flat))
                cols = [batch.column(0), pa.array(np.diff(pos), pa.int64(), mask=missing), lists]
                names = ["doc_id", "n_tokens", "token_ids"]
                if check:
                    names.append("round_trip")
                    cols.append(pa.array([None if t is None else c.decode(flat[a:b].tolist()) == t for t, a, b in zip(texts.to_pylist(), pos, pos[1:])], pa.bool_()))
                yield pa.record_batch(cols, names=names)
        c.memo.clear()

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {util.id_type(docs)}, n_tokens bigint, token_ids array<int>" + ", round_trip boolean" * check)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id, text of rows with doc_id, token_ids."""
    spark = encoded.sparkSession
    util.make_importable(spark)
    held = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(held.value, pattern)
        for whole in batches:
            for batch in tokens.cut(whole, 500):
                text = [None if ids is None or None in ids else c.decode(ids) for ids in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    slim = encoded.select("doc_id", F.col("token_ids").cast("array<int>").alias("token_ids"))
    return slim.mapInArrow(run, f"doc_id {util.id_type(encoded)}, text string")
