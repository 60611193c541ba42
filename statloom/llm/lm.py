"""9. Language-model scores from a log-frequency Bloom filter.

Word n-grams are counted over all documents. A count c >= 2 is quantised to the level 1 + floor(log2 c) - 1 and the
n-gram is inserted once for each level up to its own, so that probing levels until one is missing gives the level
back; an n-gram that isn't in the filter was seen once. Workers get the filter by broadcast and score every document
by the rest of the corpus (each count less the occurrence itself), interpolating the orders:
p(w | context) = (1 - BACKOFF) (c(context w) - 1) / (c(context) - 1) + BACKOFF p(w | shorter context), down to a
uniform share of the vocabulary.

The filter grows with the corpus. Up to ``max_mb`` it is broadcast whole. Beyond that, which is judged by the bytes of
text first and by the filter itself afterwards, no filter leaves its place: blocks of documents send their distinct
n-grams with counts to the owners of ranges of buckets, and an owner that has all counts of its range builds that part
of the filter, probes it and sends the levels back, a byte for each n-gram. N-grams travel once, so reads and shuffles
stay in proportion to the documents. The result is the same.

Counts travel as sorted blocks of hashes, one row for many n-grams, cut by hash so that each reducer owns a range.

Defined results: a null text gives nulls; a text without a word gives 0 tokens and null scores; repeated rows give
repeated rows and count as often as they occur; other columns are ignored; an empty table gives an empty result.
False positives of the filter (below 0.4 % of probes) overstate a count by a level.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import tokens, util

ORDER = 2
BACKOFF = 0.4
BITS = 12  #: of the filter for each insertion
HASHES = 6
MAX_MB = 100
_FLUSH = 1_500_000
_BLOCK_BYTES = 4 << 20
_SPAN_TEXT = 24 << 20  #: bytes of text for each range of buckets
_PROBED = 1 << 18  #: n-grams that are probed at a time
_SHARE = 0.035  #: of the bytes of text that a filter takes, about
_STEP = np.uint64(0x9E3779B97F4A7C15)


def keys(h: np.ndarray, doc: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order`` the hash of the n-gram that ends at each word; 0 where the document has no such."""
    out = [tokens.mix(h ^ np.uint64(1)) | np.uint64(1)]
    run = h.copy()
    ok = np.ones(len(h), bool)
    for n in range(2, order + 1):
        longer = np.zeros(len(h), np.uint64)
        longer[1:] = run[:-1] * _STEP + h[1:]
        ok = ok & np.append(False, (doc[1:] == doc[:-1]) & ok[:-1])[: len(h)]
        run = longer
        out.append(np.where(ok, tokens.mix(longer ^ np.uint64(n)) | np.uint64(1), np.uint64(0)))
    return out


def _count(order: int, shift: int):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            k, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = (k >> np.uint64(shift)).astype(np.int64)
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(at[1:], len(k))
            once = n == 1
            one = [k[a:b][once[a:b]].tobytes() for a, b in zip(at, ends)]
            more = [k[a:b][~once[a:b]].tobytes() for a, b in zip(at, ends)]
            count = [n[a:b][~once[a:b]].astype(np.int64).tobytes() for a, b in zip(at, ends)]
            return pa.record_batch([pa.array(bucket[at]), pa.array(one, pa.binary()), pa.array(more, pa.binary()), pa.array(count, pa.binary())], names=["bucket", "once", "more", "counts"])

        for whole in batches:
            for batch in tokens.cut(whole):
                for _, _, raw, off in tokens.blocks(tokens.lowered(batch.column(0))):
                    h, _, doc = tokens.words(raw, off)
                    for k in keys(h, doc, order):
                        k = k[k != 0]
                        held.append(k)
                        size += len(k)
                    if size >= _FLUSH:
                        yield flush()
                        held, size = [], 0
        if size:
            yield flush()

    return run


def level_of(count: np.ndarray) -> np.ndarray:
    """1 for 2 and 3, 2 for 4 to 7, ..; 0 for 1."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64) - 1


def count_of(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; 1 for level 0."""
    return np.where(level > 0, 1.5 * np.exp2(level), 1.0)


def _positions(key: np.ndarray, level: int | np.ndarray, j: int, size: np.ndarray | np.uint64) -> np.ndarray:
    a = tokens.mix(key + _STEP * np.asarray(level, np.uint64))
    return (a + np.uint64(j) * ((a >> np.uint64(32)) | np.uint64(1)) * _STEP) % size


def merged(once: list[bytes], more: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    one = np.frombuffer(b"".join(once), np.uint64)
    k = np.concatenate([one, np.frombuffer(b"".join(more), np.uint64)])
    n = np.concatenate([np.ones(len(one), np.int64), np.frombuffer(b"".join(counts), np.int64)])
    order = np.argsort(k)
    k, n = k[order], n[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[at], np.add.reduceat(n, at)


def build(key: np.ndarray, level: np.ndarray) -> tuple[int, bytes]:
    """(bits, packed filter) of keys with levels >= 1."""
    size = max(64, int(level.sum()) * BITS)
    size += -size % 64
    bits = np.zeros(size, bool)
    for lv in range(1, int(level.max(initial=0)) + 1):
        k = key[level >= lv]
        for j in range(HASHES):
            bits[_positions(k, lv, j, np.uint64(size)).astype(np.int64)] = True
    return size, np.packbits(bits, bitorder="little").tobytes()


def _reduce(x: pd.DataFrame) -> pd.DataFrame:
    k, n = merged(list(x["once"]), list(x["more"]), list(x["counts"]))
    often = n > 1
    size, packed = build(k[often], level_of(n[often]))
    return pd.DataFrame({"bucket": [x["bucket"].iloc[0]], "bits": [size], "filter": [packed], "n_keys": [len(k)]})


class Filter:
    """Buckets of a log-frequency Bloom filter; ``probe`` gives the levels of keys that belong to them."""

    def __init__(self, rows: list[tuple[int, int, bytes]], shift: int, n_buckets: int, first: int = 0) -> None:
        self.shift, self.first = np.uint64(shift), first
        self.size = np.zeros(n_buckets, np.uint64)
        self.start = np.zeros(n_buckets, np.int64)
        at = 0
        for bucket, bits, packed in rows:
            self.size[bucket], self.start[bucket] = bits, at
            at += len(packed)
        self.data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)

    def probe(self, key: np.ndarray) -> np.ndarray:
        level = np.zeros(len(key), np.int64)
        bucket = (key >> self.shift).astype(np.int64) - self.first
        size, start = self.size[bucket], self.start[bucket]
        alive = np.flatnonzero(size > 0)
        lv = 0
        while len(alive):
            lv += 1
            for j in range(HASHES):
                p = _positions(key[alive], lv, j, size[alive]).astype(np.int64)
                hit = (self.data[start[alive] + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1
                alive = alive[hit.astype(bool)]
                if not len(alive):
                    break
            level[alive] = lv
            if lv >= 62:
                break
        return level


def _table(slim: DataFrame, order: int, bits: int) -> DataFrame:
    parts = slim.mapInArrow(_count(order, 64 - bits), "bucket bigint, once binary, more binary, counts binary")
    return parts.groupBy("bucket").applyInPandas(_reduce, "bucket bigint, bits bigint, filter binary, n_keys bigint")


def train(docs: DataFrame, order: int = ORDER) -> tuple[DataFrame, int]:
    """(bucket, bits, filter, n_keys in the shared folder; log2 of the number of buckets) over all documents."""
    util.make_importable(docs.sparkSession)
    slim = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    bits = _bits(docs.count())
    return util.saved(_table(slim, order, bits), "ngrams"), bits


def _bits(n_docs: int) -> int:
    return int(min(40, max(6, math.ceil(math.log2(max(n_docs, 1) / 500 + 1)))))


@tokens.tidy
def _tokens_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = 0
    for whole in batches:
        for batch in tokens.cut(whole):
            for _, _, raw, off in tokens.blocks(tokens.lowered(batch.column(0))):
                n += len(tokens.words(raw, off)[1])
    yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])


def log_probabilities(levels: list[np.ndarray], n_total: float, n_keys: float) -> np.ndarray:
    """Natural logs by order from levels of (n-gram, context) pairs: levels[0] of words; levels[2n - 3], levels[2n - 2]
    of the n-gram and its context, -1 where there is none."""
    c = count_of(levels[0])
    p = (1 - BACKOFF) * (c - 1) / max(n_total - 1, 1.0) + BACKOFF / max(n_keys, 1.0)
    for i in range(1, len(levels), 2):
        full, context = levels[i], levels[i + 1]
        have = full >= 0
        a, b = count_of(np.maximum(full, 0)) - 1, count_of(np.maximum(context, 0)) - 1
        p = np.where(have, (1 - BACKOFF) * np.where(b > 0, np.minimum(a / np.maximum(b, 1e-9), 1.0), 0.0) + BACKOFF * p, p)
    return np.log(p)


def _sums(ks: list[np.ndarray], level: np.ndarray, doc: np.ndarray, n: int, n_total: float, n_keys: float) -> tuple[np.ndarray, np.ndarray]:
    """(words, sum of their log probabilities) of each of ``n`` documents; ``level`` has a row for each order."""
    if not len(doc):
        return np.zeros(n, np.int64), np.zeros(n)
    levels = [level[0]]
    for k in range(1, len(ks)):
        have = ks[k] != 0
        levels.append(np.where(have, level[k], -1))
        levels.append(np.where(have, np.append(0, level[k - 1])[:-1], -1))
    return np.bincount(doc, minlength=n), np.bincount(doc, log_probabilities(levels, n_total, n_keys), n)


def _score(held, shift: int, n_buckets: int, order: int, n_total: int, n_keys: int):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filter(held.value, shift, n_buckets)
        for whole in batches:
            for batch in tokens.cut(whole):
                ids, text = batch.column(0), tokens.lowered(batch.column(1))
                for i, j, raw, off in tokens.blocks(text):
                    h, _, doc = tokens.words(raw, off)
                    ks = keys(h, doc, order)
                    distinct, inv = np.unique(np.concatenate(ks), return_inverse=True)
                    n_words, total = _sums(ks, f.probe(distinct)[inv].reshape(order, -1), doc, j - i, n_total, n_keys)
                    missing = ~np.asarray(text.slice(i, j - i).is_valid())
                    yield pa.record_batch([ids.slice(i, j - i), pa.array(n_words, pa.int64(), mask=missing), pa.array(total, mask=missing)], names=["doc_id", "n_tokens", "total"])

    return run


@tokens.tidy
def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents, packed: (block, docs); a block's number is its partition's and its place there."""
    part, k = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
            for x in held:
                out.write_batch(x)
        return pa.record_batch([pa.array([part << 32 | k], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "docs"])

    for whole in batches:
        for batch in tokens.cut(whole, 200):
            held.append(batch)
            size += batch.nbytes
            if size >= _BLOCK_BYTES:
                yield flush()
                held, size, k = [], 0, k + 1
    if held:
        yield flush()


def _unpacked(docs: bytes, order: int) -> tuple[pa.Table, list[tuple[int, list[np.ndarray], np.ndarray]]]:
    """A block, and of each run of its documents (number of documents, n-grams by order, document of each word)."""
    table = pa.ipc.open_stream(docs, options=pa.ipc.IpcReadOptions(use_threads=False)).read_all()
    out = []
    for batch in table.to_batches():
        for i, j, raw, off in tokens.blocks(tokens.lowered(batch.column(1))):
            h, _, doc = tokens.words(raw, off)
            out.append((j - i, keys(h, doc, order), doc))
    return table, out


def _packed(key: np.ndarray, span_bits: int) -> bytes:
    """Keys of one range without the bits that all of them share, byte by byte of their places."""
    n = (63 - span_bits + 7) // 8
    return (key >> np.uint64(1)).view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes()


def _keys_of(packed: bytes, span: int, span_bits: int) -> np.ndarray:
    n = (63 - span_bits + 7) // 8
    planes = np.frombuffer(packed, np.uint8).reshape(n, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :n] = planes.T
    rest = (np.uint64(1) << np.uint64(63 - span_bits)) - np.uint64(1)
    return ((out.view(np.uint64).ravel() & rest | np.uint64(span) << np.uint64(63 - span_bits)) << np.uint64(1)) | np.uint64(1)


_ASKED = "span bigint, block bigint, keys binary, counts binary, n_words bigint"


def _asked(order: int, span_bits: int):
    """The distinct n-grams of each block, sorted, with counts, one row for each range of buckets; the block's first
    row has its number of words."""

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, runs = _unpacked(docs.as_buffer(), order)
                n_words = sum(len(doc) for _, _, doc in runs)
                if not n_words:
                    continue
                key, count = np.unique(np.concatenate([k[k != 0] for _, ks, _ in runs for k in ks]), return_counts=True)
                del runs
                span = (key >> np.uint64(64 - span_bits)).astype(np.int64)
                at = np.flatnonzero(np.append(True, span[1:] != span[:-1]))
                ends = np.append(at[1:], len(key))
                words = np.zeros(len(at), np.int64)
                words[0] = n_words
                count = count.astype(np.uint32)
                yield pa.record_batch(
                    [pa.array(span[at]), pa.array(np.full(len(at), block)), pa.array([_packed(key[a:b], span_bits) for a, b in zip(at, ends)], pa.binary()), pa.array([count[a:b].view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in zip(at, ends)], pa.binary()), pa.array(words)],
                    names=["span", "block", "keys", "counts", "n_words"],
                )

    return run


def _answered(bits: int, span_bits: int):
    """Levels, a byte each, of the n-grams that blocks sent to one range of buckets; the range's first row has its
    number of distinct n-grams."""

    def levels_of(x: pd.DataFrame) -> pd.DataFrame:
        span, shift, width = int(x["span"].iloc[0]), 64 - bits, 1 << bits - span_bits
        each = [_keys_of(k, span, span_bits) for k in x["keys"]]
        key = np.concatenate(each)
        count = np.concatenate([np.ascontiguousarray(np.frombuffer(c, np.uint8).reshape(4, -1).T).view(np.uint32).ravel() for c in x["counts"]])
        ends = np.cumsum([len(k) for k in each])
        del each
        order = np.argsort(key)
        key, count = key[order], count[order]
        new = np.append(True, key[1:] != key[:-1])
        at = np.flatnonzero(new)
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(new) - 1
        distinct, count = key[at], np.add.reduceat(count.astype(np.int64), at)
        often = count > 1
        key, level = distinct[often], level_of(count[often])
        first = span * width
        edges = np.searchsorted((key >> np.uint64(shift)).astype(np.int64), np.arange(first, first + width + 1))
        f = Filter([(i, *build(key[a:b], level[a:b])) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:]))], shift, width, first)
        level = np.concatenate([f.probe(distinct[i : i + _PROBED]) for i in range(0, len(distinct), _PROBED)]).astype(np.uint8)[place]
        known = np.zeros(len(x), np.int64)
        known[0] = len(distinct)
        return pd.DataFrame({"block": x["block"], "span": span, "levels": [level[a:b].tobytes() for a, b in zip(np.append(0, ends), ends)], "n_words": x["n_words"], "n_keys": known})

    def run(x: pd.DataFrame) -> pd.DataFrame:
        try:
            return levels_of(x)
        finally:
            tokens.release()

    return run


def _finished(order: int, n_total: int, n_keys: int):
    """Scores of blocks; the levels of a block stand before it, range by range."""

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[bytes] = []
        for batch in batches:
            for is_docs, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not is_docs:
                    got.append(data.as_py())
                    continue
                table, runs = _unpacked(data.as_buffer(), order)
                level = np.frombuffer(b"".join(got), np.uint8)
                got = []
                key = np.concatenate([k for _, ks, _ in runs for k in ks])
                known, inv = np.unique(key, return_inverse=True)
                if len(known) and known[0] == 0:  # words with no n-gram before them
                    level = np.append(np.uint8(0), level)
                if len(level) != len(known):
                    raise ValueError(f"{len(level)} levels for {len(known)} n-grams of a block")
                level = level[inv].astype(np.int64)
                n_words, total, at = [], [], 0
                for n, ks, doc in runs:
                    own = level[at : at + order * len(doc)].reshape(order, -1)
                    at += order * len(doc)
                    for out, x in zip((n_words, total), _sums(ks, own, doc, n, n_total, n_keys)):
                        out.append(x)
                missing = np.asarray(pc.is_null(table.column(1).combine_chunks()))
                ids = table.column(0).combine_chunks()
                yield pa.record_batch([ids, pa.array(np.concatenate(n_words), pa.int64(), mask=missing), pa.array(np.concatenate(total), mask=missing)], names=["doc_id", "n_tokens", "total"])

    return run


def _by_shuffle(slim: DataFrame, order: int, bits: int, n_bytes: int, schema: str) -> DataFrame:
    """Scores by levels that come from the owners of ranges of buckets; nothing that grows with the corpus leaves the
    executors."""
    span_bits = min(bits, max(0, math.ceil(math.log2(n_bytes / _SPAN_TEXT + 1))))
    blocks = util.saved(slim.mapInArrow(_blocked, "block bigint, docs binary"), "blocks", compression="none")
    asked = blocks.mapInArrow(_asked(order, span_bits), _ASKED)
    levels = util.saved(asked.groupBy("span").applyInPandas(_answered(bits, span_bits), "block bigint, span bigint, levels binary, n_words bigint, n_keys bigint"), "levels")
    n = levels.agg(F.sum("n_words").alias("n_words"), F.sum("n_keys").alias("n_keys")).first()
    both = levels.select("block", "span", F.lit(False).alias("is_docs"), F.col("levels").alias("data")).unionAll(blocks.select("block", F.lit(1 << span_bits).cast("bigint").alias("span"), F.lit(True).alias("is_docs"), F.col("docs").alias("data")))
    return both.repartition("block").sortWithinPartitions("block", "span").select("is_docs", "data").mapInArrow(_finished(order, int(n["n_words"] or 0), int(n["n_keys"] or 0)), schema)


def score(docs: DataFrame, order: int = ORDER, max_mb: float = MAX_MB) -> DataFrame:
    """doc_id, n_tokens, log10_prob (mean of a word), perplexity of every document."""
    spark = docs.sparkSession
    util.make_importable(spark)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {util.id_type(docs)}, n_tokens bigint, total double"
    n = slim.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_bytes = int(n["bytes"] or 0)
    out = None
    if n_bytes * _SHARE <= max_mb * 1e6:
        table, bits = train(docs, order)
        size = table.agg(F.sum(F.length("filter")).alias("bytes"), F.sum("n_keys").alias("n_keys")).first()
        if int(size["bytes"] or 0) <= max_mb * 1e6:
            n_total = int(slim.select("text").where("text is not null").mapInArrow(_tokens_in, "n bigint").agg(F.sum("n")).first()[0] or 0)
            got = table.select("bucket", "bits", "filter").toArrow()
            held = spark.sparkContext.broadcast(list(zip(got["bucket"].to_pylist(), got["bits"].to_pylist(), got["filter"].to_pylist())))
            out = slim.mapInArrow(_score(held, 64 - bits, 1 << bits, order, n_total, int(size["n_keys"] or 0)), schema)
    if out is None:
        out = _by_shuffle(slim, order, _bits(n["docs"]), n_bytes, schema)
    mean = F.when(F.col("n_tokens") > 0, F.col("total") / F.col("n_tokens"))
    return out.select("doc_id", "n_tokens", F.round(mean / math.log(10), 6).alias("log10_prob"), F.round(F.exp(-mean), 4).alias("perplexity"))
