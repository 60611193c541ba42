"""2. MinHash near-duplicates by a multi-index Hamming join.

Each document's set of words gives 256 MinHash values of which one bit each is kept. Signatures of sets with Jaccard
similarity J differ in 256 (1 - J) / 2 bits on average. All pairs of signatures that differ in at most ``distance``
bits are found, without exception, by the pigeonhole principle applied twice: cut into ``chunks`` chunks, a pair has
at most r = distance // chunks errors in one of them, so those errors are enumerated; and cut into p > r pieces, that
chunk has p - r pieces without error, so signatures are routed by the bits of such pieces, for each choice of them, and
the errors are enumerated among the chunk's other bits within such a group only. A signature travels
chunks * binomial(p, r) times: 24 times with p = 2, where a route has 2**10 groups, 48 times and 2**15 groups with
p = 4. p follows the number of unlike signatures, so that a group doesn't grow with the corpus; pairs are the same.

Groups are the connected components of the pairs. Within a routed group only enough pairs are kept to connect what
they connect, so a group of thousands of copies costs no quadratic output.

Defined results: a null text, and a null doc_id, are in no group; texts without a word are compared as whole strings
(so empty texts are copies of each other); repeated rows with one doc_id are one document and form no group by
themselves; the representative of a group is its least doc_id; an empty table gives an empty result; other columns
are ignored, whatever their names; ids keep their type.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from . import tokens, util

BITS = 256
DISTANCE = 23
CHUNKS = 12
_rng = np.random.Generator(np.random.PCG64(77003))
_A = _rng.integers(0, 1 << 32, BITS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BITS, dtype=np.uint32)
_ROWS = 1 << 11
GROUP = 8192  #: unlike signatures that a routed group holds on average at most
MAX_ROUTES = 2048
HOT = 200_000  #: rows of a routed group that one task holds
_HEAVY = 4096  #: pairs of a bucket from which on it is linked by link_all()


def minhash_bits(term: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Packed signatures (documents, 4) uint64 of runs of terms; runs must not be empty."""
    h = (tokens.mix(term) >> np.uint64(32)).astype(np.uint32)
    n = len(starts) - 1
    least = np.full((n, BITS), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(h), _ROWS):
        x = h[lo : lo + _ROWS, None] * _A
        x += _B
        first = int(np.searchsorted(starts, lo, "right")) - 1
        last = int(np.searchsorted(starts, lo + len(x), "left"))
        part = np.minimum.reduceat(x, np.maximum(starts[first:last] - lo, 0), axis=0)
        np.minimum(least[first:last], part, out=least[first:last])
    bit = (least * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return np.packbits(bit.astype(np.uint8), axis=1).view(np.uint64)


def _whole(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode()) >> 16


@tokens.tidy
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tokens.cut(whole):
            ids, text = batch.column(0), tokens.lowered(batch.column(1))
            for i, j, raw, off in tokens.blocks(text):
                h, _, doc = tokens.words(raw, off)
                term, _, starts = tokens.terms(h, doc, j - i)
                bare = np.flatnonzero(np.diff(starts) == 0)
                if len(bare):
                    extra = np.array([_whole(text[i + int(k)].as_py() or "") for k in bare], np.uint64)
                    term = np.insert(term, starts[bare], extra)
                    starts = starts + np.concatenate([[0], np.cumsum(np.diff(starts) == 0)])
                sig = minhash_bits(term, starts)
                ok = np.asarray(text.slice(i, j - i).is_valid()) & np.asarray(ids.slice(i, j - i).is_valid())
                packed = pa.array([sig[k].tobytes() for k in np.flatnonzero(ok)], pa.binary())
                yield pa.record_batch([ids.slice(i, j - i).filter(pa.array(ok)), packed], names=["doc_id", "sig"])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, sig BINARY (256 bits); rows without doc_id or text are left out."""
    util.make_importable(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))  # integers or own numbers, see groups()
    return slim.mapInArrow(_sign, "doc_id bigint, sig binary")


class Route(NamedTuple):
    """A way for signatures to meet: the bits that must agree, and the other bits of the chunk."""

    chunk: tuple[int, int]
    kept: list[tuple[int, int]]
    left: list[tuple[int, int]]


def _layout(chunks: int, distance: int, pieces: int = 0) -> list[Route]:
    """Every chunk is cut into ``pieces`` (at least r + 1) pieces; r of these may have the chunk's errors, so for each
    choice of r pieces there is a route by the bits of the others."""
    r = distance // chunks
    pieces = max(pieces, r + 1)
    ends = [round(BITS * k / chunks) for k in range(chunks + 1)]
    out = []
    for a, b in zip(ends, ends[1:]):
        cut = [(a + round((b - a) * k / pieces), a + round((b - a) * (k + 1) / pieces)) for k in range(pieces)]
        for faulty in combinations(range(pieces), r):
            out.append(Route((a, b), [x for i, x in enumerate(cut) if i not in faulty], [x for i, x in enumerate(cut) if i in faulty]))
    return out


def _pieces(rows: int, chunks: int, distance: int) -> int:
    """The least number of pieces for which a routed group holds ``GROUP`` of ``rows`` unlike signatures on average, or
    the number with the finest routes where none is fine enough; the pairs found don't depend on it."""
    r = distance // chunks
    width = min(round(BITS * (k + 1) / chunks) - round(BITS * k / chunks) for k in range(chunks))
    choices = [n for n in range(r + 1, width + 1) if chunks * math.comb(n, r) < MAX_ROUTES]
    for n in choices:
        if rows / 2 ** (width * (n - r) // n) <= GROUP:
            return n
    return choices[-1]


def _bits(sig: np.ndarray, a: int, b: int) -> np.ndarray:
    """Bits a to b of each signature as an integer (b - a <= 64)."""
    out = np.zeros(len(sig), np.uint64)
    at = a
    while at < b:
        w, o = divmod(at, 64)
        n = min(64 - o, b - at)
        part = (sig[:, w] >> np.uint64(o)) & np.uint64((1 << n) - 1)
        out |= part << np.uint64(at - a)
        at += n
    return out


def _joined(sig: np.ndarray, parts: list[tuple[int, int]]) -> tuple[np.ndarray, int]:
    """The bits of some ranges as one integer, and their number."""
    out, width = np.zeros(len(sig), np.uint64), 0
    for a, b in parts:
        out |= _bits(sig, a, b) << np.uint64(width)
        width += b - a
    return out, width


def _route(layout: list[Route]):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole, 10_000):
                sig = _unpack(batch.column(1))
                for k, route in enumerate(layout):
                    key = (np.uint64(k << 40) | _joined(sig, route.kept)[0]).astype(np.int64)
                    yield pa.record_batch([pa.array(key), batch.column(0), batch.column(1)], names=["route", "rep", "sig"])

    return run


def _unpack(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def hamming(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _flips(width: int, errors: int) -> np.ndarray:
    """Masks of at most ``errors`` bits of ``width``, the empty one first."""
    masks = [0]
    level = [(0, 0)]
    for _ in range(errors):
        level = [(m | 1 << i, i + 1) for m, lo in level for i in range(lo, width)]
        masks += [m for m, _ in level]
    return np.array(masks, np.uint64)


def _candidates(key: np.ndarray, masks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Index pairs (i < j) whose keys differ by one of the masks, as (i, j, False) in pieces; buckets with very many pairs come whole, as (members, members, True). ``key`` holds the routed group in its high bits."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    size = np.diff(np.append(first, len(k)))
    uniq = k[first]
    for m in masks:
        if m:
            at = np.searchsorted(uniq, uniq ^ m)
            at[at == len(uniq)] = 0
            a = np.flatnonzero((uniq[at] == uniq ^ m) & (uniq < uniq ^ m))
            b = at[a]
        else:
            a = b = np.flatnonzero(size > 1)
        heavy = size[a] * size[b] > _HEAVY
        for x, y in zip(a[heavy], b[heavy]):
            rows = order[first[x] : first[x] + size[x]]
            yield rows, rows if x == y else np.concatenate([rows, order[first[y] : first[y] + size[y]]]), True
        a, b = a[~heavy], b[~heavy]
        n = size[a] * size[b]
        lo = 0
        total = np.concatenate([[0], np.cumsum(n)])
        while lo < len(a):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + (1 << 20), "right")) - 1)
            rep = np.repeat(np.arange(lo, hi), n[lo:hi])
            pos = np.arange(total[hi] - total[lo]) - (total[rep] - total[lo])
            i = first[a[rep]] + pos // size[b[rep]]
            j = first[b[rep]] + pos % size[b[rep]]
            if not m:
                keep = i < j
                i, j = i[keep], j[keep]
            yield order[i], order[j], False
            lo = hi


def link_all(sig: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``distance`` that connect all that such pairs connect. Rows are compared with rows of other
    components only, and with one component only until a link is found."""
    n = len(sig)
    label = np.arange(n)
    out_i, out_j = [], []

    def join(i: int, js: np.ndarray) -> None:
        for j in js:
            if label[j] != label[i]:
                out_i.append(i)
                out_j.append(int(j))
                a, b = sorted((label[i], label[j]))
                label[label == b] = a

    near = np.flatnonzero(hamming(sig, sig[:1]) <= distance)
    out_i += [0] * (len(near) - 1)
    out_j += [int(x) for x in near if x]
    label[near] = 0
    for i in np.flatnonzero(label):
        big = np.flatnonzero(label == 0)
        step, at = 16, 0
        while at < len(big) and label[i] != 0:
            part = big[at : at + step]
            hit = part[hamming(sig[part], sig[i]) <= distance]
            join(int(i), hit[:1])
            if len(hit):
                break
            at, step = at + step, step * 4
        others = np.flatnonzero(label != label[i])
        others = others[others > i] if label[i] == 0 else others
        if len(others):
            join(int(i), others[hamming(sig[others], sig[i]) <= distance])
    return np.array(out_i, np.int64), np.array(out_j, np.int64)


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole routed groups, many at once: the input is sorted by route; a group may span batches."""
    held: list[pd.DataFrame] = []
    rows = 0
    for f in frames:
        if not len(f):
            continue
        held.append(f)
        rows += len(f)
        if rows < 20_000:
            continue
        x = pd.concat(held, ignore_index=True) if len(held) > 1 else f
        last = x["route"].to_numpy() == x["route"].iloc[-1]
        if "part" in x:
            last &= x["part"].to_numpy() == x["part"].iloc[-1]
        cutoff = int(last.argmax())
        if cutoff:
            yield x.iloc[:cutoff].reset_index(drop=True)
            x = x.iloc[cutoff:].reset_index(drop=True)
        held, rows = [x], len(x)
        if rows >= 20_000:
            rows = rows // 2
    if held:
        yield pd.concat(held, ignore_index=True)


def _pairs_of(x: pd.DataFrame, layout: list[Route], r: int, distance: int, every: bool) -> Iterator[pd.DataFrame]:
    route = x["route"].to_numpy().astype(np.uint64)
    rep = x["rep"].to_numpy()
    sig = np.frombuffer(b"".join(x["sig"]), np.uint64).reshape(-1, BITS // 64)
    place = (route >> np.uint64(40)).astype(np.int64)
    for where in np.unique(place):
        rows = np.flatnonzero(place == where)
        s, ids = sig[rows], rep[rows]
        _, group = np.unique(route[rows], return_inverse=True)
        block = part = None
        if "part" in x:  # groups within groups
            block, part = x["block"].to_numpy()[rows], x["part"].to_numpy()[rows]
            _, group = np.unique(np.stack([group, part]), axis=1, return_inverse=True)
            group = group.ravel()
        rest, width = _joined(s, layout[where].left)
        key = (group.astype(np.uint64) << np.uint64(width)) | rest
        parent = np.arange(len(rows))
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, j, whole in _candidates(key, _flips(width, r)):
            if whole and every:
                one = np.array_equal(i, j)
                u, v = (np.triu_indices(len(i), 1)) if one else (np.repeat(np.arange(len(i)), len(j) - len(i)), len(i) + np.tile(np.arange(len(j) - len(i)), len(i)))
                i, j = j[u], j[v]
            elif whole:
                u, v = link_all(s[j], distance)
                i, j = j[u], j[v]
            else:
                ok = (parent[i] != parent[j]) | every
                i, j = i[ok], j[ok]
            d = hamming(s[i], s[j])
            ok = d <= distance
            i, j, d = i[ok], j[ok], d[ok]
            if every and block is not None:  # two blocks meet in one part, a block itself in one of its parts
                here = (np.minimum(block[i], block[j]).astype(np.int64) << 31 | np.maximum(block[i], block[j])) == part[i]
                i, j, d = i[here], j[here], d[here]
            if not len(i):
                continue
            if every:
                met.append((i, j, d))
                if sum(len(m[0]) for m in met) > 100_000:
                    yield _here(met, s, ids, layout, r, int(where))
                    met = []
                continue
            keep = np.zeros(len(i), bool)
            for k in range(len(i)):
                u, v = i[k], j[k]
                while parent[u] != u:
                    parent[u] = parent[parent[u]]
                    u = parent[u]
                while parent[v] != v:
                    parent[v] = parent[parent[v]]
                    v = parent[v]
                if u != v:
                    parent[max(u, v)] = min(u, v)
                    keep[k] = True
            i, j, d = i[keep], j[keep], d[keep]
            a, b = ids[i], ids[j]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "distance": d})
        if met:
            yield _here(met, s, ids, layout, r, int(where))


def _here(met: list, s: np.ndarray, ids: np.ndarray, layout: list[Route], r: int, where: int) -> pd.DataFrame:
    """Of the pairs met on a route those that met on none before."""
    i, j, d = (np.concatenate(x) for x in zip(*met))
    one = _first_meeting(s[i], s[j], layout[: where + 1], r) == where
    a, b = ids[i[one]], ids[j[one]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "distance": d[one]})


def _first_meeting(x: np.ndarray, y: np.ndarray, layout: list[Route], r: int) -> np.ndarray:
    """The first route through which a pair meets; it is reported there only."""
    diff = x ^ y
    out = np.full(len(x), -1, np.int64)
    for k, route in enumerate(layout):
        kept = sum(np.bitwise_count(_bits(diff, a, b)).astype(np.int64) for a, b in route.kept)
        left = sum((np.bitwise_count(_bits(diff, a, b)).astype(np.int64) for a, b in route.left), np.zeros(len(x), np.int64))
        out[(out < 0) & (kept == 0) & (left <= r)] = k
    return out


def _sizes(layout: list[Route]):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole, 10_000):
                sig = _unpack(batch.column(0))
                for k, route in enumerate(layout):
                    key, n = np.unique((np.uint64(k << 40) | _joined(sig, route.kept)[0]).astype(np.int64), return_counts=True)
                    yield pa.record_batch([pa.array(key), pa.array(n)], names=["route", "n"])

    return run


def _split(routed: DataFrame, sigs: DataFrame, layout: list[Route], hot: int) -> DataFrame:
    """Routed rows, those of groups of more than ``hot`` rows in blocks of about that size: every two blocks meet in a
    part of their own, so no task holds more than two blocks, whatever share of all rows a group has."""
    n = sigs.select("sig").mapInArrow(_sizes(layout), "route bigint, n bigint").groupBy("route").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    large = util.saved(n.select("route", F.ceil(F.col("n") / hot).cast("int").alias("blocks")), "hot")
    if large.isEmpty():
        return routed.repartition("route").sortWithinPartitions("route")
    out = routed.join(large, "route", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    out = out.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.shiftleft(F.least("block", "other").cast("bigint"), 31).bitwiseOR(F.greatest("block", "other").cast("bigint"))
    return out.select("route", "rep", "sig", part.alias("part"), "block").repartition("route", "part").sortWithinPartitions("route", "part")


def hamming_pairs(sigs: DataFrame, distance: int = DISTANCE, chunks: int = CHUNKS, every: bool = True, pieces: int = 0, hot: int = HOT) -> DataFrame:
    """All pairs a < b of rows (rep BIGINT, sig BINARY) within ``distance`` bits, each once, with their distance; with
    ``every`` false only pairs that connect what all of them connect, some perhaps more than once. More ``pieces`` make
    finer groups and more routes, with the same pairs; 0 is the least number. Groups beyond ``hot`` rows are cut into
    blocks that meet two at a time."""
    if not 8 <= chunks <= 256:
        raise ValueError("chunks must be from 8 to 256, so that a chunk's bits and its group fit one integer")
    util.make_importable(sigs.sparkSession)
    layout, r = _layout(chunks, distance, pieces), distance // chunks
    routed = sigs.select("rep", "sig").mapInArrow(_route(layout), "route bigint, rep bigint, sig binary")

    @tokens.tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in _groups(frames):
            yield from _pairs_of(x, layout, r, distance, every)

    return _split(routed, sigs, layout, hot).mapInPandas(run, "a bigint, b bigint, distance bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node that it is connected with) of the edges (a, b): alternating large and small stars;
    every round is written to the shared folder, so none is computed twice."""
    e = util.saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        new = util.saved(small, "edges")
        same = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first() == e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if e.inputFiles():
            util.drop_saved(e)
        e = new
        if same:
            return e.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(docs: DataFrame, distance: int, chunks: int) -> DataFrame:
    sigs = util.saved(signatures(docs), "signatures")
    reps = util.saved(sigs.groupBy("sig").agg(F.min("doc_id").alias("rep")), "representatives")
    roots = components(hamming_pairs(reps, distance, chunks, every=False, pieces=_pieces(reps.count(), chunks, distance)))
    by_sig = reps.join(roots, reps.rep == roots.node, "left").select("sig", F.coalesce("root", "rep").alias("group_id"))
    member = sigs.distinct().join(by_sig, "sig").select("doc_id", "group_id")
    # a doc_id on rows of unlike texts can be in two groups: it stays in the least
    member = member.groupBy("doc_id").agg(F.min("group_id").alias("group_id"))
    return member.where("doc_id <> group_id").unionByName(member.where("doc_id <> group_id").select(F.col("group_id").alias("doc_id"), "group_id").distinct())


def groups(docs: DataFrame, distance: int = DISTANCE, chunks: int = CHUNKS) -> DataFrame:
    """doc_id, group_id of every document in a group of two or more; group_id is the least doc_id of the group."""
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return _grouped(docs, distance, chunks)
    own = util.saved(docs.select("doc_id").where("doc_id is not null").distinct().sort("doc_id").withColumn("own", F.monotonically_increasing_id()), "ids")
    got = _grouped(docs.select("doc_id", "text").join(own, "doc_id").select(F.col("own").alias("doc_id"), "text"), distance, chunks)
    named = got.join(own.withColumnRenamed("doc_id", "name"), got.doc_id == F.col("own")).select("name", "group_id")
    return named.join(own, F.col("group_id") == F.col("own")).select(F.col("name").alias("doc_id"), F.col("doc_id").alias("group_id"))


def deduplicate(docs: DataFrame, distance: int = DISTANCE, chunks: int = CHUNKS) -> DataFrame:
    """One document of each group: the columns of ``docs``, without documents that are near copies of one with a
    lesser doc_id; rows of one doc_id with unlike texts are judged each by its own text. Of rows that repeat a doc_id
    with the same text one stays, the first by its columns written as JSON; rows without doc_id or text all stay."""
    cols = docs.columns
    c_id, c_hash, c_own, c_drop, c_text, c_row = util.fresh(docs, "dedup_id", "dedup_hash", "dedup_own", "dedup_drop", "dedup_text", "dedup_row")
    id_, text = F.col("doc_id"), F.xxhash64(F.col("text").cast("string"))
    rows = docs.where("doc_id is not null and text is not null").groupBy(id_.alias(c_id), text.alias(c_hash)).agg(F.count("*").alias(c_own))
    again = util.saved(rows.where(F.col(c_own) > 1).select(c_id, c_hash), "repeated")
    mixed = rows.groupBy(c_id).agg(F.count("*").alias(c_own)).where(F.col(c_own) > 1)
    if mixed.isEmpty():
        drop = util.saved(groups(docs, distance, chunks).where("doc_id <> group_id").select(F.col("doc_id").alias(c_drop)), "dropped")
        kept = docs.join(drop, id_ == F.col(c_drop), "left_anti")
    else:  # each (doc_id, text) is a document of its own, in the order of doc_id
        own = util.saved(rows.select(c_id, c_hash).sort(c_id, c_hash).withColumn(c_own, F.monotonically_increasing_id()), "rows")
        known = docs.select(id_.alias(c_id), text.alias(c_hash), F.col("text").alias(c_text)).join(own, [c_id, c_hash]).select(F.col(c_own).alias("doc_id"), F.col(c_text).alias("text"))
        drop = groups(known, distance, chunks).where("doc_id <> group_id").select(F.col("doc_id").alias(c_own))
        drop = util.saved(own.join(drop, c_own).select(F.col(c_id).alias(c_drop), F.col(c_hash).alias(c_text)), "dropped")
        kept = docs.join(drop, (id_ == F.col(c_drop)) & (text == F.col(c_text)), "left_anti")
    if again.isEmpty():
        return kept.select(cols)
    on = (id_ == F.col(c_id)) & (text == F.col(c_hash))
    once = kept.join(again, on, "left_anti").select(cols)
    whole = F.struct(*[F.col(f"`{c}`") for c in cols])
    several = kept.join(again, on).groupBy(c_id, c_hash).agg(F.min_by(whole, F.to_json(whole)).alias(c_row)).select(f"{c_row}.*")
    return once.unionByName(several)
