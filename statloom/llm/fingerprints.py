"""1. Document fingerprints by consistent weighted sampling.

For sample k every term t gets r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), all derived from a hash of (t, k). A term
of weight w is quantised to y = exp(r (floor(ln w / r + b) - b)) and the sample is the (t, floor(..)) of least
c / (y e^r). Two documents agree in a sample with probability sum min(w, w') / sum max(w, w'), the generalised
Jaccard similarity of their weights; here the weight of a term is its count in the document.

Defined results: a null text gives a null signature and 0 terms; an empty text, or one without a word, gives an
empty signature; repeated rows give repeated rows; ties in the least value go to the smaller term hash, so equal
texts always have equal signatures; other columns than ``doc_id`` and ``text`` are ignored; an empty table gives an
empty result. Texts are used whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import tokens, util

SAMPLES = 64
_ROWS = 1 << 14


def variates(term: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, ln c, b) as float32 arrays of shape (samples, len(term))."""
    salt = tokens.mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    x = tokens.mix(term[None, :] ^ salt[:, None])
    y = tokens.mix(x + np.uint64(0x9E3779B97F4A7C15))
    scale, low = np.float32(2.0**-32), np.uint64(0xFFFFFFFF)

    def unit(v: np.ndarray) -> np.ndarray:
        return (v.astype(np.uint32).astype(np.float32) + np.float32(0.5)) * scale

    a1, a2, a3, a4 = unit(x >> np.uint64(32)), unit(x & low), unit(y >> np.uint64(32)), y & low
    r = -np.log(a1 * a2)
    c3, c4 = a3, ((a4 >> np.uint64(16)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)
    b = ((a4 & np.uint64(0xFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)
    return r, np.log(-np.log(c3 * c4)), b


def sketch(term: np.ndarray, count: np.ndarray, starts: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Signatures, shape (documents, samples), of documents given as runs of (term, count); 0 where a run is empty."""
    n = len(starts) - 1
    best = np.full((n, samples), np.inf, np.float32)
    sig = np.zeros((n, samples), np.uint64)
    for lo in range(0, len(term), _ROWS):
        t, w = term[lo : lo + _ROWS], count[lo : lo + _ROWS]
        distinct, inv = np.unique(t, return_inverse=True)
        r, lc, b = variates(distinct, samples)
        value = np.take(lc + r * (b - 1), inv, axis=1)
        level = np.zeros(value.shape, np.int32)
        many = np.flatnonzero(w > 1)
        if len(many):
            rm, lm, bm = (np.take(x, inv[many], axis=1) for x in (r, lc, b))
            q = np.floor(np.log(w[many]).astype(np.float32) / rm + bm)
            value[:, many] = lm - rm * (q - bm + 1)
            level[:, many] = q
        first = int(np.searchsorted(starts, lo, "right")) - 1
        last = int(np.searchsorted(starts, lo + len(t), "left"))
        ks = np.arange(samples)
        for d in range(first, last):
            s, e = max(starts[d] - lo, 0), min(starts[d + 1] - lo, len(t))
            if s >= e:
                continue
            at = value[:, s:e].argmin(axis=1) + s
            v = value[ks, at]
            better = v < best[d]
            best[d][better] = v[better]
            hashed = tokens.mix(t[at] * np.uint64(0xA24BAED4963EE407) + level[ks, at].astype(np.uint64))
            sig[d][better] = hashed[better]
    return sig


def _map(samples: int):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole):
                ids, text = batch.column(0), tokens.lowered(batch.column(1))
                for i, j, raw, off in tokens.blocks(text):
                    h, _, doc = tokens.words(raw, off)
                    term, count, starts = tokens.terms(h, doc, j - i)
                    sig = sketch(term, count, starts, samples).view(np.int64)
                    n_terms = np.diff(starts)
                    known = np.asarray(text.slice(i, j - i).is_valid())
                    size = np.where(n_terms > 0, samples, 0)
                    pos = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(pos, mask=np.append(~known, False)), pa.array(sig[n_terms > 0].ravel()))
                    yield pa.record_batch([ids.slice(i, j - i), pa.array(n_terms.astype(np.int64)), lists], names=["doc_id", "n_terms", "signature"])

    return run


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_terms, signature ARRAY<BIGINT> of ``samples`` values. One pass, no shuffle."""
    util.make_importable(docs.sparkSession)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_map(samples), f"doc_id {util.id_type(docs)}, n_terms bigint, signature array<bigint>")


def similarity(a, b):
    """Estimated generalised Jaccard similarity of two signature columns; null where either is null or empty."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda v: v))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), same / F.size(a))
