"""5. Language identification by rank-order profiles (Cavnar and Trenkle).

A profile is the most frequent character n-grams, n = 1 to 3, of words padded with ``_``. Each language's profile
comes from all documents that carry its label; a document is given the language whose profile has the least
out-of-place distance: the sum over the document's own profile of the difference in rank, or the profile size where
an n-gram is missing.

Defined results: equally frequent n-grams rank by code points; equally distant languages go by name; a null text
gives null language and distance; a text without a letter gives a null language and distance 0; repeated rows give
repeated rows; rows without a language or text don't train; without any trained language the result is null; other
columns are ignored; an empty table gives an empty result. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import tokens, util

TOP = 300
_PAD = ord("_")
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point of each letter, 0 for anything else."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            if chr(cp).isalpha():
                table[cp] = cp
        _letters.append(table)
    return _letters[0]


def ngrams(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a lower-case text: three code points of 21 bits, 0 where shorter."""
    cp = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    seq = np.zeros(len(cp) + 2, np.int64)
    seq[1:-1] = cp
    keep = seq != 0
    keep[1:] |= seq[:-1] != 0
    keep[0] = True
    seq = seq[keep]
    if len(seq) < 3 and not seq.any():
        return np.zeros(0, np.int64)
    if seq[-1] != 0:
        seq = np.append(seq, 0)
    # a run of other characters is one boundary, so that words share it
    first, letter = seq.copy(), seq != 0
    first[~letter] = _PAD
    a, b, c = first[:-2], first[1:-1], first[2:]
    one = first[letter] << 42
    two = first[:-1] << 42 | first[1:] << 21
    three = (a << 42 | b << 21 | c)[letter[1:-1]]
    return np.concatenate([one, two[letter[:-1] | letter[1:]], three])


def ranked(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, best first; ties by code."""
    if not len(codes):
        return codes
    codes = np.sort(codes)
    at = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    count = np.diff(np.append(at, len(codes)))
    if len(at) > top:
        bar = np.partition(count, len(at) - top)[len(at) - top]
        sel = np.flatnonzero(count >= bar)
    else:
        sel = np.arange(len(at))
    order = np.argsort(-count[sel], kind="stable")[:top]
    return codes[at[sel[order]]]


@tokens.tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) sums of the partition, merged language by language."""
    table = _letter_table()
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merge(lang: str, parts: list[np.ndarray]) -> None:
        code, n = np.unique(np.concatenate(parts), return_counts=True)
        if lang in total:
            code, inv = np.unique(np.concatenate([total[lang][0], code]), return_inverse=True)
            n = np.bincount(inv, np.concatenate([total[lang][1], n]), len(code)).astype(np.int64)
        total[lang] = (code, n)

    for whole in batches:
        for batch in tokens.cut(whole, 500):
            held: dict[str, list[np.ndarray]] = {}
            size = 0
            for lang, text in zip(batch.column(0).to_pylist(), tokens.lowered(batch.column(1)).to_pylist()):
                held.setdefault(lang, []).append(ngrams(text, table))
                size += len(text)
                if size > 1 << 20:
                    for k, v in held.items():
                        merge(k, v)
                    held, size = {}, 0
            for k, v in held.items():
                merge(k, v)
    for lang, (code, n) in total.items():
        for i in range(0, len(code), 50_000):
            c = code[i : i + 50_000]
            yield pa.record_batch([pa.array([lang] * len(c), pa.string()), pa.array(c), pa.array(n[i : i + 50_000])], names=["lang", "code", "n"])


def profiles(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, code, rank (from 0) of the ``top`` n-grams of each language, counted over all labelled documents."""
    util.make_importable(docs.sparkSession)
    slim = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null and text is not null")
    counts = slim.mapInArrow(_count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return counts.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < top).select("lang", "code", "rank")


def _assign(langs: list[str], known: list[tuple[np.ndarray, np.ndarray]], top: int):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letter_table()
        for whole in batches:
            for batch in tokens.cut(whole, 1000):
                best, distance = [], []
                for text in tokens.lowered(batch.column(1)).to_pylist():
                    codes = ranked(ngrams(text, table), top) if text else np.zeros(0, np.int64)
                    if not len(codes) or not langs:
                        best.append(None)
                        distance.append(None if text is None or not langs else 0)
                        continue
                    found = []
                    mine = np.arange(len(codes))
                    for code, rank in known:
                        at = np.minimum(np.searchsorted(code, codes), len(code) - 1)
                        found.append(int(np.where(code[at] == codes, np.abs(rank[at] - mine), top).sum()))
                    k = min(range(len(langs)), key=lambda i: (found[i], langs[i]))
                    best.append(langs[k])
                    distance.append(found[k])
                yield pa.record_batch([batch.column(0), pa.array(best, pa.string()), pa.array(distance, pa.int64())], names=["doc_id", "language", "distance"])

    return run


def identify(docs: DataFrame, profile: DataFrame | None = None, top: int = TOP) -> DataFrame:
    """doc_id, language, distance. The profiles that go to the workers have ``top`` rows a language, at any scale."""
    rows = (profiles(docs, top) if profile is None else profile).collect()
    by: dict[str, list[tuple[int, int]]] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["code"], r["rank"]))
    langs = sorted(by)
    known = []
    for lang in langs:
        pairs = np.array(sorted(by[lang]), np.int64).reshape(-1, 2)
        known.append((pairs[:, 0].copy(), pairs[:, 1].copy()))
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_assign(langs, known, top), f"doc_id {util.id_type(docs)}, language string, distance bigint")


def oracle(top: int = TOP) -> str:
    return f"""
with w as (
  select doc_id::bigint as doc_id, lang, text, row_number() over () as r, regexp_replace(lower(text), '[^\\p{{L}}]+', '_', 'g') as t from documents),
p as (select doc_id, lang, text, r, '_' || unnest(string_split(t, '_')) || '_' as word from w),
g as (
  select r, lang, substr(word, i, n) as gram
  from (select r, lang, word, unnest(range(1, length(word) + 1)) as i from p where length(word) > 2), (values (1), (2), (3)) v(n)
  where i + n - 1 <= length(word) and substr(word, i, n) <> '_'),
l as (
  select lang, gram, row_number() over (partition by lang order by n desc, gram) - 1 as rank
  from (select lang, gram, count(*) as n from g where lang is not null group by all) qualify rank < {top}),
d as (
  select r, gram, row_number() over (partition by r order by n desc, gram) - 1 as rank
  from (select r, gram, count(*) as n from g group by all) qualify rank < {top}),
s as (
  select d.r, k.lang, sum(case when l.rank is null then {top} else abs(l.rank - d.rank) end)::bigint as distance
  from d cross join (select distinct lang from l) k left join l on l.lang = k.lang and l.gram = d.gram group by all),
b as (select r, lang, distance from s qualify row_number() over (partition by r order by distance, lang) = 1)
select doc_id, b.lang as language, case when w.text is null then null else coalesce(b.distance, 0) end::bigint as distance
from w left join b using (r)"""
