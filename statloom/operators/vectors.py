"""Node embeddings: what to embed, and exact cosine search."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F


def to_embed(nodes: DataFrame, types: list[str], since=None, sentences: DataFrame | None = None) -> DataFrame:
    """subject_id, label, text, content_key of named nodes of some types, changed since a time; a curated sentence goes
    before the name."""
    mine = nodes.where(F.arrays_overlap("types", F.array(*[F.lit(t) for t in types])) & (F.coalesce("name", F.lit("")) != ""))
    if since is not None:
        mine = mine.where(F.col("last_update_timestamp") > F.lit(since))
    if sentences is not None:
        mine = mine.join(sentences.select("subject_id", F.col("sentence").alias("__sentence")), "subject_id", "left")
    else:
        mine = mine.withColumn("__sentence", F.lit(None).cast("string"))
    label = F.coalesce("__sentence", "name")
    text = F.to_json(F.struct(F.col("subject_id").alias("title"), label.alias("name")))
    return mine.select("subject_id", label.alias("label"), text.alias("text"), F.sha2(text, 256).alias("content_key"))


def embed(rows: DataFrame, model: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """Adds ``embedding``; ``model`` gets the texts of a batch."""
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(model(s.tolist()), np.float64)))

    return rows.withColumn("embedding", F.pandas_udf(run, "array<double>")("text"))


def cosine(a, b):
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    return F.try_divide(dot, norm(a) * norm(b))


PART = 2_000_000  #: numbers of the queries that go to the workers at a time: 16 MB
TILE = 1024  #: queries that are compared with some items at a time
ITEMS = 1024  #: items of a batch that are compared at a time: 8 MB of similarities


def _best(s: np.ndarray, ids: np.ndarray, top_s: np.ndarray, top_i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row of some similarities and those held so far; ties by id."""
    s = np.concatenate([top_s, s], axis=1)
    i = np.concatenate([top_i, np.broadcast_to(ids, (len(s), len(ids)))], axis=1)
    if s.shape[1] > 4 * k:  # all that is as good as the k-th, then sorted
        least = np.round(np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k], 9) - 1e-9
        most = int((s >= least[:, None]).sum(axis=1).max())
        at = np.argpartition(-s, min(most, s.shape[1] - 1), axis=1)[:, : max(most, k)]
        s, i = np.take_along_axis(s, at, 1), np.take_along_axis(i, at, 1)
    order = np.lexsort((i, -np.round(s, 9)), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def nearest(items: DataFrame, queries: DataFrame, k: int, item: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query, item, similarity, rank of the k most similar items of every query, exactly, whatever the type of ids; an
    item isn't compared with itself, and vectors that are null or zero are similar to nothing.

    Meant for a stated set of queries against all items: items are compared where they lie, in tiles of matrix products,
    and every task keeps its own k best of each query, so the only exchange moves k rows a query and task. Queries are
    cut by a hash into parts of about ``PART`` numbers; each part is one bounded broadcast and one pass over the items."""
    spark = items.sparkSession
    kind = items.schema[item].dataType.simpleString()
    ids = queries.select(F.col(item).alias("query"), F.col(vector).cast("array<double>").alias("v")).where("v is not null and query is not null")
    size = ids.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    parts = max(1, -(-int(size["n"]) * int(size["d"] or 1) // PART))
    best = None
    for p in range(parts):
        got = ids.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == p).toPandas()  # about PART numbers
        if not len(got):
            continue
        q = np.stack(got["v"].to_numpy()).astype(np.float64)
        norm = np.linalg.norm(q, axis=1, keepdims=True)
        held = spark.sparkContext.broadcast((got["query"].to_numpy(), q / np.where(norm > 0, norm, 1), (norm > 0)[:, 0]))

        def run(frames, held=held):
            names, qs, some = held.value
            names = names.astype(str) if names.dtype == object else names
            tops = [(np.full((len(names[a : a + TILE]), 0), -np.inf), np.zeros((len(names[a : a + TILE]), 0), names.dtype)) for a in range(0, len(names), TILE)]
            for f in (frame[a : a + ITEMS] for frame in frames for a in range(0, len(frame), ITEMS)):
                f = f[f["v"].notna() & f["i"].notna()]
                if not len(f):
                    continue
                x = np.stack(f["v"].to_numpy()).astype(np.float64)
                length = np.linalg.norm(x, axis=1, keepdims=True)
                x, own = x / np.where(length > 0, length, 1), f["i"].to_numpy().astype(str if names.dtype.kind == "U" else names.dtype)
                for t, a in enumerate(range(0, len(names), TILE)):
                    s = qs[a : a + TILE] @ x.T
                    s[:, length[:, 0] == 0] = -np.inf
                    s[~some[a : a + TILE]] = -np.inf
                    s[names[a : a + TILE, None] == own[None, :]] = -np.inf
                    tops[t] = _best(s, own, *tops[t], k)
            for t, a in enumerate(range(0, len(names), TILE)):
                ok = np.isfinite(tops[t][0])
                yield pd.DataFrame({"query": np.repeat(names[a : a + TILE], ok.sum(1)), "item": tops[t][1][ok], "similarity": tops[t][0][ok]})

        part = items.select(F.col(item).alias("i"), F.col(vector).cast("array<double>").alias("v")).mapInPandas(run, f"query {kind}, item {kind}, similarity double")
        best = part if best is None else best.unionByName(part)
    if best is None:
        return items.select(F.col(item).alias("query"), F.col(item).alias("item"), F.lit(0.0).alias("similarity"), F.lit(1).alias("rank")).where("false")
    w = Window.partitionBy("query").orderBy(F.desc(F.round("similarity", 9)), "item")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
