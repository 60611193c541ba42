"""Finer routes find the same pairs; names that clash; ids of other types; defined results of decoding and mixing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import bpe, mixing, neardup


@pytest.mark.parametrize("distance,chunks,pieces", [(23, 12, 4), (23, 12, 7), (23, 8, 5), (7, 8, 1), (30, 12, 5)])
def test_finer_routes_find_every_pair_once(spark, distance, chunks, pieces):
    rng = np.random.default_rng(11)
    bits = []
    for b in rng.integers(0, 2, (25, 256), dtype=np.uint8):
        for k in (0, 1, 3, 6, 7, 12, 20, 23, 24, 40):
            x = b.copy()
            x[rng.choice(256, k, replace=False)] ^= 1
            bits.append(x)
    bits = np.array(bits)
    df = spark.createDataFrame([(i, bytearray(np.packbits(x).tobytes())) for i, x in enumerate(bits)], "rep bigint, sig binary")
    want = {(i, j, int(d)) for i in range(len(bits)) for j in range(i + 1, len(bits)) if (d := (bits[i] != bits[j]).sum()) <= distance}
    got = [tuple(r) for r in neardup.hamming_pairs(df, distance, chunks, pieces=pieces).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("hot", [7, 40])
def test_hot_groups_are_cut_and_lose_nothing(spark, hot):
    rng = np.random.default_rng(12)
    base = rng.integers(0, 2, (2, 256), dtype=np.uint8)
    bits = np.array([np.where(rng.random(256) < 0.04, 1 - base[i % 2], base[i % 2]) for i in range(120)])
    df = spark.createDataFrame([(i, bytearray(np.packbits(x).tobytes())) for i, x in enumerate(bits)], "rep bigint, sig binary")
    want = {(i, j, int(d)) for i in range(120) for j in range(i + 1, 120) if (d := (bits[i] != bits[j]).sum()) <= 23}
    got = [tuple(r) for r in neardup.hamming_pairs(df, hot=hot).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    root = list(range(120))
    for a, b, _ in neardup.hamming_pairs(df, every=False, hot=hot).collect():
        a, b = root[a], root[b]
        root = [min(a, b) if r in (a, b) else r for r in root]
    truth = list(range(120))
    for a, b, _ in sorted(want):
        a, b = truth[a], truth[b]
        truth = [min(a, b) if r in (a, b) else r for r in truth]
    assert root == truth


def test_routes_follow_the_number_of_signatures():
    few, many = neardup._pieces(200_000, 12, 23), neardup._pieces(10**9, 12, 23)
    assert few == 2 and many > few
    kept = [sum(b - a for a, b in r.kept) for r in neardup._layout(12, 23, many)]
    assert min(kept) >= 17 and max(sum(b - a for a, b in r.kept) for r in neardup._layout(8, 23, 10)) <= 40


def test_clashing_names_and_text_ids(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [("b", text, 1, 5, 1.0, "x"), ("a", text + " more", 2, 6, 2.0, "y"), ("a", text + " more", 2, 6, 0.5, "y"), (None, text, 3, 7, 3.0, "z"), ("c", "unlike text", 4, 8, 4.0, "q")]
    df = spark.createDataFrame(rows, "doc_id string, text string, __drop int, __id int, dedup_id double, DEDUP_HASH string")
    got = neardup.deduplicate(df)
    assert got.columns == df.columns
    assert sorted((str(r["doc_id"]), r["dedup_id"]) for r in got.collect()) == [("None", 3.0), ("a", 0.5), ("c", 4.0)]
    assert {tuple(r) for r in neardup.groups(df).collect()} == {("a", "a"), ("b", "a")}


def test_decoding_unknown_ids_fails_and_nulls_are_null(spark):
    some = spark.createDataFrame([("x", [1, None]), ("y", None), ("z", [])], "doc_id string, token_ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(some).collect()} == {"x": None, "y": None, "z": ""}
    for bad in (-1, 10**7):
        with pytest.raises(Exception, match="vocabulary doesn't have"):
            bpe.decode(spark.createDataFrame([(1, [bad])], "doc_id int, token_ids array<int>")).collect()


def test_mixing_keeps_names_and_refuses_bad_schedules(spark):
    docs = spark.createDataFrame([(str(i), "x" * 40, "ab"[i % 2], f"o{i}", 7) for i in range(20)], "doc_id string, text string, source string, mix_order string, n_tokens int")
    got = mixing.mix(docs)
    assert got.columns == docs.columns and {r["mix_order"] for r in got.collect()} == {f"o{i}" for i in range(20)}
    assert {r["tokens"] for r in mixing.positions(docs, token_count="n_tokens").collect()} == {7}
    plans = {"sum to": [("a", [0.9, 0.1]), ("b", [0.2, 0.9])], "without weights": [("a", [1.0, 1.0])], "more than one": [("a", [0.5, 0.5]), ("a", [0.5, 0.5])], "at least 0": [("a", [1.5, 1.0]), ("b", [-0.5, 0.0])]}
    for message, rows in plans.items():
        with pytest.raises(ValueError, match=message):
            mixing.mix(docs, spark.createDataFrame(rows, "source string, weights array<double>"))
    fine = spark.createDataFrame([("a", [0.5, 0.5]), ("b", [0.5, 0.5])], "source string, weights array<double>")
    assert mixing.mix(docs.withColumn("source", F.lit("a")), fine).count() >= 20
