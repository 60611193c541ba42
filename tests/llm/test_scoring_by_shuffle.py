"""Language-model scores of corpora whose filter is too large to be broadcast."""

import numpy as np
import pandas as pd
import pytest

from statloom.llm import lm

SMALL = "/root/testdata/sf0.001"


def shuffled_bytes(spark):
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, sc._jvm.java.util.ArrayList())
    return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}


def written_by(spark, run):
    before = shuffled_bytes(spark)
    run()
    return sum(v for k, v in shuffled_bytes(spark).items() if k not in before)


def test_ngrams_travel_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    counted = written_by(spark, lambda: lm.train(docs))
    whole = written_by(spark, lambda: lm.score(docs, max_mb=0).collect())
    assert counted > 100_000
    assert whole < 2 * counted, (whole, counted)


@pytest.mark.parametrize("span_text", [1_000, 1 << 30])
def test_same_scores_by_shuffle_as_by_broadcast(spark, monkeypatch, span_text):
    monkeypatch.setattr(lm, "_SPAN_TEXT", span_text)
    rows = [(str(r["doc_id"]), r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    rows += [rows[3], rows[3], ("none", None), ("empty", ""), ("signs", "... --"), (None, "one word"), ("one", "word"), (rows[5][0], "another text with this id"), ("long", "many words of a long text " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    a, b = (sorted(map(tuple, lm.score(df, max_mb=mb).collect()), key=str) for mb in (100, 0))
    assert len(a) == len(rows) and a == b


def test_a_range_is_probed_once_however_many_blocks_ask(monkeypatch):
    rng = np.random.default_rng(4)
    pool = np.unique((rng.integers(0, 1 << 60, 500, dtype=np.uint64) | np.uint64(5 << 60)) & np.uint64((6 << 60) - 1) | np.uint64(1))
    blocks = [np.sort(rng.choice(pool, 200, replace=False)) for _ in range(50)]
    counts = [rng.integers(1, 300, 200).astype(np.uint32) for _ in blocks]
    asked = pd.DataFrame({"span": 5, "block": range(50), "keys": [lm._packed(k, 4) for k in blocks], "counts": [c.view(np.uint8).reshape(-1, 4).T.tobytes() for c in counts], "n_words": 0})
    probes, probe = [], lm.Filter.probe
    monkeypatch.setattr(lm.Filter, "probe", lambda self, key: probes.append(len(key)) or probe(self, key))
    got = lm._answered(6, 4)(asked)
    total = dict.fromkeys(np.unique(np.concatenate(blocks)).tolist(), 0)
    for k, c in zip(blocks, counts):
        for x, n in zip(k.tolist(), c.tolist()):
            total[x] += n
    assert probes == [len(total)] and got["n_keys"].sum() == len(total)
    levels = [np.frombuffer(x, np.uint8) for x in got["levels"]]
    want = [lm.level_of(np.array([total[x] for x in k.tolist()])) for k in blocks]
    assert all(len(a) == len(b) and (a >= b).all() for a, b in zip(levels, want))
    assert np.mean([a == b for a, b in zip(levels, want)]) > 0.97


@pytest.mark.parametrize("max_mb", [0, 100])
def test_blocks_without_a_word(spark, max_mb):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "!")], "doc_id bigint, text string").coalesce(1)
    got = sorted(map(tuple, lm.score(df, max_mb=max_mb).collect()))
    assert got == [(1, None, None, None), (2, 0, None, None), (3, 0, None, None)]
