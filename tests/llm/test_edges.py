"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for operators and stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statloom.llm import bpe, fingerprints, langid, lm, mixing, neardup, pii, quality, toxicity, warc

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens int, group_id string, sig string, rep bigint, term string, u double, position double, epoch int, score double, row bigint, `count` int"
LONG = "the long river runs on. " * 60_000


@pytest.fixture(scope="module")
def docs(spark):
    text = "The quiet river meets the old stone bridge near the market."
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (None, "no id here at all", "en", None), (4, LONG, "en", "b"), (5, text, "en", None), (6, "!!! ???", "de", "a"), (7, " \n \n", "de", "c"), (None, None, None, None), (8, "Straße 日本語 \U0001f642 x@y.org", "de", "a")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 9, "g", "s", 3, "t", 0.5, 0.1, 2, 0.3, 4, 5) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 1), (5, 0, None), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "fingerprints": lambda d, _: fingerprints.fingerprints(d), "toxicity": toxicity.score, "pii": lambda d, _: pii.sanitised(d), "langid": lambda d, _: langid.identify(d), "mixing": lambda d, _: mixing.positions(d),
    "bpe": lambda d, _: bpe.encode(d, check=True), "quality": lambda d, _: quality.clean_lines(d), "lm": lambda d, _: lm.score(d), "neardup": lambda d, _: neardup.groups(d),
}
ROWS = {k: 11 for k in OPERATORS} | {"neardup": 2}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_gets_its_result(name, docs, labels):
    got = OPERATORS[name](docs, labels)
    rows = got.collect()
    assert len(rows) == ROWS[name] or name == "mixing" and len(rows) >= 11
    if name in ("fingerprints", "bpe", "langid", "quality", "lm"):
        assert len({str(r) for r in rows if r["doc_id"] == 1}) == 1
    of = {r["doc_id"]: r for r in rows}
    if name == "fingerprints":
        assert of[2]["signature"] is None and of[2]["n_terms"] == 0 and of[3]["signature"] == [] and of[1]["signature"] == of[5]["signature"]
    if name == "toxicity":
        assert of[2]["score"] is None and not of[2]["is_toxic"] and of[3]["words"] == []
    if name == "pii":
        assert of[2]["text"] is None and of[2]["n_entities"] is None and of[3]["text"] == "" and "[EMAIL]" in of[8]["text"]
    if name == "langid":
        assert of[2]["language"] is None and of[2]["distance"] is None and of[3]["language"] is None and of[3]["distance"] == 0
    if name == "bpe":
        assert of[2]["token_ids"] is None and of[3]["token_ids"] == [] and all(r["round_trip"] for r in rows if r["token_ids"] is not None)
    if name == "quality":
        assert of[2]["keep"] is False and of[2]["kept_text"] is None and of[3]["lost"] == 0 and of[3]["keep"] is False and of[7]["kept_text"] == " \n \n"
    if name == "lm":
        assert of[2]["n_tokens"] is None and of[3]["n_tokens"] == 0 and of[3]["log10_prob"] is None and of[4]["n_tokens"] == 300_000
    if name == "mixing":
        assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None} and all(r["position"] is not None and 0 <= r["position"] <= 1 for r in rows)
    if name == "neardup":
        assert {tuple(r) for r in rows} == {(1, 1), (5, 1)}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_empty_results(name, docs, labels):
    assert OPERATORS[name](docs.where("false"), labels.where("false")).count() == 0


def test_texts_without_words_are_compared_whole(spark):
    df = spark.createDataFrame([(1, ""), (2, ""), (3, "???"), (4, "!!!"), (5, "???")], "doc_id bigint, text string")
    assert {tuple(r) for r in neardup.groups(df).collect()} == {(1, 1), (2, 1), (3, 3), (5, 3)}


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows(k, docs, labels, spark, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    name, stage = corpus_pipeline.STAGES[k]
    got = stage(spark, docs, str(tmp_path))
    if k < 4:
        assert got.columns == docs.columns
    n = got.count()
    assert n == {"toxicity": 11, "near_duplicates": 9, "personal_data": 11, "bpe": 11}.get(name, n) and n >= 9
    if name == "near_duplicates":
        assert sorted(str(r[0]) for r in got.select("doc_id").collect()) == ["1", "2", "3", "4", "6", "7", "8", "None", "None"]
    assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_warc_round_trip_of_odd_pages(spark):
    rows = [(1, "http://x/\n", "<p>é</p>"), (1, "http://x/\n", "<p>é</p>"), (None, None, ""), (2, "u", None), (3, "u", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, payload string")
    got = warc.round_trip(pages).collect()
    assert sorted(((r["page_id"] or 0), len(r["html"]) if r["html"] is not None else -1) for r in got) == [(0, 0), (1, 8), (1, 8), (2, -1), (3, 3_000_000)]
    assert all(r["digest_ok"] for r in got)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_pipeline_equals_its_stages_by_hand(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = {r[0] for r in toxicity.score(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("is_toxic").collect()}
    left = docs.where(~F.col("doc_id").isin(sorted(toxic)) if toxic else F.lit(True))
    copies = {r[0] for r in neardup.groups(left).where("doc_id <> group_id").collect()}
    rows = corpus_pipeline.run(spark, sf).collect()
    want = {r[0] for r in left.select("doc_id").collect()} - copies
    assert {r["doc_id"] for r in rows} == want
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(left.where(~F.col("doc_id").isin(sorted(copies)) if copies else F.lit(True))).collect()}
    c = bpe.Coder(bpe.read_vocabulary(bpe.VOCABULARY))
    assert all(c.decode(r["token_ids"]) == clean[r["doc_id"]] for r in rows)
