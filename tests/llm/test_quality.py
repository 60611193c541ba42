"""Single quality rules, by hand."""

import pytest

from statloom.llm import quality

GOOD = "The old bridge over the quiet river was built of grey stone long ago."
LINES = {
    "navigation": ["Home | News | Sport | Contact us today.", "Menu", "  lire la suite ", "Startseite", "a » b » c » d."],
    "boilerplate": ["We use cookies to improve what you see on this site.", "© 2020 Firma. Alle Rechte vorbehalten.", "Please log in", "Copyright 2021 by the town.", "Voir les conditions d'utilisation du site."],
    "punctuation": ["no closing mark here", "#### $$$$ %%%% ^^^^ and that is all of it here you see.", "what?! no!! really?? he said so and went home again that day."],
    "good": [GOOD, "This line has no closing mark but is long enough to stay as it has over twelve words", "ends with a colon:", "他说好。", "A single cookie is fine.", "He went home | and slept."],
}


@pytest.mark.parametrize("rule", LINES)
def test_each_rule(spark, rule):
    rows = [(i, line + "\n" + GOOD + "\n\n" + GOOD) for i, line in enumerate(LINES[rule])]
    for r in quality.clean_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        n = {k: r[f"n_{k}"] for k in ("navigation", "boilerplate", "punctuation")}
        assert n == {k: int(k == rule) for k in n}, (rows[r["doc_id"]], n)
        assert r["n_lines"] == 3 and r["keep"] and (LINES[rule][r["doc_id"]] in r["kept_text"]) == (rule == "good")


def test_documents_that_lose_too_much_are_rejected(spark):
    rows = [(1, "Menu\n" + GOOD, "a"), (2, "all of this goes\nand this\nA.", "b"), (3, None, "c"), (4, "", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, keep string")
    got = quality.reject(df)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [(1, GOOD, "a")]
