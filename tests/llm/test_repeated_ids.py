"""Near duplicates where a doc_id stands on rows with unlike texts."""

import random

from statloom.llm import neardup


def test_unlike_texts_of_one_doc_id_are_judged_each(spark):
    def text(seed):
        return " ".join(f"{seed}w{random.Random(f'{seed}-{i}').randrange(10**6)}" for i in range(300))

    a, b = text("a"), text("b")
    rows = [(3, a), (5, a), (5, b), (6, b + " more"), (7, text("c")), (7, text("d")), (7, text("d"))]
    got = sorted((r["doc_id"], r["text"][0]) for r in neardup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(3, "a"), (5, "b"), (7, "c"), (7, "d")]
