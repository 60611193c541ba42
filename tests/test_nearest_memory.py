"""Exact cosine search holds few similarities at a time."""

from statloom.operators import vectors


def test_few_items_are_compared_at_a_time(spark, monkeypatch):
    most = vectors.ITEMS
    best = vectors._best

    def checked(s, ids, *rest):
        assert s.shape[1] <= most
        return best(s, ids, *rest)

    monkeypatch.setattr(vectors, "_best", checked)
    rows = spark.range(3000).selectExpr("id as vec_id", "array(cast(id + 1 as double), cast(id % 7 as double), 1D) as embedding").coalesce(1)
    assert vectors.nearest(rows, rows.where("vec_id % 1000 = 0"), 2).count() == 6
