"""Sums of variables in one aggregation."""

from statloom.operators import variables
from statloom.schema import POINTS


def points(spark, rows):
    return spark.createDataFrame([(v, e, "", d, x, m, None, None, None, "dc/base/i", False) for v, e, d, x, m in rows], POINTS)


def test_all_of_many_sources_count_once(spark):
    names = [f"v{i}" for i in range(130)]
    rows = [(v, "whole", "2020", 1.0, "m") for v in names] + [(v, "less", "2020", 1.0, "m") for v in names[1:]] + [("v1", "less", "2020", 2.0, "m"), ("v0", "less", "2020", None, "m"), ("v0", "less", "2020", 1.0, "n"), ("other", "less", "2020", 1.0, "m")]
    got = lambda **more: {(r["entity"], r["method"]): r["value"] for r in variables.sum_variables(points(spark, rows), variables.VariableSum("T", names, ["i"], **more)).collect()}
    assert got() == {("whole", "dcAggregate/m"): 130.0}
    assert got(lenient=True) == {("whole", "dcAggregate/m"): 130.0, ("less", "dcAggregate/m"): 131.0, ("less", "dcAggregate/n"): 1.0}
    text = variables.sum_variables(points(spark, rows), variables.VariableSum("T", ["v0", "v1"], ["i"]))._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") == 2 and "distinct" not in text and "REPARTITION_BY_NUM" in text
