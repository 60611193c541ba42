"""Checks of nodes hold little in a task, with the same results."""

from statloom.operators import checks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counters_hold_only_the_first_messages(spark):
    rows = [("a", f"m{i % 50:02d}") for i in range(200)] + [("b", None), ("b", None), (None, "x"), ("c", "z"), ("c", "y"), ("c", None)]
    df = spark.createDataFrame(rows, "counter string, node_id string").repartition(5)
    got = {r["counter"]: (r["n"], r["examples"]) for r in checks.counters(df).collect()}
    assert got == {"a": (200, [f"m{i:02d}" for i in range(30)]), "b": (2, []), None: (1, ["x"]), "c": (3, ["y", "z"])}
    assert checks.counters(df.where("false")).count() == 0
    assert "collect_set" not in plan(checks.counters(df)) and "WindowGroupLimit" in plan(checks.counters(df))


def test_nodes_are_gathered_behind_an_exchange(spark):
    rows = [("n", "typeOf", 0, "RESOLVED_REF", "T"), ("n", "dcid", 0, "TEXT", "a"), ("n", "dcid", 1, "TEXT", "b"), ("m", "typeOf", 0, "RESOLVED_REF", "T"), ("m", "dcid", 0, "TEXT", "a"), ("m", "dcid", 1, "TEXT", "a"), ("k", "dcid", 0, "TEXT", None), (None, "typeOf", 0, "RESOLVED_REF", "T")]
    out = checks.node_errors(spark.createDataFrame(rows, "node_id string, prop string, pos int, type string, value string"))
    assert {tuple(r) for r in out.collect()} == {("n", "Sanity_MultipleDcid"), ("k", "Sanity_MissingTypeOf")}
    steps = [line for line in plan(out).splitlines() if "Exchange" in line or "Aggregate" in line]
    below = steps[max(i for i, line in enumerate(steps) if "Exchange" in line) + 1 :]
    assert any("Exchange" in line for line in steps) and not any("Aggregate" in line for line in below)
