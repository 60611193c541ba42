"""The driver's star-schema tables seen as a statistical graph: places, containment and series.

Customers and suppliers lie in nations, nations in regions. Orders, line items and events are summed to series about
customers, suppliers and users; the method is the priority, the return flag or the type of event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.operators.places import COLUMNS
from statloom.schema import EDGE

BASE = "dc/base/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(kind: str, column: str):
    return F.concat(F.lit(kind + "/"), F.col(column).cast("string"))


def _fact(predicate: str, o):
    return F.struct(F.lit(predicate).alias("predicate"), o.alias("object_id"))


def place_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """typeOf and containedInPlace edges; every table is read once."""
    out = None
    for name, kind, key, parent, up in (
        ("customer", "Customer", "c_custkey", "nation", "c_nationkey"),
        ("supplier", "Supplier", "s_suppkey", "nation", "s_nationkey"),
        ("nation", "Nation", "n_nationkey", "region", "n_regionkey"),
        ("region", "Region", "r_regionkey", None, None),
    ):
        facts = [_fact("typeOf", F.lit(kind))]
        if up:
            facts.append(_fact("containedInPlace", _key(parent, up)))
        part = table(spark, sf_dir, name).select(_key(name, key).alias("subject_id"), F.explode(F.array(*facts)).alias("e"), F.lit(BASE + name).alias("provenance"))
        part = part.select("subject_id", "e.predicate", "e.object_id", "provenance")
        out = part if out is None else out.unionByName(part)
    return out


def edges_of(spark: SparkSession, rows: list[tuple[str, str, str]], provenance: str = BASE + "schema") -> DataFrame:
    """A few facts given by hand, such as those about variables."""
    return spark.createDataFrame([(*r, provenance) for r in rows], EDGE)


def points(df: DataFrame, variable, entity, date, value, method, period: str, name: str) -> DataFrame:
    none = F.lit(None).cast("string")
    grouped = df.groupBy(entity.alias("entity"), date.alias("date"), method.alias("method")).agg(value.alias("value"))
    fixed = {"variable": variable, "extra": F.lit(""), "period": F.lit(period), "unit": none, "scaling": none, "provenance": F.lit(BASE + name), "is_aggregate": F.lit(False)}
    return grouped.withColumns(fixed).select(COLUMNS)


def order_points(spark: SparkSession, sf_dir: str, variable: str = "Amount_Order") -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return points(df, F.lit(variable), _key("customer", "o_custkey"), F.date_format("o_orderdate", "yyyy-MM"), F.sum("o_totalprice"), F.col("o_orderpriority"), "P1M", "orders")


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, quantity and revenue in one aggregation of the line items."""
    df = table(spark, sf_dir, "lineitem").groupBy(_key("supplier", "l_suppkey").alias("entity"), F.date_format("l_shipdate", "yyyy-MM").alias("date"), F.col("l_returnflag").alias("method"))
    wide = df.agg(F.count("*").cast("double").alias("Count_LineItem"), F.sum("l_quantity").alias("Quantity_LineItem"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Revenue_LineItem"))
    long = wide.unpivot(["entity", "date", "method"], ["Count_LineItem", "Quantity_LineItem", "Revenue_LineItem"], "variable", "value")
    none = F.lit(None).cast("string")
    return long.withColumns({"extra": F.lit(""), "period": F.lit("P1M"), "unit": none, "scaling": none, "provenance": F.lit(BASE + "lineitem"), "is_aggregate": F.lit(False)}).select(COLUMNS)


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return points(df, F.lit("Value_Event"), _key("user", "user_id"), F.date_format("ts", "yyyy-MM-dd"), F.sum("value"), F.col("event_type"), "P1D", "events")


def event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an entity: its type, user, date and value."""
    facts = F.array(
        _fact("typeOf", F.lit("Event")), _fact("location", _key("user", "user_id")), _fact("startDate", F.date_format("ts", "yyyy-MM-dd")),
        _fact("kind", F.col("event_type")), _fact("amount", F.col("value").cast("string")),
    )
    return table(spark, sf_dir, "events").select(_key("event", "event_id").alias("subject_id"), F.explode(facts).alias("e"), F.lit(BASE + "events").alias("provenance")).select("subject_id", "e.predicate", "e.object_id", "provenance")


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every brand and type of part as a variable with constraints."""
    v = table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()
    subject = F.concat(F.lit("Count_Part_"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", ""), F.lit("_"), F.regexp_replace("p_type", "[^A-Za-z0-9]", ""))
    facts = F.array(
        _fact("typeOf", F.lit("StatisticalVariable")), _fact("populationType", F.lit("Part")), _fact("measuredProperty", F.lit("count")),
        _fact("statType", F.lit("measuredValue")), _fact("brand", F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), _fact("kind", F.regexp_replace("p_type", "[^A-Za-z0-9]", "")),
    )
    return v.select(subject.alias("subject_id"), F.explode(facts).alias("e"), F.lit(BASE + "part").alias("provenance")).select("subject_id", "e.predicate", "e.object_id", "provenance")
