"""6. Mixing sources to target weights along a curriculum.

Every source has a weight over training time t in [0, 1], linear between knots and summing to 1 over the sources at
every t. Its integral times the total is the source's cumulative token demand; the tokens of the source, its
documents in hashed order, meet that demand one after another, so the inverse of the demand at a document's token
offset is its position. A source that is short is read again (``epoch`` 1, 2, ..). The default total is the least
for which every document is used at least once; with a lower ``total`` documents beyond the demand stay out.

The default schedule begins with the sources' own shares and ends with the square roots of them, normalised.

Offsets are prefix sums in two steps, over hash buckets and within them, so that no task sees a whole source.

Defined results: a null source is a source of its own; a null or empty text has 0 tokens and gets the position at
which its turn comes; repeated rows are separate documents; rows that tie in hash and doc_id are ordered by tokens;
an empty table, or one without a token, gives positions 0 in epoch 0; other columns pass through ``mix`` untouched,
whatever their names; ids keep their type. A schedule needs for every source of the documents one row, with a weight
of at least 0 at every knot and sums of 1; otherwise a ValueError says what it lacks. A document's tokens are a
quarter of its characters, rounded up, or what the column ``token_count`` has, where null and negative numbers are 0.
Buckets hold about 20,000 documents up to 2**24 buckets a source, and more beyond that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import util

CHARS_PER_TOKEN = 4
NO_SOURCE = "\u0000"


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.ceil(F.length(text.cast("string")) / F.lit(float(CHARS_PER_TOKEN))), F.lit(0)).cast("bigint")


def default_schedule(supply: DataFrame) -> DataFrame:
    """source, weights ARRAY<DOUBLE> at the knots t = 0 and 1: the natural shares, then their normalised roots."""
    everything = Window.partitionBy()
    share = F.when(F.sum("supply").over(everything) > 0, F.col("supply") / F.sum("supply").over(everything)).otherwise(F.lit(0.0))
    roots = supply.select("source", share.alias("p")).withColumn("r", F.sqrt("p"))
    return roots.select("source", F.array("p", F.when(F.sum("r").over(everything) > 0, F.col("r") / F.sum("r").over(everything)).otherwise(F.lit(0.0))).alias("weights"))


def _checked(schedule: DataFrame, sources: DataFrame, knots: list[float]) -> DataFrame:
    """The schedule, which has a row a source, with null as a source of its own; a ValueError where it isn't one."""
    if len(knots) < 2 or knots[0] != 0 or knots[-1] != 1 or any(a >= b for a, b in zip(knots, knots[1:])):
        raise ValueError("knots must rise from 0 to 1")
    plan = schedule.select(F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)).alias("source"), F.col("weights").cast("array<double>").alias("weights"))
    if plan.groupBy("source").count().where("count > 1").count():
        raise ValueError("a source has more than one row of weights")
    if plan.where((F.size("weights") != len(knots)) | F.exists("weights", lambda w: w.isNull() | (w < 0)) | F.col("weights").isNull()).count():
        raise ValueError("every source needs a weight of at least 0 at every knot")
    sums = plan.agg(*[F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(len(knots))]).first()
    if any(abs((s or 0.0) - 1) > 1e-6 for s in sums):
        raise ValueError(f"weights at the knots sum to {list(sums)}, not to 1")
    unknown = [r["source"] for r in sources.join(plan, "source", "left_anti").limit(10).collect()]
    if unknown:
        raise ValueError(f"sources without weights: {unknown}")
    return plan


def _positions(docs: DataFrame, schedule: DataFrame | None, knots: list[float], total: float | None, token_count: str | None, _P: str) -> DataFrame:
    """``docs`` with columns that begin with ``_P``; carries all columns, in one exchange on (source, bucket)."""
    n = docs.count()
    bits = max(4, min(24, math.ceil(math.log2(max(n, 1) / 20_000 + 1))))
    key = docs.withColumns({
        _P + "source": F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)),
        _P + "id": F.col("doc_id"),
        _P + "tokens": tokens_of(F.col("text")) if token_count is None else F.greatest(F.coalesce(F.col(token_count).cast("bigint"), F.lit(0)), F.lit(0)),
        _P + "order": F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("bigint"),
    }).withColumn(_P + "bucket", F.shiftright(F.col(_P + "order"), 32 - bits))
    sums = util.saved(key.groupBy(F.col(_P + "source").alias("source"), F.col(_P + "bucket").alias("bucket")).agg(F.sum(_P + "tokens").alias("tokens")), "supply")
    supply = sums.groupBy("source").agg(F.sum("tokens").alias("supply"))
    plan = default_schedule(supply) if schedule is None else _checked(schedule, supply, knots)
    steps = [b - a for a, b in zip(knots, knots[1:])]
    areas = F.array(*[(F.col("weights")[i] + F.col("weights")[i + 1]) * F.lit(0.5 * h) for i, h in enumerate(steps)])
    plan = supply.join(plan, "source").withColumn("areas", areas).withColumn("whole", F.expr("aggregate(areas, 0D, (a, x) -> a + x)"))
    everything = Window.partitionBy()
    plan = plan.withColumn("total", F.lit(float(total)) if total is not None else F.max(F.when(F.col("whole") > 0, F.col("supply") / F.col("whole"))).over(everything))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0))).drop("tokens").join(plan, "source")
    offsets = util.saved(offsets.select(F.col("source").alias(_P + "source"), F.col("bucket").alias(_P + "bucket"), *[F.col(c).alias(_P + c) for c in ("offset", "supply", "weights", "areas", "whole", "total")]), "offsets")
    inside = Window.partitionBy(_P + "source", _P + "bucket").orderBy(F.col(_P + "order"), F.col(_P + "id").asc_nulls_first(), F.col(_P + "tokens")).rowsBetween(Window.unboundedPreceding, -1)
    placed = key.withColumn(_P + "start", F.coalesce(F.sum(_P + "tokens").over(inside), F.lit(0))).join(offsets, [_P + "source", _P + "bucket"])
    placed = placed.withColumn(_P + "start", F.col(_P + "start") + F.col(_P + "offset"))
    # half a token of slack, since the demand of the source that sets the total equals its supply
    need = F.col(_P + "total") * F.col(_P + "whole") - F.lit(0.5) - F.col(_P + "start")
    epochs = F.when(F.col(_P + "supply") > 0, F.ceil(need / F.col(_P + "supply"))).otherwise(F.lit(1)).cast("int")
    last = F.when(F.col(_P + "tokens") > 0, F.lit(0)).otherwise(F.lit(1)) if total is None else F.lit(0)
    uses = F.greatest(epochs, last)
    placed = placed.withColumn(_P + "epoch", F.explode(F.when(uses > 0, F.sequence(F.lit(0), uses - 1)).otherwise(F.array().cast("array<int>"))))
    u = F.when(F.col(_P + "total") > 0, (F.col(_P + "start") + F.col(_P + "epoch") * F.col(_P + "supply")) / F.col(_P + "total")).otherwise(F.lit(0.0))
    placed = placed.withColumn(_P + "u", u)
    position, done = F.lit(None).cast("double"), F.lit(0.0)
    for i, h in enumerate(steps):
        a, b = F.col(_P + "weights")[i], F.col(_P + "weights")[i + 1]
        rest = F.greatest(F.col(_P + "u") - done, F.lit(0.0))
        root = a + F.sqrt(F.greatest(a * a + (b - a) * F.lit(2.0 / h) * rest, F.lit(0.0)))
        here = F.lit(knots[i]) + F.when(root > 0, F.least(F.lit(2.0) * rest / root, F.lit(h))).otherwise(F.lit(0.0))
        done = done + F.col(_P + "areas")[i]
        inside_segment = F.col(_P + "u") < done if i + 1 < len(steps) else F.lit(True)
        position = F.coalesce(position, F.when(inside_segment, here))
    return placed.withColumn(_P + "position", F.round(position, 9))


def positions(docs: DataFrame, schedule: DataFrame | None = None, knots: tuple[float, ...] = (0.0, 1.0), total: float | None = None, token_count: str | None = None) -> DataFrame:
    """doc_id, source, tokens, epoch, position of every use of a document, range-sorted by position."""
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text") if token_count is None else F.col(token_count))
    _P = "mix_"
    out = _positions(slim, schedule, list(knots), total, token_count, _P)
    return out.select("doc_id", "source", F.col(_P + "tokens").alias("tokens"), F.col(_P + "epoch").alias("epoch"), F.col(_P + "position").alias("position")).orderBy("position", "doc_id", "epoch")


def mix(docs: DataFrame, schedule: DataFrame | None = None, knots: tuple[float, ...] = (0.0, 1.0), total: float | None = None, token_count: str | None = None) -> DataFrame:
    """The rows of ``docs``, repeated as their source is, range-sorted by training position."""
    _P = "mix_"
    while any(c.lower().startswith(_P) for c in docs.columns):  # no name of the table is touched
        _P += "_"
    out = _positions(docs, schedule, list(knots), total, token_count, _P)
    return out.orderBy(_P + "position", _P + "id", _P + "epoch").select(docs.columns)


ORACLE = f"""
with d as (
  select doc_id::bigint as doc_id, source, coalesce(source, chr(1)) as s, coalesce(ceil(length(text) / {float(CHARS_PER_TOKEN)}), 0)::bigint as tokens,
    ('0x' || substr(md5(coalesce(doc_id::bigint::varchar, '')), 1, 8))::bigint as o from documents),
c as (select *, coalesce(sum(tokens) over (partition by s order by o, doc_id nulls first, tokens rows between unbounded preceding and 1 preceding), 0)::bigint as start from d),
supply as (select s, sum(tokens)::bigint as supply from d group by s),
p as (select s, supply, supply::double / (sum(supply) over ())::double as p from supply),
r as (select *, sqrt(p) / sum(sqrt(p)) over () as q from p),
w as (select *, (p + q) * 0.5 as whole from r),
t as (select *, max(supply::double / whole) over () as total from w),
e as (
  select doc_id, source, tokens, start, supply, p, q, total,
    unnest(range(0, greatest(ceil((total * whole - 0.5 - start) / supply)::int, case when tokens > 0 then 0 else 1 end)))::int as epoch
  from c join t using (s))
select doc_id, source, tokens, epoch,
  round(least(2.0::double * u / (p + sqrt(greatest(p * p + (q - p) * 2.0::double * u, 0))), 1.0::double), 9) as position
from (select *, ((start + epoch * supply)::double / total) as u from e)"""
