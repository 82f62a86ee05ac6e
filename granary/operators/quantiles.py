"""Quantiles of groups of any size: mergeable sketches (KLL), and exact values by counting passes over the bracket that a sketch gives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import delete, put

#: Size of a sketch; its ranks are off by about ERROR (with 99 % confidence).
K, ERROR = 1024, 0.0033
#: Half a bracket's width in ranks: thrice the sketch's error.
REACH = 3 * ERROR
#: Different values of a bracket that one task may sort; wider brackets are narrowed first.
SORTED = 1_000_000


def sketches(df: DataFrame, metric: str, by: list[str] | None = None, k: int = K) -> DataFrame:
    """(by..., n, sketch) over values that are not null. Partial sketches are merged, so that no task holds a group."""
    v = F.col(metric).cast("double")
    return df.where(v.isNotNull()).groupBy(*(by or [])).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch"))


def merged(parts: DataFrame, by: list[str] | None = None, k: int = K) -> DataFrame:
    """(by..., n, sketch) of sketches that were stored, such as those of many days."""
    return parts.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def estimates(parts: DataFrame, ps: list[float], by: list[str] | None, names: list[str]) -> DataFrame:
    """(by..., names...): the values of sketches at these ranks."""
    return parts.select(*(by or []), *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(n) for p, n in zip(ps, names, strict=True)])


#: Steps of the ranks at which a bracket's own sketch is read.
STEPS = 100


def _at(sketch: str, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(min(max(rank, 0.0), 1.0)))


def _step(sketch: str, step: Column) -> Column:
    """The value of a sketch at a step of STEPS; ranks themselves have to be literals."""
    grid = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    return F.get(grid, F.greatest(F.lit(0), F.least(F.lit(STEPS), step)).cast("int"))


def exact(df: DataFrame, metric: str, ps: list[float], by: list[str] | None, names: list[str], sorted_at_once: int = SORTED, k: int = K, reach: float = REACH) -> DataFrame:
    """(by..., names...): quantiles with linear interpolation between neighbours, null for groups without values.

    A sketch brackets each quantile. Counting passes tell how many values lie below a bracket and how many in it; a bracket with more different
    values than `sorted_at_once` is narrowed by a sketch of its own values, which shrinks it to a few of STEPS parts. Only what is left in brackets
    is sorted. The counts prove that a bracket holds its quantile; where one does not (a sketch may be off by more than it states), its
    group is computed by Spark's own percentile.
    """
    spark = df.sparkSession
    by = by or []
    temporary: list[str] = []
    keys = [f"g{i}" for i in range(len(by))] or ["g0"]
    rows = df.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(by or [None], keys, strict=True) if c], *([] if by else [F.lit(0).alias("g0")]), F.col(f"`{metric}`").cast("double").alias("v"))
    rows = put(rows, temporary)
    groups = rows.select(*keys).distinct()
    values = rows.where("v is not null")
    same = lambda a, b: reduce(lambda x, y: x & y, [a[g].eqNullSafe(b[g]) for g in keys])

    # one row a group and quantile: its place among n values, between the whole ranks low and high
    first = put(values.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.kll_sketch_agg_double("v", k).alias("sketch")), temporary)
    one = lambda i, p: F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), (F.col("least") if p <= reach else _at("sketch", p - reach)).alias("lo"), (F.col("most") if p >= 1 - reach else _at("sketch", p + reach)).alias("hi"))
    wanted = first.select(*keys, "n", F.explode(F.array(*[one(i, p) for i, p in enumerate(ps)])).alias("w")).select(*keys, "n", "w.*")
    place = F.col("p") * (F.col("n") - 1)
    brackets = put(wanted.select(*keys, "i", place.alias("place"), F.floor(place).alias("low"), F.ceil(place).alias("high"), "lo", "hi"), temporary)
    while True:
        a, b = values.alias("a"), brackets.alias("b")
        met = a.join(b, same(_Side("a"), _Side("b")) & (F.col("a.v") <= F.col("b.hi")))
        inside = F.col("v") >= F.col("lo")
        counted = met.select(*[F.col(f"b.{g}").alias(g) for g in keys], "i", "place", "low", "high", "lo", "hi", "v")
        of = [*keys, "i", "place", "low", "high", "lo", "hi"]
        sums = put(counted.groupBy(*of).agg(F.count_if(~inside).alias("below"), F.count_if(inside).alias("inside"), F.approx_count_distinct(F.when(inside, F.col("v"))).alias("different"), F.kll_sketch_agg_double(F.when(inside, F.col("v")), k).alias("sketch")), temporary)
        wide = sums.where((F.col("different") > sorted_at_once) & (F.col("lo") < F.col("hi")))
        if wide.isEmpty():
            break
        # a step of slack on either side
        down = F.floor((F.col("low") - F.col("below")) / F.col("inside") * STEPS) - 1
        up = F.ceil((F.col("high") - F.col("below")) / F.col("inside") * STEPS) + 1
        lo, hi = _step("sketch", down), _step("sketch", up)
        narrow = (F.col("different") > sorted_at_once) & (F.col("lo") < F.col("hi"))
        new = sums.select(*keys, "i", "place", "low", "high", F.when(narrow & (down > 0), F.greatest(lo, F.col("lo"))).otherwise(F.col("lo")).alias("lo"), F.when(narrow & (up < STEPS), F.least(hi, F.col("hi"))).otherwise(F.col("hi")).alias("hi"), (F.col("lo").alias("old_lo")), F.col("hi").alias("old_hi"))
        brackets = put(new, temporary)
        if brackets.where("lo > old_lo or hi < old_hi").isEmpty():
            break  # as narrow as sketches make it
    # running counts of the different values of each bracket
    of = [*keys, "i"]
    kept = values.alias("a").join(sums.drop("sketch").alias("b"), same(_Side("a"), _Side("b")) & F.col("a.v").between(F.col("b.lo"), F.col("b.hi")))
    each = kept.groupBy(*[F.col(f"b.{g}").alias(g) for g in keys], "i", "place", "low", "high", "below", "v").agg(F.count("*").alias("m"))
    upto = F.col("below") + F.sum("m").over(Window.partitionBy(*of).orderBy("v"))
    ranked = each.withColumn("upto", upto)
    holds = lambda r: F.max(F.when((F.col(r) < F.col("upto")) & (F.col(r) >= F.col("upto") - F.col("m")), F.col("v")))
    ends = ranked.groupBy(*of, "place", "low").agg(holds("low").alias("a"), holds("high").alias("b"))
    part = F.col("place") - F.col("low")
    found = put(ends.select(*of, (F.col("a") * (1 - part) + F.col("b") * part).alias("x"), (F.col("a").isNull() | F.col("b").isNull()).alias("lost")), temporary)
    lost = found.where("lost").select(*keys).distinct()
    if not lost.isEmpty():
        plain = values.alias("a").join(lost.alias("b"), same(_Side("a"), _Side("b")), "left_semi").groupBy(*keys).agg(F.percentile("v", F.array(*[F.lit(float(p)) for p in ps])).alias("all"))
        plain = plain.select(*keys, F.posexplode("all").alias("i", "x"))
        found = found.alias("a").join(lost.alias("b"), same(_Side("a"), _Side("b")), "left_anti").select(*keys, "i", "x").unionByName(plain)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("x"))).alias(n) for i, n in enumerate(names)])
    out = groups.alias("a").join(wide.alias("b"), same(_Side("a"), _Side("b")), "left").select(*[F.col(f"a.{g}").alias(c) for c, g in zip(by, keys, strict=False)], *names)
    done = put(out)
    delete(spark, *temporary)
    return done


class _Side:
    """The columns of one side of a join."""

    def __init__(self, name: str):
        self.name = name

    def __getitem__(self, column: str) -> Column:
        return F.col(f"{self.name}.{column}")
