"""Exact quantiles of many columns and groups at once, and the scalers that rest on them.

An order statistic is found by narrowing: a band of values that surely holds the wanted rank is cut into equal slots, the
slots are counted in one aggregate, and the slot with the rank is the next band. Only when a band holds few enough
rows are its values sorted. No pass moves rows of a group into one task, and repeated values count as one.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.session import materialize

#: Slots a band is cut into, and rows of a band that are sorted directly.
SLOTS, SORTED = 1024, 200_000


def _long(df, columns, by):
    """(by, feature, x): the finite values of the columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])
    return df.select(*by, F.inline(pairs)).where("x > double('-infinity') and x < double('infinity')")


def _same(left, right, names):
    """Join on columns that may be null, which match each other."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    on = [left[n].eqNullSafe(renamed[f"_r_{n}"]) for n in names]
    return left.join(renamed, on).drop(*[f"_r_{n}" for n in names])


def _slot():
    width = F.col("hi") / SLOTS - F.col("lo") / SLOTS  # halves first: the difference of two doubles may overflow
    part = F.try_divide(F.col("x") / SLOTS - F.col("lo") / SLOTS, width)
    number = F.least(F.greatest(F.floor(F.coalesce(part, F.lit(0.0)) * SLOTS), F.lit(0)), F.lit(SLOTS - 1)).cast("int")
    return F.when(F.col("x") == F.col("hi"), SLOTS - 1).otherwise(number)  # two values never stay together for ever


def exact_quantiles(df, columns, probabilities, by=(), sorted_rows=SORTED):
    """(by, feature, p, value): quantiles with linear interpolation between the two neighbouring values.

    Nulls, NaN and infinite values are left out; a group without values has no row; null group values are a group.
    ``df`` is read once per pass and should be a stored table. The bands are wide at first (least to greatest value), each
    pass narrows them by ``SLOTS`` or more, and a band of one value is done, however many rows share it.
    """
    by = list(by)
    keys = [*by, "feature"]
    values = _long(df, columns, by)
    edges = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    at = F.col("p") * (F.col("n") - 1)
    targets = edges.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    wanted = targets.select(*keys, "p", "n", (at - F.floor(at)).alias("share"), F.floor(at).alias("low"), F.ceil(at).alias("high"))
    wanted = materialize(wanted, "wanted")
    ranks = wanted.select(*keys, F.explode(F.array("low", "high")).alias("rank")).distinct()
    bands = _same(edges.withColumnRenamed("n", "held"), ranks, keys).withColumn("below", F.lit(0).cast("long"))
    bands = materialize(bands.select(*keys, "rank", "lo", "hi", "held", "below"), "bands")
    found = []
    while True:
        found.append(bands.where("lo = hi").select(*keys, "rank", F.col("lo").alias("value")))
        few = bands.where(f"lo < hi and held <= {sorted_rows}")
        found.append(_sorted_values(values, few, keys))
        bands = bands.where(f"lo < hi and held > {sorted_rows}")
        if bands.isEmpty():
            break
        bands = materialize(_narrowed(values, bands, keys), "bands")
    order = found[0]
    for more in found[1:]:
        order = order.unionByName(more)
    order = materialize(order, "order")
    one = _same(wanted, order.withColumnRenamed("rank", "low").withColumnRenamed("value", "a"), [*keys, "low"])
    two = _same(one, order.withColumnRenamed("rank", "high").withColumnRenamed("value", "b"), [*keys, "high"])
    return two.select(*keys, "p", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        F.col("a") * (1 - F.col("share")) + F.col("b") * F.col("share")).alias("value"))


def _inside(values, bands, keys):
    """Values inside the band of every rank of their group."""
    return _same(values, bands, keys).where("x >= lo and x <= hi")


def _narrowed(values, bands, keys):
    """The slot of every band that holds its rank, from the least to the greatest value in it."""
    names = [*keys, "rank"]
    slots = _inside(values, bands, keys).groupBy(*names, "below", _slot().alias("slot")).agg(
        F.count(F.lit(1)).alias("held"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    before = Window.partitionBy(*names).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("below", F.col("below") + F.coalesce(F.sum("held").over(before), F.lit(0)))
    hit = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("held"))
    return slots.where(hit).select(*names, "lo", "hi", "held", "below")


def _sorted_values(values, bands, keys):
    """The value of each rank whose band is short: running counts of its distinct values."""
    names = [*keys, "rank"]
    counts = _inside(values, bands, keys).groupBy(*names, "below", "x").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(*names).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("end", F.col("below") + F.sum("c").over(upto))
    hit = (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("c"))
    return counts.where(hit).select(*names, F.col("x").alias("value"))


def scales(df, columns, by=(), sorted_rows=SORTED):
    """(by, feature, median, spread, mean, deviation): spread is the distance of the quartiles, deviation that of the
    population; both are 1 where they are 0."""
    by = list(by)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by, sorted_rows)
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
    robust = quartiles.groupBy(*by, "feature").agg(at(0.5).alias("median"), (at(0.75) - at(0.25)).alias("spread"))
    plain = _long(df, columns, by).groupBy(*by, "feature").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation"))
    one = lambda c: F.when(F.col(c) == 0, 1.0).otherwise(F.col(c)).alias(c)
    return _same(robust, plain, [*by, "feature"]).select(*by, "feature", "median", one("spread"), "mean", one("deviation"))


def scaled_columns(df, fitted, columns, by=()):
    """``df`` with robust_<c> = (c - median) / spread and standard_<c> = (c - mean) / deviation for every column.

    ``fitted`` (of ``scales``) has a row per group and feature; rows of groups without any value keep nulls.
    """
    by = list(by)
    parts = ["median", "spread", "mean", "deviation"]
    wide = fitted.groupBy(*by).agg(*[F.max(F.when(F.col("feature") == c, F.col(s))).alias(f"_{s}_{c}") for c in columns for s in parts])
    renamed = wide.withColumnsRenamed({b: f"_g_{b}" for b in by})
    on = F.lit(True)
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_g_{b}"))
    out = df.join(renamed, on, "left") if by else df.join(F.broadcast(renamed))
    made = {f"robust_{c}": F.try_divide(F.col(c) - F.col(f"_median_{c}"), F.col(f"_spread_{c}")) for c in columns}
    made |= {f"standard_{c}": F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_deviation_{c}")) for c in columns}
    return out.withColumns(made).drop(*[f"_g_{b}" for b in by], *[f"_{s}_{c}" for c in columns for s in parts])
