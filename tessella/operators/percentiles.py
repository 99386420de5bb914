"""Exact percentiles of groups of any size.

The built-in exact percentile keeps a map of a group's distinct values in one task. Here each wanted rank keeps a range of
values that must hold it and how many values are below. A round estimates two quantiles around the rank inside the range
and counts what lies below and between them, both with partial aggregation; the range shrinks by about the accuracy of
the estimate, and rounds go on until it is small. When at most `limit` values are left, or one value fills the range, those are sorted and the rank is read off. No
group is ever in one task; an estimate that missed the rank only costs a round.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.model import normal_percentiles, percentile_name


def _cut(df: DataFrame) -> DataFrame:
    """df, kept in the shared checkpoint folder; on one machine without one, in a temporary folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.startswith(("local-cluster", "spark:", "yarn", "k8s:", "mesos:")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessella-"))
    return df.checkpoint()


def selected_percentiles(rows: DataFrame, keys: list[str], percentiles, limit: int = 100_000, accuracy: int = 1000) -> DataFrame:
    """keys and a column for each percentile, linear between neighbours, over rows (keys, value). Null values are left
    out; a group with a NaN has NaN for all; a group without values has none."""
    ps, limit = normal_percentiles(percentiles), max(limit, 16)  # a range keeps a few values around its rank
    rows = rows.select(*keys, "value").where("value is not null")
    whole = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("inside"), F.min("value").alias("low"), F.max("value").alias("high"), (F.count_if(F.isnan("value")) > 0).alias("nan"))
    wanted = F.explode(F.array(*[F.lit(p) for p in ps])).alias("p")
    state = whole.select(*keys, wanted, "inside", "low", "high", "nan").withColumn("rank", (F.col("inside") - 1) * F.col("p") / 100)
    state = _cut(state.withColumns({"k0": F.floor("rank"), "k1": F.ceil("rank"), "below": F.lit(0).cast("bigint")}))
    names = {k: f"_{k}" for k in keys}

    def bounded(ranges: DataFrame) -> DataFrame:
        """rows inside the ranges that are still open."""
        right = ranges.withColumnsRenamed(names)
        same = None
        for k in keys:
            one = F.col(k).eqNullSafe(F.col(f"_{k}"))
            same = one if same is None else same & one
        return rows.join(right, same if same is not None else F.lit(True)).where(F.col("value").between(F.col("low"), F.col("high"))).drop(*names.values())

    open_ = (F.col("inside") > limit) & (F.col("low") < F.col("high")) & ~F.col("nan")
    k = 0
    while not (wide := state.where(open_)).isEmpty():
        k, accuracy = k + 1, accuracy * 2 if k >= 8 else accuracy  # an estimate that misses again and again is made better
        # two quantiles around the rank; where they fall is only an estimate
        inside = bounded(wide.select(*keys, "p", "low", "high"))
        grid = [k / (accuracy // 4) for k in range(accuracy // 4 + 1)]
        marks = inside.groupBy(*keys, "p").agg(F.percentile_approx("value", F.array(*map(F.lit, grid)), accuracy).alias("marks"))
        at = lambda c: F.element_at("marks", F.greatest(F.lit(1), F.least(F.lit(len(grid)), c)).cast("int"))
        place = (F.col("k0") - F.col("below")) / F.col("inside") * (len(grid) - 1)
        ahead = (F.col("k1") - F.col("below")) / F.col("inside") * (len(grid) - 1)
        guess = _joined(wide, marks, keys).withColumns({"lower": at(F.floor(place)), "upper": at(F.ceil(ahead) + 2)}).drop("marks")
        guess = guess.withColumns({"lower": F.greatest("lower", "low"), "upper": F.least("upper", "high")})
        counts = bounded(guess.select(*keys, "p", "low", "high", "lower", "upper")).groupBy(*keys, "p").agg(
            F.count_if(F.col("value") < F.col("lower")).alias("under"), F.count_if(F.col("value").between(F.col("lower"), F.col("upper"))).alias("between")
        )
        held = _joined(guess, counts, keys)
        low_ok = F.col("below") + F.col("under") <= F.col("k0")
        high_ok = F.col("below") + F.col("under") + F.col("between") > F.col("k1")
        new = held.select(
            *keys, "p", F.when(low_ok & high_ok, F.col("between")).when(low_ok, F.col("inside") - F.col("under")).when(high_ok, F.col("under") + F.col("between")).otherwise(F.col("inside")).alias("inside"),
            F.when(low_ok, F.col("lower")).otherwise(F.col("low")).alias("low"), F.when(high_ok, F.col("upper")).otherwise(F.col("high")).alias("high"), "nan", "rank", "k0", "k1",
            F.when(low_ok, F.col("below") + F.col("under")).otherwise(F.col("below")).alias("below"),
        )
        state = _cut(state.where(~open_).unionByName(new))
    flat = state.where("low = high or nan").withColumn("out", F.when(F.col("nan"), F.lit(float("nan"))).otherwise(F.col("low"))).select(*keys, "p", "out")
    left = state.where("low < high and not nan")
    sorted_ = bounded(left.select(*keys, "p", "low", "high", "k0", "k1", "rank", "below")).groupBy(*keys, "p", "k0", "k1", "rank", "below").agg(F.sort_array(F.collect_list("value")).alias("v"))
    a, b = (F.get("v", (F.col(k) - F.col("below")).cast("int")) for k in ("k0", "k1"))
    found = flat.unionByName(sorted_.select(*keys, "p", (a + (b - a) * (F.col("rank") - F.col("k0"))).alias("out")))
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("out"))).alias(percentile_name(p)) for p in ps])
    return wide


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with right's columns of the same keys and p; null keys are keys."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in (*keys, "p")})
    same = F.col("p") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(right, same).drop("_p", *[f"_{k}" for k in keys])
