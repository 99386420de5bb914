"""Zonal statistics as plain aggregates.

Nodata values count in count and nodata_count; all else is over the values that contribute. With ignore_nodata off every
value contributes. A NaN that is not nodata makes every statistic of its group but the counts NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.scalar import is_nodata
from tessella.model import STAT_FIELDS, normal_percentiles, percentile_name
from tessella.operators.percentiles import selected_percentiles

NAN = float("nan")


def marked(rows: DataFrame, nodata: Column | float | None = None, nan_is_nodata: bool = True) -> DataFrame:
    """rows with missing (whether value is nodata)."""
    if nodata is None:
        return rows.withColumn("missing", F.lit(False))
    nodata = nodata if isinstance(nodata, Column) else F.lit(float(nodata))
    return rows.withColumn("missing", is_nodata(F.col("value"), nodata, nan_is_nodata))


def aggregates(percentiles=(), ignore_nodata: bool = True, approximate: int | None = None, float32: bool = False, extra: tuple[str, ...] = ()) -> list[Column]:
    """The aggregates over rows (value, missing), in report order.

    Percentiles are exact and interpolate linearly between neighbours; approximate (an accuracy) trades that for bounded
    memory in groups with very many distinct values. float32 rounds values to single precision for percentiles alone.
    extra: of avg, median, total_count.
    """
    value = F.when(~F.col("missing"), F.col("value")) if ignore_nodata else F.col("value")
    poisoned = F.count_if(F.isnan(value)) > 0
    guard = lambda c: F.when(poisoned, F.lit(NAN)).otherwise(c)
    sample = value.cast("float").cast("double") if float32 else value
    ps = normal_percentiles([*percentiles, *([50.0] if "median" in extra else [])])
    # one aggregate for all percentiles: each takes its element, and equal aggregates are computed once
    points = F.array(*[F.lit(p / 100) for p in ps])
    every = F.percentile_approx(sample, points, approximate) if approximate else F.percentile(sample, points)
    percentile = lambda p: guard(F.get(every, ps.index(float(p))))
    named = {
        "min": guard(F.min(value)), "max": guard(F.max(value)), "count": F.count(F.lit(1)), "nodata_count": F.count_if(F.col("missing")), "valid_count": F.count_if(~F.col("missing")),
        "sum": F.coalesce(F.sum(value), F.lit(0.0)), "stdev": F.stddev_pop(value),
    }
    named |= {percentile_name(p): percentile(p) for p in normal_percentiles(percentiles)}
    more = {"avg": lambda: F.avg(value), "median": lambda: percentile(50), "total_count": lambda: F.count(F.lit(1))}
    return [c.alias(n) for n, c in named.items()] + [more[x]().alias(x) for x in extra]


def requested_fields(operations) -> list[str]:
    """The columns that operation names ask for, in their order."""
    return list(dict.fromkeys(operations))


def summarise(rows: DataFrame, keys: list[str], percentiles=(), **options) -> DataFrame:
    """One row for each combination of keys over rows (keys, value, missing)."""
    return rows.groupBy(*keys).agg(*aggregates(percentiles, **options))


def counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows by value, with their number n. For values that repeat much, as in rasters of small integers: counting starts
    on the map side, so a group of any size becomes at most as many rows as it has values."""
    return rows.groupBy(*keys, "value", "missing").agg(F.count(F.lit(1)).alias("n"))


def weighted_aggregates(percentiles=(), ignore_nodata: bool = True, extra: tuple[str, ...] = ()) -> list[Column]:
    """`aggregates` over counted rows. The deviation comes from exact sums, so values must be whole numbers."""
    value = F.when(~F.col("missing"), F.col("value")) if ignore_nodata else F.col("value")
    used = F.sum(F.when(value.isNotNull(), F.col("n")))
    mean, square = F.sum(value * F.col("n")) / used, F.sum(value * value * F.col("n")) / used
    ps = normal_percentiles([*percentiles, *([50.0] if "median" in extra else [])])
    every = F.percentile(value, F.array(*[F.lit(p / 100) for p in ps]), F.col("n"))
    total, count_if = F.sum("n"), lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    named = {
        "min": F.min(value), "max": F.max(value), "count": total, "nodata_count": count_if(F.col("missing")), "valid_count": count_if(~F.col("missing")),
        "sum": F.coalesce(F.sum(value * F.col("n")), F.lit(0.0)), "stdev": F.when(used > 0, F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))),
    }
    named |= {percentile_name(p): F.get(every, ps.index(p)) for p in normal_percentiles(percentiles)}
    more = {"avg": lambda: mean, "median": lambda: F.get(every, ps.index(50.0)), "total_count": lambda: total}
    return [c.alias(k) for k, c in named.items()] + [more[x]().alias(x) for x in extra]


def summarise_discrete(rows: DataFrame, keys: list[str], percentiles=(), **options) -> DataFrame:
    """`summarise` for whole numbers that repeat much."""
    return counted(rows, keys).groupBy(*keys).agg(*weighted_aggregates(percentiles, **options))


def filled(stats: DataFrame, cube: DataFrame, keys: list[str]) -> DataFrame:
    """stats with a row for every row of cube: absent groups have counts and sum 0 and null for the rest."""
    right = stats.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    zero = {"count": 0, "nodata_count": 0, "valid_count": 0, "sum": 0.0, "total_count": 0}
    fields = [c for c in stats.columns if c not in keys]
    return cube.join(right, same, "left").select(*keys, *[F.coalesce(F.col(f), F.lit(zero[f]).cast(stats.schema[f].dataType)).alias(f) if f in zero else F.col(f"`{f}`") for f in fields])


def complete_cube(groups: DataFrame, rasters: list[str]) -> DataFrame:
    """Every (group, raster, ordinal): rasters is the list of a job's files, spread from each group without a join."""
    names = F.array(*[F.struct(F.lit(r).alias("raster"), F.lit(k).alias("ordinal")) for k, r in enumerate(rasters)])
    return groups.select("group").distinct().select("group", F.inline(names))


def grouping_sets(rows: DataFrame, groupings: list[str], percentiles=(), always: list[str] | None = None, weighted: bool = False, **options) -> DataFrame:
    """Several groupings of the same rows in one pass: a row for each value of each grouping (and of the always columns).

    Columns: grouping (which), group (its value as text, null is a group), the always columns, the statistics. weighted:
    rows are counted.
    """
    always = always or []
    view = rows.groupingSets([[F.col(x) for x in (*always, g)] for g in groupings], *[F.col(x) for x in (*always, *groupings)])
    out = view.agg(F.struct(*[F.grouping(g).alias(g) for g in groupings]).alias("rolled"), *(weighted_aggregates if weighted else aggregates)(percentiles, **options))
    which, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for g in groupings:
        mine = F.col(f"rolled.{g}") == 0
        which, value = F.when(mine, F.lit(g)).otherwise(which), F.when(mine, F.col(g).cast("string")).otherwise(value)
    names = [c for c in out.columns if c not in (*groupings, *always, "rolled")]
    return out.select(which.alias("grouping"), value.alias("group"), *always, *[F.col(f"`{c}`") for c in names])


def with_selected(found: DataFrame, rows: DataFrame, keys: list[str], percentiles=(), ignore_nodata: bool = True, extra: tuple[str, ...] = (), limit: int = 100_000) -> DataFrame:
    """found, statistics by keys without percentiles, with the exact percentiles (and the median, if extra has it) of rows
    (keys, value, missing): by narrowing ranges, so that no group's values meet in one task."""
    ps = normal_percentiles([*percentiles, *([50.0] if "median" in extra else [])])
    if not ps:
        return found
    selected = selected_percentiles(rows.where(~F.col("missing")) if ignore_nodata else rows, keys, ps, limit)
    right = selected.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    named = {percentile_name(p): F.col(f"`{percentile_name(p)}`") for p in normal_percentiles(percentiles)}
    named |= {"median": F.col("p50")} if "median" in extra else {}
    rest = [c for c in found.columns if c not in (*STAT_FIELDS, *keys, *extra)]
    order = [c for c in (*rest, *keys, *STAT_FIELDS, *named) if c != "median"]
    both = found.join(right, same, "left")
    return both.select(*[named[c].alias(c) if c in named else F.col(f"`{c}`") for c in order], *[(named[x] if x in named else F.col(x)).alias(x) for x in extra])


def stacked_groupings(rows: DataFrame, groupings: list[str], always: list[str]) -> DataFrame:
    """A row for each row and grouping: grouping, group (as text), the always columns, value, missing."""
    which = F.array(*[F.struct(F.lit(g).alias("grouping"), F.col(g).cast("string").alias("group")) for g in groupings])
    return rows.select(F.explode(which).alias("g"), *always, "value", "missing").select("g.grouping", "g.group", *always, "value", "missing")
