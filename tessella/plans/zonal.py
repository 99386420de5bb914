"""Zonal plans: edges, pixels and groups in, one lazy DataFrame of statistics out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.model import Grid
from tessella.operators import assign, stats


def by_feature(edges: DataFrame, pixels: DataFrame, grid: Grid, nodata: Column | float | None = None, overlap: str = "last", fallback: bool = True, percentiles=(), **options) -> DataFrame:
    """Statistics of every zone that owns a cell: fid, raster, ..."""
    owned = pixels.join(assign.assign(edges, grid, overlap, fallback), ["row", "col"])
    return stats.summarise(stats.marked(owned, nodata), ["fid", "raster"], percentiles, **options)


def zonal_statistics(
    zones: DataFrame, edges: DataFrame, pixels: DataFrame, grid: Grid, rasters: list[str], nodata: Column | float | None = None,
    overlap: str = "last", fallback: bool = True, percentiles=(), nan_is_nodata: bool = True, **options,
) -> DataFrame:
    """Statistics of every (group, raster), empty ones included: group, raster, ...

    zones: fid, group. pixels: raster, row, col, value, on one grid. Cells are assigned once for all rasters.
    """
    cells = assign.assign(edges, grid, overlap, fallback)
    grouped = cells.join(zones.select("fid", "group"), "fid").select("row", "col", "group")
    owned = pixels.join(grouped, ["row", "col"])
    return finish(zones, owned, rasters, nodata, percentiles, nan_is_nodata, **options)


def zonal_statistics_of_strips(
    zones: DataFrame, edges: DataFrame, strips: DataFrame, grid: Grid, rasters: list[str], nodata: Column | float | None = None,
    overlap: str = "last", fallback: bool = True, percentiles=(), nan_is_nodata: bool = True, **options,
) -> DataFrame:
    """The same over rasters stored as strips: only (row, tile) arrays are joined, pixels stay where they are read."""
    owned = assign.owned_values(strips, assign.strip_spans(edges, grid, overlap, fallback))
    return finish(zones, owned.join(zones.select("fid", "group"), "fid"), rasters, nodata, percentiles, nan_is_nodata, **options)


def finish(zones: DataFrame, owned: DataFrame, rasters: list[str], nodata: Column | float | None, percentiles, nan_is_nodata: bool, **options) -> DataFrame:
    """Aggregate (group, raster, value) rows and add the groups that have none."""
    found = stats.summarise(stats.marked(owned, nodata, nan_is_nodata), ["group", "raster"], percentiles, **options)
    cube = stats.complete_cube(zones, rasters)
    return stats.filled(found, cube, ["group", "raster"])


def pixel_centres(pixels: DataFrame, grid: Grid) -> DataFrame:
    """pixels with the world coordinates of their centres."""
    return pixels.withColumns({"cx": F.lit(grid.x0) + (F.col("col") + 0.5) * F.lit(grid.dx), "cy": F.lit(grid.y0) + (F.col("row") + 0.5) * F.lit(grid.dy)})


def ray_cast(edges: DataFrame, pixels: DataFrame, grid: Grid) -> DataFrame:
    """cells by testing centres against sides, for checking: sides are matched to the rows they cross by equality, then
    each centre counts the crossings to its right."""
    e = assign.grid_edges(edges, grid)
    low, high = F.ceil(F.least("ay", "by") - 0.5).cast("int"), (F.ceil(F.greatest("ay", "by") - 0.5) - 1).cast("int")
    at_row = e.withColumns({"lo": F.greatest(low, F.lit(0)), "hi": F.least(high, F.lit(grid.height - 1))}).where("lo <= hi").select("*", F.explode(F.sequence("lo", "hi")).alias("row")).drop("lo", "hi")
    x = (F.col("bx") - F.col("ax")) * (F.col("row") + 0.5 - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")
    hits = pixels.select("row", "col").distinct().join(at_row.select("fid", "row", x.alias("x")), "row").where(F.col("col") + 0.5 < F.col("x"))
    return hits.groupBy("fid", "row", "col").agg(F.count("*").alias("n")).where("n % 2 = 1").select("fid", "row", "col")
