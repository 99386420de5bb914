"""Incremental zonal sums over a stream of pixel readings.

Batch jobs need no streaming; a feed of readings (event time, raster, row, col, value) can still keep zonal totals
current. Cells are static, so each micro-batch is one equi-join and a windowed aggregation with a watermark: late
readings within it are folded in, state beyond it is dropped. Only statistics that merge are kept; percentiles are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.stats import marked


def windowed_sums(readings: DataFrame, cells: DataFrame, zones: DataFrame, window: str, watermark: str, nodata: Column | float | None = None) -> DataFrame:
    """begin, end, group, raster, count, nodata_count, valid_count, sum, min, max for each window of event time.

    readings: ts, raster, row, col, value, streaming or not. cells, zones: static (fid, row, col) and (fid, group).
    """
    place = cells.join(zones.select("fid", "group"), "fid").select("row", "col", "group")
    rows = marked(readings.withWatermark("ts", watermark).join(place, ["row", "col"]), nodata)
    value = F.when(~F.col("missing"), F.col("value"))
    out = rows.groupBy(F.window("ts", window).alias("w"), "group", "raster").agg(
        F.count(F.lit(1)).alias("count"), F.count_if(F.col("missing")).alias("nodata_count"), F.count(value).alias("valid_count"), F.coalesce(F.sum(value), F.lit(0.0)).alias("sum"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    return out.select(F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "group", "raster", "count", "nodata_count", "valid_count", "sum", "min", "max")
