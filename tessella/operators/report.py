"""Reports: the pivoted tables of a job and their CSV files.

Labels and rasters are listed first, so pivots get explicit values and Spark never has to find them. Null groups have the
empty label and stand last; other groups are in the order of their text.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessella.functions.scalar import label
from tessella.model import BARE_FIELDS

ORDERS = ("agg_field,base_raster", "base_raster,agg_field")


def normal_order(order: str) -> str:
    """A row_col_order without white space, checked."""
    out = ",".join(p.strip() for p in order.lower().split(","))
    if out not in ORDERS:
        raise ValueError(f"row_col_order must be one of {ORDERS}, not {order!r}")
    return out


def group_order(groups: DataFrame) -> list[tuple]:
    """(group, label) of the distinct groups, by text, null last. The list heads a report, so it is small by nature."""
    rows = groups.select("group").distinct().select("group", label(F.col("group")).alias("label")).orderBy(F.col("group").cast("string").asc_nulls_last()).collect()
    return [(r["group"], r["label"]) for r in rows]


def check_stems(rasters: list[str], on_duplicate: str = "error") -> list[str]:
    """Raster names in order of appearance; names are columns, so two files of one stem are an error or the last wins."""
    if len(set(rasters)) < len(rasters) and on_duplicate != "last":
        twice = sorted({r for r in rasters if rasters.count(r) > 1})
        raise ValueError(f"several rasters have the same name: {', '.join(twice)}")
    return list(dict.fromkeys(rasters))


def _named(wide: DataFrame, outer: list[str], fields: list[str]) -> list[Column]:
    """<stat>_<name> columns of a pivot: names outside, statistics inside. They are read by place, so any text is a name."""
    out = []
    for k, (name, f) in enumerate((x, f) for x in outer for f in fields):
        out.append(F.col(_quoted(wide.columns[k + 1])).alias(f"{f}_{name}"))
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def pivoted(stats: DataFrame, order: str, field: str, rasters: list[str], fields: list[str]) -> DataFrame:
    """The report of long statistics (group, raster, fields...).

    "agg_field,base_raster": a row for each group, columns <stat>_<raster>, rasters outside, statistics inside.
    "base_raster,agg_field": a row for each raster, columns <stat>_<group>, groups outside, statistics inside.

    Without any group the first has no rows and BARE_FIELDS of each raster as columns, the second its first column alone.
    """
    spark, by_group = stats.sparkSession, normal_order(order) == ORDERS[0]
    known = group_order(stats)
    if not known:
        names = [field, *(f"{f}_{r}" for r in rasters for f in BARE_FIELDS)] if by_group else ["base_raster"]
        return spark.createDataFrame([] if by_group else [(r,) for r in rasters], StructType([StructField(n, StringType()) for n in names]))
    values = [F.first(F.col(_quoted(f))).alias(f) for f in fields]
    if by_group:
        wide = stats.groupBy("group").pivot("raster", rasters).agg(*values)
        out = wide.select("group", *_named(wide, rasters, fields))
        return out.orderBy(F.col("group").cast("string").asc_nulls_last()).withColumn("group", label(F.col("group"))).withColumnRenamed("group", field)
    labels = [x for _, x in known]
    if len(set(labels)) < len(labels):
        raise ValueError("a null group and an empty one have the same label and would share columns")
    wide = stats.withColumn("label", label(F.col("group"))).groupBy("raster").pivot("label", labels).agg(*values)
    place = F.array_position(F.array(*[F.lit(r) for r in rasters]), F.col("raster"))
    return wide.orderBy(place).select(F.col("raster").alias("base_raster"), *_named(wide, labels, fields))


def csv_text(report: DataFrame) -> str:
    """A report as CSV: header, CRLF, null as nothing. Reports have a row a group or raster and are small."""
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(report.columns)
    for row in report.collect():
        writer.writerow(["" if v is None else v for v in row])
    return out.getvalue()


def write_csv(report: DataFrame, path: str) -> None:
    """A report as one named file on the driver."""
    import os

    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(csv_text(report))


def write_csv_parts(df: DataFrame, path: str) -> None:
    """A table of any size as CSV parts, by Spark's writer in the same form."""
    df.write.option("header", True).option("lineSep", "\r\n").option("encoding", "UTF-8").csv(path)
