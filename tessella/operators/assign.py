"""Which cells a zone owns: a cell belongs to a zone if its centre lies inside.

The spatial join is a scan-line plan in built-in functions: each side of a zone becomes one row for every grid row whose
centre line it crosses, the crossings of a zone and row are sorted and paired into spans of columns, and spans are
exploded into cells or into strips of TILE columns. What follows are equi-joins. Holes and parts need no care: inside is
an odd number of crossings to the right. A crossing counts if exactly one end is above the line, a centre on a crossing
is to its right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.scalar import clamp, trunc_int
from tessella.model import TILE, Grid


def grid_edges(edges: DataFrame, grid: Grid) -> DataFrame:
    """edges in grid units: x in columns, y in rows."""
    to_col = lambda c: (F.col(c) - F.lit(grid.x0)) / F.lit(grid.dx)
    to_row = lambda c: (F.col(c) - F.lit(grid.y0)) / F.lit(grid.dy)
    return edges.select("fid", to_col("ax").alias("ax"), to_row("ay").alias("ay"), to_col("bx").alias("bx"), to_row("by").alias("by"))


def spans(edges: DataFrame, grid: Grid) -> DataFrame:
    """(fid, row, first, last): the columns first to last of a row inside a zone, within the grid."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    first, last = clamp(F.ceil(low - 0.5), 0, grid.height), clamp(F.ceil(high - 0.5) - 1, -1, grid.height - 1)
    e = grid_edges(edges, grid).withColumn("r0", first.cast("int")).withColumn("r1", last.cast("int")).where("r0 <= r1")
    crossed = e.select("fid", "ax", "ay", "bx", "by", F.explode(F.sequence("r0", "r1")).alias("row"))
    centre = F.col("row") + 0.5
    x = (F.col("bx") - F.col("ax")) * (centre - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")
    sorted_x = crossed.select("fid", "row", x.alias("x")).groupBy("fid", "row").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pairs = sorted_x.select("fid", "row", "xs", F.explode(F.sequence(F.lit(1), F.size("xs") - 1, F.lit(2))).alias("k"))
    column = lambda k: clamp(F.ceil(F.element_at("xs", k) - 0.5), 0, grid.width).cast("int")
    return pairs.select("fid", "row", column(F.col("k")).alias("first"), (column(F.col("k") + 1) - 1).alias("last")).where("first <= last")


def cells_of_spans(found: DataFrame) -> DataFrame:
    return found.select("fid", "row", F.explode(F.sequence("first", "last")).alias("col"))


def resolve(cells: DataFrame, overlap: str = "last") -> DataFrame:
    """overlap "last": a cell goes to the zone of the largest fid; "all": to every zone that has it."""
    if overlap == "all":
        return cells
    if overlap != "last":
        raise ValueError(f"overlap must be 'last' or 'all', not {overlap!r}")
    return cells.groupBy("row", "col").agg(F.max("fid").alias("fid")).select("fid", "row", "col")


def envelopes(edges: DataFrame) -> DataFrame:
    """(fid, minx, miny, maxx, maxy)."""
    return edges.groupBy("fid").agg(
        F.min(F.least("ax", "bx")).alias("minx"), F.min(F.least("ay", "by")).alias("miny"), F.max(F.greatest("ax", "bx")).alias("maxx"), F.max(F.greatest("ay", "by")).alias("maxy")
    )


def layer_extent(edges: DataFrame) -> DataFrame:
    """One row: minx, miny, maxx, maxy of all zones."""
    return edges.agg(F.min(F.least("ax", "bx")).alias("minx"), F.min(F.least("ay", "by")).alias("miny"), F.max(F.greatest("ax", "bx")).alias("maxx"), F.max(F.greatest("ay", "by")).alias("maxy"))


def boxes_meet(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether two boxes (minx, miny, maxx, maxy) overlap or touch."""
    return ~((a[2] < b[0]) | (b[2] < a[0]) | (a[3] < b[1]) | (b[3] < a[1]))


def window_of_box(boxes: DataFrame, grid: Grid) -> DataFrame:
    """boxes (fid, minx, miny, maxx, maxy) with col_lo, col_hi, row_lo, row_hi: the cells a box touches, half open, the
    low ends cut toward zero, the high ends rounded up, all clamped to the grid; empty windows are left out."""
    gx = [(F.col(c) - F.lit(grid.x0)) / F.lit(grid.dx) for c in ("minx", "maxx")]
    gy = [(F.col(c) - F.lit(grid.y0)) / F.lit(grid.dy) for c in ("miny", "maxy")]
    out = boxes.withColumns({
        "col_lo": clamp(trunc_int(F.least(*gx)), 0, grid.width), "col_hi": clamp(F.ceil(F.greatest(*gx)).cast("int"), 0, grid.width),
        "row_lo": clamp(trunc_int(F.least(*gy)), 0, grid.height), "row_hi": clamp(F.ceil(F.greatest(*gy)).cast("int"), 0, grid.height),
    })
    return out.where("col_lo < col_hi and row_lo < row_hi")


def unset_zones(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """Envelopes of the zones that own no cell."""
    return envelopes(edges).join(cells.select("fid").distinct(), "fid", "left_anti")


def fallback_cells(edges: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """For each zone without a cell, after overlaps are resolved: all cells of its bounding box."""
    w = window_of_box(unset_zones(edges, cells), grid)
    rows = w.select("fid", "col_lo", "col_hi", F.explode(F.sequence("row_lo", F.col("row_hi") - 1)).alias("row"))
    return rows.select("fid", "row", F.explode(F.sequence("col_lo", F.col("col_hi") - 1)).alias("col"))


def assign(edges: DataFrame, grid: Grid, overlap: str = "last", fallback: bool = True) -> DataFrame:
    """cells of every zone on a grid."""
    cells = resolve(cells_of_spans(spans(edges, grid)), overlap)
    return cells.unionByName(fallback_cells(edges, cells, grid)) if fallback else cells


# ---------------------------------------------------------------- strips


def strip_spans(edges: DataFrame, grid: Grid, overlap: str = "last", fallback: bool = True, tile: int = TILE) -> DataFrame:
    """(row, tile, owners): for each strip that any zone meets, spans (fid, a, z) of cells a to z that a zone owns. One row
    a strip, so a raster stored as strips joins by (row, tile) and its pixels never move one by one; a strip's owners are
    as many as its zones' borders, not as its cells."""
    if overlap not in ("last", "all"):
        raise ValueError(f"overlap must be 'last' or 'all', not {overlap!r}")
    found = spans(edges, grid)
    pieces = found.select("fid", "row", "first", "last", F.explode(F.sequence(F.floor(F.col("first") / tile), F.floor(F.col("last") / tile))).alias("tile"))
    pieces = pieces.select("fid", "row", F.col("tile").cast("int").alias("tile"), F.greatest(F.col("first") - F.col("tile") * tile, F.lit(0)).cast("int").alias("a"), F.least(F.col("last") - F.col("tile") * tile, F.lit(tile - 1)).cast("int").alias("z"))
    owners = pieces.groupBy("row", "tile").agg(F.collect_list(F.struct("fid", "a", "z")).alias("owners"))
    if overlap == "last":
        owners = _last(owners)
    if not fallback:
        return owners
    kept = owners.select(F.explode("owners.fid").alias("fid")).distinct()
    extra = _fallback_spans(edges, kept, grid, tile).groupBy("row", "tile").agg(F.collect_list(F.struct("fid", "a", "z")).alias("more"))
    none = F.expr("cast(array() as array<struct<fid:bigint,a:int,z:int>>)")
    joined = owners.join(extra, ["row", "tile"], "full_outer")
    return joined.select("row", "tile", F.concat(F.coalesce("owners", none), F.coalesce("more", none)).alias("owners"))


def _last(owners: DataFrame) -> DataFrame:
    """Where spans overlap, the cells go to the largest fid: a strip is cut where a span begins or has ended."""
    cuts = owners.withColumn("cuts", F.array_sort(F.array_distinct(F.flatten(F.transform("owners", lambda p: F.array(p["a"], p["z"] + 1))))))
    cuts = cuts.withColumn("pairs", F.arrays_zip(F.col("cuts").alias("a"), F.slice("cuts", F.lit(2), F.size("cuts")).alias("b")))
    holder = lambda c: F.array_max(F.transform(F.filter("owners", lambda p: (p["a"] <= c["a"]) & (p["z"] >= c["a"])), lambda p: p["fid"]))
    held = F.transform("pairs", lambda c: F.struct(holder(c).alias("fid"), c["a"].alias("a"), (c["b"] - 1).alias("z")))
    return cuts.select("row", "tile", F.filter(held, lambda p: p["fid"].isNotNull() & p["z"].isNotNull()).alias("owners"))


def _fallback_spans(edges: DataFrame, cells: DataFrame, grid: Grid, tile: int) -> DataFrame:
    """`fallback_cells` as spans of strips: fid, row, tile, a, z."""
    w = window_of_box(unset_zones(edges, cells), grid)
    rows = w.select("fid", "col_lo", (F.col("col_hi") - 1).alias("col_hi"), F.explode(F.sequence("row_lo", F.col("row_hi") - 1)).alias("row"))
    rows = rows.select("fid", "row", "col_lo", "col_hi", F.explode(F.sequence(F.floor(F.col("col_lo") / tile).cast("int"), F.floor(F.col("col_hi") / tile).cast("int"))).alias("tile"))
    return rows.select("fid", "row", "tile", F.greatest(F.col("col_lo") - F.col("tile") * tile, F.lit(0)).cast("int").alias("a"), F.least(F.col("col_hi") - F.col("tile") * tile, F.lit(tile - 1)).cast("int").alias("z"))


def owned_values(strips: DataFrame, owners: DataFrame) -> DataFrame:
    """(raster, fid, value) of every cell of a strip and each of its zones; strips no zone meets are never decoded."""
    both = strips.join(owners, ["row", "tile"])
    held = both.select("raster", "values", F.explode("owners").alias("o"))
    cells = held.select("raster", F.col("o.fid").alias("fid"), F.explode(F.slice("values", F.col("o.a") + 1, F.col("o.z") - F.col("o.a") + 1)).alias("value"))
    return cells.where("value is not null")
