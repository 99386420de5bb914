"""The catalogue of zonal queries over the driver's tables, and the same in SQL.

A raster is made of `part` (50 columns, value p_retailprice, nodata where p_size = 50), zones of `nation` (a triangle
each on a lattice of boxes of 10 by 8 cells, grouped by region), and measures of lineitem stand for further rasters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.scalar import file_stem, is_nodata
from tessella.model import Grid, percentile_name
from tessella.operators import assign, report, stats
from tessella.operators.percentiles import selected_percentiles
from tessella.plans import zonal

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
WIDTH = 50
NODATA = -9999.0


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- fixtures


def grid_pixels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    return p.select(F.lit("price").alias("raster"), F.floor(F.col("p_partkey") / WIDTH).cast("int").alias("row"), (F.col("p_partkey") % WIDTH).cast("int").alias("col"), F.when(F.col("p_size") == 50, NODATA).otherwise(F.col("p_retailprice")).alias("value"))


def grid_of(spark: SparkSession, d: str) -> Grid:
    last = table(spark, d, "part").agg(F.max("p_partkey")).first()[0]
    return Grid(0.0, 1.0, 0.0, 1.0, WIDTH, last // WIDTH + 1)


def shaped(nation: DataFrame, points: list[tuple[float, float]], x: Column | None = None, y: Column | None = None) -> DataFrame:
    """edges of one ring for each nation: points shifted to the nation's box or by x and y."""
    x = F.col("n_nationkey") % 5 * 10.0 if x is None else x
    y = F.floor(F.col("n_nationkey") / 5) * 8.0 if y is None else y
    sides = F.array(*[F.struct(F.lit(float(a[0])).alias("ax"), F.lit(float(a[1])).alias("ay"), F.lit(float(b[0])).alias("bx"), F.lit(float(b[1])).alias("by")) for a, b in zip(points, points[1:] + points[:1], strict=True)])
    rows = nation.select(F.col("n_nationkey").cast("bigint").alias("fid"), x.alias("x"), y.alias("y"), F.explode(sides).alias("s"))
    return rows.select("fid", (F.col("s.ax") + F.col("x")).alias("ax"), (F.col("s.ay") + F.col("y")).alias("ay"), (F.col("s.bx") + F.col("x")).alias("bx"), (F.col("s.by") + F.col("y")).alias("by"))


TRIANGLE = [(0.3, 0.2), (9.7, 0.2), (5.1, 7.9)]
#: Overlapping boxes: each is wider and higher than its place on the lattice.
BOX = [(0.2, 0.2), (13.8, 0.2), (13.8, 10.8), (0.2, 10.8)]
SPECK = [(0.1, 0.1), (0.3, 0.1), (0.2, 0.3)]


def zones_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("fid"), F.col("n_regionkey").alias("group"))


def triangles(spark: SparkSession, d: str) -> DataFrame:
    return shaped(table(spark, d, "nation"), TRIANGLE)


def sql_points(points: list[tuple[float, float]]) -> str:
    return ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(points, points[1:] + points[:1], strict=True))


def sql_zones(points: list[tuple[float, float]], x: str = "(n_nationkey % 5) * 10", y: str = "floor(n_nationkey / 5) * 8", prefix: str = "") -> str:
    """CTEs grid, edges and inside (fid, row, col, value) by ray casting."""
    return f"""
        {prefix}grid AS (
            SELECT CAST(floor(p_partkey / {WIDTH}) AS INT) AS row, CAST(p_partkey % {WIDTH} AS INT) AS col,
                   CASE WHEN p_size = 50 THEN -9999.0 ELSE p_retailprice END AS value
            FROM part
        ), {prefix}edges AS (
            SELECT n_nationkey AS fid, n_regionkey AS grp, CAST(ax AS DOUBLE) + {x} AS ax, CAST(ay AS DOUBLE) + {y} AS ay, CAST(bx AS DOUBLE) + {x} AS bx, CAST(by_ AS DOUBLE) + {y} AS by_
            FROM nation, (VALUES {sql_points(points)}) AS s(ax, ay, bx, by_)
        ), {prefix}inside AS (
            SELECT fid, any_value(grp) AS grp, row, col, any_value(value) AS value
            FROM {prefix}grid JOIN {prefix}edges ON (ay > row + 0.5) <> (by_ > row + 0.5) AND col + 0.5 < (bx - ax) * (row + 0.5 - ay) / (by_ - ay) + ax
            GROUP BY fid, row, col HAVING count(*) % 2 = 1
        )"""


#: Whether a value is not nodata, and the statistics of such values, in SQL.
SQL_MISSING = "abs(value - (-9999.0)) <= 1e-8 + 1e-5 * 9999.0"


def sql_stats(missing: str = SQL_MISSING, percentiles: tuple[float, ...] = (), value: str = "value", present: str = "TRUE") -> str:
    """present: false for the filler row of an outer join."""
    ok = f"NOT ({missing}) AND {present}"
    out = f"""min({value}) FILTER ({ok}) AS min, max({value}) FILTER ({ok}) AS max, CAST(count(*) FILTER ({present}) AS BIGINT) AS count,
        CAST(count(*) FILTER ({missing} AND {present}) AS BIGINT) AS nodata_count, CAST(count(*) FILTER ({ok}) AS BIGINT) AS valid_count,
        round(coalesce(CAST(sum({value}) FILTER ({ok}) AS DOUBLE), 0), 4) AS sum, round(stddev_pop({value}) FILTER ({ok}), 4) AS stdev"""
    for p in percentiles:
        out += f', round(quantile_cont({value}, {p / 100}) FILTER ({ok}), 4) AS "{percentile_name(p)}"'
    return out


def rounded(df: DataFrame, *fields: str) -> DataFrame:
    """Sums, deviations and percentiles to four places, as the SQL has them."""
    names = fields or [c for c, t in df.dtypes if t == "double" and c not in ("min", "max")]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 4) for c in names})


# ---------------------------------------------------------------- zones on the grid

FILLED = f"""
    SELECT n.grp, 'price' AS raster, {sql_stats(percentiles=(5, 50, 95), present="i.fid IS NOT NULL")}
    FROM (SELECT DISTINCT n_nationkey AS fid, n_regionkey AS grp FROM nation) n LEFT JOIN inside i ON n.fid = i.fid GROUP BY n.grp"""


def _filled(spark: SparkSession, d: str, edges: DataFrame, overlap: str = "last", fallback: bool = False, **options) -> DataFrame:
    out = zonal.zonal_statistics(zones_of(spark, d), edges, grid_pixels(spark, d), grid_of(spark, d), ["price"], NODATA, overlap, fallback, **{"percentiles": (5, 50, 95)} | options)
    return rounded(out.withColumnRenamed("group", "grp"))


@query(f"WITH {sql_zones(TRIANGLE)} {FILLED}")
def zonal_all_stats(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: every statistic of every region, regions without cells included."""
    return _filled(spark, d, triangles(spark, d))


@query(f"WITH {sql_zones(TRIANGLE)} {FILLED}")
def zonal_strip_stats(spark: SparkSession, d: str) -> DataFrame:
    """The same with the raster stored as strips."""
    px = grid_pixels(spark, d)
    strips = px.groupBy("raster", "row", F.floor(F.col("col") / 16).cast("int").alias("tile")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("col") % 16, "value"))).alias("m"))
    strips = strips.select("raster", "row", "tile", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.try_element_at("m", k)).alias("values"))
    owned = assign.owned_values(strips, assign.strip_spans(triangles(spark, d), grid_of(spark, d), fallback=False, tile=16))
    zones = zones_of(spark, d)
    out = zonal.finish(zones, owned.join(zones, "fid"), ["price"], NODATA, (5, 50, 95), True)
    return rounded(out.withColumnRenamed("group", "grp"))


@query(f"WITH {sql_zones(TRIANGLE)} SELECT fid, 'price' AS raster, {sql_stats(percentiles=(25, 75))} FROM inside GROUP BY fid")
def zonal_by_feature(spark: SparkSession, d: str) -> DataFrame:
    return rounded(zonal.by_feature(triangles(spark, d), grid_pixels(spark, d), grid_of(spark, d), NODATA, fallback=False, percentiles=(25, 75)))


@query(f"WITH {sql_zones(TRIANGLE)} SELECT fid, row, col FROM inside")
def zonal_pip_raycast(spark: SparkSession, d: str) -> DataFrame:
    return zonal.ray_cast(triangles(spark, d), grid_pixels(spark, d), grid_of(spark, d))


@query(f"WITH {sql_zones(TRIANGLE)} SELECT fid, row, col FROM inside")
def zonal_scanline_assign(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the grid are exactly the parts, so spans need no join to be compared."""
    grid = grid_of(spark, d)
    cells = assign.cells_of_spans(assign.spans(triangles(spark, d), grid))
    return cells.join(grid_pixels(spark, d).select("row", "col"), ["row", "col"], "left_semi").select("fid", "row", "col")


SQL_WINDOW = """
    box AS (
        SELECT fid, min(least(ax, bx)) AS minx, max(greatest(ax, bx)) AS maxx, min(least(ay, by_)) AS miny, max(greatest(ay, by_)) AS maxy FROM edges GROUP BY fid
    ), size AS (
        SELECT 50 AS w, CAST(max(p_partkey) // 50 + 1 AS INT) AS h FROM part
    ), win AS (
        SELECT fid, greatest(0, least(w, CAST(trunc(minx) AS INT))) AS col_lo, greatest(0, least(w, CAST(ceil(maxx) AS INT))) AS col_hi,
               greatest(0, least(h, CAST(trunc(miny) AS INT))) AS row_lo, greatest(0, least(h, CAST(ceil(maxy) AS INT))) AS row_hi
        FROM box, size
    )"""
SQL_FALLBACK = f"""{SQL_WINDOW}, owned AS (
        SELECT fid, row, col, value FROM resolved
        UNION ALL
        SELECT w.fid, g.row, g.col, g.value FROM win w JOIN grid g ON g.row >= row_lo AND g.row < row_hi AND g.col >= col_lo AND g.col < col_hi
        WHERE w.fid NOT IN (SELECT fid FROM resolved)
    )"""


@query(f"WITH {sql_zones(SPECK)}, resolved AS (SELECT fid, row, col, value FROM inside), {SQL_FALLBACK} SELECT fid, 'price' AS raster, {sql_stats()} FROM owned GROUP BY fid")
def zonal_small_zone_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Zones smaller than a cell take the cells of their bounding box."""
    return rounded(zonal.by_feature(shaped(table(spark, d, "nation"), SPECK), grid_pixels(spark, d), grid_of(spark, d), NODATA))


#: Boxes further apart than the grid is wide: the zones of some lie outside it.
WIDE_X, WIDE_Y = "(n_nationkey % 5) * 17 - 4", "floor(n_nationkey / 5) * 11 - 3"


def wide_triangles(spark: SparkSession, d: str) -> DataFrame:
    return shaped(table(spark, d, "nation"), TRIANGLE, F.col("n_nationkey") % 5 * 17.0 - 4, F.floor(F.col("n_nationkey") / 5) * 11.0 - 3)


@query(f"WITH {sql_zones(TRIANGLE, WIDE_X, WIDE_Y)}, {SQL_WINDOW.strip()} SELECT fid, minx, miny, maxx, maxy FROM box WHERE fid NOT IN (SELECT fid FROM inside)")
def zonal_unset_anti(spark: SparkSession, d: str) -> DataFrame:
    grid, edges = grid_of(spark, d), wide_triangles(spark, d)
    cells = assign.cells_of_spans(assign.spans(edges, grid)).join(grid_pixels(spark, d).select("row", "col"), ["row", "col"], "left_semi")
    return assign.unset_zones(edges, cells)


FAR_X = "(n_nationkey % 5) * 10 + 1000"


@query(f"WITH {sql_zones(TRIANGLE, x=FAR_X)} {FILLED}")
def zonal_empty_groups(spark: SparkSession, d: str) -> DataFrame:
    """Zones that lie outside the grid: every group is there, with zeros and nulls."""
    return _filled(spark, d, shaped(table(spark, d, "nation"), TRIANGLE, x=F.col("n_nationkey") % 5 * 10.0 + 1000), fallback=True)


SQL_LAST = "resolved AS (SELECT max(fid) AS fid, row, col, any_value(value) AS value FROM inside GROUP BY row, col)"


@query(f"WITH {sql_zones(BOX)}, {SQL_LAST} SELECT fid, 'price' AS raster, {sql_stats()} FROM resolved GROUP BY fid")
def zonal_overlap_last(spark: SparkSession, d: str) -> DataFrame:
    return rounded(zonal.by_feature(shaped(table(spark, d, "nation"), BOX), grid_pixels(spark, d), grid_of(spark, d), NODATA, "last", False))


@query(f"WITH {sql_zones(BOX)} SELECT grp, 'price' AS raster, {sql_stats()} FROM inside GROUP BY grp")
def zonal_overlap_all(spark: SparkSession, d: str) -> DataFrame:
    """A cell under two zones of a group counts twice in it."""
    cells = assign.assign(shaped(table(spark, d, "nation"), BOX), grid_of(spark, d), "all", False).join(zones_of(spark, d), "fid")
    owned = grid_pixels(spark, d).join(cells, ["row", "col"])
    return rounded(stats.summarise(stats.marked(owned, NODATA), ["group", "raster"]).withColumnRenamed("group", "grp"))


#: Nations 0 to 12 are covered whole by a later one of the same box.
HALF_X, HALF_Y = "(n_nationkey % 13 % 5) * 10", "floor(n_nationkey % 13 / 5) * 8"


@query(f"WITH {sql_zones(BOX, HALF_X, HALF_Y)}, {SQL_LAST}, {SQL_FALLBACK} SELECT fid, 'price' AS raster, {sql_stats()} FROM owned GROUP BY fid")
def zonal_overlap_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A zone that loses all its cells to later ones counts those of its bounding box."""
    k = F.col("n_nationkey") % 13
    edges = shaped(table(spark, d, "nation"), BOX, k % 5 * 10.0, F.floor(k / 5) * 8.0)
    return rounded(zonal.by_feature(edges, grid_pixels(spark, d), grid_of(spark, d), NODATA, "last", True))


# ---------------------------------------------------------------- nodata


@query("""
    SELECT l_orderkey, l_linenumber, abs(l_tax - 0.0) <= 1e-8 + 1e-5 * abs(0.0) AS tax_missing, abs(l_quantity - 50.0) <= 1e-8 + 1e-5 * abs(50.0) AS quantity_missing,
           abs(l_extendedprice - 30000.0) <= 1e-8 + 1e-5 * 30000.0 AS price_missing
    FROM lineitem""")
def nodata_isclose(spark: SparkSession, d: str) -> DataFrame:
    close = lambda c, nd: is_nodata(F.col(c), F.lit(nd))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", close("l_tax", 0.0).alias("tax_missing"), close("l_quantity", 50.0).alias("quantity_missing"), close("l_extendedprice", 30000.0).alias("price_missing"))


def line_rows(spark: SparkSession, d: str, value: str, nodata: float | None = None) -> DataFrame:
    return stats.marked(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("grp"), F.col(value).alias("value")), nodata)


def line_stats(spark: SparkSession, d: str, value: str, nodata: float | None, fields: list[str] | None = None, percentiles=(), **options) -> DataFrame:
    out = rounded(stats.summarise(line_rows(spark, d, value, nodata), ["grp"], percentiles, **options))
    return out.select("grp", *fields) if fields else out


def sql_lines(value: str, missing: str, what: str) -> str:
    return f"SELECT l_returnflag AS grp, {what} FROM (SELECT *, {value} AS value FROM lineitem) WHERE TRUE GROUP BY l_returnflag"


@query(sql_lines("l_quantity", "FALSE", sql_stats("FALSE")))
def nodata_none(spark: SparkSession, d: str) -> DataFrame:
    return line_stats(spark, d, "l_quantity", None)


@query("""
    SELECT l_returnflag AS grp, min(l_quantity) AS min, max(l_quantity) AS max, CAST(count(*) AS BIGINT) AS count, CAST(count(*) FILTER (l_quantity = 50) AS BIGINT) AS nodata_count,
           CAST(count(*) FILTER (l_quantity <> 50) AS BIGINT) AS valid_count, round(sum(l_quantity), 4) AS sum, round(stddev_pop(l_quantity), 4) AS stdev
    FROM lineitem GROUP BY l_returnflag""")
def nodata_included(spark: SparkSession, d: str) -> DataFrame:
    """Nodata values are counted as such but contribute to the rest."""
    return line_stats(spark, d, "l_quantity", 50.0, ignore_nodata=False)


@query("""
    SELECT l_returnflag AS grp, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(count(*) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS nodata_count,
           CAST(0 AS BIGINT) AS valid_count, CAST(0 AS DOUBLE) AS sum, CAST(NULL AS DOUBLE) AS stdev
    FROM lineitem WHERE l_quantity = 50 GROUP BY l_returnflag""")
def all_nodata_group(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_quantity = 50").select(F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("value"))
    return stats.summarise(stats.marked(rows, 50.0), ["grp"])


# ---------------------------------------------------------------- single aggregates

OK50 = "abs(value - 50.0) <= 1e-8 + 1e-5 * 50.0"


def _one(name: str, fields: list[str], what: str, **options) -> None:
    def f(spark: SparkSession, d: str) -> DataFrame:
        return line_stats(spark, d, "l_quantity", 50.0, fields, **options)

    f.__name__ = name
    query(sql_lines("l_quantity", OK50, what))(f)


_one("agg_count", ["count", "nodata_count"], f"CAST(count(*) AS BIGINT) AS count, CAST(count(*) FILTER ({OK50}) AS BIGINT) AS nodata_count")
_one("agg_valid_count", ["valid_count"], f"CAST(count(*) FILTER (NOT {OK50}) AS BIGINT) AS valid_count")
_one("agg_sum", ["sum"], f"round(CAST(sum(value) FILTER (NOT {OK50}) AS DOUBLE), 4) AS sum")
_one("agg_minmax", ["min", "max"], f"min(value) FILTER (NOT {OK50}) AS min, max(value) FILTER (NOT {OK50}) AS max")
_one("agg_stdev", ["stdev"], f"round(stddev_pop(value) FILTER (NOT {OK50}), 4) AS stdev")
_one("agg_avg", ["avg"], f"round(avg(value) FILTER (NOT {OK50}), 4) AS avg", extra=("avg",))
_one("agg_median", ["median"], f"round(quantile_cont(value, 0.5) FILTER (NOT {OK50}), 4) AS median", extra=("median",))


def sql_percentiles(ps: tuple[float, ...], value: str = "l_extendedprice") -> str:
    return "SELECT l_returnflag AS grp, " + ", ".join(f'round(quantile_cont({value}, {p / 100}), 4) AS "{percentile_name(p)}"' for p in ps) + " FROM lineitem GROUP BY l_returnflag"


@query(sql_percentiles((5, 10, 25, 75, 90, 95)))
def agg_percentiles(spark: SparkSession, d: str) -> DataFrame:
    ps = (5, 10, 25, 75, 90, 95)
    return line_stats(spark, d, "l_extendedprice", None, [percentile_name(p) for p in ps], ps)


@query(sql_percentiles((2.5, 97.5)))
def agg_percentile_fractional(spark: SparkSession, d: str) -> DataFrame:
    out = line_stats(spark, d, "l_extendedprice", None, None, (97.5, 2.5, 2.5))
    return out.select("grp", "`p2.5`", "`p97.5`")


@query(sql_percentiles((5, 50, 95), "CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE)"))
def agg_percentile_float32(spark: SparkSession, d: str) -> DataFrame:
    return line_stats(spark, d, "l_extendedprice", None, ["p5", "p50", "p95"], (5, 50, 95), float32=True)


@query(sql_percentiles((5, 50, 95)))
def agg_percentiles_selected(spark: SparkSession, d: str) -> DataFrame:
    """The same numbers without any group in one task."""
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("grp"), F.col("l_extendedprice").alias("value"))
    return rounded(selected_percentiles(rows, ["grp"], (5, 50, 95), limit=2000))


@query(sql_lines("l_quantity", OK50, sql_stats(OK50, (5, 50, 95))))
def agg_discrete(spark: SparkSession, d: str) -> DataFrame:
    """Whole numbers counted by value first."""
    return rounded(stats.summarise_discrete(line_rows(spark, d, "l_quantity", 50.0), ["grp"], (5, 50, 95)))


# ---------------------------------------------------------------- several rasters, reports

STEMS = {"price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}


def stacked(spark: SparkSession, d: str, group: Column | None = None) -> DataFrame:
    """(group, raster, value): three measures as three rasters, in one scan."""
    line = table(spark, d, "lineitem")
    measures = F.explode(F.array(*[F.struct(F.lit(s).alias("raster"), F.col(c).alias("value")) for s, c in STEMS.items()]))
    return line.select((F.col("l_returnflag") if group is None else group).alias("group"), measures.alias("m")).select("group", "m.raster", "m.value")


SQL_STACKED = " UNION ALL ".join(f"SELECT l_returnflag AS grp, '{s}' AS raster, {c} AS value FROM lineitem" for s, c in STEMS.items())
SHOWN = ["min", "max", "count", "sum"]


def long_stats(rows: DataFrame, nodata: float | None = 0.0, **options) -> DataFrame:
    return rounded(stats.summarise(stats.marked(rows, nodata), ["group", "raster"], **options))


def sql_cells(stem: str, where: str) -> list[str]:
    ok = f"{where} AND NOT abs(value) <= 1e-8"
    return [f"min(value) FILTER ({ok}) AS min_{stem}", f"max(value) FILTER ({ok}) AS max_{stem}", f"CAST(count(*) FILTER ({where}) AS BIGINT) AS count_{stem}", f"round(CAST(sum(value) FILTER ({ok}) AS DOUBLE), 4) AS sum_{stem}"]


@query(f"SELECT grp AS returnflag, {', '.join(x for s in STEMS for x in sql_cells(s, f"raster = '{s}'"))} FROM ({SQL_STACKED}) GROUP BY grp")
def pivot_group_rows(spark: SparkSession, d: str) -> DataFrame:
    return report.pivoted(long_stats(stacked(spark, d)), "agg_field, base_raster", "returnflag", list(STEMS), SHOWN)


@query(f"SELECT raster AS base_raster, {', '.join(x for g in 'ANR' for x in sql_cells(g, f"grp = '{g}'"))} FROM ({SQL_STACKED}) GROUP BY raster")
def pivot_raster_rows(spark: SparkSession, d: str) -> DataFrame:
    return report.pivoted(long_stats(stacked(spark, d)), "base_raster,agg_field", "returnflag", list(STEMS), SHOWN)


@query(f"WITH {sql_zones(TRIANGLE)} SELECT CASE WHEN grp = 4 THEN NULL ELSE grp END AS grp, coalesce(CAST(CASE WHEN grp = 4 THEN NULL ELSE grp END AS VARCHAR), '') AS label, {sql_stats()} FROM inside GROUP BY ALL")
def null_group(spark: SparkSession, d: str) -> DataFrame:
    """Null is a group like any other; its label is the empty text."""
    zones = zones_of(spark, d).withColumn("group", F.when(F.col("group") != 4, F.col("group")))
    cells = assign.assign(triangles(spark, d), grid_of(spark, d), fallback=False).join(zones, "fid")
    out = stats.summarise(stats.marked(grid_pixels(spark, d).join(cells, ["row", "col"]), NODATA), ["group"])
    return rounded(out).withColumn("label", F.coalesce(F.col("group").cast("string"), F.lit(""))).withColumnRenamed("group", "grp")


@query("""
    SELECT CASE WHEN n_nationkey = 7 THEN NULL ELSE n_nationkey END AS grp, coalesce(CAST(CASE WHEN n_nationkey = 7 THEN NULL ELSE n_nationkey END AS VARCHAR), '') AS label,
           CAST(row_number() OVER (ORDER BY CAST(CASE WHEN n_nationkey = 7 THEN NULL ELSE n_nationkey END AS VARCHAR) ASC NULLS LAST) - 1 AS BIGINT) AS ordinal
    FROM nation""")
def group_sort_key(spark: SparkSession, d: str) -> DataFrame:
    """Groups in report order: 10 before 9, null last."""
    groups = table(spark, d, "nation").select(F.when(F.col("n_nationkey") != 7, F.col("n_nationkey")).alias("group"))
    known = [(g, x, k) for k, (g, x) in enumerate(report.group_order(groups))]
    return spark.createDataFrame(known, "grp int, label string, ordinal bigint")


SETS = {"nation": "n_name", "region": "r_name", "segment": "c_mktsegment"}
SQL_SET_ROWS = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"""
    WITH rows AS (SELECT n_name AS nation, r_name AS region, c_mktsegment AS segment, l_extendedprice AS value FROM {SQL_SET_ROWS})
    SELECT CASE WHEN grouping(nation) = 0 THEN 'nation' WHEN grouping(region) = 0 THEN 'region' ELSE 'segment' END AS grouping_name, coalesce(nation, region, segment) AS grp, {sql_stats("FALSE", (95,))}
    FROM rows GROUP BY GROUPING SETS ((nation), (region), (segment))""")
def multi_job_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """Jobs that differ in the grouping attribute alone, in one pass over the pixels."""
    line = table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("value"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    places = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = places.select("c_custkey", *[F.col(c).alias(n) for n, c in SETS.items()])
    rows = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(places, F.col("o_custkey") == F.col("c_custkey")).select(*SETS, "value")
    out = stats.grouping_sets(stats.marked(rows), list(SETS), (95,))
    return rounded(out.withColumnRenamed("grouping", "grouping_name").withColumnRenamed("group", "grp"))


@query(f"""
    WITH {sql_zones(TRIANGLE)}, {SQL_WINDOW.strip()}
    SELECT fid, NOT (maxx < 0 OR 25 < minx OR maxy < 0 OR 16.2 < miny) AS meets, NOT (maxx < 9.7 OR 9.7 < minx OR maxy < 0.2 OR 0.2 < miny) AS touches FROM box""")
def extent_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Boxes that only touch count as overlapping."""
    box = lambda *v: tuple(F.lit(float(x)) for x in v)
    mine = tuple(F.col(c) for c in ("minx", "miny", "maxx", "maxy"))
    return assign.envelopes(triangles(spark, d)).select("fid", assign.boxes_meet(mine, box(0, 0, 25, 16.2)).alias("meets"), assign.boxes_meet(mine, box(9.7, 0.2, 9.7, 0.2)).alias("touches"))


@query("SELECT CAST(floor(p_partkey / 50) AS INT) AS row, CAST(p_partkey % 50 AS INT) AS col, p_retailprice AS price, CAST(p_size AS DOUBLE) AS size, round(p_retailprice * p_size, 4) AS product FROM part")
def grid_align_join(spark: SparkSession, d: str) -> DataFrame:
    """Two rasters on one grid, cell by cell."""
    p = table(spark, d, "part")
    at = [F.floor(F.col("p_partkey") / WIDTH).cast("int").alias("row"), (F.col("p_partkey") % WIDTH).cast("int").alias("col")]
    a, b = p.select(*at, F.col("p_retailprice").alias("price")), p.select(*at, F.col("p_size").cast("double").alias("size"))
    return a.join(b, ["row", "col"]).withColumn("product", F.round(F.col("price") * F.col("size"), 4))


@query(f"WITH {sql_zones(TRIANGLE, WIDE_X, WIDE_Y)}, {SQL_WINDOW.strip()} SELECT fid, col_lo, col_hi, row_lo, row_hi FROM win WHERE col_lo < col_hi AND row_lo < row_hi")
def window_clip(spark: SparkSession, d: str) -> DataFrame:
    return assign.window_of_box(assign.envelopes(wide_triangles(spark, d)), grid_of(spark, d)).select("fid", "col_lo", "col_hi", "row_lo", "row_hi")


@query("""
    SELECT CAST(floor(p_partkey / 50) AS INT) AS row, CAST(p_partkey % 50 AS INT) AS col, round(-180 + (p_partkey % 50 + 0.5) * 0.25, 6) AS cx, round(90 - (floor(p_partkey / 50) + 0.5) * 0.5, 6) AS cy FROM part""")
def pixel_centres(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a north-up grid in world coordinates."""
    cells = zonal.pixel_centres(grid_pixels(spark, d), Grid(-180.0, 0.25, 90.0, -0.5, WIDTH, 1000))
    return cells.select("row", "col", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query(r"""
    SELECT p_partkey, regexp_extract(parse_filename('/data/' || replace(p_name, ' ', '/') || '.' || p_brand || '.tif'), '^(.*)\.[^.]*$', 1) AS stem FROM part""")
def file_stems(spark: SparkSession, d: str) -> DataFrame:
    """Names of rasters from their paths."""
    path = F.concat(F.lit("/data/"), F.translate("p_name", " ", "/"), F.lit("."), "p_brand", F.lit(".tif"))
    return table(spark, d, "part").select("p_partkey", file_stem(path).alias("stem"))


@query(f"SELECT raster, CAST(count(*) AS BIGINT) AS count, round(sum(value), 4) AS sum FROM ({SQL_STACKED}) GROUP BY raster")
def raster_union(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stacked(spark, d).groupBy("raster").agg(F.count(F.lit(1)).alias("count"), F.sum("value").alias("sum")))


@query("SELECT DISTINCT l_returnflag AS grp FROM lineitem UNION SELECT DISTINCT o_orderstatus FROM orders")
def group_key_union(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("grp")).distinct()
    return a.union(table(spark, d, "orders").select("o_orderstatus").distinct()).distinct()


@query("""
    WITH cube AS (SELECT r_regionkey AS grp, raster FROM region, (VALUES ('balance'), ('debt')) AS v(raster)),
         rows AS (SELECT CASE WHEN n_regionkey < 3 THEN n_regionkey END AS grp, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'balance' END AS raster, c_acctbal AS value
                  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey < 3)
    SELECT c.grp, c.raster, min(value) AS min, max(value) AS max, CAST(count(value) AS BIGINT) AS count, CAST(0 AS BIGINT) AS nodata_count, CAST(count(value) AS BIGINT) AS valid_count,
           round(coalesce(CAST(sum(value) AS DOUBLE), 0), 4) AS sum, round(stddev_pop(value), 4) AS stdev
    FROM cube c LEFT JOIN rows r ON c.grp = r.grp AND c.raster = r.raster GROUP BY c.grp, c.raster""")
def cube_complete(spark: SparkSession, d: str) -> DataFrame:
    """Every group and raster has a row, also where no value was met."""
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).where("n_regionkey < 3")
    rows = rows.select(F.col("n_regionkey").alias("group"), F.when(F.col("c_acctbal") < 0, "debt").otherwise("balance").alias("raster"), F.col("c_acctbal").alias("value"))
    cube = stats.complete_cube(table(spark, d, "region").select(F.col("r_regionkey").alias("group")), ["balance", "debt"])
    return rounded(stats.filled(stats.summarise(stats.marked(rows), ["group", "raster"]), cube, ["group", "raster"]).withColumnRenamed("group", "grp"))


@query(f"""
    SELECT l_returnflag AS grp, round(avg(value) FILTER (NOT {OK50}), 4) AS avg, round(stddev_pop(value) FILTER (NOT {OK50}), 4) AS stdev, CAST(count(*) FILTER (NOT {OK50}) AS BIGINT) AS valid_count,
           CAST(count(*) AS BIGINT) AS total_count, round(quantile_cont(value, 0.5) FILTER (NOT {OK50}), 4) AS median, round(quantile_cont(value, 0.05) FILTER (NOT {OK50}), 4) AS p5
    FROM (SELECT *, l_quantity AS value FROM lineitem) GROUP BY l_returnflag""")
def requested_columns(spark: SparkSession, d: str) -> DataFrame:
    """Exactly the operations asked for; Catalyst drops the others' aggregates."""
    asked = ["avg", "stdev", "valid_count", "total_count", "median", "p5"]
    return line_stats(spark, d, "l_quantity", 50.0, stats.requested_fields(asked), (5,), extra=("avg", "median", "total_count"))
