"""Queries of the catalogue that go through files: tables of the driver are written as GeoTIFF, GeoPackage and job files,
then read by the sources, run as jobs, and the reports read back.

The files are in the folder of spark.checkpoint.dir (a temporary one where a session on one machine has none).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import geometry
from tessella.model import Grid
from tessella.operators import assign
from tessella.plans import config, jobs
from tessella.queries import NODATA, SQL_MISSING, TRIANGLE, WIDTH, query, sql_points, sql_stats, sql_zones, table
from tessella.sources import geotiff, gpkg, writers

NOW = datetime(2020, 1, 2, 3, 4, 5)


def folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.startswith(("local-cluster", "spark:", "yarn", "k8s:", "mesos:")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tessella-")
    path = os.path.join(root.removeprefix("file://").removeprefix("file:"), f"files-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def write_rasters(spark: SparkSession, d: str, path: str) -> Grid:
    """price.tif (real numbers, nodata where p_size is 50) and size.tif (small integers, a second band of their doubles)."""
    rows = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size").toPandas()
    key = rows["p_partkey"].to_numpy()
    grid = Grid(0.0, 1.0, 0.0, 1.0, WIDTH, int(key.max()) // WIDTH + 1, "EPSG:3857")
    price, size = np.full(grid.width * grid.height, NODATA), np.zeros(grid.width * grid.height, np.uint8)
    price[key] = np.where(rows["p_size"] == 50, NODATA, rows["p_retailprice"])
    size[key] = rows["p_size"]
    shape = (grid.height, grid.width)
    writers.write_geotiff(f"{path}/price.tif", [price.reshape(shape)], grid, NODATA)
    writers.write_geotiff(f"{path}/size.tif", [size.reshape(shape), 2 * size.reshape(shape)], grid)
    return grid


def write_zones(spark: SparkSession, d: str, path: str) -> None:
    """zones.gpkg: nations (a triangle each, and one feature without a geometry) and regions."""
    nations = sorted(tuple(r) for r in table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").collect())
    regions = sorted(tuple(r) for r in table(spark, d, "region").select("r_regionkey", "r_name").collect())
    at = lambda n: [[[(x + n % 5 * 10.0, y + n // 5 * 8.0) for x, y in TRIANGLE]]]
    layers = {
        "nations": (3857, [("name", "TEXT"), ("region", "INTEGER")], [*[(n, at(n), name, r) for n, name, r in nations], (1000, None, "NOWHERE", 77)]),
        "regions": (3857, [("label", "TEXT")], [(k, None, name) for k, name in regions]),
    }
    writers.write_gpkg(f"{path}/zones.gpkg", layers)


@query(f"""
    SELECT 'price' AS raster, CAST(floor(p_partkey / {WIDTH}) AS INT) AS row, CAST(p_partkey % {WIDTH} AS INT) AS col, p_retailprice AS value FROM part WHERE p_size <> 50
    UNION ALL SELECT 'size', CAST(floor(p_partkey / {WIDTH}) AS INT), CAST(p_partkey % {WIDTH} AS INT), CAST(2 * p_size AS DOUBLE) FROM part WHERE p_size <> 0""")
def file_raster_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every cell of a raster's only band and of another's second one."""
    path = folder(spark)
    write_rasters(spark, d, path)
    spark.dataSource.register(geotiff.GeoTiffSource)
    strips = [spark.read.format("tessella_geotiff").option("band", b).load(f"{path}/{n}.tif") for n, b in (("price", 1), ("size", 2))]
    cells = strips[0].unionByName(strips[1]).select("raster", "row", "tile", F.posexplode("values").alias("k", "value")).where("value is not null")
    return cells.where((F.col("value") != NODATA) & (F.col("value") != 0)).select("raster", "row", (F.col("tile") * 256 + F.col("k")).alias("col"), "value")


@query(f"""
    WITH size AS (SELECT CAST(max(p_partkey) // {WIDTH} + 1 AS INT) AS h FROM part)
    SELECT 'price' AS raster, 0.0::DOUBLE AS x0, 1.0::DOUBLE AS dx, 0.0::DOUBLE AS y0, 1.0::DOUBLE AS dy, CAST({WIDTH} AS INT) AS width, h AS height, 'EPSG:3857' AS crs, {NODATA}::DOUBLE AS nodata, 'f8' AS dtype FROM size
    UNION ALL SELECT 'size', 0.0, 1.0, 0.0, 1.0, {WIDTH}, h, 'EPSG:3857', NULL, 'u1' FROM size""")
def file_raster_meta(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    write_rasters(spark, d, path)
    spark.dataSource.register(geotiff.GeoTiffMetaSource)
    return spark.read.format("tessella_geotiff_meta").load(f"{path}/price.tif;{path}/size.tif").drop("path", "band", "block_width", "block_height")


@query(f"""
    WITH points(x, y) AS (VALUES {", ".join(f"({x}, {y})" for x, y in TRIANGLE)}),
         boxes AS (SELECT n_nationkey AS fid, min(x + n_nationkey % 5 * 10) AS minx, min(y + n_nationkey // 5 * 8) AS miny, max(x + n_nationkey % 5 * 10) AS maxx, max(y + n_nationkey // 5 * 8) AS maxy FROM nation, points GROUP BY n_nationkey)
    SELECT CAST(n_nationkey AS BIGINT) AS fid, n_name AS name, CAST(n_regionkey AS BIGINT) AS region, CAST(minx AS DOUBLE) AS minx, CAST(miny AS DOUBLE) AS miny, CAST(maxx AS DOUBLE) AS maxx, CAST(maxy AS DOUBLE) AS maxy
    FROM nation JOIN boxes ON fid = n_nationkey
    UNION ALL SELECT 1000, 'NOWHERE', 77, NULL, NULL, NULL, NULL""")
def file_zone_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of the default layer with their envelopes; one has no geometry."""
    path = folder(spark)
    write_zones(spark, d, path)
    spark.dataSource.register(gpkg.GpkgSource)
    zones = spark.read.format("tessella_gpkg").load(f"{path}/zones.gpkg")
    return zones.drop("geom").join(assign.envelopes(geometry.edges_of(zones)), "fid", "left")


@query("SELECT CAST(r_regionkey AS BIGINT) AS fid, r_name AS label, CAST(1 AS INT) AS ordinal, 'regions' AS layer, 'label' AS fields, 'EPSG:3857' AS crs FROM region")
def file_zone_layers(spark: SparkSession, d: str) -> DataFrame:
    """A layer by name, and its place in the file's list, its fields and reference system."""
    path = folder(spark)
    write_zones(spark, d, path)
    file, known = f"{path}/zones.gpkg", gpkg.layers(f"{path}/zones.gpkg")
    spark.dataSource.register(gpkg.GpkgSource)
    rows = spark.read.format("tessella_gpkg").option("layer", gpkg.resolve_layer(file, "regions")).load(file)
    about = F.lit(known.index("regions")).alias("ordinal"), F.lit("regions").alias("layer"), F.lit(",".join(gpkg.fields(file, "regions"))).alias("fields"), F.lit(gpkg.layer_crs(file, "regions")).alias("crs")
    return rows.select("fid", "label", *about)


LON, LAT = "(ax / 2)", "(ay + 20)"


@query(f"""
    WITH edges AS (SELECT n_nationkey AS fid, ax + (n_nationkey % 5) * 10 AS ax, ay + floor(n_nationkey / 5) * 8 AS ay FROM nation, (VALUES {sql_points(TRIANGLE)}) AS s(ax, ay, bx, by_))
    SELECT CAST(fid AS BIGINT) AS fid, round(6378137 * radians({LON}), 2) AS x, round(6378137 * ln(tan(pi() / 4 + radians({LAT}) / 2)), 2) AS y FROM edges""")
def file_zones_reprojected(spark: SparkSession, d: str) -> DataFrame:
    """Corners of zones in degrees, moved to the reference system of a raster."""
    path, nations = folder(spark), sorted(r[0] for r in table(spark, d, "nation").select("n_nationkey").collect())
    at = lambda n: [[[((x + n % 5 * 10.0) / 2, y + n // 5 * 8.0 + 20) for x, y in TRIANGLE]]]
    writers.write_gpkg(f"{path}/degrees.gpkg", {"nations": (4326, [], [(n, at(n)) for n in nations])})
    spark.dataSource.register(gpkg.GpkgSource)
    zones = spark.read.format("tessella_gpkg").load(f"{path}/degrees.gpkg")
    edges = geometry.edges_of(zones, "EPSG:3857", gpkg.layer_crs(f"{path}/degrees.gpkg"))
    return edges.select("fid", F.round("ax", 2).alias("x"), F.round("ay", 2).alias("y"))


JOBS = """
[project]
name = world
global_work_dir = {path}/work
global_output_dir = {path}/out
log_level = warning
[job:by_region]
agg_vector = {path}/zones.gpkg
agg_field = region
base_raster_pattern = {path}/*.tif, {path}/price.tif
operations = AVG, stdev, p5 , p95, stdev
row_col_order = agg_field, base_raster
[job: across]
agg_vector = {path}/zones.gpkg
agg_layer = nations
agg_field = region
base_raster_pattern = {path}/size.tif,{path}/price.tif
operations = p5,p95
row_col_order = base_raster,agg_field
[other]
key = value
"""


def _project(spark: SparkSession, d: str, run: bool = True) -> tuple[config.JobConfig, dict]:
    path = folder(spark)
    write_zones(spark, d, path)
    write_rasters(spark, d, path)
    with open(f"{path}/world.ini", "w") as f:
        f.write(JOBS.format(path=path))
    cfg = config.parse_config(f"{path}/world.ini")
    return cfg, jobs.run_config(spark, cfg, now=NOW) if run else {}


@query("""
    SELECT * FROM (VALUES
        ('by_region', 1, 'nations', 'region', 'price,size', 'avg,stdev,p5,p95', 'p5,p95', 'by_region_2020_01_02_03_04_05.csv', 'agg_field,base_raster', 'WARNING'),
        ('across', 2, 'nations', 'region', 'size,price', 'p5,p95', 'p5,p95', 'across_2020_01_02_03_04_05.csv', 'base_raster,agg_field', 'WARNING')
    ) AS t(tag, ordinal, layer, field, rasters, operations, percentiles, file, row_col_order, log_level)""")
def file_job_config(spark: SparkSession, d: str) -> DataFrame:
    """What a job file asks for: sections, globs, operations, the default layer, stamped names."""
    cfg, _ = _project(spark, d, run=False)
    rows = [(j.tag, k + 1, j.agg_layer, j.agg_field, ",".join(p.stem for p in j.base_rasters), ",".join(j.operations), ",".join(f"p{p:g}" for p in j.percentiles), jobs.stamped(j.output_csv, NOW).name, j.row_col_order, cfg.project.log_level) for k, j in enumerate(cfg.jobs)]
    return spark.createDataFrame(rows, "tag string, ordinal int, layer string, field string, rasters string, operations string, percentiles string, file string, row_col_order string, log_level string")


def _read_report(spark: SparkSession, path: str) -> DataFrame:
    """(label, ordinal, field, value) of every field of a report, in the order of its columns."""
    wide = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cells = F.array(*[F.struct(F.lit(k).alias("ordinal"), F.lit(c).alias("field"), F.round(F.col(f"`{c}`").cast("double"), 4).alias("value")) for k, c in enumerate(wide.columns) if k])
    return wide.select(F.coalesce(F.col(wide.columns[0]), F.lit("")).alias("label"), F.inline(cells))


FIELDS = ("min", "max", "count", "nodata_count", "valid_count", "sum", "stdev", "p5", "p95")
GROUPS = ("0", "1", "2", "3", "4", "77")  # 77: a feature without a geometry
SQL_REPORT = f"""
    WITH {sql_zones(TRIANGLE)}, sized AS (SELECT i.grp, CAST(coalesce(p_size, 0) AS DOUBLE) AS value FROM inside i JOIN part ON p_partkey = i.row * {WIDTH} + i.col),
    groups AS (SELECT DISTINCT n_regionkey AS grp FROM nation UNION ALL SELECT 77),
    price AS (SELECT g.grp, {sql_stats(SQL_MISSING, (5, 95), present="i.grp IS NOT NULL")} FROM groups g LEFT JOIN inside i ON g.grp = i.grp GROUP BY g.grp),
    size AS (SELECT g.grp, {sql_stats("FALSE", (5, 95), present="s.grp IS NOT NULL")} FROM groups g LEFT JOIN sized s ON g.grp = s.grp GROUP BY g.grp)"""


def _sql_cells(rasters: tuple[str, ...], by_group: bool) -> str:
    if by_group:
        cells = [f"SELECT CAST(grp AS VARCHAR) AS label, {1 + k * len(FIELDS) + j} AS ordinal, '{f}_{r}' AS field, round(CAST({f} AS DOUBLE), 4) AS value FROM {r}" for k, r in enumerate(rasters) for j, f in enumerate(FIELDS)]
    else:
        cells = [f"SELECT '{r}' AS label, {1 + k * len(FIELDS) + j} AS ordinal, '{f}_{g}' AS field, round(CAST({f} AS DOUBLE), 4) AS value FROM {r} WHERE grp = {g}" for r in rasters for k, g in enumerate(GROUPS) for j, f in enumerate(FIELDS)]
    return f"{SQL_REPORT} {' UNION ALL '.join(cells)}"


@query(_sql_cells(("price", "size"), True))
def file_job_report(spark: SparkSession, d: str) -> DataFrame:
    """A job from its file to its report: a row for each group, fields in the order of columns."""
    return _read_report(spark, str(_project(spark, d)[1]["by_region"]))


@query(_sql_cells(("size", "price"), False))
def file_job_report_across(spark: SparkSession, d: str) -> DataFrame:
    """The other orientation: a row for each raster."""
    return _read_report(spark, str(_project(spark, d)[1]["across"]))
