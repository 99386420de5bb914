"""Running jobs: zones and rasters from files, a CSV report from each job.

Jobs that share vector, layer and rasters run as one bundle: cells are assigned once for each grid, pixels are read once,
and the jobs' attributes are grouping sets of one aggregation. Bundles run at the same time on one session.

    python -m tessella.plans.jobs config.ini
"""

from __future__ import annotations

import argparse
import logging
import threading
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import geometry
from tessella.model import STAT_FIELDS, Grid, percentile_name
from tessella.operators import assign, report, stats
from tessella.plans.config import JobConfig, JobSpec, parse_config
from tessella.sources import geotiff, gpkg

LOG = logging.getLogger(__name__)
#: Up to so many headers are read on the driver; so many names and nodata values are broadcast.
HEADERS_ON_DRIVER, BROADCAST_RASTERS = 32, 100_000


@dataclass(frozen=True)
class JobOptions:
    """columns: "compat" reports all statistics and the percentiles asked for, "requested" just the operations.
    simplify: tolerance of zones in cell widths, 0 for none. on_duplicate_stem: "error" or "last". in_task: rasters of real
    values with more cells than this get their percentiles by narrowing ranges, not from a map of a group's values."""

    columns: str = "compat"
    overlap: str = "last"
    simplify: float = 0.5
    nan_is_nodata: bool = True
    ignore_nodata: bool = True
    on_duplicate_stem: str = "error"
    assume_crs: str | None = None
    approximate: int | None = None
    band: int = 1
    in_task: int = 50_000_000


def report_fields(job: JobSpec, options: JobOptions) -> list[str]:
    if options.columns == "requested":
        return list(job.operations)
    if options.columns != "compat":
        raise ValueError(f"columns must be 'compat' or 'requested', not {options.columns!r}")
    return [*STAT_FIELDS, *map(percentile_name, job.percentiles)]


def _register(spark: SparkSession) -> None:
    for source in (gpkg.GpkgSource, geotiff.GeoTiffSource, geotiff.GeoTiffMetaSource):
        spark.dataSource.register(source)


def load_zones(spark: SparkSession, vector: str, layer: str, fields: list[str]) -> DataFrame:
    """fid, geom and the fields of a layer."""
    rows = spark.read.format("tessella_gpkg").option("layer", layer).load(vector)
    return rows.select("fid", "geom", *[F.col(f"`{f}`") for f in fields])


@dataclass(frozen=True)
class RasterInfo:
    name: str
    path: str
    grid: Grid
    nodata: float | None
    dtype: str
    blocks: tuple[int, int]


def describe(spark: SparkSession, paths: list[str], band: int) -> list[RasterInfo]:
    """What plans need of each raster; many headers are read in tasks."""
    if len(paths) <= HEADERS_ON_DRIVER:
        found = [geotiff.open_raster(p, band) for p in paths]
        return [RasterInfo(r.name, r.path, r.grid, r.nodata, r.dtype.strip("<>"), (r.block_width, r.block_height)) for r in found]
    rows = {r["path"]: r for r in spark.read.format("tessella_geotiff_meta").option("band", band).load(";".join(paths)).collect()}  # a row a raster
    return [RasterInfo(r["raster"], p, Grid(r["x0"], r["dx"], r["y0"], r["dy"], r["width"], r["height"], r["crs"]), r["nodata"], r["dtype"], (r["block_width"], r["block_height"])) for p in paths for r in [rows[p]]]


class Shared:
    """Tables that the reports of a bundle have in common: kept until released."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables.append(df.persist())
        return df

    def release(self) -> None:
        while self.tables:
            self.tables.pop().unpersist()


def _extent(edges: DataFrame) -> tuple[float, ...] | None:
    row = assign.layer_extent(edges).first()
    return None if row is None or row[0] is None else tuple(row)


def owned_pixels(spark: SparkSession, zones: DataFrame, rasters: list[RasterInfo], source_crs: str, options: JobOptions, shared: Shared | None = None) -> DataFrame:
    """(raster, fid, value, missing) of all rasters; grids that are equal share one assignment."""
    shared = shared or Shared()
    by_grid: dict = defaultdict(list)
    for r in rasters:
        by_grid[r.grid].append(r)
    parts = []
    for grid, members in by_grid.items():
        if grid.crs and not source_crs and not options.assume_crs:
            raise ValueError("the vector layer has no reference system; name one with assume_crs")
        edges = shared.keep(geometry.edges_of(zones, grid.crs or None, source_crs or options.assume_crs or None, options.simplify * abs(grid.dx) or None))
        extent = _extent(edges)
        g = grid.bounds()
        if extent is None or extent[2] < g[0] or extent[0] > g[2] or extent[3] < g[1] or extent[1] > g[3]:
            LOG.error("no zone meets the rasters %s", ", ".join(r.name for r in members))
            continue
        # blocks that no zone can meet are not read
        cols, rows = sorted(((extent[0] - grid.x0) / grid.dx, (extent[2] - grid.x0) / grid.dx)), sorted(((extent[1] - grid.y0) / grid.dy, (extent[3] - grid.y0) / grid.dy))
        window = (max(0, int(rows[0]) - 1), min(grid.height, int(rows[1]) + 2), max(0, int(cols[0]) - 1), min(grid.width, int(cols[1]) + 2))
        owners = shared.keep(assign.strip_spans(edges, grid, options.overlap))
        for blocks in dict.fromkeys(r.blocks for r in members):  # files of one layout are planned without opening them
            same = [r for r in members if r.blocks == blocks]
            reader = spark.read.format("tessella_geotiff").option("band", options.band).option("window", ",".join(map(str, window)))
            reader = reader.option("layout", f"{grid.width},{grid.height},{blocks[0]},{blocks[1]}")
            owned = assign.owned_values(reader.load(";".join(r.path for r in same)), owners)
            parts.append(_marked(owned, same, options.nan_is_nodata))
    if not parts:
        return spark.createDataFrame([], "raster string, fid bigint, value double, missing boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _marked(owned: DataFrame, rasters: list[RasterInfo], nan_is_nodata: bool) -> DataFrame:
    """owned with missing, by the nodata value of each raster."""
    known = {r.nodata for r in rasters}
    if len(known) == 1:
        return stats.marked(owned, known.pop(), nan_is_nodata)
    table = owned.sparkSession.createDataFrame([(r.name, r.nodata) for r in rasters], "raster string, nodata double")
    table = F.broadcast(table) if len(rasters) <= BROADCAST_RASTERS else table
    return stats.marked(owned.join(table, "raster", "left"), F.col("nodata"), nan_is_nodata).drop("nodata")


def _summarised(rows: DataFrame, fields: list[str], percentiles: list[float], extra: tuple[str, ...], cells: int, discrete: bool, options: JobOptions, shared: Shared) -> DataFrame:
    """grouping, group, raster and statistics of rows (fields, raster, value, missing, and n if they are counted)."""
    if discrete or options.approximate or cells <= options.in_task or not (percentiles or "median" in extra):
        more = {"weighted": True} if discrete else {"approximate": options.approximate}
        return stats.grouping_sets(rows, fields, percentiles, always=["raster"], ignore_nodata=options.ignore_nodata, extra=extra, **more)
    found = stats.grouping_sets(rows, fields, always=["raster"], ignore_nodata=options.ignore_nodata, extra=tuple(x for x in extra if x != "median"))
    stacked = shared.keep(stats.stacked_groupings(rows, fields, ["raster"]))
    return stats.with_selected(found, stacked, ["grouping", "group", "raster"], percentiles, options.ignore_nodata, extra)


def run_bundle(spark: SparkSession, jobs: list[JobSpec], options: JobOptions = JobOptions(), shared: Shared | None = None) -> dict[str, DataFrame]:
    """The report of each job, by tag; all jobs have the same vector, layer and rasters. Once the reports are read,
    shared.release() gives back what they have in common."""
    shared = shared or Shared()
    _register(spark)
    first = jobs[0]
    fields = list(dict.fromkeys(j.agg_field for j in jobs))
    paths = [str(p) for p in first.base_rasters]
    names = report.check_stems([Path(p).stem for p in paths], options.on_duplicate_stem)
    rasters = list({r.name: r for r in describe(spark, paths, options.band)}.values())
    zones = load_zones(spark, str(first.agg_vector), first.agg_layer, fields)
    source = gpkg.layer_crs(str(first.agg_vector), first.agg_layer)
    percentiles = sorted({p for j in jobs for p in j.percentiles})
    extra = tuple(x for x in ("avg", "median", "total_count") if any(x in j.operations for j in jobs)) if options.columns == "requested" else ()
    pixels = owned_pixels(spark, zones, rasters, source, options, shared)
    # small integers: count each zone's values before anything else moves
    discrete = options.approximate is None and all(r.dtype in ("u1", "i1", "u2", "i2") for r in rasters)
    if discrete:
        pixels = stats.counted(pixels, ["raster", "fid"])
    rows = pixels.join(zones.select("fid", *[F.col(f"`{f}`").alias(f"field_{k}") for k, f in enumerate(fields)]), "fid")
    keys = [f"field_{k}" for k in range(len(fields))]
    cells = sum(r.grid.width * r.grid.height for r in rasters)
    found = shared.keep(_summarised(rows, keys, percentiles, extra, cells, discrete, options, shared))
    out = {}
    for j in jobs:
        mine = found.where(F.col("grouping") == keys[fields.index(j.agg_field)]).drop("grouping")
        groups = zones.select(F.col(f"`{j.agg_field}`").cast("string").alias("group"))
        full = stats.filled(mine, stats.complete_cube(groups, names), ["group", "raster"])
        out[j.tag] = report.pivoted(full, j.row_col_order, j.agg_field, names, report_fields(j, options))
    return out


def raster_statistics(
    spark: SparkSession, raster: str, vector: str, field: str, layer: str | None = None, percentiles=(), polygons_might_overlap: bool = True, options: JobOptions = JobOptions(),
) -> DataFrame:
    """Statistics of one band of one raster by an attribute of a layer: group (of the attribute's type), raster, ...

    Where polygons might overlap a cell counts for each that has it, else for the last one.
    """
    _register(spark)
    layer = gpkg.resolve_layer(vector, layer)
    if field not in gpkg.fields(vector, layer):
        raise ValueError(f"layer {layer!r} has no field {field!r}")
    one, shared = describe(spark, [raster], options.band)[0], Shared()
    zones = load_zones(spark, vector, layer, [field]).withColumnRenamed(field, "group")
    options = replace(options, overlap="all" if polygons_might_overlap else "last")
    pixels = owned_pixels(spark, zones, [one], gpkg.layer_crs(vector, layer), options)
    rows = pixels.join(zones.select("fid", "group"), "fid")
    keys, large = ["group", "raster"], one.grid.width * one.grid.height > options.in_task and options.approximate is None
    found = stats.summarise(rows, keys, () if large else percentiles, ignore_nodata=options.ignore_nodata, approximate=options.approximate)
    found = stats.with_selected(found, rows, keys, percentiles, options.ignore_nodata) if large else found
    return stats.filled(found, stats.complete_cube(zones, [one.name]), ["group", "raster"])


def as_dict(table: DataFrame) -> dict:
    """{group: {statistic: value}} of one raster's statistics."""
    return {r["group"]: {k: v for k, v in r.asDict().items() if k not in ("group", "raster")} for r in table.collect()}


def bundles(jobs: list[JobSpec]) -> list[list[JobSpec]]:
    by: dict = defaultdict(list)
    for j in jobs:
        by[j.agg_vector, j.agg_layer, j.base_rasters].append(j)
    return list(by.values())


def stamped(path: Path, now: datetime) -> Path:
    return path.with_name(f"{path.stem}_{now:%Y_%m_%d_%H_%M_%S}{path.suffix}")


@contextmanager
def progress(spark: SparkSession, every: float = 10.0) -> Iterator[None]:
    """Says in the log, again and again, how many tasks of the stages under way are done."""
    tracker, over = spark.sparkContext.statusTracker(), threading.Event()

    def report_stages() -> None:
        while not over.wait(every):
            for info in filter(None, map(tracker.getStageInfo, tracker.getActiveStageIds())):
                LOG.info("stage %d: %d of %d tasks done, %d failed", info.stageId, info.numCompletedTasks, info.numTasks, info.numFailedTasks)

    thread = threading.Thread(target=report_stages, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def run_config(spark: SparkSession, config: JobConfig, options: JobOptions = JobOptions(), now: datetime | None = None) -> dict[str, Path]:
    """Run all jobs; the paths of their reports by tag. One time stamps all reports of a run."""
    now, written = now or datetime.now(), {}

    def run(jobs: list[JobSpec]) -> None:
        shared = Shared()
        try:
            for tag, table in run_bundle(spark, jobs, options, shared).items():
                path = stamped(next(j.output_csv for j in jobs if j.tag == tag), now)
                report.write_csv(table, str(path))
                written[tag] = path
                LOG.info("%s: %s (%d of %d reports)", tag, path, len(written), len(config.jobs))
        finally:
            shared.release()

    groups = bundles(config.jobs)
    with progress(spark), ThreadPoolExecutor(max_workers=min(8, len(groups)) or 1) as pool:
        for done in [pool.submit(run, g) for g in groups]:
            done.result()
    return {j.tag: written[j.tag] for j in config.jobs}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Zonal statistics jobs")
    parser.add_argument("config", help="job file")
    parser.add_argument("--columns", choices=("compat", "requested"), default="compat")
    args = parser.parse_args(argv)
    config = parse_config(args.config)
    logging.basicConfig(level=config.project.log_level, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName(config.project.name).config("spark.scheduler.mode", "FAIR").getOrCreate()
    for tag, path in run_config(spark, config, JobOptions(columns=args.columns)).items():
        print(f"{tag}\t{path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
