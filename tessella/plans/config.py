"""Job files: INI text with one [project] section and one [job:<tag>] section for each job.

    [project]
    name = world              the file's stem
    global_work_dir = ./work
    global_output_dir = ./out
    log_level = INFO          optional

    [job:by_country]
    agg_vector = zones.gpkg
    agg_layer = countries     optional: the first layer
    agg_field = country
    base_raster_pattern = a/*.tif, b/*.tif
    operations = avg, stdev, valid_count, p5, p95
    row_col_order = agg_field,base_raster
"""

from __future__ import annotations

import configparser
import glob
import logging
import os
from dataclasses import dataclass, field
from pathlib import Path

from tessella.model import OPERATIONS, percentiles_of
from tessella.operators.report import normal_order
from tessella.sources import gpkg


@dataclass(frozen=True)
class ProjectSpec:
    name: str
    global_work_dir: Path
    global_output_dir: Path
    log_level: str = "INFO"


@dataclass(frozen=True)
class JobSpec:
    tag: str
    agg_vector: Path
    agg_layer: str
    agg_field: str
    base_rasters: tuple[Path, ...]
    operations: tuple[str, ...]
    output_csv: Path
    work_dir: Path
    row_col_order: str

    @property
    def percentiles(self) -> list[float]:
        return percentiles_of(self.operations)


@dataclass(frozen=True)
class JobConfig:
    project: ProjectSpec
    jobs: list[JobSpec] = field(default_factory=list)


def _value(section, key: str, where: str) -> str:
    value = section.get(key, "").strip()
    if not value:
        raise ValueError(f"[{where}]: {key} is missing")
    return value


def matches(patterns: str) -> list[Path]:
    """Files that comma-separated patterns name, absolute ones too; sorted within a pattern, each file once."""
    found: dict[Path, None] = {}
    for p in filter(None, (p.strip() for p in patterns.split(","))):
        for name in sorted(glob.glob(os.path.expanduser(p), recursive=True)):
            found.setdefault(Path(name))
    return list(found)


def parse_operations(text: str, where: str = "job") -> tuple[str, ...]:
    ops = tuple(dict.fromkeys(o.strip().lower() for o in text.split(",") if o.strip()))
    if not ops:
        raise ValueError(f"[{where}]: operations is empty")
    if unknown := sorted(set(ops) - set(OPERATIONS)):
        raise ValueError(f"[{where}]: unknown operations {', '.join(unknown)}; known are {', '.join(OPERATIONS)}")
    return ops


def parse_config(path: str | Path) -> JobConfig:
    """Read and check a job file. Everything that can be known before a pixel is read is checked here."""
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(str(path))
    parser = configparser.ConfigParser(interpolation=None)
    parser.read(path)
    if not parser.has_section("project"):
        raise ValueError(f"{path}: there is no [project] section")
    section = parser["project"]
    name = _value(section, "name", "project")
    if name != path.stem:
        raise ValueError(f"[project]: name is {name!r} but the file is named {path.stem!r}")
    level = section.get("log_level", "INFO").strip().upper()
    if level not in logging.getLevelNamesMapping():
        raise ValueError(f"[project]: unknown log_level {level!r}")
    project = ProjectSpec(name, Path(_value(section, "global_work_dir", "project")), Path(_value(section, "global_output_dir", "project")), level)
    jobs: dict[str, JobSpec] = {}
    for where in parser.sections():
        prefix, _, tag = where.partition(":")
        if prefix.strip() != "job":
            continue
        tag = tag.strip()
        if not tag:
            raise ValueError(f"[{where}]: the job has no tag")
        if tag in jobs:
            raise ValueError(f"[{where}]: the tag {tag!r} is used twice")
        jobs[tag] = _job(parser[where], where, tag, project)
    return JobConfig(project, list(jobs.values()))


def _job(section, where: str, tag: str, project: ProjectSpec) -> JobSpec:
    vector = Path(_value(section, "agg_vector", where))
    if not vector.exists():
        raise FileNotFoundError(f"[{where}]: agg_vector {vector}")
    rasters = matches(_value(section, "base_raster_pattern", where))
    if not rasters:
        raise FileNotFoundError(f"[{where}]: no file matches base_raster_pattern {section['base_raster_pattern']!r}")
    agg_field = _value(section, "agg_field", where)
    operations = parse_operations(_value(section, "operations", where), where)
    order = normal_order(_value(section, "row_col_order", where))
    layer = gpkg.resolve_layer(str(vector), section.get("agg_layer", "").strip() or None)
    if agg_field not in gpkg.fields(str(vector), layer):
        raise ValueError(f"[{where}]: layer {layer!r} has no field {agg_field!r}; it has {', '.join(gpkg.fields(str(vector), layer))}")
    return JobSpec(tag, vector, layer, agg_field, tuple(rasters), operations, project.global_output_dir / f"{tag}.csv", project.global_work_dir / tag, order)
