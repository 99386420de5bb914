"""GeoPackage layers as a Spark data source, over the standard library's SQLite.

    spark.dataSource.register(GpkgSource)
    spark.read.format("tessella_gpkg").option("layer", "countries").load("zones.gpkg")

Columns: fid, geom (WKB, null if the feature has none), then the layer's attributes. Without a layer the first is read.
Large layers are read in ranges of fid. The file must be on a disk that the readers mount, as SQLite needs.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing
from urllib.parse import quote

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from tessella.functions.geometry import strip_gpkg

ROWS_PER_PARTITION = 100_000
TYPES = {
    "BOOLEAN": BooleanType(), "TINYINT": LongType(), "SMALLINT": LongType(), "MEDIUMINT": LongType(), "INT": LongType(), "INTEGER": LongType(), "FLOAT": DoubleType(), "DOUBLE": DoubleType(), "REAL": DoubleType(), "BLOB": BinaryType(),
}


def connect(path: str) -> sqlite3.Connection:
    path = path.removeprefix("file://").removeprefix("file:")
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return sqlite3.connect(f"file:{quote(os.path.abspath(path))}?mode=ro", uri=True)


def _name(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


def layers(path: str) -> list[str]:
    """Feature layers, in the order in which the file lists them."""
    with closing(connect(path)) as db:
        return [r[0] for r in db.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid")]


def resolve_layer(path: str, layer: str | None = None) -> str:
    known = layers(path)
    if layer:
        if layer not in known:
            raise ValueError(f"{path} has no layer {layer!r}; it has {', '.join(known) or 'none'}")
        return layer
    if not known:
        raise ValueError(f"{path} has no layers")
    return known[0]


def layer_crs(path: str, layer: str | None = None) -> str:
    """"EPSG:<code>" of a layer, the definition if it is of another authority, or "" if it is undefined."""
    with closing(connect(path)) as db:
        row = db.execute(
            "SELECT s.organization, s.organization_coordsys_id, s.definition FROM gpkg_geometry_columns g JOIN gpkg_spatial_ref_sys s ON g.srs_id = s.srs_id WHERE g.table_name = ?", [resolve_layer(path, layer)]
        ).fetchone()
    if not row or row[1] in (0, -1):
        return ""
    return f"EPSG:{row[1]}" if str(row[0]).upper() == "EPSG" else row[2]


def describe(path: str, layer: str | None = None) -> tuple[str, str, str, list[tuple[str, str]]]:
    """(layer, key column, geometry column, attributes as (name, SQL type))."""
    layer = resolve_layer(path, layer)
    with closing(connect(path)) as db:
        row = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", [layer]).fetchone()
        columns = db.execute(f"PRAGMA table_info({_name(layer)})").fetchall()
    geometry = row[0] if row else "geom"
    key = next((c[1] for c in columns if c[5]), "rowid")
    return layer, key, geometry, [(c[1], c[2].upper()) for c in columns if c[1] not in (key, geometry)]


def fields(path: str, layer: str | None = None) -> list[str]:
    return [n for n, _ in describe(path, layer)[3]]


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class GpkgReader(DataSourceReader):
    def __init__(self, path: str, layer: str | None):
        self.path = path
        self.layer, self.key, self.geometry, self.attributes = describe(path, layer)

    def partitions(self) -> list[InputPartition]:
        with closing(connect(self.path)) as db:
            low, high, n = db.execute(f"SELECT min({_name(self.key)}), max({_name(self.key)}), count(*) FROM {_name(self.layer)}").fetchone()
        if not n:
            return [_Range(0, 0)]
        parts = -(-n // ROWS_PER_PARTITION)
        step = -(-(high - low + 1) // parts)
        return [_Range(low + k * step, min(low + (k + 1) * step, high + 1)) for k in range(parts)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        names = [self.key, self.geometry, *[n for n, _ in self.attributes]]
        kinds = [TYPES.get(t.split("(")[0], StringType()) for _, t in self.attributes]
        with closing(connect(self.path)) as db:
            sql = f"SELECT {', '.join(map(_name, names))} FROM {_name(self.layer)} WHERE {_name(self.key)} >= ? AND {_name(self.key)} < ? ORDER BY 1"
            for fid, geom, *rest in db.execute(sql, [partition.low, partition.high]):
                values = (None if v is None else bool(v) if isinstance(k, BooleanType) else float(v) if isinstance(k, DoubleType) else str(v) if isinstance(k, StringType) else v for v, k in zip(rest, kinds, strict=True))
                yield (fid, strip_gpkg(geom)[0] if geom else None, *values)


class GpkgSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessella_gpkg"

    def schema(self) -> StructType:
        attributes = describe(self.options["path"], self.options.get("layer"))[3]
        return StructType([StructField("fid", LongType()), StructField("geom", BinaryType()), *[StructField(n, TYPES.get(t.split("(")[0], StringType())) for n, t in attributes]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return GpkgReader(self.options["path"], self.options.get("layer"))
