"""GeoTIFF rasters as Spark data sources.

    spark.dataSource.register(GeoTiffSource)
    spark.read.format("tessella_geotiff").option("band", 1).load("raster.tif")           strips: raster, row, tile, values
    spark.dataSource.register(GeoTiffMetaSource)
    spark.read.format("tessella_geotiff_meta").load("raster.tif")                        one row of metadata

Reads classic and BigTIFF, either byte order, strips and tiles, 8 to 64 bit integers and floats, uncompressed, deflate
and LZW, horizontal and floating-point predictors, chunky and planar bands, the GDAL_NODATA tag and EPSG geokeys. Anything
else is an error that names it. A partition is a run of blocks, so a task decodes BLOCK_PIXELS pixels at most or a block.

Option window ("row_lo,row_hi,col_lo,col_hi", half open): blocks outside it are never read. Option layout
("width,height,block width,block height" for all files): planning then opens no file; without it headers are read by
several threads.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from pathlib import PurePath

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessella.model import TILE, Grid

BLOCK_PIXELS = 1 << 22
STRIP_SCHEMA = "raster string, row int, tile int, values array<double>"
META_SCHEMA = "raster string, path string, band int, x0 double, dx double, y0 double, dy double, width int, height int, crs string, nodata double, dtype string, block_width int, block_height int"
#: TIFF field types: size and struct code.
FIELDS = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 7: (1, "s"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}


def _open(path: str):
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        return store.open_input_file(name)
    return open(path.removeprefix("file://").removeprefix("file:"), "rb")


@dataclass(frozen=True)
class Raster:
    path: str
    band: int
    bands: int
    grid: Grid
    nodata: float | None
    dtype: str
    block_width: int
    block_height: int
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    compression: int
    predictor: int
    planar: bool
    tiled: bool

    @property
    def name(self) -> str:
        return PurePath(self.path).stem

    @property
    def across(self) -> int:
        return -(-self.grid.width // self.block_width)

    @property
    def down(self) -> int:
        return -(-self.grid.height // self.block_height)


def _tags(f) -> tuple[str, dict[int, tuple]]:
    head = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(f"{order}H", head[2:4])[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    at = struct.unpack(f"{order}Q", head[8:16])[0] if big else struct.unpack(f"{order}I", head[4:8])[0]
    f.seek(at)
    n = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))[0]
    size, inline, wide = (20, 8, "Q") if big else (12, 4, "I")
    table, out = f.read(n * size), {}
    for k in range(n):
        e = table[k * size : (k + 1) * size]
        tag, kind = struct.unpack(f"{order}HH", e[:4])
        count = struct.unpack(order + wide, e[4 : 4 + inline])[0]
        if kind not in FIELDS:
            continue
        width, code = FIELDS[kind]
        data = e[4 + inline :]
        if width * count > inline:
            f.seek(struct.unpack(order + wide, data)[0])
            data = f.read(width * count)
        out[tag] = (data[:count].split(b"\0")[0].decode("latin-1"),) if code == "s" else struct.unpack(f"{order}{count}{code}", data[: width * count])
    return order, out


def open_raster(path: str, band: int = 1) -> Raster:
    """A raster's description, from its header alone."""
    with _open(path) as f:
        order, t = _tags(f)
    one = lambda tag, default=None: t[tag][0] if tag in t else default
    width, height, bands = one(256), one(257), one(277, 1)
    if not 1 <= band <= bands:
        raise ValueError(f"{path} has {bands} bands, not a band {band}")
    bits, form = set(t.get(258, (1,))), set(t.get(339, (1,)))
    kind = {1: "u", 2: "i", 3: "f"}.get(next(iter(form))) if len(form) == 1 else None
    if len(bits) != 1 or kind is None or next(iter(bits)) not in ((32, 64) if kind == "f" else (8, 16, 32, 64)):
        raise ValueError(f"{path}: samples of {sorted(bits)} bits and format {sorted(form)} are not supported")
    compression, predictor = one(259, 1), one(317, 1)
    if compression not in (1, 5, 8, 32946) or predictor not in (1, 2, 3):
        raise ValueError(f"{path}: compression {compression} with predictor {predictor} is not supported")
    tiled = 322 in t
    block_width, block_height = (one(322), one(323)) if tiled else (width, min(one(278, height), height))
    if 34264 in t:
        m = t[34264]
        if m[1] or m[4]:
            raise ValueError(f"{path}: rotated rasters are not supported")
        x0, dx, y0, dy = m[3], m[0], m[7], m[5]
    elif 33550 in t and 33922 in t:
        (sx, sy, *_), (i, j, _, x, y, *_) = t[33550], t[33922]
        x0, dx, y0, dy = x - i * sx, sx, y + j * sy, -sy
    else:
        x0, dx, y0, dy = 0.0, 1.0, 0.0, 1.0
    keys = t.get(34735, ())
    geo = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    code = geo.get(3072) or geo.get(2048)
    nodata = str(one(42113, "")).strip()
    return Raster(
        path, band, bands, Grid(x0, dx, y0, dy, width, height, f"EPSG:{code}" if code and code < 32767 else ""), float(nodata) if nodata else None, f"{order}{kind}{next(iter(bits)) // 8}",
        block_width, block_height, t[324 if tiled else 273], t[325 if tiled else 279], compression, predictor, one(284, 1) == 2, tiled,
    )


#: How many codes of each width follow a clear code at most: the table has 258 entries then, and widths change one early.
LZW_RUNS = ((9, 254), (10, 512), (11, 1024), (12, 1 << 30))


def lzw_decode(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, the most significant bit first, widths change one code early. Codes of one width
    are cut out all at once."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    out: list[bytes] = []
    at, fresh = 0, [bytes([k]) for k in range(256)] + [b"", b""]
    table, last, runs = fresh.copy(), None, iter(LZW_RUNS)
    width, left = next(runs)
    while at + width <= len(bits):
        n = min(left, (len(bits) - at) // width, 4096)
        codes = bits[at : at + n * width].reshape(n, width) @ (1 << np.arange(width - 1, -1, -1))
        marks = np.flatnonzero((codes == 256) | (codes == 257))
        mark = int(codes[marks[0]]) if len(marks) else 0
        part = codes[: marks[0]] if mark else codes
        for code in part.tolist():
            if last is None:
                entry = table[code]
            else:
                if code > len(table):
                    raise ValueError("broken LZW data")
                entry = table[code] if code < len(table) else last + last[:1]
                table.append(last + entry[:1])
            out.append(entry)
            last = entry
        if mark == 257:
            break
        at += (len(part) + bool(mark)) * width
        left -= len(part)
        if mark:
            table, last, runs = fresh.copy(), None, iter(LZW_RUNS)
            width, left = next(runs)
        elif not left:
            width, left = next(runs)
    return b"".join(out)


def decode_block(raster: Raster, data: bytes, height: int) -> np.ndarray:
    """(height, block width) values of the raster's band."""
    if raster.compression in (8, 32946):
        data = zlib.decompress(data)
    elif raster.compression == 5:
        data = lzw_decode(data)
    samples = 1 if raster.planar else raster.bands
    kind, row = np.dtype(raster.dtype), raster.block_width * samples
    if raster.predictor == 3:
        # bytes of a row by significance, differenced along the row
        raw = np.frombuffer(data, np.uint8, height * row * kind.itemsize).reshape(height, kind.itemsize * row)
        raw = raw.reshape(height, -1, samples).cumsum(1, dtype=np.uint8).reshape(height, kind.itemsize, row)
        values = np.ascontiguousarray(raw.transpose(0, 2, 1)).view(f">f{kind.itemsize}").reshape(height, raster.block_width, samples)
    else:
        values = np.frombuffer(data, kind, height * row).reshape(height, raster.block_width, samples)
        if raster.predictor == 2:
            values = values.astype(kind.newbyteorder("=")).cumsum(1, dtype=kind.newbyteorder("="))
    return values[:, :, 0 if raster.planar else raster.band - 1]


class _Blocks(InputPartition):
    def __init__(self, path: str, blocks: list[int]):
        self.path, self.blocks = path, blocks


class GeoTiffReader(DataSourceReader):
    def __init__(self, paths: list[str], band: int, window: tuple[int, int, int, int] | None, layout: tuple[int, int, int, int] | None = None):
        self.paths, self.band, self.window, self.layout = paths, band, window, layout

    def _layout(self, path: str) -> tuple[int, int, int, int]:
        r = open_raster(path, self.band)
        return r.grid.width, r.grid.height, r.block_width, r.block_height

    def partitions(self) -> list[InputPartition]:
        out = []
        with ThreadPoolExecutor(16) as pool:
            layouts = [self.layout] * len(self.paths) if self.layout else list(pool.map(self._layout, self.paths))
        for path, (width, height, block_width, block_height) in zip(self.paths, layouts, strict=True):
            across, down, w = -(-width // block_width), -(-height // block_height), self.window or (0, height, 0, width)
            rows = range(max(0, w[0] // block_height), min(down, -(-w[1] // block_height)))
            wanted = [y * across + x for y in rows for x in range(max(0, w[2] // block_width), min(across, -(-w[3] // block_width)))]
            each = max(1, BLOCK_PIXELS // (block_width * block_height))
            out += [_Blocks(path, wanted[k : k + each]) for k in range(0, len(wanted), each)]
        return out or [_Blocks("", [])]

    def read(self, partition: _Blocks) -> Iterator[pa.RecordBatch]:
        if not partition.blocks:
            return
        raster = open_raster(partition.path, self.band)
        g, skip = raster.grid, raster.across * raster.down * (raster.band - 1) if raster.planar else 0
        with _open(partition.path) as f:
            for k in partition.blocks:
                top, left = k // raster.across * raster.block_height, k % raster.across * raster.block_width
                rows = raster.block_height if raster.tiled else min(raster.block_height, g.height - top)  # the last strip is short
                if raster.sizes[skip + k] == 0:  # a sparse block
                    values = np.full((rows, raster.block_width), 0.0 if raster.nodata is None else raster.nodata)
                else:
                    f.seek(raster.offsets[skip + k])
                    values = decode_block(raster, f.read(raster.sizes[skip + k]), rows)
                yield strips(raster.name, values[: g.height - top, : g.width - left].astype(float), top, left)


def strips(name: str, values: np.ndarray, top: int, left: int) -> pa.RecordBatch:
    """A block as strips; cells of a strip that are not in the block are null."""
    height, width = values.shape
    first, last = left // TILE, (left + width - 1) // TILE
    whole = np.zeros((height, (last - first + 1) * TILE))
    there = np.zeros(whole.shape, bool)
    at = left - first * TILE
    whole[:, at : at + width], there[:, at : at + width] = values, True
    n = height * (last - first + 1)
    flat = pa.array(whole.ravel(), mask=~there.ravel())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * TILE, pa.int32()), flat)
    rows, tiles = np.repeat(np.arange(top, top + height), last - first + 1), np.tile(np.arange(first, last + 1), height)
    return pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(rows, pa.int32()), pa.array(tiles, pa.int32()), lists], ["raster", "row", "tile", "values"])


def _paths(options) -> list[str]:
    path = options.get("path", "")
    return [p for p in path.split(";") if p]


class GeoTiffSource(DataSource):
    """Strips of one raster or of several, their paths separated by semicolons."""

    @classmethod
    def name(cls) -> str:
        return "tessella_geotiff"

    def schema(self) -> str:
        return STRIP_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        window = self.options.get("window")
        numbers = lambda x: tuple(map(int, x.split(","))) if x else None
        return GeoTiffReader(_paths(self.options), int(self.options.get("band", 1)), numbers(window), numbers(self.options.get("layout")))


class _MetaReader(DataSourceReader):
    def __init__(self, paths: list[str], band: int):
        self.paths, self.band = paths, band

    def partitions(self) -> list[InputPartition]:
        return [_Blocks(p, []) for p in self.paths] or [_Blocks("", [])]

    def read(self, partition: _Blocks) -> Iterator[tuple]:
        if partition.path:
            r = open_raster(partition.path, self.band)
            g = r.grid
            yield (r.name, r.path, r.band, float(g.x0), float(g.dx), float(g.y0), float(g.dy), g.width, g.height, g.crs, r.nodata, r.dtype.strip("<>"), r.block_width, r.block_height)


class GeoTiffMetaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessella_geotiff_meta"

    def schema(self) -> str:
        return META_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _MetaReader(_paths(self.options), int(self.options.get("band", 1)))

