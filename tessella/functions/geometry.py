"""Geometry without libraries: WKB, edges, envelopes, simplification, projections.

Geometries arrive as WKB (polygons and multipolygons, with or without Z, M or an EWKB SRID; GeoPackage headers are
skipped). DataFrames get them as `edges`, by one Arrow pass over the zones, which are few beside pixels.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Ring = np.ndarray
EDGE_SCHEMA = "fid bigint, ax double, ay double, bx double, by double"


# ---------------------------------------------------------------- WKB


def strip_gpkg(blob: bytes) -> tuple[bytes | None, int | None]:
    """(WKB, srs id) of a GeoPackage geometry; WKB is None for an empty one. Plain WKB passes through."""
    if blob[:2] != b"GP":
        return blob, None
    flags = blob[3]
    srs = struct.unpack("<i" if flags & 1 else ">i", blob[4:8])[0]
    size = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}.get(flags >> 1 & 7)
    if size is None:
        raise ValueError("unknown envelope in a GeoPackage geometry")
    return (None if flags & 16 else blob[8 + size :]), srs


def rings(wkb: bytes) -> list[Ring]:
    """All rings of a polygon or multipolygon as (n, 2) arrays, holes among them."""
    out: list[Ring] = []
    if _read(wkb, 0, out) > len(wkb):
        raise ValueError("the WKB ends too early")
    return out


def _read(b: bytes, at: int, out: list[Ring]) -> int:
    order = "<" if b[at] == 1 else ">"
    kind = struct.unpack_from(order + "I", b, at + 1)[0]
    at += 5
    dims = 2
    if kind & 0xE0000000:  # EWKB
        dims += bool(kind & 0x80000000) + bool(kind & 0x40000000)
        at += 4 * bool(kind & 0x20000000)
        kind &= 0x0FFFFFFF
    dims += {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
    kind %= 1000
    if kind not in (3, 6, 7):
        raise ValueError(f"not a polygon: WKB type {kind}")
    n = struct.unpack_from(order + "I", b, at)[0]
    at += 4
    for _ in range(n):
        if kind != 3:
            at = _read(b, at, out)
            continue
        points = struct.unpack_from(order + "I", b, at)[0]
        ring = np.frombuffer(b, order + "f8", points * dims, at + 4).reshape(points, dims)[:, :2].astype(float)
        at += 4 + 8 * points * dims
        out.append(ring[:-1] if points > 1 and (ring[0] == ring[-1]).all() else ring)
    return at


def to_wkb(polygons: list[list[list[tuple[float, float]]]]) -> bytes:
    """A multipolygon (polygons of rings of points), or a polygon if there is one."""

    def polygon(parts) -> bytes:
        body = struct.pack("<BII", 1, 3, len(parts))
        for r in parts:
            r = [*r, r[0]]
            body += struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r)
        return body

    return polygon(polygons[0]) if len(polygons) == 1 else struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(polygon, polygons))


def envelope(wkb: bytes) -> tuple[float, float, float, float] | None:
    points = [r for r in rings(wkb) if len(r)]
    if not points:
        return None
    p = np.concatenate(points)
    return (*p.min(0).tolist(), *p.max(0).tolist())


# ---------------------------------------------------------------- simplification


def simplified(ring: Ring, tolerance: float) -> Ring:
    """Douglas and Peucker (1973) on a closed ring, without recursion; at least three points stay."""
    if len(ring) < 4 or tolerance <= 0:
        return ring
    far = int(((ring - ring[0]) ** 2).sum(1).argmax())
    line = np.concatenate([ring, ring[:1]])
    keep = np.zeros(len(line), bool)
    keep[[0, far, len(line) - 1]] = True
    todo = [(0, far), (far, len(line) - 1)]
    while todo:
        a, z = todo.pop()
        if z - a < 2:
            continue
        along, rel = line[z] - line[a], line[a + 1 : z] - line[a]
        length = math.hypot(*along)
        off = np.abs(along[0] * rel[:, 1] - along[1] * rel[:, 0]) / length if length else np.hypot(rel[:, 0], rel[:, 1])
        k = int(off.argmax())
        if off[k] > tolerance:
            k += a + 1
            keep[k] = True
            todo += [(a, k), (k, z)]
    out = line[keep][:-1]
    return out if len(out) >= 3 else ring


# ---------------------------------------------------------------- projections

R = 6378137.0
F_WGS84 = 1 / 298.257223563


def epsg(crs: str | int | None) -> int | None:
    """The EPSG code in "EPSG:4326", 4326 or the outermost authority of a WKT; None if there is none."""
    import re

    if crs is None or crs == "":
        return None
    if isinstance(crs, int) or str(crs).strip().lstrip("-").isdigit():
        return int(crs)
    found = re.findall(r"(?i)EPSG\W+(\d+)", str(crs))
    return int(found[-1]) if found else None


def same_crs(a, b) -> bool:
    ea, eb = epsg(a), epsg(b)
    return ea == eb if ea is not None and eb is not None else "".join(str(a).split()) == "".join(str(b).split())


def _mercator(lon, lat):
    return np.radians(lon) * R, R * np.log(np.tan(np.pi / 4 + np.radians(np.clip(lat, -89.99, 89.99)) / 2))


def _mercator_back(x, y):
    return np.degrees(x / R), np.degrees(2 * np.arctan(np.exp(y / R)) - np.pi / 2)


def _series() -> tuple[float, list[float], list[float]]:
    """Krüger's series to the third order: the rectifying radius, alphas forward and betas back."""
    n = F_WGS84 / (2 - F_WGS84)
    return R / (1 + n) * (1 + n**2 / 4 + n**4 / 64), [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240], [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]


def _utm(zone: int, south: bool):
    a, alpha, beta = _series()
    e = math.sqrt(F_WGS84 * (2 - F_WGS84))
    lon0, north = math.radians(zone * 6 - 183), 1e7 if south else 0.0

    def forward(lon, lat):
        lam, s = np.radians(lon) - lon0, np.sin(np.radians(lat))
        with np.errstate(divide="ignore"):  # a pole's conformal latitude is infinite
            t = np.sinh(np.arctanh(s) - e * np.arctanh(e * s))
        xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
        x = eta + sum(c * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, c in enumerate(alpha, 1))
        y = xi + sum(c * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, c in enumerate(alpha, 1))
        return 500000 + 0.9996 * a * x, north + 0.9996 * a * y

    def back(x, y):
        xi, eta = (y - north) / (0.9996 * a), (x - 500000) / (0.9996 * a)
        xi, eta = xi - sum(c * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, c in enumerate(beta, 1)), eta - sum(c * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, c in enumerate(beta, 1))
        t = np.sin(xi) / np.sqrt(np.sinh(eta) ** 2 + np.cos(xi) ** 2)  # tan of the conformal latitude
        s = t / np.sqrt(1 + t * t)
        lat = np.arcsin(s)
        for _ in range(6):
            lat = np.arcsin(np.tanh(np.arctanh(s) + e * np.arctanh(e * np.sin(lat))))
        return np.degrees(lon0 + np.arctan2(np.sinh(eta), np.cos(xi))), np.degrees(lat)

    return forward, back


def _pair(code: int):
    if code == 4326:
        return (lambda x, y: (x, y),) * 2
    if code in (3857, 900913):
        return _mercator, _mercator_back
    if 32601 <= code <= 32660 or 32701 <= code <= 32760:
        return _utm(code % 100, code >= 32701)
    raise ValueError(f"no projection for EPSG:{code}; geographic (4326), web Mercator (3857) and UTM (326zz, 327zz) are known")


def transformer(source, target) -> Callable[[Ring], Ring] | None:
    """From one reference system to another, x before y; None if they are the same."""
    if same_crs(source, target):
        return None
    a, b = epsg(source), epsg(target)
    if a is None or b is None:
        raise ValueError(f"cannot project from {source or 'an unnamed system'!r} to {target or 'an unnamed system'!r}: EPSG codes are needed")
    (_, back), (forward, _) = _pair(a), _pair(b)

    def move(ring: Ring) -> Ring:
        return np.column_stack(forward(*back(ring[:, 0], ring[:, 1])))

    return move


# ---------------------------------------------------------------- DataFrames


def edges_of(zones: DataFrame, target_crs: str | None = None, source_crs: str | None = None, tolerance: float | None = None) -> DataFrame:
    """edges of zones (fid, geom): projected to target_crs if it differs, then simplified by a tolerance in its units.

    Null and empty geometries have no edges, so such zones own nothing and get no bounding box.
    """
    move = transformer(source_crs, target_crs) if target_crs is not None and source_crs is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fids, parts = [], []
            for fid, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                wkb = strip_gpkg(g)[0] if g else None
                for ring in rings(wkb) if wkb else ():
                    ring = move(ring) if move else ring
                    ring = simplified(ring, tolerance) if tolerance else ring
                    parts.append(np.column_stack([ring, np.roll(ring, -1, 0)]))
                    fids += [fid] * len(ring)
            rows = np.concatenate(parts) if parts else np.empty((0, 4))
            yield pa.RecordBatch.from_arrays([pa.array(fids, pa.int64()), *(pa.array(rows[:, k]) for k in range(4))], ["fid", "ax", "ay", "bx", "by"])

    return zones.selectExpr("cast(fid as bigint) fid", "geom").mapInArrow(run, EDGE_SCHEMA)
