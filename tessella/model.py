"""The data model: grids, statistics and their order.

Relations used throughout:

* zones   fid bigint, <group column>, geom binary (WKB), crs string
* edges   fid bigint, ax, ay, bx, by double; the sides of a zone's rings in world coordinates
* pixels  raster string, row int, col int, value double
* strips  raster string, row int, tile int, values array<double>; the cells tile * TILE to (tile + 1) * TILE of a row
* cells   fid bigint, row int, col int; which cells a zone owns
"""

from __future__ import annotations

from dataclasses import dataclass

#: Operation names that a job may request (fixed values).
OPERATIONS = ("avg", "stdev", "min", "max", "sum", "total_count", "valid_count", "median", "p5", "p10", "p25", "p75", "p90", "p95")
#: Statistics in the order of reports (fixed values); percentiles follow, ascending.
STAT_FIELDS = ("min", "max", "count", "nodata_count", "valid_count", "sum", "stdev")
#: What a report has when no group at all was met.
BARE_FIELDS = ("min", "max", "count", "nodata_count", "sum")
TILE = 256


@dataclass(frozen=True)
class Grid:
    """A north-up (or flipped) raster without rotation: cell (row, col) begins at (x0 + col * dx, y0 + row * dy)."""

    x0: float
    dx: float
    y0: float
    dy: float
    width: int
    height: int
    crs: str = ""

    def bounds(self) -> tuple[float, float, float, float]:
        """(min x, min y, max x, max y)."""
        xs, ys = sorted((self.x0, self.x0 + self.dx * self.width)), sorted((self.y0, self.y0 + self.dy * self.height))
        return xs[0], ys[0], xs[1], ys[1]


def percentile_name(p: float) -> str:
    """p5 for 5 and 5.0, p2.5 for 2.5."""
    return f"p{int(p)}" if float(p).is_integer() else f"p{float(p)}"


def normal_percentiles(percentiles) -> list[float]:
    """Ascending and without repeats; each must lie in 0 to 100."""
    out = sorted({float(p) for p in percentiles or ()})
    if out and not 0 <= out[0] <= out[-1] <= 100:
        raise ValueError(f"percentiles must be between 0 and 100: {out}")
    return out


def percentiles_of(operations) -> list[float]:
    """The percentiles that operation names of the form p<number> ask for."""
    out = []
    for op in operations:
        if op.startswith("p"):
            try:
                out.append(float(op[1:]))
            except ValueError:
                continue
    return normal_percentiles(out)
