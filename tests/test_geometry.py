import math
import struct

import numpy as np
import pytest

from tessella.functions import geometry as g
from tests.writers import square


def test_wkb_forms():
    polygon = [square(0, 0, 4, 4)[0], square(1, 1, 2, 2)[0]]
    assert [r.tolist() for r in g.rings(g.to_wkb([polygon]))] == [[list(map(float, p)) for p in r] for r in polygon]
    assert len(g.rings(g.to_wkb([polygon, square(5, 5, 6, 6)]))) == 3
    points = [(0.0, 0.0, 9.0), (1.0, 0.0, 9.0), (1.0, 1.0, 9.0), (0.0, 0.0, 9.0)]
    for kind in (1003, 0x80000003):  # ISO and extended Z, big-endian
        b = struct.pack(">BIII", 0, kind, 1, 4) + b"".join(struct.pack(">ddd", *p) for p in points)
        assert g.rings(b)[0].tolist() == [[0, 0], [1, 0], [1, 1]]
    b = struct.pack("<BIIII", 1, 0x20000003, 4326, 1, 4) + b"".join(struct.pack("<dd", *p[:2]) for p in points)
    assert len(g.rings(b)[0]) == 3
    with pytest.raises(ValueError, match="type 1"):
        g.rings(struct.pack("<BIdd", 1, 1, 0, 0))


def test_gpkg_headers():
    wkb = g.to_wkb([square(0, 0, 1, 1)])
    assert g.strip_gpkg(wkb) == (wkb, None)
    for code, size in ((0, 0), (1, 32), (2, 48), (4, 64)):
        assert g.strip_gpkg(b"GP\0" + bytes([code << 1 | 1]) + struct.pack("<i", 4326) + bytes(size) + wkb) == (wkb, 4326)
    assert g.strip_gpkg(b"GP\0" + bytes([17]) + struct.pack("<i", 4326) + wkb)[0] is None


def test_envelope():
    assert g.envelope(g.to_wkb([square(0, 1, 2, 3), square(5, -1, 6, 0)])) == (0, -1, 6, 3)


def test_simplify():
    t = np.linspace(0, 2 * np.pi, 400, endpoint=False)
    ring = np.column_stack([np.cos(t), np.sin(t)])
    out = g.simplified(ring, 0.01)
    assert 10 < len(out) < 60 and np.abs(np.hypot(*out.T) - 1).max() < 1e-9
    for p in ring:  # every point stays within the tolerance of the new outline
        a, b = out, np.roll(out, -1, 0)
        s = np.clip(((p - a) * (b - a)).sum(1) / ((b - a) ** 2).sum(1), 0, 1)
        assert np.hypot(*(a + s[:, None] * (b - a) - p).T).min() <= 0.0101
    flat = np.array([[0, 0], [1, 0.001], [2, 0], [2, 2], [0, 2.0]])
    assert len(g.simplified(flat, 0.01)) == 4 and len(g.simplified(flat, 0)) == 5


def test_codes():
    assert g.epsg("EPSG:4326") == g.epsg(4326) == g.epsg('GEOGCS["WGS 84",DATUM["x",AUTHORITY["EPSG","6326"]],AUTHORITY["EPSG","4326"]]') == 4326
    assert g.epsg("") is None and g.same_crs("EPSG:3857", "epsg:3857") and not g.same_crs("EPSG:3857", 4326)


def test_projections():
    points = np.array([[15.0, 0.0], [16.3, 48.2], [12.1, -33.9], [17.9, 71.0]])
    x = g.transformer(4326, "EPSG:3857")(points)
    assert np.allclose(x[0], [1669792.36, 0], atol=0.01)
    assert np.allclose(x[1], [16.3 * math.pi / 180 * g.R, math.asinh(math.tan(math.radians(48.2))) * g.R])
    # a quarter of a meridian (10 001 965.729 m) times the scale of the central meridian
    pole = g.transformer(4326, 32633)(np.array([[15.0, 90.0], [15.0, 0.0]]))
    assert np.allclose(pole, [[500000, 9997964.943], [500000, 0]], atol=0.01)
    for code in (3857, 32633, 32733):
        back = g.transformer(code, 4326)(g.transformer(4326, code)(points))
        assert np.abs(back - points).max() < 1e-7
    # conformal: the scale is the same in both directions
    e = 1e-5
    f = g.transformer(4326, 32633)
    p = np.array([[17.0, 50.0], [17.0 + e, 50.0], [17.0, 50.0 + e]])
    q = f(p)
    n = g.R / math.sqrt(1 - g.F_WGS84 * (2 - g.F_WGS84) * math.sin(math.radians(50)) ** 2)
    m = n**3 / g.R**2 * (1 - g.F_WGS84 * (2 - g.F_WGS84))
    kx, ky = np.hypot(*(q[1] - q[0])) / (math.radians(e) * n * math.cos(math.radians(50))), np.hypot(*(q[2] - q[0])) / (math.radians(e) * m)
    assert abs(kx - ky) < 1e-5 and 0.9996 < kx < 1.0003
    assert g.transformer(4326, "EPSG:4326") is None
    with pytest.raises(ValueError, match="EPSG:2154"):
        g.transformer(4326, 2154)
    with pytest.raises(ValueError, match="codes are needed"):
        g.transformer("", 4326)
