import numpy as np
import pytest

from tessella.functions.geometry import rings
from tessella.sources import geotiff, gpkg
from tests import writers


def read(spark, path, **options):
    spark.dataSource.register(geotiff.GeoTiffSource)
    reader = spark.read.format("tessella_geotiff")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path).collect()


def image(rows, shape):
    out = np.full(shape, np.nan)
    for r in rows:
        for k, v in enumerate(r["values"]):
            if v is not None:
                assert np.isnan(out[r.row, r.tile * geotiff.TILE + k])
                out[r.row, r.tile * geotiff.TILE + k] = v
    return out


CASES = [
    dict(), dict(rows=7), dict(order=">", rows=3), dict(compress=8, rows=5), dict(compress=5, rows=50), dict(tile=(16, 32)), dict(tile=(16, 16), compress=8, predictor=2), dict(compress=5, predictor=2, rows=9),
    dict(tile=(64, 16), compress=8, predictor=3), dict(big=True, rows=10), dict(big=True, order=">", tile=(32, 16), compress=5),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_geotiff_variants(tmp_path, case):
    r, options = np.random.default_rng(case), CASES[case]
    kinds = ["f4", "f8"] if options.get("predictor") == 3 else ["u1", "i2", "u2", "i4"] if options.get("predictor") == 2 else ["u1", "i2", "u4", "f4", "f8", "i8"]
    for kind in kinds:
        data = (r.integers(0, 200, (45, 70)) // r.integers(1, 60, (45, 1))).astype(kind)
        path = str(tmp_path / f"{kind}.tif")
        writers.geotiff(path, data, **options)
        reader = geotiff.GeoTiffReader([path], 1, None)
        rows = [x for p in reader.partitions() for b in reader.read(p) for x in b.to_pylist()]
        out = np.full(data.shape, np.nan)
        for x in rows:
            for k, v in enumerate(x["values"]):
                if v is not None:
                    out[x["row"], x["tile"] * geotiff.TILE + k] = v
        assert (out == data).all(), (kind, options)


def test_bands_wide_rasters_and_windows(spark, tmp_path):
    r = np.random.default_rng(1)
    a, b = (r.normal(size=(30, 600)) for _ in range(2))
    for planar in (False, True):
        path = str(tmp_path / f"p{planar}.tif")
        writers.geotiff(path, [a, b], rows=4, planar=planar)
        assert (image(read(spark, path, band=2), a.shape) == b).all()
    with pytest.raises(ValueError, match="bands"):
        geotiff.open_raster(path, 3)
    writers.geotiff(str(tmp_path / "t.tif"), a, tile=(128, 16))
    assert (image(read(spark, str(tmp_path / "t.tif")), a.shape) == a).all()
    rows = read(spark, str(tmp_path / "t.tif"), window="0,10,130,140")
    assert {x.row for x in rows} == set(range(16)) and {x.tile for x in rows} == {0}


def test_metadata(spark, tmp_path):
    path = str(tmp_path / "some.name.tif")
    writers.geotiff(path, np.zeros((4, 6), "i2"), x0=10.5, dx=0.25, y0=60.0, dy=-0.5, nodata=-9999, epsg=4326)
    spark.dataSource.register(geotiff.GeoTiffMetaSource)
    m = spark.read.format("tessella_geotiff_meta").load(path).first()
    assert (m.raster, m.band, m.x0, m.dx, m.y0, m.dy, m.width, m.height, m.crs, m.nodata, m.dtype) == ("some.name", 1, 10.5, 0.25, 60.0, -0.5, 6, 4, "EPSG:4326", -9999.0, "i2")
    (tmp_path / "no.tif").write_bytes(b"not a tiff at all")
    with pytest.raises(ValueError, match="TIFF"):
        geotiff.open_raster(str(tmp_path / "no.tif"))
    writers.geotiff(path, np.zeros((4, 6), "i2"))
    assert geotiff.open_raster(path).nodata is None and geotiff.open_raster(path).grid.crs == ""


def test_gpkg(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "z.gpkg")
    rows = [(k, writers.square(k, 0, k + 1, 1) and [writers.square(k, 0, k + 1, 1)[0:1]], f"n{k}", k * 1.5, k % 2) for k in range(1, 8)]
    rows.append((20, None, None, None, None))
    writers.gpkg(path, {"first one": (4326, [("name", "TEXT(20)"), ("size", "REAL"), ("odd", "BOOLEAN")], rows), "second": (0, [("name", "TEXT")], [])})
    spark.dataSource.register(gpkg.GpkgSource)
    df = spark.read.format("tessella_gpkg").load(path)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("fid", "bigint"), ("geom", "binary"), ("name", "string"), ("size", "double"), ("odd", "boolean")]
    got = df.orderBy("fid").collect()
    assert [(r.fid, r.name, r["size"], r.odd) for r in got] == [(k, f"n{k}", k * 1.5, k % 2 == 1) for k in range(1, 8)] + [(20, None, None, None)]
    assert rings(bytes(got[0].geom))[0].tolist() == [[1, 0], [2, 0], [2, 1], [1, 1]] and got[-1].geom is None
    assert spark.read.format("tessella_gpkg").option("layer", "second").load(path).count() == 0
    monkeypatch.setattr(gpkg, "ROWS_PER_PARTITION", 3)
    reader = gpkg.GpkgReader(path, None)
    parts = reader.partitions()
    assert len(parts) == 3 and sorted(r[0] for p in parts for r in reader.read(p)) == [*range(1, 8), 20]
    assert gpkg.layers(path) == ["first one", "second"] and gpkg.layer_crs(path) == "EPSG:4326" and gpkg.layer_crs(path, "second") == ""
    with pytest.raises(ValueError, match="no layer"):
        gpkg.resolve_layer(path, "third")
    with pytest.raises(FileNotFoundError):
        gpkg.layers(str(tmp_path / "absent.gpkg"))
