from datetime import datetime

import numpy as np
import pytest

from tessella.operators import report
from tessella.plans import config, jobs
from tests import writers
from tests.test_operators import brute_cells
from tessella.model import Grid

VALUES = np.random.default_rng(2).integers(0, 200, (20, 30)).astype("u1")
GRID = Grid(0.0, 1.0, 20.0, -1.0, 30, 20, "EPSG:3857")
SHAPES = {
    1: ([writers.square(1.2, 1.2, 9.3, 9.3)], "north", 1), 2: ([writers.square(8.2, 8.2, 20.3, 15.3)], "south", 2), 3: ([writers.square(12.1, 3.1, 12.3, 3.2)], "south", None),
    4: ([writers.square(90, 90, 95, 95)], "far", 10), 5: (None, None, 9),
}


@pytest.fixture()
def project(tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    writers.geotiff(str(tmp_path / "a/first.tif"), VALUES, y0=20.0, nodata=7, epsg=3857, tile=(16, 16), compress=8)
    writers.geotiff(str(tmp_path / "a/second.tif"), VALUES.astype("f4") / 3, y0=20.0, epsg=3857, rows=6)
    writers.geotiff(str(tmp_path / "b/coarse.tif"), VALUES[:10, :15].copy(), y0=20.0, dx=2.0, dy=-2.0, epsg=3857)
    writers.gpkg(str(tmp_path / "z.gpkg"), {"areas": (3857, [("name", "TEXT"), ("code", "INTEGER")], [(f, p, n, c) for f, (p, n, c) in SHAPES.items()])})
    text = f"""
[project]
name = world
global_work_dir = {tmp_path}/work
global_output_dir = {tmp_path}/out
[job:by_name]
agg_vector = {tmp_path}/z.gpkg
agg_field = name
base_raster_pattern = {tmp_path}/a/*.tif, {tmp_path}/b/*.tif , {tmp_path}/a/first.tif
operations = AVG, stdev, valid_count, total_count, p5, p95
row_col_order = agg_field, base_raster
[job: by_code]
agg_vector = {tmp_path}/z.gpkg
agg_layer = areas
agg_field = code
base_raster_pattern = {tmp_path}/a/*.tif,{tmp_path}/b/*.tif
operations = median
row_col_order = base_raster,agg_field
"""
    (tmp_path / "world.yml").write_text(text)
    return tmp_path, text


def expected(grid, values, group_of, nodata=None):
    out, cells = {}, brute_cells({f: (p, n) for f, (p, n, _) in SHAPES.items()}, grid)
    for f, shape in SHAPES.items():
        out.setdefault(group_of(shape), []).extend(float(values[c]) for c in cells[f])
    return {g: [x for x in v if nodata is None or x != nodata] for g, v in out.items()}, {g: len(v) for g, v in out.items()}


def test_run(spark, project):
    path, _ = project
    cfg = config.parse_config(path / "world.yml")
    assert [j.tag for j in cfg.jobs] == ["by_name", "by_code"] and len(cfg.jobs[0].base_rasters) == 3 and len(jobs.bundles(cfg.jobs)) == 1
    options = jobs.JobOptions(simplify=0.0)
    out = jobs.run_config(spark, cfg, options, datetime(2020, 1, 2, 3, 4, 5))
    assert out["by_name"] == path / "out/by_name_2020_01_02_03_04_05.csv"
    lines = [x.split(",") for x in out["by_name"].read_bytes().decode().split("\r\n")[:-1]]
    stems = ["first", "second", "coarse"]
    fields = ["min", "max", "count", "nodata_count", "valid_count", "sum", "stdev", "p5", "p95"]
    assert lines[0] == ["name", *[f"{f}_{s}" for s in stems for f in fields]]
    assert [x[0] for x in lines[1:]] == ["far", "north", "south", ""]
    got = {x[0]: dict(zip(lines[0][1:], x[1:], strict=True)) for x in lines[1:]}
    for stem, grid, values, nodata in (("first", GRID, VALUES, 7), ("second", GRID, VALUES.astype("f4") / 3, None), ("coarse", Grid(0, 2.0, 20.0, -2.0, 15, 10), VALUES[:10, :15], None)):
        want, total = expected(grid, values, lambda s: s[1] or "", nodata)
        for g, v in want.items():
            r = got[g]
            assert int(r[f"count_{stem}"]) == total[g] and int(r[f"valid_count_{stem}"]) == len(v)
            assert float(r[f"sum_{stem}"]) == pytest.approx(sum(v))
            if v:
                assert float(r[f"stdev_{stem}"]) == pytest.approx(np.std(v)) and float(r[f"p95_{stem}"]) == pytest.approx(np.percentile(v, 95))
            else:
                assert r[f"min_{stem}"] == r[f"p5_{stem}"] == ""
    lines = [x.split(",") for x in out["by_code"].read_bytes().decode().split("\r\n")[:-1]]
    assert lines[0] == ["base_raster", *[f"{f}_{g}" for g in ("1", "10", "2", "9", "") for f in fields[:7]]] and [x[0] for x in lines[1:]] == stems
    table = jobs.run_bundle(spark, [cfg.jobs[1]], jobs.JobOptions(columns="requested", simplify=0.0))["by_code"]
    assert table.columns == ["base_raster", "median_1", "median_10", "median_2", "median_9", "median_"]
    want, _ = expected(GRID, VALUES, lambda s: s[2], 7)
    assert table.first()["median_1"] == np.median(want[1])


def test_small_integers_are_counted_first(spark, project):
    path, _ = project
    (path / "world.yml").write_text((path / "world.yml").read_text().replace("a/*.tif", "a/first.tif"))
    cfg = config.parse_config(path / "world.yml")
    table = jobs.run_bundle(spark, [cfg.jobs[0]], jobs.JobOptions(simplify=0.0))["by_name"]
    assert "percentile" in table._jdf.queryExecution().optimizedPlan().toString()
    got = {r["name"]: r for r in table.collect()}
    want, total = expected(GRID, VALUES, lambda s: s[1] or "", 7)
    for g, v in want.items():
        assert got[g]["count_first"] == total[g] and got[g]["nodata_count_first"] == total[g] - len(v)
        if v:
            assert np.allclose([got[g][f"{k}_first"] for k in ("min", "max", "sum", "stdev", "p5", "p95")], [min(v), max(v), sum(v), np.std(v), *np.percentile(v, [5, 95])])


def test_percentiles_by_ranges_and_headers_in_tasks(spark, project, monkeypatch):
    """The same reports where rasters count as large, headers are read in tasks, and nothing is left in memory."""
    path, _ = project
    cfg = config.parse_config(path / "world.yml")
    usual = jobs.run_config(spark, cfg, jobs.JobOptions(simplify=0.0), datetime(2020, 1, 2, 3, 4, 5))
    monkeypatch.setattr(jobs, "HEADERS_ON_DRIVER", 0)
    large = jobs.run_config(spark, cfg, jobs.JobOptions(simplify=0.0, in_task=0), datetime(2021, 1, 2, 3, 4, 5))
    for tag in usual:
        a, b = ([x.split(",") for x in p.read_text().split("\n")] for p in (usual[tag], large[tag]))
        assert a[0] == b[0] and len(a) == len(b)
        for x, y in zip(a[1:], b[1:], strict=True):
            assert x[0] == y[0] and all(p == q or np.isclose(float(p), float(q)) for p, q in zip(x[1:], y[1:], strict=True))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    for o in (jobs.JobOptions(columns="requested", simplify=0.0), jobs.JobOptions(columns="requested", simplify=0.0, in_task=0)):
        shared = jobs.Shared()
        table = jobs.run_bundle(spark, [cfg.jobs[1]], o, shared)["by_code"]
        assert table.columns[:2] == ["base_raster", "median_1"] and [round(r["median_1"], 6) for r in table.collect()][0] == np.median(expected(GRID, VALUES, lambda s: s[2], 7)[0][1])
        shared.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    args = (str(path / "a/second.tif"), str(path / "z.gpkg"), "code")
    one, two = (jobs.as_dict(jobs.raster_statistics(spark, *args, percentiles=(5, 50), options=jobs.JobOptions(simplify=0.0, in_task=n))) for n in (10**9, 0))
    assert list(one[1]) == list(two[1]) and all(one[g][k] == two[g][k] or np.isclose(one[g][k], two[g][k]) for g in one for k in one[g])


def test_reprojected_zones(spark, project):
    path, _ = project
    from tessella.functions.geometry import transformer

    back = transformer(3857, 4326)
    moved = {f: (None if p is None else [[[tuple(q) for q in back(np.array(r)).tolist()] for r in poly] for poly in p], n, c) for f, (p, n, c) in SHAPES.items()}
    writers.gpkg(str(path / "ll.gpkg"), {"areas": (4326, [("name", "TEXT")], [(f, p, n) for f, (p, n, _) in moved.items()])})
    (path / "world.yml").write_text((path / "world.yml").read_text().replace("z.gpkg", "ll.gpkg").split("[job: by_code]")[0])
    job = config.parse_config(path / "world.yml").jobs[0]
    rows = {r["name"]: r for r in jobs.run_bundle(spark, [job], jobs.JobOptions(simplify=0.0))["by_name"].collect()}
    _, total = expected(GRID, VALUES, lambda s: s[1] or "")
    assert {g: r["count_first"] for g, r in rows.items()} == total


def test_one_raster(spark, project):
    path, _ = project
    args = (str(path / "a/first.tif"), str(path / "z.gpkg"), "code")
    for overlap, name in ((True, "all"), (False, "last")):
        got = jobs.as_dict(jobs.raster_statistics(spark, *args, percentiles=(5, 2.5), polygons_might_overlap=overlap, options=jobs.JobOptions(simplify=0.0)))
        cells = brute_cells({f: (p, n) for f, (p, n, _) in SHAPES.items()}, GRID, name)
        assert set(got) == {1, 2, None, 10, 9}
        for f, (_, _, code) in SHAPES.items():
            v = np.array([float(VALUES[c]) for c in cells[f]])
            assert list(got[code]) == ["min", "max", "count", "nodata_count", "valid_count", "sum", "stdev", "p2.5", "p5"]
            assert got[code]["count"] == len(v) and got[code]["sum"] == v[v != 7].sum()
    with pytest.raises(ValueError, match="no field"):
        jobs.raster_statistics(spark, *args[:2], "absent")


BROKEN = [
    ("[project]", "[projekt]", ValueError, "no \\[project\\]"), ("name = world", "name = other", ValueError, "file is named"), ("name = world", "name = world\nlog_level = LOUD", ValueError, "log_level"),
    ("global_work_dir", "work_dir", ValueError, "global_work_dir"), ("global_output_dir", "output_dir", ValueError, "global_output_dir"), ("[job: by_code]", "[job: by_name]", ValueError, "used twice"), ("[job: by_code]", "[job:by_name]", Exception, "already exists"),
    ("[job: by_code]", "[job: ]", ValueError, "no tag"), ("z.gpkg", "absent.gpkg", FileNotFoundError, "agg_vector"), ("agg_field = name", "agg_field = nome", ValueError, "no field"), ("agg_field = name", "", ValueError, "agg_field is missing"),
    ("agg_layer = areas", "agg_layer = lakes", ValueError, "no layer"), ("operations = median", "operations = ,", ValueError, "empty"), ("operations = median", "operations = count, mode", ValueError, "count, mode"), ("operations = median", "", ValueError, "operations is missing"),
    ("agg_field, base_raster", "agg_field", ValueError, "row_col_order"), ("row_col_order = base_raster,agg_field", "", ValueError, "row_col_order is missing"), ("a/*.tif, ", "a/*.png, ", None, ""), ("base_raster_pattern", "base_raster", ValueError, "base_raster_pattern"),
]


@pytest.mark.parametrize("old,new,error,said", BROKEN)
def test_broken_configs(project, old, new, error, said):
    path, text = project
    assert old in text
    (path / "world.yml").write_text(text.replace(old, new))
    if error is None:
        assert len(config.parse_config(path / "world.yml").jobs[0].base_rasters) == 2
        return
    with pytest.raises(error, match=said):
        config.parse_config(path / "world.yml")


def test_missing_files(project):
    path, text = project
    with pytest.raises(FileNotFoundError):
        config.parse_config(path / "none.yml")
    (path / "world.yml").write_text(text.replace("/a/", "/x/").replace("/b/", "/x/"))
    with pytest.raises(FileNotFoundError, match="no file matches"):
        config.parse_config(path / "world.yml")


def test_equal_stems(spark, project):
    path, text = project
    writers.geotiff(str(path / "b/first.tif"), VALUES, y0=20.0, epsg=3857)
    job = config.parse_config(path / "world.yml").jobs[0]
    with pytest.raises(ValueError, match="same name"):
        jobs.run_bundle(spark, [job])
    assert jobs.run_bundle(spark, [job], jobs.JobOptions(on_duplicate_stem="last"))["by_name"].columns[1] == "min_first"


def test_reports_to_the_byte(spark):
    rows = [("a`b", "x", 1, 2.5), ("a`b", "y.1", 3, None), (None, "x", 0, None), (None, "y.1", 7, 1.0), ("10", "x", 5, 5.5), ("10", "y.1", 6, 6.5)]
    table = spark.createDataFrame(rows, "group string, raster string, count int, sum double")
    text = report.csv_text(report.pivoted(table, "agg_field,base_raster", "name", ["x", "y.1"], ["count", "sum"]))
    assert text == "name,count_x,sum_x,count_y.1,sum_y.1\r\n10,5,5.5,6,6.5\r\na`b,1,2.5,3,\r\n,0,,7,1.0\r\n"
    text = report.csv_text(report.pivoted(table, "base_raster,agg_field", "name", ["x", "y.1"], ["count", "sum"]))
    assert text == "base_raster,count_10,sum_10,count_a`b,sum_a`b,count_,sum_\r\nx,5,5.5,1,2.5,0,\r\ny.1,6,6.5,3,,7,1.0\r\n"
    one = report.pivoted(table, "base_raster,agg_field", "name", ["y.1", "x"], ["sum"])
    assert report.csv_text(one) == "base_raster,sum_10,sum_a`b,sum_\r\ny.1,6.5,,1.0\r\nx,5.5,2.5,\r\n"
    none = table.where("false")
    assert report.csv_text(report.pivoted(none, "agg_field,base_raster", "name", ["x"], ["count", "sum"])) == "name,min_x,max_x,count_x,nodata_count_x,sum_x\r\n"
    assert report.csv_text(report.pivoted(none, "base_raster,agg_field", "name", ["x", "z"], ["count"])) == "base_raster\r\nx\r\nz\r\n"
