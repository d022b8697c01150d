import io
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.sources import fits

KEYS = {"CRVAL1": 10.0, "CRPIX1": 51.0, "CDELT1": -0.5, "CRVAL2": 0.0, "CRPIX2": 101.0, "CDELT2": 0.5, "BUNIT": "K"}


class Counted(io.BytesIO):
    def __init__(self, content):
        super().__init__(content)
        self.bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        self.bytes += len(out)
        return out


def image(ny=200, nx=120):
    return np.arange(ny * nx, dtype=float).reshape(ny, nx)


def pixels_of(reader, content, start=0, end=None):
    file = Counted(content)
    batches = list(reader.pixels(file, fits.Range("x", start, len(content) if end is None else end)))
    rows = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
    return rows, file.bytes


def test_a_box_reads_its_own_bytes_alone():
    data = image()
    content = fits.encoded(data, KEYS)
    rows, read = pixels_of(fits.FitsReader({"path": "x", "box": "50,60,10,20"}), content)
    assert sorted(rows) == [(y, x, data[y, x]) for y in range(50, 60) for x in range(10, 20)]
    assert read == fits.BLOCK + 8 * 100
    # rows at declinations -1 to 1 (96..104), columns at right ascensions 5 to 15 (40..60)
    rows, read = pixels_of(fits.FitsReader({"path": "x", "sky": "-1,1,5,15"}), content)
    assert sorted(rows) == [(y, x, data[y, x]) for y in range(98, 103) for x in range(40, 61)]
    assert read == fits.BLOCK + 8 * 5 * 21
    assert pixels_of(fits.FitsReader({"path": "x", "sky": "-1,1,200,210"}), content) == ([], fits.BLOCK)
    head = Counted(content)
    assert fits.HeaderReader({"path": "x"}).row("x", head)[1:3] == (200, 120) and head.bytes == fits.BLOCK


def test_a_sky_box_across_zero_hours():
    content = fits.encoded(image(4, 720), {"CRVAL1": 180.0, "CRPIX1": 361.0, "CDELT1": -0.5, "CRVAL2": 0.0, "CRPIX2": 1.0, "CDELT2": 1.0})
    rows, _ = pixels_of(fits.FitsReader({"path": "x", "sky": "0,0,359,1"}), content)
    assert sorted({r[1] for r in rows}) == [0, 1, 2, 718, 719]


def test_ranges_of_bytes_share_the_rows():
    data = image(37, 11)
    content = fits.encoded(data, KEYS | {"HISTORY1": "x" * 20})
    for size in (100, 3000, 10_000):
        rows = [r for at in range(0, len(content), size) for r in pixels_of(fits.FitsReader({"path": "x"}), content, at, min(len(content), at + size))[0]]
        assert sorted(rows) == [(y, x, data[y, x]) for y in range(37) for x in range(11)]


def test_other_types_planes_and_long_headers():
    cube = np.arange(2 * 3 * 4).reshape(2, 3, 4)
    text = "".join(f"{k:<8}= {v:>20}{'':<50}" for k, v in ({"SIMPLE": "T", "BITPIX": 16, "NAXIS": 3, "NAXIS1": 4, "NAXIS2": 3, "NAXIS3": 2, "BSCALE": 2.0, "BZERO": 1.0, "BLANK": 5} | {f"K{i}": i for i in range(70)}).items()) + f"{'END':<80}"
    content = text.encode() + b" " * (-len(text) % fits.BLOCK) + cube.astype(">i2").tobytes()
    rows, _ = pixels_of(fits.FitsReader({"path": "x", "plane": "1"}), content)
    assert sorted(rows) == [(y, x, 2.0 * cube[1, y, x] + 1) for y in range(3) for x in range(4)]
    rows, _ = pixels_of(fits.FitsReader({"path": "x"}), content)
    assert [r[2] for r in sorted(rows)][4:7] == [9.0, pytest.approx(float("nan"), nan_ok=True), 13.0]
    with pytest.raises(ValueError, match="planes"):
        pixels_of(fits.FitsReader({"path": "x", "plane": "2"}), content)
    with pytest.raises(ValueError, match="END"):
        pixels_of(fits.FitsReader({"path": "x"}), content[:2880])


def test_the_source_splits_files_and_takes_filters(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"m{i}.fits").write_bytes(fits.encoded(image() + i, KEYS))
    (tmp_path / "other.txt").write_text("no image")
    every = fits.source(spark).option("split", 40_000).option("positions", True).load(str(tmp_path))
    assert every.rdd.getNumPartitions() == 15 and every.count() == 3 * 200 * 120
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        part = fits.source(spark).option("positions", True).load(str(tmp_path)).where("gy >= 10 and gy < 12 and gx = 7 and dec_deg < 100")
        assert part.count() == 6
        reader = fits.FilteringReader({"path": "x"})
        filters = [fits.GreaterThanOrEqual(("gy",), 10), fits.LessThan(("gy",), 12), fits.EqualTo(("gx",), 7)]
        assert list(reader.pushFilters(filters)) == filters
        assert pixels_of(reader, fits.encoded(image(), KEYS))[1] == fits.BLOCK + 3 * 8
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    row = every.where("gy = 100 and gx = 50 and path like '%m1.fits'").first()
    assert (row["ra_deg"], row["dec_deg"], row["value"]) == (10.0, 0.0, image()[100, 50] + 1)


def test_units_are_checked(spark, tmp_path):
    (tmp_path / "m.fits").write_bytes(fits.encoded(image(3, 4), KEYS))
    assert fits.read_pixels(spark, str(tmp_path), unit="temperature").count() == 12
    assert fits.read_headers(spark, str(tmp_path), unit="temperature").first()["unit"] == "K"
    for read in (fits.read_pixels, fits.read_headers):
        with pytest.raises(Exception, match="no unit of a flux"):
            read(spark, str(tmp_path), unit="flux").collect()
    with pytest.raises(Exception, match="no unit of a flux"):
        fits.read_map(spark, {"rho": str(tmp_path / "m.fits")}, units={"rho": "flux"}).collect()


def test_written_by_several_tasks_and_read_back(spark, tmp_path):
    data = {m: np.random.default_rng(m).normal(size=(90, 40)) for m in (1, 2)}
    rows = [(m, y, x, float(v[y, x]), float(-v[y, x])) for m, v in data.items() for y in range(90) for x in range(40) if (y, x) != (3, 4)]
    pixels = spark.createDataFrame(rows, "map_id long, gy int, gx int, rho double, kappa double").repartition(7)
    out = str(tmp_path / "out")
    fits.write_maps(pixels, ["rho", "kappa"], 90, 40, out, KEYS, band=10)
    assert sorted(os.listdir(out)) == ["1_kappa.fits", "1_rho.fits", "2_kappa.fits", "2_rho.fits"]
    assert all(os.path.getsize(f"{out}/{f}") % fits.BLOCK == 0 for f in os.listdir(out))
    for m, v in data.items():
        want = v.copy()
        want[3, 4] = 0
        got = np.zeros((90, 40))
        for r in fits.read_pixels(spark, f"{out}/{m}_rho.fits").collect():
            got[r["gy"], r["gx"]] = r["value"]
        assert (got == want).all()
    assert fits.read_headers(spark, out).where("crval_ra = 10 and unit = 'K' and ny = 90").count() == 4
    # any order of rows does, and a file of the same name is replaced
    fits.FitsSource.name()
    pixels.where("map_id = 1").selectExpr("map_id", "gy", "gx", "rho * 2 as rho").write.format("sky_fits").mode("append").options(ny=90, nx=40).save(out)
    again = fits.read_pixels(spark, f"{out}/1_rho.fits").agg(F.sum("value")).first()[0]
    assert again == pytest.approx(2 * (data[1].sum() - data[1][3, 4]))


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    rows = spark.createDataFrame([(1, y, x, 1.0) for y in range(20) for x in range(5)], "map_id long, gy int, gx int, v double")
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="outside the image"):
        fits.write_maps(rows, ["v"], 19, 5, out, band=1)
    assert os.listdir(out) == []
    with pytest.raises(Exception, match="shared file system"):
        fits.write_maps(rows, ["v"], 20, 5, "s3://bucket/out")
