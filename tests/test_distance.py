import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.operators import distance, maps


def brute(ny, nx, seeds):
    yy, xx = np.mgrid[:ny, :nx]
    return np.sqrt(np.min([(yy - y) ** 2 + (xx - x) ** 2 for y, x in seeds], axis=0)) if seeds else np.full((ny, nx), np.inf)


@pytest.mark.parametrize("share", [0.0, 0.01, 0.2, 1.0])
def test_envelope_is_the_least_over_all_columns(share):
    rng = np.random.default_rng(int(share * 100))
    g2 = np.where(rng.random((40, 70)) < share, rng.integers(0, 30, (40, 70)) ** 2, np.inf)
    x = np.arange(70)
    want = np.min((x[:, None] - x[None, :]) ** 2 + g2[:, None, :], axis=2)
    assert (distance.envelope(g2) == want).all()


def test_distances_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    shapes = {1: (150, 40, 12), 2: (9, 130, 1), 3: (20, 20, 0), 4: (70, 3, 60)}
    seeds = {m: [(int(a), int(b)) for a, b in zip(rng.integers(0, ny, n), rng.integers(0, nx, n), strict=True)] for m, (ny, nx, n) in shapes.items()}
    grid = spark.createDataFrame([(m, y, x) for m, (ny, nx, _) in shapes.items() for y in range(ny) for x in range(nx) if (y * 7 + x) % 5], "map_id long, gy int, gx int")
    marks = spark.createDataFrame([(m, y, x) for m, s in seeds.items() for y, x in s] + [(9, 1, 1)], "map_id long, gy int, gx int")
    want = {m: brute(*shapes[m][:2], seeds[m]) for m in shapes}
    for radius in (None, 0, 3.5, 60):
        got = distance.with_distance(grid, marks, radius).collect()
        assert len(got) == grid.count()
        for r in got:
            d = want[r["map_id"]][r["gy"], r["gx"]]
            near = np.isfinite(d) and (radius is None or d <= radius)
            assert r["distance"] == pytest.approx(d) if near else r["distance"] is None
    for radius in (0, 3, 4, 60):  # as discs and by the transform
        hits = maps.near_any(grid, marks, radius).where("hit").count()
        assert hits == sum((want[r["map_id"]][r["gy"], r["gx"]] <= radius) for r in grid.collect())
    box = {(r["map_id"], r["gy"], r["gx"]) for r in maps.near_any(grid, marks, 2, box=True).where("hit").collect()}
    assert box == {(r["map_id"], r["gy"], r["gx"]) for r in grid.collect() if any(max(abs(y - r["gy"]), abs(x - r["gx"])) <= 2 for y, x in seeds[r["map_id"]])}


def test_rows_do_not_grow_with_the_radius(spark):
    grid = spark.range(400).selectExpr("1L as map_id", "cast(id / 20 as int) as gy", "cast(id % 20 as int) as gx")
    plan = distance.nearest_seed(grid, grid.where("gx = gy"), 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and distance.nearest_seed(grid, grid.where("gx = gy"), 10_000).count() == 400
    assert distance.nearest_seed(grid, grid.where(F.lit(False))).count() == 0
