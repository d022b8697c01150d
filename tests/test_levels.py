import duckdb
import numpy as np

from skyquarry.operators import kernels, levels
from skyquarry.plans import domain_queries as d
from skyquarry.plans.views import duck

NEXT = [(y, x) for y in (-1, 0, 1) for x in (-1, 0, 1) if y or x]


def parts(pixels):
    """8-connected parts of a set of pixels."""
    left, out = set(pixels), []
    while left:
        todo = [left.pop()]
        part = set(todo)
        while todo:
            y, x = todo.pop()
            for dy, dx in NEXT:
                if (y + dy, x + dx) in left:
                    left.remove((y + dy, x + dx))
                    part.add((y + dy, x + dx))
                    todo.append((y + dy, x + dx))
        out.append(part)
    return out


def brute(image, n_levels=32, contrast=1e-3, at_least=2):
    """label by pixel of {(y, x): value}, by plain recursion over the tree."""
    out = {}
    for region in parts(image):
        v = {p: image[p] for p in region}
        low, high, flux = min(v.values()), max(v.values()), sum(v.values())
        if low == high:
            at = [low] * n_levels
        else:
            at = [low * (high / low) ** (k / (n_levels + 1)) if low > 0 else low + (high - low) * k / (n_levels + 1) for k in range(1, n_levels + 1)]
        at = [-np.inf, *at]
        holds = lambda part: len(part) >= at_least and sum(v[p] for p in part) >= contrast * flux
        peak = lambda part: max(part, key=lambda p: (v[p], -p[0], -p[1]))

        def grown(part, k):
            """Sources over a component of level k, each with the levels at which its components lie."""
            if k == n_levels:
                return None
            above = [c for c in parts([p for p in part if v[p] > at[k + 1]]) if holds(c)]
            if not above:
                return None
            if len(above) == 1:
                return grown(above[0], k + 1)
            return [s for c in above for s in (grown(c, k + 1) or [c])]

        found = grown(region, 0)
        if found is None:
            out |= dict.fromkeys(region, peak(region))
            continue
        for p in region:
            q = p
            while (up := peak([n for n in [q, *((q[0] + y, q[1] + x) for y, x in NEXT)] if n in v])) != q:
                q = up
            own = [s for s in found if q in s]
            if not own:
                for k in range(n_levels, -1, -1):
                    comp = next((c for c in parts([x for x in region if v[x] > at[k]]) if q in c), set())
                    own = [s for s in found if s <= comp]
                    if own:
                        break
            tops = [peak(s) for s in own]
            out[p] = min(tops, key=lambda t: ((t[0] - q[0]) ** 2 + (t[1] - q[1]) ** 2, t))
    return {p: f"{t[0]}_{t[1]}" for p, t in out.items()}


def gaussians(ny, nx, *sources):
    yy, xx = np.mgrid[:ny, :nx]
    return sum(a * np.exp(-((yy - y) ** 2 + (xx - x) ** 2) / (2 * s * s)) for a, y, x, s in sources)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    images = {
        "two": gaussians(24, 40, (10, 12, 13, 3), (6, 12, 22, 3)),
        "noisy": gaussians(24, 40, (10, 12, 20, 5)) * (1 + 0.06 * rng.normal(size=(24, 40))),
        "plateau": np.full((4, 5), 2.0),
        "empty": np.zeros((4, 5)),
    }
    images |= {f"m{k}": np.round(gaussians(18, 22, *[(rng.uniform(1, 9), *rng.uniform(2, 17, 2), rng.uniform(1, 3)) for _ in range(6)]) + 0.3 * rng.random((18, 22)), 2) for k in range(3)}
    kept = {m: {(y, x): float(v[y, x]) for y, x in np.argwhere(v > 0.05).tolist()} for m, v in images.items()}
    # under zero, in even steps
    under = gaussians(12, 20, (5, 6, 5, 2), (4, 6, 13, 2)) + 0.01
    kept["under"] = {(y, x): float(under[y, x]) - 0.02 for y in range(12) for x in range(20)}
    rows = spark.createDataFrame([(m, y, x, v) for m, image in kept.items() for (y, x), v in image.items()], "map_id string, gy int, gx int, v double")
    got = {m: {} for m in kept}
    for r in levels.level_deblended(rows, "v", contrast=0.05).collect():
        assert (r["gy"], r["gx"]) not in got[r["map_id"]]
        got[r["map_id"]][r["gy"], r["gx"]] = r["label"]
    for m, image in kept.items():
        assert got[m] == brute(image, contrast=0.05), m
    assert set(got["two"].values()) == {"12_13", "12_22"} and set(got["under"].values()) == {"6_5", "6_13"}
    # noise peaks on one source are no sources
    assert len(set(got["noisy"].values())) == 1
    assert len({r["label"] for r in kernels.deblended(rows.where("map_id = 'noisy'"), "v").collect()}) >= 2


def test_the_query_equals_brute_force(spark, small):
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from '{small}/lineitem.parquet'")
    rows = db.execute(duck("pixels_raw") + "select freq, gy, gx, sum(rho) / sum(kappa) as v from pixels_raw group by all having sum(rho) / sum(kappa) > 5e-1").fetchall()
    want = []
    for band in {r[0] for r in rows}:
        image = {(y, x): v for f, y, x, v in rows if f == band}
        label = brute(image, contrast=0.02)
        for name in set(label.values()):
            part = [p for p, n in label.items() if n == name]
            if len(part) >= 2:
                want.append((band, name, len(part)))
    got = [(r["band"], r["label"], r["n_pixels"]) for r in d.segment_levels(spark, small).collect()]
    assert got and sorted(got) == sorted(want)
