"""Array kernels in numpy, and the grouped Spark operators that apply them to stamps and map tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIGMA_TO_FWHM = 2.0 * np.sqrt(2.0 * np.log(2.0))
FIT_COLUMNS = "amplitude double, x0 double, y0 double, sigma_x double, sigma_y double, theta double, offset double, err_amplitude double, fwhm_x double, fwhm_y double, chi2 double, reduced_chi2 double, r2 double, failed boolean, reason string"


def gaussian(p: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    a, x0, y0, sx, sy, th, off = p
    u = (x - x0) * np.cos(th) + (y - y0) * np.sin(th)
    v = -(x - x0) * np.sin(th) + (y - y0) * np.cos(th)
    return off + a * np.exp(-0.5 * ((u / sx) ** 2 + (v / sy) ** 2))


def _jacobian(p: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    a, x0, y0, sx, sy, th, _ = p
    c, s = np.cos(th), np.sin(th)
    u, v = (x - x0) * c + (y - y0) * s, -(x - x0) * s + (y - y0) * c
    e = np.exp(-0.5 * ((u / sx) ** 2 + (v / sy) ** 2))
    f = a * e
    return np.column_stack([e, f * (u * c / sx**2 - v * s / sy**2), f * (u * s / sx**2 + v * c / sy**2), f * u**2 / sx**3, f * v**2 / sy**3, -f * u * v * (1 / sx**2 - 1 / sy**2), np.ones_like(x)])


def fit_gaussian(image: np.ndarray, noise: float = 1.0, centre: tuple[float, float] | None = None, allow: float | None = None, fwhm: float = 4.0, rounds: int = 100) -> dict:
    """Levenberg-Marquardt fit of a rotated Gaussian over an offset; the centre stays within `allow` pixels, 0 freezes it."""
    ny, nx = image.shape
    y, x = (v.ravel().astype(float) for v in np.mgrid[:ny, :nx])
    z = image.ravel().astype(float)
    empty = dict.fromkeys((c.split()[0] for c in FIT_COLUMNS.split(", ")), None)
    if not np.isfinite(z).all():
        return empty | {"failed": True, "reason": "flux_thumb_has_nan"}
    cx, cy = centre or ((nx - 1) / 2, (ny - 1) / 2)
    allow = max(nx, ny) / 2 if allow is None else allow
    low = np.array([-np.inf, cx - allow, cy - allow, 0.3, 0.3, 0.0, -np.inf])
    high = np.array([np.inf, cx + allow, cy + allow, nx, ny, np.pi, np.inf])
    off = float(np.median(z))
    near = z[np.argmin((x - cx) ** 2 + (y - cy) ** 2)]
    p = np.array([near - off or 1e-12, cx, cy, fwhm / SIGMA_TO_FWHM, fwhm / SIGMA_TO_FWHM * 1.01, 0.1, off])
    free = np.array([True, allow > 0, allow > 0, True, True, True, True])
    cost, damp = float(((z - gaussian(p, x, y)) ** 2).sum()), 1e-3
    for _ in range(rounds):
        j, r = _jacobian(p, x, y), z - gaussian(p, x, y)
        # what stands at a bound and would go beyond it does not take part in a step
        slope = j.T @ r
        go = free & ~((p <= low) & (slope < 0)) & ~((p >= high) & (slope > 0))
        go[5] = True  # an angle has no bounds
        j = j[:, go]
        h = j.T @ j
        try:
            step = np.linalg.solve(h + damp * np.diag(np.maximum(np.diag(h), 1e-12)), j.T @ r)
        except np.linalg.LinAlgError:
            return empty | {"failed": True, "reason": "singular"}
        new = p.copy()
        new[go] += step
        new[5] %= np.pi
        new = np.clip(new, low, high)
        new_cost = float(((z - gaussian(new, x, y)) ** 2).sum())
        if new_cost < cost:
            done = cost - new_cost < 1e-10 * max(cost, 1e-30)
            p, cost, damp = new, new_cost, damp / 5
            if done:
                break
        else:
            damp *= 5
            if damp > 1e12:
                break
    j = _jacobian(p, x, y)[:, free]
    dof = max(1, len(z) - int(free.sum()))
    cov = np.linalg.pinv(j.T @ j) * cost / dof
    total = float(((z - z.mean()) ** 2).sum())
    return {"amplitude": p[0], "x0": p[1], "y0": p[2], "sigma_x": p[3], "sigma_y": p[4], "theta": p[5], "offset": p[6], "err_amplitude": float(np.sqrt(max(0.0, cov[0, 0]))), "fwhm_x": SIGMA_TO_FWHM * p[3], "fwhm_y": SIGMA_TO_FWHM * p[4], "chi2": cost / noise**2, "reduced_chi2": cost / noise**2 / dof, "r2": 1 - cost / total if total else 0.0, "failed": False, "reason": None}


def fitted(stamps: DataFrame, key: str = "stamp_id", image: str = "image", ny: int = 8, nx: int = 8, fwhm: float = 4.0, allow: float | None = None) -> DataFrame:
    """One fit per stamp (key, image as an array of ny * nx values by row). Null or wrongly sized stamps fail with a reason."""
    kind = stamps.schema[key].dataType.simpleString()

    def kernel(it):
        for pdf in it:
            rows = []
            for v in pdf[image]:
                if v is None or len(v) != ny * nx:
                    rows.append(dict.fromkeys((c.split()[0] for c in FIT_COLUMNS.split(", ")), None) | {"failed": True, "reason": "extract_thumbnail_failed"})
                else:
                    rows.append(fit_gaussian(np.asarray(v, float).reshape(ny, nx), fwhm=fwhm, allow=allow))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in FIT_COLUMNS.split(", ")])
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return stamps.select(key, image).mapInPandas(kernel, f"{key} {kind}, {FIT_COLUMNS}")


def labelled(rows: DataFrame, diagonal: bool = True) -> DataFrame:
    """(map_id, gy, gx, label) of the 8-connected (or, without diagonals, 4-connected) regions of given pixels, whatever their extent: each named by its least pixel.

    Runs of a row are found by a window; runs that touch in neighbouring rows are edges, and regions their connected sets.
    """
    from skyquarry.operators.groups import connected

    line = Window.partitionBy("map_id", "gy").orderBy("gx")
    runs = rows.select("map_id", "gy", "gx").distinct().withColumn("_run", F.col("gx") - F.row_number().over(line))
    runs = runs.groupBy("map_id", "gy", "_run").agg(F.min("gx").alias("x0"), F.max("gx").alias("x1"))
    runs = runs.withColumn("run_id", F.xxhash64(F.col("map_id").cast("string"), "gy", "x0"))
    # a run meets those of the next row in the 64-pixel cells that both reach
    cells = F.explode(F.sequence(F.floor((F.col("x0") - 1) / 64), F.floor((F.col("x1") + 1) / 64)))
    a = runs.select("map_id", "gy", F.col("x0").alias("ax0"), F.col("x1").alias("ax1"), F.col("run_id").alias("i"), cells.alias("cell"))
    b = runs.select("map_id", (F.col("gy") - 1).alias("gy"), F.col("x0").alias("bx0"), F.col("x1").alias("bx1"), F.col("run_id").alias("j"), cells.alias("cell"))
    touch = a.join(b, ["map_id", "gy", "cell"]).where((F.col("bx0") <= F.col("ax1") + int(diagonal)) & (F.col("bx1") >= F.col("ax0") - int(diagonal))).select("i", "j").distinct()
    sets = connected(touch)
    named = runs.join(sets, runs.run_id == sets.node, "left").withColumn("set", F.coalesce("root", "run_id"))
    first = named.groupBy("map_id", "set").agg(F.min(F.struct("gy", "x0")).alias("first"))
    pixels = named.join(first, ["map_id", "set"]).withColumn("gx", F.explode(F.sequence("x0", "x1")))
    return pixels.select("map_id", "gy", F.col("gx").cast("int").alias("gx"), F.concat_ws("_", F.col("first.gy"), F.col("first.x0")).alias("label"))


def deblended(rows: DataFrame, value: str, rounds: int = 60) -> DataFrame:
    """(map_id, gy, gx, label) of given pixels: each belongs to the peak that the steepest way up leads to, over its eight neighbours.

    Every pixel points to the greatest of its neighbourhood, of equal ones the first by row and column; ways halve in
    every round, each a table in the shared folder.
    """
    from skyquarry.sources.tables import saved

    steps = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in (-1, 0, 1) for x in (-1, 0, 1)])
    best = F.struct(F.col(value).alias("v"), (-F.col("gy")).alias("y"), (-F.col("gx")).alias("x")).alias("o")
    seen = rows.select("map_id", best, "gy", "gx", F.explode(steps).alias("d")).select("map_id", (F.col("gy") + F.col("d.y")).cast("int").alias("gy"), (F.col("gx") + F.col("d.x")).cast("int").alias("gx"), "o")
    up = rows.select("map_id", "gy", "gx").join(seen, ["map_id", "gy", "gx"]).groupBy("map_id", "gy", "gx").agg(F.max("o").alias("o"))
    now = saved(up.select("map_id", "gy", "gx", (-F.col("o.y")).cast("int").alias("py"), (-F.col("o.x")).cast("int").alias("px")), "ways")
    for _ in range(rounds):
        far = now.select("map_id", F.col("gy").alias("py"), F.col("gx").alias("px"), F.col("py").alias("qy"), F.col("px").alias("qx"))
        new = saved(now.join(far, ["map_id", "py", "px"]).select("map_id", "gy", "gx", F.col("qy").alias("py"), F.col("qx").alias("px"), ((F.col("qy") != F.col("py")) | (F.col("qx") != F.col("px"))).alias("moved")), "ways")
        now = new.drop("moved")
        if not new.where("moved").limit(1).count():
            return now.select("map_id", "gy", "gx", F.concat_ws("_", "py", "px").alias("label"))
    raise RuntimeError("ways did not end")


def regions(pixels: DataFrame, value: str, threshold: float, at_least: int = 2, deblend: bool = False, contrast: float | None = None) -> DataFrame:
    """Connected regions over the threshold with their peak, centroid, second moments, width, elongation and orientation.

    With deblend they are cut into the parts around their peaks, with contrast into the branches of at least that share
    of a region's sum (levels.level_deblended).
    """
    from skyquarry.operators.levels import level_deblended
    from skyquarry.sources.tables import saved

    over = saved(pixels.where((F.col(value) > threshold) & ~F.isnan(value)), "over")
    if contrast is not None:
        label = level_deblended(over, value, contrast=contrast, at_least=at_least)
    else:
        label = deblended(over, value) if deblend else labelled(over)
    marked = over.join(label, ["map_id", "gy", "gx"])
    w = F.col(value)
    s = marked.groupBy("map_id", "label").agg(F.count("*").alias("n_pixels"), F.max(w).alias("peak"), F.sum(w).alias("sum"), F.sum(w * F.col("gx")).alias("sx"), F.sum(w * F.col("gy")).alias("sy"), F.sum(w * F.col("gx") * F.col("gx")).alias("sxx"), F.sum(w * F.col("gy") * F.col("gy")).alias("syy"), F.sum(w * F.col("gx") * F.col("gy")).alias("sxy"))
    s = s.where((F.col("n_pixels") >= at_least) & (F.col("sum") > 0)).withColumns({"x": F.col("sx") / F.col("sum"), "y": F.col("sy") / F.col("sum")})
    s = s.withColumns({"mxx": F.col("sxx") / F.col("sum") - F.col("x") * F.col("x"), "myy": F.col("syy") / F.col("sum") - F.col("y") * F.col("y"), "mxy": F.col("sxy") / F.col("sum") - F.col("x") * F.col("y")})
    mean, diff = (F.col("mxx") + F.col("myy")) / 2, (F.col("mxx") - F.col("myy")) / 2
    root = F.sqrt(diff * diff + F.col("mxy") * F.col("mxy"))
    major, minor = F.sqrt(F.greatest(mean + root, F.lit(0.0))), F.sqrt(F.greatest(mean - root, F.lit(0.0)))
    return s.select("map_id", "label", "n_pixels", "peak", "x", "y", major.alias("sigma_major"), minor.alias("sigma_minor"), (0.5 * F.atan2(2 * F.col("mxy"), F.col("mxx") - F.col("myy"))).alias("theta"), F.when(major > 0, 1 - minor / major).alias("ellipticity"), (F.sqrt((major * major + minor * minor) / 2) * float(SIGMA_TO_FWHM)).alias("fwhm"))


def window_splines(x: np.ndarray, y: np.ndarray, at: np.ndarray, window: float, least: int = 4, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts) at each of `at` of the cubic splines with not-a-knot ends through all points within window of it.

    x ascends without repeats; y has a column for each curve. Fewer than `least` points give NaN. The systems have three
    diagonals and are solved for many windows at once, of at most `most` points together with their padding.
    """
    first, last = np.searchsorted(x, at - window, "left"), np.searchsorted(x, at + window, "right")
    count = last - first
    out = np.full((len(at), y.shape[1]), np.nan)
    todo = np.flatnonzero(count >= max(4, least))
    todo = todo[np.argsort(count[todo], kind="stable")]
    while len(todo):
        part = todo[-max(1, most // int(count[todo[-1]])) :]
        todo = todo[: len(todo) - len(part)]
        n, m = count[part], int(count[part].max())
        index = first[part][:, None] + np.minimum(np.arange(m), n[:, None] - 1)
        px, py = x[index] - at[part][:, None], y[index]
        h = np.diff(px, axis=1)
        d = np.diff(py, axis=1) / np.where(h > 0, h, 1)[:, :, None]
        # slopes: diag * s[j] + upper * s[j + 1] = right, from the first row on
        upper, right = np.zeros((len(part), m)), np.zeros((len(part), m, y.shape[1]))
        wide = h[:, 0] + h[:, 1]
        upper[:, 0] = wide / h[:, 1]
        right[:, 0] = (((h[:, 0] + 2 * wide) * h[:, 1])[:, None] * d[:, 0] + (h[:, 0] ** 2)[:, None] * d[:, 1]) / (wide * h[:, 1])[:, None]
        for j in range(1, m):
            a, b = h[:, j - 1], h[:, j] if j < m - 1 else h[:, j - 1]
            low, diag, up, r = b, 2 * (a + b), a, 3 * (b[:, None] * d[:, j - 1] + a[:, None] * (d[:, j] if j < m - 1 else d[:, j - 1]))
            end = n - 1 == j
            if end.any():
                c = h[:, j - 2] if j > 1 else a
                both = a + c
                low, diag, up = np.where(end, both, low), np.where(end, c, diag), np.where(end, 0, up)
                tail = ((a**2)[:, None] * (d[:, j - 2] if j > 1 else d[:, 0]) + ((2 * both + a) * c)[:, None] * d[:, j - 1]) / np.where(end, both, 1)[:, None]
                r = np.where(end[:, None], tail, r)
            beyond = n - 1 < j
            pivot = np.where(beyond, 1, diag - low * upper[:, j - 1])
            upper[:, j] = np.where(beyond, 0, up / pivot)
            right[:, j] = np.where(beyond[:, None], 0, (r - low[:, None] * right[:, j - 1]) / pivot[:, None])
        for j in range(m - 2, -1, -1):
            right[:, j] -= np.where(n - 1 > j, upper[:, j], 0)[:, None] * right[:, j + 1]
        i = np.clip((px < 0).sum(1) - 1, 0, n - 2)
        k = np.arange(len(part))
        step = h[k, i]
        t = (-px[k, i] / step)[:, None]
        y0, y1, s0, s1, step = py[k, i], py[k, i + 1], right[k, i], right[k, i + 1], step[:, None]
        out[part] = (1 + 2 * t) * (1 - t) ** 2 * y0 + t * (1 - t) ** 2 * step * s0 + t * t * (3 - 2 * t) * y1 + t * t * (t - 1) * step * s1
    return out, count


def interpolated(asks: DataFrame, ephemerides: DataFrame, window_days: float, least: int = 4) -> DataFrame:
    """asks (ask_id, designation, target_jd) with the object's spline position through all rows of the window; null with fewer than `least` of them.

    Asks without a row in their window are left out; of rows of one time the least (RA, declination) counts. Distinct
    targets meet the rows of their object within ranges as wide as the window, so that a group holds an object's rows of
    three windows, each of them once.
    """
    asks = asks.withColumn("target_jd", F.col("target_jd").cast("double"))
    bucket = lambda c: F.floor(c / window_days).cast("long")
    targets = asks.select("designation", "target_jd").where("target_jd is not null").distinct().withColumn("_b", bucket(F.col("target_jd")))
    here = bucket(F.col("julian_day"))
    rows = ephemerides.where("julian_day is not null and ra_deg is not null and dec_deg is not null").select("designation", F.col("julian_day").cast("double").alias("julian_day"), "ra_deg", "dec_deg", F.explode(F.sequence(here - 1, here + 1)).alias("_b"))
    # ranges without a target need no rows
    rows = rows.join(targets.select("designation", "_b").distinct(), ["designation", "_b"], "left_semi")
    kind = asks.schema["designation"].dataType.simpleString()

    def splines(key: tuple, ask: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        row = row.sort_values(["julian_day", "ra_deg", "dec_deg"]).drop_duplicates("julian_day")
        ra = np.degrees(np.unwrap(np.radians(row["ra_deg"].to_numpy(float))))
        at = ask["target_jd"].to_numpy()
        found, n = window_splines(row["julian_day"].to_numpy(), np.column_stack([ra, row["dec_deg"].to_numpy(float)]), at, window_days, least)
        out = pd.DataFrame({"designation": key[0], "target_jd": at, "ra_deg": found[:, 0] % 360, "dec_deg": found[:, 1], "n_points": n})
        return out[out["n_points"] > 0]

    met = targets.groupBy("designation", "_b").cogroup(rows.groupBy("designation", "_b"))
    found = met.applyInPandas(splines, f"designation {kind}, target_jd double, ra_deg double, dec_deg double, n_points int")
    return asks.select("ask_id", "designation", "target_jd").join(found, ["designation", "target_jd"]).select("ask_id", "designation", "target_jd", "ra_deg", "dec_deg", "n_points")


def polynomial_pointing(sources: DataFrame, order: int, snr_at_least: float = 5.0, sigma: float = 3.0, rounds: int = 3, by: str = "map_id") -> DataFrame:
    """Offsets as polynomials of position per map: clipped in each axis, both kept, weights min(snr, 100).

    The normal equations are sums, so that a map's sources are aggregated by Spark and only they are solved.
    """
    from skyquarry.operators.maps import clip_marks

    good = sources.where(F.col("snr") >= snr_at_least)
    good = clip_marks(good, {"_ra": "offset_ra", "_dec": "offset_dec"}, [by], sigma, rounds).where("_ra and _dec")
    # powers of centred and scaled positions: raw degrees would lose most digits of the sums
    over = Window.partitionBy(by)
    for c in ("ra_deg", "dec_deg"):
        good = good.withColumns({f"_m_{c}": F.avg(c).over(over), f"_s_{c}": F.greatest(F.coalesce(F.stddev_pop(c).over(over), F.lit(0.0)), F.lit(1e-9))})
    u, v = ((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") for c in ("ra_deg", "dec_deg"))
    terms = [(i, j) for i in range(order + 1) for j in range(order + 1 - i)]
    base = [F.pow(u, F.lit(float(i))) * F.pow(v, F.lit(float(j))) for i, j in terms]
    w = F.least(F.col("snr").cast("double"), F.lit(100.0))
    w = w * w
    n = len(terms)
    sums = [F.sum(w * base[a] * base[b]).alias(f"m_{a}_{b}") for a in range(n) for b in range(a, n)]
    sums += [F.sum(w * base[a] * F.col(c)).alias(f"v_{c}_{a}") for a in range(n) for c in ("offset_ra", "offset_dec")]
    sums += [F.first(f"_{k}_{c}").alias(f"{k}_{c}") for k in "ms" for c in ("ra_deg", "dec_deg")]
    sums = good.groupBy(by).agg(F.count("*").alias("n_sources"), *sums)

    def solve(it):
        from math import comb

        for pdf in it:
            rows = []
            for r in pdf.to_dict("records"):
                m = np.array([[r[f"m_{min(a, b)}_{max(a, b)}"] for b in range(n)] for a in range(n)])
                # what each scaled term is in powers of degrees
                raw = np.zeros((n, n))
                for a, (i, j) in enumerate(terms):
                    for b, (k, l) in enumerate(terms):
                        if k <= i and l <= j:
                            x = comb(i, k) * (-r["m_ra_deg"]) ** (i - k) / r["s_ra_deg"] ** i
                            raw[b, a] = x * comb(j, l) * (-r["m_dec_deg"]) ** (j - l) / r["s_dec_deg"] ** j
                rows.append([(raw @ np.linalg.lstsq(m, np.array([r[f"v_{c}_{a}"] for a in range(n)]), rcond=None)[0]).tolist() for c in ("offset_ra", "offset_dec")])
            yield pd.DataFrame({by: pdf[by], "n_sources": pdf["n_sources"], "ra_coef": [r[0] for r in rows], "dec_coef": [r[1] for r in rows]})

    return sums.mapInPandas(solve, f"{by} {sources.schema[by].dataType.simpleString()}, n_sources long, ra_coef array<double>, dec_coef array<double>")


def ramps(n: int, block: int, overlap: int) -> list[tuple[int, int, np.ndarray]]:
    """Overlapping ranges (start, end, weight): ramps of neighbours add to 1 in an overlap of at most half a block."""
    overlap = min(overlap, block // 2)
    out, start = [], 0
    while start < n:
        end = min(n, start + block)
        if n - end < overlap:
            end = n
        w = np.ones(end - start)
        up = (np.arange(overlap) + 1) / (overlap + 1)
        if start:
            w[:overlap] = up[: len(w[:overlap])]
        if end < n:
            w[len(w) - overlap :] = 1 - up
        out.append((start, end, w))
        if end == n:
            break
        start = end - overlap
    return out


def noise_weight(image: np.ndarray, ivar: np.ndarray, down: tuple[int, int]) -> np.ndarray:
    """The inverse of a patch's own noise spectrum, smoothed over blocks of `down` frequencies."""
    white = np.nan_to_num(image) * np.sqrt(np.maximum(np.nan_to_num(ivar), 0))
    power = np.abs(np.fft.fft2(white)) ** 2 / max(1, np.count_nonzero(white))
    for axis, size in enumerate(down):
        n = power.shape[axis]
        block = np.arange(n) // max(1, size)
        sums = np.apply_along_axis(lambda v, block=block: np.bincount(block, v), axis, power)
        shape = [1, 1]
        shape[axis] = -1
        power = np.take(sums / np.bincount(block).reshape(shape), block, axis)
    return 1 / np.maximum(power, 1e-300)


def matched_filter(image: np.ndarray, ivar: np.ndarray, fwhm_pix: float, knee: float = 0.02, alpha: float = -3.0, measured: tuple[int, int] | None = None, apod: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(rho, kappa) of a patch: signal weighted by the beam over the noise.

    The noise is of one level with a low-frequency rise, or, with measured, the patch's own spectrum, smoothed over
    blocks of that many frequencies. apod pixels at the patch's edge lose their weight gradually. Pixels that are not
    finite or have no weight are holes of weight 0.
    """
    ny, nx = image.shape
    sigma = fwhm_pix / SIGMA_TO_FWHM
    ky, kx = np.meshgrid(np.fft.fftfreq(ny), np.fft.fftfreq(nx), indexing="ij")
    k = np.hypot(ky, kx)
    beam = np.exp(-2 * (np.pi * sigma * k) ** 2)
    ivar = np.where(np.isfinite(image) & np.isfinite(ivar), np.maximum(np.nan_to_num(ivar), 0), 0)
    if apod:
        ramp = lambda n: np.minimum(1, 0.5 - 0.5 * np.cos(np.pi * np.minimum(apod, np.minimum(np.arange(n), np.arange(n)[::-1]) + 0.5) / apod))
        ivar = ivar * ramp(ny)[:, None] * ramp(nx)[None, :]
    weight = 1 / (1 + (np.maximum(k, 0.5 / max(ny, nx)) / knee) ** alpha) if measured is None else noise_weight(image, ivar, measured)
    root = np.sqrt(ivar)
    filt = lambda v: np.fft.ifft2(np.fft.fft2(v) * beam * weight).real
    rho = root * filt(root * np.nan_to_num(image))
    norm = float((beam**2 * weight).mean())
    return rho, root**2 * norm


def filtered(pixels: DataFrame, nx: int, ny: int, fwhm_pix: float, block: int = 512, overlap: int = 64, image: str = "flux", ivar: str = "kappa", measured: tuple[int, int] | None = None, apod: int = 0) -> DataFrame:
    """Matched-filtered maps (rho, kappa) by bands of rows with halos, merged by weights that add to 1. A task holds one band."""
    bands = ramps(ny, block, overlap)
    cut = F.array(*[F.struct(F.lit(i).alias("band"), F.lit(s).alias("y0"), F.lit(e).alias("y1")) for i, (s, e, _) in enumerate(bands)])
    spread = pixels.withColumn("_b", F.explode(F.filter(cut, lambda b: (F.col("gy") >= b["y0"]) & (F.col("gy") < b["y1"]))))
    kind = pixels.schema["map_id"].dataType.simpleString()

    def run(g: pd.DataFrame) -> pd.DataFrame:
        s, e, w = bands[int(g["band"].iloc[0])]
        img, iv = np.zeros((e - s, nx)), np.zeros((e - s, nx))
        y, x = g["gy"].to_numpy() - s, g["gx"].to_numpy()
        img[y, x], iv[y, x] = g["v"].to_numpy(), g["w"].to_numpy()
        rho, kappa = matched_filter(img, iv, fwhm_pix, measured=measured, apod=apod)
        yy, xx = np.mgrid[: e - s, :nx]
        return pd.DataFrame({"map_id": g["map_id"].iloc[0], "gy": (yy + s).ravel().astype("int32"), "gx": xx.ravel().astype("int32"), "rho": (rho * w[:, None]).ravel(), "kappa": (kappa * w[:, None]).ravel()})

    parts = spread.select("map_id", F.col("_b.band").alias("band"), "gy", "gx", F.col(image).cast("double").alias("v"), F.col(ivar).cast("double").alias("w"))
    done = parts.groupBy("map_id", "band").applyInPandas(run, f"map_id {kind}, gy int, gx int, rho double, kappa double")
    return done.groupBy("map_id", "gy", "gx").agg(F.sum("rho").alias("rho"), F.sum("kappa").alias("kappa"))
