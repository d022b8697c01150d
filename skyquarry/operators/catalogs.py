"""Catalogs and their records: cuts, selections, conversions and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquarry.functions import names
from skyquarry.operators.joins import zone_join


def model_cuts(models: DataFrame, cuts: dict[str, tuple[float, float]], failed: str = "fit_failed") -> DataFrame:
    """Models that did not fail and whose values all lie within their cut's range, ends included; null and NaN are cut. An unknown name raises."""
    unknown = [name for name in cuts if name not in models.columns]
    if unknown:
        raise ValueError(f"no column {unknown[0]} to cut on")
    keep = ~F.coalesce(F.col(failed), F.lit(False))
    for name, (low, high) in cuts.items():
        v = F.col(name).cast("double")
        keep = keep & F.coalesce(~F.isnan(v) & (v >= low) & (v <= high), F.lit(False))
    return models.where(keep)


def star_candidates(pairs: DataFrame, faintest: float, widest: Column | float, mag: str = "mag", parallax: str = "parallax", sep: str = "sep", needs_parallax: bool = True) -> DataFrame:
    """Pairs with a star brighter than `faintest`, nearer than `widest` and, if needed, of a finite parallax."""
    p = F.col(parallax).cast("double")
    finite = F.coalesce(~F.isnan(p) & (F.abs(p) < F.lit(float("inf"))), F.lit(False)) if needs_parallax else F.lit(True)
    return pairs.where((F.col(mag) < faintest) & finite & (F.col(sep) < widest))


def nearest_rows(pairs: DataFrame, key: str, tie: str, most: int) -> DataFrame:
    """At most `most` partners of each key, by separation, with their rank."""
    w = Window.partitionBy(key).orderBy("sep", tie)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def matched_or_null(rows: DataFrame, catalog: DataFrame, radius: float, key: str, name: str) -> DataFrame:
    """Every row, with the name and separation of its closest partner within radius degrees, null where there is none."""
    best = nearest_rows(zone_join(rows, catalog, radius), key, name, 1).select(key, name, "sep")
    return rows.join(best, key, "left")


def by_id(asks: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Every asked id with the first catalog row of it (by all columns), null columns where there is none."""
    first = catalog.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in catalog.columns if c != key])).alias("_row"))
    return asks.join(first, key, "left").select(*[F.col(c) for c in asks.columns], "_row.*")


def prefix_fraction(rows: DataFrame, fraction: float, by: str, order: str) -> DataFrame:
    """The first int(n * fraction) rows of each set."""
    w = Window.partitionBy(by)
    return rows.withColumns({"_i": F.row_number().over(w.orderBy(order)), "_n": F.count("*").over(w)}).where(F.col("_i") <= F.floor(F.col("_n") * fraction)).drop("_i", "_n")


def random_rows(rows: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows in the order of a hash of seed and key: a repeatable random sample without replacement."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))), key).limit(n)


def ecdf(rows: DataFrame, value: str, by: str) -> DataFrame:
    """rows with the share of their set's values that are not greater."""
    return rows.withColumn("ecdf", F.cume_dist().over(Window.partitionBy(by).orderBy(value)))


def orbital_table(fluxes: DataFrame, orbits: DataFrame, flux_at_least: float) -> DataFrame:
    """The orbits of bright minor planets: fluxes (name, flux) over the least one, without comets (C...) and unnumbered objects ((...),
    by the normalised name; of several orbits of a designation that of the least orbit_id, and none without a semimajor axis."""
    name = F.col("name")
    bright = fluxes.where((F.col("flux") > flux_at_least) & ~name.startswith("C") & ~name.startswith("(")).select(names.asteroid_name(name).alias("designation")).distinct()
    columns = [c for c in orbits.columns if c not in ("designation", "orbit_id")]
    first = orbits.where("semimajor_axis is not null").groupBy("designation").agg(F.min(F.struct("orbit_id", *columns)).alias("_row"))
    return bright.join(first, "designation").select("designation", "_row.*")


def registered(catalog: DataFrame, seed: str = "source") -> DataFrame:
    """Catalog rows (name, ra_deg, dec_deg, flux, offset, err_offset) as sources: RA in [0, 360), an id by hash, offsets' errors where
    there is an offset, and a crossmatch with itself of probability 1."""
    key = F.sha2(F.concat_ws("-", F.lit(seed), F.col("name").cast("string")), 256)
    offset = F.coalesce(F.col("offset"), F.lit(0)) != 0
    out = catalog.withColumn("source_id", key).withColumn("ra_deg", F.pmod(F.col("ra_deg"), F.lit(360.0)))
    out = out.withColumn("err", F.when(offset, F.col("err_offset")))
    return out.select("name", "source_id", "ra_deg", "dec_deg", "flux", "err", F.array(F.struct(F.col("source_id").alias("match_id"), F.lit(1.0).alias("probability"))).alias("crossmatches"))


def measured(detections: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Detections (peak, significance) as measurements: flux is the peak, its error the peak over the significance; other columns are renamed."""
    out = detections.withColumns({"flux": F.col("peak").cast("double"), "err_flux": F.try_divide(F.col("peak").cast("double"), F.col("significance").cast("double"))})
    return out.withColumnsRenamed(renamed)


def forced_table(positions: DataFrame, pixels: DataFrame, value: str = "flux") -> DataFrame:
    """Fitted positions (map_id, id, flux, ...) as a catalog: name, flux, forced, and the deviation of their whole map as the error of all."""
    noise = pixels.groupBy("map_id").agg(F.stddev_pop(value).alias("err_flux"))
    return positions.join(noise, "map_id").withColumns({"name": F.col("id").cast("string"), "forced": F.lit(1)}).drop("id")
