"""Processing state and light-curve tables: claims, upserts and id translation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: What happens to a map: one row for every start and end of its processing, which are only ever added.
EVENTS = "map_id string, status string, processing_start double, processing_end double, at double"


def current(events: DataFrame) -> DataFrame:
    """The state of each map: its last event's; of one moment an end comes after a start."""
    last = F.max(F.struct("at", (F.col("status") == "completed").alias("done"), "status", "processing_start", "processing_end")).alias("e")
    return events.groupBy("map_id").agg(last).select("map_id", "e.status", "e.processing_start", "e.processing_end")


def starts(maps: DataFrame, now: float) -> DataFrame:
    """Events that claim maps: whoever asks for maps within the lease does not get them."""
    return maps.select(F.col("map_id").cast("string").alias("map_id"), F.lit("processing").alias("status"), F.lit(float(now)).alias("processing_start"), F.lit(None).cast("double").alias("processing_end"), F.lit(float(now)).alias("at"))


def ends(events: DataFrame, maps: DataFrame, now: float) -> DataFrame:
    """Events that end maps; one that was never started raises."""
    began = maps.select(F.col("map_id").cast("string").alias("map_id")).join(current(events).select("map_id", "processing_start"), "map_id", "left")
    start = F.when(F.col("processing_start").isNull(), F.raise_error(F.concat(F.lit("never started: "), "map_id")).cast("double")).otherwise(F.col("processing_start"))
    return began.select("map_id", F.lit("completed").alias("status"), start.alias("processing_start"), F.lit(float(now)).alias("processing_end"), F.lit(float(now)).alias("at"))


def unclaimed(maps: DataFrame, status: DataFrame, now: float, stale_s: float = 7200.0) -> DataFrame:
    """Maps that are neither completed nor being processed since less than the lease."""
    busy = status.where((F.col("status") == "completed") | ((F.col("status") == "processing") & (F.lit(now) - F.col("processing_start") < stale_s))).select("map_id")
    return maps.join(busy, "map_id", "left_anti")


def next_maps(maps: DataFrame, status: DataFrame, now: float, days: float | None = 1.0, most: int | None = None, rerun: bool = False, models: DataFrame | None = None, refit: bool = False) -> DataFrame:
    """The maps to process, in the order of their start: those of the last `days` that are not processed (all with rerun), at most `most`.

    models (map_id, and columns of a pointing model) are attached where one is kept, so that only maps without one are
    fitted; refit leaves them out. No days means any time.
    """
    found = maps if days is None else maps.where(F.col("obs_end") >= now - days * 86400.0)
    if not rerun:
        found = unclaimed(found, status, now)
    if most is not None:
        found = found.orderBy("obs_start", "map_id").limit(most)
    if models is None:
        return found
    return found.join(models.where(F.lit(not refit)), "map_id", "left")


def query_maps(maps: DataFrame, freq: str | None = None, arr: str | None = None, start: float | None = None, end: float | None = None, map_ids: DataFrame | None = None, tiles: DataFrame | None = None, coverage: DataFrame | None = None) -> DataFrame:
    """Maps by band, array, overlap of the observation with [start, end], id and sky tile; a map counts once however many tiles it covers."""
    for name, value in (("freq", freq), ("arr", arr)):
        if value is not None:
            maps = maps.where(F.col(name) == value)
    if start is not None:
        maps = maps.where(F.col("obs_end") >= start)
    if end is not None:
        maps = maps.where(F.col("obs_start") <= end)
    if map_ids is not None:
        maps = maps.join(map_ids, "map_id", "left_semi")
    if tiles is not None and coverage is not None:
        maps = maps.join(coverage.join(tiles, tiles.columns, "left_semi").select("map_id"), "map_id", "left_semi")
    return maps


def upserted(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """table with rows in place of those of the same key; of several rows of a key the last of their columns' order counts."""
    last = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in rows.columns if c != key]))).where("_n = 1").drop("_n")
    return table.join(last.select(key), key, "left_anti").unionByName(last, allowMissingColumns=True)


def ended(status: DataFrame, done: DataFrame, now: float) -> DataFrame:
    """status with the maps of done completed; one that never started raises."""
    missing = done.join(status, "map_id", "left").withColumn("_ok", F.when(F.col("processing_start").isNull(), F.raise_error(F.concat(F.lit("never started: "), F.col("map_id").cast("string"))).cast("double")).otherwise(F.col("processing_start")))
    rows = missing.select("map_id", F.lit("completed").alias("status"), F.col("_ok").alias("processing_start"), F.lit(now).alias("processing_end"))
    return upserted(status, rows, "map_id")


def translated(fluxes: DataFrame, known: DataFrame, key: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """(fluxes with their internal id, sources to create). New ids are hashes, so that a rerun gives the same."""
    new = fluxes.select(key).distinct().join(known.select(key), key, "left_anti").withColumn("internal_id", F.sha2(F.concat(F.lit("source-"), F.col(key).cast("string")), 256))
    both = known.select(key, F.col("internal_id").cast("string").alias("internal_id")).unionByName(new)
    return fluxes.join(both, key), new


def light_curve_rows(measured: DataFrame) -> DataFrame:
    """Rows as stored: null flux and errors are 0, and the time is the pixel's or else the map's."""
    zero = F.lit(0.0)
    return measured.withColumns({"flux_mjy": F.coalesce("flux_mjy", zero), "err_flux_mjy": F.coalesce("err_flux_mjy", zero), "t": F.coalesce("t_mean", "map_time")})
