"""Tables in the cluster's shared folder, and catalogs, ephemerides and light curves as files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which goes when the application ends."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as Parquet in the shared folder; cuts the lineage of loops."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SOURCE_COLUMNS = ["source_id", "ra_deg", "dec_deg", "flux_mjy", "err_flux_mjy", "catalog_name"]


def catalog(spark: SparkSession, path: str, kind: str, flux_at_least_jy: float | None = None) -> DataFrame:
    """A source catalog. kind: json (lines with name, ra, dec and mJy fluxes), csv (flux Jy, ra, dec), parquet (fluxJy, raDeg, decDeg, name) or quasar (RA, DEC, NAME)."""
    if kind == "json":
        df = spark.read.json(path).select(F.col("name").alias("source_id"), F.col("ra").alias("ra_deg"), F.col("dec").alias("dec_deg"), F.col("flux").cast("double").alias("flux_mjy"), F.col("err_flux").cast("double").alias("err_flux_mjy"))
    elif kind == "csv":
        df = spark.read.option("header", True).csv(path).select(F.col("ra").cast("double").alias("ra_deg"), F.col("dec").cast("double").alias("dec_deg"), (F.col("flux").cast("double") * 1e3).alias("flux_mjy"))
        df = df.withColumns({"source_id": F.concat(F.lit("src_"), F.format_number("ra_deg", 4), F.lit("_"), F.format_number("dec_deg", 4)), "err_flux_mjy": F.lit(0.0)})
    elif kind == "quasar":
        df = spark.read.parquet(path).select(F.col("NAME").alias("source_id"), F.col("RA").alias("ra_deg"), F.col("DEC").alias("dec_deg"), F.lit(None).cast("double").alias("flux_mjy"), F.lit(None).cast("double").alias("err_flux_mjy"))
    elif kind == "parquet":
        df = spark.read.parquet(path).select(F.col("name").alias("source_id"), F.when(F.col("raDeg") < 0, F.col("raDeg") + 360.0).otherwise(F.col("raDeg")).alias("ra_deg"), F.col("decDeg").alias("dec_deg"), (F.col("fluxJy") * 1e3).alias("flux_mjy"), (F.col("err_fluxJy") * 1e3).alias("err_flux_mjy"))
    else:
        raise ValueError(f"unknown catalog kind {kind}")
    df = df.withColumn("catalog_name", F.lit(kind))
    if flux_at_least_jy is not None:
        limit = flux_at_least_jy * 1e3
        df = df.where(F.col("flux_mjy") > limit if kind == "csv" else F.col("flux_mjy") >= limit)
    return df.select(SOURCE_COLUMNS)


def ephemerides(spark: SparkSession, path: str, start_jd: float, stop_jd: float) -> DataFrame:
    """Ephemeris rows of a range of Julian days, both ends included; the range reaches the Parquet scan."""
    return spark.read.parquet(path).where(F.col("julian_day").between(start_jd, stop_jd))


def numeric_where_all(df: DataFrame) -> DataFrame:
    """Each string column as double if every value of it is a number."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    bad = df.agg(*[F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), 1)).alias(c) for c in text]).first() if text else {}
    return df.withColumns({c: F.col(c).cast("double") for c in text if bad[c] == 0})


def ephemeris_lines(lines: DataFrame, order: Column, by: str) -> DataFrame:
    """Lines between $$SOE and $$EOE of each answer (`value`, split at commas), in file order."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.sum(F.when(F.trim("value") == "$$SOE", 1).when(F.trim("value") == "$$EOE", -1).otherwise(0)).over(w)
    return lines.withColumn("_in", inside).where((F.col("_in") > 0) & (F.trim("value") != "$$SOE")).drop("_in").withColumn("fields", F.transform(F.split("value", ","), lambda x: F.trim(x)))


def write_light_curves(rows: DataFrame, path: str) -> None:
    """Text light curves with a header, in time order, one folder per source."""
    rows.repartitionByRange("source_id", "t").sortWithinPartitions("source_id", "t").write.partitionBy("source_id").option("header", True).csv(path)


def write_results(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    """Measurements by map and class."""
    rows.write.partitionBy("map_id").format(kind).save(path)


def map_files(paths: DataFrame, column: str = "path") -> DataFrame:
    """Map files by day folder, band and array, with the paths of their sibling layers."""
    from skyquarry.functions.names import file_parts

    part = file_parts(F.col(column))
    sibling = {f"{layer}_path": F.regexp_replace(F.col(column), r"_(map|ivar|rho|kappa|time)\.fits$", f"_{layer}.fits") for layer in ("map", "ivar", "rho", "kappa", "time")}
    return paths.withColumns({"folder": F.element_at(F.split(column, "/"), -2), "unix": part["unix"], "freq": part["freq"], "arr": part["arr"], "layer": part["layer"]} | sibling)


def collated_light_curves(spark: SparkSession, path: str, out: str) -> None:
    """All light-curve files under path as text, in parts ordered by file name and line, with the first header alone."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    header = lines.where(F.col("value").contains("#")).orderBy("file", "line").limit(1).withColumn("first", F.lit(0))
    rows = header.unionByName(lines.where(~F.col("value").contains("#")).withColumn("first", F.lit(1)))
    rows.orderBy("first", "file", "line").select("value").write.text(out)
