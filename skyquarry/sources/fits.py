"""FITS images as a Spark data source: pixel rows from images, and images from pixel rows; primary HDU only.

Reading splits files by byte ranges, as the listing gives their sizes: a task reads the header's blocks, and of its range
only the rows and columns that are asked for, by seeks. Writing puts pixels at their fixed places of a file that gets its
header and its name when all tasks have ended.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

BLOCK = 2880
_TYPES = {8: "u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
PIXELS = "path string, gy int, gx int, value double"
POSITIONS = ", ra_deg double, dec_deg double"
HEADERS = "path string, ny int, nx int, crval_ra double, crpix_x double, cdelt_ra double, crval_dec double, crpix_y double, cdelt_dec double, unit string, res_deg double"
#: Bytes of a file that a task reads, pixels of a batch, headers of a task.
SPLIT, PIXELS_AT_ONCE, HEADERS_AT_ONCE = 64 << 20, 200_000, 256
#: Units by what they measure.
UNITS = {"temperature": ("K", "mK", "uK"), "flux": ("Jy", "mJy", "uJy", "Jy/sr")}


def checked_unit(unit: str | None, expected: str) -> str:
    """unit, if it is one of the expected dimension: a temperature or a flux density. Else it raises."""
    if unit not in UNITS[expected]:
        raise ValueError(f"{unit} is no unit of a {expected}")
    return unit


def cards(content: bytes) -> Iterator[tuple[str, object]]:
    """Keywords and values up to END, which comes as the last keyword where it is there."""
    for at in range(0, len(content) - 79, 80):
        card = content[at : at + 80].decode("ascii", "replace")
        key = card[:8].strip()
        if key == "END":
            yield "END", at
            return
        if card[8:10] == "= ":
            text = card[10:].split("/")[0].strip() if not card[10:].lstrip().startswith("'") else card[10:].lstrip()[1:].split("'")[0].rstrip()
            if text in ("T", "F"):
                yield key, text == "T"
                continue
            try:
                yield key, float(text.replace("D", "E")) if any(c in text for c in ".EeDd") else int(text)
            except ValueError:
                yield key, text


@dataclass
class Image:
    """What a header says of the first image: keywords, the place of its data, and its size."""

    keywords: dict
    at: int

    @classmethod
    def of(cls, file) -> Image:
        """Reads blocks up to the header's END and no further."""
        content, found = b"", {}
        while "END" not in found:
            block = file.read(BLOCK)
            if len(block) < BLOCK and not block.rstrip(b"\0 ").endswith(b"END"):
                raise ValueError("no END in the header")
            content += block
            found |= dict(cards(block))
        del found["END"]
        if int(found.get("NAXIS", 0)) < 2:
            raise ValueError("not an image")
        return cls(found, len(content))

    @property
    def ny(self) -> int:
        return int(self.keywords["NAXIS2"])

    @property
    def nx(self) -> int:
        return int(self.keywords["NAXIS1"])

    @property
    def planes(self) -> int:
        return int(np.prod([int(self.keywords[f"NAXIS{i}"]) for i in range(3, int(self.keywords["NAXIS"]) + 1)], dtype=np.int64))

    @property
    def kind(self) -> np.dtype:
        return np.dtype(_TYPES[int(self.keywords["BITPIX"])])

    def number(self, key: str) -> float | None:
        return float(self.keywords[key]) if key in self.keywords else None

    def values(self, raw: bytes) -> np.ndarray:
        data = np.frombuffer(raw, self.kind)
        out = data.astype(float) * float(self.keywords.get("BSCALE", 1)) + float(self.keywords.get("BZERO", 0))
        if "BLANK" in self.keywords and self.kind.kind in "iu":
            out[data == int(self.keywords["BLANK"])] = np.nan
        return out

    def sky_rows(self, dec0: float, dec1: float) -> tuple[int, int]:
        """Rows whose centres lie between the declinations, ends included."""
        return self.between(sorted(((d - self.number("CRVAL2")) / self.number("CDELT2") + self.number("CRPIX2") - 1) for d in (dec0, dec1)), self.ny)

    def sky_columns(self, ra0: float, ra1: float) -> list[tuple[int, int]]:
        """Ranges of columns whose centres lie from ra0 eastward to ra1, ends included; ra1 under ra0 lies beyond 360 degrees."""
        if ra1 < ra0:
            ra1 += 360.0
        turns = range(-3, 4)
        spans = [self.between(sorted((r + 360.0 * k - self.number("CRVAL1")) / self.number("CDELT1") + self.number("CRPIX1") - 1 for r in (ra0, ra1)), self.nx) for k in turns]
        out: list[tuple[int, int]] = []
        for a, z in sorted(s for s in spans if s[0] < s[1]):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(z, out[-1][1]))
            else:
                out.append((a, z))
        return out

    @staticmethod
    def between(ends: list[float], n: int) -> tuple[int, int]:
        low, high = (float(np.clip(e, -1, n)) for e in ends)
        return max(0, int(np.ceil(low - 1e-9))), min(n, int(np.floor(high + 1e-9)) + 1)


def rows_of(file, image: Image, plane: int, y0: int, y1: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, first column, values) of rows y0 to y1, ends excluded, within spans of columns. Reads those bytes, or whole rows where most of them is asked for."""
    width = image.kind.itemsize
    start = image.at + plane * image.ny * image.nx * width
    if sum(z - a for a, z in spans) > image.nx // 2:
        step = max(1, PIXELS_AT_ONCE // max(1, image.nx))
        for y in range(y0, y1, step):
            n = min(step, y1 - y)
            file.seek(start + y * image.nx * width)
            block = image.values(file.read(n * image.nx * width)).reshape(n, image.nx)
            for a, z in spans:
                yield y, a, block[:, a:z]
        return
    for y in range(y0, y1):
        for a, z in spans:
            file.seek(start + (y * image.nx + a) * width)
            yield y, a, image.values(file.read((z - a) * width)).reshape(1, -1)


def opened(path: str):
    """A file that can be sought, of any store that the file systems of Arrow reach."""
    where, name = fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else os.path.abspath(path))
    return where.open_input_file(name)


def listed(path: str, suffix: str = ".fits") -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files with that suffix under a folder, in order."""
    where, name = fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else os.path.abspath(path))
    lead = path[: len(path) - len(name)] if path.endswith(name) else ""
    info = where.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else where.get_file_info(fs.FileSelector(name, recursive=True))
    return sorted((lead + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Names(InputPartition):
    paths: list[str]


class FitsReader(DataSourceReader):
    """Pixels of files by byte ranges."""

    def __init__(self, options: dict):
        self.path, self.plane = options["path"], int(options.get("plane", 0))
        self.positions = options.get("positions", "false").lower() == "true"
        self.unit, self.split = options.get("unit"), int(options.get("split", SPLIT))
        self.bounds = {"gy": [-np.inf, np.inf], "gx": [-np.inf, np.inf], "dec_deg": [-np.inf, np.inf]}
        self.sky = [float(x) for x in options["sky"].split(",")] if "sky" in options else None
        if "box" in options:
            y0, y1, x0, x1 = (int(x) for x in options["box"].split(","))
            self.bounds |= {"gy": [y0, y1 - 1], "gx": [x0, x1 - 1]}

    def partitions(self):
        return [Range(p, at, min(size, at + self.split)) for p, size in listed(self.path) for at in range(0, size, self.split)]

    def wanted(self, image: Image, part: Range) -> tuple[int, int, list[tuple[int, int]]]:
        """Rows that begin in the range of bytes, and spans of columns, that are asked for."""
        stride = image.nx * image.kind.itemsize
        start = image.at + self.plane * image.ny * stride
        y0, y1 = (int(np.clip(-(-(at - start) // stride), 0, image.ny)) for at in (part.start, part.end))
        low, high = self.bounds["gy"]
        y0, y1 = max(y0, int(np.ceil(np.clip(low, 0, image.ny)))), min(y1, int(np.floor(np.clip(high, -1, image.ny))) + 1)
        low, high = self.bounds["gx"]
        spans = [(int(np.ceil(np.clip(low, 0, image.nx))), min(image.nx, int(np.floor(np.clip(high, -1, image.nx))) + 1))]
        dec = list(self.bounds["dec_deg"])
        if self.sky:
            dec = [max(dec[0], self.sky[0]), min(dec[1], self.sky[1])]
            spans = [(max(a, spans[0][0]), min(z, spans[0][1])) for a, z in image.sky_columns(*self.sky[2:])]
        if np.isfinite(dec).any():
            a, z = image.sky_rows(max(-1e6, dec[0]), min(1e6, dec[1]))
            y0, y1 = max(y0, a), min(y1, z)
        return y0, y1, [s for s in spans if s[0] < s[1]]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with opened(partition.path) as file:
            yield from self.pixels(file, partition)

    def pixels(self, file, partition: Range) -> Iterator[pa.RecordBatch]:
        image = Image.of(file)
        if self.unit:
            checked_unit(image.keywords.get("BUNIT"), self.unit)
        if self.plane >= image.planes:
            raise ValueError(f"{partition.path} has {image.planes} planes")
        y0, y1, spans = self.wanted(image, partition)
        waiting: list[tuple[int, int, np.ndarray]] = []
        for block in rows_of(file, image, self.plane, y0, y1, spans) if spans else ():
            waiting.append(block)
            if sum(b[2].size for b in waiting) >= PIXELS_AT_ONCE:
                yield self.batch(partition.path, image, waiting)
                waiting = []
        if waiting:
            yield self.batch(partition.path, image, waiting)

    def batch(self, path: str, image: Image, blocks: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        y = np.concatenate([np.repeat(np.arange(v.shape[0], dtype=np.int32) + y, v.shape[1]) for y, _, v in blocks])
        x = np.concatenate([np.tile(np.arange(v.shape[1], dtype=np.int32) + x, v.shape[0]) for _, x, v in blocks])
        names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(y), np.int32)), pa.array([path])).cast(pa.string())
        columns = {"path": names, "gy": pa.array(y), "gx": pa.array(x), "value": pa.array(np.concatenate([v.ravel() for *_, v in blocks]))}
        if self.positions:
            at = lambda n, i: image.number(f"CRVAL{i}") + (n + 1 - image.number(f"CRPIX{i}")) * image.number(f"CDELT{i}")
            columns |= {"ra_deg": pa.array(at(x, 1) % 360.0), "dec_deg": pa.array(at(y, 2))}
        return pa.RecordBatch.from_pydict(columns)


class FilteringReader(FitsReader):
    """Conditions on gy, gx and dec_deg narrow what is read; Spark still applies them."""

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in self.bounds and not isinstance(getattr(f, "value", None), (str, bool, type(None))):
                low, high = self.bounds[name]
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, float(f.value))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = min(high, float(f.value))
                self.bounds[name] = [low, high]
            yield f


class HeaderReader(DataSourceReader):
    """One row for each file, from the blocks of its header alone."""

    def __init__(self, options: dict):
        self.path, self.unit = options["path"], options.get("unit")

    def partitions(self):
        names = [p for p, _ in listed(self.path)]
        return [Names(names[i : i + HEADERS_AT_ONCE]) for i in range(0, len(names), HEADERS_AT_ONCE)]

    def read(self, partition: Names) -> Iterator[tuple]:
        for path in partition.paths:
            with opened(path) as file:
                yield self.row(path, file)

    def row(self, path: str, file) -> tuple:
        image = Image.of(file)
        unit, step = image.keywords.get("BUNIT"), image.number("CDELT2")
        if self.unit:
            checked_unit(unit, self.unit)
        geometry = [image.number(f"{k}{i}") for i in (1, 2) for k in ("CRVAL", "CRPIX", "CDELT")]
        return (path, image.ny, image.nx, *geometry, None if unit is None else str(unit), None if step is None else abs(step))


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class FitsWriter(DataSourceArrowWriter):
    """Pixels to their places in <map_id>_<field>.fits of doubles, of ny rows and nx columns; what has no row is 0.

    Every run of neighbouring pixels is written where it belongs, whatever the order of rows and however often a task is
    run. Files bear another name until all tasks have ended; if one fails for good, they go. The folder is on a file
    system that all executors share and that takes writes at any place.
    """

    def __init__(self, options: dict, schema):
        path = options["path"]
        if re.match(r"\w+:", path) and not path.startswith("file:"):
            raise ValueError("FITS images are written to a shared file system, not to an object store")
        self.folder = re.sub(r"^file:(//)?", "", path)
        self.ny, self.nx = int(options["ny"]), int(options["nx"])
        self.fields = [n for n in schema.fieldNames() if n not in ("map_id", "gy", "gx")]
        self.job = uuid.uuid4().hex
        self.head = head(self.ny, self.nx, json.loads(options.get("keywords", "{}")))

    def place(self, name: str) -> str:
        return os.path.join(self.folder, f".{name}.{self.job}")

    def write(self, iterator) -> Written:
        os.makedirs(self.folder, exist_ok=True)
        files: dict[str, int] = {}
        try:
            for b in iterator:
                at = {n: b.column(i) for i, n in enumerate(b.schema.names)}
                y, x = at["gy"].to_numpy(zero_copy_only=False), at["gx"].to_numpy(zero_copy_only=False)
                if len(y) and (y.min() < 0 or x.min() < 0 or y.max() >= self.ny or x.max() >= self.nx):
                    raise ValueError("a pixel lies outside the image")
                ids = at["map_id"].cast(pa.string()).dictionary_encode()
                place = y.astype(np.int64) * self.nx + x
                order = np.lexsort((place, ids.indices.to_numpy()))
                place, which = place[order], ids.indices.to_numpy()[order]
                cuts = np.concatenate([[0], np.flatnonzero((np.diff(place) != 1) | (np.diff(which) != 0)) + 1, [len(place)]]) if len(place) else [0]
                for field in self.fields:
                    v = at[field].cast(pa.float64()).to_numpy(zero_copy_only=False)[order].astype(">f8")
                    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                        name = f"{re.sub(r'[^A-Za-z0-9_.+-]', '_', ids.dictionary[int(which[s])].as_py())}_{field}.fits"
                        if name not in files:
                            files[name] = os.open(self.place(name), os.O_RDWR | os.O_CREAT, 0o644)
                        os.pwrite(files[name], v[s:e].tobytes(), len(self.head) + 8 * int(place[s]))
        finally:
            for f in files.values():
                os.close(f)
        return Written(sorted(files))

    def commit(self, messages) -> None:
        end = len(self.head) + 8 * self.ny * self.nx
        for name in sorted({n for m in messages if m is not None for n in m.names}):
            with open(self.place(name), "r+b") as f:
                f.write(self.head)
                f.truncate(end + -end % BLOCK)
            os.replace(self.place(name), os.path.join(self.folder, name))

    def abort(self, messages) -> None:
        for name in os.listdir(self.folder) if os.path.isdir(self.folder) else ():
            if name.endswith(f".{self.job}"):
                os.unlink(os.path.join(self.folder, name))


class FitsSource(DataSource):
    """format("sky_fits"): pixels (or, with option rows=headers, a row a file) of path; written, images of columns map_id, gy, gx and any layers.

    Options of reading: plane; box (y0,y1,x0,x1, ends excluded) or sky (dec0,dec1,ra0,ra1 in degrees, ends included);
    positions (true adds ra_deg and dec_deg); filters (true
    narrows the reading by conditions, which needs spark.sql.python.filterPushdown.enabled); unit (temperature or flux: another one raises); split (bytes of a task).
    Options of writing: ny, nx, keywords (of the header, as JSON).
    """

    @classmethod
    def name(cls) -> str:
        return "sky_fits"

    def schema(self) -> str:
        if self.options.get("rows") == "headers":
            return HEADERS
        return PIXELS + (POSITIONS if self.options.get("positions", "false").lower() == "true" else "")

    def reader(self, schema):
        options = {k.lower(): v for k, v in self.options.items()}
        if options.get("rows") == "headers":
            return HeaderReader(options)
        return (FilteringReader if options.get("filters") == "true" else FitsReader)(options)

    def writer(self, schema, overwrite: bool):
        return FitsWriter({k.lower(): v for k, v in self.options.items()}, schema)


def head(ny: int, nx: int, keywords: dict | None = None) -> bytes:
    """The header of a two-dimensional image of doubles."""
    told = {"SIMPLE": "T", "BITPIX": -64, "NAXIS": 2, "NAXIS1": nx, "NAXIS2": ny} | (keywords or {})
    text = "".join((f"{k:<8}= {v!r:<70}" if isinstance(v, str) and v != "T" else f"{k:<8}= {v:>20}{'':<50}")[:80] for k, v in told.items()) + f"{'END':<80}"
    return text.encode() + b" " * (-len(text) % BLOCK)


def encoded(data: np.ndarray, keywords: dict | None = None) -> bytes:
    """A FITS file of a two-dimensional image of doubles."""
    body = data.astype(">f8").tobytes()
    return head(*data.shape, keywords) + body + b"\0" * (-len(body) % BLOCK)


def source(spark: SparkSession):
    """The reader of the session, which knows the format; filters are pushed down where the session allows that for Python sources."""
    spark.dataSource.register(FitsSource)
    return spark.read.format(FitsSource.name()).option("filters", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))


def read_headers(spark: SparkSession, path: str, unit: str | None = None) -> DataFrame:
    """Geometry and unit of every image under path. unit: temperature or flux; an image of another one raises."""
    return source(spark).options(rows="headers", **({"unit": unit} if unit else {})).load(path)


def read_pixels(spark: SparkSession, path: str, box: tuple[int, int, int, int] | None = None, sky: tuple[float, float, float, float] | None = None, unit: str | None = None, plane: int = 0, positions: bool = False) -> DataFrame:
    """(path, gy, gx, value [, ra_deg, dec_deg]) of every image under path, or of its part.

    box: (y0, y1, x0, x1), ends excluded. sky: (dec0, dec1, ra0, ra1) in degrees, of pixels' centres, ends included. Only
    the rows and columns of the part are read. unit: temperature or flux; an image of another one raises.
    """
    options = {"plane": plane, "positions": positions} | ({"unit": unit} if unit else {})
    options |= {k: ",".join(map(str, v)) for k, v in (("box", box), ("sky", sky)) if v is not None}
    return source(spark).options(**options).load(path)


def read_map(spark: SparkSession, layers: dict[str, str], box=None, sky=None, units: dict[str, str] | None = None) -> DataFrame:
    """Layers of one map (name: path) side by side. Layers must have the same shape; a pixel that one lacks raises."""
    out = None
    for name, path in layers.items():
        rows = read_pixels(spark, path, box, sky, (units or {}).get(name)).select("gy", "gx", F.col("value").alias(name))
        out = rows if out is None else out.join(rows, ["gy", "gx"], "full_outer")
    for name in layers:
        out = out.withColumn(name, F.coalesce(name, F.raise_error(F.lit(f"layer {name} has another shape")).cast("double")))
    return out


def with_time_offset(pixels: DataFrame, offset: float, time: str = "t_unix") -> DataFrame:
    """Relative times as absolute ones; 0 stays unobserved."""
    return pixels.withColumn(time, F.when(F.col(time) > 0, F.col(time) + offset).otherwise(F.col(time)))


def write_maps(pixels: DataFrame, layers: list[str], ny: int, nx: int, path: str, keywords: dict | None = None, band: int = 256) -> None:
    """Each map's layers as <map_id>_<layer>.fits under path, bands of rows by several tasks; pixels without a row are 0, null values NaN.

    A file is there when all of the job's tasks have ended, or not at all. One of the same name is replaced.
    """
    pixels.sparkSession.dataSource.register(FitsSource)
    rows = pixels.select("map_id", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx"), *(F.col(c).cast("double").alias(c) for c in layers))
    rows = rows.repartition("map_id", F.floor(F.col("gy") / band)).sortWithinPartitions("map_id", "gy", "gx")
    rows.write.format(FitsSource.name()).mode("append").options(ny=ny, nx=nx, keywords=json.dumps(keywords or {})).save(path)
