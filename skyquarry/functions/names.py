"""Names of sources, bands and files as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band centres (GHz) and beam widths (arcmin) by band, of the large and of the small telescopes.
BAND_GHZ = {"f030": 30.0, "f040": 40.0, "f090": 90.0, "f150": 150.0, "f220": 220.0, "f280": 280.0}
BAND_GHZ_SMALL = {"f090": 93.0, "f150": 145.0, "f220": 225.0, "f280": 280.0}
BEAM_ARCMIN = {"f030": 7.4, "f040": 5.1, "f090": 2.2, "f150": 1.4, "f220": 1.0, "f280": 0.9}
BEAM_ARCMIN_SMALL = {"f090": 27.4, "f150": 17.6, "f220": 13.5, "f280": 12.1}


def band_value(band: Column, values: dict[str, float], strict: bool = True) -> Column:
    """Lookup of a band; an unknown one raises, or is null if not strict."""
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(band == name, F.lit(value)).otherwise(out)
    return F.coalesce(out, F.raise_error(F.concat(F.lit("unknown band "), band)).cast("double")) if strict else out


def _padded(x: Column, n: int) -> Column:
    return F.lpad(x.cast("long").cast("string"), n, "0")


def iau_name(ra: Column, dec: Column, kind: str = "S", observatory: str = "SO", wrap: bool = True) -> Column:
    """`SO-S Jhhmmss+ddmm.m`, truncated and not rounded. kind: S, SV (to a tenth of a second of time and whole arc seconds), CL (hhmm, ddmm) or short (hhmm+dd).

    Without wrap the right ascension is taken as it is, so that one of 360 or more has hours from 24 on.
    """
    ms = F.rint((F.pmod(ra, F.lit(360.0)) if wrap else ra) / 15.0 * 3.6e6)  # milliseconds of time, then cut
    mas = F.rint(F.abs(dec) * 3.6e6)  # thousandths of an arc second
    hh, mm, ss = F.floor(ms / 3.6e6), F.floor(ms / 6e4) % 60, F.floor(ms / 1e3) % 60
    dd, dm, ds = F.floor(mas / 3.6e6), F.floor(mas / 6e4) % 60, F.floor(mas / 1e3) % 60
    sign = F.when(dec < 0, "-").otherwise("+")
    hour = F.concat(_padded(hh, 2), _padded(mm, 2))
    degree = F.concat(sign, _padded(dd, 2), _padded(dm, 2))
    if kind == "short":
        return F.concat(hour, sign, _padded(dd, 2))
    if kind == "CL":
        parts = (hour, degree)
    elif kind == "SV":
        parts = (F.concat(hour, _padded(ss, 2), F.lit("."), _padded(F.floor(ms / 100) % 10, 1)), F.concat(degree, _padded(ds, 2)))
    else:
        thousandths = F.rint(F.abs(dec) * 6e4) % 1000  # of an arc minute
        parts = (F.concat(hour, _padded(ss, 2)), F.concat(degree, F.lit("."), _padded(F.floor(thousandths / 100), 1)))
    return F.concat(F.lit(f"{observatory}-{kind} J"), *parts)


def transient_name(name: Column) -> Column:
    return F.replace(name, F.lit("-S"), F.lit("-T"))


def asteroid_name(name: Column) -> Column:
    """`3552 Don Quixote (1983 SA)` as `(3552) Don Quixote`, `7335 (1989 JA)` as `(7335) 1989 JA`; without a leading number unchanged."""
    number = F.regexp_extract(name, r"^\s*(\d+)\s+\S", 1)
    rest = F.trim(F.regexp_replace(name, r"^\s*\d+\s+", ""))
    bare = F.regexp_extract(rest, r"^\(([^)]*)\)$", 1)
    named = F.trim(F.regexp_replace(rest, r"\s*\([^)]*\)\s*$", ""))
    return F.when(number == "", name).otherwise(F.concat(F.lit("("), number, F.lit(") "), F.when(bare != "", bare).otherwise(named)))


def designation_number(name: Column) -> Column:
    """`(3552) Don Quixote` as `3552;`."""
    return F.concat(F.ltrim(F.split(name, r"\)")[0], F.lit("(")), F.lit(";"))


def map_id(band: Column, array: Column, unix: Column) -> Column:
    return F.concat_ws("_", band, array, F.floor(unix).cast("string"))


def file_parts(path: Column) -> dict[str, Column]:
    """What a map file's name says: time, array, band, layer and suffix. Layers are tried in a fixed order."""
    name = F.element_at(F.split(path, "/"), -1)
    parts = F.split(F.regexp_replace(name, r"\.fits$", ""), "_")
    layer = F.lit(None).cast("string")
    for word in reversed(("rho", "kappa", "map", "ivar", "time")):
        layer = F.when(name.contains(word), word).otherwise(layer)
    return {"unix": F.regexp_extract(name, r"(\d{9,10})", 1), "arr": F.get(parts, F.lit(2)), "freq": F.regexp_extract(name, r"(f\d{3})", 1), "layer": layer, "suffix": F.element_at(parts, -1)}


def sexagesimal(text: Column, hours: bool = False) -> Column:
    """`[+-]d m s` in degrees."""
    p = F.split(F.trim(F.regexp_replace(text, "[+-]", " ")), r"[\s:]+")
    value = p[0].cast("double") + p[1].cast("double") / 60.0 + p[2].cast("double") / 3600.0
    return F.when(F.trim(text).startswith("-"), -value).otherwise(value) * (15.0 if hours else 1.0)
