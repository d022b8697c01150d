"""Fill-in-the-middle transformation of texts.

A text is cut into units (lines) by one full match of (unit)*: the regex library keeps every repetition of the group,
so that its ends are the places where units end, and two drawn numbers of units are looked up as code points. What lies
between the two cuts is the middle; it moves to the end of the text, behind sentinels. The draws are the leading digits
of a SHA-256 of the seed and the document's id, so that a run can be repeated on any cluster.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import map_arrow

#: Possessive, so that no repetition is kept for a second try.
LINES = r"[^\n]*+\n|[^\n]++"
#: Stand before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Code points that one match treats (a longer text is matched in stretches of whole lines), and bytes that leave together.
STRETCH, LEAVING = 4_000_000, 8 << 20


def unit_ends(text: str, units: regex.Pattern, stretch: int = STRETCH) -> list[int] | array:
    """Where the units of text end, in code points. units: a pattern (unit)* whose units end at every newline.

    A text of more than `stretch` code points is matched in stretches that end at a newline, so that the match keeps no
    more than their captures; a line longer than that is one stretch.
    """
    if len(text) <= stretch:
        return units.fullmatch(text).ends(1)
    ends, at = array("q"), 0
    while at < len(text):
        cut = text.find("\n", at + stretch - 1) + 1 or len(text)
        ends.extend(units.fullmatch(text, at, cut).ends(1))
        at = cut
    return ends


def draws(id_col: str, seed: int) -> list[Column]:
    """The first four groups of eight hexadecimal digits of SHA-256 of `seed:id`, as numbers. A null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def rearranged(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, id_col: str = "doc_id", text_col: str = "text", unit: str = LINES, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every text; n: its units.

    form is psm (prefix, suffix, middle), spm (suffix, prefix, middle; `spm` percent of the rearranged) or plain: the
    text as it is, of `100 - rate` percent of the texts, of empty and null ones, and of those that hold a sentinel; its
    prefix_chars and middle_chars are null. Rows that repeat are treated each, alike where id and text are; a null id
    counts as an empty one. Bytes that are no UTF-8 stay as they are, each a code point. Other columns take no part,
    whatever their names. An empty table gives an empty result. `unit` must match whole any text, and end at newlines.
    """
    kind = docs.schema[id_col].dataType
    p, s, m = sentinels
    fields = [("id", to_arrow_type(kind)), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]

    def kernel(it):
        units = regex.compile(f"({unit})*+")
        out, room = [], LEAVING

        def leave():
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)], schema=pa.schema(fields))

        for batch in it:
            for name, raw, h1, h2, h3, h4 in zip(*(batch.column(i) for i in range(6)), strict=True):
                text = (raw.as_py() or b"").decode("utf-8", "surrogateescape")
                ends = unit_ends(text, units)
                n = len(ends)
                if not text or any(x in text for x in sentinels) or h3.as_py() % 100 >= rate:
                    row = ("plain", None, None, text)
                else:
                    a, b = (ends[k - 1] if k else 0 for k in sorted((h1.as_py() % (n + 1), h2.as_py() % (n + 1))))
                    if h4.as_py() % 100 < spm:
                        row = ("spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}")
                    else:
                        row = ("psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}")
                made = row[3].encode("utf-8", "surrogateescape")
                out.append((name.as_py(), n, *row[:3], made))
                room -= len(made)
                if room < 0:
                    yield leave()
                    out, room = [], LEAVING
        if out:
            yield leave()

    schema = T.StructType([T.StructField("id", kind), *(T.StructField(n, t) for n, t in (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.BinaryType())))])
    told = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), *draws(id_col, seed))
    return map_arrow(told, kernel, schema).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from which an output was made. A text that holds a sentinel is plain, so the first of each in an output is its own.

    No sentinel may hold another one or begin as one ends, or it could be seen across a border.
    """
    p, s, m = sentinels

    def between(a: str | None, z: str | None) -> Column:
        found = F.substring_index(output, z, 1) if z else output
        # what follows the first a, which stands once
        return F.substring_index(found, a, -1) if a else found

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
