"""Benchmark decontamination by winnowing.

Of every window of `w` consecutive k-grams the least hash is kept, on both sides by the same rule, so that two texts
with k + w - 1 words in common share a kept hash within them. Kept hashes of documents join those of the benchmark;
each hit is then extended over the windows around it, which are compared word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import MIX, P, batches, byte_buffer, map_arrow, mixed, prefix_hashes, saved, slabs

#: Words of a window, and words of a winnowed k-gram in it.
WINDOW, GRAM = 10, 5
#: The prefilter holds this many bits, whatever the benchmark's size; what passes it is joined exactly.
FILTER_BITS = 20
#: Benchmark rows up to which the small side is broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Word bytes: all but 00-2F, 3A-60 and 7B-7F.
_WORD = np.ones(256, bool)
_WORD[0x00:0x30] = _WORD[0x3A:0x61] = _WORD[0x7B:0x80] = False


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(lower-cased bytes, word starts, word ends, document of each word) of texts that lie one after another."""
    low = _LOWER[data]
    inside = _WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(low), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(low), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h, down = prefix_hashes(low)
    return mixed((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX)


def winnowed(words: np.ndarray, doc: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the k-grams that are the least of a window of `size` words; ties are all kept."""
    n = len(words) - gram + 1
    if n < 1 or len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(size))
    for j in range(gram):
        h = h * P + words[j : j + n]
    h = mixed(h)
    w = size - gram + 1
    windows = n - w + 1
    least = h[:windows].copy()
    for j in range(1, w):
        np.minimum(least, h[j : j + windows], out=least)
    whole = doc[:windows] == doc[size - 1 : size - 1 + windows]
    kept = np.zeros(n, bool)
    for j in range(w):
        kept[j : j + windows] |= whole & (h[j : j + windows] == least)
    at = np.flatnonzero(kept)
    return at, h[at]


def _classes(sizes: list[int]) -> list[tuple[int, int]]:
    """(window, gram) for every window length: below WINDOW, each k-gram of that length is a window of its own."""
    return [(s, GRAM if s == WINDOW else s) for s in sizes]


def _bench_kernel(window: int):
    def kernel(it):
        out = pa.schema([("item", pa.string()), ("size", pa.int32()), ("h", pa.int64()), ("words", pa.string())])
        for batch in it:
            items = batch.column(0).to_pylist()
            data, offsets = byte_buffer(batch.column(1))
            low, starts, ends, doc = words_of(data, offsets)
            hashes = word_hashes(low, starts, ends)
            raw = low.tobytes()
            rows = []
            for i, item in enumerate(items):
                a, b = np.searchsorted(doc, [i, i + 1])
                if a == b:
                    continue
                size = min(window, b - a)
                gram = dict(_classes([size]))[size]
                _, kept = winnowed(hashes[a:b], doc[a:b], size, gram)
                rows += [(item, size, h, None) for h in np.unique(kept).view(np.int64).tolist()]
                text = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                rows += [(item, size, None, x) for x in dict.fromkeys(" ".join(text[j : j + size]) for j in range(len(text) - size + 1))]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield from batches(out, 10_000, {f.name: pa.array(list(c), f.type) for f, c in zip(out, columns, strict=True)})

    return kernel


def _doc_kernel(sizes: list[int], passes: np.ndarray, kind: pa.DataType):
    """Rows of two kinds: one for each document with its number of words, and one for each kept hash that may be the benchmark's.

    The first has size 0, which no window has, and its own number for a hash, so that joins deal such rows evenly.
    """

    def kernel(it):
        out = pa.schema([("row_id", pa.int64()), ("id", kind), ("n_words", pa.int64()), ("size", pa.int32()), ("h", pa.int64()), ("first", pa.int64()), ("context", pa.string())])
        for batch in it:
            data_all, offsets_all = byte_buffer(batch.column(1))
            ids_all = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in slabs(offsets_all):
                offsets = offsets_all[i : j + 1] - offsets_all[i]
                ids = ids_all[i:j]
                low, starts, ends, doc = words_of(data_all[offsets_all[i] : offsets_all[j]], offsets)
                hashes = word_hashes(low, starts, ends)
                bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
                cols = [(ids, np.diff(bounds), np.zeros(len(ids), np.int32), ids, np.zeros(len(ids), np.int64), [None] * len(ids))]
                raw = low.tobytes() if len(low) else b""
                for size, gram in _classes(sizes):
                    at, h = winnowed(hashes, doc, size, gram)
                    keep = passes[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                    at, h = at[keep], h[keep]
                    if not len(at):
                        continue
                    of = doc[at]
                    first = np.maximum(at - (size - gram), bounds[of])
                    last = np.minimum(at + size, bounds[of + 1])
                    text = [" ".join(raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    cols.append((ids[of], np.full(len(at), -1), np.full(len(at), size, np.int32), h.view(np.int64), first - bounds[of], text))
                joined = [np.concatenate(c) for c in list(zip(*cols, strict=True))[:5]]
                names = batch.column(2).slice(i, j - i).take(pa.array(np.searchsorted(ids, joined[0])))
                yield from batches(out, 10_000, dict(zip(out.names, [joined[0], names, *joined[1:], [t for c in cols for t in c[5]]], strict=True)))

    return kernel


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(row_id, id, n_words, spans, items) for every row of docs; rows that repeat count one by one.

    A window is `window` consecutive item words, or the whole of a shorter item. spans: the sorted distinct
    (first, size) of windows that occur in the text, in words; items: the sorted distinct ids, as strings, of items
    with an occurring window. Null and empty texts, and texts without a word, have no spans; an empty benchmark hits nothing.
    """
    items = saved(map_arrow(bench.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")), _bench_kernel(window), "item string, size int, h long, words string"), "bench")
    marks = items.where("h is not null").select("size", "h").distinct()
    windows = items.where("words is not null").groupBy("size", "words").agg(F.collect_set("item").alias("of"))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most `window`
    passes = np.zeros(1 << FILTER_BITS, bool)
    set_bits = marks.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).cast("int").alias("b")).distinct()
    passes[set_bits.toPandas()["b"].to_numpy(np.int64)] = True  # at most 2^FILTER_BITS small integers
    small = items.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else (lambda df: df)
    kind = docs.schema[id_col].dataType
    schema = f"row_id long, id {kind.simpleString()}, n_words long, size int, h long, first long, context string"
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    rows = map_arrow(texts, _doc_kernel(sizes, passes, to_arrow_type(kind)), schema)
    hits = rows.join(hint(marks.withColumn("hit", F.lit(True))), ["size", "h"], "left").where("n_words >= 0 or hit")
    words = F.split("context", " ")
    around = F.when(F.size(words) >= F.col("size"), F.transform(F.sequence(F.lit(0), F.size(words) - F.col("size")), lambda i: F.struct((F.col("first") + i).alias("first"), F.array_join(F.slice(words, i + 1, F.col("size")), " ").alias("words"))))
    own = F.array(F.struct(F.col("first"), F.col("row_id").cast("string").alias("words")))
    spread = hits.select("row_id", "id", "n_words", "size", F.explode(F.when(F.col("size") == 0, own).otherwise(around)).alias("w")).select("row_id", "id", "n_words", "size", "w.first", "w.words")
    found = spread.join(hint(windows), ["size", "words"], "left").where("n_words >= 0 or of is not null")
    spans = F.array_sort(F.collect_set(F.when(F.col("of").isNotNull(), F.struct("first", F.col("size").cast("long").alias("size")))))
    return found.groupBy("row_id", "id").agg(F.max("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("of")))).alias("items"))


def covered(spans):
    """How many words sorted spans cover."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc, s):
        end = s["first"] + s["size"]
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(s["first"], acc["end"]))).alias("n"), F.greatest(end, acc["end"]).alias("end"))

    return F.aggregate(spans, start, add)["n"]


def decontaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the rows in whose text a window of a benchmark item occurs. Each row is judged by its text, whatever its id; null texts stay."""
    digest = F.md5(F.col(f"`{text_col}`").cast("string"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest.alias("digest"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = contamination(rows.select("digest", "text"), bench, "digest").where(F.size("spans") > 0).select(F.col("id").alias("digest")).distinct()
    return rows.join(found, "digest", "left_anti").select("row.*")
