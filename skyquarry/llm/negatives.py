"""Hard negatives of anchors, by a shuffle that sorts.

Every pair (anchor, row) has an integer score. A pair travels as one packed key (anchor, descending score, kind, id):
the shuffle deals keys by anchor and sorts them, so that a task reads each anchor's rows best first, and an iterator
decides them as they pass. A positive opens a window of scores below its own; a negative is emitted for each window that
is open and not yet full. The iterator keeps the few open windows and nothing else of an anchor.

Scores come from blocks: rows lie in shards of bounded size by their id's hash, each read once; anchors pass through
every shard in batches and are multiplied with it. Of a shard only those pairs are sent on that can come out: its first
positives, and, in a second pass that knows each anchor's positives, its first negatives in each of their windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyquarry.llm.common import batches, map_arrow, saved

#: Rows of a shard at most, rows that make a shard worth its task, and anchors that are multiplied with a shard at once.
SHARD, LEAST, ASKING = 32_768, 256, 128
#: Scores stay below 2^SCORE_BITS, so that a hundredfold of them fits a long.
SCORE_BITS = 56
POSITIVE, NEGATIVE = 0, 1
#: An anchor's number, the score from the top, the kind and the row's number, so that bytes sort as the pairs do.
PACKED = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_TOP = np.uint64(1 << 63)


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, name: np.ndarray) -> pa.Array:
    """Keys of pairs as binary values of equal width."""
    out = np.empty(len(name), PACKED)
    out["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ _TOP
    out["score"] = (-score.astype(np.int64)).view(np.uint64) ^ _TOP
    out["kind"] = kind
    out["id"] = name.astype(np.int64).view(np.uint64) ^ _TOP
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(PACKED.itemsize), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    """(anchor, score, kind, id) of a key."""
    number = lambda at: int.from_bytes(key[at : at + 8], "big") - (1 << 63)
    return number(0), -number(8), key[16], number(17)


def mined(keys: Iterator[bytes], positives: int, most: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive's score, negative's score) from keys in order.

    An anchor's first `positives` positives open windows; a window takes the first `most` negatives n with
    low * p <= 100 * n <= high * p. Positives sort before negatives of their score, and high is at most 100.
    """
    anchor, opened, windows = None, 0, []
    for key in keys:
        a, score, kind, name = unpacked(key)
        if a != anchor:
            anchor, opened, windows = a, 0, []
        if kind == POSITIVE:
            if opened < positives:
                opened += 1
                windows.append([name, score, 0])
            continue
        for w in windows:
            if low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield a, w[0], w[2], name, w[1], score
        # scores only fall: a full window and one that lies above are done
        if windows and (windows[0][2] == most or any(w[2] == most or low * w[1] > 100 * score for w in windows)):
            windows = [w for w in windows if w[2] < most and low * w[1] <= 100 * score]


def first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest, equal ones in the order they stand."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores > cut)
        at = np.concatenate([over, np.flatnonzero(scores == cut)[: k - len(over)]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((at, -scores[at]))]


def padded(column: pa.Array, width: int = 0) -> np.ndarray:
    """The rows of a list column of whole numbers; what a shorter row lacks is zero."""
    n = len(column)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())]).astype(np.int64) if n else np.zeros(1, np.int64)
    flat, size = column.flatten().to_numpy(zero_copy_only=False), np.diff(ends)
    out = np.zeros((n, max(width, int(size.max()) if n else 0)), np.int64)
    out[np.repeat(np.arange(n), size), np.arange(len(flat)) - np.repeat(ends[:-1], size)] = flat
    return out


class Shard:
    """Rows of one shard, ordered by label and id, and their products with anchors."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts)
        ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        self.x = padded(rows["v"].combine_chunks())[order]
        self.most = float(np.abs(self.x).max(initial=0))
        # whole numbers below 2^53 are exact as doubles, whose products are much faster
        self.doubles = self.x.astype(np.float64)

    def scores(self, asked: np.ndarray) -> np.ndarray:
        """Exact products, a row for each anchor."""
        n = min(asked.shape[1], self.x.shape[1])
        if n * self.most * float(np.abs(asked).max(initial=0)) < 2**53:
            return (asked[:, :n].astype(np.float64) @ self.doubles[:, :n].T).astype(np.int64)
        return asked[:, :n] @ self.x[:, :n].T


def through_shards(asking: DataFrame, rows: DataFrame, shards: int, answer, columns: str) -> DataFrame:
    """What answer(shard, anchors, scores) yields for every batch of anchors and every shard.

    rows: id, label, v; asking: the same and more. Rows go to shards by hash and stand first there; a task holds its
    shard and one batch of anchors.
    """
    more = [c for c in asking.columns if c not in rows.columns]
    kinds = dict(asking.dtypes)
    held = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), "id", "label", "v", *(F.lit(None).cast(kinds[c]).alias(c) for c in more))
    going = asking.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks"), "id", "label", "v", *more)
    met = held.unionByName(going).repartitionById(shards, F.col("shard")).sortWithinPartitions("asks").drop("shard")

    def kernel(it):
        parts, shard = [], None
        for b in it:
            at = int(np.searchsorted(b.column(0).to_numpy(), 1))
            if at:
                parts.append(b.slice(0, at))
            if at == len(b) or not parts:
                continue
            shard, asks = shard or Shard(parts), b.slice(at)
            for i in range(0, len(asks), ASKING):
                some = asks.slice(i, ASKING)
                yield from answer(shard, some, shard.scores(padded(some.column("v"))))

    return map_arrow(met, kernel, columns)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, most: int = 5, low: int = 80, high: int = 100, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows where is_anchor holds.

    Components become floor(scale * x), scores are their products' sums. An anchor's positives are its first rows of its
    label; to each belong the first `most` rows of other labels whose score is `low` to `high` percent of the
    positive's, by descending score and ascending id. `high` is at most 100.

    Rows without an id or a label, with a null vector, or a null or non-finite component take no part. Rows that repeat
    an id count once, with the least label, then the least vector. An empty vector has the score 0 with all; a component
    that a shorter vector lacks counts as 0; components beyond the root of 2^56 / their number are held to it, so that
    every score is a long. Empty tables, anchors without a positive and positives without a negative give no row. Other
    columns take no part, whatever their names.
    """
    if not 0 <= high <= 100:
        raise ValueError("high is at most 100 percent of a positive's score")
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bound = F.floor(F.sqrt(F.lit(float(1 << SCORE_BITS)) / F.greatest(F.size(v), F.lit(1)))).cast("double")
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, bound), -bound)).cast("long"))
    taking = vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).where("id is not null and label is not null")
    once = taking.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("asks").alias("asks"))
    rows = saved(once.select("id", "r.label", "r.v", "asks"), "rows")
    anchors, held = rows.where("asks").drop("asks"), rows.drop("asks")

    n = rows.count()
    spread = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // SHARD), min(spread, n // LEAST))

    def nearest(shard: Shard, asks: pa.RecordBatch, scores: np.ndarray):
        out, made = pa.schema([("anchor", pa.int64()), ("score", pa.int64()), ("id", pa.int64())]), []
        for i, (a, lab) in enumerate(zip(asks.column("id").to_numpy(), asks.column("label").to_numpy(), strict=True)):
            s, z = np.searchsorted(shard.labels, [lab, lab + 1])
            others = np.flatnonzero(shard.ids[s:z] != a) + s
            at = others[first(scores[i, others], positives)]
            made.append((np.full(len(at), a), scores[i, at], shard.ids[at]))
        yield from batches(out, 50_000, dict(zip(out.names, map(np.concatenate, zip(*made, strict=True)), strict=True)))

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = through_shards(anchors, held, shards, nearest, "anchor long, score long, id long")
    pairs = saved(near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives).drop("n"), "positives")
    wanted = pairs.groupBy(F.col("anchor").alias("id")).agg(F.collect_set("score").alias("tops"))
    asking = anchors.join(wanted, "id")

    def between(shard: Shard, asks: pa.RecordBatch, scores: np.ndarray):
        order, made = np.argsort(shard.ids, kind="stable"), []
        ids, labels = shard.ids[order], shard.labels[order]
        for i, (a, lab, tops) in enumerate(zip(asks.column("id").to_numpy(), asks.column("label").to_numpy(), asks.column("tops").to_pylist(), strict=True)):
            row = scores[i, order]
            spans = [(-(-low * p // 100), high * p // 100) for p in tops]
            near = np.flatnonzero((row >= min(x for x, _ in spans)) & (row <= max(z for _, z in spans)) & (labels != lab))
            part = row[near]
            found = [inside[first(part[inside], most)] for x, z in spans if (inside := np.flatnonzero((part >= x) & (part <= z))).size]
            if found:
                at = near[np.unique(np.concatenate(found))]
                made.append(packed(np.full(len(at), a), row[at], NEGATIVE, ids[at]))
        if made:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(made)], ["key"])

    def opening(it):
        for b in it:
            a, s, i = (b.column(k).to_numpy() for k in range(3))
            yield pa.RecordBatch.from_arrays([packed(a, s, POSITIVE, i)], ["key"])

    keys = through_shards(asking, held, shards, between, "key binary").unionByName(map_arrow(pairs, opening, "key binary"))
    dealt = keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(max(spread, shards), lambda key: zlib.crc32(key[:8]))
    found = dealt.mapPartitions(lambda it: mined((k for k, _ in it), positives, most, low, high))
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return vectors.sparkSession.createDataFrame(found, T.StructType([T.StructField(c, T.IntegerType() if c == "rank" else T.LongType(), False) for c in names]))
