"""SimHash near-duplicates: fingerprints in vantage-point shards, linked exactly within a Hamming radius.

A fingerprint x lies in the inner half of a node (vantage v, radius m) when d(x, v) <= m. By the triangle inequality
a partner within r of an outer x lies in the inner half only if d(x, v) <= m + r, so that x visits it only then.
Equal fingerprints count once: a group of any number of copies is one point.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm import nearcopies
from skyquarry.llm.common import batches, map_arrow, saved
from skyquarry.llm.graph import components

#: Fingerprints that choose the vantage points of the shared tree (a bounded sample; it changes only who meets where).
TREE_SAMPLE = 32768
#: Distinct fingerprints meant for a shard, and for a block compared pair by pair.
SHARD_POINTS, BLOCK_POINTS = 20_000, 1024


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64 majority bits of the XXH64 (seed 42) of the word shingles of an A-Z lower-cased text; 0 without words."""
    from xxhash import xxh64_digest

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        digests = [xxh64_digest(b" ".join(words), 42)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        digests = [xxh64_digest(line[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for i in range(0, len(digests), 8192):
        bits = np.unpackbits(np.frombuffer(b"".join(digests[i : i + 8192]), np.uint8)).reshape(-1, 64)
        total += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(digests)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long. Null texts count as empty; rows may repeat."""
    kind = docs.schema[id_col].dataType

    def kernel(it):
        out = pa.schema([("id", to_arrow), ("fp", pa.int64())])
        for batch in it:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield from batches(out, 10_000, {"id": batch.column(0), "fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)})

    to_arrow = to_arrow_type(kind)
    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), kernel, schema)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set where it is in over half of hashes."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def vantage_tree(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, inner, outer), root first; a negative child -1 - k is shard k."""
    nodes: list = []
    shards = 0

    def grow(points: np.ndarray, want: int) -> int:
        nonlocal shards
        if want > 1 and len(points) > 16:
            # of a few candidates, the vantage point whose distances spread most
            tries = points[:: max(1, len(points) // 12)][:12]
            vantage = max(tries, key=lambda v: distances(points, v).std())
            d = distances(points, vantage)
            radius = int(np.median(d))
            inner = d <= radius
            if 0 < inner.sum() < len(points):
                at = len(nodes)
                nodes.append(None)
                share = max(1, min(want - 1, round(want * inner.mean())))
                a = grow(points[inner], share)
                b = grow(points[~inner], want - share)
                nodes[at] = (int(vantage), radius, a, b)
                return at
        shards += 1
        return -shards

    root = grow(np.unique(sample), leaves)
    return nodes if root == 0 else []


def dealt(points: np.ndarray, nodes: list, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, shard, at home) of every shard that a point must see: its own, and those where its ball crosses the boundary."""
    found = []
    todo = [(0, np.arange(len(points)), np.ones(len(points), bool))] if nodes else [(-1, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        at, index, home = todo.pop()
        if not len(index):
            continue
        if at < 0:
            found.append((index, np.full(len(index), -1 - at), home))
            continue
        vantage, m, a, b = nodes[at]
        d = distances(points[index], np.uint64(vantage))
        inner = d <= m
        # a point at home in the outer half is only a visitor of the inner one: each pair meets on one side
        to_inner = d <= m + radius
        to_outer = np.where(home, ~inner, d > m - radius)
        todo.append((a, index[to_inner], (home & inner)[to_inner]))
        todo.append((b, index[to_outer], home[to_outer]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)


def close_pairs(home: np.ndarray, guests: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within radius, over home followed by guests; of each pair one at least is at home. Exact."""
    every = np.concatenate([home, guests])
    left, right = [], []

    def blocks(mine: np.ndarray, theirs: np.ndarray) -> None:
        both = np.concatenate([mine, theirs])
        for i in range(0, len(mine), BLOCK_POINTS):
            part = mine[i : i + BLOCK_POINTS]
            for j in range(i, len(both), 4 * BLOCK_POINTS):
                other = both[j : j + 4 * BLOCK_POINTS]
                x, y = np.nonzero(np.bitwise_count(every[part][:, None] ^ every[other][None, :]) <= radius)
                keep = part[x] != other[y]
                left.append(part[x[keep]])
                right.append(other[y[keep]])

    todo = [(np.arange(len(home)), np.arange(len(home), len(every)))]
    while todo:
        mine, theirs = todo.pop()
        if len(mine) <= BLOCK_POINTS:
            blocks(mine, theirs)
            continue
        d = distances(every[mine], every[mine[len(mine) // 2]])
        m = int(np.median(d))
        inner = d <= m
        if inner.all():
            m -= 1
            inner = d <= m
        if not inner.any() or inner.all():
            blocks(mine, theirs)
            continue
        g = distances(every[theirs], every[mine[len(mine) // 2]])
        todo.append((mine[inner], np.concatenate([theirs[g <= m + radius], mine[~inner & (d <= m + radius)]])))
        todo.append((mine[~inner], theirs[g > m - radius]))
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index reachable from each of n, by minimum propagation and pointer jumping."""
    lab = np.arange(n)
    while len(a):
        was = lab.copy()
        low = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, lab[a], low)
        np.minimum.at(lab, lab[b], low)
        while not np.array_equal(jump := lab[lab], lab):
            lab = jump
        if np.array_equal(was, lab):
            break
    return lab


def met(points: DataFrame, radius: int, found, schema: str) -> DataFrame:
    """found(a shard's fingerprints, index pairs within radius) for every shard of a vantage-point tree. points: distinct non-null `fp`."""
    n = points.count()
    leaves = max(1, -(-n // SHARD_POINTS))
    share = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(min(1.0, TREE_SAMPLE / max(1, n)) * (1 << 30)) + 1
    # a share by hash, so that the same fingerprints are chosen whenever this runs
    sample = np.array([r[0] for r in points.where(share).collect()] if leaves > 1 else [], np.int64).view(np.uint64)  # TREE_SAMPLE on average
    nodes = vantage_tree(sample, leaves) if len(sample) else []

    def deal(it):
        out = pa.schema([("shard", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])
        for batch in it:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            index, shard, home = dealt(x.view(np.uint64), nodes, radius)
            yield from batches(out, 50_000, {"shard": shard.astype(np.int64), "fp": x[index], "home": home})

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        fp = group["fp"].to_numpy(np.int64).view(np.uint64)
        at_home = group["home"].to_numpy(bool)
        home, guests = fp[at_home], fp[~at_home]
        a, b = close_pairs(home, guests, radius)
        return found(np.concatenate([home, guests]).view(np.int64), a, b)

    shards = map_arrow(points.select("fp"), deal, "shard long, fp long, home boolean")
    return shards.groupBy("shard").applyInPandas(meet, schema)


def links(points: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): star edges that connect distinct fingerprints `fp` exactly as all pairs within radius would.

    Within a shard, all pairs are found, and each connected set is returned as edges to its least member: the
    output stays linear in the points.
    """

    def stars(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        lab = roots(len(fp), a, b)
        moved = np.flatnonzero(lab != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[moved], "b": fp[lab[moved]]})

    return met(points, radius, stars, "a long, b long")


def neighbours(points: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): for each fingerprint one of those within radius, if there are any: candidates, whose texts are still to be compared."""

    def first(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        least = np.arange(len(fp))
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        moved = np.flatnonzero(least != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[moved], "b": fp[least[moved]]})

    return met(points, radius, first, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the least id reachable over fingerprint links.

    Texts that are null, empty or blank have fingerprint zero, which links like any other. Rows that repeat an id
    stay; a null id gets its component from the others of its group, and null if there are none.
    """
    marks = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    points = saved(marks.groupBy("fp").agg(F.min("id").alias("least")), "points")
    root = components(links(points.select("fp"), radius))
    named = points.join(root, points.fp == root.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("least").alias("component"))
    classes = named.join(best, "root").select("fp", "component")
    return marks.join(classes, "fp").select("id", "fp", "component")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """docs with one row of each near-duplicate group: that of the least id; rows that repeat this id count once. Null ids stay."""
    out = near_duplicates(docs, id_col, text_col, shingle, radius)
    kept = out.where("id = component").select(F.col("id").alias(id_col)).distinct()
    named = docs.where(F.col(id_col).isNotNull())
    return named.join(kept, id_col, "left_semi").dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull())).select(docs.columns)


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = nearcopies.SHINGLE, radius: int = 2) -> DataFrame:
    """docs with one row of each connected set of near copies: that of the least id, a null id being the greatest.

    Near copies are texts whose sets of word shingles have a Jaccard similarity of 0.8 or more. Fingerprints of the sets
    meet in vantage-point shards, and each candidate pair within radius is compared set by set. At a similarity of 0.8
    some 10 of 64 bits differ, a radius at which no branch of a tree can be pruned; so the links that are left are
    completed exactly by a prefix filter. Texts without words (null, empty, blank) are copies of each other. Rows that
    repeat count once; rows of one id with different texts are judged by their texts. An empty table stays empty.
    """
    kind = docs.schema[id_col].dataType

    def kernel(it):
        for batch in it:
            sets = [nearcopies.shingles(t, shingle) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            made = [pa.array([nearcopies.point(g) for g in sets], pa.int64()), pa.array(np.array([majority(g) for g in sets], np.uint64).view(np.int64)), pa.array([len(g) for g in sets], pa.int64()), pa.array([nearcopies.sketch(g) for g in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["id", "h", "point", "fp", "n", "sketch"])

    name, h = F.col(f"`{id_col}`"), nearcopies.text_hash(text_col)
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in ("h", "point", "fp", "n")), T.StructField("sketch", T.BinaryType())])
    marks = saved(map_arrow(docs.select(name.alias("id"), h.alias("h"), F.col(f"`{text_col}`").cast("string").alias("text")), kernel, schema), "marks")
    points = saved(marks.dropDuplicates(["point"]).select("point", "fp", "n", "sketch"), "points")
    least = saved(points.groupBy("fp").agg(F.min("point").alias("lead"), F.max("point").alias("last")), "fingerprints")
    same = points.join(least.where("lead < last"), "fp").where("point <> lead").select(F.col("point").alias("a"), F.col("lead").alias("b"))
    near = neighbours(least.select("fp"), radius)
    lead = lambda c: least.select(F.col("fp").alias(c), F.col("lead").alias(f"p{c}"))
    near = near.join(lead("a"), "a").join(lead("b"), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    known = nearcopies.verified(nearcopies._fitting(same.union(near).distinct(), points), docs, text_col, marks, shingle)
    root = components(nearcopies.completed(docs, text_col, marks, points, known, marks.count(), shingle))
    classes = marks.join(root, F.col("point") == F.col("node"), "left").groupBy(F.coalesce("root", "point").alias("root"))
    kept = classes.agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("k")).select(F.col("k.id").alias("kept_id"), F.col("k.h").alias("kept_h"))
    kept = saved(kept, "kept")
    twice = saved(marks.groupBy("id", "h").agg(F.count("*").alias("n")).where("n > 1").join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h")), "left_semi").select("id", "h"), "twice")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("id"), h.alias("h"))
    mine = lambda a, b: F.col("id").eqNullSafe(F.col(a)) & (F.col("h") == F.col(b))
    out = rows.join(kept, mine("kept_id", "kept_h"), "left_semi")
    if not twice.isEmpty():  # rows that repeat id and text go apart, so that the others are not shuffled again
        again = twice.select(F.col("id").alias("again_id"), F.col("h").alias("again_h"))
        out = out.join(again, mine("again_id", "again_h"), "left_anti").union(rows.join(again, mine("again_id", "again_h"), "left_semi").dropDuplicates(["id", "h"]))
    return out.select("row.*")
