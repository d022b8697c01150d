"""Nearest neighbours by inner product in a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and every vector is filed under one leaf. A query opens nodes in order of the
inner product with their centroids, from a priority queue. How many leaves it visits is calibrated: the visits of a
sample of queries, whose true neighbours are found in blocks over all rows, widen until the wanted recall is reached.
Equal vectors are filed once with their least ids, so that a vector with any number of copies is one candidate.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquarry.llm.common import batches, map_arrow, saved

#: Vectors that fit the tree, queries that calibrate it, and the recall they must reach.
FIT_SAMPLE, CALIBRATION, RECALL = 65_536, 128, 0.95
#: Children of a node, vectors meant for a leaf, leaves at most, and vectors of a shard: neighbouring leaves, or a part of a large one.
BRANCH, LEAF, MOST_LEAVES, SHARD = 8, 400, 16_384, 4096
#: Queries that meet a shard in one group, about; more are dealt to blocks, each with its copy of the shard.
ASKING = 20_000


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        for j in range(k):
            if (near == j).any():
                centres[j] = x[near == j].mean(0)
    return centres


def fit_tree(x: np.ndarray, leaf: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroids, first child, leaf number) by node, root first; the children of a node stand together; -1 where none."""
    centroids, first, count, number = [x.mean(0) if len(x) else np.zeros(0)], [-1], [0], [-1]
    todo, leaves = [(0, x)], 0
    while todo:
        at, part = todo.pop()
        k = min(BRANCH, len(part) // 2)
        near = None
        if len(part) > leaf and k > 1:
            centres = kmeans(part, k, 8, seed + at)
            near = (part @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
            used = np.unique(near)
        if near is None or len(used) < 2:
            number[at] = leaves
            leaves += 1
            continue
        first[at], count[at] = len(centroids), len(used)
        for j in used:
            todo.append((len(centroids), part[near == j]))
            centroids.append(centres[j])
            first.append(-1)
            count.append(0)
            number.append(-1)
    return np.array(centroids), np.array([first, count]).T, np.array(number)


def filed(x: np.ndarray, tree) -> np.ndarray:
    """The leaf of each vector: the nearest child, node by node."""
    centroids, kids, number = tree
    at = np.zeros(len(x), np.int64)
    while (inner := np.flatnonzero(kids[at, 0] >= 0)).size:
        for node in np.unique(at[inner]):
            rows = inner[at[inner] == node]
            f, n = kids[node]
            c = centroids[f : f + n]
            at[rows] = f + (x[rows] @ c.T - 0.5 * (c**2).sum(1)).argmax(1)
    return number[at]


def visited(q: np.ndarray, tree, most: int) -> list[list[int]]:
    """For each query the leaves in the order in which best-bin-first search meets them, at most `most`."""
    centroids, kids, number = tree
    out = []
    for scores in q @ centroids.T:
        heap, met = [(0.0, 0)], []
        while heap and len(met) < most:
            _, node = heapq.heappop(heap)
            f, n = kids[node]
            if f < 0:
                met.append(int(number[node]))
            else:
                for j in range(f, f + n):
                    heapq.heappush(heap, (-scores[j], j))
        out.append(met)
    return out


def best_of(q: np.ndarray, x: np.ndarray, ids: list, k: int, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of x for each of q, ties to the smaller id. ids: the ids of each vector, ascending.

    seen (queries, vectors) says what a query looks at. The product of matrices finds who may be among the k; their
    scores are then summed row by row, so that equal vectors have equal scores wherever they stand.
    """
    copies = np.array([min(len(i), k) for i in ids], np.int64)
    flat = np.array([name for i in ids for name in i[:k]], np.int64)
    first = np.cumsum(copies) - copies
    parts = []
    for i in range(0, len(q), 512):
        scores = q[i : i + 512] @ x.T
        if seen is not None:
            scores[~seen[i : i + 512]] = -np.inf
        cut = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), -np.inf)
        row, near = np.nonzero((scores >= (cut - 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(cut), cut, 0))))[:, None]) & np.isfinite(scores))
        exact = (x[near] * q[i + row]).sum(1)
        n = copies[near]
        row, exact = np.repeat(row, n), np.repeat(exact, n)
        name = flat[np.repeat(first[near] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        order = np.lexsort((name, -exact, row))
        row, name, exact = row[order], name[order], exact[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        parts.append((row[rank < k] + i, name[rank < k], exact[rank < k]))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def stacked(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where is_query holds, its k best of all other rows found.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without an
    id; rows that repeat an id with the same vector count once. With fewer than k candidates, all are returned; an
    empty table gives an empty result.
    """
    v = F.col(vector_col)
    fine = F.size(v) > 0
    fine &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = saved(rows, "vectors")
    # the least k + 1 ids of each distinct vector: one may be the query's own
    top = Window.partitionBy("v").orderBy("id")
    once = rows.select("id", "v").withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1)
    reps = saved(once.groupBy("v").agg(F.array_sort(F.array_distinct(F.collect_list("id"))).alias("ids")).withColumn("rep", F.col("ids")[0]), "reps")
    asked = rows.where("asks").select("id", "v").distinct().join(reps.select("v", "rep"), "v").select("id", "rep")
    asked = saved(asked, "asked")
    questions = reps.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "v")

    n = reps.count()
    # a share of the rows by hash: FIT_SAMPLE on average, and the same ones whenever this runs
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(min(1.0, FIT_SAMPLE / max(1, n)) * (1 << 30)) + 1
    x = stacked([r["v"] for r in sorted(reps.where(share).select("rep", "v").collect())])
    leaves = max(1, min(MOST_LEAVES, n // LEAF))
    tree = fit_tree(x, max(4, len(x) // leaves))
    number_of_leaves = int(tree[2].max()) + 1
    shared = vectors.sparkSession.sparkContext.broadcast(tree)  # bounded by MOST_LEAVES

    def file(it):
        out = pa.schema([("rep", pa.int64()), ("leaf", pa.int64()), ("v", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64()))])
        for b in it:
            leaf = filed(matrix(b.column(1)), shared.value)
            yield from batches(out, 10_000, {"rep": b.column(0), "leaf": leaf, "v": b.column(1), "ids": b.column(2)})

    index = saved(map_arrow(reps.select("rep", "v", "ids"), file, "rep long, leaf long, v array<double>, ids array<long>"), "index")

    trial = questions.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(CALIBRATION).collect()
    visits = number_of_leaves
    if len(trial) and number_of_leaves > 1:
        tq, names = stacked([r["v"] for r in trial]), [r["rep"] for r in trial]

        def blocks(it):
            out = pa.schema([("q", pa.int64()), ("id", pa.int64()), ("score", pa.float64()), ("leaf", pa.int64())])
            best: list = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
            for b in it:  # a task hands on its best alone
                ids, leaf = b.column(0).to_numpy(), b.column(2).to_numpy()
                row, place, score = best_of(tq, matrix(b.column(1)), [[i] for i in range(len(b))], k + 1)
                best = [np.concatenate(c) for c in zip(best, (row, ids[place], score, leaf[place]), strict=True)]
                order = np.lexsort((best[1], -best[2], best[0]))
                best = [c[order] for c in best]
                keep = np.arange(len(order)) - np.searchsorted(best[0], best[0]) <= k
                best = [c[keep] for c in best]
            yield from batches(out, 50_000, dict(zip(out.names, best, strict=True)))

        found = map_arrow(index.select("rep", "v", "leaf"), blocks, "q long, id long, score double, leaf long")
        ranked = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1)
        place = [{leaf: i for i, leaf in enumerate(met)} for met in visited(tq, tree, number_of_leaves)]
        depth = np.array([place[r["q"]][r["leaf"]] for r in ranked.collect() if r["id"] != names[r["q"]]])  # at most CALIBRATION * (k + 1)
        visits = 1
        while len(depth) and (depth < visits).mean() < recall and visits < number_of_leaves:
            visits = min(number_of_leaves, visits + max(1, visits // 8))

    sizes = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # at most MOST_LEAVES
    # leaves share a shard while they fit it; a larger leaf is cut into shards of its own
    begin, parts, shard, room = np.zeros(number_of_leaves, np.int64), np.ones(number_of_leaves, np.int64), 0, SHARD
    for leaf in range(number_of_leaves):
        n = sizes.get(leaf, 0)
        if n > room and room < SHARD:
            shard, room = shard + 1, SHARD
        begin[leaf], parts[leaf] = shard, max(1, -(-n // SHARD))
        shard, room = (shard + int(parts[leaf]), SHARD) if n > SHARD else (shard, room - n)
    lookup = lambda values: F.element_at(F.lit(np.array(values, np.int64)), (F.col("leaf") + 1).cast("int"))
    stored = index.withColumn("shard", lookup(begin) + F.pmod(F.xxhash64("rep"), lookup(parts)))

    def ask(it):
        out = pa.schema([("rep", pa.int64()), ("v", pa.list_(pa.float64())), ("shard", pa.int64()), ("leaves", pa.list_(pa.int64()))])
        for b in it:
            rows = []
            for i, met in enumerate(visited(matrix(b.column(1)), shared.value, visits) if len(b) else []):
                at: dict = {}
                for leaf in met:
                    for s in range(int(begin[leaf]), int(begin[leaf] + parts[leaf])):
                        at.setdefault(s, []).append(leaf)
                rows += [(i, s, leaves) for s, leaves in at.items()]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield from batches(out, 10_000, {"rep": b.column(0).take(take), "v": b.column(1).take(take), "shard": pa.array([r[1] for r in rows], pa.int64()), "leaves": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})

    block = max(1, -(-questions.count() // ASKING))
    part = F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(block)).cast("int")
    going = map_arrow(questions, ask, "rep long, v array<double>, shard long, leaves array<long>").withColumn("block", part)
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(block - 1))))

    def search(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or held.empty:
            return pd.DataFrame({"rep": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        mine, of = np.unique(held["leaf"].to_numpy(), return_inverse=True)
        sees = np.zeros((len(asking), len(mine)), bool)
        for i, leaves in enumerate(asking["leaves"]):
            sees[i] = np.isin(mine, leaves)
        x, ids, reps, found = stacked(held["v"]), [list(i) for i in held["ids"]], asking["rep"].to_numpy(), []
        for i in range(0, len(asking), 2048):
            row, name, score = best_of(stacked(asking["v"].iloc[i : i + 2048]), x, ids, k + 1, sees[i : i + 2048][:, of])
            found.append(pd.DataFrame({"rep": reps[i + row], "id": name, "score": score}))
        return pd.concat(found)

    met = going.groupBy("shard", "block").cogroup(stored.groupBy("shard", "block")).applyInPandas(search, "rep long, id long, score double")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "id")
    met = met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    every = asked.withColumnRenamed("id", "query_id").join(met, "rep").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
