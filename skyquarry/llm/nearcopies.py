"""Exact similarity of word-shingle sets: verification of candidate pairs, and the pairs that fingerprints cannot promise.

Two sets have a Jaccard similarity of 4/5 or more when they share 4/9 of their elements together. With every set sorted
in one order of all shingles, two such sets have their first common shingle among the first n - ceil(4n/5) + 1 of each
(n: size of the set), so only texts that share one of these meet (prefix filter); then the sets themselves are
compared. The order puts shingles that many texts have last; it is taken from a sample and changes only who meets needlessly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquarry.llm.common import batches, map_arrow, saved
from skyquarry.llm.graph import components

SHINGLE = 5
#: Texts that tell which shingles are frequent (a bounded sample), from how many of them on, and how many shingles count as such.
ORDER_TEXTS, ORDER_LEAST, ORDER_MOST = 20_000, 8, 1 << 16
#: Bits of the filter that spares texts whose sets nobody asks for; what passes it is joined exactly.
FILTER_BITS = 20
#: Bits of the shortest and the longest sketch, whose differences tell that two sets cannot be similar; bytes of a hash that are compared.
LEAST_BITS, MOST_BITS, ELEMENT = 512, 8192, 5
#: Points meant for a block of a key's points, and bytes of sketches that a task compares at once.
BLOCK, SKETCHED = 1024, 4 << 20
#: Sets that a task remembers so as to hand on a repeated one only once.
REMEMBERED = 1 << 18
#: Points of its key with which a point is compared before all pairs are that are not connected by then.
NEXT = 2


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct XXH64 (seed 42) of the word shingles of an A-Z lower-cased text; a shorter text is one shingle, and one without words has none."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(line, 42)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    return np.unique(np.array([xxh64_intdigest(line[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64))


def point(grams: np.ndarray) -> int:
    """The name of a set of shingles, a signed long."""
    from xxhash import xxh64_digest

    return int.from_bytes(xxh64_digest(grams.tobytes(), 42), "big", signed=True)


def similar(common: Column, a: Column, b: Column) -> Column:
    """Whether sets of a and b elements with so many in common have a Jaccard similarity of 4/5 at least."""
    return common * 9 >= (a + b) * 4


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{text_col}`").cast("string"))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.pmod(text_hash(text_col), F.lit(1 << FILTER_BITS)).cast("int").alias("slot"))


def _sets(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """grams of every row."""

    def kernel(it):
        for batch in it:
            found = [shingles(t, shingle) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["grams"])

    return map_arrow(_texts(docs, text_col), kernel, "grams array<long>")


def packed(grams: np.ndarray) -> bytes:
    """The first ELEMENT bytes of each hash."""
    return grams.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT].tobytes()


def elements(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // ELEMENT, 8), np.uint8)
    out[:, 8 - ELEMENT :] = np.frombuffer(data, np.uint8).reshape(-1, ELEMENT)
    return out.view(">u8").ravel()


def _packed(docs: DataFrame, text_col: str, shingle: int, wanted: np.ndarray) -> DataFrame:
    """(point, n, grams) of every row whose slot is wanted; of a set that a task meets again soon only the first."""

    def kernel(it):
        out = pa.schema([("point", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])
        seen: set = set()
        for batch in it:
            rows = []
            for i in np.flatnonzero(wanted[batch.column(1).to_numpy(zero_copy_only=False)]).tolist():
                grams = shingles(batch.column(0)[i].cast(pa.binary()).as_py(), shingle)
                name = point(grams)
                if name not in seen:
                    seen.add(name)
                    rows.append((name, len(grams), packed(grams)))
            if len(seen) > REMEMBERED:
                seen = set()
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield from batches(out, 1000, {f.name: pa.array(list(c), f.type) for f, c in zip(out, columns, strict=True)})

    return map_arrow(_texts(docs, text_col), kernel, "point long, n long, grams binary")


def _frequent(docs: DataFrame, text_col: str, shingle: int, n: int) -> np.ndarray:
    """Shingles that many sampled texts have, the most frequent last."""
    share = int(min(1.0, ORDER_TEXTS / max(1, n)) * (1 << 30))
    some = docs.where(F.pmod(text_hash(text_col), F.lit(1 << 30)) < share)
    counts = _sets(some, text_col, shingle).select(F.explode("grams").alias("h")).groupBy("h").count().where(F.col("count") >= ORDER_LEAST)
    top = counts.orderBy(F.desc("count"), "h").limit(ORDER_MOST).collect()  # at most ORDER_MOST longs
    return np.array([r["h"] for r in reversed(top)], np.int64).view(np.uint64)


def prefix(grams: np.ndarray, names: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n/5) + 1 of a set: rare shingles by value, then the frequent ones (names, sorted) by rank."""
    n = len(grams)
    if not n:
        return grams
    rank = np.zeros(n, np.int64)
    if len(names):
        at = np.minimum(np.searchsorted(names, grams), len(names) - 1)
        rank = np.where(names[at] == grams, ranks[at] + 1, 0)
    return grams[np.lexsort((grams, rank))][: n - -(-4 * n // 5) + 1]


def _prefixes(docs: DataFrame, text_col: str, shingle: int, frequent: np.ndarray) -> DataFrame:
    """(key, point, place): the prefix of every set; place has the set's size in its upper half and the shingle's position in its lower."""
    ranks = np.argsort(frequent)
    names = frequent[ranks]

    def kernel(it):
        out = pa.schema([("key", pa.int64()), ("point", pa.int64()), ("place", pa.int64())])
        seen: set = set()
        for batch in it:
            sets = {}
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                grams = shingles(text, shingle)
                name = point(grams)
                if name not in seen and len(grams):
                    sets[name] = prefix(grams, names, ranks), len(grams)
            seen.update(sets)
            if len(seen) > REMEMBERED:
                seen = set()
            if sets:
                size = [len(k) for k, _ in sets.values()]
                place = np.concatenate([np.arange(len(k), dtype=np.int64) + (n << 32) for k, n in sets.values()])
                yield from batches(out, 50_000, {"key": np.concatenate([k for k, _ in sets.values()]).view(np.int64), "point": np.repeat(np.array(list(sets), np.int64), size), "place": place})

    return map_arrow(_texts(docs, text_col), kernel, "key long, point long, place long")


def sketch(grams: np.ndarray) -> bytes:
    """Of each of some bins, whether an odd number of elements falls into it. The bins are two for each element, up to a power of two."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(grams) - 1).bit_length() if len(grams) else 0))
    odd = np.bincount((grams >> np.uint64(16)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(sketches: list[bytes], words: int) -> np.ndarray:
    """Sketches of so many 64-bit words, or of twice as many, with so many: halves of bins fall together, and so do their parities."""
    out = np.empty((len(sketches), words), np.uint64)
    long = np.array([len(x) > 8 * words for x in sketches], bool)
    for twice in (False, True):
        at = np.flatnonzero(long == twice)
        flat = np.frombuffer(b"".join(sketches[i] for i in at.tolist()), np.uint64).reshape(len(at), words << twice)
        out[at] = flat[:, :words] ^ flat[:, words:] if twice else flat
    return out


def _far(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets (rows of sketches, sizes together) differ in more than a ninth of their elements: bins of other parity hold each an element that one set alone has."""
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64) * 9 > sizes


def _fitting(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs that may be similar, by their sizes and sketches. points: point, n, sketch."""

    def kernel(it):
        for b in it:
            n, m = (b.column(k).to_numpy(zero_copy_only=False) for k in (4, 5))
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            keep = np.minimum(n, m) * 5 >= np.maximum(n, m) * 4
            words = np.minimum([len(v) for v in x], [len(v) for v in y]) // 8
            for w in np.unique(words[keep]).tolist():
                at = np.flatnonzero(keep & (words == w))
                keep[at] = ~_far(_folded([x[i] for i in at.tolist()], w), _folded([y[i] for i in at.tolist()], w), (n + m)[at])
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["a", "b"])

    one = lambda c: points.select(F.col("point").alias(c), F.col("sketch").alias(f"s{c}"), F.col("n").alias(f"n{c}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "sa", "sb", "na", "nb")
    return map_arrow(both, kernel, "a long, b long")


def _compared(it):
    """Pairs whose sets are similar, of rows (a, b, point, n, grams) in the order of pairs."""
    held: dict = {}
    now = None

    def judged():
        if len(held) == 2:
            (n, x), (m, y) = held.values()
            common = len(np.intersect1d(elements(x), elements(y), assume_unique=True))
            return common * 9 >= (n + m) * 4
        return False

    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in it:
        found = []
        for a, b, point, n, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, b) != now:
                if judged():
                    found.append(now)
                held, now = {}, (a, b)
            held[point] = n, grams
        yield from batches(out, 50_000, {"a": np.array([a for a, _ in found], np.int64), "b": np.array([b for _, b in found], np.int64)})
    if judged():
        yield from batches(out, 1, {"a": np.array([now[0]], np.int64), "b": np.array([now[1]], np.int64)})


def verified(pairs: DataFrame, docs: DataFrame, text_col: str, marks: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of points whose sets are similar. marks: point and h (hash of the text) of docs.

    Sets travel as the first ELEMENT bytes of each hash.
    """
    pairs = saved(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    asks = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("point"))
    need = asks.select("point").distinct()
    slots = marks.join(need, "point", "left_semi").select(F.pmod("h", F.lit(1 << FILTER_BITS)).cast("int").alias("slot")).distinct().toArrow()
    wanted = np.zeros(1 << FILTER_BITS, bool)
    wanted[slots["slot"].to_numpy()] = True  # at most 2^FILTER_BITS small integers
    # one row a point first: copies in many tasks must not multiply with the pairs
    sets = _packed(docs, text_col, shingle, wanted).dropDuplicates(["point"])
    rows = asks.join(sets, "point").select("a", "b", "point", "n", "grams")
    rows = rows.repartition("a", "b").sortWithinPartitions("a", "b")
    return saved(map_arrow(rows, _compared, "a long, b long"), "links")


def _fit(x: Column, y: Column) -> Column:
    """Whether two sets with one key may be similar, by their places: their sizes and the key's position in the order."""
    (n, i), (m, j) = ((F.shiftright(c, 32), c.bitwiseAND(F.lit((1 << 32) - 1))) for c in (x, y))
    # of the first common shingle on, no more can be in common
    return (F.least(n, m) * 5 >= F.greatest(n, m) * 4) & similar(F.least(n - i, m - j), n, m)


def _pair(x: Column, y: Column) -> tuple[Column, Column]:
    """(a, b): a pair in one order, so that it counts once."""
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _blocks(rest: DataFrame, points: DataFrame) -> DataFrame:
    """(key, low, high, block, point, place, root, sketch): the points of each key in blocks of some BLOCK, each pair of which is a group.

    A key of few points is one group. rest: key, point, place, root, met (how many points the key has).
    """
    blocks = F.ceil(F.col("met") / BLOCK).cast("int")
    cut = rest.join(points.select("point", "sketch"), "point").withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("point"), blocks).cast("int")})
    other = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = other.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "point", "place", "root", "sketch")
    return groups.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


def _meeting(group, block, across, point, place, root, sketches) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) of points of one group and several roots that may be similar, by sizes, positions and sketches. Rows of a group stand together; across: its pairs are those of two blocks."""
    size, position = place >> 32, place & ((1 << 32) - 1)
    words = np.array([len(x) // 8 for x in sketches], np.int64)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for w in np.unique(words).tolist():
        # sets of similar size have sketches of one length, or of one and its double
        mine = np.flatnonzero((words == w) | (words == 2 * w))
        sketch = _folded([sketches[i] for i in mine.tolist()], w)
        of, at, k = group[mine], np.arange(len(mine)), 1
        while True:  # each row with the k-th after it, as long as a group has so many
            at = at[at + k < len(mine)]
            at = at[of[at] == of[at + k]]
            if not len(at):
                break
            x, y = mine[at], mine[at + k]
            n, m = size[x], size[y]
            # of the first common shingle on, no more can be in common
            apt = (root[x] != root[y]) & (np.minimum(words[x], words[y]) == w) & (~across[x] | (block[x] != block[y]))
            apt &= (np.minimum(n, m) * 5 >= np.maximum(n, m) * 4) & (np.minimum(n - position[x], m - position[y]) * 9 >= (n + m) * 4)
            apt[apt] = ~_far(sketch[at[apt]], sketch[at[apt] + k], (n + m)[apt])
            left.append(point[x[apt]])
            right.append(point[y[apt]])
            k += 1
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b)


def _met(it):
    """Pairs (a, b) of the rows of _blocks, whole groups at a time."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compared(rows: pa.Table):
        key, low, high, block, point, place, root = (rows.column(k).to_numpy() for k in range(7))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        pairs = np.unique(np.stack(_meeting(np.cumsum(new), block, low != high, point, place, root, rows.column(7).to_pylist())), axis=1)
        yield from batches(out, 50_000, {"a": pairs[0], "b": pairs[1]})

    held, size = [], 0
    for batch in it:
        if not len(batch):
            continue
        held.append(batch)
        size += batch.column(7).nbytes
        if size > SKETCHED:
            rows = pa.Table.from_batches(held)
            ends = rows.slice(len(rows) - 1).select([0, 1, 2]).to_pylist()[0]
            last = np.logical_and.reduce([rows.column(k).to_numpy() == v for k, v in enumerate(ends.values())])
            first = int(np.flatnonzero(last)[0])
            if first:
                yield from compared(rows.slice(0, first))
                held = rows.slice(first).combine_chunks().to_batches()
                size = sum(b.column(7).nbytes for b in held)
    if held:
        yield from compared(pa.Table.from_batches(held))


def _introduced(apart: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that may be similar: each point with the least of its key, and with the NEXT before it in an order of its key's own.

    As every key has another order, a set with copies meets some of them whatever the least one is like, and a cluster
    costs its size. apart: key, point, place, root, band.
    """
    one = F.struct("root", "point", "place")
    row = Window.partitionBy("key", "band").orderBy(F.xxhash64("key", "point"), "point")
    others = F.array(F.min(one).over(Window.partitionBy("key")), *[F.lag(one, k).over(row) for k in range(1, NEXT + 1)])
    met = apart.withColumn("others", others)
    apt = F.filter("others", lambda x: x.isNotNull() & (x["root"] != F.col("root")) & _fit(x["place"], F.col("place")))
    return met.select("point", F.explode(F.transform(apt, lambda x: x["point"])).alias("other")).select(*_pair(F.col("point"), F.col("other"))).distinct()


def completed(docs: DataFrame, text_col: str, marks: DataFrame, points: DataFrame, known: DataFrame, n: int, shingle: int = SHINGLE) -> DataFrame:
    """(a, b): known links and as many more as connect exactly what all similar pairs of points would.

    Prefixes are shuffled once, by shingle. A point is first compared with the least of each of its shingles and with
    some others, so that a cluster costs no more than its size. Then the points of a shingle that are not connected yet
    meet in blocks: a task compares the sketches of all pairs of two blocks, and only pairs that these cannot tell
    apart become rows, whose sets are compared.
    """
    key = Window.partitionBy("key")
    rows = _prefixes(docs, text_col, shingle, _frequent(docs, text_col, shingle, n))
    shared = rows.withColumns({"lead": F.min("point").over(key), "last": F.max("point").over(key)}).where("lead < last")
    shared = saved(shared.select("key", "point", "place").distinct(), "shared")

    def named(links: DataFrame) -> DataFrame:
        """shared with the root of each point, where a key has several roots."""
        if not links.isEmpty():
            root = components(links)
            found = shared.join(root, F.col("point") == F.col("node"), "left").select("key", "point", "place", F.coalesce("root", "point").alias("root"))
        else:
            found = shared.withColumn("root", F.col("point"))
        return found.withColumns({"lo": F.min("root").over(key), "hi": F.max("root").over(key), "met": F.count("*").over(key)}).where("lo < hi").drop("lo", "hi")

    band = F.floor(F.log(F.shiftright("place", 32)) / float(np.log(1.25))).cast("int")
    apart = saved(named(known).withColumn("band", band), "apart")
    first = verified(_fitting(_introduced(apart), points), docs, text_col, marks, shingle)
    both = saved(known.union(first), "links")
    rest = saved(named(both), "rest")
    pairs = map_arrow(_blocks(rest, points), _met, "a long, b long").distinct()
    return both.union(verified(pairs, docs, text_col, marks, shingle))
