"""Removal of byte strings that repeat anywhere in a corpus, by a hash-compared sort of suffixes.

Not every suffix travels. Of each window of `length` bytes, the least hash of its k-grams, the leftmost of equal ones, is
its anchor, so that equal windows have equal anchors at equal distances, wherever they stand. A stretch of windows with
one anchor is a region; only regions whose anchor's hash occurs twice are gathered by it, copies of a region as one.
There the suffixes at every window of every region are mergesorted, those at one distance from the anchor among each
other: prefix polynomial hashes and a binary search give the common extension of two suffixes, and so their order.
Windows repeat where sorted neighbours have `length` bytes in common. The order of all neighbours is verified byte by
byte; if hashes collided, the suffixes of the batch are sorted by their bytes.

An anchor with very many regions is cut into shards by the regions' bytes. Each shard hands on one entry for every
distinct window, and entries of different shards meet by a digest of the window.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import batches, byte_buffer, map_arrow, mixed, prefix_hashes, slabs

LENGTH, GRAM = 200, 32
#: Low bits of an anchor's hash that tell positions apart within a window; windows treated at once; region bytes sorted at once.
PLACE_BITS, SLAB, GATHER = 20, 1 << 19, 1 << 20
#: Regions of an anchor meant for a shard, and shards of an anchor at most (each then takes more).
SHARD, MOST_SHARDS = 2000, 1 << 16


def parts(offsets: np.ndarray, length: int = LENGTH):
    """(first text, end text, first byte, end byte, offset in the text) of what is treated at once: some texts, or the windows of a part of a long one."""
    for i, j in slabs(offsets, SLAB):
        size = int(offsets[j] - offsets[i])
        if size <= SLAB + length:
            yield i, j, int(offsets[i]), int(offsets[j]), 0
        else:
            for a in range(0, size - length + 1, SLAB):
                yield i, j, int(offsets[i]) + a, int(offsets[i]) + min(size, a + SLAB + length - 1), a


def regions(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(key, document, first window, last window, anchor) of every region of texts that lie one after another, of at most 2^PLACE_BITS bytes.

    Positions count from the start of data.
    """
    none = (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 4
    n = len(data)
    if n < length:
        return none
    h, down = prefix_hashes(data)
    grams = n - gram + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    v = mixed((h[gram:] - h[:grams]) * down[:grams]) & ~low
    v |= np.arange(grams, dtype=np.uint64) & low
    width, size = length - gram + 1, 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < width:
        v = np.minimum(v[: len(v) - (width - size)], v[width - size :])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(np.arange(len(v)) + length <= ends[: len(v)])
    if not len(at):
        return none
    v = v[at]
    new = np.ones(len(at), bool)
    new[1:] = v[1:] != v[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    doc = np.searchsorted(offsets, at[first], "right") - 1
    return mixed(v[first] >> np.uint64(PLACE_BITS)), doc, at[first], at[last], (v[first] & low).astype(np.int64)


def common_extension(h: np.ndarray, down: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes, at most `most`, the suffixes at a and b share: a binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
    for _ in range(int(high.max(initial=0)).bit_length()):
        mid = (low + high + 1) >> 1
        same = (h[a + mid] - h[a]) * down[a] == (h[b + mid] - h[b]) * down[b]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_order(data: np.ndarray, h: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A stable mergesort of data[start:end] within each group, all groups at once.

    A comparison finds the common extension and looks at the byte after it, so that it costs the logarithm of the
    length. Runs of doubling width are merged: an element's place is its rank in its run and, by binary search, in the other.
    """
    order = np.argsort(group, kind="stable")
    sizes = np.unique(group[order], return_counts=True)[1]
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    padded = np.append(data, 0)

    def before(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        a, b = starts[x], starts[y]
        left, right = ends[x] - a, ends[y] - b
        m = common_extension(h, down, a, b, np.minimum(left, right))
        end = (m == left) | (m == right)
        return np.where(end, (left < right) | (or_equal & (left == right)), padded[a + m] < padded[b + m])

    width = 1
    while width < (sizes.max() if len(sizes) else 0):
        i = np.flatnonzero(size > width)
        rank = i - base[i]
        run = rank // width
        second = run % 2 == 1
        other = (run ^ 1) * width
        low = np.minimum(other, size[i])
        begin, high = low.copy(), np.minimum(other + width, size[i])
        mine = order[i]
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            # equal suffixes keep their order: what comes from the second run stays behind
            less = before(order[base[i[open_]] + mid], mine[open_], second[open_])
            low[open_] = np.where(less, mid + 1, low[open_])
            high[open_] = np.where(less, high[open_], mid)
        merged_at = base[i] + (run // 2) * 2 * width + rank % width + (low - begin)
        new = order.copy()
        new[merged_at] = mine
        order, width = new, 2 * width
    return order


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, the first one lowest; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data) + 1, np.uint64)
    for j in range(8):
        out |= padded[j : j + len(data) + 1] << np.uint64(8 * j)
    return out


_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def agree(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, length: int) -> np.ndarray:
    """Whether the first `most` bytes at a and b are the same, byte by byte."""
    out = np.ones(len(a), bool)
    last = len(words) - 1
    for i in range(0, length, 8):
        mask = _MASKS[np.clip(most - i, 0, 8)]
        out &= ((words[np.minimum(a + i, last)] ^ words[np.minimum(b + i, last)]) & mask) == 0
    return out


def classes(texts: list[bytes], anchors: np.ndarray, groups: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, class) of every window: windows of a group at one distance from their anchors have one class if their bytes are the same.

    The suffixes are sorted, and what sorted neighbours have in common decides.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(0, sizes - length + 1)
    text = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = start + (np.cumsum(sizes) - sizes)[text]
    place = np.unique(groups[text] * (2 * length) + anchors[text] - start, return_inverse=True)[1]
    h, down = prefix_hashes(data)
    order = suffix_order(data, h, down, at, at + length, place)
    x, y = order[:-1], order[1:]
    pair = place[x] == place[y]
    most = np.full(len(x), length)
    shared = np.where(pair, common_extension(h, down, at[x], at[y], np.where(pair, most, 0)), 0)
    words = words_at(data)
    # neighbours agree as far as their hashes say, and the byte after that rises: then the order is that of the bytes
    sure = agree(words, at[x], at[y], shared, length)
    rises = (shared == length) | (data[np.minimum(at[x] + shared, len(data) - 1)] < data[np.minimum(at[y] + shared, len(data) - 1)])
    same = pair & (shared == length)
    if not (sure & (rises | ~pair)).all():
        raw = data.tobytes()
        order = np.array(sorted(range(len(at)), key=lambda i: (place[i], raw[at[i] : at[i] + length])), np.int64)
        x, y = order[:-1], order[1:]
        same = (place[x] == place[y]) & agree(words, at[x], at[y], most, length)
    name = np.empty(len(at), np.int64)
    name[order] = np.cumsum(np.concatenate([[0], ~same])) if len(at) else 0
    return text, start, name


def _anchor_kernel(it):
    out = pa.schema([("key", pa.int64()), ("row_id", pa.int64()), ("n", pa.int64())])
    for b in it:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        data, offsets = byte_buffer(b.column(2))
        for i, j, first, end, _ in parts(offsets):
            key, doc, *_ = regions(data[first:end], np.clip(offsets[i : j + 1], first, end) - first)
            # one row for each anchor of a text
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            total = np.diff(np.append(np.flatnonzero(new), len(key)))
            yield from batches(out, 50_000, {"key": key[new].view(np.int64), "row_id": ids[i:j][doc[new]], "n": total})


def _region_kernel(it):
    out = pa.schema([("key", pa.int64()), ("shard", pa.int32()), ("cut", pa.bool_()), ("region", pa.binary()), ("anchor", pa.int64()), ("rows", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))])
    for b in it:
        ids = b.column(0).to_pylist()
        keys = b.column(3)
        bounds = np.cumsum([0, *(len(x) for x in keys)])
        wanted = keys.flatten()
        wanted, shards = wanted.field("key").to_numpy(zero_copy_only=False), wanted.field("shards").to_numpy(zero_copy_only=False)
        data, offsets = byte_buffer(b.column(2))
        for i, j, begin, end, within in parts(offsets):
            part = data[begin:end]
            base = np.clip(offsets[i : j + 1], begin, end) - begin
            key, doc, first, last, anchor = regions(part, base)
            # a text's wanted anchors, told apart from those of others by its number
            of = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
            keep, place = _within(doc, key.view(np.int64), of, wanted[bounds[i] : bounds[j]])
            split = shards[bounds[i] : bounds[j]][place]
            found: dict = {}
            raw = part.tobytes()
            for k, n, d, f, z, m in zip(key.view(np.int64)[keep].tolist(), split.tolist(), doc[keep].tolist(), first[keep].tolist(), last[keep].tolist(), anchor[keep].tolist(), strict=True):
                at = found.setdefault((k, n, raw[f : z + LENGTH], m - f), ([], []))
                at[0].append(ids[i + d])
                at[1].append(f - int(base[d]) + within)
            columns = list(zip(*((k, zlib.crc32(r) % n, n > 1, r, m, rows, starts) for (k, n, r, m), (rows, starts) in found.items()), strict=True)) or [()] * 7
            yield from batches(out, 2000, {f.name: pa.array(list(c), f.type) for f, c in zip(out, columns, strict=True)})


def _within(doc: np.ndarray, key: np.ndarray, of: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the (document, key) pairs that are wanted, and where each stands among those (distinct pairs of, want)."""
    order = np.lexsort((want, of))
    names, number = np.unique(np.concatenate([want, key]), return_inverse=True)
    have, asked = doc * len(names) + number[len(want) :], of[order] * len(names) + number[: len(want)][order]
    at = np.searchsorted(asked, have)
    keep = np.flatnonzero(asked[np.minimum(at, len(asked) - 1)] == have) if len(asked) else np.zeros(0, np.int64)
    return keep, order[at[keep]]


def _solved(held: list):
    """(row, start, end, digest) columns for gathered regions (group, cut, region, anchor, rows, starts), a group's together.

    A span has no digest. Of an anchor that is cut into shards every distinct window has an entry with its digest: a
    window seen once with its row and start, one that repeats within the shard without.
    """
    groups = np.array([g for g, *_ in held], np.int64)
    times = np.array([len(rows) for *_, rows, _ in held], np.int64)
    several = np.bincount(groups)[groups] > 1
    cut = np.array([c for _, c, *_ in held], bool)
    sort = np.flatnonzero(several | cut)
    texts = [held[i][2] for i in sort.tolist()]
    text, start, name = classes(texts, np.array([held[i][3] for i in sort.tolist()], np.int64), groups[sort]) if len(sort) else (np.zeros(0, np.int64),) * 3
    hit = np.bincount(name, times[sort][text])[name] > 1 if len(name) else np.zeros(0, bool)
    # maximal stretches of hits within a text
    begins = hit & np.concatenate([[True], ~hit[:-1] | (text[1:] != text[:-1])])[: len(hit)]
    ends = hit & np.concatenate([~hit[1:] | (text[1:] != text[:-1]), [True]])[: len(hit)]
    found = list(zip(sort[text[begins]].tolist(), start[begins].tolist(), (start[ends] + LENGTH).tolist(), strict=True))
    # a lone region repeats as a whole if it occurs twice
    found += [(i, 0, len(held[i][2])) for i in np.flatnonzero(~(several | cut) & (times > 1)).tolist()]
    out = [(row, at + a, at + z, None) for i, a, z in found for row, at in zip(held[i][4], held[i][5], strict=True)]
    open_ = np.flatnonzero(cut[sort][text])
    if len(open_):
        once = open_[np.unique(name[open_], return_index=True)[1]]
        for t, s, h in zip(text[once].tolist(), start[once].tolist(), hit[once].tolist(), strict=True):
            _, _, region, _, rows, starts = held[sort[t]]
            digest = hashlib.blake2b(region[s : s + LENGTH], digest_size=16).digest()
            out.append((None, None, None, digest) if h else (rows[0], starts[0] + s, starts[0] + s + LENGTH, digest))
    return list(zip(*out, strict=True)) or [()] * 4


def _sort_kernel(it):
    """Rows in the order of key and shard: some groups at a time, cut between them."""
    out = pa.schema([("row_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.binary())])

    def solve(held: dict):
        flat = [(g, cut, r, m, rows, starts) for g, regions_of in enumerate(held.values()) for (r, m), (cut, rows, starts) in regions_of.items()]
        columns = _solved(flat) if flat else [()] * 4
        yield from batches(out, 50_000, {f.name: pa.array(list(c), f.type) for f, c in zip(out, columns, strict=True)})

    held: dict = {}
    size, now = 0, None
    for b in it:
        for k, shard, cut, r, m, of, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (k, shard) != now and size > GATHER:
                yield from solve(held)
                held, size = {}, 0
            now = k, shard
            mine = held.setdefault(now, {})
            if (r, m) in mine:
                mine[r, m][1].extend(of)
                mine[r, m][2].extend(at)
            else:
                mine[r, m] = (cut, of, at)
                size += len(r)
    yield from solve(held)


def spans_of(rows: DataFrame) -> DataFrame:
    """(row_id, spans): the intervals of bytes to remove. rows: row_id, kept (anything), text; a text without a repeat has no row.

    rows is partitioned by row_id, and nothing but it is asked for, so that one shuffle of the texts serves all uses.
    """
    rows = rows.select("row_id", "kept", "text")
    anchors = map_arrow(rows, _anchor_kernel, "key long, row_id long, n long")
    twice = anchors.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key", F.least(F.ceil(F.col("n") / SHARD), F.lit(MOST_SHARDS)).cast("int").alias("shards"))
    wanted = anchors.select("key", "row_id").join(twice, "key").groupBy("row_id").agg(F.collect_set(F.struct("key", "shards")).alias("keys"))
    gathered = map_arrow(rows.join(wanted, "row_id").select("row_id", "kept", "text", "keys"), _region_kernel, "key long, shard int, cut boolean, region binary, anchor long, rows array<long>, starts array<long>")
    found = map_arrow(gathered.repartition("key", "shard").sortWithinPartitions("key", "shard"), _sort_kernel, "row_id long, start long, end long, digest binary")
    # windows of a cut anchor that other shards have too; a span is alone with itself
    meet = F.coalesce(F.hex("digest"), F.concat_ws(":", "row_id", "start"))
    met = found.withColumn("n", F.count("*").over(Window.partitionBy(meet))).where("row_id is not null and (digest is null or n > 1)")
    return met.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _with_spans(docs: DataFrame, others: list[str], text_col: str) -> DataFrame:
    """(row_id, kept, text, spans) of every row; kept is a struct of the other columns.

    Rows are numbered once, before the only shuffle of the texts, which all later steps of the query read.
    """
    kept = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others])
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), kept.alias("kept"), F.col(f"`{text_col}`").cast("string").alias("text")).repartition("row_id")
    return rows.join(spans_of(rows), "row_id", "left").select("row_id", "kept", "text", "spans")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256 [, kept]) of every row: each byte that a repeated string covers goes.

    Texts are UTF-8 bytes, null is empty, and matches never cross texts; rows that repeat are repeats of one another.
    kept is the remaining bytes; what a cut leaves of a character is in it.
    """
    kind = docs.schema[id_col].dataType
    fields = [("id", to_arrow_type(kind)), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.binary())] * keep_text

    def kernel(it):
        for b in it:
            data, offsets = byte_buffer(b.column(2))
            raw, cols = memoryview(data), [[] for _ in range(5)]
            for i, found in enumerate(b.column(3).to_pylist()):
                text = raw[offsets[i] : offsets[i + 1]]
                gone = merged((s["start"], s["end"]) for s in found or ())
                at, kept = 0, []
                for a, z in gone:
                    kept.append(text[at:a])
                    at = z
                kept = b"".join([*kept, text[at:]])
                for col, x in zip(cols, (len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([b.column(1).field(1).cast(fields[0][1]), *(pa.array(c, t) for c, (_, t) in zip(cols, fields[1:], strict=False))], schema=pa.schema(fields))

    schema = T.StructType([T.StructField("id", kind), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256", T.StringType())] + [T.StructField("kept", T.BinaryType())] * keep_text)
    return map_arrow(_with_spans(docs, [id_col], text_col), kernel, schema)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated strings cut out of the texts; a character that a cut divides goes. Null texts stay null. Other columns, whatever their names, stay as they are."""
    others = [c for c in docs.columns if c != text_col]

    def kernel(it):
        for b in it:
            data, offsets = byte_buffer(b.column(2))
            raw, null, left = memoryview(data), b.column(2).is_null().to_pylist(), []
            for i, found in enumerate(b.column(3).to_pylist()):
                text, last, pieces = raw[offsets[i] : offsets[i + 1]], 0, []
                for a, z in merged((s["start"], s["end"]) for s in found or ()):
                    pieces.append(bytes(text[last:a]).decode("utf-8", "ignore"))
                    last = z
                pieces.append(bytes(text[last:]).decode("utf-8", "ignore"))
                left.append(None if null[i] else "".join(pieces))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(left, pa.string())], names=["kept", "text"])

    cut = _with_spans(docs, others, text_col)
    done = map_arrow(cut, kernel, T.StructType([cut.schema["kept"], T.StructField("text", T.StringType())]))
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("kept").getField(c).alias(c) for c in docs.columns])
