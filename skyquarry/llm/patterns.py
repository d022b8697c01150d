"""Shortest-pack-first packing of token sequences over the histogram of their lengths.

Only counts of lengths, at most the capacity each, decide the packing. Lengths are placed longest first, each time into
the shortest pack (that with most room) which takes it; packs alike are one pattern with a count, and a step moves as
many packs at once as pattern and length have. What is open at the end is closed by cuts: the shortest packs are taken
apart, their pieces, laid end to end, are cut to fill the others' room, and what is left over is cut into powers of two,
which need no padding. Patterns are then joined back to the documents: each holds ranges of ranks, and a document's
piece has a rank among those of its length. The plan's size is bounded by the capacity, whatever the corpus.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import map_arrow, saved, worker_cache

CAPACITY = 1024
#: Characters of a text that are encoded at once, where it can be cut; bytes of ids that leave a task together.
STRETCH, LEAVING = 1 << 20, 4 << 20
#: The split of byte-level encodings: a fixed value of their public description.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: (length, first rank): the piece of rank first + i of that length is in the i-th pack.
Item = tuple[int, int]


def moved(items: list[Item], n: int) -> list[Item]:
    return [(length, rank + n) for length, rank in items]


def shortest_first(counts: dict[int, int], capacity: int) -> list[tuple[int, int, list[Item]]]:
    """(number, room, items) of the patterns."""
    open_: dict[int, list[tuple[int, list[Item]]]] = {}
    rooms: list[int] = []  # those of open_, negated, as a heap

    def keep(room: int, number: int, items: list[Item]) -> None:
        if number:
            if not open_.get(room):
                open_[room] = []
                heapq.heappush(rooms, -room)
            open_[room].append((number, items))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            while rooms and not open_.get(-rooms[0]):
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room < length:
                # no pack takes it: as many new ones as these pieces fill, and one for the rest
                each = capacity // length
                n = left // each
                keep(capacity - each * length, n, [(length, rank + j * n) for j in range(each)])
                few = left - each * n
                keep(capacity - few * length, bool(few), [(length, rank + each * n + j) for j in range(few)])
                break
            number, items = open_[room].pop()
            n = min(number, left)
            keep(room, number - n, moved(items, n))
            keep(room - length, n, [*items, (length, rank)])
            rank, left = rank + n, left - n
    return [(number, room, items) for room, packs in open_.items() for number, items in packs]


def givers(packs: list[tuple[int, int, list[Item]]], capacity: int, slack: int) -> tuple[list, list, list]:
    """Packs that stay as they are, packs to fill and packs to take apart.

    A pack stays if it has room for at most slack tokens, or has a power of two of them. Of the others the shortest are taken
    apart, as many as fill the rest; the last one is a single pack, of which something is left over.
    """
    stays = lambda room: room <= slack or (capacity - room) & (capacity - room - 1) == 0
    line = sorted((p for p in packs if not stays(p[1])), key=lambda p: p[1])
    need, apart = sum(n * room for n, room, _ in line), []
    while need:
        n, room, items = line.pop()
        x = min(n, need // capacity) or 1
        apart.append((x, room, items))
        if n > x:
            line.append((n - x, room, moved(items, x)))
        need = max(0, need - x * capacity)
    return [p for p in packs if stays(p[1])], line, apart


def plan(counts: dict[int, int], capacity: int = CAPACITY, slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(runs, rooms), both in order.

    runs: length, first rank, pack, offset and stream. The piece of rank first + i lies in pack + i at offset; where pack is
    -1 it is of a pack taken apart, and begins at stream + i * length of all those pieces, laid end to end.
    rooms: stream, size, pack, offset. From there on, the stream fills rooms of that size in pack, pack + 1 and so on, at offset.
    Packs are numbered from 0 without a gap. A pack with room for at most slack tokens is left as it is.
    """
    closed, line, apart = givers(shortest_first(counts, capacity), capacity, slack)
    runs, rooms, packs, stream = [], [], 0, 0
    for n, room, items in [*closed, *line]:
        offset = 0
        for length, rank in items:
            runs.append((length, rank, packs, offset, 0))
            offset += length
        packs += n
    first = sum(n for n, *_ in closed)
    for n, room, _ in line:
        rooms.append((stream, room, first, capacity - room))
        first, stream = first + n, stream + n * room
    laid = 0
    for n, _, items in apart:
        for length, rank in items:
            runs.append((length, rank, -1, 0, laid))
            laid += n * length
    left = laid - stream  # less than a pack: into sequences of powers of two
    while left > 0:
        size = 1 << (left.bit_length() - 1)
        rooms.append((stream, size, packs, 0))
        packs, stream, left = packs + 1, stream + size, left - size
    return np.array(sorted(runs), np.int64).reshape(-1, 5), np.array(rooms, np.int64).reshape(-1, 4)


def parts(a: int, length: int, rooms: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, size, pack, offset) of the parts of a piece that begins at a of the stream."""
    out, x = [], a
    while x < a + length:
        stream, size, pack, offset = rooms[np.searchsorted(rooms[:, 0], x, "right") - 1].tolist()
        full, within = divmod(x - stream, size)
        n = min(size - within, a + length - x)
        out.append((x - a, n, pack + full, offset + within))
        x += n
    return out


class Encoder:
    """Token ids of texts as the tokenizer's file gives them.

    A byte-level encoding whose merges stand in the order of their ids is run by its ranks, which is some five times
    faster and gives the same ids; any other is run as it is. Long texts are encoded in stretches where the split is
    known: a blank or newline that follows a visible ASCII character always begins a token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has its core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size()
        self.ranks = self.by_ranks(json.loads(self.whole.to_str()))

    @staticmethod
    def by_ranks(said: dict):
        import tiktoken

        model, split = said["model"], said.get("pre_tokenizer") or {}
        added = said.get("added_tokens", [])
        plain = not said.get("normalizer") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        bytelevel = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        odd = any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or not t.get("special") for t in added)
        if model.get("type") != "BPE" or not plain or not bytelevel or odd:
            return None
        # bytes that print stand for themselves, the others follow in order from U+0100
        prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(prints)]
        byte = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"]: t["id"] for t in added}
        ids = {w: i for w, i in model["vocab"].items() if w not in special}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        if any(ids.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or len(ids) != 256 + len(pairs) or any(c not in byte for w in ids for c in w):
            return None
        ranks = {bytes(byte[c] for c in w): i for w, i in ids.items()}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """The ids, stretch by stretch."""
        if self.ranks is None:
            yield np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            return
        at = 0
        for cut in stretches(text, tuple(self.ranks.special_tokens_set)):
            yield self.ranks.encode_to_numpy(text[at:cut] if at or cut < len(text) else text, allowed_special="all")
            at = cut


def stretches(text: str, special: tuple[str, ...], most: int = STRETCH) -> Iterator[int]:
    """Where to cut a text: at blanks and newlines after visible ASCII, outside special tokens."""
    at = 0
    while len(text) - at > most:
        cut = at + most
        while cut < len(text) and not (text[cut] in " \n" and "\x20" < text[cut - 1] < "\x7f" and not any(" " in s or "\n" in s for s in special)):
            cut += 1
        if cut >= len(text):
            break
        yield cut
        at = cut
    yield len(text)


def encoder(path: str) -> Encoder:
    kept = worker_cache()
    if kept.get("encoder_path") != path:
        kept |= {"encoder_path": path, "encoder": Encoder(path)}
    return kept["encoder"]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """One row for each full window of a document and for its rest: id, start, length, doc_tokens, ids_crc32, ids, part, rk.

    A rest has its ids, and in rk its rank among those of its length in its part; a full window, which is a sequence of
    its own, has the number of that sequence in its part below zero: -1, -2 and so on.
    """
    kind = docs.schema[id_col].dataType
    fields = [("id", to_arrow_type(kind)), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("rk", pa.int64())]
    schema = pa.schema(fields)

    def kernel(it):
        codes = encoder(tokenizer_path)
        narrow = np.dtype("<u2" if max(codes.size, end_id) < 1 << 16 else "<u4")
        part, seen, windows = TaskContext.get().partitionId(), {}, 0
        rows: list[tuple] = []
        room = LEAVING

        def leave():
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], schema=schema)

        for batch in it:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                name, rest, total, own = name.as_py(), np.zeros(0, np.uint32), 0, []
                text = (text.as_py() or b"").decode("utf-8", "replace")
                for last, ids in after(codes.ids(text)):
                    rest = np.concatenate([rest, ids, *([[end_id]] if last else [])]).astype("<u4")
                    for at in range(0, len(rest) - capacity + 1, capacity):
                        x = rest[at : at + capacity]
                        windows += 1
                        own.append((total + at, capacity, zlib.crc32(x), x.astype(narrow).tobytes() if keep_ids else None, -windows))
                    whole = len(rest) // capacity * capacity
                    total, rest = total + whole, rest[whole:]
                if len(rest):
                    rk = seen[len(rest)] = seen.get(len(rest), -1) + 1
                    own.append((total, len(rest), None, rest.astype(narrow).tobytes(), rk))
                rows += [(name, start, size, total + len(rest), crc, raw, part, rk) for start, size, crc, raw, rk in own]
                room -= sum(len(o[3] or b"") + 64 for o in own)
                if room < 0:
                    yield leave()
                    rows, room = [], LEAVING
        if rows:
            yield leave()

    types = (("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()), ("ids_crc32", T.LongType()), ("ids", T.BinaryType()), ("part", T.IntegerType()), ("rk", T.LongType()))
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")), kernel, T.StructType([T.StructField("id", kind), *(T.StructField(n, t) for n, t in types)]))


def after(it: Iterator) -> Iterator[tuple[bool, object]]:
    """(whether it is the last, x) of each x."""
    held = next(it)
    for x in it:
        yield False, held
        held = x
    yield True, held


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False, slack: int = 0) -> DataFrame:
    """Every piece of every text with its place: id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids].

    A text's ids are followed by end_id. Windows of the capacity are sequences of their own, the rests are packed; no
    sequence needs padding: each has the capacity's length or a power of two's (with slack, or up to slack tokens less than
    the capacity, which saves cuts into tiny pieces). Null and empty texts are the end id
    alone, bytes that are no UTF-8 count as U+FFFD, rows that repeat are packed as often as they occur, and null ids stay
    null. Other columns take no part, whatever their names. An empty table gives an empty result.
    """
    cut = saved(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, keep_ids), "pieces")
    rests = cut.where("rk >= 0")
    by_part = rests.groupBy("length", "part").agg(F.count("*").alias("n"))
    # a rest's rank in its length is its rank in its part after all those of the parts before
    before = by_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs, rooms = plan(counts, capacity, slack)
    # lengths and ranks as one ascending key
    base = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        base[length + 1] = n
    base = np.cumsum(base)
    shared = docs.sparkSession.sparkContext.broadcast((base, base[runs[:, 0]] + runs[:, 1], runs, rooms))
    out = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    wide = {"id": to_arrow_type(docs.schema[id_col].dataType), "ids": pa.list_(pa.int32())}

    def kernel(it):
        base, keys, runs, rooms = shared.value
        narrow = np.dtype("<u2" if max(encoder(tokenizer_path).size, end_id) < 1 << 16 else "<u4")
        for batch in it:
            if not len(batch):
                continue
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            number = lambda n: col[n].to_numpy(zero_copy_only=False)
            length = number("length")
            key = base[length] + number("rk") + number("before")
            run = np.searchsorted(keys, key, "right") - 1
            nth, (_, _, pack, offset, stream) = key - keys[run], runs[run].T
            # whole pieces, and the parts of the others
            at = [[(0, n, p + i, o)] if p >= 0 else parts(x + i * n, n, rooms) for n, i, p, o, x in zip(*(c.tolist() for c in (length, nth, pack, offset, stream)), strict=True)]
            row = np.repeat(np.arange(len(at)), list(map(len, at)))
            at = np.array([p for some in at for p in some], np.int64)
            ids = [np.frombuffer(x, narrow).astype("<u4") for x in col["ids"].to_pylist()]
            cut = [ids[i][s : s + n] for i, s, n in zip(row.tolist(), at[:, 0].tolist(), at[:, 1].tolist(), strict=True)]
            made = {
                "start": number("start")[row] + at[:, 0], "length": at[:, 1], "ids_crc32": np.array([zlib.crc32(x) for x in cut], np.int64), "doc_tokens": number("doc_tokens")[row],
                "sequence_id": at[:, 2], "offset": at[:, 3], "ids": cut if keep_ids else None,
            }
            yield pa.RecordBatch.from_arrays([col["id"].take(pa.array(row)) if c == "id" else pa.array(made[c], wide.get(c, pa.int64())) for c in out], names=out)

    placed = rests.join(before, ["length", "part"]).select("id", "start", "length", "doc_tokens", "ids", "rk", "before")
    kinds = {"id": docs.schema[id_col].dataType, "ids": T.ArrayType(T.IntegerType())}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in out])
    # a full window's sequence has a number no pack has: its part's and its own
    own = F.shiftleft(F.col("part").cast("long") + 1, 40) - F.col("rk")
    windows = cut.where("rk < 0").withColumns({"sequence_id": own, "offset": F.lit(0).cast("long")})

    def listed(it):
        narrow = np.dtype("<u2" if max(encoder(tokenizer_path).size, end_id) < 1 << 16 else "<u4")
        for batch in it:
            ids = [np.frombuffer(x, narrow).astype(np.int32) for x in batch.column("ids").to_pylist()]
            arrays = [pa.array(ids, wide["ids"]) if c == "ids" else batch.column(c) for c in out]
            yield pa.RecordBatch.from_arrays(arrays, names=out)

    windows = map_arrow(windows.select(out), listed, schema) if keep_ids else windows.select(out)
    return map_arrow(placed, kernel, schema).unionByName(windows)
