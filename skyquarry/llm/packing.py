"""Best-fit packing of token sequences into fixed capacity.

Only the lengths of pieces decide a packing, and they are at most the capacity. So the job counts pieces by length,
plans on that histogram (bounded by the capacity, whatever the corpus), and deals the planned places out by each
piece's rank within its length. Pieces above a third of the capacity pair at most twice per bin by greedy matching,
largest first with the largest partner that fits; smaller ones then go, longest first, to the tightest gap.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import byte_buffer, map_arrow, saved, worker_cache

CAPACITY = 4096
#: Words whose ids a worker keeps before it starts again.
WORD_CACHE = 500_000
#: Stands between chunks that are encoded together.
MARK = "^"
#: Letters that have one form and one lower case, then ASCII marks other than the apostrophe and digits.
LETTERS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")

#: Those marks.
MARKS = bytes(x for x in range(33, 127) if not chr(x).isalnum() and x != 39)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first bin, offset): piece first + i of that length goes to bin first + i at offset.

    counts: pieces by length, 1 to capacity. Bins are numbered from 0 without a gap.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    done = dict.fromkeys(counts, 0)
    left = dict(counts)
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    bins = 0

    def place(length: int, first_bin: int, number: int, offset: int) -> None:
        runs.append((length, done[length], number, first_bin, offset))
        done[length] += number
        left[length] -= number

    def free(gap: int, first_bin: int, number: int) -> None:
        if gap and number:
            if not gaps.get(gap):
                gaps[gap] = []
                heapq.heappush(sizes, gap)
            gaps[gap].append((first_bin, number))

    large = sorted((x for x in counts if 3 * x > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((x for x in large if x <= capacity - a and left[x] and (x != a or left[a] > 1)), 0)
            if not b:
                n = left[a]
                place(a, bins, n, 0)
                free(capacity - a, bins, n)
            else:
                n = left[a] // 2 if a == b else min(left[a], left[b])
                place(a, bins, n, 0)
                place(b, bins, n, a)
                free(capacity - a - b, bins, n)
            bins += n
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        while left[length]:
            # gaps in ascending order; what is too tight for this length waits for a shorter one
            fitting = min((g for g in gaps if g >= length and gaps[g]), default=0)
            if not fitting:
                each = capacity // length
                n = -(-left[length] // each)
                free(capacity, bins, n)
                bins += n
                continue
            first, number = gaps[fitting].pop()
            each = fitting // length
            full = min(number, left[length] // each)
            if full:
                for j in range(each):
                    place(length, first, full, capacity - fitting + j * length)
                free(fitting - each * length, first, full)
                if number > full:
                    gaps[fitting].append((first + full, number - full))
            else:
                some = left[length]
                for j in range(some):
                    place(length, first, 1, capacity - fitting + j * length)
                free(fitting - some * length, first, 1)
                if number > 1:
                    gaps[fitting].append((first + 1, number - 1))
    return runs


def chunk_ids(chunks: list[str], tokenizer) -> list[bytes]:
    """The ids of blank-free chunks, as bytes. Many chunks are encoded as one text, with a mark between them.

    The mark stands between blanks, so that it is a token of its own; no other character's encoding holds that token.
    """
    (mark_id,) = tokenizer.encode(MARK, add_special_tokens=False).ids
    plain = [c for c in chunks if MARK not in c]
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    lines = [f" {MARK} ".join(plain[i : i + 500]) for i in range(0, len(plain), 500)]
    got: dict[str, bytes] = {}
    for i, e in enumerate(encode(lines, add_special_tokens=False)):
        ids = np.array(e.ids, "<u4")
        at = np.flatnonzero(ids == mark_id)
        raw, starts, ends = ids.tobytes(), [0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), 4 * len(ids)]
        got |= {c: raw[s:z] for c, s, z in zip(plain[500 * i : 500 * i + 500], starts, ends, strict=True)}
    rest = [c for c in chunks if MARK in c]
    got |= {c: np.array(e.ids, "<u4").tobytes() for c, e in zip(rest, tokenizer.encode_batch(rest, add_special_tokens=False), strict=True)}
    return [got[c] for c in chunks]


def chunked(tokenizer) -> bool:
    """Whether a text's ids are those of its blank-separated, lower-cased chunks, letters and marks apart, as the tokenizer's own description has it.

    So it is where white space becomes a blank, case is dropped, and the first split keeps runs of letters, single
    digits and runs of other marks alone.
    """
    said = json.loads(tokenizer.to_str())
    normal, split = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [normal])
    first = split.get("pretokenizers", [split])[0]
    blanks = any(n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"} and n.get("content") == " " for n in steps)
    apart = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    kinds = first.get("pattern", {}).get("Regex", "").split("|")[-3:]
    return blanks and {"type": "Lowercase"} in steps and apart and kinds == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]


def letters_and_marks(chunk: bytes) -> tuple[bytes, bytes] | None:
    """A chunk's letters in lower case and the marks after them, as LETTERS has it; None if it is anything else."""
    letters = chunk.rstrip(MARKS)
    if letters.isalpha():  # of bytes: a-z and A-Z alone
        return letters.lower(), chunk[len(letters) :]
    if chunk.isascii():
        return None
    m = LETTERS.fullmatch(chunk.decode("utf-8", "replace"))
    return (m[1].lower().encode(), m[2].encode()) if m else None


def token_ids(data: np.ndarray, offsets: np.ndarray, tokenizer) -> list[np.ndarray]:
    """The ids of texts that lie one after another, as tokenizer.encode(text, add_special_tokens=False) gives them.

    Where the tokenizer's description allows it (chunked), the ids are put together from those of the blank-separated
    chunks; otherwise every text is encoded whole. A batch's chunks are numbered by Arrow, and only distinct ones are looked up; each worker keeps the ids of chunks
    that it has met. A text that holds a special token is encoded whole.
    """
    kept = worker_cache()
    if kept.get("told") is not tokenizer:
        kept |= {"told": tokenizer, "chunked": chunked(tokenizer)}
    if not kept["chunked"]:
        whole = data.tobytes()
        texts = [whole[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    cache: dict[bytes, bytes] = kept.setdefault("word_ids", {})
    n, raw = len(data), data.tobytes()
    # a chunk ends after a blank or with its text
    mark = np.zeros(n + 1, bool)
    mark[1:] = (data == 32) | (data == 10)
    mark[offsets] = True
    cuts = np.flatnonzero(mark)
    ends = pa.py_buffer(cuts.astype(np.int64))
    coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, ends, pa.py_buffer(raw)]).dictionary_encode()
    which = coded.indices.to_numpy()
    _, bounds, chars = coded.dictionary.buffers()
    bounds, chars = np.frombuffer(bounds, np.int64, len(coded.dictionary) + 1), chars.to_pybytes()
    last = np.frombuffer(chars, np.uint8)[np.maximum(bounds[1:], 1) - 1] if chars else bounds[1:]
    words = [chars[s:e] for s, e in zip(bounds[:-1].tolist(), (bounds[1:] - ((last == 32) | (last == 10))).tolist(), strict=True)]
    ids = list(map(cache.get, words))
    if len(cache) > WORD_CACHE:  # what this batch knows is frequent and stays
        cache.clear()
        cache.update((w, i) for w, i in zip(words, ids, strict=True) if i is not None)
    new = {w for w, i in zip(words, ids, strict=True) if i is None}
    if new:
        # letters and the marks after them are tokens apart, and case is dropped: most chunks are made of known ones
        parts = {w: two for w in new if (two := letters_and_marks(w))}
        need = list({x for two in parts.values() for x in two if x not in cache} | (new - parts.keys()))
        cache.update(zip(need, chunk_ids([x.decode("utf-8", "replace") for x in need], tokenizer), strict=True))
        cache.update((w, cache[x] + cache[y]) for w, (x, y) in parts.items())
        ids = [cache[w] if i is None else i for w, i in zip(words, ids, strict=True)]
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
    each = size[which]
    total = np.concatenate([[0], np.cumsum(each)])
    out = flat[np.repeat(first[which] - total[:-1], each) + np.arange(total[-1])]
    at = total[np.searchsorted(cuts, offsets)]
    found = [out[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    for special in {t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()}:
        if special in raw:
            for i in range(len(found)):
                if special in (text := raw[offsets[i] : offsets[i + 1]]):
                    found[i] = np.array(tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4")
    return found


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, [ids,] part and rk, the piece's rank in its length and part.

    A text's ids are followed by end_id; only what is longer than capacity is cut, into pieces of capacity and a rest.
    """
    kind = docs.schema[id_col].dataType
    fields = [("id", to_arrow_type(kind)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rk", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] if keep_ids else []

    def kernel(it):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has its core; more threads only wait for one another
        from tokenizers import Tokenizer

        kept = worker_cache()
        if kept.get("tokenizer_path") != tokenizer_path:
            kept |= {"tokenizer_path": tokenizer_path, "tokenizer": Tokenizer.from_file(tokenizer_path), "word_ids": {}}
        part, seen = TaskContext.get().partitionId(), {}
        for batch in it:
            names, rows = batch.column(0).to_pylist(), []
            for name, ids in zip(names, token_ids(*byte_buffer(batch.column(1)), kept["tokenizer"]), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    x = ids[start : start + capacity]
                    rk = seen[len(x)] = seen.get(len(x), -1) + 1
                    rows.append((name, k, start, len(x), zlib.crc32(x.tobytes()), part, rk, *([x.astype(np.int32)] if keep_ids else [])))
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)], schema=pa.schema(fields))

    schema = T.StructType([T.StructField("id", kind), *(T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("part", T.IntegerType()), ("rk", T.LongType()))), *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])])
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), kernel, schema)


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Every piece of every text with its place: id, piece, start, length, ids_crc32, sequence_id, offset [, ids].

    Null and empty texts are the end id alone. Rows that repeat are packed as often as they occur. An empty table
    gives an empty result.
    """
    cut = saved(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, keep_ids), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    # a piece's rank in its length is its rank in its part after all pieces of the parts before
    before = by_part.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    # lengths and ranks as one ascending key: runs of a length follow one another by rank
    base = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        base[length + 1] = n
    base = np.cumsum(base)
    shared = docs.sparkSession.sparkContext.broadcast((base, base[runs[:, 0]] + runs[:, 1], runs))

    def kernel(it):
        base, keys, runs = shared.value
        for batch in it:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            rank = at["rk"].to_numpy(zero_copy_only=False) + at["before"].to_numpy(zero_copy_only=False)
            key = base[at["length"].to_numpy(zero_copy_only=False)] + rank
            run = np.searchsorted(keys, key, "right") - 1
            made = {"sequence_id": pa.array(runs[run, 3] + key - keys[run]), "offset": pa.array(runs[run, 4])}
            names = [n for n in batch.schema.names if n not in ("rk", "before", "part")]
            yield pa.RecordBatch.from_arrays([*(at[n] for n in names), *made.values()], names=[*names, *made])

    placed = cut.join(before.select("length", "part", "before"), ["length", "part"]).select(*cut.columns, "before")
    kept = [f for f in cut.schema.fields if f.name not in ("rk", "part")]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_arrow(placed, kernel, schema)
