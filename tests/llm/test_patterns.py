import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyquarry.llm import patterns

PATH = public_tokenizers.path("byte_bpe_50k.json")


def bins_of(rows):
    """Every sequence gapless from 0, of the capacity's or a power of two's length."""
    bins: dict = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in bins.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end and length > 0
            end += length
        assert end == 1024 or end < 1024 and end & (end - 1) == 0
    return bins


def check(df, texts):
    """Every id of every text in exactly one piece."""
    tok = Tokenizer.from_file(PATH)
    want = sorted([*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts)
    found = patterns.packed(df, PATH, keep_ids=True).collect()
    docs: dict = {}
    for r in found:
        assert len(r["ids"]) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4"))
        docs.setdefault((r["id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    got = []
    for (_, total), parts in docs.items():
        ids: list = []
        for start, x in sorted(parts):
            assert start == len(ids)
            ids += x
        assert len(ids) == total
        got.append(ids)
    assert sorted(got) == want
    return bins_of(found), sum(map(len, want))


def test_real_documents(docs):
    bins, tokens = check(docs, [r["text"] for r in docs.collect()])
    assert len(bins) <= -(-tokens // 1024) + 12
    assert patterns.packed(docs, PATH).columns == ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_awkward_documents(odd, none):
    one = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(one, [r["text"] for r in one.collect()])
    found = patterns.packed(odd, PATH).collect()
    bins_of(found)
    tok = Tokenizer.from_file(PATH)
    assert sum(r["length"] for r in found) == sum(len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert patterns.packed(none, PATH).count() == 0


def laid(counts, capacity, slack=0):
    runs, rooms = patterns.plan(counts, capacity, slack)
    seen, bins, cuts = {}, {}, 0
    for k, (length, rank, pack, offset, stream) in enumerate(runs.tolist()):
        n = (runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else counts[length]) - rank
        assert seen.get(length, 0) == rank
        seen[length] = rank + int(n)
        for i in range(int(n)):
            parts = [(0, length, pack + i, offset)] if pack >= 0 else patterns.parts(stream + i * length, length, rooms)
            assert [p[0] for p in parts] == [sum(q[1] for q in parts[:j]) for j in range(len(parts))] and sum(p[1] for p in parts) == length
            cuts += len(parts) - 1
            for _, size, p, o in parts:
                bins.setdefault(p, []).append((o, size))
    assert seen == counts and sorted(bins) == list(range(len(bins)))
    out = []
    for x in bins.values():
        end = 0
        for offset, size in sorted(x):
            assert offset == end
            end += size
        out.append(end)
    return out, cuts


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 30), max_size=40))
def test_plan_fills_every_pack(counts):
    ends, _ = laid(counts, 64)
    assert all(e == 64 or e < 64 and e & (e - 1) == 0 for e in ends)
    ends, cuts = laid(counts, 64, slack=63)
    assert cuts == 0 and all(e <= 64 for e in ends)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 6), max_size=8))
def test_lengths_go_longest_first_to_the_shortest_pack(counts):
    packs: list = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fits = [p for p in packs if sum(p) + length <= 32]
        if fits:
            min(fits, key=sum).append(length)
        else:
            packs.append([length])
    got = [sum(x for x, _ in items) for n, _, items in patterns.shortest_first(counts, 32) for _ in range(n)]
    assert sorted(got) == sorted(map(sum, packs))


def test_the_plan_does_not_grow_with_the_corpus():
    shape = lambda x: {length: x * (1 + length * 7919 % 101) + length % 13 for length in range(1, 1024)}
    small, large = (sum(map(len, patterns.plan(shape(x)))) for x in (10**3, 10**12))
    assert large < 3 * small < 30_000


def test_ids_are_the_tokenizers_own():
    codes, tok = patterns.Encoder(PATH), Tokenizer.from_file(PATH)
    assert codes.ranks is not None
    odd = ["a  b\n\n c\t d 　e", "x<|endoftext|> y", " " * 50 + "z" * 5000, "don't 12ab '' ١٢ \U0001f600‍", "\x00\x85 .", ""]
    for t in odd:
        assert np.concatenate(list(codes.ids(t))).tolist() == tok.encode(t, add_special_tokens=False).ids
    long = ("Some words, 12 of them;\n  and été <|endoftext|> " * 300)[:9000]
    cuts = list(patterns.stretches(long, ("<|endoftext|>",), 100))
    assert len(cuts) > 50
    ids = [i for a, z in zip([0, *cuts], cuts, strict=False) for i in tok.encode(long[a:z], add_special_tokens=False).ids]
    assert ids == tok.encode(long, add_special_tokens=False).ids
    # one that drops case is no byte-level encoding: it runs as it is
    other = public_tokenizers.path("word_bpe_49k.json")
    codes, tok = patterns.Encoder(other), Tokenizer.from_file(other)
    assert codes.ranks is None and next(codes.ids("Some words")).tolist() == tok.encode("Some words", add_special_tokens=False).ids
