import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyquarry.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(df, rows):
    """Every piece once, of the right ids, gapless from 0 in its sequence."""
    tok = Tokenizer.from_file(PATH)
    want = []
    for name, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(name), k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    found = packing.packed(df, PATH).collect()
    assert sorted((str(r["id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    bins: dict = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in bins.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end
            end += length
        assert end <= 4096
    return len(bins), sum(x[3] for x in want)


def test_real_documents(docs):
    bins, tokens = check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert bins <= -(-tokens // 4096) + 2


def test_awkward_documents(odd, none):
    check(odd, [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert packing.packed(none, PATH).count() == 0
    kept = packing.packed(odd, PATH, keep_ids=True)
    assert all(len(r["ids"]) == r["length"] for r in kept.collect())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=40))
def test_plan_places_every_piece_once_without_overlap(counts):
    seen, bins = {x: [] for x in counts}, {}
    for length, rank, n, first, offset in packing.plan(counts, 64):
        seen[length] += range(rank, rank + n)
        for b in range(first, first + n):
            bins.setdefault(b, []).append((offset, length))
    assert all(sorted(seen[x]) == list(range(n)) for x, n in counts.items())
    assert sorted(bins) == list(range(len(bins)))
    for x in bins.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end
            end += length
        assert end <= 64


def test_a_tokenizer_that_keeps_blanks_encodes_whole_texts():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["Two  words\nand 12 more", "", " Blank", "É x^y"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    for name, split in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        assert packing.chunked(tokenizer) is split
        got = packing.token_ids(np.frombuffer(b"".join(raw), np.uint8), offsets, tokenizer)
        assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        packing.worker_cache().pop("word_ids", None)


def test_words_that_occur_again_stay_known_when_the_cache_is_full(monkeypatch):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, asked, encode = Tokenizer.from_file(path), [], packing.chunk_ids
    monkeypatch.setattr(packing, "WORD_CACHE", 3)
    monkeypatch.setattr(packing, "worker_cache", lambda kept={}: kept)  # noqa: B006
    monkeypatch.setattr(packing, "chunk_ids", lambda chunks, t: asked.extend(chunks) or encode(chunks, t))
    for i in range(4):
        text = f"The river, a Stone! (light) x9 don't Ärger. end' it's... new{i}".encode()
        (ids,) = packing.token_ids(np.frombuffer(text, np.uint8), np.array([0, len(text)]), tokenizer)
        assert ids.tolist() == tokenizer.encode(text.decode(), add_special_tokens=False).ids
    assert asked.count(b"river".decode()) == 1 and len(asked) == len(set(asked))


def test_letters_and_marks_are_those_of_the_pattern():
    for a in [*map(chr, range(33, 256)), "Ab", "aÉ", "é", "ﬀ"]:
        for b in ["", *map(chr, range(33, 128)), ".,", "é!"]:
            m = packing.LETTERS.fullmatch(a + b)
            assert packing.letters_and_marks((a + b).encode()) == ((m[1].lower().encode(), m[2].encode()) if m else None)
