import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from skyquarry.llm import nearcopies, simhash


def brute(rows):
    """The kept (id, text) pairs' ids by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    lab = list(range(len(rows)))

    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if 5 * common >= 4 * union:
                lab[find(i)] = find(j)
    best = {}
    for i, (name, _) in enumerate(rows):
        best.setdefault(find(i), []).append((name is None, name))
    return sorted((min(x) for x in best.values()), key=str)


def kept(df):
    return sorted(((r["doc_id"] is None, r["doc_id"]) for r in df.collect()), key=str)


def test_the_stage_drops_copies_with_a_similarity_of_four_fifths(spark, docs, small):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert kept(corpus_pipeline.drop_near_copies(spark, docs, small)) == brute(rows)


def test_copies_with_many_edits_and_chains_match_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 6, 60, 300]))]
        for _ in range(8):  # each an edit of the one before, so that sets are connected by chains; some edits are too many
            texts.append(" ".join(["the same opening line of all of these texts", *base]))
            for _ in range(rng.randrange(1 + len(base) // 25)):
                base[rng.randrange(len(base))] = f"x{rng.randrange(3000)}"
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "alone without an id"), (5, "another text of the id five"), (None, ""), (900, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert kept(simhash.without_near_copies(df)) == brute(rows)


def test_awkward_documents(odd, none):
    out = simhash.without_near_copies(odd)
    assert out.columns == odd.columns
    assert kept(out) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert simhash.without_near_copies(none).collect() == []


def test_points_of_a_key_meet_others_than_the_least_at_a_linear_cost(spark):
    """300 points share three keys: each meets some in each key besides the least, which is other points in every key; no pair comes twice."""
    rows = [(key, point, (100 << 32) + 1, point, 20) for key in range(3) for point in range(300)]
    pairs = [tuple(r) for r in nearcopies._introduced(spark.createDataFrame(rows, "key long, point long, place long, root long, band int")).collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    assert len(pairs) <= 300 * (1 + 3 * nearcopies.NEXT)
    others = {p: sum(p in x for x in pairs if 0 not in x) for p in range(1, 300)}
    assert min(others.values()) >= nearcopies.NEXT and sum(others.values()) > 299 * 3 * nearcopies.NEXT


def test_points_left_meet_in_blocks_and_only_pairs_that_sketches_cannot_tell_apart_become_rows(spark, monkeypatch):
    """240 sets share one key, all but a few of which differ in more than a ninth: rows stay in proportion, and no similar pair is lost."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(nearcopies, "BLOCK", 50)
    base = rng.integers(1, 1 << 63, 500).astype(np.uint64)
    sets = []
    for i in range(240):
        size = (40, 200, 270, 500)[i % 4]
        edits = size // (3 if i % 5 else 20)
        sets.append(np.unique(np.concatenate([base[: size - edits] if i % 5 else base[:size][rng.permutation(size)[edits:]], rng.integers(1, 1 << 63, edits).astype(np.uint64)])))
    root = [i // 2 if i % 10 < 2 else i for i in range(240)]
    rest = spark.createDataFrame([(7, i, len(s) << 32, root[i], 240) for i, s in enumerate(sets)], "key long, point long, place long, root long, met long")
    points = spark.createDataFrame([(i, len(s), nearcopies.sketch(s)) for i, s in enumerate(sets)], "point long, n long, sketch binary")
    blocks = nearcopies._blocks(rest, points)
    assert blocks.count() == 240 * 5 and blocks.select("low", "high").distinct().count() == 15
    got = {tuple(r) for r in nearcopies.map_arrow(blocks, nearcopies._met, "a long, b long").collect()}
    every = [(a, b) for b in range(240) for a in range(b) if root[a] != root[b]]
    common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in every}
    alike = {(a, b) for a, b in every if common[a, b] * 9 >= (len(sets[a]) + len(sets[b])) * 4}
    assert len(alike) > 200 and alike <= got
    assert len(got) < 1.2 * len(alike) < len(every) / 5


def test_groups_cut_between_batches_and_empty_ones_keep_their_pairs():
    sketch = nearcopies.sketch(np.arange(1 << 20, 1 << 21, 1 << 16, dtype=np.uint64))
    rows = [(key, 0, 0, 0, 100 * key + i, 16 << 32, 100 * key + i, sketch) for key in range(30) for i in range(1 + key % 3)]
    names = ["key", "low", "high", "block", "point", "place", "root", "sketch"]
    table = pa.table(dict(zip(names, map(pa.array, zip(*rows, strict=True)), strict=True)))
    for most in (1, 7, 1000):
        was, nearcopies.SKETCHED = nearcopies.SKETCHED, 64 * most
        try:
            got = [p for b in nearcopies._met(iter([*table.to_batches(max_chunksize=4), *table.slice(0, 0).to_batches()])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        finally:
            nearcopies.SKETCHED = was
        assert sorted(got) == [(100 * key + i, 100 * key + j) for key in range(30) for i in range(1 + key % 3) for j in range(i + 1, 1 + key % 3)]
    assert list(nearcopies._met(iter([]))) == []
