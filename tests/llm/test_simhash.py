import numpy as np
import xxhash

from skyquarry.llm import simhash


def brute(rows):
    marks = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        marks.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0)
    lab = list(range(len(rows)))

    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 2:
                lab[find(i)] = find(j)
    best = {}
    for i, (name, _) in enumerate(rows):
        r = find(i)
        best[r] = min((x for x in (best.get(r), name) if x is not None), default=None)
    return sorted((str(name), marks[i], str(best[find(i)])) for i, (name, _) in enumerate(rows))


def got(df):
    return sorted((str(r["id"]), r["fp"] & (2**64 - 1), str(r["component"])) for r in simhash.near_duplicates(df).collect())


def test_near_duplicates_match_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(docs) == brute(rows)


def test_awkward_documents(odd, none):
    assert got(odd) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert got(none) == []
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and len(set(ids)) == len(ids) - 1 and 6 in ids and 7 not in ids


def test_shards_and_blocks_lose_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    near = base[:700] ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64))
    points = np.unique(np.concatenate([base, near, base[:50] ^ np.uint64(1)]))
    want = {(a, b) for i, a in enumerate(points.tolist()) for b in points[i + 1 :][np.bitwise_count(points[i + 1 :] ^ np.uint64(a)) <= 2].tolist()}
    nodes = simhash.vantage_tree(points, 6)
    index, shard, home = simhash.dealt(points, nodes, 2)
    assert sorted(index[home].tolist()) == list(range(len(points))) and len(set(shard.tolist())) == 6
    found = set()
    for s in set(shard.tolist()):
        mine = shard == s
        x, y = points[index[mine & home]], points[index[mine & ~home]]
        every = np.concatenate([x, y])
        a, b = simhash.close_pairs(x, y, 2)
        found |= {(min(p, q), max(p, q)) for p, q in zip(every[a].tolist(), every[b].tolist())}
    assert found == want
