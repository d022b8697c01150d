import hashlib
from collections import Counter

from skyquarry.llm import suffixes


def brute(rows, length=200):
    raw = [(n, (t or "").encode()) for n, t in rows]
    seen = Counter(hashlib.md5(b[i : i + length]).digest() for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for name, b in raw:
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - length + 1):
            if seen[hashlib.md5(b[i : i + length]).digest()] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not gone[i + 1])
        out.append((str(name), len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.without_repeats(df).collect())


def test_matches_brute_force(docs):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got(docs) == want and any(x[2] for x in want)


def test_awkward_documents(spark, odd, none):
    rows = [(r["doc_id"], r["text"] if r["text"] is None or len(r["text"]) < 20_000 else r["text"][:20_000]) for r in odd.collect()]
    period = "abcdefghijklmnopqrstuvwxyz0123456789" * 20
    line = " ".join(f"line{i}" for i in range(60))
    rows += [(100, period), (101, "x" * 199), (102, "x" * 200), (103, "start " + line + " end"), (104, "other " + line[:250] + " tail"), (105, line[120:] + line[:130])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)
    assert got(none) == []
    out = suffixes.deduplicated(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert {r["doc_id"] for r in out.where("text is null").collect()} == {0, None}
    assert {r["n_chars"] for r in out.where("doc_id = 10").collect()} == {r["n_chars"] for r in odd.where("doc_id = 10").collect()}


def by_bytes(texts, anchors, groups, length=200):
    """Windows that are the same in one group, at one distance from their anchors, by their bytes."""
    names = {}
    return [names.setdefault((g, m - s, t[s : s + length]), len(names)) for t, m, g in zip(texts, anchors, groups) for s in range(len(t) - length + 1)]


def partition(names):
    first = {}
    return [first.setdefault(n, i) for i, n in enumerate(names)]


def some_regions():
    import numpy as np

    rng = np.random.default_rng(3)
    shared = bytes(rng.integers(97, 100, 330).astype(np.uint8))
    texts = []
    for _ in range(60):
        a, z = rng.integers(0, 60), rng.integers(230, 330)
        t = bytearray(b"L" * int(rng.integers(0, 9)) + shared[a:z])
        if rng.random() < 0.5:
            t[int(rng.integers(0, len(t)))] = 120
        texts.append(bytes(t))
    return texts, np.array([int(rng.integers(0, 3)) + 40 for _ in texts]), np.array([int(rng.integers(0, 4)) for _ in texts])


def test_classes_are_those_of_the_bytes():
    texts, anchors, groups = some_regions()
    text, start, name = suffixes.classes(texts, anchors, groups)
    assert [(t, s) for t, s in zip(text.tolist(), start.tolist())] == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 199)]
    assert partition(name.tolist()) == partition(by_bytes(texts, anchors.tolist(), groups.tolist()))


def test_colliding_hashes_change_no_class(monkeypatch):
    import numpy as np

    texts, anchors, groups = some_regions()
    want = partition(by_bytes(texts, anchors.tolist(), groups.tolist()))
    for low in (0, 7):  # all hashes equal, and hashes of three bits
        monkeypatch.setattr(suffixes, "prefix_hashes", lambda d, low=low: (np.cumsum(np.concatenate([[0], d & low])).astype(np.uint64), np.ones(len(d) + 1, np.uint64)))
        assert partition(suffixes.classes(texts, anchors, groups)[2].tolist()) == want


def test_the_sort_decides_what_repeats(docs, monkeypatch):
    """Without the sort the order is not that of the bytes; with neither sort nor its verification repeats are missed."""
    import numpy as np

    texts, anchors, groups = some_regions()
    want = partition(by_bytes(texts, anchors.tolist(), groups.tolist()))
    monkeypatch.setattr(suffixes, "suffix_order", lambda data, h, down, starts, ends, group: np.argsort(group, kind="stable"))
    monkeypatch.setattr(suffixes, "sorted", lambda rows, key: list(rows), raising=False)
    assert partition(suffixes.classes(texts, anchors, groups)[2].tolist()) != want


def test_anchors_in_shards_and_long_texts_in_parts_match_brute_force(spark, monkeypatch):
    import random

    rng = random.Random(8)
    line = " ".join(f"word{i}" for i in range(90))
    rows = [(i, f"{rng.random()} {rng.random()} " * rng.randrange(1, 9) + line[rng.randrange(0, 90) : rng.randrange(400, len(line))] + f" {rng.random()}" * rng.randrange(1, 9)) for i in range(60)]
    rows += [(90, "".join(chr(97 + rng.randrange(26)) for _ in range(5000)) + rows[0][1] + "z" * 900), (91, rows[3][1]), (92, rows[40][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    monkeypatch.setattr(suffixes, "SHARD", 3)
    monkeypatch.setattr(suffixes, "SLAB", 1500)
    monkeypatch.setattr(suffixes, "GATHER", 3000)
    assert got(df) == want


def test_names_that_clash_stay(spark):
    line = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, line + " one", 5, "a", 7), (2, line + " two", 6, "b", 8), (3, None, None, None, None)], "doc_id long, text string, __row_id long, kept string, row_id long")
    out = {r["doc_id"]: r for r in suffixes.deduplicated(df).collect()}
    assert out[1].asDict() == {"doc_id": 1, "text": "one", "__row_id": 5, "kept": "a", "row_id": 7} and out[2]["text"] == "two"
    assert out[3].asDict() == {"doc_id": 3, "text": None, "__row_id": None, "kept": None, "row_id": None}


def test_suffix_order_is_the_order_of_the_bytes():
    import numpy as np

    rng = np.random.default_rng(9)
    texts = [bytes(rng.integers(97, 99, rng.integers(0, 60)).astype(np.uint8)) for _ in range(300)] + [b"", b"a" * 50, b"a" * 51, b"a" * 50]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    group = rng.integers(0, 7, len(texts))
    h, down = suffixes.prefix_hashes(data)
    got = suffixes.suffix_order(data, h, down, starts, ends, group)
    assert got.tolist() == sorted(range(len(texts)), key=lambda i: (group[i], texts[i], i))
