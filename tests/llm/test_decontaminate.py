import hashlib
import re

from skyquarry.llm import decontaminate, queries

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, bench):
    items = [(str(i), w) for i, t in bench if (w := words(t))]
    out = []
    for name, text in docs:
        w, hit, of = words(text), set(), set()
        for item, x in items:
            n = min(10, len(x))
            wins = {tuple(x[j : j + n]) for j in range(len(x) - n + 1)}
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in wins:
                    hit.update(range(j, j + n))
                    of.add(item)
        out.append((str(name), len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest()))
    return sorted(out)


def got(df, bench):
    f = decontaminate.contamination(df, bench).collect()
    ends = lambda r: len({k for s in r["spans"] for k in range(s["first"], s["first"] + s["size"])})
    return sorted((str(r["id"]), r["n_words"], ends(r), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in f)


def test_query_matches_brute_force(spark, docs, small):
    bench = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], bench)
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in queries.op2_decontaminate(spark, small).collect())
    assert found == want and any(x[2] for x in want)


def test_awkward_documents_and_short_items(spark, odd, none):
    base = [f"w{i}" for i in range(200)]
    bench = [(1, " ".join(base[50:75])), (2, "two three"), (3, "a"), (4, ""), (5, None), (6, " ".join(["a"] * 40)), (7, "éééé"), (8, "é" * 500), (2, "repeated id"), (9, " ".join(base[:10]).upper()), (None, "one two")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    named = [(i, t) for i, t in bench if i is not None]
    assert got(odd, items.where("item_id is not null")) == brute(rows, named)
    assert len(got(odd, items)) == len(rows)
    assert [x[2] for x in got(odd, items.limit(0))] == [0] * len(rows)
    assert got(none, items) == []
    kept = decontaminate.decontaminated(odd, items)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {n for n, *_ , in []} | {r[0] for r in rows if r[0] is None or not dict((x[0], x[2]) for x in brute(rows, named))[str(r[0])] and r[1] not in ("one two", "one two three")}


def test_a_large_benchmark_is_joined_by_shuffles_with_the_same_rows(spark, docs, small, monkeypatch):
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    want = sorted(map(str, decontaminate.contamination(docs, bench).drop("row_id").collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, decontaminate.contamination(docs, bench).drop("row_id").collect())) == want


def test_rows_are_judged_by_their_texts_and_not_by_their_ids(spark, small):
    item = spark.read.parquet(f"{small}/benchmark.parquet").where("size(split(text, ' ')) > 12").first()["text"]
    rows = [(1, item), (1, "nothing of the kind"), (None, item), (None, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = decontaminate.decontaminated(df, spark.read.parquet(f"{small}/benchmark.parquet"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
