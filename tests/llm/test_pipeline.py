import corpus_pipeline
from skyquarry.llm import packing, quality, queries
from tests.llm import test_decontaminate, test_nearcopies, test_packing, test_suffixes


def staged(spark, tmp_path, docs, small, upto):
    out = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:upto]):
        path = str(tmp_path / f"{i}-{name}")
        stage(spark, out[-1], small).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_every_stage_does_what_brute_force_does(spark, tmp_path, docs, small):
    whole, good, single, cut, clean = staged(spark, tmp_path, docs, small, 4)
    assert all(x.columns == docs.columns for x in (good, single, cut, clean))
    scores = {r["doc_id"]: r["score"] for r in queries.op1_quality(spark, small).collect()}
    assert {i for i, _ in rows(good)} == {i for i, s in scores.items() if s >= 0.3}
    assert test_nearcopies.kept(single) == test_nearcopies.brute(rows(good))
    want = {i: (n, removed) for i, n, removed, _, _ in test_suffixes.brute(rows(single))}
    left = dict(rows(cut))
    assert {str(i) for i in left} == {i for i, (n, removed) in want.items() if removed < n or not n}
    assert all(abs(len(t.encode()) - (want[str(i)][0] - want[str(i)][1])) < 40 for i, t in left.items())
    bench = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {i for i, _, n, _, _ in test_decontaminate.brute(rows(cut), bench) if n}
    assert {str(i) for i, _ in rows(clean)} == {str(i) for i in left} - hit
    bins, tokens = test_packing.check(clean, rows(clean))
    assert bins <= -(-tokens // 4096) + 2
    final = corpus_pipeline.STAGES[-1][1](spark, clean, small)
    assert {r["doc_id"] for r in final.select("doc_id").collect()} == {i for i, _ in rows(clean)}


def test_awkward_documents_pass_every_stage(spark, tmp_path, odd, none, small):
    for df in (odd, none):
        at = tmp_path / str(df.count())
        at.mkdir()
        last = staged(spark, at, df, small, 5)[-1]
        assert {"doc_id", "piece", "ids", "sequence_id"} <= set(last.columns)


def test_a_learned_network_needs_both_classes():
    net = quality.fit([b"text"], [1])
    assert quality.probability(__import__("numpy").frombuffer(b"any", "u1"), net) > 0.5
    assert packing.plan({}) == []
