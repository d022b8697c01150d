import zlib

import numpy as np
import pytest

from skyquarry.llm import quality, queries


def test_held_out_accuracy(spark):
    """Trained and tested on whole texts of the two sides of the split."""
    at = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    found = {r["doc_id"]: r for r in queries.op1_quality(spark, at).collect()}
    held = [i for i in labels if found[i]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found.values())
    good = [found[i]["predicted"] for i in held if labels[i] == 1]
    bad = [found[i]["predicted"] for i in held if labels[i] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in quality.initial().items()}
    text = rng.integers(0, 256, 700).astype(np.uint8)
    into = {k: np.zeros_like(v) for k, v in net.items()}
    quality.gradients(text, 1.0, 1.0, net, into)
    loss = lambda: -np.log(quality.probability(text, net))
    for name in net:
        flat = net[name].reshape(-1)
        for i in np.argsort(-abs(into[name].reshape(-1)))[:3]:
            was = flat[i]
            flat[i] = was + 1e-5
            up = loss()
            flat[i] = was - 1e-5
            down = loss()
            flat[i] = was
            assert (up - down) / 2e-5 == pytest.approx(into[name].reshape(-1)[i], rel=2e-2, abs=1e-4)


def test_pooling_covers_every_position():
    for n in (1, 31, 32, 33, 64, 65, 500):
        r = np.random.default_rng(n).normal(size=(n, 3)).astype(np.float32)
        best, starts = quality.pooled(r)
        assert (best.max(0) == r.max(0)).all()
        for c, s in enumerate(starts):
            assert (best[c] == r[s : s + quality.CHUNK].max(0)).all()
        assert starts[-1] + quality.CHUNK >= n


def test_awkward_documents(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    from pyspark.sql import functions as F

    net = quality.trained(odd, labels, F.lit(True))
    out = quality.scored(odd, net)
    assert out.columns == [*odd.columns, "score"] and out.count() == odd.count()
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    assert quality.scored(none, net).count() == 0
    assert quality.scored(odd, quality.trained(odd, labels.limit(0), F.lit(True))).count() == odd.count()


def test_long_texts_are_scored_in_parts_like_whole_ones(monkeypatch):
    rng = np.random.default_rng(4)
    net = quality.initial()
    for size in (1 << 14, (1 << 14) + 1, 70_001, 200_003):
        text = rng.integers(0, 256, size).astype(np.uint8)
        want = quality.features(text, net)[-1]
        monkeypatch.setattr(quality, "PART", 1 << 12)
        assert np.allclose(quality.whole_features(text, net), want, atol=1e-6)


def test_a_column_that_is_called_score_is_kept_under_another_name(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(1, "plain text", 7.0)], "doc_id long, text string, score double")
    assert quality.scored(df, quality.initial(), score_col="mine").columns == ["doc_id", "text", "score", "mine"]
    assert corpus_pipeline.unused("score", df) == "_score"


def test_scores_match_a_network_of_plain_loops(spark):
    """Every filter at every position, every chunk and every sum written out, against what the job returns."""
    from math import exp, tanh

    q = quality
    rng = np.random.default_rng(6)
    net = {k: rng.normal(0, 0.4, v.shape).astype(np.float32) for k, v in q.initial().items()}
    texts = [None, "", "x", "a short text", "é" * 70, " ".join(f"word{i}" for i in range(90))]
    texts.append("z" * (q.CHUNK * q.STRIDE) + "!")
    embed, filters = net["embed"].astype(float).tolist(), net["filters"].astype(float).tolist()

    def plain(text):
        data = list((text or "").encode())
        n = max(1, -(-len(data) // q.STRIDE))
        under = [[data[p * q.STRIDE + k] if p * q.STRIDE + k < len(data) else 256 for k in range(q.WIDTH)] for p in range(n)]
        chunks, start = [], 0
        while not chunks or start + q.CHUNK - q.STEP < n:
            chunks.append(range(start, min(n, start + q.CHUNK)))
            start += q.STEP
        z = float(net["out"][0])
        for f in range(q.FILTERS):
            response = [sum(embed[b][e] * filters[k * q.EMBED + e][f] for k, b in enumerate(w) for e in range(q.EMBED)) for w in under]
            best = [tanh(max(response[p] for p in c) + float(net["bias"][f])) for c in chunks]
            z += sum(best) / len(best) * float(net["dense"][f]) + max(best) * float(net["dense"][q.FILTERS + f])
        return 1 / (1 + exp(-z))

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in q.scored(df, net).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(plain(text), abs=1e-4)
