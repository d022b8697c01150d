import zlib

import numpy as np
from pyspark.sql import functions as F

from skyquarry.llm import language, queries


def test_held_out_accuracy(spark):
    at = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op9_language(spark, at).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]) > 0.95


def test_kernel_is_the_normalised_count_of_shared_ngrams():
    texts = [b"the cat sat", b"la casa", b"", b"THE hat"]
    model = language.Model(texts, ["en", "es", "en", "es"])
    sets = lambda t: {t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    got = model.kernel([np.frombuffer(t, np.uint8) for t in texts], model.table())
    want = {frozenset(np.round([len(sets(a) & sets(b)) / max(1, np.sqrt(max(1, len(sets(a))) * max(1, len(sets(b))))) for b in texts], 4).tolist()) for a in texts}
    assert {frozenset(np.round(row.astype(float), 4).tolist()) for row in got} == want


def test_awkward_documents(odd, none):
    model = language.trained(odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")), F.lit(True))
    out = language.identified(odd, model)
    assert out.columns == [*odd.columns, "lang_pred", "lang_score"] and out.count() == odd.count()
    for r in out.collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language.identified(none, model).count() == 0
    nothing = language.trained(none, F.lit(True))
    assert {r["lang_pred"] for r in language.identified(odd, nothing).collect()} == {"und"}
    one = language.trained(odd, F.lit(True))
    assert {r["lang_pred"] for r in language.identified(odd, one).collect()} == {"en", "und"}


def test_scores_are_ridge_regression_by_plain_algebra():
    """Normal equations in the kernels of sets of n-grams, without the map to eigenvectors; long texts piece by piece."""
    rng = np.random.default_rng(9)
    words = {"a": ["the", "river", "of", "stone"], "b": ["der", "fluss", "und", "stein"], "c": ["la", "rivière", "et", "pierre"]}
    texts, langs = [], []
    for k in range(18):
        lang = "abc"[k % 3] if k < 15 else "a"  # languages of different sizes
        texts.append(" ".join(rng.choice(words[lang], 6 + k)).encode())
        langs.append(lang)
    model = language.Model(texts, langs)
    sets = lambda t: {t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    known = set().union(*map(sets, texts))
    marks = [sets(t) for t in texts]  # no more texts than landmarks: all are

    def kernel(t):
        has = sets(t) & known
        return [len(has & m) / np.sqrt(len(m)) / np.sqrt(max(1, len(has))) for m in marks]

    k = np.column_stack([[kernel(t) for t in texts], np.ones(len(texts))])
    y = np.array([[g == x for g in "abc"] for x in langs], float)
    w = np.diag([1 / langs.count(x) for x in langs])
    between = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in marks] for a in marks])
    penalty = np.zeros((len(texts) + 1,) * 2)
    penalty[:-1, :-1], penalty[-1, -1] = between, 1
    solved = np.linalg.lstsq(k.T @ w @ k + language.RIDGE / len(texts) * penalty, k.T @ w @ y, rcond=1e-9)[0]
    asked = [b"the river und la pierre", b"", b"zzz qqq", " ".join(rng.choice(sum(words.values(), []), 900)).encode()]
    got = model.scores([np.frombuffer(t, np.uint8) for t in asked], model.table())
    for t, row in zip(asked, got, strict=True):
        pieces = [t[i : i + language.PIECE] for i in range(0, max(1, len(t)), language.PIECE)]
        size = [max(1, len(p)) for p in pieces]
        want = sum(n * (np.array([*kernel(p), 1]) @ solved) for n, p in zip(size, pieces, strict=True)) / sum(size)
        assert np.allclose(row, want, atol=2e-3), (t[:20], row, want)


def test_columns_with_names_of_its_own_are_kept(spark):
    model = language.Model([b"the cat", b"la casa"], ["en", "es"])
    df = spark.createDataFrame([(1, "the cat", "mine", 2.0)], "doc_id long, text string, __letters string, lang_score double")
    (row,) = language.identified(df, model).collect()
    assert row["__letters"] == "mine" and row["lang_pred"] == "en" and row["lang_score"] != 2.0
