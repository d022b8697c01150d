import hashlib
import re

import pytest
import regex
from pyspark.sql import functions as F

from skyquarry.llm import infill

PLAIN = [("a\nb\n\nc", 1), ("\n\n\n", 2), ("no end", 3), ("ends\n", 4), ("has <S> in it\nx", 5), ("<P", 6), ("<\n>S>\nP>", 7), ("é\U0001f600\n　x\r\ny", 8), ("", 9), (None, 10), ("x\n" * 500, 11), ("<P\n<S\n<M", 12)]


def brute(name, text, seed=7, rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def check(df, **how):
    rows = df.select("doc_id", "text").collect()
    found = infill.rearranged(df, **how).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: str(tuple(r))
    want = sorted(((r["doc_id"], *brute(r["doc_id"], r["text"], **how), r["text"] or "") for r in rows), key=key)
    assert sorted((tuple(r) for r in found), key=key) == want


@pytest.mark.parametrize("how", [{}, {"seed": 3, "rate": 60, "spm": 0}, {"spm": 100}])
def test_equals_brute_force_and_comes_back(spark, docs, odd, how):
    check(docs, **how)
    check(odd, **how)
    check(spark.createDataFrame([(i + 100 * k, t) for t, i in PLAIN for k in range(8)], "doc_id long, text string"), **how)


def test_empty_table(none):
    assert infill.rearranged(none).count() == 0


def test_long_texts_are_matched_in_stretches():
    units = regex.compile(f"({infill.LINES})*+")
    for text in ("ab\n\ncdef\n" * 40 + "end", "\n" * 100, "x" * 300, "y" * 80 + "\n" + "z\n" * 20):
        whole = units.fullmatch(text).ends(1)
        for stretch in (1, 7, 50):
            assert list(infill.unit_ends(text, units, stretch)) == whole


def test_bytes_that_are_no_utf8_stay(spark):
    df = spark.sql("select 4L as doc_id, cast(unhex('61FF0A62C30A63') as string) as text")
    row = infill.rearranged(df).select(F.hex(infill.restored(F.col("output"), F.col("form"))).alias("x"), "n").first()
    assert row["x"] == "61FF0A62C30A63" and row["n"] == 3
