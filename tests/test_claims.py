"""Claims of maps in a stream against a plain loop over the same events."""

import random

import pytest

from skyquarry.operators import state
from skyquarry.streaming import claims

SCHEMA = "map_id string, status string, at double"


def files(spark, at, *batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(at)


def ran(spark, tmp_path, batches, lease=100.0, **how):
    stream = claims.claims(files(spark, str(tmp_path / "in"), *batches), lease, **how)
    return claims.settled(stream, str(tmp_path / "out"), str(tmp_path / "cp"))


def told(df):
    return sorted((r["map_id"], r["at"], r["status"], r["processing_start"], r["processing_end"]) for r in df.collect())


def loop(rows, lease, clock):
    out, held = [], {}
    for at, status, name in sorted((at, status, name) for name, status, at in rows if name is not None and status is not None):
        was, since = held.get(name, (None, None))
        if was == "processing" and at - since >= lease:
            out.append((name, since + lease, "expired", since, None))
            was = "expired"
        if status == "completed":
            out.append((name, at, "completed", since, at))
            held[name] = ("completed", since)
        elif was == "processing":
            out.append((name, at, "refused", at, None))
        else:
            out.append((name, at, "processing", at, None))
            held[name] = ("processing", at)
    out += [(name, since + lease, "expired", since, None) for name, (was, since) in held.items() if was == "processing" and since + lease <= clock]
    return sorted(out, key=str)


def test_a_stream_gives_the_states_of_a_plain_loop(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"m{k}", "processing", 1.0 + k) for k in range(5)]
    for at in range(10, 2000, 7):
        rows.append((f"m{rng.randrange(5)}", rng.choice(["processing", "processing", "completed"]), float(at)))
        if at % 5 == 0:
            rows.append((None, None, float(at)))
    rows.append((None, None, 5000.0))
    parts = [rows[i : i + 60] for i in range(0, len(rows), 60)]
    got = ran(spark, tmp_path, parts)
    assert sorted(told(got), key=str) == loop(rows, 100.0, 5000.0)
    statuses = {r[2] for r in told(got)}
    assert statuses == {"processing", "completed", "refused", "expired"}
    # the tables of the runner read them
    busy = {r["map_id"] for r in state.current(got.where("status <> 'refused'")).collect() if r["status"] == "processing"}
    assert busy == set()


def test_ticks_alone_let_a_claim_expire_and_free_its_map(spark, tmp_path):
    got = ran(spark, tmp_path, [[("a", "processing", 10.0), ("b", "processing", 10.0), (None, None, 20.0)], [(None, None, 109.0), ("b", "completed", 105.0)], [(None, None, 111.0)], [("a", "processing", 112.0)]], late="10 seconds")
    assert told(got) == [("a", 10.0, "processing", 10.0, None), ("a", 110.0, "expired", 10.0, None), ("a", 112.0, "processing", 112.0, None), ("b", 10.0, "processing", 10.0, None), ("b", 105.0, "completed", 10.0, 105.0)]
    maps = spark.createDataFrame([("a",), ("b",)], "map_id string")
    assert state.unclaimed(maps, state.current(got.where("at <= 110")), 111.0, 100.0).collect()[0]["map_id"] == "a"


def test_an_end_without_a_start_raises_or_is_left_out(spark, tmp_path):
    rows = [[("a", "completed", 5.0), ("b", "processing", 6.0)]]
    with pytest.raises(Exception, match="never started: a"):
        ran(spark, tmp_path / "r", rows)
    assert told(ran(spark, tmp_path / "s", rows, orphans="skip")) == [("b", 6.0, "processing", 6.0, None)]
    with pytest.raises(Exception, match="no claim: paused"):
        ran(spark, tmp_path / "u", [[("a", "paused", 5.0)]])
    with pytest.raises(ValueError, match="orphans"):
        claims.claims(spark.createDataFrame([], SCHEMA), orphans="keep")


def test_awkward_rows(spark, tmp_path):
    """Repeated claims of one moment, rows without a time, a map or a status, extra columns and an empty table."""
    got = ran(spark, tmp_path / "a", [[("a", "processing", 1.0), ("a", "processing", 1.0), ("a", None, 2.0), (None, "processing", 3.0), ("a", "completed", None)]])
    assert told(got) == [("a", 1.0, "processing", 1.0, None), ("a", 1.0, "refused", 1.0, None)]
    assert told(ran(spark, tmp_path / "e", [[]])) == []
    before = spark.conf.get(claims.PROVIDER, None)
    assert before != claims.ROCKS
