import random

from pyspark.sql import functions as F

from skyquarry.operators import groups, maps


def python_free(df):
    plan = df._jdf.queryExecution().toString()
    return not any(x in plan for x in ("FlatMapGroupsInPandas", "collect_list"))


def test_groups_match_the_sequential_fold_without_one_group(spark):
    rng = random.Random(5)
    for n in (6, 40, 200):
        place = {i: rng.randrange(5) for i in range(n)}
        names = list(range(n))
        rng.shuffle(names)
        pairs = sorted({(place[i], place[j], i, j) for i, j in ((rng.choice(names), rng.choice(names)) for _ in range(2 * n)) if place[i] < place[j]})
        group: dict = {}
        for (_, _, i), j in sorted({(a, b, i): j for a, b, i, j in pairs}.items()):
            name = group.get(i, group.get(j, i))
            group.setdefault(i, name)
            group.setdefault(j, name)
        got = groups.folded(spark.createDataFrame(pairs, "map_i int, map_j int, i long, j long"))
        assert {r["node"]: r["group"] for r in got.collect()} == group
        assert python_free(got)


def test_suppression_matches_the_sequential_one_without_one_row_a_map(spark):
    rng = random.Random(6)
    rows = [(m, i, float(rng.randrange(-20, 20)), float(rng.randrange(-20, 20)), float(rng.randrange(9)), rng.choice([0.0, 1.0, 2.5])) for m in range(3) for i in range(150)]
    want = []
    for m in range(3):
        kept: list = []
        for p in sorted((p for p in rows if p[0] == m), key=lambda p: (-p[4], *p[1:4])):
            if not any((q[2] - p[2]) ** 2 + (q[3] - p[3]) ** 2 <= p[5] ** 2 for q in kept):
                kept.append(p)
        want += [p[:5] for p in kept]
    df = spark.createDataFrame(rows, "map_id int, peak_id long, x double, y double, v double, rad double")
    got = maps.greedy_suppressed(df, F.col("rad"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert python_free(got)
    assert maps.greedy_suppressed(df.limit(0), F.col("rad")).collect() == []
