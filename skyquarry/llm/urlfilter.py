"""URL rules looked up in Bloom filter cascades, with DataFrame functions only.

A cascade is exact over a known universe of keys: level 1 holds the listed keys, level 2 those unlisted keys of the
universe that level 1 lets through, level 3 the listed keys that level 2 lets through, and so on until a level lets
no wrong key through. A key is listed if the first level that refuses it is an even one. The universe is every key
that the corpus can ask for, so that no answer needs a join. Level 1 is sized by the universe, to let through fewer
unlisted keys than there are listed ones, and later ones halve; so all levels together take a few bits for each listed
key and each doubling of the universe, and travel with the plan, as the rules do.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquarry.llm.common import saved

#: Hash functions of a level, and bits of level 1 at least: with few rules it lets next to no key through.
HASHES, FIRST_BITS = 4, 1 << 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every rule that could fit: host suffixes of up to `labels` labels, each with the path's prefixes of the given lengths."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + j), key), F.lit(bits)) for j in range(HASHES)]


def _held(key: Column, level: int, words: list[int]) -> Column:
    """Whether a level's filter lets key through."""
    bits = F.lit(np.array(words, np.int64))  # one literal, however long
    test = [F.getbit(F.element_at(bits, (F.shiftright(p, 6) + 1).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in _places(key, level, 64 * len(words))]
    return reduce(lambda a, b: a & b, test)


def _words(n: int, others: int, level: int) -> int:
    """64-bit words of a level of n keys that meets others: at most n / 1.4 of these and at most half pass."""
    share = min(0.5, n / (1.4 * max(1, others))) ** (1 / HASHES)
    bits = -HASHES * n / math.log1p(-share)
    return max(1 if level else FIRST_BITS // 64, math.ceil(bits / 64))


def _filter_bits(keys: DataFrame, level: int, words: int) -> list[int]:
    at = keys.select(F.explode(F.array(*_places(F.col("key"), level, 64 * words))).alias("p"))
    got = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")).alias("bits"))
    out = [0] * words
    for r in got.collect():  # at most `words` rows
        out[r["w"]] = r["bits"]
    return out


def cascade(universe: DataFrame, listed: DataFrame, most_levels: int = 90) -> list[list[int]]:
    """The levels (as 64-bit words) that tell listed keys from all others of universe. Both: distinct non-null `key`."""
    wanted, other = listed, universe.join(listed, "key", "left_anti")
    levels: list[list[int]] = []
    counts = wanted.count(), other.count()
    while len(levels) < most_levels:
        if counts[0] == 0:
            return levels
        words = _filter_bits(wanted, len(levels), _words(*counts, len(levels)))
        passed = other.where(_held(F.col("key"), len(levels), words))
        levels.append(words)
        wanted, other = saved(passed, "cascade"), wanted
        counts = wanted.count(), counts[0]
    raise RuntimeError("the cascade did not end")


def member(key: Column, levels: list[list[int]]) -> Column:
    out = F.lit(False)
    for i in range(len(levels) - 1, -1, -1):
        out = _held(key, i, levels[i]) & ~out
    return out


def judged(urls: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """urls with host, path, rule and verdict. rules: (host, path prefix, allow or block).

    A rule fits its host and all subdomains where the path starts with the rule's; the longest wins. The rule and
    the verdict come from two cascades, of all rules and of the blocking ones, over every key that the table's urls
    can ask for. A url that no rule fits is not listed, so it is allowed; null urls, and urls without ://, have an
    empty host and path. The columns are named as given: url_host, url_path, url_rule, url_verdict.
    """
    spark = urls.sparkSession
    held = urls.withColumns({"url_host": url_host(F.col(url_col)), "url_path": url_path(F.col(url_col))})
    if not rules:
        return held.withColumns({"url_rule": F.lit(None).cast("string"), "url_verdict": F.lit("allow")})
    labels = max(h.count(".") + 1 for h, _, _ in rules)
    lengths = sorted({len(p) for _, p, _ in rules})
    keys = candidate_keys(F.col("url_host"), F.col("url_path"), labels, lengths)
    universe = saved(held.select(F.explode(keys).alias("key")).distinct(), "universe")
    all_rules = cascade(universe, _keys(spark, [h + p for h, p, _ in rules]))
    blocking = cascade(_keys(spark, [h + p for h, p, _ in rules]), _keys(spark, [h + p for h, p, v in rules if v == "block"]))
    fitting = F.filter(keys, lambda k: member(k, all_rules))
    longest = F.array_max(F.transform(fitting, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    out = held.withColumn("url_rule", longest)
    return out.withColumn("url_verdict", F.when(F.col("url_rule").isNotNull() & member(F.col("url_rule"), blocking), "block").otherwise("allow"))


def _keys(spark: SparkSession, keys: list[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in sorted(set(keys))]).cast("array<string>")).alias("key"))
