"""URL filters by a Bloom filter cascade.

A rule is a (host, path) pair with a verdict. It fits its host and all subdomains if the url's path
starts with the rule's; the longest fitting rule wins (ties: the one with the longer host). The
rules' keys (host followed by path) are held in one cascade for each verdict. Level 1 of a cascade
encodes the listed keys, level 2 those other keys of the corpus that pass level 1, level 3 the listed
keys that pass level 2, and so on until nothing passes wrongly. The first level is sized so that about
as many other keys pass as there are listed ones; so all levels together take a few bits for each
listed key and doubling of the corpus. As the levels are built over every key that occurs in the
corpus, a test against them is exact for the corpus and needs no join: the bits are literals.

Null urls and urls without ``://`` have an empty host and path, fit no rule and get the default
verdict. Repeated pages each get a row; an empty table gives an empty result. Other columns of the
pages are not read. Rules with a null host or path fit nothing.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow, stage

#: Most listed keys that are held in literals; longer lists are joined instead.
MAX_LISTED = 100_000
#: A key of the corpus that no level tells from a listed one would never end the cascade.
MAX_LEVELS = 40


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    part = lambda i: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), part(2)


def candidate_keys(host: Column, path: Column, label_counts: list[int], path_lengths: list[int]) -> Column:
    """Every key under which a rule for this url could be listed: suffixes of the host with as many
    labels, and prefixes of the path with as many characters, as some rule has."""
    ends = F.array(*[F.when(F.size(F.split(host, r"\.")) >= n, F.substring_index(host, ".", -n)) for n in label_counts])
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths])
    pairs = F.transform(F.array_compact(ends), lambda h: F.transform(F.array_compact(starts), lambda p: F.concat(h, p)))
    return F.flatten(pairs)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` positions in 64-bit words, ``hashes`` of them set for each key."""

    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.seed), F.lit(i), key), F.lit(self.bits)) for i in range(self.hashes)]

    def has(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        out = F.lit(True)
        for at in self.positions(key):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            out = out & (word.bitwiseAND(_bit(at)) != F.lit(0))
        return out


def _bit(at: Column) -> Column:
    """The 64-bit word that has only bit ``at`` modulo 64 set."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))


def make_level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A Bloom filter of the ``n`` keys with about the given rate of wrong passes."""
    rate = min(max(rate, 1e-15), 0.5)
    bits = 64 * math.ceil(max(1, n) * 1.44 * math.log2(1 / rate) / 64)
    empty = Level(seed, bits, max(1, round(math.log2(1 / rate))), (0,) * (bits // 64))
    at = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("at"))
    set_words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("v")).collect()
    words = list(empty.words)
    for row in set_words:  # at most bits / 64 rows, bounded through MAX_LISTED
        words[row["word"]] = row["v"]
    return Level(seed, bits, empty.hashes, tuple(words))


def build_cascade(listed: DataFrame, universe: DataFrame, seed: int = 17) -> list[Level]:
    """Levels over ``listed`` keys that are exact for each ``key`` of ``universe``."""
    inside, outside = listed.select("key").distinct(), universe.join(listed, "key", "left_anti")
    n, m = inside.count(), outside.count()
    levels: list[Level] = []
    rate = math.sqrt(0.5) * n / max(1, m)
    while n:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end")
        levels.append(make_level(inside, n, rate, seed + len(levels)))
        passed = stage(outside.where(levels[-1].has(F.col("key"))), "cascade")
        inside, outside, n, rate = passed, inside, passed.count(), 0.5
    return levels


def in_cascade(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: it is if the first level that it fails has an even number."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(~levels[i].has(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", max_listed: int = MAX_LISTED) -> DataFrame:
    """Each page's ``page_id, host, path, rule, verdict``; ``rules`` has ``host, path, verdict``."""
    rules = rules.where("host is not null and path is not null").select(
        F.concat("host", "path").alias("key"), "verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
    rules = rules.groupBy("key").agg(F.min("verdict").alias("verdict"), F.first("labels").alias("labels"), F.first("chars").alias("chars"))
    seen = rules.agg(F.count("*"), F.collect_set("labels"), F.collect_set("chars"), F.collect_set("verdict")).first()
    host, path = url_parts(F.col("url"))
    rows = narrow(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    if not seen[0]:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidate_keys(F.col("host"), F.col("path"), sorted(seen[1]), sorted(seen[2]))
    if seen[0] > max_listed:
        return _joined(rows.withColumn("keys", keys), rules, default)
    universe = stage(rows.select(F.explode(keys).alias("key")).distinct(), "universe")
    cascades = {v: build_cascade(rules.where(F.col("verdict") == v), universe) for v in sorted(seen[3])}
    tests = {v: (lambda k, c=c: in_cascade(c, k)) for v, c in cascades.items()}
    fitting = F.filter(keys, lambda k: _any(t(k) for t in tests.values()))
    longest = F.array_max(F.transform(fitting, lambda k: F.struct(F.length(k), F.length(F.substring_index(k, "/", 1)), k.alias("key"))))
    out = rows.withColumn("rule", longest["key"])
    verdict = F.lit(default)
    for v, test in tests.items():
        verdict = F.when(F.col("rule").isNotNull() & test(F.col("rule")), F.lit(v)).otherwise(verdict)
    return out.withColumn("verdict", verdict)


def _any(tests) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _joined(rows: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for lists too long for literals: one equi-join on the distinct keys, and a join back
    on the set of keys, so that equal pages meet once."""
    sets = rows.select("keys").distinct()
    best = F.max(F.struct(F.length("key"), F.length(F.substring_index("key", "/", 1)), "key", "verdict"))
    found = (sets.select("keys", F.explode("keys").alias("key")).join(rules, "key").groupBy("keys").agg(best.alias("best")))
    return rows.join(found, "keys", "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
