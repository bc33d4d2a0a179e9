import collections
import re

import pytest
from pyspark.sql import functions as F

from kandela.llm import mixing as M
from llm_cases import SF_SMALL, empty, few_partitions, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in capped]
        rest, all_w = total - sum(capped.values()), sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / all_w > most * sizes[s]]
        if not over:
            return capped | {s: rest * w[s] / all_w for s in left}
        capped |= {s: most * sizes[s] for s in over}


def check(rows):
    taken = collections.Counter()
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    targets = brute_targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(r.size for r in rows if r.source == s)


def test_targets_and_taken_words(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = M.mixed_sizes(docs).collect()
    assert {r.doc_id: r.size for r in rows} == {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    check(rows)
    assert sorted(M.mixed_sizes(docs.repartition(5)).collect()) == sorted(rows)


def test_tree_of_several_levels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(M.mixed_sizes(docs, fan=3).collect())


def test_mean_copies_follow_the_rate(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(300)], "doc_id long, text string, source string")
    extra = collections.Counter()
    for seed in range(6):
        for r in M.mixed_sizes(docs, seed=seed).collect():
            extra[r.size, r.source] += r.copies
            rate = r.target / r.source_size
    for (_, source), n in extra.items():
        assert n / 6 / 22 <= 2
    assert rate <= 2


def test_mix_repeats_rows(spark, odd):
    taken = collections.Counter()
    for r in M.mixed_sizes(odd).collect():
        taken[r.doc_id] += r.copies
    got = M.mix(odd)
    assert got.columns == odd.columns
    assert collections.Counter(r[0] for r in got.collect()) == +taken


def test_odd_rows(odd, empty):
    rows = M.mixed_sizes(odd).collect()
    assert len(rows) == odd.count()
    check(rows)
    assert {r.size for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert M.mixed_sizes(empty).collect() == [] and M.mix(empty).collect() == []


def test_no_python_in_the_plan(odd):
    for df in (M.mixed_sizes(odd), M.mix(odd)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_mix_agrees_after_a_shuffle_when_texts_differ_under_one_key(spark):
    rows = [(None, f"word{i} and more", "a", {"k": i % 3}) for i in range(40)] + [(1, "same words", "a", {"k": 1})] * 30 + [(i, "one two three", "b", None) for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, notes map<string,int>")

    def taken(d):
        return sorted(((r[0], r[1], r[2], str(r[3])) for r in M.mix(d, most=1.7).collect()), key=repr)

    first = taken(df.repartition(3))
    assert first == taken(df.orderBy("text").repartition(7)) and len(first) > len(rows)


def test_a_row_that_is_repeated_very_often_is_spread(spark, monkeypatch):
    from kandela.llm import common
    rows = spark.createDataFrame([(1, 1_000_000), (2, 3), (3, 0)], "doc_id long, n long")
    out = common.repeated(rows, "n", "i")
    assert out.groupBy("doc_id").agg(F.count("*"), F.countDistinct("i"), F.max("i")).orderBy("doc_id").collect() == [(1, 1_000_000, 1_000_000, 999_999), (2, 3, 3, 2)]
    monkeypatch.setattr(common, "CHUNK", 10_000)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in common.repeated(rows, "n", "i").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 1_000_003 and max(sizes) <= 250_000
