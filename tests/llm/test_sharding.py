import collections
import zlib

from kandela.llm import sharding as S
from llm_cases import SF_SMALL, empty, few_partitions, odd  # noqa: F401


def check(rows, n_shards):
    n = len(rows)
    sizes = collections.Counter(r.shard for r in rows)
    assert all(n // n_shards <= sizes[s] <= -(-n // n_shards) for s in range(n_shards))
    for s, k in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(k))
    for source, of in collections.Counter(r.source for r in rows).items():
        for s in range(n_shards):  # every shard holds the source's share, give or take rounding
            own = sum(r.source == source and r.shard == s for r in rows)
            assert abs(own - of * sizes[s] / n) <= 2


def test_shards_match_the_mixture(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = S.shard_rows(docs, 7).collect()
    check(rows, 7)
    want = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in want.items()}
    assert sorted(S.shard_rows(docs.repartition(5), 7).collect(), key=repr) == sorted(rows, key=repr)


def test_ranges_do_not_change_the_law(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 9)
    check(S.shard_rows(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 5).collect(), 5)


def test_odd_rows(spark, odd, empty):
    rows = S.shard_rows(odd, 3).collect()
    assert len(rows) == odd.count()
    check(rows, 3)
    by = {r.doc_id: r for r in rows}
    assert (by[3].size, by[3].text_crc32) == (8, 0) and by[4].size == 8
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert S.shard_rows(empty, 3).collect() == []
    many = odd.where("doc_id = 10").unionAll(odd.where("doc_id = 10")).unionAll(odd)  # one row a third of the table
    check(S.shard_rows(many, 3).collect(), 3)
