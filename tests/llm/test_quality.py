import zlib

import numpy as np
from pyspark.sql import functions as F

from kandela.llm import quality as Q
from llm_cases import SF_SMALL, empty, few_partitions, odd  # noqa: F401

SF_MID = SF_SMALL.replace("0.001", "0.01")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    seen = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = (np.array([s for s, q in seen if q == v]) for v in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([(s >= 0.5) == q for s, q in seen]) > 0.95
    # labels of held-out rows are never used
    other = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in Q.judge(docs.repartition(3), other).collect()} == {i: r.score for i, r in got.items()}
    # a smaller bound of the sample changes the model, not what is scored
    assert Q.judge(docs, labels, max_train=50).count() == len(got)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 1, 0, "x"), (5, 0, 1, "x"), (6, 0, 0, "x"), (8, None, 0, "x"), (None, 1, 1, "x"), (9, 7, 0, "x")], "doc_id long, quality int, toxic int, text string")
    rows = Q.judge(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[3].score == by[4].score == by[5].score and by[None].held_out is False
    assert {r.score for r in Q.judge(odd, labels.limit(0)).collect()} == {0.5}
    assert Q.judge(empty, labels).collect() == []
    kept = Q.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted for r in rows)


def test_features_do_not_depend_on_the_neighbours():
    texts = ["One two two!! three", "", "x", "äöü ÄÖ 12,5 $$$ a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0] + [len(t.encode()) for t in texts])
    place, value, ahead = Q.features(data, at)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode(), np.uint8)
        p, v, _ = Q.features(b, np.array([0, len(b)]))
        own = slice(ahead[i], ahead[i + 1])
        assert sorted(zip(p, v, strict=True)) == sorted(zip(place[own], value[own], strict=True))


def test_the_bound_holds_for_an_id_that_many_rows_share(spark):
    i = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1)
    docs = spark.range(20_000).selectExpr(f"if(id < 19000, {i}, id) as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(i, 1), (i, 1), (i, 0), *((i, i % 2) for i in range(19_000, 19_400))], "doc_id long, quality int")
    rows = Q.training_rows(docs, labels, max_train=100).collect()
    assert 50 < len(rows) <= 100 and len({(r.h, r.quality) for r in rows}) == len(rows)
    own = [r.text for r in Q.training_rows(docs, labels).collect() if r.text in {f"text {i}" for i in range(19_000)}]
    assert len(own) == 2 and own == [r.text for r in Q.training_rows(docs.repartition(7), labels).collect() if r.text in own]
