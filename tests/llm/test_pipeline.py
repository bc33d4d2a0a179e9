import collections

import corpus_pipeline as C
import __spark_entry__ as E
from kandela.llm import mixing, packing, quality, secrets
from kandela.llm.common import stage, table
from llm_cases import SF_SMALL, few_partitions  # noqa: F401
from test_minhash import brute


def test_stages_take_effect(spark):
    docs = table(spark, SF_SMALL, "documents")
    labels = table(spark, SF_SMALL, "labels")
    names, out = docs.columns, [docs]
    for name, apply in C.STAGES:
        out.append(stage(apply(spark, out[-1], SF_SMALL), "test"))
        if name != "packing":
            assert out[-1].columns == names
    rows = [[tuple(r) for r in d.collect()] for d in out[:5]]
    text = [{r[0]: r[1] for r in rs} for rs in rows]
    good = {r.doc_id for r in quality.judge(out[0], labels).collect() if r.predicted}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r[0] in good) and 0 < len(good) < len(rows[0])
    kept = {i for i, (_, c, _) in brute(text[1], C.NEAR_PERCENT).items() if c == i}
    assert sorted(rows[2]) == sorted(r for r in rows[1] if r[0] in kept) and len(kept) < len(rows[1])
    found = {r.doc_id for r in secrets.findings(out[2]).collect() if r.is_secret}
    assert set(text[3]) == set(text[2]) and {i for i in text[3] if text[3][i] != text[2][i]} == found
    copies = {r.doc_id: r.copies for r in mixing.mixed_sizes(out[3]).collect()}
    assert collections.Counter(r[0] for r in rows[4]) == +collections.Counter(copies)
    pieces = [tuple(r) for r in out[5].select("doc_id", "piece", "length", "ids_crc32").collect()]
    assert sorted(pieces) == sorted(tuple(r) for r in packing.cut_pieces(out[4]).select("doc_id", "piece", "length", "ids_crc32").collect())
    assert out[5].selectExpr("max(offset + length)").first()[0] <= 4096


def test_queries_are_registered():
    numbers = {int(k[2:].split("_")[0]) for k in E.queries() if k.startswith("op") and k[2:3].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in E.queries()
    assert {"op2_multi_index_hamming", "op9_bloom_cascade", "op10_cover_tree"} <= set(E.oracle_sql())


def test_run_gives_the_last_stage(spark):
    rows = E.queries()["pipeline"](spark, SF_SMALL)
    assert rows.count() > 100 and rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
