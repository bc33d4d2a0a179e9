import itertools
import random

from kandela.llm import hamming as H
from llm_cases import few_partitions  # noqa: F401

KIND = "vec_id long, embedding array<float>, label int, id long, rank string"


def brute(rows, k, every=50):
    bits = max(len(v) for _, v in rows)
    code = {i: [v[j] is not None and v[j] == v[j] and v[j] > 0 if j < len(v) else False for j in range(bits)] for i, v in rows}
    out = set()
    for q in code:
        if q % every == 0:
            near = sorted((sum(x != y for x, y in zip(code[q], code[i], strict=True)), i) for i in code if i != q)[:k]
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near)}
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, 0, "x") for i, v in rows], KIND)
    return {(r.query_id, r["rank"], r.vec_id, r.distance) for r in H.top_k(df, **kw).collect()}


def test_groups_of_copies_and_random_codes(spark):
    r = random.Random(2)
    base = [r.gauss(0, 1) for _ in range(24)]
    rows = [(i, [r.gauss(0, 1) for _ in range(24)]) for i in range(240)]
    rows += [(240 + i, base) for i in range(120)]  # a third are copies
    rows += [(360 + i, [x if r.random() > 0.1 else -x for x in base]) for i in range(60)]
    assert run(spark, rows, k=7) == brute(rows, 7)


def test_odd_vectors(spark):
    rows = [(0, [1.0, -1.0, 0.0]), (50, [1.0, None, float("nan")]), (1, [1.0]), (2, [-1.0, 2.0, 3.0, 4.0]), (3, [1.0, -1.0, 0.0])]
    assert run(spark, rows, k=3) == brute(rows, 3)
    df = spark.createDataFrame([(i, v, 1, 0, "x") for i, v in [*rows, (100, None), (150, []), (200, [None, None]), (None, [1.0]), *rows]], KIND)
    assert {(r.query_id, r["rank"], r.vec_id, r.distance) for r in H.top_k(df, k=3).collect()} == brute(rows, 3)
    assert H.top_k(df.limit(0), k=3).collect() == []
    assert run(spark, rows[:1], k=3) == set()


def test_widths_cover_all_bits():
    for bits in (1, 7, 64, 100):
        for n in (0, 3, 1000, 10**12):
            w = H.segment_widths(bits, n)
            assert sum(w) == bits and max(w) <= H.MAX_WIDTH and max(w) - min(w) <= 1


def test_masks_are_all_sets_of_bits():
    for w, r in ((1, 0), (4, 4), (13, 3), (16, 5), (4, 5)):
        want = sorted(sum(1 << b for b in c) for c in itertools.combinations(range(w), r))
        got = [int(m) for a in range(0, max(1, len(want)), 100) for m in H.masks(w, r, a, a + 100)]
        assert got == want
    assert H.masks(30, 15, 155117519, 155117600).tolist() == [(1 << 30) - (1 << 15)]
