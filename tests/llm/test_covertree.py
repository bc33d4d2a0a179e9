import numpy as np

from kandela.llm import covertree as C
from llm_cases import few_partitions  # noqa: F401

KIND = "vec_id long, embedding array<double>, label int, n_links string, rep int"


def brute(rows, cosine=0.98):
    ok = {i: np.array(v) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    lab = {i: c for i, _, c in rows}
    links, up = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(ok)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            u, v = ok[a], ok[b]
            if lab[a] == lab[b] and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {i: (links[i], root(i), root(i) == i) for i in links}


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], KIND)
    got = C.near_vectors(df, **kw).collect()
    assert len(got) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def clustered(seed, dim=12):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(12):
        c = r.normal(size=dim)
        for _ in range(r.integers(1, 40)):
            rows.append((len(rows), (c + r.normal(size=dim) * r.choice([0.01, 0.06, 0.1])).tolist(), int(r.integers(0, 2))))
    rows += [(len(rows) + i, r.normal(size=dim).tolist(), 1) for i in range(60)]
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(70)]  # copies
    return rows


def test_trees_of_several_levels(spark):
    rows = clustered(1)
    want = brute(rows)
    assert max(n for n, _, _ in want.values()) > 60
    assert run(spark, rows, leaf=16) == want
    assert run(spark, rows) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1),
            (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [1e-200, 0.0], 1)]
    got = run(spark, rows)
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[13][0] == 3
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], KIND)
    assert C.near_vectors(df.limit(0)).collect() == []
    twice = C.near_vectors(df.where("vec_id in (3, 4)").unionAll(df.where("vec_id = 3"))).collect()
    assert sorted((r.vec_id, r.n_links) for r in twice) == [(3, 1), (3, 1), (4, 0)]


def test_pairs_at_the_threshold(spark):
    a = np.array([1.0, 0.0])
    rows = [(0, a.tolist(), 1)] + [(i, [c, float(np.sqrt(1 - c * c))], 1) for i, c in enumerate([0.98000001, 0.97999999, 0.985, 0.9], 1)]
    assert run(spark, rows) == brute(rows)


def separated(clusters, each, dim=32, noise=0.002, seed=3):
    r = np.random.default_rng(seed)
    c = r.normal(size=(clusters, dim))
    v = np.repeat(c, each, axis=0) + r.normal(size=(clusters * each, dim)) * noise
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_tree_in_a_block_halves_nests_and_covers():
    r = np.random.default_rng(5)
    v = np.concatenate([separated(12, 20), r.normal(size=(40, 32))])
    v = np.concatenate([v, v[:5]])  # equal vectors end in single ones too
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    order, t = C.grow(v, 7)
    assert sorted(order) == list(range(len(v))) and order[t["centre"][0]] == 7
    w, depth = v[order], np.zeros(len(t["centre"]), int)
    for i, (c, radius, a, b, kid, kids) in enumerate(zip(*(t[x] for x in C.NODES), strict=True)):
        assert a <= c < b and np.linalg.norm(w[a:b] - w[c], axis=1).max() <= radius + 1e-12
        assert (kids == 0) == (b - a == 1)
        if kids:
            below = range(kid, kid + kids)
            depth[kid:kid + kids] = depth[i] + 1
            assert t["centre"][kid] == c or radius <= C.SLACK
            assert t["start"][kid] == a and t["stop"][kid + kids - 1] == b
            assert all(t["radius"][k] <= radius / 2 + 1e-9 for k in below)
            assert all(t["stop"][k] == t["start"][k + 1] for k in list(below)[:-1])
    assert depth.max() >= 3
    assert all(radius <= 2.0 ** (1 - d) for radius, d in zip(t["radius"], depth, strict=True))


def test_traversal_of_separated_clusters_prunes():
    v = separated(25, 20)
    order, t = C.grow(v, 0)
    hits, whole, seen = C.traverse(v[order], t, v[order], t, 0.98, True)
    assert seen < len(v) ** 2 / 100  # 25 clusters against each other, no more
    assert len(hits) == 0 and {(a, b) for a, b in whole.tolist()} == {(a, a) for a, _ in whole.tolist()} and len(whole) == 25


def test_passes_prune_pairs_of_nodes(spark):
    v = separated(60, 40)
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    classes = spark.createDataFrame([(i, 1, x.astype("<f8").tobytes(), "t") for i, x in enumerate(v)], "rep long, weight long, raw binary, tree string")
    leaves, levels, roots = C.build(classes, 0.98, 64)
    n = leaves.select("node").distinct().count()
    pairs = C.node_pairs(levels, roots, 0.98).collect()
    assert levels and n >= 50 and len(pairs) <= n * (n + 1) / 4 and sum(p.whole for p in pairs) >= 50
    assert run(spark, rows, leaf=64) == {i: (39, i - i % 40, i % 40 == 0) for i in range(len(rows))}


def test_dense_groups_are_linked_as_a_whole(spark):
    """A group of near copies, larger than a block, is neither split nor compared; another, wider than the threshold,
    that no centres can halve, is split until it is blocks."""
    r = np.random.default_rng(8)
    tight = separated(1, 700)
    wide = separated(1, 500, noise=0.14, seed=9)
    rows = [(i, x.tolist(), i % 10 // 9) for i, x in enumerate(np.concatenate([tight, wide, r.normal(size=(150, 32))]))]
    assert run(spark, rows, leaf=48) == brute(rows)
