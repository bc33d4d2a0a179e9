import collections
import random
import re

from kandela.llm import minhash as M
from kandela.llm.components import components
from llm_cases import LONG, SF_SMALL, empty, few_partitions, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute(docs, percent=85):
    """Set size and smallest reachable id, comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs.items()}
    holders, shared, up = collections.defaultdict(list), collections.Counter(), {i: i for i in docs}
    for i, s in sets.items():
        for x in s:
            shared.update((j, i) for j in holders[x])
            holders[x].append(i)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in docs}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_corpus_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert result(M.near_duplicates(docs)) == brute({r.doc_id: r.text for r in docs.collect()})


def near_copies():
    """Groups whose pairs lie on both sides of the threshold, one passage that many texts share, and copies."""
    r = random.Random(11)
    docs, words = {}, [f"w{i}" for i in range(4000)]
    for g in range(6):
        base = r.choices(words, k=r.choice([40, 120, 300]))
        for _ in range(45):
            own = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 5])):
                own[r.randrange(len(own))] = r.choice(words)
            docs[len(docs)] = " ".join(own)
    passage = r.choices(words, k=60)
    for _ in range(150):
        docs[len(docs)] = " ".join(r.choices(words, k=r.choice([8, 15, 25])) + passage)
    docs |= {len(docs) + i: docs[3] for i in range(80)}
    return docs


def test_groups_against_all_pairs(spark, monkeypatch):
    docs = near_copies()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = brute(docs)
    assert len({c for _, c, _ in want.values()}) > 20
    assert result(M.near_duplicates(df)) == want
    # the comparison of blocks alone, in many blocks
    monkeypatch.setattr(M, "_verify", lambda pairs, sets: pairs.selectExpr("a", "b", "0L both", "1L either"))
    monkeypatch.setattr(M, "BLOCK", 600)
    assert result(M.near_duplicates(df)) == want


def test_threshold_is_inclusive(spark):
    # 17 of 20 shingles: 85 %; 16 of 20: less
    a = [f"a{i}" for i in range(22)]
    docs = {1: " ".join(a[:22]), 2: " ".join(a[:21]), 5: " ".join(f"b{i}" for i in range(24)), 6: " ".join(f"b{i}" for i in range(20))}
    got = result(M.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")))
    assert got == brute(docs) and got[2][1] == 1 and got[6][1] == 6


def test_odd_rows(spark, odd, empty):
    got = M.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    want = brute({r[0]: r[1] for r in odd.collect() if r[0] is not None})
    assert {i: v for i, v in by.items() if i is not None} == want
    assert by[None][1:] == (None, True) and by[3] == (0, 3, True) and by[5] == (0, 5, True)
    assert by[7][1] == 6 and by[2][1] == 1  # the same two words; case and blanks don't matter
    assert M.near_duplicates(empty).collect() == []
    kept = M.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r[0] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9, 10, 10]
    assert M.one_of_each(empty).collect() == []


def test_very_long_text_is_taken_whole(spark):
    other = LONG.replace("word976 word0", "changed here", 3)
    docs = {1: LONG, 2: other, 3: LONG + " tail"}
    assert result(M.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))) == brute(docs)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 180)]
    star = [(7, i) for i in range(1000, 1100)] + [(5, 1050)]
    edges = spark.createDataFrame(path + star + [(3, 3), (None, 4)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 100 for i in range(100, 181)} | {i: 5 for i in [5, 7, *range(1000, 1100)]}
    assert components(edges.limit(0)).collect() == []


def test_one_of_each_judges_rows_not_ids(spark):
    r = random.Random(4)
    a, b, c, d, e = (" ".join(r.choices([f"w{i}" for i in range(4000)], k=60)) for _ in range(5))
    rows = [(1, a, "x"), (None, a + " end", "x"), (None, b, "x"),  # the copy without an id goes alone
            (5, c, "x"), (5, a + " more", "x"),  # of a repeated id only the copy goes
            (None, d, "x"), (None, d, "x"), (None, d, "y"), (None, d + " end", "x"),  # one of a group without ids
            (8, e, "x"), (8, e.upper(), "x"), (8, e, "y"), (9, e, "x"), (None, None, "x"), (None, " ", "x"), (None, " ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    kept = sorted(((i, t and t.strip().lower().removesuffix(" end")) for i, t, _ in M.one_of_each(df).collect()), key=repr)
    assert kept == sorted([(1, a), (None, b), (5, c), (None, d), (8, e), (None, None), (None, ""), (None, "")], key=repr)


def near_group(n, seed=6):
    """Copies of one text, with a few words changed in each."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    base = r.choices(words, k=300)
    out = {}
    for i in range(n):
        own = list(base)
        for _ in range(r.randrange(1, 6)):
            own[r.randrange(len(own))] = r.choice(words)
        out[i] = " ".join(own)
    return out


def test_links_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    made, plain = [], M.components

    def counted(edges):
        made[-1] += edges.distinct().count()
        return plain(edges)

    monkeypatch.setattr(M, "components", counted)
    monkeypatch.setattr(M, "BLOCK", 6000)  # about 20 texts
    for n in (200, 400):
        made.append(0)
        docs = near_group(n)
        assert result(M.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))) == brute(docs)
    assert made[0] > 150 and made[1] <= 2.2 * made[0], made


def test_rows_without_an_id_are_fetched_once(spark, monkeypatch):
    docs = list(near_group(500).values())
    docs = [*docs, *docs]
    df = spark.createDataFrame([(None, t) for t in docs], "doc_id long, text string")
    seen = []
    plain = M.stage

    def counted(rows, name, *batch):
        out = plain(rows, name, *batch)
        if name == "sets":
            seen.append(out.count())
            text = rows  # classes, each once
            assert text.count() == out.count()
        return out

    monkeypatch.setattr(M, "stage", counted)
    passed = spark.sparkContext.accumulator(0)
    sets = M._sets

    def passing(batches):
        def told():
            for b in batches:
                passed.add(b.num_rows)
                yield b
        return sets(told())

    monkeypatch.setattr(M, "_sets", passing)
    rows = M.near_duplicates(df).collect()
    assert len(rows) == len(docs) and seen[0] <= 500
    assert passed.value <= 3 * len(docs)  # counted again by the checks above
