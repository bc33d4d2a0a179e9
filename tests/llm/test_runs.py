import hashlib
import random
import re
import zlib

import numpy as np

from kandela.llm import runs as R
from kandela.llm.queries import QUERIES
from llm_cases import LONG, SF_SMALL, empty, few_partitions, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Runs by extending every stretch in which words some period apart are equal."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in best.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_made_words_against_brute_force():
    r = random.Random(3)
    for trial in range(400):
        words = [r.randrange(r.choice([1, 2, 3, 9])) for _ in range(r.randrange(60))]
        if trial % 2:  # periods inside periods
            base = [r.randrange(3) for _ in range(r.randrange(1, 9))]
            words = words[:9] + base * r.randrange(2, 9) + words[9:20] + (base + [7]) * r.randrange(1, 5)
        for least in (2, 5, 12):
            assert R.find_runs(np.array(words, np.int64), least) == brute(words, least), words


def test_corpus_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 6000")
    got = {r[0]: tuple(r) for r in R.run_digests(docs).collect()}
    want = {r.doc_id: expected(r.doc_id, r.text) for r in docs.collect()}
    assert got == want and sum(w[1] > 0 for w in want.values()) > 5
    assert QUERIES["op12_maximal_pair_runs"](spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_one_word_many_times_and_lines_with_other_neighbours():
    n = 30_000
    assert R.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    line = list(range(8))
    words = np.array([w for i in range(3000) for w in [100 + i, *line, 10_000 + i % 7]], np.int64)
    assert R.find_runs(words) == []
    assert R.find_runs(np.array(line * 2000 + [9] + line * 3, np.int64)) == [(0, 16_000, 8), (16_001, 24, 8)]


def test_odd_rows(spark, odd, empty):
    got = sorted(map(tuple, R.run_digests(odd).collect()), key=repr)
    rows = [(r[0], r[1]) for r in odd.collect()]
    short = sorted((expected(*r) for r in rows if r[0] != 8), key=repr)
    assert [g for g in got if g[0] != 8] == short
    nothing = hashlib.sha256(b"").hexdigest()
    assert next(g for g in got if g[0] == 3) == (3, 0, None, None, None, None, nothing, nothing)
    long = next(g for g in got if g[0] == 8)
    assert long[1:5] == (1, 0, len(LONG.split()) - 1, 977)  # the last word has a full stop
    assert R.run_digests(empty).collect() == []
    plain = {r.doc_id: r for r in R.periodic_runs(odd).collect()}
    assert len(plain[8].collapsed.split()) == 978 and plain[7].runs == []
