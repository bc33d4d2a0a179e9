import collections
import random
import re

import numpy as np

from kandela.llm import spans as S
from kandela.llm.words import hash_spans
from llm_cases import SF_SMALL, empty, few_partitions, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def of_word(word, memo={}):  # noqa: B006
    if word not in memo:
        b = np.frombuffer(word.encode(), np.uint8)
        memo[word] = int(hash_spans(b, np.array([0]), np.array([len(b)]))[0])
    return memo[word]


def sentences(text):
    whole, own = [], []
    found = list(WORD.finditer(text))
    for k, m in enumerate(found):
        own.append((m.start(), m.group().translate(LOWER)))
        gap = text[m.end():found[k + 1].start()] if k + 1 < len(found) else "\n"
        if own[-1][1][-1] in ".!?" or "\n" in gap:
            whole.append(own)
            own = []
    out = []
    for own in whole:
        ends = {len(own)}
        if len(own) > S.LONG:
            h = [of_word(w) for _, w in own]
            ends |= {a + h[a:a + S.WINDOW].index(min(h[a:a + S.WINDOW])) + 1 for a in range(len(own) - S.WINDOW + 1)}
        begin = 0
        for e in sorted(ends):
            out.append((own[begin][0], tuple(w for _, w in own[begin:e])))
            begin = e
    return out


def brute(docs):
    """Text and number of removed sentences of each document."""
    parts, seen = {i: sentences(t or "") for i, t in docs.items()}, collections.defaultdict(list)
    for i in sorted(parts):
        own = parts[i]
        size = [len(w) for _, w in own]
        shortest = set()
        for k in range(len(own)):
            shortest |= {(k, e) for e in range(k + 1, min(len(own), k + S.MIN_WORDS) + 1) if sum(size[k:e - 1]) < S.MIN_WORDS <= sum(size[k:e])}
            shortest |= {(a, k + 1) for a in range(max(0, k - S.MIN_WORDS), k + 1) if sum(size[a + 1:k + 1]) < S.MIN_WORDS <= sum(size[a:k + 1])}
        for a, e in sorted(shortest):
            seen[tuple(w for _, w in own[a:e])].append((i, a, e))
    gone = collections.defaultdict(set)
    for found in seen.values():
        for i, a, e in found[1:]:
            gone[i] |= set(range(a, e))
    out = {}
    for i, t in docs.items():
        edges = [a for a, _ in parts[i]] + [len(t or "")]
        out[i] = (t if not gone[i] else t[:edges[0]] + "".join(t[edges[k]:edges[k + 1]] for k in range(len(parts[i])) if k not in gone[i]), len(gone[i]))
    return out


def test_corpus_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_removed) for r in S.remove_repeats(docs).collect()}
    want = brute({r.doc_id: r.text for r in docs.collect()})
    assert got == want and sum(n > 0 for _, n in want.values()) > 5


def test_passages_are_caught_and_the_rest_stays(spark):
    r = random.Random(6)

    def prose(n):
        return " ".join(" ".join(f"w{r.randrange(5000)}" for _ in range(r.randrange(4, 14))).capitalize() + "." for _ in range(n))
    passage = prose(8)
    docs = {i: prose(6) + " " + (passage + " " if i % 5 == 2 else "") + prose(5) for i in range(40)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in S.remove_repeats(df).collect()}
    assert [i for i in docs if got[i].n_removed] == [i for i in docs if i % 5 == 2 and i != 2]
    assert all(got[i].text == docs[i].replace(passage + " ", "") for i in docs if i != 2) and got[2].text == docs[2]


def test_only_long_sentences_have_ends_inside():
    text = "One two three four. Five six seven eight nine ten eleven twelve\nthirteen! " + " ".join(f"w{i}" for i in range(60))
    data = np.frombuffer(text.encode(), np.uint8)
    first, _, size, _ = S.sentences(data, np.array([0, len(data)]))
    assert list(size[:3]) == [4, 8, 1] and max(size) <= S.WINDOW and size.sum() == 73
    assert [a for a, _ in sentences(text)] == list(first)


def test_odd_rows(odd, empty):
    got = S.remove_repeats(odd)
    assert got.columns == [*odd.columns, "n_removed", "words_removed"]
    rows = got.collect()
    assert len(rows) == odd.count()
    by = {r[0]: r for r in rows}
    want = brute({r[0]: r[1] for r in odd.collect() if r[0] is not None})
    assert {i: (r[1], r["n_removed"]) for i, r in by.items() if i is not None} == want
    assert by[3][1] is None and by[1]["n_removed"] == 0 and by[6][1] == by[7][1] == "two words"
    assert S.remove_repeats(empty).collect() == []


def test_passages_of_51_words_are_caught_at_any_offset(spark):
    """Passages of one, two and three sentences that begin and end within sentences of other texts."""
    r = random.Random(9)
    docs, planted = {}, {}
    for k in range(60):
        passage = [f"p{k}x{r.randrange(5000)}" for _ in range(51)]
        for at in [[], [25], [16, 33]][k % 3]:
            passage[at] += "."
        for copy in (0, 1):
            i = 2 * k + copy
            docs[i] = " ".join([*(f"a{i}x{r.randrange(5000)}" for _ in range(r.randrange(40, 90))), *passage, *(f"b{i}x{r.randrange(5000)}" for _ in range(r.randrange(40, 90)))])
            planted[i] = passage
    got = {r.doc_id: r for r in S.remove_repeats(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    for i, t in docs.items():
        left = got[i].text.split()
        assert [w for w in left if w[0] != "p"] == [w for w in t.split() if w[0] != "p"]
        assert sum(w in left for w in planted[i]) <= (51 if i % 2 == 0 else 25), i
    assert all(got[i].text == docs[i] for i in docs if i % 2 == 0)


def test_rows_without_an_id_and_of_one_id_are_judged_by_their_texts(spark):
    r = random.Random(12)

    def prose(n):
        return " ".join(" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(9)) + "." for _ in range(n))
    passage, lone = prose(6), prose(6)
    a, b, c, d = (prose(6) for _ in range(4))
    rows = [(1, passage), (None, passage + " " + a), (None, b), (7, c), (7, passage + " " + d), (None, lone), (None, lone)]
    got = [(x.doc_id, x.text.split()) for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    for own, i in [(a, None), (b, None), (c, 7), (d, 7)]:  # unique words stay, and of the passage no more than the end of a span
        left = next(t for k, t in got if k == i and t[-1] == own.split()[-1])
        assert left[-54:] == own.split() and len(left) < 54 + 16
    assert (1, passage.split()) in got
    assert sorted(len(t) for i, t in got if i is None and set(t) <= set(lone.split())) in [[n, 54] for n in range(16)]
