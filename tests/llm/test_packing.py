import collections
import math
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kandela.llm import packing as P
from llm_cases import SF_SMALL, empty, few_partitions, odd  # noqa: F401

TOKENIZER = Tokenizer.from_file(P.vocabulary_path())


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs):
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc_id, text in docs.items():
        want = ids(text)
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(want) // 4096)))
        for r in own:
            part = want[r.start:r.start + 4096]
            assert r.start == 4096 * r.piece and r.length == len(part)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


def gapless(rows):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    return len(bins)


def test_round_trip(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = P.pack_documents(docs).collect()
    check(rows, {r.doc_id: r.text for r in docs.collect()})
    gapless(rows)
    least = math.ceil(sum(r.length for r in rows) / 4096)
    assert len({r.sequence_id for r in rows}) <= least + 1


def test_odd_rows(odd, empty):
    rows = P.pack_documents(odd).collect()
    docs = {r[0]: r[1] for r in odd.collect()}
    check([r for r in rows if r.doc_id != 10], {i: t for i, t in docs.items() if i != 10})
    gapless(rows)
    assert len([r for r in rows if r.doc_id == 10]) == 2
    assert [r.length for r in rows if r.doc_id == 3] == [1]
    assert P.pack_documents(empty).collect() == []


def test_plan_uses_all_pieces_and_few_sequences():
    random.seed(3)
    for capacity, lengths in ((4096, [min(4096, int(random.lognormvariate(6.5, 1)) + 1) for _ in range(3000)]), (64, [33] * 50 + [31] * 50 + [1] * 7), (64, [64, 1]), (64, [])):
        counts = collections.Counter(lengths)
        types = P.make_plan(dict(counts), capacity, unit=1 if capacity == 64 else P.UNIT)
        placed = collections.Counter()
        for own, n in types:
            assert sum(own) <= capacity
            for x in own:
                placed[x] += n
        assert placed == counts
        assert sum(n for _, n in types) <= math.ceil(sum(lengths) / capacity * 1.002) + 1


def test_configuration_is_the_best_one():
    random.seed(4)
    for _ in range(20):
        prices = np.array([random.random() * (random.random() > 0.3) for _ in range(9)])

        def best(c):
            return max([0.0] + [prices[k - 1] + best(c - k) for k in range(1, min(c, 9) + 1) if prices[k - 1] > 0])
        got = P.best_configuration(prices, 12)
        assert sum(k * n for k, n in got.items()) <= 12
        assert abs(sum(prices[k - 1] * n for k, n in got.items()) - best(12)) < 1e-9


ALPHABET = st.one_of(st.characters(codec="utf-8"), st.sampled_from(list(" \n\t'.,!<|>AZazéßÑİΣ0189\x1c\x85\xa0　́")))


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_encoder_equals_the_tokenizer(text):
    assert P.encoder(P.vocabulary_path()).encode(text) == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_special_tokens_are_found_as_the_tokenizer_finds_them():
    for text in ("<|endoftext|> x", "a<|startoftext|>b", "<|ENDOFTEXT|>", "I'm don't. O'S the's"):
        assert P.encoder(P.vocabulary_path()).encode(text) == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
