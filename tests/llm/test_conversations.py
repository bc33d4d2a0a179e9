import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np

from kandela.llm import conversations as C
from kandela.llm.queries import QUERIES
from llm_cases import SF_SMALL, few_partitions  # noqa: F401

WORD_CHAR = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).hexdigest()))


def expected(rows):
    """Everything by search: states ordered by (cost, audit), so that the first one that ends is the answer."""
    turns = {t for t, _, _ in rows if t is not None}
    faults, seen = [], set()
    for _, role, text in rows:
        chars = WORD_CHAR.findall(text)
        faults.append("blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, at, lines = heapq.heappop(heap)
        if i == len(rows) and at in ("", "a"):
            break
        if (i, at) in done:
            continue
        done.add((i, at))
        new = NEXT[at]
        heapq.heappush(heap, (cost + 5, audit + "I", i, new, lines + (f"{ROLE[new]}:",)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, at, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] else 0
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, new, lines + (f"{ROLE[new]}:{text}",)))
                if role[:1] == new or role[:1] == "s" and at == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], lines + (f"{role}:{text}",)))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def want(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    return {conv: expected(damage(own)) for conv, own in by.items()}


def got(df):
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def made(conversations=150, longest=25, seed=5):
    r = random.Random(seed)
    out = []
    for c in range(conversations):
        for t in range(r.randrange(1, longest)):
            text = r.choice(["yes.", "no!", "what?", "cut of", f"own {c} {t}.", f"own {c} {t}", "", " \t", None])
            out.append((r.choice([c, c, c, None]), r.choice([t, t, t, 2 * t, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return out


def test_corpus_against_search(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    result = got(QUERIES["op11_conversation_repair"](spark, SF_SMALL))
    assert result == want([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert sum("I" in v[6] for v in result.values()) + sum("R" in v[6] for v in result.values()) > 3


def test_made_conversations_against_search(spark):
    rows = [r for r in made() if r[0] is not None]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(C.repair_digests(C.damaged(df))) == want(rows)


def test_conversations_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 3)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    rows = made(8, 60, seed=9)  # a fifth has no conv_id: one large conversation
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = C.repaired_blocks(C.damaged(df))
    assert blocks.groupBy("conv_id").count().agg({"count": "max"}).first()[0] > 10
    assert got(C.repair_digests(C.damaged(df))) == want(rows)


def test_block_costs_are_those_of_the_whole():
    r = random.Random(2)
    for _ in range(200):
        kinds = [np.array([r.choice([0, 1, 2, 3, 2, 3, 10, 11, 6, 9]) for _ in range(r.randrange(1, 9))]) for _ in range(2)]
        whole = C._backwards([np.concatenate(kinds)], C.END[None])[0]
        second = C._block_costs([kinds[1]], C.END[None], np.array([True]))[0]
        first = C._block_costs([kinds[0]], second[:1], np.array([False]))[0]
        assert (first[0] == whole[0]).all() and (second == whole[len(kinds[0]):]).all()


def test_odd_rows(spark):
    rows = [(1, 0, "user", "A word " * 200_000 + "end."), (1, 1, "assistant", "Fine."), (2, None, None, None), (3, None, "user", "Hm."), (3, None, "user", "Hm."), (None, 4, "user", None)]
    df = spark.createDataFrame([(*r, 1, "x", 7) for r in rows], SCHEMA + ", place long, audit string, n long")
    assert got(C.repair_digests(C.damaged(df))) == want(rows)
    whole = got(C.repair_digests(df.drop("audit")))  # rows as they are, without damage
    assert whole[3][:6] == (0, 0, 1, 0, 1, 2 + 2) and whole[1][5:7] == (0, "KK")
    assert C.repair_digests(C.damaged(df.limit(0))).collect() == []
    # a conversation whose only row is dropped
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = spark.createDataFrame([(conv, 0, "user", "Gone.")], SCHEMA)
    assert got(C.repair_digests(C.damaged(gone))) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
