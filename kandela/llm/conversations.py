"""Repair of conversations by cheapest edits, with least audits by prefix doubling.

A repaired conversation has roles whose initials read ``(s?(ua)+)?``. A row is kept (K, costs 0), given
the role that fits (R, 1) or deleted (D, 2; blank rows and repeats always are), and rows without text
can be inserted anywhere (I, 5); a truncated row that isn't deleted adds 5. The audit holds the initials
of the edits in order; of all cheapest repairs the one with the ASCII-least audit counts.

An edit leads from a node (rows done, role before) to another, and an audit is a path. What the roles
allow next is known from the last one (nothing yet, s, u, a), so a node has one arc at most for each letter.

1. Rows are dealt to ranges of (conversation, turn, role, text) and cut into blocks of at most
   ``BLOCK_ROWS`` rows and ``BLOCK_BYTES`` of text of one conversation. A conversation that holds a third
   of all rows is many blocks in many tasks; nearly all others are one block.
2. Cost DP. For a conversation of several blocks, costs from each role at a block's begin to each at its
   end (4 x 4) are combined from the last block to the first by doubling: in round k a block takes in
   what the block 2^k further on has. So each block knows what is still to be paid behind it.
3. In a block, going backwards, every node gets its cost to the end; arcs on a cheapest path remain.
4. Path ranking. For audits of 1, 2, 4 ... letters the remaining arcs are ranked by (rank of the first
   half, rank of what the pointer leads to), with pointers doubled along. Of a node's arcs that with the
   least rank is on its least path; the path from the first node is read off the doubled pointers.
5. Which role a block ends with, by the role it begins with, is again combined by doubling along the
   blocks; then every block writes its part of the audit and of the repaired rows, and the parts of a
   conversation are put together as a stream of blocks (the digest of a conversation's text is sequential
   by nature; it needs one block at a time in memory).

Nulls: a null role or text is one blank, a null turn comes before all others, and rows without a conv_id
are one conversation. Rows with equal turns follow each other by role and text; which of equal rows is
first cannot matter, the first stays and the others are repeats. An empty role fits nowhere. Very
long texts are blocks of their own. Conversations that the damage leaves without rows have zeros, an empty
audit and the digest of no bytes. An empty table gives no rows. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import narrow, stage

BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 20
#: Costs of the edits and of a truncated row that stays.
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Roles before a node: none yet, system, user, assistant; and the one that a new or retyped row gets then.
START, S, USER, A = range(4)
NEXT = np.array([USER, USER, A, USER])
NAMES = ["", "", "user", "assistant"]  # of a role that an edit gives
FAR = 1 << 40
#: What is still to be paid behind the last row, by the role before: both, both, an assistant, nothing.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
#: Initials of delete, insert, keep and retype (rerole).
LETTERS = b"DIKR"
_WORD_CHAR = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults by the checksum of ``conv_id:turn``: in twenty, one is dropped (stays, marked
    ``gone``, so that no conversation is lost), one emptied, one without its sentence ends, one repeated,
    one spoken by the user."""
    rows = narrow(rows, "conv_id", "turn", "role", "text")
    blank = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    h = F.crc32(F.encode(F.concat(text("conv_id"), F.lit(":"), text("turn")), "UTF-8")) % 20
    out = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(h == 4, "user").otherwise(text("role")).alias("role"),
                      F.when(h == 1, "").when(h == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"), (h == 0).alias("gone"),
                      F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return out.drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``again`` (role and text came before in the conversation), in ranges, in order."""
    plain = narrow(rows, "conv_id", "turn", "role", "text", "gone")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = plain.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), F.coalesce("gone", F.lit(False)).alias("gone"))
    # a number tells equal rows apart; the file keeps it the same for all readers
    plain = stage(plain.withColumn("n", F.monotonically_increasing_id()).withColumn("said", F.md5(F.concat_ws("\0", "role", "text"))), "turns")
    order = [F.col("turn").asc_nulls_first(), "role", "said", "n"]
    said = plain.where("not gone").groupBy("conv_id", "said").agg(F.count("*").alias("c"), F.min(F.struct("turn", "n")).alias("first")).where("c > 1")
    said = said.select(F.col("conv_id").alias("c_id"), F.col("said").alias("c_said"), F.col("first.n").alias("first"))
    both = plain.join(said, F.col("conv_id").eqNullSafe(F.col("c_id")) & (F.col("said") == F.col("c_said")), "left")
    both = both.select("conv_id", "turn", "role", "text", "gone", "said", "n", (~F.col("gone") & F.coalesce(F.col("first") != F.col("n"), F.lit(False))).alias("again"))
    return both.repartitionByRange(F.col("conv_id").asc_nulls_first(), *order).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


_BLOCK = ("part int, block int, roles array<string>, texts array<string>, kinds binary, blank long, duplicate long, truncated long, illegal long, "
          "least_turn long, most_turn long, turns long, first_turn long, last_turn long, first_role string, last_role string")
LEGAL_PAIRS = {"su", "ua", "au"}
_KIND = {"s": S, "u": USER, "a": A}


def _block(rows: list[tuple]) -> dict:
    """One block of rows (``turn, role, text, again``): what to do with each as a byte (role of its initial, 4:
    must go, 8: truncated), and its counts."""
    kinds, blank, duplicate, truncated, illegal = bytearray(), 0, 0, 0, 0
    before = None
    for _, role, text, again in rows:
        last = next((c for c in reversed(text) if _WORD_CHAR.match(c)), None)
        kind = _KIND.get(role[:1], 0)
        if last is None:
            blank, kind = blank + 1, kind | 4
        elif again:
            duplicate, kind = duplicate + 1, kind | 4
        elif last not in ".!?":
            truncated, kind = truncated + 1, kind | 8
        illegal += before is not None and before + role[:1] not in LEGAL_PAIRS
        before = role[:1]
        kinds.append(kind)
    turns = [t for t, *_ in rows if t is not None]
    return {"roles": [r[1] for r in rows], "texts": [r[2] for r in rows], "kinds": bytes(kinds), "blank": blank, "duplicate": duplicate, "truncated": truncated,
            "illegal": illegal, "least_turn": min(turns, default=None), "most_turn": max(turns, default=None), "turns": len(set(turns)),
            "first_turn": rows[0][0] if rows else None, "last_turn": rows[-1][0] if rows else None,
            "first_role": rows[0][1][:1] if rows else None, "last_role": rows[-1][1][:1] if rows else None}


def _cut(names: list[str], schema: pa.Schema):
    """Blocks of the ordered rows of a range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size, pending, conv, own, out = TaskContext.get().partitionId(), 0, 0, 0, (), [], []

        def close() -> None:
            nonlocal number, size, own
            if conv:
                out.append({"conv_id": conv[0], "part": part, "block": number} | _block(own))
                number, size, own = number + 1, 0, []

        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            for i, (turn, role, text, gone, again) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
                if not conv or conv[0] != ids[i]:
                    close()
                    conv = (ids[i],)
                if gone:
                    continue
                if len(own) >= BLOCK_ROWS or size + len(text) > BLOCK_BYTES and own:
                    close()
                own.append((turn, role, text, again))
                size += len(text)
                pending += len(text)
                if len(out) >= 512 or pending > BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
                    pending = 0
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _steps(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row and role before it: cost and next role of keeping it and cost of retyping it (``FAR``: can't be)."""
    role, gone, extra = kinds & 3, (kinds & 4) > 0, np.where(kinds & 8, TRUNCATED, 0)
    state = np.arange(4)
    fits = np.where((role == S)[:, None], state == START, (role[:, None] == NEXT[state]) & (role > 0)[:, None])
    keep = np.where(fits & ~gone[:, None], extra[:, None], FAR)
    retype = np.where(gone, FAR, RETYPE + extra)[:, None] + np.zeros(4, np.int64)
    return keep, np.where((role == S)[:, None], S, NEXT[state]), retype


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Costs to the end (last axis: role before) when rows may be inserted first; two are enough."""
    for _ in range(2):
        cost = np.minimum(cost, INSERT + cost[..., NEXT])
    return cost


def _backwards(kinds: list[np.ndarray], ends: np.ndarray) -> list[np.ndarray]:
    """For each block, costs to the end before each of its rows and behind the last (rows + 1, ..., 4) from
    those in ``ends`` (blocks, ..., 4). Blocks go in step, from their last rows to the first."""
    if not kinds:
        return []
    sizes = np.array([len(k) for k in kinds])
    first = np.concatenate([[0], np.cumsum(sizes)])
    keep, to, retype = _steps(np.concatenate(kinds))
    cost, out = _inserted(ends), np.empty((int(first[-1]) + len(kinds), *ends.shape[1:]), np.int64)
    at = first[1:] + np.arange(len(kinds))  # place of a block's last layer
    out[at] = cost
    wide = (slice(None),) + (None,) * (ends.ndim - 2)  # rows beside what lies between blocks and roles
    for t in range(1, int(sizes.max(initial=0)) + 1):
        on = np.flatnonzero(sizes >= t)
        row = first[on + 1] - t
        after = cost[on]
        kept = np.take_along_axis(after, np.broadcast_to(to[row][wide], after.shape), axis=-1)
        now = np.minimum(DELETE + after, np.minimum(keep[row][wide] + kept, retype[row][wide] + after[..., NEXT]))
        cost[on] = _inserted(now)
        out[at[on] - t] = cost[on]
    return [out[a:a + n + 1] for a, n in zip((first[:-1] + np.arange(len(kinds))).tolist(), sizes.tolist(), strict=True)]


def _least_paths(kinds: list[np.ndarray], costs: list[np.ndarray], last: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Audits of each block from each of the four roles at its begin, and the roles at its end.

    ``costs`` (rows + 1, 4) are costs to the conversation's end; rows are inserted behind the last
    row only in blocks that are the ``last`` of theirs."""
    sizes = np.array([len(k) for k in kinds])
    layers = np.concatenate([[0], np.cumsum(sizes + 1)])
    nodes = 4 * int(layers[-1])
    flat = np.concatenate(costs).ravel()
    behind = np.zeros(int(layers[-1]), bool)
    behind[layers[1:] - 1] = True
    block = np.repeat(np.arange(len(kinds)), sizes + 1)
    keep, to, retype = (np.zeros((int(layers[-1]), 4), np.int64) for _ in range(3))
    keep[~behind], to[~behind], retype[~behind] = _steps(np.concatenate(kinds))
    node = np.arange(nodes).reshape(-1, 4)
    inner = ~behind
    arcs = []  # tail, letter, head, cost of the arc
    insert = inner | last[block]
    for rows, letter, head, price in ((inner, 0, lambda r: node[r] + 4, lambda r: np.full(node[r].shape, DELETE)),
                                      (insert, 1, lambda r: node[r][:, NEXT], lambda r: np.full(node[r].shape, INSERT)),
                                      (inner, 2, lambda r: node[r][:, :1] + 4 + to[r], lambda r: keep[r]),
                                      (inner, 3, lambda r: node[r][:, NEXT] + 4, lambda r: retype[r])):
        tail, head, price = node[rows].ravel(), head(rows).ravel(), price(rows).ravel()
        best = flat[tail] == price + flat[head]
        arcs.append((tail[best], np.full(int(best.sum()), letter), head[best]))
    # where nothing is to be paid behind a last block, and at the end of another one, a path stops: an arc to itself without a letter
    stop = np.flatnonzero(np.repeat(behind, 4) & ~(np.repeat(last[block], 4) & (np.tile(END, len(behind)) > 0)))
    arcs.append((stop, np.full(len(stop), -1), stop))
    tail, letter, head = (np.concatenate(c) for c in zip(*arcs, strict=True))
    rank, least = letter + 1, np.full(nodes, -1)

    def choose() -> None:
        """The arc of least rank of each node."""
        order = np.lexsort((rank, tail))[::-1]
        least[tail[order]] = order  # of equal tails the least rank comes last

    choose()  # letters of a node differ, so the first one decides which arc follows
    pointers = [least[head]]
    while not (letter[pointers[-1]] < 0).all():
        follow = pointers[-1]
        rank = np.unique(rank * (len(tail) + 2) + rank[follow], return_inverse=True)[1] + 1
        pointers.append(follow[follow])
    choose()
    # read the path off the pointers: places 0, 2^k, then those halfway between, and so on
    path = least[(4 * layers[:-1][:, None] + np.arange(4)).ravel()][:, None]
    for follow in reversed(pointers):
        path = np.stack([path, follow[path]], axis=2).reshape(len(path), -1)
    text = np.frombuffer(LETTERS + b"\0", np.uint8)[letter[path]]
    audits = [line.tobytes().rstrip(b"\0").decode() for line in text]
    return audits, (head[path[:, -1]] % 4).reshape(-1, 4)


def _groups(kinds: list[np.ndarray], most: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Ranges of blocks, in about equal steps: long ones don't go with many short ones."""
    a = 0
    while a < len(kinds):
        b, longest = a + 1, len(kinds[a])
        while b < len(kinds) and (b + 1 - a) * (max(longest, len(kinds[b])) + 1) <= most:
            longest, b = max(longest, len(kinds[b])), b + 1
        yield a, b
        a = b


def _kinds(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint8).astype(np.int64) for v in column]


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``costs``: 4 x 4 from each role at a block's begin to each at its end."""
    ends = np.where(np.eye(4, dtype=bool), 0, FAR)
    for batch in batches:
        kinds = _kinds(batch.column("kinds"))
        # rows inserted behind a block belong to the next one, so they are taken back at its end
        out = []
        for k in kinds:
            costs = _backwards([k[:-1]], _before_last(k, ends)[None])[0][0] if len(k) else ends
            out.append(np.minimum(costs, FAR).T.ravel().tolist())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "place")), pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "place", "costs"])


def _before_last(kinds: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before a block's last row from those behind it, without rows inserted behind it."""
    keep, to, retype = _steps(kinds[-1:])
    kept = np.take_along_axis(after, np.broadcast_to(to[0], after.shape), axis=-1)
    return np.minimum(DELETE + after, np.minimum(keep[0] + kept, retype[0] + after[..., NEXT]))


def _block_costs(kinds: list[np.ndarray], ends: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Costs to the conversation's end in all layers of each block, from those at its end."""
    out: list[np.ndarray] = [np.zeros(0)] * len(kinds)
    for which, make in ((last, True), (~last, False)):
        on = np.flatnonzero(which)
        if make:
            for i, c in zip(on, _backwards([kinds[i] for i in on], ends[on]), strict=True):
                out[i] = c
        else:
            for i in on:
                out[i] = np.concatenate([_backwards([kinds[i][:-1]], _before_last(kinds[i], ends[i])[None])[0], ends[i][None]])
    return out


def _moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``moves``: the role at a block's end for each role at its begin, on the least path."""
    for batch in batches:
        kinds, ends = _kinds(batch.column("kinds")), np.array(batch.column("ends").to_pylist(), np.int64).reshape(-1, 4)
        last, out = batch.column("last").to_numpy(zero_copy_only=False), []
        for a, b in _groups(kinds):
            _, roles = _least_paths(kinds[a:b], _block_costs(kinds[a:b], ends[a:b], last[a:b]), last[a:b])
            out += roles.tolist()
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "place")), pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "place", "moves"])


def _repaired(names: list[str], schema: pa.Schema):
    """Audit and repaired rows of each block, given the costs behind it and the role before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ends = _kinds(batch.column("kinds")), np.array(batch.column("ends").to_pylist(), np.int64).reshape(-1, 4)
            last, begin = batch.column("last").to_numpy(zero_copy_only=False), batch.column("begin").to_numpy()
            audits, lines, paid = [], [], []
            roles, texts = batch.column("roles"), batch.column("texts")
            for a, b in _groups(kinds):
                costs = _block_costs(kinds[a:b], ends[a:b], last[a:b])
                found, _ = _least_paths(kinds[a:b], costs, last[a:b])
                for i in range(a, b):
                    audit = found[4 * (i - a) + int(begin[i])]
                    audits.append(audit)
                    paid.append(int(costs[i - a][0][begin[i]]))
                    lines.append(_apply(audit, int(begin[i]), roles[i].as_py(), texts[i].as_py()))
            new = {"audit": pa.array(audits, pa.string()), "cost": pa.array(paid, pa.int64()), "repaired": pa.array(lines, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], schema=schema)
    return run


def _apply(audit: str, state: int, roles: list[str], texts: list[str]) -> list[dict]:
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            state = int(NEXT[state])
            out.append({"role": NAMES[state], "text": ""})
            continue
        if letter == "K":
            state = _KIND[roles[i][:1]]
            out.append({"role": roles[i], "text": texts[i]})
        elif letter == "R":
            state = int(NEXT[state])
            out.append({"role": NAMES[state], "text": texts[i]})
        i += 1
    return out


def _same(left: str, right: str):
    return F.col(left).eqNullSafe(F.col(right))


def _doubled(rows: DataFrame, value: str, combine, backwards: bool, most: int) -> DataFrame:
    """``rows`` (``conv_id, place, value``), where ``value`` is combined with those of all later (``backwards``: and
    of all earlier) places of the conversation, by doubling; ``combine(own, other)`` is a column."""
    step = 1
    while step < most:
        other = rows.select(F.col("conv_id").alias("o_id"), (F.col("place") + F.lit(-step if backwards else step)).alias("o_place"), F.col(value).alias("other"))
        both = rows.join(other, _same("conv_id", "o_id") & (F.col("place") == F.col("o_place")), "left")
        rows = stage(both.select("conv_id", "place", F.when(F.col("other").isNull(), F.col(value)).otherwise(combine(F.col(value), F.col("other"))).alias(value)), "doubled")
        step *= 2
    return rows


def _added(one, two):
    """Min-plus product of two 4 x 4 matrices, given row by row as arrays."""
    return F.array(*[F.least(*[one[4 * i + k] + two[4 * k + j] for k in range(4)]) for i in range(4) for j in range(4)])


def _placed(blocks: DataFrame) -> DataFrame:
    """Blocks of conversations that have several, with ``place`` (from 0) and ``many``, by counts of the ranges before."""
    several = blocks.groupBy("conv_id").agg(F.count("*").alias("many")).where("many > 1").select(F.col("conv_id").alias("m_id"), "many")
    own = blocks.select("conv_id", "part", "block").join(several, _same("conv_id", "m_id"))
    # a conversation's blocks in a range are numbered without a gap, so one row for each range is enough
    parts = own.groupBy("conv_id", "part", "many").agg(F.min("block").alias("low"), F.count("*").alias("n"))
    ahead = F.sum("n").over(W.partitionBy("conv_id").orderBy("part")) - F.col("n")
    ahead = parts.select(F.col("conv_id").alias("p_id"), F.col("part").alias("p_part"), "many", "low", ahead.alias("ahead"))
    return own.drop("many", "m_id").join(ahead, _same("conv_id", "p_id") & (F.col("part") == F.col("p_part"))).select("conv_id", "part", "block", "many", (F.col("ahead") + F.col("block") - F.col("low")).alias("place"))


def repaired_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the conversations of ``rows`` (``conv_id, turn, role, text``, and ``gone``: a row that is not
    there any more), each with its ``audit``, ``repaired`` rows (role and text), ``place`` and counts."""
    rows = rows if "gone" in rows.columns else narrow(rows, "conv_id", "turn", "role", "text").withColumn("gone", F.lit(False))
    ordered = _ordered(rows)
    schema = f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {_BLOCK}"
    blocks = stage(ordered.mapInArrow(_cut(["turn", "role", "text", "gone", "again"], _arrow(schema)), schema), "blocks")
    # blocks without rows count only where a conversation has no other
    full = blocks.where("length(kinds) > 0")
    none = blocks.where("length(kinds) = 0").dropDuplicates(["conv_id"]).join(full.select(F.col("conv_id").alias("f_id")).distinct(), _same("conv_id", "f_id"), "left_anti")
    blocks = full.unionByName(none)
    placed = stage(_placed(blocks), "placed")
    most = placed.agg(F.max("many")).first()[0] or 1
    alone = [F.lit(0).alias("place"), F.array(*[F.lit(int(v)) for v in END]).cast("array<bigint>").alias("ends"), F.lit(0).alias("begin"), F.lit(True).alias("last")]
    if most == 1:
        full = blocks.select("*", *alone)
    else:
        full = _joined(blocks, placed, most, alone)
    names = [c for c in full.columns if c not in ("roles", "texts", "kinds", "ends")]
    out = [*names, "audit", "cost", "repaired"]
    schema = ", ".join([f"{c} {full.schema[c].dataType.simpleString()}" for c in names] + ["audit string, cost long, repaired array<struct<role:string,text:string>>"])
    return full.mapInArrow(_repaired(out, _arrow(schema)), schema)


def _joined(blocks: DataFrame, placed: DataFrame, most: int, alone: list) -> DataFrame:
    """Blocks with the costs behind them (``ends``) and the role before them (``begin``)."""
    place = placed.select(F.col("conv_id").alias("p_id"), F.col("part").alias("p_part"), F.col("block").alias("p_block"), "place", "many")
    at = _same("conv_id", "p_id") & (F.col("part") == F.col("p_part")) & (F.col("block") == F.col("p_block"))
    several = stage(blocks.select("conv_id", "part", "block", "kinds").join(place, at).select("conv_id", "place", "many", "kinds"), "several")
    kind = blocks.schema["conv_id"].dataType.simpleString()
    costs = stage(several.mapInArrow(_costs, f"conv_id {kind}, place long, costs array<bigint>"), "costs")
    behind = _doubled(costs, "costs", _added, True, most)
    # what is to be paid behind a block is what the next one costs to the end
    ends = F.array(*[F.least(*[F.col("costs")[4 * i + k] + F.lit(int(END[k])) for k in range(4)]) for i in range(4)])
    ends = behind.select(F.col("conv_id").alias("o_id"), (F.col("place") - 1).alias("o_place"), ends.alias("next"))
    last = F.col("place") + 1 == F.col("many")
    several = several.join(ends, _same("conv_id", "o_id") & (F.col("place") == F.col("o_place")), "left").select(
        "conv_id", "place", "kinds", last.alias("last"), F.coalesce("next", F.array(*[F.lit(int(v)) for v in END]).cast("array<bigint>")).alias("ends"))
    several = stage(several, "ends")
    moves = stage(several.mapInArrow(_moves, f"conv_id {kind}, place long, moves array<bigint>"), "moves")
    # roles at the end of all blocks up to one, for each role at the conversation's begin
    before = _doubled(moves, "moves", lambda own, other: F.array(*[F.get(own, other[i].cast("int")) for i in range(4)]), False, most)
    before = before.select(F.col("conv_id").alias("b_id"), (F.col("place") + 1).alias("b_place"), F.col("moves")[START].alias("role"))
    known = several.join(before, _same("conv_id", "b_id") & (F.col("place") == F.col("b_place")), "left").select(
        F.col("conv_id").alias("k_id"), F.col("place").alias("k_place"), "ends", "last", F.coalesce(F.col("role"), F.lit(START)).cast("int").alias("begin"))
    found = stage(placed.join(known, _same("conv_id", "k_id") & (F.col("place") == F.col("k_place"))).select(
        F.col("conv_id").alias("p_id"), F.col("part").alias("p_part"), F.col("block").alias("p_block"), "place", "ends", "begin", "last"), "known")
    full = blocks.join(found, at, "left")
    default = dict(zip(("place", "ends", "begin", "last"), alone, strict=True))
    return full.select(*blocks.columns, *[F.coalesce(F.col(c), default[c]).alias(c) for c in ("place", "ends", "begin", "last")])


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of conversations, in order, to one row each; only digests and audits are held."""
    own, sha, audit, rows, out, kind = (), None, [], 0, [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for i, conv in enumerate(batch.column("conv_id").to_pylist()):
            if not own or own[0] != conv:
                if own:
                    out.append((own[0], "".join(audit), sha.hexdigest()))
                own, sha, audit, rows = (conv,), hashlib.sha256(), [], 0
            audit.append(batch.column("audit")[i].as_py())
            for r in batch.column("repaired")[i].as_py():
                sha.update((f"\n{r['role']}:{r['text']}" if rows else f"{r['role']}:{r['text']}").encode())
                rows += 1
        if len(out) > 1000:
            yield _digests(out, kind)
            out = []
    if own:
        out.append((own[0], "".join(audit), sha.hexdigest()))
        yield _digests(out, kind)


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, audits, shas = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(audits, pa.string()), pa.array(shas, pa.string())], names=["conv_id", "audit", "repaired_sha256"])


def repair_digests(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation."""
    blocks = stage(repaired_blocks(rows), "repaired")
    facts = ["blank", "duplicate", "truncated", "illegal", "turns"]
    gaps = F.coalesce(F.col("most_turn") - F.col("least_turn") + 1 - F.col("turns"), F.lit(0))
    counts = blocks.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in facts], F.min("least_turn").alias("least_turn"), F.max("most_turn").alias("most_turn"),
                                           F.max(F.when(F.col("place") == 0, F.col("cost"))).alias("cost"))
    # neighbours in two blocks: their roles, and a turn that both have
    ahead = blocks.where("place > 0").select(F.col("conv_id").alias("n_id"), (F.col("place") - 1).alias("n_place"), "first_role", "first_turn")
    edges = blocks.where("not last").select("conv_id", "place", "last_role", "last_turn").join(ahead, _same("conv_id", "n_id") & (F.col("place") == F.col("n_place")))
    legal = F.concat("last_role", "first_role").isin(*sorted(LEGAL_PAIRS))
    edges = edges.groupBy("conv_id").agg(F.sum((~legal).cast("long")).alias("more"), F.sum(F.coalesce((F.col("last_turn") == F.col("first_turn")).cast("long"), F.lit(0))).alias("fewer"))
    edges = edges.withColumnRenamed("conv_id", "e_id")
    counts = counts.join(edges, _same("conv_id", "e_id"), "left").withColumn("illegal", F.col("illegal") + F.coalesce("more", F.lit(0))).withColumn("turns", F.col("turns") - F.coalesce("fewer", F.lit(0)))
    counts = counts.select(F.col("conv_id").alias("c_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost")
    kind = blocks.schema["conv_id"].dataType.simpleString()
    alone = F.col("last") & (F.col("place") == 0)
    several = blocks.where(~alone).select("conv_id", "place", "audit", "repaired").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = f"conv_id {kind}, audit string, repaired_sha256 string"
    texts = blocks.where(alone).select("conv_id", "place", "audit", "repaired").mapInArrow(_streamed, schema).unionByName(several.mapInArrow(_streamed, schema))
    return texts.join(counts, _same("conv_id", "c_id")).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
