"""Best-fit packing of token sequences by a configuration linear program.

Every text is tokenized once; documents longer than a sequence are cut into full pieces and a rest.
Pieces are then only lengths, and the corpus only a histogram of at most ``SEQUENCE`` counts, however
many documents it has. On that histogram the plan is made:

1. Lengths are rounded up to classes of ``UNIT`` tokens. A configuration is a set of classes that fits
   a sequence. The linear program asks for the fewest configurations that cover all pieces. It is
   solved by multiplicative weights: a class has a price that falls as it gets covered, and each round
   takes the configuration of the highest price, found by dynamic programming over the capacity
   (an unbounded knapsack).
2. The solution is scaled down until no class is covered more than it has pieces, and rounded down.
3. Each configuration lays down the larger half of its classes, with real lengths in their place.
   What that leaves free is filled with the other pieces by best fit: longest piece first, into the
   smallest gap that holds it, and into new sequences where none does. So the last pieces of a sequence
   are chosen by their exact lengths, and what rounding to classes lost is won back.

The plan is a list of sequence types (lengths in their order, and how many sequences are of this type).
Its size depends on the number of distinct lengths, not on the number of documents. Pieces of a
length are numbered by a distributed ranking (counts by hash range, then ranks inside a range), and
the number says which type, sequence and place a piece gets. No task or group holds all pieces of a length.

A null text counts as empty: one piece that holds only the end token. Repeated rows are packed each
for themselves, null doc_ids like others. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import narrow, stage

SEQUENCE, END_ID, UNIT, ROUNDS, STEP = 4096, 1, 16, 1500, 0.25
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a task keeps at hand.
WORDS_KEPT = 600_000
RANGE_ROWS = 2_000

_ENCODERS: dict[str, Encoder] = {}


#: Letters of Latin-1, which no normalisation changes but lower-casing, then ASCII signs.
_PLAIN = re.compile("([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 signs for
    themselves, the others in their order from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(other)}


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes. The vocabulary's pre-tokenizer joins nothing
    across blanks, so words between blanks are encoded on their own, and known ones looked up. New
    words of letters and closing signs go to the merges at once, others through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {"": b""}
        self.letters = {chr(b): "".join(_byte_letters()[x] for x in chr(b).encode()) for b in range(256)}

    def _merged(self, word: str) -> bytes:
        """Ids of a run of Latin-1 letters, or of ASCII signs."""
        word = word.lower()
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word))
        return np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        known, rest = self.known, []
        for w in new:
            if m := _PLAIN.fullmatch(w):
                core, signs = m.groups()
                for x in (core, signs):
                    if x not in known:
                        known[x] = self._merged(x)
                if signs:
                    known[w] = known[core] + known[signs]
            else:
                rest.append(w)
        if rest:
            known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True))

    def encode(self, text: str) -> bytes:
        if not isinstance(text, str):
            return b""
        # the vocabulary is lower-case, but its special tokens are found in the text as it is
        if "<|" not in text and (text.isascii() or len(text.encode("latin-1", "ignore")) == len(text)):
            text = text.lower()
        words = text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")
        known = self.known
        if new := set(words).difference(known):
            if len(known) + 2 * len(new) > WORDS_KEPT:
                known.clear()
                known[""] = b""
                new = set(words)
                new.discard("")
            self._learn(list(new))
        return b"".join(map(known.__getitem__, words))


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of each piece of each row. Without a
    path every task finds the vocabulary in its own installation."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path or vocabulary_path())
        for batch in batches:
            for rows in (batch.slice(a, 256) for a in range(0, batch.num_rows, 256)):
                row, piece, length, crc, held = [], [], [], [], []
                for i, text in enumerate(rows.column("text").to_pylist()):
                    own = enc.encode(text) + end
                    for p, a in enumerate(range(0, len(own), 4 * sequence)):
                        part = own[a:a + 4 * sequence]
                        row.append(i)
                        piece.append(p)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if ids:
                            held.append(part)
                out = [rows.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array([p * sequence for p in piece], pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(out + [pa.array(held, pa.binary())] * ids, names=names + ["ids"] * ids)

    docs = narrow(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)


def best_configuration(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """Classes (1 .. len(prices)) with the highest sum of prices in ``capacity``, by dynamic programming."""
    classes = np.flatnonzero(prices > 0) + 1
    worth = prices[classes - 1]
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        fit = np.searchsorted(classes, c, side="right")
        best[c], pick[c] = best[c - 1], 0
        if fit:
            gain = worth[:fit] + best[c - classes[:fit]]
            k = int(gain.argmax())
            if gain[k] > best[c]:
                best[c], pick[c] = gain[k], classes[k]
    out: dict[int, int] = defaultdict(int)
    c = capacity
    while c:
        k = int(pick[c])
        if k:
            out[k] += 1
        c -= k or 1
    return out


def solve(need: np.ndarray, capacity: int, rounds: int = ROUNDS, step: float = STEP) -> dict[tuple, float]:
    """Multiplicative weights for the configuration program: configuration (class, count pairs) to how often."""
    use: dict[tuple, float] = defaultdict(float)
    covered = np.zeros(len(need))
    has = need > 0
    size = np.arange(1, len(need) + 1)
    prices = np.where(has, size.astype(float), 0.0)
    for _ in range(rounds):
        if not has.any():
            break
        config = best_configuration(prices, capacity)
        if not config:
            break
        often = min(need[k - 1] / n for k, n in config.items())
        use[tuple(sorted(config.items()))] += often
        for k, n in config.items():
            covered[k - 1] += n * often / need[k - 1]
            prices[k - 1] *= np.exp(-step * n * often / need[k - 1])
        prices /= prices.max()
    top = covered.max(initial=0)
    return {c: x / top for c, x in use.items()} if top else {}


class Plan:
    """Sequence types by best fit: ``types`` has lengths and the number of sequences of each type."""

    def __init__(self, capacity: int, stock: dict[int, int]):
        self.capacity, self.stock = capacity, dict(stock)
        self.open: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # by gap
        self.gaps: list[int] = []

    def put(self, lengths: tuple, count: int) -> None:
        gap = self.capacity - sum(lengths)
        if not self.open[gap]:
            bisect.insort(self.gaps, gap)
        self.open[gap].append((lengths, count))

    def lay(self, wanted: list[list[int]], count: int) -> None:
        """``count`` sequences with a piece of one of the given lengths for each wanted class, as far as there are any."""
        while count:
            lengths, taken = [], defaultdict(int)
            for choice in wanted:
                length = next((x for x in choice if self.stock.get(x, 0) > taken.get(x, 0)), None)
                if length is not None:
                    taken[length] += 1
                    lengths.append(length)
            if not lengths:
                return
            now = min(count, *(self.stock[x] // n for x, n in taken.items()))
            for x, n in taken.items():
                self.stock[x] -= n * now
            self.put(tuple(lengths), now)
            count -= now

    def fill(self) -> None:
        """All pieces left in the stock, longest first, into the smallest gap that holds them or new sequences."""
        for length in sorted((x for x, n in self.stock.items() if n), reverse=True):
            left = self.stock[length]
            while left:
                i = bisect.bisect_left(self.gaps, length)
                if i == len(self.gaps):
                    each = self.capacity // length
                    if left >= each:
                        self.put((length,) * each, left // each)
                    if left % each:
                        self.put((length,) * (left % each), 1)
                    break
                gap = self.gaps[i]
                lengths, count = self.open[gap].pop()
                now = min(left, count)
                if count > now:
                    self.open[gap].append((lengths, count - now))
                if not self.open[gap]:
                    self.gaps.pop(i)
                self.put((*lengths, length), now)
                left -= now
            self.stock[length] = 0

    @property
    def types(self) -> list[tuple[tuple, int]]:
        return [t for gap in sorted(self.open) for t in self.open[gap]]


def make_plan(histogram: dict[int, int], capacity: int = SEQUENCE, unit: int = UNIT) -> list[tuple[tuple, int]]:
    need = np.zeros(-(-capacity // unit))
    members: dict[int, list[int]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        need[-(-length // unit) - 1] += histogram[length]
        members[-(-length // unit)].append(length)
    plan = Plan(capacity, histogram)
    use = solve(need, capacity // unit)
    for config in sorted(use, key=lambda c: (-use[c], c)):
        classes = [k for k, n in sorted(config, reverse=True) for _ in range(n)]
        plan.lay([members[k] for k in classes[:max(1, len(classes) // 2)]], int(use[config]))
    plan.fill()
    return plan.types


def pack(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """``pieces`` (``doc_id, piece, length``, others) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs: dict[int, list[tuple]] = defaultdict(list)  # by length: first number, first sequence, offset
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, count in make_plan(counts, capacity):
        offset = 0
        for x in lengths:
            runs[x].append((used[x], sequence, offset))
            used[x] += count
            offset += x
        sequence += count
    table = {x: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for x, r in runs.items()}
    model = pieces.sparkSession.sparkContext.broadcast(table)  # as large as the plan: by distinct lengths, not by documents

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for x in np.unique(length):
                own = length == x
                first, begin, offset = model.value[int(x)]
                i = np.searchsorted(first, number[own], side="right") - 1
                seq[own], off[own] = begin[i] + number[own] - first[i], offset[i]
            keep = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return _numbered(pieces, sum(counts.values())).mapInArrow(place, schema)


def _numbered(pieces: DataFrame, n: int) -> DataFrame:
    """``pieces`` with ``number``, from 0 and gapless within each length."""
    ranges = max(1, min(100_000, n // RANGE_ROWS))
    rows = pieces.withColumn("cut", F.pmod(F.xxhash64(*[c for c in pieces.columns if c != "ids"]), F.lit(ranges)).cast("int"))
    counts = rows.groupBy("length", "cut").agg(F.count("*").alias("n"))
    before = counts.select("length", "cut", (F.sum("n").over(W.partitionBy("length").orderBy("cut")) - F.col("n")).alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "cut").orderBy("doc_id", "piece"))
    return (rows.withColumn("inside", inside).join(before, ["length", "cut"])
            .select(*pieces.columns, (F.col("inside") - 1 + F.col("before")).cast("bigint").alias("number")))


def pack_documents(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """Every piece of every row with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(stage(cut_pieces(docs, path, ids=ids), "pieces"))
