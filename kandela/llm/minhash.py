"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles of ``WORDS`` words; documents with
``100 * intersection >= PERCENT * union`` are linked, and linked ones form a component.

Tables for candidates are not banded with hashes of their own. There are two collections of ``HALVES``
half keys, each made of ``JOINT`` minhashes, and every pair of a half key of the first and one of the
second collection is the key of a table. So HALVES^2 tables take only 2 * HALVES * JOINT minhashes. Two
documents meet in no table only if they agree in no half key of one of the collections: with 10 half
keys of two minhashes, six in a million pairs of similarity 0.85, and fewer above.

1. Documents with the same set are one class, named by a 64-bit hash of the set; all that follows
   works on classes. So copies cost nothing, however many there are.
2. Half keys that a single class has are dropped, and the rest are paired to table keys.
3. In every table bucket the smallest class is the hub. A class is compared with the smallest of its
   hubs; sets are compared in full. Links make components, so a large group of near copies is mostly
   one component after as many comparisons as it has classes.
4. Buckets that still hold several components are compared completely, but not pair by pair: their
   classes are dealt to blocks by set size (a step of sizes for each ratio that a
   link allows, so links lie within a step or between neighbouring ones) and by a hash, at most about
   ``BLOCK`` shingles or ``MEMBERS`` sets in a block. Two blocks that meet in a bucket are compared as matrices: the product
   of their 0/1 rows over the shingles they hold gives all intersections. From a pair of blocks come
   links that join what hangs together to its smallest component, one fewer than there are components.
   First every block is compared with itself and with the first block of its buckets, and then, where a
   bucket still holds several components, those blocks that hold another than its most frequent one with
   all; pairs of blocks that are one component by then are left out. So the comparisons and links of a
   large group of near copies grow with its blocks, not with their square.

Results: no words or a null text: set size 0, linked with nothing. A null doc_id names no component:
such a document is in its class and links others, but only the ids that are not null count for the
smallest one; alone it has a null component and is kept. Repeated rows are of one class and each get
a row. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from .common import WORD, narrow, set_aside, stage
from .components import components
from .words import U, _mix, chunks, shingles, texts_of, word_hashes

WORDS, PERCENT, HALVES, JOINT = 5, 85, 10, 2
#: Most shingles and sets of a block, about: its matrices are MEMBERS x COLUMNS and MEMBERS x MEMBERS numbers.
BLOCK, MEMBERS = 1 << 16, 512
#: Bytes of texts, sets or blocks that a Python worker gets at a time.
BATCH = 8 << 20
#: Names of candidate classes or of rows that go, up to this number (some 40 MB), are broadcast to the scan of the texts.
MAX_BROADCAST = 1_000_000


def _family(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the minhashes of one family of half keys."""
    n = np.arange(2 * HALVES * JOINT, dtype=U)
    return _mix(n * U(2) + U(1 + 1000 * seed)) | U(1), _mix(n * U(2) + U(2 + 1000 * seed))


def _half_keys(h: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """Half keys (texts x 2 HALVES) of runs of shingle hashes that begin at ``first``."""
    out = np.empty((len(first), 2 * HALVES), U)
    times, plus = _family(seed)
    for k in range(2 * HALVES):
        key = np.full(len(first), k + 1, U)
        for j in range(JOINT):
            i = k * JOINT + j
            key = _mix(key + np.minimum.reduceat((h ^ plus[i]) * times[i], first))
        out[:, k] = key
    return out


def _key(distinct: np.ndarray) -> int:
    """Names a set by a hash of its size, sum and exclusive or."""
    m = _mix(distinct + U(99))
    parts = np.array([len(distinct), m.sum(dtype=U), np.bitwise_xor.reduce(m)], U)
    return int(_mix(_mix(_mix(parts[:1]) + parts[1:2]) + parts[2:3]).view(np.int64)[0])


def _distinct(h: np.ndarray) -> np.ndarray:
    s = np.sort(h)
    keep = np.empty(len(s), bool)
    keep[0] = True
    np.not_equal(s[1:], s[:-1], out=keep[1:])
    return s[keep]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, data = texts_of(batch.column("text"))
        for a, b in chunks(at):
            h, ahead = shingles(*word_hashes(data, at[a:b + 1]), WORDS)
            has = np.flatnonzero(np.diff(ahead))
            size, key = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
            for i in has:
                own = _distinct(h[ahead[i]:ahead[i + 1]])
                size[i], key[i] = len(own), _key(own)
            halves = np.zeros((b - a, 2 * HALVES), U)
            if len(has):
                halves[has] = _half_keys(h, ahead[has], 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * 2 * HALVES, pa.int32()), pa.array(halves.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("doc_id", "text_key")), pa.array(size), pa.array(key, mask=size == 0), lists],
                                             names=["doc_id", "text_key", "n", "key", "halves"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the texts whose set is the expected one."""
    for batch in batches:
        at, data = texts_of(batch.column("text"))
        want = batch.column("key").to_numpy()
        for a, b in chunks(at):
            h, ahead = shingles(*word_hashes(data, at[a:b + 1]), WORDS)
            sets = [_distinct(h[ahead[i]:ahead[i + 1]]) if ahead[i] < ahead[i + 1] else h[:0] for i in range(b - a)]
            keep = [i for i, s in enumerate(sets) if len(s) and _key(s) == want[a + i]]
            yield pa.RecordBatch.from_arrays([pa.array(want[a:b][keep], pa.int64()), pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=["key", "set"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inter, union = [], []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), U) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            inter.append(both)
            union.append(len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()), pa.array(union, pa.int64())], names=["a", "b", "both", "either"])


def _joined(percent: int):
    """Links between components of two blocks: of those that hang together one link from each to the smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same = batch.column("x")[r].as_py() == batch.column("y")[r].as_py()
                one, two = ([m.as_py() for m in batch.column(c)[r].values] for c in ("one", "two"))
                names = {m["c"]: m["now"] for c in ("names_x", "names_y") for m in batch.column(c)[r].as_py()}
                c1, c2 = (np.array([names[m["c"]] for m in side], np.int64) for side in (one, two))
                one_sets, two_sets = ([np.frombuffer(m["set"], U) for m in side] for side in (one, two))
                n1, n2 = np.array([len(v) for v in one_sets]), np.array([len(v) for v in two_sets])
                # only shingles that both sides have can meet
                shared = np.intersect1d(np.concatenate(one_sets), np.concatenate(two_sets))
                m1, m2 = _rows(one_sets, shared), _rows(two_sets, shared)
                both = np.zeros((len(one), len(two)), np.float32)
                for a in range(0, len(shared), COLUMNS):
                    both += _dense(*m1, len(one), a) @ _dense(*m2, len(two), a).T
                both = np.rint(both).astype(np.int64)
                hit = (100 * both >= percent * (n1[:, None] + n2[None, :] - both)) & (c1[:, None] != c2[None, :])
                if same:
                    hit = np.triu(hit, 1)
                i, j = np.nonzero(hit)
                if len(i):
                    yield _star(c1[i], c2[j])
    return run


def _star(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """A link to the smallest node from each other one that hangs together with it."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = np.unique(ends.reshape(2, -1), axis=1)
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[one], least[two])
        new = least.copy()
        np.minimum.at(new, one, low)
        np.minimum.at(new, two, low)
        new = new[new]
        if (new == least).all():
            break
        least = new
    other = least != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[least[other]]), pa.array(nodes[other])], names=["a", "b"])


#: Columns of the 0/1 matrices that are filled in at a time.
COLUMNS = 4096


def _rows(sets: list[np.ndarray], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each shingle of ``sets`` that is among the sorted ``shared`` ones."""
    all_ = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    at = np.searchsorted(shared, all_)
    at[at == len(shared)] = 0
    keep = shared[at] == all_ if len(shared) else np.zeros(len(all_), bool)
    return row[keep], at[keep]


def _dense(row: np.ndarray, at: np.ndarray, n: int, first: int) -> np.ndarray:
    own = (at >= first) & (at < first + COLUMNS)
    out = np.zeros((n, COLUMNS), np.float32)
    out[row[own], at[own] - first] = 1
    return out


def _tables(rows: DataFrame) -> DataFrame:
    """Table keys ``t`` of ``rows`` (``key, n, halves``) for pairs of half keys that are not alone."""
    half = rows.select("key", "n", F.posexplode("halves").alias("i", "x")).withColumn("x", F.xxhash64("i", "x"))
    met = half.groupBy("x").agg(F.count("*").alias("c")).where("c > 1").select("x")
    half = half.join(met, "x")
    first = half.where(F.col("i") < HALVES).select("key", "n", F.col("x").alias("u"))
    second = half.where(F.col("i") >= HALVES).select("key", F.col("x").alias("v"))
    return first.join(second, "key").select(F.xxhash64("u", "v").alias("t"), "key", "n")


def _same_size(a: str, b: str, percent: int):
    """Sets whose sizes alone don't rule a link out."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, both, either`` of pairs of classes, from their full sets."""
    left = sets.select(F.col("key").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("key").alias("b"), F.col("set").alias("set_b"))
    return stage(pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(_compared, "a long, b long, both long, either long"), "compared", BATCH)


def _labelled(rows: DataFrame, *maps: DataFrame) -> DataFrame:
    """``rows`` with the component ``c`` of their key."""
    rows = rows.withColumn("c", F.col("key"))
    for m in maps:
        rows = rows.join(m.select(F.col("node").alias("c"), "component"), "c", "left").withColumn("c", F.coalesce("component", "c")).drop("component")
    return rows


def links(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, list[DataFrame]]:
    """``doc_id, n, key`` of each row, and maps ``node, component`` that lead a key, one after the other,
    to the name of its component; a key that is in none of them is its own."""
    docs = narrow(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")).withColumn("text_key", F.xxhash64("text"))
    signed = stage(docs.mapInArrow(_signed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, n long, key long, halves array<bigint>"), "signed", BATCH)
    classes = stage(signed.where("key is not null").groupBy("key").agg(F.min(F.struct("doc_id", "text_key")).alias("of"), F.max("n").alias("n"), F.first("halves").alias("halves")), "classes")
    rows = stage(_tables(classes.select("key", "n", "halves")), "tables")
    # a bucket's own members only: a table key needs two
    buckets = rows.groupBy("t").agg(F.count("*").alias("c"), F.min(F.struct("key", "n")).alias("hub")).where("c > 1").select("t", "hub")
    rows = stage(rows.join(buckets, "t"), "buckets")
    members = stage(classes.select("key", "of").join(rows.select("key").distinct(), "key", "left_semi"), "members")
    count = members.count()
    signed = signed.select("doc_id", "n", "key")
    if not count:
        return signed, []
    # a text is fetched by its id and its hash: many rows have no id, or one id with other texts
    wanted = members.select(F.col("of.doc_id").alias("_id"), F.col("of.text_key").alias("_key"), "key")
    wanted = F.broadcast(wanted) if count <= MAX_BROADCAST else wanted
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("key", "text")
    sets = stage(texts.mapInArrow(_sets, "key long, set binary").groupBy("key").agg(F.first("set").alias("set")), "sets", BATCH)
    pairs = rows.where((F.col("key") != F.col("hub.key")) & _same_size("n", "hub.n", percent)).groupBy(F.col("key").alias("b")).agg(F.min("hub.key").alias("a"))
    tested = _verify(pairs, sets)
    maps = [stage(components(tested.where(f"100 * both >= {percent} * either").select("a", "b")), "components")]
    rest = stage(_blocks_meeting(_labelled(rows, maps[0]), percent), "blocks")
    if not rest.take(1):
        return signed, maps
    held = rest.select("key", "c", "block").distinct().join(sets, "key")
    held = stage(held.groupBy("block").agg(F.collect_list(F.struct("c", "set")).alias("members")), "held")  # BLOCK shingles or one set
    met = stage(rest.select("t", "block", "step", "c").distinct(), "met")
    compared = None
    for choose in (_with_first, _all_left):
        found, compared = _round(met, held, maps[1:], choose, compared, percent)
        if found is not None:
            maps.append(stage(components(found), "components"))
    return signed, maps


def _round(met: DataFrame, held: DataFrame, maps: list[DataFrame], choose, compared: DataFrame | None, percent: int) -> tuple[DataFrame | None, DataFrame]:
    """Compares the pairs of blocks that ``choose`` gives, but those whose classes are all of one component by
    now: links between components, if there are any, and the pairs."""
    names = met.select("block", "c").distinct()
    now = names.withColumn("key", F.col("c")).drop("c")
    now = _labelled(now, *maps).select("block", F.col("key").alias("c"), F.col("c").alias("now"))
    now = stage(now, "now")
    blocks = now.groupBy("block").agg(F.min("now").alias("low"), F.max("now").alias("high"), F.collect_list(F.struct("c", "now")).alias("names"))  # of one block
    blocks = stage(blocks, "names")
    pairs = choose(met.join(now, ["block", "c"]), blocks)
    if compared is not None:
        pairs = pairs.join(compared, ["x", "y"], "left_anti")
    one = blocks.select(F.col("block").alias("x"), F.col("low").alias("low_x"), F.col("high").alias("high_x"), F.col("names").alias("names_x"))
    two = blocks.select(F.col("block").alias("y"), F.col("low").alias("low_y"), F.col("high").alias("high_y"), F.col("names").alias("names_y"))
    pairs = pairs.join(one, "x").join(two, "y").where("least(low_x, low_y) < greatest(high_x, high_y)")
    pairs = stage(pairs.select("x", "y", "names_x", "names_y"), "pairs")
    if not pairs.take(1):
        return None, pairs.select("x", "y")
    both = pairs.join(held.select(F.col("block").alias("y"), F.col("members").alias("two")), "y").join(held.select(F.col("block").alias("x"), F.col("members").alias("one")), "x")
    found = stage(both.select("x", "y", "one", "two", "names_x", "names_y").mapInArrow(_joined(percent), "a long, b long").distinct(), "joined", BATCH)
    return found if found.take(1) else None, pairs.select("x", "y")


def _with_first(met: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block with itself, and with the first one of each of its buckets that has sets of about its size."""
    first = met.groupBy("t", "step").agg(F.min("block").alias("x"))
    pairs = met.select("t", "step", F.col("block").alias("y")).join(first, ["t", "step"]).select("x", "y")
    return pairs.unionAll(blocks.select(F.col("block").alias("x"), F.col("block").alias("y"))).distinct()


def _all_left(met: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks that meet in a bucket, unless both hold nothing but the bucket's most frequent component there:
    as many pairs as there are blocks for each block that holds another one."""
    most = met.groupBy("t", "now").agg(F.count("*").alias("n")).groupBy("t").agg(F.max(F.struct("n", "now")).alias("most"), F.count("*").alias("components")).where("components > 1")
    here = met.groupBy("t", "block", "step").agg(F.min("now").alias("low"), F.max("now").alias("high")).join(most, "t")
    here = here.withColumn("odd", (F.col("low") != F.col("high")) | (F.col("low") != F.col("most.now")))
    odd = here.where("odd").select("t", F.col("block").alias("u"), F.col("step").alias("step_u"))
    pairs = odd.join(here.select("t", F.col("block").alias("v"), "step"), "t").where("abs(step - step_u) <= 1")
    return pairs.select(F.least("u", "v").alias("x"), F.greatest("u", "v").alias("y")).distinct()


def _blocks_meeting(rows: DataFrame, percent: int) -> DataFrame:
    """``t, key, c, block, step`` of the buckets that hold several components. Classes that have their
    smallest hub in common lie together."""
    mixed = rows.groupBy("t").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("t")
    rows = stage(rows.select("t", "key", "n", "c", F.col("hub.key").alias("hub")).join(mixed, "t"), "mixed")
    members = rows.groupBy("key", "n").agg(F.min("hub").alias("group"))
    members = stage(members.withColumn("step", F.floor(F.log(F.col("n")) / F.lit(-1.000001 * math.log(percent / 100))).cast("int")), "mixed-members")
    blocks = members.groupBy("group", "step").agg(F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.count("*") / MEMBERS)).alias("blocks"))
    members = members.join(blocks, ["group", "step"]).withColumn("block", F.xxhash64("group", "step", F.pmod(F.xxhash64("key"), F.col("blocks"))))
    return rows.select("t", "key", "c").join(members.select("key", "block", "step"), "key")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``, and the class's key."""
    signed, maps = links(docs, percent)
    rows = _labelled(signed, *maps)  # a null key has no component
    smallest = rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(smallest, "c", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), F.col("key").alias("set_key"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id, those without
    a doc_id last, and of rows with that id the one with the smallest hash of its columns. Equal rows
    with an id are one document and stay or go together; of equal rows without an id one stays."""
    plain, back = set_aside(docs, "doc_id", "text")
    names = plain.columns
    plain = plain.withColumn("row_key", F.xxhash64(*(f.name for f in plain.schema.fields if isinstance(f.dataType, AtomicType))))
    # rows are judged, not ids: a doc_id may be null or have several texts
    named = plain.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key").alias("doc_id"), "text")
    judged = near_duplicates(named, percent).where("not kept").select(F.col("doc_id.doc_id").alias("gone"), F.col("doc_id.row_key").alias("gone_key")).distinct()
    judged = stage(judged, "gone")
    # as long as few go, their names meet the texts where these lie
    judged = F.broadcast(judged) if judged.count() <= MAX_BROADCAST else judged
    kept = plain.join(judged, F.col("doc_id").eqNullSafe(F.col("gone")) & (F.col("row_key") == F.col("gone_key")), "left_anti")
    copies = F.col("doc_id").isNull() & F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    one = kept.where(copies).groupBy("row_key").agg(F.first(F.struct(*names)).alias("row")).select("row.*")
    return kept.where(~copies).select(*names).unionAll(one).select(*back)
