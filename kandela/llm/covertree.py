"""Near-duplicate vectors by dual traversal of cover trees.

Vectors of a label are scaled to unit length; cosine >= c means distance <= t = sqrt(2 - 2c). Each label
has a tree. A node has one of its vectors as its centre and covers all its vectors within its radius, that
of its farthest one; a node of radius up to 2^(1 - level) is on that level. Its children are chosen farthest-first, the
node's own centre first, until all its vectors lie within half the radius of one, and each vector goes
to its nearest. So radii halve, centres are nested, and a tree ends in single vectors.

The traversal starts with each root against itself. With centres d apart and radii p and q, a pair
of nodes with d > p + q + t holds no link and is dropped; one with d + p + q <= t is linked as a whole and taken as
sums; others are replaced by the pairs of their children. Two single vectors are decided by their
cosine in double precision. So every pair with a cosine of the threshold or more is counted, and none
below it.

The top of a tree is built by passes of Spark, the rest inside blocks of about ``LEAF`` vectors:

* A node with more vectors is split by centres from a bounded sample of its vectors (radii are taken over
  all of them). Where vectors lie in all directions, half the radius takes more than ``CHILDREN`` centres; then centres are
  sampled vectors, and the children, hardly smaller in radius, are smaller in number.
* A node whose diameter is within t is never split, however many vectors it has: it is linked as a whole.
* Pairs of these nodes go a level down with each pass of joins. Pairs that are left at the end meet as pairs of blocks,
  and the traversal goes on in them; the distances of many pairs of centres are one matrix product.

Equal vectors are one entry with a weight. From a pair of blocks come sums and, for components, one edge for each vector
that has a link, not a row for each link: a group of thousands of near copies gives thousands of rows.

Null labels, vectors that are null, empty, zero or hold null or non-finite components, and rows
without an id link with nothing: n_links 0, component the row's own id, kept. Vectors of unequal
length don't link (each length is a tree of its own). Repeated rows are vectors of their own and link
with each other. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow, stage
from .components import components

COSINE, LEAF, CHILDREN, SAMPLE, MAX_PASSES = 0.98, 512, 256, 2048, 12


def _unit(raw: list[bytes]) -> np.ndarray:
    return _scaled(np.stack([np.frombuffer(r, "<f8") for r in raw]))


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows at unit length, also those whose squares are too small or too large for a double."""
    with np.errstate(over="ignore", under="ignore"):
        n = np.linalg.norm(v, axis=1, keepdims=True)
        out = (n < 1e-140) | (n > 1e140)
    if out.any():
        v = np.where(out, v / np.abs(v).max(axis=1, keepdims=True), v)
        n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / n


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null where nothing can link."""
    for batch in batches:
        out = []
        for x in batch.column("v"):
            x = x.as_py()
            v = np.array(x, "<f8") if x and None not in x else None
            if v is not None:
                v = v if np.isfinite(v).all() and v.any() else None
            out.append(None if v is None else v.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(out, pa.binary())], names=["id", "label", "raw"])


#: Room for rounding in the bounds, as distances; links themselves are decided by cosines.
SLACK = 1e-7
#: Columns of a block's tree; nodes are numbered level by level, so a node's children follow each other.
NODES = ["centre", "radius", "start", "stop", "kid", "kids"]


def _far(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.linalg.norm(v - c, axis=1)


def cover(v: np.ndarray, lead: int, radius: float, most: int) -> list[int]:
    """Centres, farthest-first from ``lead``, until all of ``v`` lie within ``radius`` of one, or ``most`` of them."""
    picked, far = [lead], _far(v, v[lead])
    while len(picked) < most and far.max() > radius:
        picked.append(int(far.argmax()))
        far = np.minimum(far, _far(v, v[picked[-1]]))
    return picked


def grow(v: np.ndarray, lead: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The cover tree of ``v`` from the root's centre ``lead`` down to single vectors: an order of the vectors in which
    each node's follow each other (``start`` to ``stop``), and the columns ``NODES``."""
    order = np.arange(len(v))
    centre, radius, start, stop, kid, kids = [lead], [float(_far(v, v[lead]).max())], [0], [len(v)], [], []
    at = 0
    while at < len(centre):
        own = order[start[at]:stop[at]].copy()
        kid.append(len(centre))
        kids.append(0)
        if len(own) > 1:
            first = int(np.flatnonzero(own == centre[at])[0])
            picked = cover(v[own], first, radius[at] / 2, len(own)) if radius[at] > SLACK else range(len(own))
            c = v[own[list(picked)]]
            nearest = np.arange(len(own)) if len(c) == len(own) else (v[own] @ c.T).argmax(axis=1)
            nearest[list(picked)] = np.arange(len(c))  # a centre is its own child's, also beside an equal vector
            by = np.argsort(nearest, kind="stable")
            order[start[at]:stop[at]] = own[by]
            edges = np.searchsorted(nearest[by], np.arange(len(c) + 1)) + start[at]
            kids[at] = len(c)
            for k, i in enumerate(picked):
                centre.append(int(own[i]))
                start.append(int(edges[k]))
                stop.append(int(edges[k + 1]))
                radius.append(float(_far(v[own[nearest == k]], v[own[i]]).max()))
        at += 1
    place = np.empty(len(v), np.int64)
    place[order] = np.arange(len(v))
    return order, {"centre": place[centre], "radius": np.array(radius), "start": np.array(start), "stop": np.array(stop),
                   "kid": np.array(kid), "kids": np.array(kids)}


def _children(tree: dict[str, np.ndarray], node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children; a single vector stands for itself."""
    single = tree["kids"][node] == 0
    return np.where(single, node, tree["kid"][node]), np.where(single, 1, tree["kids"][node])


def traverse(va: np.ndarray, ta: dict, vb: np.ndarray, tb: dict, cosine: float, same: bool):
    """``hits, whole, seen``: linked pairs of single vectors, pairs of nodes that are linked as a whole (with
    ``same`` each once, and a node with itself), and how many pairs of nodes were looked at."""
    t = np.sqrt(2 - 2 * cosine)
    x = y = np.zeros(1, np.int64)
    product, hits, whole, seen = None, [], [], 0
    while len(x):
        seen += len(x)
        ca, cb = ta["centre"][x], tb["centre"][y]
        if product is None and len(x) > len(va) * len(vb) // 16:
            product = va @ vb.T
        cos = product[ca, cb] if product is not None else np.einsum("ij,ij->i", va[ca], vb[cb])
        d = np.sqrt(np.maximum(0.0, 2 - 2 * cos))
        reach = ta["radius"][x] + tb["radius"][y]
        single = (ta["kids"][x] == 0) & (tb["kids"][y] == 0)
        hit = single & (cos >= cosine)
        if same:
            hit &= x != y
        hits.append(np.stack([ca[hit], cb[hit]], axis=1))
        all_in = ~single & (d + reach <= t - SLACK)
        whole.append(np.stack([x[all_in], y[all_in]], axis=1))
        on = ~single & ~all_in & (d <= reach + t + SLACK)
        x, y = x[on], y[on]
        fa, na = _children(ta, x)
        fb, nb = _children(tb, y)
        many = na * nb
        pair = np.repeat(np.arange(len(x)), many)
        i = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        own = (x == y)[pair] if same else None
        x, y = fa[pair] + i // nb[pair], fb[pair] + i % nb[pair]
        if same:
            keep = ~own | (x <= y)
            x, y = x[keep], y[keep]
    return np.concatenate(hits), np.concatenate(whole), seen


def _chosen(leaf: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Centres of a node from a bounded sample of its vectors, the node's own centre first."""
        node, size = pdf["node"].iloc[0], int(pdf["size"].iloc[0])
        pdf = pdf.sort_values(["far", "h"])
        v = _unit(pdf["raw"].tolist())
        far = _far(v, v[0]).max()
        picked = cover(v, 0, far / 2, CHILDREN)
        if len(picked) == CHILDREN:
            picked = list(range(min(len(v), CHILDREN, max(2, math.ceil(2 * size / leaf)))))
        return pd.DataFrame({"node": [node], "centres": [v[picked].tobytes()], "dim": [v.shape[1]]})
    return run


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector's nearest centre and its distance; a row holds some vectors of a node."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
            c, v = np.frombuffer(row["centres"], "<f8").reshape(-1, row["dim"]), _unit(row["raw"])
            child = (v @ c.T).argmax(axis=1)
            n = len(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["rep"], pa.int64()), pa.array(row["weight"], pa.int64()), pa.array(row["raw"], pa.binary()), pa.array(row["h"], pa.int64()),
                 pa.array([row["node"]] * n, pa.int64()), pa.array(child.astype(np.int32)), pa.array(np.linalg.norm(v - c[child], axis=1))],
                names=["rep", "weight", "raw", "h", "parent", "child", "far"])


def _doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centres from bytes to arrays, for the bounds."""
    for batch in batches:
        out = []
        for c, dim, i in zip(batch.column("centres").to_pylist(), batch.column("dim").to_pylist(), batch.column("child").to_pylist(), strict=True):
            out.append(np.frombuffer(c, "<f8").reshape(-1, dim)[i])
        names = ["parent", "node", "radius"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.list_(pa.float64()))], names=[*names, "centre"])


def _apart(a: Column, b: Column) -> Column:
    """Distance of two arrays of doubles."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


_GROWN = "node long, block long, ids array<long>, weights array<long>, raw binary, dim int, centre array<int>, radius array<double>, start array<int>, stop array<int>, kid array<int>, kids array<int>"


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their trees; the root's centre is the node's, in a part without it the vector nearest to the mean."""
    for batch in batches:
        for r in range(batch.num_rows):
            rows = batch.column("v")[r].as_py()
            v = _unit([x["raw"] for x in rows])
            far = np.array([x["far"] for x in rows])
            order, tree = grow(v, int(far.argmin()) if far.min() == 0 else int((v @ v.mean(axis=0)).argmax()))
            lists = [pa.array([tree[c].astype(np.float64 if c == "radius" else np.int32)]) for c in NODES]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").slice(r, 1), batch.column("block").slice(r, 1), pa.array([[rows[i]["rep"] for i in order]], pa.list_(pa.int64())),
                 pa.array([[rows[i]["weight"] for i in order]], pa.list_(pa.int64())), pa.array([v[order].tobytes()], pa.binary()), pa.array([v.shape[1]], pa.int32()), *lists],
                names=["node", "block", "ids", "weights", "raw", "dim", *NODES])


def _block(row: dict, side: str) -> tuple:
    tree = {c: np.array(row[f"{c}_{side}"]) for c in NODES}
    v = np.frombuffer(row[f"raw_{side}"], "<f8").reshape(-1, row[f"dim_{side}"])
    return np.array(row[f"ids_{side}"], np.int64), np.array(row[f"weights_{side}"], np.int64), v, tree


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                same = row["a"] == row["b"]
                one = _block(row, "a")
                ids, links, to = block_links(one, one if same else _block(row, "b"), cosine, same)
                keep = links > 0
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(links[keep]), pa.array(to[keep])], names=["rep", "links", "to"])
    return run


def block_links(one: tuple, two: tuple, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of two blocks' vectors: ids, number of links, the smallest id that each reaches by them."""
    (ids_a, wa, va, ta), (ids_b, wb, vb, tb) = one, two
    hits, whole, _ = traverse(va, ta, vb, tb, cosine, same)
    n = len(ids_a)
    ids, w, shift = (ids_a, wa, 0) if same else (np.concatenate([ids_a, ids_b]), np.concatenate([wa, wb]), n)
    i, j = hits[:, 0], hits[:, 1] + shift
    links = np.bincount(i, w[j], len(ids)) + np.bincount(j, w[i], len(ids))
    ends = [np.stack([i, j], axis=1)]
    for x, y in whole.tolist():
        p, q = slice(ta["start"][x], ta["stop"][x]), slice(tb["start"][y] + shift, tb["stop"][y] + shift)
        links[p] += w[q].sum()
        if same and x == y:
            links[p] -= w[p]
        else:
            links[q] += w[p].sum()
        of = np.concatenate([np.arange(p.start, p.stop), np.arange(q.start, q.stop)])
        ends.append(np.stack([of, np.full(len(of), of[0])], axis=1))
    e = np.concatenate(ends)
    to, before = ids.copy(), None
    while before is None or (to != before).any():
        before = to.copy()
        np.minimum.at(to, e[:, 0], before[e[:, 1]])
        np.minimum.at(to, e[:, 1], before[e[:, 0]])
    return ids, links.astype(np.int64), to


def build(rows: DataFrame, cosine: float, leaf: int) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Top of the trees by passes of Spark: the vectors with their last node, for each pass the nodes and what stands for
    them below (``parent, node, radius, centre``), and the roots as pairs."""
    whole = math.sqrt(2 - 2 * cosine) - SLACK
    todo = stage(rows.select("rep", "weight", "raw", F.xxhash64("tree").alias("node"), F.xxhash64("rep", "raw").alias("h"), F.lit(1.0).alias("far")), "tree-rows")
    roots = todo.select("node").distinct().select(F.col("node").alias("a"), F.col("node").alias("b"))
    leaves, levels, last = [], [], None
    nodes = todo.groupBy("node").agg(F.count("*").alias("size"), F.lit(2.0).alias("radius"))
    for _ in range(MAX_PASSES):
        large = stage(nodes.where((F.col("size") > leaf) & (2 * F.col("radius") > whole)).select("node", "size"), "large")
        if not large.take(1):
            break
        leaves.append(todo.join(large.select("node"), "node", "left_anti"))
        inside = todo.join(large, "node")
        sample = inside.withColumn("i", F.row_number().over(W.partitionBy("node").orderBy(F.col("far") > 0, "h", "rep"))).where(F.col("i") <= SAMPLE)
        sample = sample.withColumn("far", (F.col("far") > 0).cast("int"))
        centres = stage(sample.select("node", "size", "far", "h", "raw").groupBy("node").applyInPandas(_chosen(leaf), "node long, centres binary, dim int"), "centres")
        some = inside.groupBy("node", F.pmod("h", F.ceil(F.col("size") / leaf)).alias("part")).agg(F.collect_list(F.struct("rep", "weight", "raw", "h")).alias("v"))  # about ``leaf``
        some = some.join(centres, "node").select("node", F.col("v.rep").alias("rep"), F.col("v.weight").alias("weight"), F.col("v.raw").alias("raw"), F.col("v.h").alias("h"), "centres", "dim")
        dealt = some.mapInArrow(_nearest, "rep long, weight long, raw binary, h long, parent long, child int, far double")
        # a centre is at 0, whatever rounding says
        dealt = dealt.withColumn("far", F.when(F.col("far") > 1e-12, F.col("far")).otherwise(0.0))
        dealt = stage(dealt.withColumn("node", F.xxhash64("parent", "child")), "dealt", 8 << 20)
        below = dealt.groupBy("parent", "node", "child").agg(F.max("far").alias("radius"), F.count("*").alias("size"))
        nodes = stage(below, "nodes")
        below = nodes.join(centres.withColumnRenamed("node", "parent"), "parent").select("parent", "node", "radius", "centres", "dim", "child")
        below = below.mapInArrow(_doubles, "parent long, node long, radius double, centre array<double>")
        if last is None:
            stay = roots.join(large.select(F.col("node").alias("a")), "a", "left_anti").select(
                F.col("a").alias("parent"), F.col("a").alias("node"), F.lit(2.0).alias("radius"), F.lit(None).cast("array<double>").alias("centre"))
        else:
            stay = last.join(large.select("node"), "node", "left_anti").select(F.col("node").alias("parent"), "node", "radius", "centre")
        last = stage(below.unionAll(stay), "level", 8 << 20)
        levels.append(last)
        todo = dealt.select("rep", "weight", "raw", "node", "h", "far")
    leaves.append(todo)
    out = leaves[0].select("rep", "weight", "raw", "node", "h", "far")
    for more in leaves[1:]:
        out = out.unionAll(more.select(*out.columns))
    return out, levels, roots


def node_pairs(levels: list[DataFrame], roots: DataFrame, cosine: float) -> DataFrame:
    """``a, b, whole``: pairs of last nodes that may hold links, and whether they are linked as a whole."""
    t = math.sqrt(2 - 2 * cosine)
    pairs = roots.withColumn("whole", F.lit(False))
    for below in levels:
        one, two = (below.select(F.col("parent").alias(p), F.col("node").alias(f"n{p}"), F.col("radius").alias(f"r{p}"), F.col("centre").alias(f"c{p}")) for p in "ab")
        down = pairs.drop("whole").join(one, "a").join(two, "b").where((F.col("a") < F.col("b")) | (F.col("na") <= F.col("nb")))
        reach = F.col("ra") + F.col("rb")
        down = down.withColumn("d", F.when(F.col("na") == F.col("nb"), 0.0).otherwise(_apart(F.col("ca"), F.col("cb"))))
        down = down.where((F.col("d") <= reach + F.lit(t + SLACK)) | F.col("d").isNull())
        whole = F.coalesce(F.col("d") + reach <= F.lit(t - SLACK), F.lit(False))
        pairs = stage(down.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"), whole.alias("whole")), "pairs")
    return pairs


def linked(rows: DataFrame, cosine: float = COSINE, leaf: int = LEAF) -> DataFrame:
    """``rep, links, to`` for ``rows`` of distinct vectors (``rep, weight, raw, tree``): in each row how many
    vectors a vector links with in some pair of nodes, and the smallest id that it reaches there."""
    leaves, levels, roots = build(rows, cosine, leaf)
    pairs = node_pairs(levels, roots, cosine)
    size = leaves.groupBy("node").agg(F.count("*").alias("size"))
    blocks = leaves.join(size, "node").withColumn("part", F.pmod("h", F.ceil(F.col("size") / leaf)).cast("int"))
    blocks = blocks.groupBy("node", "part").agg(F.sort_array(F.collect_list(F.struct("rep", "weight", "raw", "far"))).alias("v"))
    blocks = stage(blocks.select("node", F.xxhash64("node", "part").alias("block"), "v").mapInArrow(_grown, _GROWN), "blocks", 8 << 20)
    part = blocks.select("node", "block")
    of = pairs.where("not whole").join(part.select(F.col("node").alias("a"), F.col("block").alias("x")), "a").join(part.select(F.col("node").alias("b"), F.col("block").alias("y")), "b")
    of = of.where("a < b or x <= y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    columns = ["ids", "weights", "raw", "dim", *NODES]
    left, right = (blocks.select(F.col("block").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in columns]) for p in "ab")
    found = stage(of.join(right, "b").join(left, "a").mapInArrow(_compare(cosine), "rep long, links long, to long"), "links", 8 << 20)
    if not levels:
        return found
    # nodes that are linked as a whole: each vector of one has links with all of the other
    sums = leaves.groupBy("node").agg(F.sum("weight").alias("all"), F.min("rep").alias("least"))
    joined = pairs.where("whole")
    ways = joined.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(joined.where("a < b").select(F.col("b").alias("node"), F.col("a").alias("other")))
    ways = ways.join(sums.withColumnRenamed("node", "other"), "other")
    met = leaves.select("node", "rep", "weight").join(ways, "node").select(
        "rep", (F.col("all") - F.when(F.col("node") == F.col("other"), F.col("weight")).otherwise(0)).alias("links"), F.col("least").alias("to"))
    return found.unionAll(stage(met.where("links > 0"), "whole"))


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = COSINE, leaf: int = LEAF) -> DataFrame:
    """``<id>, n_links, component_id, kept`` of each row."""
    rows = narrow(vectors, id_column, vector_column, label_column).select(F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("string").alias("label"), F.col(vector_column).alias("v"))
    rows = stage(rows.mapInArrow(_bytes, "id long, label string, raw binary"), "vectors")
    can = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull()
    classes = rows.where(can).groupBy("label", "raw").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    classes = stage(classes.withColumn("tree", F.concat_ws("/", F.length("raw").cast("string"), "label")), "classes")
    found = linked(classes, cosine, leaf)
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    named = classes.join(sums, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("label", "raw", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("bigint").alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(named, ["label", "raw"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
