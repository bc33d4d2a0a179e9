"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken ``target / source_size`` times on average (2 at most). The
whole part is taken always; the fractional part is a probability. Two documents with fractional
probabilities are paired, and words are moved from one to the other, in a random direction with
odds that keep each document's expectation, until one of the two probabilities is 0 or 1. The other
goes on to the next pair. The words that a source is expected to give stay the same in each step, so
at the end one document a source is left to be rounded alone, and the words taken differ from the
target by less than that document's size.

The pairing runs as a reduction tree: documents are dealt to buckets of about ``FAN`` by a hash, a
bucket is folded into decisions and one residual, and the residuals of ``FAN`` buckets meet in a
bucket of the next level. So a source of n documents takes log(n) / log(FAN) levels of small groups,
and no group holds a source. Larger documents are folded first, so that the residual is small.
Everything is DataFrame functions, and all randomness is a hash of the document and the seed.

Rows that agree in doc_id, source and size (``mix``: in all columns) are counted first and dealt with as
one; of m of them, each gets the whole part, and the sum of their probabilities is split into whole rows
and one fraction. So it never matters which of them are the first, and one row that is repeated very
often is counted in parts, and its copies are made in many tasks. A null text has no words, null doc_ids and sources are values like any other. A document
without words gives none. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, narrow, nullable_key, repeated, row_hash, set_aside, stage, uniform

FAN = 64
#: Weights of the sources in the order of their names, repeating; share of all words; most copies.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, weight, source_size, target`` of ``sizes`` (``source, source_size``).

    Targets are in proportion to the weights, but at most ``most`` times the source's size; what is
    cut off goes to the others by weight. So target = min(cap, level * weight), with the one level at
    which the targets sum up to the share. Sources are taken in the order in which they reach their
    cap, and the level is read where the next one is not yet capped."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    all_, order = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("at", level)
    reached = F.min(F.when(F.col("cap") >= F.col("at") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "at"))).over(all_)
    target = F.least("cap", F.coalesce(reached["at"] * F.col("weight"), F.col("cap")))
    return s.select("source", "weight", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def _fold(units: Column, seed: int, level: int, last: bool) -> Column:
    """Units (structs with ``size``, ``p`` and what else names them) to ``done`` ones and one ``left``."""
    number = lambda v: F.lit(v).cast("double")

    def with_p(u: Column, p: Column) -> Column:
        return u.withField("p", p)

    def step(state: Column, b: Column) -> Column:
        a = state["left"]
        up = F.least((number(1) - a["p"]) * a["size"], b["p"] * b["size"])  # words that a can gain from b
        down = F.least(a["p"] * a["size"], (number(1) - b["p"]) * b["size"])
        gain = uniform(seed, F.lit(level), a["id"], b["id"], b["size"]) * (up + down) < down
        words = F.when(gain, up).otherwise(-down)
        a_to = a["p"] + words / a["size"]
        b_to = b["p"] - words / b["size"]
        # which of the two became whole is known from the bound that was reached, not from the sum
        a_whole = F.when(gain, (number(1) - a["p"]) * a["size"] <= b["p"] * b["size"]).otherwise(a["p"] * a["size"] <= (number(1) - b["p"]) * b["size"])
        a_end = F.when(gain, number(1)).otherwise(number(0))
        return F.when(a_whole, F.struct(with_p(b, F.greatest(number(0), F.least(number(1), b_to))).alias("left"), F.array_append(state["done"], with_p(a, a_end)).alias("done"))) \
                .otherwise(F.struct(with_p(a, F.greatest(number(0), F.least(number(1), a_to))).alias("left"), F.array_append(state["done"], with_p(b, number(1) - a_end)).alias("done")))

    start = F.struct(units[0].alias("left"), F.slice(units, 1, 0).alias("done"))
    out = F.aggregate(F.slice(units, 2, F.size(units)), start, step)
    if not last:
        return out
    whole = lambda u: with_p(u, F.when(uniform(seed, F.lit(-1), u["id"], u["size"].cast("bigint")) < u["p"], number(1)).otherwise(number(0)))
    return F.struct(out["left"].alias("left"), F.array_append(out["done"], whole(out["left"])).alias("done"))


def mixture(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7, fan: int = FAN) -> DataFrame:
    """``doc_id, source, size, source_size, target, rows, extra, copies`` of each set of equal rows (if ``docs`` has
    a ``row_key``, of each row_key too): ``rows`` of them are taken ``copies`` times each, the first ``extra`` of
    them once more."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    names = ["doc_id", "source", *(["row_key"] if "row_key" in docs.columns else [])]
    classes = stage(narrow(docs, *names, "text").select(*names, size.alias("size")).groupBy(*names, "size").agg(F.count("*").alias("rows")), "mix-sizes")
    named, keyed = F.col("doc_id"), "row_key" in names
    if keyed:  # the key tells rows apart only where id, source and size don't; a null adds nothing to a hash
        alike = classes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("alike")).where("alike > 1").toDF("a_id", "a_source", "a_size", "alike")
        classes = classes.join(alike, F.col("doc_id").eqNullSafe(F.col("a_id")) & F.col("source").eqNullSafe(F.col("a_source")) & (F.col("size") == F.col("a_size")), "left")
        named = F.struct("doc_id", F.when(F.col("alike").isNotNull(), F.col("row_key")).alias("row_key"))
    sizes = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("classes"))
    targets = source_targets(sizes.select("source", "source_size"), weights, share, most).join(
        sizes.select(F.col("source").alias("s"), "classes"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    targets = stage(targets.select(nullable_key(F.col("source")).alias("key"), "source_size", "target", rate.alias("rate"),
                                   F.ceil(F.col("classes") / fan).alias("buckets")), "mix-targets")
    most_buckets = targets.agg(F.max("buckets")).first()[0] or 1
    units = classes.withColumn("key", nullable_key(F.col("source"))).join(targets, "key")
    copies = F.floor("rate")
    chance = (F.col("rate") - copies) * F.col("rows")
    units = units.select("source", "source_size", "target", F.pmod(F.xxhash64(F.lit(seed), named, "size"), F.col("buckets")).alias("bucket"),
                         F.struct(F.col("size").cast("double").alias("size"), (chance - F.floor(chance)).alias("p"), named.alias("id"),
                                  "rows", F.floor(chance).alias("extra"), copies.alias("copies"), *(["row_key"] if keyed else [])).alias("u"))
    whole = (F.col("u.p") <= 0) | (F.col("u.size") <= 0)
    parts = [units.where(whole).select("source", "source_size", "target", F.col("u").withField("p", F.lit(0.0)).alias("u"))]
    units = units.where(~whole)
    level = 0
    while True:
        last = most_buckets <= 1
        groups = units.groupBy("source", "source_size", "target", "bucket").agg(F.sort_array(F.collect_list("u"), asc=False).alias("units"))
        folded = stage(groups.withColumn("f", _fold(F.col("units"), seed, level, last)).drop("units"), "mix-level")
        parts.append(folded.select("source", "source_size", "target", F.explode("f.done").alias("u")))
        if last:
            break
        units = folded.select("source", "source_size", "target", F.floor(F.col("bucket") / fan).alias("bucket"), F.col("f.left").alias("u"))
        most_buckets, level = -(-most_buckets // fan), level + 1
    done = parts[0]
    for p in parts[1:]:
        done = done.unionByName(p)
    ids = [F.col("u.id.doc_id").alias("doc_id"), F.col("u.row_key").alias("row_key")] if keyed else [F.col("u.id").alias("doc_id")]
    return done.select(*ids, "source", F.col("u.size").cast("bigint").alias("size"), "source_size", "target", F.col("u.rows").alias("rows"),
                       (F.col("u.extra") + F.col("u.p").cast("bigint")).alias("extra"), F.col("u.copies").alias("copies"))


def mixed_sizes(docs: DataFrame, **parameters) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, size, source_size, target, taken, source, copies``."""
    m = repeated(mixture(narrow(docs, "doc_id", "source", "text"), **parameters), "rows", "i")
    copies = F.col("copies") + F.when(F.col("i") < F.col("extra"), 1).otherwise(0)
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("bigint").alias("taken"), "source", copies.cast("int").alias("copies"))


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, each as many times as the mixture takes it."""
    docs, back = set_aside(docs, "doc_id", "source", "text")
    names = docs.columns
    docs = docs.withColumn("row_key", row_hash(docs))
    m = mixture(docs, **parameters).where("copies > 0 or extra > 0")
    m = m.select(F.col("doc_id").alias("m_id"), nullable_key(F.col("source")).alias("m_key"), F.col("row_key").alias("m_row"), (F.col("rows") * F.col("copies") + F.col("extra")).cast("long").alias("m_n"), F.col("rows").alias("m_rows"))
    rows = docs.join(m, F.col("doc_id").eqNullSafe(F.col("m_id")) & (nullable_key(F.col("source")) == F.col("m_key")) & (F.col("row_key") == F.col("m_row")))
    single = rows.where("m_rows = 1").select(*names, "m_n")
    # rows that are equal in all columns become one, and as many come out as are taken
    several = rows.where("m_rows > 1").groupBy("m_id", "m_key", "m_row", "m_n").agg(F.first(F.struct(*names)).alias("row")).select("row.*", "m_n")
    copied = single.withColumn("m_c", F.explode(F.array_repeat(F.lit(0), F.col("m_n").cast("int"))))
    return copied.select(*names).unionAll(repeated(several, "m_n", "m_c").select(*names)).select(*back)
