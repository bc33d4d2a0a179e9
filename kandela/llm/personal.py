r"""Personal data: overlapping candidates from high-recall generators, judged by boosted trees.

1. Generators. Each kind (email, ip, card, phone) has a base pattern and a wide one. Base matches that
   pass their check (parts of at most 255, Luhn, numbers of digits) are always spans. Wide patterns
   propose more, also inside or across other matches: emails with letters of any script or written with
   ``(at)``, addresses of version 6, numbers in groups or without ``+``, and numbers that a base pattern has
   swallowed together with their neighbours.
2. Labels. A candidate that equals a base span is a finding. It is none where its check fails away from base
   spans of its kind, or where it lies in a base span of another kind. All others, such as a number inside
   a longer match that failed its check, have no label: these the trees decide. Each finding also gives
   a broken copy (a digit changed, a part of 999, digits missing or too many, no dots), which is none.
3. Trees. Spark ML's gradient-boosted trees learn from all labelled candidates, with features of the format
   (lengths, groups, digits, checks) and of ``CONTEXT`` characters to each side (kinds of the neighbours, digits
   around, cue words). Candidates with equal features are one example with their number as its weight; there are
   bins enough that Spark ML takes the places to split at from all examples, too.
4. Thresholds. The rows are dealt into ``FOLDS`` folds, and each fold is judged by trees that learnt from the others
   only. From the scores of all labelled candidates, for each kind, the lowest one is taken from which on
   ``PRECISION`` of them are findings (``NO_THRESHOLD`` where there are none). Candidates to which the trees of
   all rows give at least that score are spans too.

All steps are DataFrame functions, also the places of matches: what lies between matches is split off,
and lengths are summed up by a window over a row's matches. The base patterns are written so that they
take time in proportion to the text (possessive, and starting only where a match can begin), with the same
matches. Places count code points, ends are exclusive.

Results: a null or empty text has no span. Null doc_ids are values like any other, repeated rows get a row
each. Texts are taken whole. Without any finding nothing can be learnt, and base spans are all there is. An
empty table gives no rows. Ties (equal spans found twice) count once. Only doc_id and text are read. Spark ML adds up
doubles in any order, so with examples in several partitions a rerun may choose another of two equally good splits;
base spans don't depend on that.
"""

from __future__ import annotations

from functools import reduce
from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow, set_aside, stage

KINDS = ("email", "ip", "card", "phone")
PRECISION, NO_THRESHOLD, CONTEXT = 0.995, 0.95, 24
TREES, DEPTH, FOLDS, SEED = 20, 4, 4, 13

_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: The base patterns (email, ip, card, phone).
BASE = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_ANY = r"""\x00-\x20@<>()\[\]{}",;:'|/\\"""
WIDE = (
    rf"(?:\G|(?<![^{_ANY}]))[^{_ANY}]++@[^{_ANY}]++(?<![.!?*_-])|(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++ ?[(\[]at[)\]] ?[\p{{L}}\p{{N}}-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[\p{{L}}\p{{N}}-]++)++",
    r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4}){2,3}(?:[ ./_-]{1,2}[0-9]{1,3})?|[0-9]{4}[ ./_-][0-9]{6}[ ./_-][0-9]{4,5})(?![0-9])",
    r"(?<![0-9+])\+?[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])",
)
#: Words near a value that speak for its kind.
CUES = ("mail|write|contact|reach", r"\bip\b|host|server|address|client", "card|visa|credit|pay|account", r"tel\b|phone|call|fax|mobile|dial")


def _hits(text: Column) -> list[Column]:
    """For each generator, arrays of what lies between its matches and of the matches."""
    email = text.contains("@") | text.rlike(r"[(\[]at[)\]]")
    some = {0: text.contains("@"), 3: text.contains("+"), 4: email}
    digit = text.rlike("[0-9]")
    out = []
    for g, pattern in enumerate(BASE + WIDE):
        on = some.get(g, digit)
        out += [F.when(on, F.split(text, pattern, -1)).alias(f"between{g}"), F.when(on, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"hit{g}")]
    return out


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``row, doc_id`` of each row of ``docs``, and all matches: ``row, kind, wide, start, end, value, left, right``."""
    docs = narrow(docs, "doc_id", "text")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hits = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *_hits(text))

    def listed(g: int) -> Column:
        before, hit = F.col(f"between{g}"), F.col(f"hit{g}")
        zipped = F.arrays_zip(hit.alias("value"), F.slice(before, F.lit(1), F.size(hit)).alias("before"), F.slice(before, F.lit(2), F.size(hit)).alias("behind"))
        one = lambda z, i: F.struct(F.lit(g).alias("g"), i.alias("i"), z["value"].alias("value"), F.length(z["before"]).alias("gap"),
                                    F.right(z["before"], F.lit(CONTEXT)).alias("left"), F.left(z["behind"], F.lit(CONTEXT)).alias("right"))
        return F.coalesce(F.transform(zipped, one), F.array().cast("array<struct<g:int,i:int,value:string,gap:int,left:string,right:string>>"))

    n = len(BASE + WIDE)
    hits = hits.select("row", "doc_id", *[listed(g).alias(f"m{g}") for g in range(n)])
    hits = stage(hits.select("row", "doc_id", F.concat(*[F.col(f"m{g}") for g in range(n)]).alias("m")), "pii-hits")
    each = hits.where(F.size("m") > 0).select("row", F.explode("m").alias("m")).select("row", "m.*")
    # places: all that lies between the matches of a generator up to here, and the matches
    end = F.sum(F.col("gap").cast("long") + F.length("value")).over(W.partitionBy("row", "g").orderBy("i"))
    each = each.withColumn("end", end)
    kind = F.pmod("g", F.lit(len(KINDS))).cast("int")
    each = each.select("row", kind.alias("kind"), (F.col("g") >= len(BASE)).alias("wide"), (F.col("end") - F.length("value")).alias("start"), "end", "value", "left", "right")
    return hits.select("row", "doc_id"), each


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(kind: Column, value: Column) -> Column:
    """Whether a value passes the check of its kind."""
    digits = _digits(value)
    n = F.length(digits)
    part = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
    ip = F.when(value.contains(":"), F.lit(True)).otherwise(F.forall(F.split(value, "[.]"), part))
    card = n.between(12, 19) & F.when(n.between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)
    return F.when(kind == 0, value.contains(".") | value.contains("dot")).when(kind == 1, ip).when(kind == 2, card).otherwise(n.between(9, 15))


def spans_of(found: DataFrame) -> DataFrame:
    """Distinct spans of the matches: ``row, kind, start, end, base, passes, value, left, right, label``."""
    found = found.withColumn("passes", _passes(F.col("kind"), F.col("value"))).where("wide or passes")
    spans = found.groupBy("row", "kind", "start", "end").agg((~F.min("wide")).alias("base"), F.max("passes").alias("passes"), F.first("value").alias("value"), F.first("left").alias("left"), F.first("right").alias("right"))
    # base spans that overlap: of those that begin before, the greatest end; of the later ones, the least begin
    ahead, behind = W.partitionBy("row").orderBy("start"), W.partitionBy("row").orderBy(F.desc("start"))
    for k in range(len(KINDS)):
        own = F.col("base") & (F.col("kind") == k)
        spans = spans.withColumn(f"end{k}", F.max(F.when(own, F.col("end"))).over(ahead)).withColumn(f"start{k}", F.min(F.when(own, F.col("start"))).over(behind))
    near = [F.coalesce(F.col(f"end{k}") > F.col("start"), F.lit(False)) | F.coalesce(F.col(f"start{k}") < F.col("end"), F.lit(False)) for k in range(len(KINDS))]
    same = reduce(lambda a, k: F.when(F.col("kind") == k, near[k]).otherwise(a), range(len(KINDS)), F.lit(False))
    other = reduce(lambda a, k: a | ((F.col("kind") != k) & near[k]), range(len(KINDS)), F.lit(False))
    label = F.when(F.col("base"), 1.0).when(~same & (~F.col("passes") | other), 0.0)
    return spans.withColumn("label", label).drop(*[f"{w}{k}" for w in ("start", "end") for k in range(len(KINDS))])


def _broken(kind: Column, value: Column) -> Column:
    """A finding's value with its check spoilt."""
    last = F.pmod(F.right(value, F.lit(1)).try_cast("int") + 1, F.lit(10)).cast("string")
    card = F.concat(F.substring(value, F.lit(1), F.length(value) - 1), last)
    short = F.pmod(F.xxhash64(value), F.lit(2)) == 0
    phone = F.when(short, F.substring(value, 1, 7)).otherwise(F.concat(value, F.lit("-"), F.reverse(_digits(value))))
    email = F.concat(F.substring_index(value, "@", 1), F.lit("@"), F.regexp_replace(F.substring_index(value, "@", -1), "[.]", ""))
    return F.when(kind == 0, email).when(kind == 1, F.regexp_replace(value, "^[0-9]+", "999")).when(kind == 2, card).otherwise(phone)


def features(kind: Column, value: Column, left: Column, right: Column) -> Column:
    """Numbers that describe a candidate's format and what stands around it."""
    digits, groups = _digits(value), F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    count = lambda c, p: F.regexp_count(c, F.lit(p))
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    cue = reduce(lambda a, k: F.when(kind == k, left.rlike("(?i)" + CUES[k])).otherwise(a), range(len(KINDS)), F.lit(False))
    of = [(kind == k) for k in range(len(KINDS))]
    of += [F.length(value), F.length(digits), count(value, r"\p{L}"), count(value, r"[^\x00-\x7F]"), count(value, r"\."), count(value, "[ -]"), count(value, "[()]"), count(value, ":"),
           value.startswith("+"), count(value, "@"), F.size(groups), F.array_max(F.transform(groups, F.length)), F.array_min(F.transform(groups, F.length)),
           F.length(F.substring_index(value, ".", -1)), F.array_max(F.transform(groups, lambda g: F.least(g.try_cast("int"), F.lit(100_000)))), F.left(digits, F.lit(1)).try_cast("int"),
           F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)), F.length(digits) / F.greatest(F.length(value), F.lit(1)),
           left.rlike(r"[\p{L}\p{N}]$"), left.rlike(r"[0-9][ .()-]?$"), right.rlike(r"^[\p{L}\p{N}]"), right.rlike("^[ .()-]?[0-9]"), F.right(left, F.lit(1)) == "+",
           count(left, "[0-9]"), count(right, "[0-9]"), cue]
    return F.array(*[number(c) for c in of])


def _taught(labelled: DataFrame, max_train: int | None) -> DataFrame:
    """All labelled candidates (``max_train``: at most so many of each kind and label), and broken copies of the findings."""
    some = labelled
    if max_train is not None:
        order = F.row_number().over(W.partitionBy("kind", "label").orderBy("h", "row", "start", "end"))
        some = some.withColumn("h", F.xxhash64("row", "kind", "start", F.lit(SEED))).withColumn("place", order).where(F.col("place") <= max_train)
    some = some.select("row", "kind", "label", "value", "left", "right")
    spoilt = some.where("label = 1").withColumn("value", _broken(F.col("kind"), F.col("value"))).withColumn("label", F.lit(0.0))
    return some.unionByName(spoilt)


def scored(spans: DataFrame, max_train: int | None = None, precision: float = PRECISION) -> DataFrame:
    """``row, kind, start, end, base, label, score, accepted`` of all spans; a base span is always accepted."""
    described = features(*(F.col(c) for c in ("kind", "value", "left", "right")))
    fold = F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(FOLDS)).cast("int")
    examples = _taught(spans.where("label is not null"), max_train).select("kind", "label", described.alias("features"), fold.alias("fold"))
    examples = examples.groupBy("kind", "label", "features", "fold").agg(F.count("*").cast("double").alias("weight"))
    examples = stage(examples.sortWithinPartitions("kind", "label", "features", "fold"), "pii-examples")
    n = {(r["fold"], r["label"]): r["n"] for r in examples.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}  # two rows for each fold
    keep = ["row", "kind", "start", "end", "base", "label"]
    if len({label for _, label in n}) < 2:
        return spans.select(*keep, F.col("base").cast("double").alias("score"), F.col("base").alias("accepted"))
    # places to split at are sought among as many rows as the square of the bins: with these, among all
    bins = max(32, isqrt(sum(n.values())) + 1)
    trees = GBTClassifier(featuresCol="v", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=0.3, seed=SEED, cacheNodeIds=False)
    learnt = lambda df: trees.fit(df.select("label", "weight", array_to_vector("features").alias("v")))
    judge = lambda model, df: model.transform(df.withColumn("v", array_to_vector("features"))).withColumn("score", vector_to_array("probability")[1])
    # each fold by trees that haven't seen its rows, where the others hold both labels
    tried = [k for k in sorted({f for f, _ in n}) if len({label for f, label in n if f != k}) == 2]
    folds = [judge(learnt(examples.where(F.col("fold") != k)), examples.where(F.col("fold") == k)).select("kind", "label", "weight", "score") for k in tried]
    least = _thresholds(reduce(DataFrame.unionByName, folds), precision) if folds else {}
    threshold = reduce(lambda a, k: F.when(F.col("kind") == k, F.lit(float(least.get(k, NO_THRESHOLD)))).otherwise(a), range(len(KINDS)), F.lit(NO_THRESHOLD))
    out = judge(learnt(examples), spans.withColumn("features", described))
    return out.select(*keep, "score", (F.col("base") | (F.col("score") >= threshold)).alias("accepted"))


def _thresholds(judged: DataFrame, precision: float) -> dict[int, float]:
    """For each kind, from the highest score down: the lowest one from which on enough are findings."""
    bins = judged.groupBy("kind", F.floor(F.col("score") * 1000).alias("bin")).agg(F.sum(F.col("label") * F.col("weight")).alias("hits"), F.sum("weight").alias("n"))
    down = W.partitionBy("kind").orderBy(F.desc("bin"))
    share = F.sum("hits").over(down) / F.sum("n").over(down)
    least = bins.withColumn("share", share).where(F.col("share") >= precision).groupBy("kind").agg((F.min("bin") / 1000).alias("least"))
    return {r["kind"]: r["least"] for r in least.collect()}  # one row for each kind


def personal_spans(docs: DataFrame, **parameters) -> tuple[DataFrame, DataFrame]:
    """``row, doc_id`` of each row of ``docs``, and the spans of all rows (as from ``scored``, accepted ones only)."""
    rows, found = candidates(docs)
    spans = stage(spans_of(found), "pii-spans")
    return rows, stage(scored(spans, **parameters).where("accepted"), "pii-accepted")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def span_digests(docs: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of each row of ``docs``."""
    rows, spans = personal_spans(docs, **parameters)
    each = F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base")))  # those of one text
    spans = spans.groupBy(F.col("row").alias("of")).agg(each.alias("all"))
    out = rows.join(spans, F.col("row") == F.col("of"), "left").withColumn("all", F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,base:boolean>>")))
    base = F.filter("all", lambda s: s["base"])
    counts = [F.size(F.expr(f"filter(all, s -> s.base and s.kind = {k})")).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` with ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]`` in the place of personal data; of
    spans that overlap, all is covered under the name of the first."""
    plain, back = set_aside(docs, "doc_id", "text")
    names = plain.columns
    # the rows with their numbers are written, so that spans are found in the text they are cut from
    plain = stage(plain.withColumn("_n", F.monotonically_increasing_id()), "pii-rows")
    rows, spans = personal_spans(plain.select(F.col("_n").alias("doc_id"), "text"), **parameters)
    spans = spans.join(rows.select(F.col("row").alias("r"), F.col("doc_id").alias("_of")), F.col("row") == F.col("r"))
    # where no span before reaches, a new stretch begins
    reach = F.max("end").over(W.partitionBy("row").orderBy("start", "kind", "end").rowsBetween(W.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    spans = spans.withColumn("stretch", F.sum("new").over(W.partitionBy("row").orderBy("start", "kind", "end")))
    spans = spans.groupBy("_of", "stretch").agg(F.min(F.struct("start", "kind")).alias("first"), F.max("end").alias("end"))
    before = F.coalesce(F.lag("end").over(W.partitionBy("_of").orderBy("stretch")), F.lit(0))
    spans = spans.select("_of", F.struct(F.col("first.start").alias("start"), F.col("first.kind").alias("kind"), "end", before.alias("before")).alias("s"))
    spans = spans.groupBy("_of").agg(F.sort_array(F.collect_list("s")).alias("stretches"))  # those of one text
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    cut = lambda a, b: F.col("text").substr((a + 1).cast("int"), (b - a).cast("int"))
    parts = F.transform("stretches", lambda s: F.concat(cut(s["before"], s["start"]), F.get(marks, s["kind"])))
    new = F.concat(F.array_join(parts, ""), cut(F.element_at("stretches", -1)["end"], F.length("text").cast("long")))
    out = plain.join(spans, F.col("_n") == F.col("_of"), "left").withColumn("text", F.when(F.col("stretches").isNull(), F.col("text")).otherwise(new))
    return out.select(*names).select(*back)
