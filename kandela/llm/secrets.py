"""Secret scans with a random forest for the removal of false positives.

Candidates are found by their outer form: values of 8 characters or more that are assigned (``=``,
``:``) to something named like a password, key or token, and runs of 16 or more characters of keys'
alphabets that aren't plain words (they hold a digit, or capitals beyond the first letter). Every
candidate gets features: length, character transitions (changes between kinds of characters, and how
likely each pair of neighbours is in the dictionary), entropy, shares of digits and capitals,
dictionary coverage, the path (``source``) and the neighbouring words. A random forest scores them.

The forest is trained on labelled findings. ``scan`` takes them as a table; without one they are made
by ``known_findings``: candidates whose form leaves no doubt, either way. At most ``MAX_TRAIN`` findings of each
label train it, those with the smallest hash (a documented bound; all candidates of all texts are
scored). The dictionary is the word list of a public tokenizer, whose path is a parameter.

Null and empty texts have no candidates. A null source is an empty path. A null doc_id is carried as it
is. Findings in repeated rows are repeated; equal findings train once. Where the labelled findings hold no finding
of one label, there is nothing to learn: all candidates get the score of the other label, or 0.5
without any. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, set_aside, stage
from .packing import vocabulary_path

TREES, TREE_DEPTH, MAX_TRAIN, SEED = 24, 6, 10_000, 4
MASK = "[SECRET]"

_RUN = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}={0,2}")
# fixed values: names of what holds a secret, and of places that hold made-up ones
_NAMES = r"(?:pass(?:w(?:or)?d|phrase)?|pwd|secret|token|key|auth|credentials?|bearer)"
# a value without quotes ends before a sign that begins the next assignment, too
_ASSIGNED = re.compile(_NAMES + r"[\"']?\s*[:=][ \t]*(?:[\"']([^\s\"']{8,})|((?:(?![&;,][\w.%\[\] -]{1,40}[:=])[^\s\"']){8,}))", re.IGNORECASE)
_MADE_UP = re.compile(r"test|example|sample|demo|dummy|doc", re.IGNORECASE)

FEATURES = ["length", "entropy", "changes", "likely", "digits", "capitals", "distinct", "hex", "covered",
            "path_length", "path_depth", "path_digits", "path_made_up", "named", "assigned", "quoted", "before_covered", "after_covered", "before_length"]


class Dictionary:
    """Words of a vocabulary, and how likely one letter follows another in them."""

    def __init__(self, path: str):
        words = {w[:-4] for w in json.load(open(path, encoding="utf-8"))["model"]["vocab"] if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha()}
        self.words = {w for w in words if len(w) >= 4}
        self.longest = max(map(len, self.words), default=0)
        pairs = np.ones((128, 128))
        for w in words:
            b = np.frombuffer(w.encode(), np.uint8)
            np.add.at(pairs, (b[:-1], b[1:]), 1)
        self.likely = np.log(pairs / pairs.sum(axis=1, keepdims=True))

    def covered(self, text: str) -> float:
        """Share of the characters that words of four or more letters cover, longest first from the left."""
        text, i, n = text.lower(), 0, 0
        size = len(text)
        while i < size - 3:
            for k in range(min(self.longest, size - i), 3, -1):
                if text[i:i + k] in self.words:
                    i, n = i + k, n + k
                    break
            else:
                i += 1
        return n / max(1, size)


_DICTIONARIES: dict[str, Dictionary] = {}


def dictionary(path: str) -> Dictionary:
    if path not in _DICTIONARIES:
        _DICTIONARIES[path] = Dictionary(path)
    return _DICTIONARIES[path]


def candidates(text: str) -> list[tuple[int, int, bool]]:
    """Start, end and whether it is a named assignment, of each candidate."""
    found: dict[int, tuple[int, bool]] = {}
    for m in _ASSIGNED.finditer(text):
        start = m.start(m.lastindex)
        end = start + len(m.group(m.lastindex).rstrip(".,;:!?)]}"))
        if end - start >= 8:
            found[start] = (end, True)
    busy = sorted((a, e) for a, (e, _) in found.items())
    for m in _RUN.finditer(text):
        v = m.group()
        if v[1:].islower() and v[1:].isalpha():
            continue
        if (any(c.isdigit() for c in v) or v.upper() == v or any(c.isupper() for c in v[1:])) and not any(a < m.end() and m.start() < e for a, e in busy):
            found[m.start()] = (m.end(), False)
    return [(a, e, named) for a, (e, named) in sorted(found.items())]


def describe(text: str, a: int, e: int, named: bool, path: str, words: Dictionary) -> list[float]:
    """The features of a candidate, in the order of FEATURES."""
    v = text[a:e]
    n = len(v)
    counts = np.unique(list(v), return_counts=True)[1]
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in v]
    low = np.frombuffer(v.lower().encode("ascii", "replace"), np.uint8)
    before, after = text[max(0, a - 60):a], text[e:e + 60]
    previous = re.findall(r"\w+", before)
    following = re.findall(r"\w+", after)
    return [float(n), float(-(counts / n * np.log2(counts / n)).sum()), sum(x != y for x, y in zip(kind, kind[1:], strict=False)) / max(1, n - 1),
            float(words.likely[low[:-1], low[1:]].mean()) if n > 1 else 0.0, kind.count("d") / n, kind.count("u") / n, len(counts) / n,
            float(all(c in "0123456789abcdefABCDEF" for c in v)), words.covered(v),
            float(len(path)), float(path.count("/")), float(sum(c.isdigit() for c in path)), float(bool(_MADE_UP.search(path))),
            float(named), float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:] in "\"'" and bool(before)),
            words.covered(previous[-1]) if previous else 0.0, words.covered(following[0]) if following else 0.0, float(len(previous[-1]) if previous else 0)]


def find_candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text_key, start, length, value, named, features`` of each candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary(path or vocabulary_path())
        for batch in batches:
            row, out = [], []
            source, texts = batch.column("source"), batch.column("text")
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                for a, e, named in candidates(text) if text else ():
                    row.append(i)
                    out.append((a, e - a, text[a:e], named, describe(text, a, e, named, source[i].as_py() or "", words)))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.float64())]
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_key").take(at), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))],
                                             names=["doc_id", "text_key", "start", "length", "value", "named", "features"])

    docs = narrow(docs, "doc_id", "source", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, start long, length long, value string, named boolean, features array<double>")


def known_findings(found: DataFrame) -> DataFrame:
    """Candidates with a ``label``: 1 where the form is that of an issued key, or a value assigned to a
    secret's name is a random one; 0 where it is words, a number, or the same few characters again."""
    v = F.col("value")
    # fixed values: forms of issued keys
    issued = v.rlike(r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^sk_live_[0-9A-Za-z]{24,}$|^xox[abp]-[0-9A-Za-z-]{20,}$|^AIza[0-9A-Za-z_-]{35}$")
    random_ = F.col("named") & v.rlike(r"[0-9].*[0-9].*[0-9]") & v.rlike(r"[A-Za-z].*[A-Za-z]")
    plain = v.rlike(r"^[0-9+/_-]+$") | (v.rlike(r"^[A-Za-z_/+-]+={0,2}$") & ~issued)
    return found.withColumn("label", F.when(issued | random_, 1).when(plain, 0)).where("label is not null")


def train(labelled: DataFrame, max_train: int = MAX_TRAIN):
    """A forest from findings (``features, label``); the only label there is, or None, if it can't be trained."""
    rows = labelled.select("features", F.col("label").cast("double").alias("label")).distinct().withColumn("h", F.xxhash64("features"))
    sample = None
    for label in (0.0, 1.0):
        part = rows.where(F.col("label") == label).orderBy("h", "features").limit(max_train)
        sample = part if sample is None else sample.unionAll(part)
    sample = stage(sample.coalesce(1).sortWithinPartitions("h", "label"), "findings")
    labels = [r["label"] for r in sample.select("label").distinct().collect()]  # two at most
    if len(labels) < 2:
        return labels[0] if labels else None
    forest = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=TREES, maxDepth=TREE_DEPTH, seed=SEED)
    return forest.fit(sample.select(array_to_vector("features").alias("v"), "label"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """All candidates with ``score`` (0 to 1) and ``is_secret``."""
    found = stage(find_candidates(docs, path), "candidates")
    model = train(known_findings(found) if labelled is None else labelled)
    if model is None or isinstance(model, float):
        return found.withColumn("score", F.lit(0.5 if model is None else model)).withColumn("is_secret", F.col("score") >= 0.5)
    scored = model.transform(found.withColumn("v", array_to_vector("features")))
    out = scored.withColumn("score", vector_to_array("probability")[1])
    return out.select(*found.columns, "score", (F.col("score") >= 0.5).alias("is_secret"))


def findings(docs: DataFrame, **parameters) -> DataFrame:
    """``doc_id, start, length, shown, score, is_secret``: of the value, only the first four characters are shown."""
    shown = F.concat(F.substring("value", 1, 4), F.lit("..."))
    return scan(docs, **parameters).select("doc_id", "start", "length", shown.alias("shown"), "named", "score", "is_secret")


def _masked(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = batch.column("text"), batch.column("spans")
            mask, new = pc.is_valid(spans).to_numpy(zero_copy_only=False), []
            for i in np.flatnonzero(mask):
                own = text[i].as_py()
                for s in sorted(spans[i].as_py(), key=lambda s: -s["start"]):
                    own = own[:s["start"]] + MASK + own[s["start"] + s["length"]:]
                new.append(own)
            if new:
                text = pc.replace_with_mask(text, pa.array(mask), pa.array(new, text.type))
            yield pa.RecordBatch.from_arrays([text if c == "text" else batch.column(c) for c in names], names=names)
    return run


def mask_secrets(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` with ``[SECRET]`` in the place of every secret of their text."""
    plain, back = set_aside(docs, "doc_id", "source", "text")
    names = plain.columns
    spans = scan(plain, **parameters).where("is_secret").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    spans = stage(spans.withColumnRenamed("doc_id", "id"), "secrets")
    rows = plain.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("text_key")), "left").select(*names, "spans")
    return rows.mapInArrow(_masked(names), plain.schema).select(*back)
