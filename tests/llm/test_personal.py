import hashlib
import random
import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kandela.llm import personal as P
from kandela.llm.queries import QUERIES
from llm_cases import SF_SMALL, empty, few_partitions, odd  # noqa: F401

BASE = {  # as the contract writes them
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def joined(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def compare(got, texts):
    """Counts and digests of base spans by regular expressions; base spans stay among all spans."""
    want = {}
    for i, text in texts:
        spans = base(text)
        want.setdefault(i, []).append((*(sum(s[3] == k for s in spans) for k in P.KINDS), hashlib.sha256(joined(spans).encode()).hexdigest()))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
    assert {i: sorted(v) for i, v in have.items()} == {i: sorted(v) for i, v in want.items()}
    for r in got:
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert len(set(spans)) == len(spans)
        assert spans == sorted(spans, key=lambda s: (int(s[1]), P.KINDS.index(s[0]), int(s[2])))
        texts_ = [t for i, t in texts if i == r.doc_id]
        assert any(set(joined(base(t)).split(",")) - {""} <= {":".join(s) for s in spans} for t in texts_)


def made(n=400):
    r = random.Random(8)
    pieces = ["a.b@c.de", "x@y", "ünï.7@mail.example.com", "a@b.c%d@e.f", "a@b.c.d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "300.1.1.1", "0255.1.000.1", "99999999999999999999.1.1.1",
              "4929348385146306", "4929-3483-8514-6306", "4929 3483 8514 6306 4929", "4929348385146307", "+1 (017) 555-7713", "+49 30.123-45 ", "+1 2", "+", "word", "Ünder", "and", "10-12-2020",
              "+1 (017) 555-7713 2390409500648960", "4929348385146306 4539578763621486", "\U0001F600", "\n", "call", "..", "-", "@", "12", "token=1a2b"]
    return [(i, "".join(r.choice(pieces) + r.choice([" ", " ", "", ", "]) for _ in range(r.randrange(1, 14)))) for i in range(n)]


def test_base_spans_against_regular_expressions(spark):
    texts = made() + [(None, "me@you.org"), (None, None), (7, "again 4929348385146306"), (7, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = P.span_digests(df).collect()
    assert len(got) == len(texts)
    compare(got, texts)


def test_corpus(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = QUERIES["op13_boosted_pii"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    compare(got, texts)
    clean = {i for i, t in texts if not re.search(r"[0-9@]", t or "")}
    assert len(clean) > 20 and all(r.spans == "" for r in got if r.doc_id in clean)


@pytest.fixture()
def cases():
    """Texts with findings to learn from, and cases that the base patterns lose or that are none."""
    r = random.Random(3)
    card = lambda ok: next(c for c in iter(lambda: "4" + "".join(r.choices("0123456789", k=15)), "") if luhn(c) == ok)
    rows = []
    for i in range(300):
        rows.append((i, f"words then {card(True)} words and a{i}@mail{i % 7}.example.com or +1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)} from {r.randrange(256)}.{r.randrange(256)}.1.9 here"))
        rows.append((1000 + i, f"order number {card(False)} of 12/11/2020 at {r.randrange(300, 999)}.{r.randrange(256)}.7.8, pages 12-{i}"))
    hidden = {2000 + i: (f"pay {card(True)} {card(True)} now", "card") for i in range(20)}
    hidden |= {2100 + i: (f"call +1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)} {card(False)} today", "phone") for i in range(20)}
    return rows, hidden


def test_trees_add_what_base_patterns_lose(spark, cases):
    rows, hidden = cases
    texts = rows + [(i, t) for i, (t, _) in hidden.items()]
    got = {r.doc_id: r for r in P.span_digests(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    compare(list(got.values()), texts)
    found = [any(s.startswith(kind) for s in got[i].spans.split(",")) for i, (_, kind) in hidden.items()]
    assert sum(found) >= 0.9 * len(found) and all(joined(base(t)).count(kind) == 0 for t, kind in hidden.values())
    wrong = [i for i, _ in rows if i >= 1000 and got[i].spans]
    assert len(wrong) <= 0.02 * 300


def test_scores_of_findings_that_were_not_learnt(spark, cases):
    rows, _ = cases
    found = P.candidates(spark.createDataFrame(rows, "doc_id long, text string"))[1]
    spans = P.stage(P.spans_of(found), "test")
    judged = P.scored(spans, max_train=100).where("label is not null").select("label", "score").collect()  # most are left out of the sample
    right = sum((r.score >= 0.5) == (r.label == 1) for r in judged)
    assert len(judged) > 1500 and right >= 0.98 * len(judged)


def spans_like(rows, value, left, label):
    """Candidates for a phone number, one in each of the ``rows`` (a column ``row``), all written alike."""
    return rows.selectExpr("row", "3 kind", "0L start", "12L end", f"{label} is not null and {label} = 1 base", "true passes", f"'{value}' value", f"'{left}' left", "' today' right", f"cast({label} as double) label")


def test_all_candidates_are_learnt(spark):
    # findings beyond the first 4,000 by hash are written like those of the other label, behind the word "phone"
    place = W.orderBy(F.xxhash64("row", F.lit(3), F.lit(0).cast("long"), F.lit(P.SEED)))
    rows = spark.range(5_000).withColumnRenamed("id", "row").withColumn("place", F.row_number().over(place))
    other = lambda start, n: spark.range(start, start + n).withColumnRenamed("id", "row")
    spans = [spans_like(rows.where("place <= 4000"), "+1 (212) 555-7713", "at ", 1), spans_like(rows.where("place > 4000"), "555-123-4567", "phone ", 1),
             spans_like(other(10_000, 5_000), "555-123-4567", "order ", 0), spans_like(other(20_000, 50), "555-123-4567", "phone ", "null"), spans_like(other(30_000, 50), "555-123-4567", "order ", "null")]
    got = P.scored(P.stage(reduce(DataFrame.unionByName, spans), "test")).where("label is null").collect()
    assert len(got) == 100 and all(r.accepted == (r.row < 30_000) and (r.score >= 0.5) == r.accepted for r in got)


def test_thresholds_come_from_all_rows(spark):
    # no row of the fold that hashes to 0 has a label; 7 of 10 written alike are findings
    rows = spark.range(20_000).withColumnRenamed("id", "row").where(F.pmod(F.xxhash64("row", F.lit(P.SEED)), F.lit(4)) != 0)
    unsure = lambda label, cut: spans_like(rows.where(f"row < 4000 and {cut}"), "555-123-4567", "phone ", label)
    spans = [unsure(1, "row % 10 < 7"), unsure(0, "row % 10 >= 7"), spans_like(rows.where("row between 4000 and 6000"), "+1 (212) 555-7713", "at ", 1),
             spans_like(spark.range(30_000, 30_050).withColumnRenamed("id", "row"), "555-123-4567", "phone ", "null")]
    spans = P.stage(reduce(DataFrame.unionByName, spans), "test")
    taken = {p: {r.accepted for r in P.scored(spans, precision=p).where("label is null").collect()} for p in (0.6, 0.995)}
    assert taken == {0.6: {True}, 0.995: {False}}


def test_redact(spark, cases):
    rows, hidden = cases
    extra = [(i, t, "x", 1) for i, t in rows] + [(9000, None, None, 2), (9001, "write to a.b@c.de, ok", None, 3)]
    out = {r[0]: r[1] for r in P.redact(spark.createDataFrame(extra, "doc_id long, text string, kind string, row long")).collect()}
    assert len(out) == len(extra) and out[9000] is None and out[9001] == "write to [EMAIL], ok"
    assert re.fullmatch(r"words then \[CARD\] words and \[EMAIL\] or \[PHONE\] from \[IP\] here", out[5])


def test_odd_rows(spark, odd, empty):
    texts = [(r[0], r[1]) for r in odd.collect()]
    got = P.span_digests(odd).collect()
    assert len(got) == len(texts)
    compare(got, texts)
    assert P.span_digests(empty).collect() == []
    assert P.redact(odd).columns == odd.columns and P.redact(odd).count() == odd.count()
    long = [(1, "1" * 300_000 + " " + "a." * 50_000 + "@" + "b." * 50_000 + "c"), (2, "x" * 400_000 + "+" + "1 " * 50_000)]
    got = P.span_digests(spark.createDataFrame(long, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_email for r in got} == {1: 1, 2: 0}
