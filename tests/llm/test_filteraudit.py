"""The audit against a document-by-document run of every order."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import filteraudit as A
from quarry.llm import queries
from quarry.llm.oracle import SQL
from tests.conftest import SF_SMALL
from tests.helpers import assert_same

LABELS = "doc_id long, quality int, toxic int"


def _fails(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text))}


def brute_force(docs, labels):
    """docs: (doc_id, text, lang); every order is applied to the documents one filter at a time."""
    lowest = {}
    for i, t, _ in docs:
        if i is not None:
            lowest[t or ""] = min(lowest.get(t or "", i), i)
    rows = []
    for i, t, lang in docs:
        fails = _fails(t)
        fails["E"] = i is not None and i > lowest[t or ""]
        rows.append((lang or "", fails, any(q == 1 for j, q, _ in labels if j == i and i is not None),
                     any(x == 1 for j, _, x in labels if j == i and i is not None)))
    out, total = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                here = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                total[part, f] = total.get((part, f), 0) + len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(r[1][f] for r in gone), sum(r[1][f] and sum(r[1].values()) == 1 for r in own),
                    sum(r[2] for r in here), sum(r[3] for r in here)]
                gone = gone + here
    return {k: tuple(v) + (total[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def _result(df):
    found = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}
    assert len(out) == len(found)
    return out


def _words(n, extra=""):
    return " ".join(f"w{i}" for i in range(n)) + extra


CASES = [
    (1, _words(250), "en"), (2, _words(250), "fr"), (3, _words(250), "en"), (3, _words(250), "en"), (4, "x " * 300, "en"),
    (5, None, "en"), (6, "", "en"), (7, "", None), (8, None, ""), (9, "A" * 50, "en"), (10, _words(199) + " a&b", "fr"),
    (11, _words(200) + "\x0b\x1c é", "fr"), (None, _words(250), "en"), (None, _words(250), "en"), (None, None, "en"),
    (12, "ok " + _words(30_000) + " #", "de"), (13, "É" * 400, "de"), (14, "a b\nc\td" * 80, "xx"), (15, _words(250), "xx"),
]
MARKS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, None, 0), (4, 1, 0), (5, 1, 1), (6, 0, 0), (10, 1, None), (None, 1, 1), (99, 1, 1)]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(MARKS, LABELS)
    want = brute_force(CASES, MARKS)
    assert _result(A.audit(docs, labels)) == want
    # extra columns with clashing names change nothing
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("part", "mask", "digest", "n", "good", "toxic", "key", "low")])
    assert _result(A.audit(clash, labels.withColumn("good", F.lit(5)).withColumn("key", F.lit("k")))) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(MARKS, LABELS)
    assert A.audit(docs.limit(0), labels).collect() == []
    assert _result(A.audit(docs, labels.limit(0))) == brute_force(CASES, [])


@pytest.mark.parametrize("k", [1, 3, 5])
def test_potential_gives_shapley_of_orders(k):
    worth = A.worths({m: (m * 37) % 11 for m in range(1 << k)}, k)
    p = A.potentials(worth, k)
    for i in range(k):
        over_orders = 0
        for order in itertools.permutations(range(k)):
            before = sum(1 << j for j in order[:order.index(i)])
            over_orders += worth[before | 1 << i] - worth[before]
        n = len(list(itertools.permutations(range(k))))
        assert (p[-1] - p[len(p) - 1 ^ 1 << i]) * n == over_orders


def test_query_equals_sql(spark, duck):
    df = queries.q_op11_filter_audit(spark, SF_SMALL)
    assert df.count() % 600 == 0
    assert_same(df, duck, SQL["op11_filter_audit"])
