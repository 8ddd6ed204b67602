"""Personal data against the base patterns as Python reads them."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from feedfold.llm import pii
from feedfold.llm.common import landed


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(values[::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def numbers(text):
    return re.sub("[^0-9]", "", text)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(numbers(m)) <= 19 and luhn(numbers(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(numbers(m)) <= 15),
}


def brute(text):
    found = [
        (m.start(), at, m.end(), kind)
        for at, (kind, (pattern, good)) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if good(m[0])
    ]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


PARTS = [
    "a@b.c", "x.y@d-e.org_z@q.io", "1.2.3.4", "001.2.3.255.9", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "+1 (555) 010-9999", "+49.30.1234567", "tel ", "card: ", "🙂", "é", " at ", " dot ", "me (at) site (dot) org",
    "12 34", "-", "\n", " ", "@", "+", ".", "00:1b:44:11:3a:b7", "5", "word",
]


def corpus():
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(30)))) for i in range(400)]
    long = ["1" * 30_000 + " a@b.c", "a" * 60_000 + "@", "@ at " + "b." * 30_000, "1-" * 20_000, "x@" + "y." * 20_000 + "z"]
    return [*docs, (None, None), (900, ""), (901, None), (5, docs[5][1]), *enumerate(long, 1000)]


def test_base_spans(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, at string, base int")
    rows = pii.report(frame).collect()
    wanted = []
    for i, text in docs:
        spans = brute(text)
        counts = [sum(s.startswith(f"{k}:") for s in spans) for k in BASE]
        wanted.append((i, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    got = [tuple(r)[:6] for r in rows]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    every = {(r["doc_id"], r["base_sha256"]): r["spans"].split(",") for r in rows}
    for i, text in docs:
        spans = brute(text)
        assert set(spans) <= set(every[i, hashlib.sha256(",".join(spans).encode()).hexdigest()])
    assert pii.report(frame.limit(0)).count() == 0


def likely(spark, texts):
    """The spans that the trees add, as text, per document."""
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["every"] for r in pii.scan(frame).collect()}
    return [[t[s.start : s.end] for s in rows[i] if s.kind == "likely"] for i, t in enumerate(texts)]


def test_trees_add_what_patterns_miss_and_leave_plain_numbers(spark):
    texts = {
        "ring tel 0171 9876543 now": ["0171 9876543"],
        "kim.lee (at) uni (dot) edu": ["kim.lee (at) uni (dot) edu"],
        "ask lee at uni dot edu": ["lee at uni dot edu"],
        "call 212-555-0100": ["212-555-0100"],
        "ssn 987-65-4321": ["987-65-4321"],
        "device de:ad:be:ef:00:01": ["de:ad:be:ef:00:01"],
        "isbn 978-1-4028-9462-6": [],
        "order 7654321": [],
        "on 2020-11-30": [],
        "see you at cafe.org": [],
        "is 7663683147833396": [],
        "0.333333333": [],
        "": [],
    }
    assert dict(zip(texts, likely(spark, texts), strict=True)) == texts


def test_precision_and_recall_on_planted_forms(spark):
    """Forms and words as in the seeds, other numbers and names; next to a corpus of base spans and near misses."""
    rng = random.Random(11)

    def some(form):
        return "".join(rng.choice("23456789") if c == "9" else c for c in form)

    good, bad = [], []
    for _ in range(60):
        word = rng.choice(["tel", "phone", "fax", "call", "mobile"])
        good.append(f"so {word} " + some(rng.choice(["0999 9999999", "999-999-9999", "(999) 999-9999", "099/999999"])))
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        good.append(f"{name} " + rng.choice(["(at) mail (dot) org", "[at] firm [dot] net", "at home dot com"]))
        good.append("ssn " + some("999-99-9999"))
        word = rng.choice(["order", "invoice", "total", "item", "page"])
        bad.append(f"{word} " + some(rng.choice(["9999999", "99-9999-99", "999-999-9999", "9 999 999"])))
        bad.append(some("and 9999999 more of 0.99999999"))
        bad.append(f"on 20{rng.randrange(10, 24)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02} it")
    plain = [rng.choice(["a@b.org ", "1.2.3.4 ", "+1 (555) 010-9999 ", "4111 1111 1111 1111 ", some("9999999999999999 "), "700.1.2.3 "]) for _ in range(300)]
    found = likely(spark, good + bad + plain)
    hits = sum(bool(f) for f in found[: len(good)])
    wrong = sum(bool(f) for f in found[len(good) :])
    assert hits >= 0.95 * len(good)
    assert hits >= 0.95 * (hits + wrong)


def test_spans_next_to_many_others(spark):
    rng = random.Random(5)
    base = sorted((a := rng.randrange(5000), a + rng.randrange(1, 40)) for _ in range(700))
    asked = [(a := rng.randrange(5000), a + rng.randrange(1, 20)) for _ in range(300)]
    frame = spark.createDataFrame([(base, asked), ([], asked)], "base array<struct<a int, b int>>, asked array<struct<a int, b int>>")
    rows = landed(frame.select("asked", F.col("base.a").alias("starts"), pii.highest_before(F.col("base.b")).alias("tops")), "tops")
    got = rows.select(F.transform("asked", lambda s: pii.touches(F.col("starts"), F.col("tops"), s["a"], s["b"]))).collect()
    assert got[0][0] == [any(x < b and a < y for x, y in base) for a, b in asked]
    assert not any(got[1][0])
