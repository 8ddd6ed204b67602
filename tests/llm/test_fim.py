"""Fill-in-middle: forms against slices, and the way back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedfold.llm import fim

TEXTS = st.text(st.sampled_from("ab<>PSM \né漢\U0001f600\0"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 40), st.integers(0, 40), st.sampled_from([fim.PSM, fim.SPM]))
def test_forms_and_back(text, a, b, form):
    if any(mark.decode() in text for mark in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
        return
    first, last = sorted((min(a, len(text)), min(b, len(text))))
    parts = "<P>" + text[:first], "<M>" + text[first:last], "<S>" + text[last:]
    want = parts[0] + parts[2] + parts[1] if form == fim.PSM else parts[2] + parts[0] + parts[1]
    assert fim.rearrange(text, first, last, form) == want
    assert fim.restore(want, form) == text


def plainly(doc_id, text):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    text = text or ""
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    return (n, "spm", a, b - a, s + p + m) if h[3] % 100 < 20 else (n, "psm", a, b - a, p + s + m)


def test_rows(spark):
    rows = [(i, f"text {i} é漢" * (i % 7 + 1)) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "a <P> b"), (None, "no id"), (5, rows[5][1]), (303, "x"), (304, "long ü" * 100_000)]
    docs = spark.createDataFrame([(*r, "other", 1) for r in rows], "doc_id long, text string, output string, n int")
    found = fim.transform(docs)
    found = found.withColumn("back", fim.restored(found["output"], found["form"])).collect()
    assert len(found) == len(rows)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found)
    want = sorted((((i is None, i or 0), *plainly(i, t)) for i, t in rows), key=lambda r: (r[0], r[1]))
    assert [g[:3] for g in got] == [w[:3] for w in want] and sorted(map(repr, got)) == sorted(map(repr, want))
    assert sorted(r["back"] for r in found) == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("form", [fim.PSM, fim.SPM])
def test_empty_segments(form):
    for first, last in ((0, 0), (0, 3), (3, 3)):
        assert fim.restore(fim.rearrange("abc", first, last, form), form) == "abc"
