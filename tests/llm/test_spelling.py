"""Spelling variants against an all-pairs version."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from feedfold.llm import spelling


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=2, max_size=12, unique=True))
def test_scan(words):
    words.sort()
    lcps = [0, *map(spelling.shared, words, words[1:])]
    common = spelling.shared(words[0], words[-1])
    for query in words:
        got = [words[i] for i in spelling.scan(query, words, lcps, common)]
        assert got == [w for w in words if edits(query, w) == 1]


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def all_pairs(rows):
    n = counted(rows)
    form, near = {}, {}
    for w in n:
        close = [v for v in n if abs(len(v) - len(w)) <= 1 and edits(v, w) == 1]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        near[w], form[w] = len(close), best if close and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], near[w], n[form[w]] if form[w] else None))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "other", 1) for r in rows], "doc_id long, text string, word string, n int")


def found(docs):
    rows = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in docs.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(5, 9))) for _ in range(150)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "Ärger", "ärger", "STRASSE", "straße", "x" * 40, "x" * 41, "x" * 20 + "y" + "x" * 20, "long" * 12]
    rows = []
    for i in range(400):
        words = rng.choices(base, [1 / (k + 1) for k in range(len(base))], k=60)
        for k in range(len(words)):
            if rng.random() < 0.05 and len(words[k]) < 50:
                at = rng.randrange(len(words[k]))
                words[k] = words[k][:at] + rng.choice(["", "q", words[k][at] * 2]) + words[k][at + 1 :]
        rows.append((i, rng.choice([" ", "1", "\n- "]).join(words)))
    rows += [(500 + i, "vwxyz " * (i < 4) + "vwxyza " * (i < 9) + "vwxyzab") for i in range(25)]
    return rows + [(400, None), (401, ""), (None, "aaaaa aaaaa bbbbb"), (None, "aaaaa aaaaa bbbbb"), rows[3], (402, "ab cd 12")]


def test_against_all_pairs(spark):
    rows = corpus()
    want = all_pairs(rows)
    assert any(form and root != form for _, form, root, *_ in want)
    assert found(spelling.variants(frame(spark, rows))) == want


def test_very_long_words(spark):
    a, b = "ab" * 20_000, "ab" * 9_000 + "a" + "ab" * 11_000
    rows = [(i, f"{a} {a} {b}") for i in range(3)]
    n = {w: (f, m, k) for w, f, _, m, k, _ in found(spelling.variants(frame(spark, rows), min_count=2))}
    assert n == {a: (None, 6, 1), b: (a, 3, 1)}


def test_counts_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    counts = Counter()
    for doc_id, text in corpus():
        spelling.count_words(doc_id, text or "", counts)
    got = {r["word"]: r["n"] for r in spelling.vocabulary(frame(spark, corpus()), min_count=1).collect()}
    assert got == counts


def test_nothing_to_group(spark):
    assert found(spelling.variants(frame(spark, []))) == set()
    assert found(spelling.variants(frame(spark, [(1, "one two three"), (2, None)]))) == set()
