"""Line dedup against a definition that looks at every run."""

import random

import pytest
from pyspark.sql import functions as F

from feedfold.llm import lines


def brute(docs, min_words):
    """Lines of every repeated run of enough words go, if an earlier place has the run."""
    rows = sorted({(i, t) for i, t in docs if t is not None}, key=lambda r: (r[0] is not None, r[0]))
    seqs = [[(n, x) for n, x in enumerate(t.split("\n")) if x.split()] for _, t in rows]
    earlier, gone = set(), {}
    for (i, t), seq in zip(rows, seqs, strict=True):
        for s in range(len(seq)):
            for e in range(s + 1, len(seq) + 1):
                run = tuple(x for _, x in seq[s:e])
                if sum(len(x.split()) for x in run) >= min_words and run in earlier:
                    gone.setdefault((i, t), set()).update(n for n, _ in seq[s:e])
            # a run that starts here is earlier for later starts, also within the document
            for e in range(s + 1, len(seq) + 1):
                earlier.add(tuple(x for _, x in seq[s:e]))
    out = []
    for i, t in docs:
        g = gone.get((i, t), set())
        out.append((i, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g), len(g)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_against_every_run(spark, seed):
    rng = random.Random(seed)
    kinds = ["a b", "c", "d e f", "", "  ", "g h i j k", "c"]
    docs = [(i, "\n".join(rng.choice(kinds) for _ in range(rng.randrange(9)))) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = lines.dedup(frame, min_words=5).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, 5))


def test_cases(spark):
    long = "\n".join(f"w{i} x{i} y{i}" for i in range(40))
    docs = [(1, None), (2, ""), (3, long), (4, "one\n" + long + "\ntwo"), (None, "n"), (3, long), (5, "one\ntwo")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame = frame.withColumns({"row": F.lit(1), "d": F.lit(2), "n_deleted": F.lit(3), "gone": F.lit(4)})
    got = lines.dedup(frame, min_words=50)
    assert got.columns == [*frame.columns, "n_deleted_"]
    rows = {(r["doc_id"], r["text"]): r["n_deleted_"] for r in got.collect()}
    assert got.count() == 7 and rows[4, "one\ntwo"] == 40
    assert rows[3, long] == 0 and rows[1, None] == 0 and rows[2, ""] == 0 and rows[None, "n"] == 0
    assert lines.dedup(frame.limit(0)).count() == 0
