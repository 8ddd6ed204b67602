"""HyperMinHash near-dedup against all pairs."""

import random

import numpy as np

from feedfold.llm import neardup


def sets_of(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(k, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(docs, k):
    """Components by comparing every two rows."""
    sets = [sets_of(t, k) for _, t in docs]
    label = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = label[a], label[b]
                label = [x if v == y else v for v in label]
    out = []
    for n, (i, _) in enumerate(docs):
        ids = [docs[m][0] for m in range(len(docs)) if label[m] == label[n] and docs[m][0] is not None]
        out.append((i, len(sets[n]), i if not sets[n] else min(ids, default=None)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.choice([6, 30, 120, 300]))] for _ in range(12)]
    shared = [rng.choice(words) for _ in range(25)]
    docs = []
    for i in range(120):
        text = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append((i, " ".join(text + shared * (rng.random() < 0.2))))
    return [*docs, (200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "ONE  two"), (5, docs[5][1]), (None, docs[7][1]), (None, "q r s t u")]


def test_against_all_pairs(spark):
    for seed in range(2):
        docs = corpus(seed)
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        got = neardup.resolve(frame, k=4).select("d", "n", "component").collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, 4)


def test_bands_of_several_components_are_compared(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    docs = corpus(7)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = neardup.resolve(frame, k=4).select("d", "n", "component").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, 4)


def test_one_of_each_group_stays(spark):
    docs = corpus(3)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, component string")
    kept = neardup.dedup(frame, k=4)
    assert kept.columns == frame.columns
    wanted = {i for i, _, component in brute(docs, 4) if i == component}
    assert sorted(map(str, {r["doc_id"] for r in kept.collect()})) == sorted(map(str, wanted))
    assert kept.count() == kept.dropDuplicates(["doc_id", "text"]).count()
    assert neardup.dedup(frame.limit(0)).count() == 0


def test_estimates():
    rng = np.random.default_rng(1)
    for overlap in (0.5, 0.8, 0.95):
        found = []
        for _ in range(40):
            pool = rng.integers(1, 2**63, 2000).astype(np.uint64)
            n = int(2000 * (1 - overlap) / 2)
            a, b = neardup.registers(pool[n:]), neardup.registers(pool[: 2000 - n])
            found.append(neardup.estimates(a[None], b[None])[0])
        assert abs(np.mean(found) - overlap) < 0.02


def test_one_stays_of_null_and_shared_ids(spark):
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base[:-1], f"end{n}"]) for n in range(6)]
    far = [" ".join(f"{w}x" for w in [*base[:-1], f"end{n}"]) for n in range(6)]
    docs = [(None, t) for t in near] + [(4, t) for t in far] + [(None, near[0]), (4, far[0]), (9, far[1] + " y"), (None, ""), (None, "q r s")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [tuple(r) for r in neardup.dedup(frame, k=4).collect()]
    assert sum(t in near for _, t in kept) == 1
    assert [i for i, t in kept if t in far or t.endswith(" y")] == [4]
    assert sorted(t for _, t in kept if len(t) < 10) == ["", "q r s"] and len(kept) == 4


def test_components_of_large_ids(spark):
    from feedfold.llm.components import components

    start = 2_000 << 33  # ids that Spark gives in partition 2,000
    links = spark.range(start, start + 300_000).selectExpr("id AS v", "id + 1000000 AS u")
    found = components(links.union(links.selectExpr("v", "v + 2000000 AS u")))
    assert found.count() == 600_000
    assert found.where("u - v NOT IN (1000000, 2000000)").count() == 0


def test_rows_of_a_group_that_stays_apart(spark, monkeypatch):
    """Texts alike at less than the limit make no table of their pairs, and links among them are still found."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(360):
        text = list(base)
        for at in rng.sample(range(60), 2):
            text[at] = f"x{i}at{at}"
        docs.append((i, " ".join(text)))
    docs += [(1000 + i, docs[i][1] + " end") for i in range(0, 360, 20)]
    counted = []

    def seen(rows, name):
        held = landed(rows, name)
        counted.append((held.count(), name))
        return held

    landed = neardup.landed
    monkeypatch.setattr(neardup, "landed", seen)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = neardup.resolve(frame, k=4).select("d", "n", "component").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, 4)
    apart = [n for n, name in counted if name not in ("bands", "sketches", "classes")]
    assert max(apart) <= neardup.BANDS * len(docs)


def test_full_sets_are_worked_out_once(spark, tmp_path):
    """A second call of the function in the same task is a second Python worker that stays in memory."""
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "a b c d e"), (3, "not asked for")], "d long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    sets = neardup.shingles([text, "a b c d e"], 4)
    digests = [neardup.digest(sets[0]), "another digest"]
    named = docs.where("d < 3").distinct().selectExpr("d AS c", "d", "xxhash64(text) AS t", f"if(d = 1, '{digests[0]}', '{digests[1]}') AS x")
    rows = neardup.set_rows(named.select("c"), named, docs, 4)
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r["c"], bytes(r["whole"])) for r in rows.collect()] == [(1, sets[0].tobytes())]
