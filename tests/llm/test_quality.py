"""Weak supervision: counts against brute force, the verdict against labels."""

import random
import re

from feedfold.llm import quality

LABELLED = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_counts(spark):
    rng = random.Random(4)
    parts = ["a", "b", "the", "wörd🙂", "#", "<x>", " ", "\n", "\t", "\x0b", "  \n", "line one two\n", "\xa0", "\x85"]
    docs = [(i, " ".join(rng.choice(parts) for _ in range(rng.choice([0, 5, 60, 150])))) for i in range(150)]
    docs += [(None, None), (200, ""), (201, " \n "), (3, docs[3][1])]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, words string, row int")
    rows = quality.judge(frame).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = [(r["doc_id"], *[r[n] for n in names]) for r in rows]
    assert sorted(got, key=str) == sorted([(i, *brute(t)) for i, t in docs], key=str)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert quality.judge(frame.limit(0)).count() == 0
    kept = quality.keep_good(frame)
    assert kept.columns == frame.columns and kept.count() == sum(r["kept"] for r in rows)


def test_clean_documents_are_kept(spark):
    docs, labels = (spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"]]
    assert good and sum(good) >= 0.95 * len(good)
