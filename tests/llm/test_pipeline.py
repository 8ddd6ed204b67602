"""The pipeline on documents whose fate is known."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from feedfold.session import scratch_path


def prose(seed, n=30):
    rng = random.Random(seed)
    small = ["the", "of", "and", "to", "in", "is", "that", "it"]
    words = ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randrange(4, 9))) for _ in range(200)]
    return "\n".join(" ".join(rng.choice(small if i % 3 == 0 else words) for i in range(12)) + "." for _ in range(n))


def test_stages(spark):
    shared = prose("shared", 8)
    docs = {i: prose(i) for i in range(60)}
    docs[60] = docs[10].replace(" ", "  ")  # other lines, the same words
    docs[61] = docs[11]
    docs[62] = prose(62) + "\n" + shared
    docs[63] = prose(63) + "\n" + shared
    docs[64] = prose(64) + '\npassword = "hunter2hunter2"\n'
    docs[65], docs[66], docs[67] = None, "", "too short"
    folder = scratch_path(spark, "pipeline_input")
    frame = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{folder}/documents.parquet")
    held = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, folder)
        assert held.columns == frame.columns, name
    left = {r["doc_id"]: r["text"] for r in held.collect()}
    assert left.keys() == set(range(60)) | {62, 63, 64}
    assert shared in left[62] and shared not in left[63] and left[63] == prose(63)
    assert "hunter2" not in left[64] and prose(64) in left[64]
    assert all(left[i] == docs[i] for i in range(60))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, folder).orderBy("doc_id", "start").collect()
    whole = {}
    for r in pieces:
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + bytes(r["ids"])
    assert whole.keys() == left.keys()
    for i, text in left.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert zlib.crc32(whole[i]) == zlib.crc32(ids)
