"""BPE against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedfold.llm import bpe, packing, rans
from feedfold.llm.tokens import LibraryEncoder, library_encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = [*"abc  \n\t'sdé字🙂́\x1c\x85\xa0İΣς.,!<|>0१", "<|endoftext|>", "<|startoftext|>", "  ", " \n", "the ", " THE"]


def texts(n=400):
    rng = random.Random(5)
    return ["", *("".join(rng.choice(LETTERS) for _ in range(rng.randrange(40))) for _ in range(n)), "a" * 3000, " " * 900, "ab" * 700 + " x\n" * 99]


@pytest.mark.parametrize(("make", "path"), [(bpe.bpe_encoder, BYTE), (library_encoder, BYTE), (library_encoder, WORD)])
def test_same_ids(make, path):
    wanted = Tokenizer.from_file(path).encode_batch(texts(), add_special_tokens=False)
    assert make(path).ids(texts()) == [np.array(w.ids, "<u4").tobytes() for w in wanted]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_go_to_the_model_at_once(path, monkeypatch):
    """Words with a mark are not encoded one by one through the library's whole way, and have its ids."""
    rng = random.Random(6)
    letters = "abcdeXYZéÀßÿñØ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", *".,;:!?", "***", "&.", "$$%#"]) for _ in range(3000)]
    some = [" ".join(words[i : i + 30]) for i in range(0, 3000, 30)] + ["one.\nTwo\nthree, four\n", "a\n\nb. c\n d", "don't. x×y ª÷ \u0130x a..", "Word", "é.", "x\u0301 y"]
    library = Tokenizer.from_file(path)
    wanted = [np.array(w.ids, "<u4").tobytes() for w in library.encode_batch(some, add_special_tokens=False)]
    encoder = LibraryEncoder(path)
    whole = []

    class Seen:
        def encode(self, text, **more):
            whole.append(text)
            return library.encode(text, **more)

    encoder.table.tokenizer = Seen()
    assert encoder.ids(some) == wanted
    assert len(whole) <= 10


def test_decoding():
    library = Tokenizer.from_file(BYTE)
    encoder = bpe.bpe_encoder(BYTE)
    for ids in encoder.ids(texts()):
        numbers = np.frombuffer(ids, "<u4").tolist()
        assert encoder.read(ids) == (library.decode(numbers, skip_special_tokens=False), ",".join(map(str, numbers)))


DOCS = [(1, None), (2, ""), (None, "null id"), (3, "a long text " * 3000), (2**60 + 1, "big"), (2, ""), (4, "x")]


def frame_of(spark, docs):
    return spark.createDataFrame([(*d, "t", 1) for d in docs], "doc_id long, text string, ids string, start int")


def test_digests(spark):
    got = bpe.digests(frame_of(spark, DOCS), BYTE).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got)[:2] == [("1", 0), ("1152921504606846977", 1)]
    assert len(got) == 7 and bpe.digests(frame_of(spark, DOCS).limit(0), BYTE).count() == 0


def test_token_store(spark):
    library = Tokenizer.from_file(BYTE)
    rows = sorted(rans.digests(frame_of(spark, DOCS), BYTE).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 2, 3, 4, 2**60 + 1]
    at = 0
    texts_by_id = {i: t for i, t in DOCS}
    for r in rows:
        ids = [*library.encode(texts_by_id[r["doc_id"]] or "", add_special_tokens=False).ids, 0]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == rans.zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert rans.digests(frame_of(spark, DOCS).limit(0), BYTE).count() == 0


def test_coder(monkeypatch):
    monkeypatch.setattr(rans, "SEGMENT", 1000)
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 999, 1000, 5003):
        ids = np.minimum(rng.geometric(0.02, n), 4000).astype(np.uint32)
        table = rans.Table(rans.quantised(np.bincount(ids, minlength=1)))
        segments, payload = rans.encode_block(table, ids)
        parts = [rans.decode_segment(table, s, payload) for s in reversed(segments)]  # each by itself, in any order
        assert np.array_equal(np.concatenate([np.zeros(0, int), *reversed(parts)]), ids)
    assert len(payload) < 5003 * 1.2
    with pytest.raises(ValueError, match="checksum"):
        rans.decode_segment(table, segments[0] | {"crc32": 1}, payload)


def test_frequencies():
    freq = rans.quantised(np.array([0, 1, 10**12, 3, 0]))
    assert freq.sum() == rans.TOTAL and (freq[[1, 3]] > 0).all() and freq[0] == freq[4] == 0


def pieces_of(spark, docs, **more):
    return packing.pack(frame_of(spark, docs), WORD, 2, **more).collect()


def check_pieces(pieces, limits):
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        by_doc.setdefault(p["doc_id"], []).append(p)
    for some in by_sequence.values():
        some.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in some] == rans.starts_of([p["length"] for p in some])
        total = sum(p["length"] for p in some)
        assert total == limits.tokens or total & (total - 1) == 0 and total < limits.tokens
        assert len(some) <= limits.segments
    return by_sequence, by_doc


def test_packing(spark):
    library, rng = Tokenizer.from_file(WORD), random.Random(3)
    docs = [(i, "word " * rng.choice([0, 1, 5, 300, 5000])) for i in range(200)] + [(500, None), (None, "x")]
    limits = packing.Limits(tokens=1024, segments=20)
    _, by_doc = check_pieces(pieces_of(spark, docs, limits=limits), limits)
    for i, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        some = sorted(by_doc[i], key=lambda p: p["start"])
        assert b"".join(p["ids"] for p in some) == np.array(ids, "<u4").tobytes()
        assert [p["start"] for p in some] == rans.starts_of([p["length"] for p in some])
        assert all(p["doc_tokens"] == len(ids) for p in some)
    assert pieces_of(spark, docs[:0] or [(1, "")], limits=limits)[0]["length"] == 1
    assert packing.pack(frame_of(spark, docs).limit(0), WORD, 2).count() == 0


def test_loss_limit_and_whole_items():
    rng = random.Random(4)
    limits = packing.Limits(tokens=100, segments=4, loss=30)
    packer = packing.Packer(limits, cut=False)
    items = [packing.Item(i, bytes(4 * rng.randrange(1, 60)), 0) for i in range(300)]
    for item in items:
        item.loss = min(30, rng.randrange(item.tokens + 1))
    packer.add(list(items))
    sequences = {}
    for item, start, length, sequence, _ in packer.fill(0):
        assert start == 0 and length == item.total
        sequences.setdefault(sequence, []).append(item)
    for some in sequences.values():
        assert sum(i.total for i in some) <= 100 and len(some) <= 4 and sum(i.loss for i in some) <= 30
    assert sorted(i.doc_id for s in sequences.values() for i in s) == list(range(300))
    bound = max(sum(i.total for i in items) / 100, sum(i.loss for i in items) / 30, 300 / 4)
    assert len(sequences) <= 1.25 * bound
    with pytest.raises(ValueError, match="beyond the limits"):
        packer.add([packing.Item(1, bytes(4 * 101), 0)])
