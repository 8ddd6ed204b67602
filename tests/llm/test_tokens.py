"""Ids by pieces against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedfold.llm import tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [*"ab Z\n\n  \t\r\0\x1c'sté×÷ÿŒ字🙂̸́;\u0085  ᠎  　“﻿ªº9१", *".,;:!?*$%&#=<>|", "<|endoftext|>", "don't", " the", "Œuvre", "\n\n", "x" * 30]


def told(path, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("direct", [True, False])
def test_odd_texts_in_one_run(path, direct):
    rng = random.Random(9)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(12))) for _ in range(4000)]
    encoder = tokens.LibraryEncoder(path)
    assert encoder.table.direct
    encoder.table.direct = direct
    assert encoder.ids(texts) == told(path, texts)
    assert encoder.ids(texts[::-1]) == told(path, texts[::-1])
    assert encoder.ids([]) == [] and encoder.ids(["", "a", ""]) == told(path, ["", "a", ""])


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_word_is_worked_out_once_whatever_stands_around_it(path):
    """Marks and line breaks beside words made each pair a stretch of its own, and most new ones were such."""
    words = ["".join("abcdefghij"[int(d)] for d in str(n)) for n in range(300)]
    around = [",", ".", "!", "?", ";", "...", "?!", ".\n", "\n", ",\n", ""]
    texts = [" ".join(w + a for w in words for a in around[n:] + around[:n]).replace("\n ", "\n") for n in range(len(around))]
    encoder, asked = tokens.LibraryEncoder(path), []
    found = encoder.table.found
    encoder.table.found = lambda piece: asked.append(piece) or found(piece)
    assert encoder.ids(texts) == told(path, texts)
    assert len(asked) <= 2 * len(words) + len(around)


def test_generations_and_full_slots(monkeypatch):
    """Pieces that come back move to the young table; many keys share few slots."""
    monkeypatch.setattr(tokens, "KEPT_SIZE", 40)
    monkeypatch.setattr(tokens, "RUN_PIECES", 20)
    monkeypatch.setattr(tokens, "SLOTS", 64)
    monkeypatch.setattr(tokens, "LONGER_SIZE", 3)
    rng = random.Random(4)
    words = [f"w{'abcdefghij'[n % 10] * (1 + n % 40)}{n}" for n in range(150)]
    texts = [" ".join(rng.choice(words[n : n + 40]) for _ in range(60)) for n in range(0, 110, 5)]
    encoder = tokens.LibraryEncoder(BYTE)
    for _ in range(2):
        assert encoder.ids(texts) == told(BYTE, texts)
    assert len(encoder.table.old) and len(encoder.table.young) <= 60
