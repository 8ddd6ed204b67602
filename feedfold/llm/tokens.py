"""Token ids of whole texts, with the work done once for each distinct stretch of text.

A text is cut before single spaces that stand between two other characters.
No token of the supported vocabularies crosses such a cut, so a stretch (a
space and what follows it) is encoded once and its ids are looked up from then
on. The memory of a worker's table has a bound: two generations of about
``TABLE_SIZE`` stretches, and stretches over ``LONG`` characters are not kept.

Ids by the tokenizers library are had for shorter pieces: where the steps before a
vocabulary's model are known, texts are also cut before and after line breaks and before
marks that follow a letter. Pieces of a run of texts are found, and their ids are looked up, in
bulk with numpy; the library works out the ids of those that no table has.
"""

from __future__ import annotations

import json
import os
import re
import struct
from codecs import charmap_decode
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

from feedfold.llm.common import bounded_runs

TABLE_SIZE = 600_000
#: The same for pieces with ids by the library: an executor has up to two workers a core.
KEPT_SIZE = 300_000
LONG = 120

#: A space beside other white space: such texts are cut with more care.
ODD_SPACE = re.compile(r" \s|\s ")
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")


def beside_space(text: str) -> bool:
    """Whether a space stands beside other white space; line breaks alone need no search by pattern."""
    if text.isascii() and not any(c in text for c in "\t\v\f\r\x1c\x1d\x1e\x1f"):
        return " \n" in text or "\n " in text or "  " in text
    return ODD_SPACE.search(text) is not None


def stretches(text: str) -> list:
    """Keys of a text's stretches: the first as a 1-tuple, later ones without their leading space."""
    parts = text.split(" ")
    if "" in parts or beside_space(text):
        parts = SAFE_CUT.split(text)
        return [(parts[0],), *[p[1:] for p in parts[1:]]]
    parts[0] = (parts[0],)
    return parts


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers; ``encode`` does so for a list of stretches."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode = encode
        self.young: dict = {}
        self.old: dict = {}

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        keys = [stretches(t) for t in texts]
        wanted = set(chain.from_iterable(keys))
        if len(self.young) > TABLE_SIZE:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        wanted = {k for k in wanted if k not in young}
        known = {k for k in wanted if k in old}
        young.update(zip(known, map(old.__getitem__, known), strict=True))
        new = list(wanted - known)
        found = self.encode([k[0] if isinstance(k, tuple) else " " + k for k in new])
        young.update(zip(new, found, strict=True))
        out = [b"".join(map(young.__getitem__, k)) for k in keys]
        for key in new:
            if len(key if isinstance(key, str) else key[0]) > LONG:
                del young[key]
        return out


LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
MARKS = ".,;:!?*$%&#"
#: A piece that is a word, a run of marks or a line break.
plain_form = re.compile(f" ?[{LETTERS}]+|[{MARKS}]+|\n").fullmatch
#: What an added token must hold, and must not: it is cut out before anything else, and may not meet a cut or be a word.
OTHER = re.compile(f"[^\\s{MARKS}{LETTERS}]").search
CUT_AT = re.compile(f"[\\s{MARKS}]").search
#: Writers of so many ids.
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(33)]
#: Steps before the model that cut a text into words (with their space, or without and in small letters), marks and white space.
LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
KEEPS_SPACE = (None, {**LEVEL, "use_regex": True})
SMALL_LETTERS = (
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {**LEVEL, "use_regex": False},
        ],
    },
)
#: How byte-level vocabularies spell each byte.
_ITSELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = dict(zip([b for b in range(256) if b not in _ITSELF], range(256, 512), strict=False))
SPELLING = "".join(chr(_OTHERS.get(b, b)) for b in range(256))

#: What a byte is: surely no white space, space, line break, letter, mark, lead byte of white space beyond ASCII or of a letter.
SOLID, BLANK, LINE, LETTER, MARK, LEAD, LATIN = (1 << n for n in range(7))
CLASSES = np.full(256, SOLID, np.uint8)
CLASSES[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = 0
CLASSES[0x20], CLASSES[0x0A] = BLANK, LINE
CLASSES[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] |= LETTER
CLASSES[list(MARKS.encode())] |= MARK
CLASSES[[0xC2, 0xE1, 0xE2, 0xE3]] |= LEAD
CLASSES[0xC3] |= LATIN
#: White space beyond ASCII, as three bytes in one number (two and a zero, if it has two).
WIDE = [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), *range(0x2028, 0x2030), 0x205F, 0x3000]
WIDE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in WIDE])

#: Pieces of at most so many bytes are kept in a ``Kept``, under their bytes and, in the last byte of the key, their number.
KEY_BYTES = 23
_SIZES = np.arange(KEY_BYTES + 1)
KEY_MASKS = [np.array([(1 << 8 * min(max(n - at, 0), 8)) - 1 for n in _SIZES.tolist()], np.uint64) for at in (0, 8, 16)]
KEY_SIZES = _SIZES.astype(np.uint64) << np.uint64(56)
#: Slots of a table are a power of two, over one and a half times its pieces; a place in the list of ids and their number share a word.
SLOTS = 1 << (3 * KEPT_SIZE // 2).bit_length()
MIXERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SIZE_BITS = np.uint64(32)
MISSING = np.uint64(2**64 - 1)
#: Longer pieces that are kept.
LONGER_SIZE = 20_000
#: Characters of texts cut at once, and pieces looked up at once: what is held for them stays in a processor's cache.
RUN_CHARS = 500_000
RUN_PIECES = 1 << 15


def cuts(data: bytes, starts: np.ndarray, ends: np.ndarray, direct: bool) -> np.ndarray:
    """Where pieces begin, and the end; ``data`` holds texts from ``starts`` to ``ends`` and at least two bytes more."""
    n = int(ends[-1])
    codes = np.frombuffer(data, np.uint8)
    kinds = np.take(CLASSES, codes)
    if not data.isascii():
        lead = np.flatnonzero(kinds[:n] & LEAD)
        code = codes[lead].astype(np.int64) << 16 | codes[lead + 1].astype(np.int64) << 8 | codes[lead + 2]
        wide = lead[np.isin(code, WIDE) | np.isin(code & 0xFFFF00, WIDE)]
        for k in range(3):
            kinds[wide + k] &= ~np.uint8(SOLID)
        latin = np.flatnonzero(kinds[:n] & LATIN) + 1
        kinds[latin[(codes[latin] != 0x97) & (codes[latin] != 0xB7)]] |= LETTER
    cut = np.zeros(n + 1, bool)
    here, before = kinds[1:n], kinds[: max(n - 1, 0)]
    solid = (kinds[:n] & SOLID).astype(bool)
    if direct:
        # before white space, before marks behind a letter, and behind a line break that stands alone
        cut[1:n] = (here & (BLANK | LINE)).astype(bool) & solid[:-1]
        cut[1:n] |= ((here & MARK) << 1 & (before & LETTER) << 2).astype(bool)
        cut[2:n] |= (kinds[1 : max(n - 1, 1)] & LINE).astype(bool) & solid[: max(n - 2, 0)] & solid[2:]
    else:
        cut[1 : max(n - 1, 1)] = (here[:-1] & BLANK).astype(bool) & solid[: max(n - 2, 0)] & solid[2:]
        cut[np.maximum(ends - 1, 0)] = False
    cut[starts] = cut[n] = True
    return np.flatnonzero(cut)


def keys_of(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Three words for each piece; ``data`` goes on for three words behind the last start."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    keys = [words[starts + at] & mask[sizes] for at, mask in zip((0, 8, 16), KEY_MASKS, strict=True)]
    keys[2] |= KEY_SIZES[sizes]
    return keys


def slots_of(keys: list[np.ndarray]) -> np.ndarray:
    mixed = keys[0] * MIXERS[0] ^ keys[1] * MIXERS[1] ^ keys[2] * MIXERS[2]
    mixed = (mixed ^ mixed >> np.uint64(29)) * MIXERS[0]
    return (mixed >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)


def spread(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs that follow one another, each from its first on."""
    ends = np.cumsum(sizes)
    return np.repeat(firsts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Kept:
    """Ids of pieces, found by their keys in an open table."""

    def __init__(self):
        self.rows = np.zeros((SLOTS, 4), np.uint64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = self.n = 0

    def __len__(self) -> int:
        return self.n

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """For each key the place and number of its ids, or ``MISSING``."""
        found = np.full(len(keys[0]), MISSING)
        at, slot = np.arange(len(found)), slots_of(keys)
        while len(at):
            rows = np.take(self.rows, slot, axis=0)
            same = (rows[:, 0] == keys[0]) & (rows[:, 1] == keys[1]) & (rows[:, 2] == keys[2])
            found[at[same]] = rows[same, 3]
            on = np.flatnonzero(~same & (rows[:, 2] != 0))
            at, slot, keys = at[on], (slot[on] + 1) & (SLOTS - 1), [k[on] for k in keys]
        return found

    def read(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids at such places, and their numbers; those of missing keys are left for the caller to write."""
        sizes = (found & ((np.uint64(1) << SIZE_BITS) - np.uint64(1))).astype(np.int64)
        return np.take(self.ids, spread((found >> SIZE_BITS).astype(np.int64), sizes), mode="clip"), sizes

    def add(self, keys: list[np.ndarray], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Keep the ids of different keys that are not here yet."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids) // 2, len(ids)), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        places = np.cumsum(sizes) - sizes + self.used
        self.used, self.n = self.used + len(ids), self.n + len(sizes)
        rows = np.stack([*keys, places.astype(np.uint64) << SIZE_BITS | sizes.astype(np.uint64)], axis=1)
        slot = slots_of(keys)
        while len(rows):
            free = self.rows[slot, 2] == 0
            self.rows[slot[free]] = rows[free]
            on = np.flatnonzero((self.rows[slot] != rows).any(axis=1))
            rows, slot = rows[on], (slot[on] + 1) & (SLOTS - 1)


class Pieces:
    """Ids of pieces, worked out by the tokenizers library where no table has them.

    A piece that is a word, a run of marks or a line break goes to the library's model at once, if the vocabulary's steps
    before the model are known to do just that to it. All others take the library's whole way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        told = json.loads(self.tokenizer.to_str())
        steps, added = (told["normalizer"], told["pre_tokenizer"]), told["added_tokens"]
        plain = all(OTHER(t["content"]) and not CUT_AT(t["content"]) for t in added)
        plain &= not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        self.small = steps == SMALL_LETTERS
        self.direct = plain and (self.small or steps == KEEPS_SPACE)
        self.young, self.old = Kept(), Kept()
        #: Pieces that are too long for a table but not over ``LONG`` bytes.
        self.longer: dict[bytes, bytes] = {}

    def __len__(self) -> int:
        return len(self.young) + len(self.longer)

    def found(self, piece: bytes) -> bytes:
        """Ids of one piece by the library."""
        text = piece.decode()
        if not self.direct or plain_form(text) is None:
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.small:
            piece = text.strip().lower().encode()
        return packed([t.id for t in self.tokenize(charmap_decode(piece, "strict", SPELLING)[0])])

    def learn(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        """Keep the ids of pieces that the young table lacks, from the old one if it has them."""
        first = {data[a:b]: n for n, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True))}
        at = np.fromiter(first.values(), np.int64, len(first))
        keys = keys_of(data, starts[at], ends[at] - starts[at])
        places = self.old.find(keys)
        known = places != MISSING
        ids, sizes = self.old.read(places[known])
        self.young.add([k[known] for k in keys], sizes, ids)
        told = [self.found(piece) for piece, old in zip(first, known.tolist(), strict=True) if not old]
        sizes = np.fromiter(map(len, told), np.int64, len(told)) // 4
        self.young.add([k[~known] for k in keys], sizes, np.frombuffer(b"".join(told), "<u4"))

    def long_ids(self, piece: bytes) -> bytes:
        ids = self.longer.get(piece)
        if ids is None:
            ids = self.found(piece)
            if len(piece) <= LONG:
                if len(self.longer) >= LONGER_SIZE:
                    self.longer = {}
                self.longer[piece] = ids
        return ids

    def ids(self, data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces between neighbouring bounds, one after another, and how many each has."""
        if len(self.young) > KEPT_SIZE:
            self.old, self.young = self.young, Kept()
        starts, sizes = bounds[:-1], np.diff(bounds)
        short = np.flatnonzero(sizes <= KEY_BYTES)
        keys = keys_of(data, starts[short], sizes[short])
        places = self.young.find(keys)
        lost = np.flatnonzero(places == MISSING)
        if len(lost):
            self.learn(data, starts[short[lost]], bounds[short[lost] + 1])
            places[lost] = self.young.find([k[lost] for k in keys])
        if len(short) == len(sizes):
            return self.young.read(places)
        at = np.flatnonzero(sizes > KEY_BYTES)
        told = [self.long_ids(data[a:b]) for a, b in zip(starts[at].tolist(), bounds[at + 1].tolist(), strict=True)]
        found = np.zeros(len(sizes), np.uint64)
        found[short], found[at] = places, np.fromiter(map(len, told), np.uint64, len(told)) // np.uint64(4)
        ids, counts = self.young.read(found)
        ids[spread((np.cumsum(counts) - counts)[at], counts[at])] = np.frombuffer(b"".join(told), "<u4")
        return ids, counts


def packed(ids: Sequence[int]) -> bytes:
    n = len(ids)
    return PACKERS[n](*ids) if n < len(PACKERS) else struct.pack(f"<{n}I", *ids)


class LibraryEncoder:
    """Ids of texts by the tokenizers library, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.table = Pieces(path)

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        return [ids for a, b in bounded_runs(texts, RUN_CHARS) for ids in self.run(texts[a:b])]

    def run(self, texts: Sequence[str]) -> list[bytes]:
        coded = [t.encode() for t in texts]
        sizes = np.array([len(c) for c in coded])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        data = b"".join([*coded, bytes(KEY_BYTES + 1)])
        bounds = cuts(data, starts, ends, self.table.direct)
        parts = [self.table.ids(data, bounds[a : a + RUN_PIECES + 1]) for a in range(0, len(bounds) - 1, RUN_PIECES)]
        whole = b"".join([ids.astype("<u4", copy=False).tobytes() for ids, _ in parts])
        upto = 4 * np.cumsum(np.concatenate([np.zeros(1, np.int64), *(counts for _, counts in parts)]))
        firsts, lasts = upto[np.searchsorted(bounds, starts)], upto[np.searchsorted(bounds, ends)]
        return [whole[a:b] for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]


_LOADED: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    """An encoder over the tokenizers library; one per worker and file."""
    if path not in _LOADED:
        _LOADED[path] = LibraryEncoder(path)
    return _LOADED[path]
