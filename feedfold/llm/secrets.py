"""Secrets in source, configuration and prose, found by patterns and by reading assignments.

Three fixed patterns give the base spans. Beyond them, the text is read the
way a lexer reads source and configuration: every *name, sign, value*, perhaps with a
type between a colon and the sign, gives a pair of a name and a literal or another name. Unquoted
values are read again for pairs inside them. An unquoted value is another name if it has no digits or
is assigned in the document. In ``a: b = value`` both ``a`` and ``b`` are given the
value, as ``b`` may be a type or a name. Names that stand for literals are followed (constants
are propagated, through chains, within the document), and a literal is scored by
the names it reaches: the words of the name (split at case, digits and
punctuation) against sensitive words, the literal's length, its characters and its
entropy. Literals that score at least ``THRESHOLD`` become spans of kind
``lexed`` unless a base span covers them.

Defined cases: a null or empty text has no spans. Repeated rows give repeated
results. Spans are in code points, ends exclusive, ordered by start, then
kind. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import outcome

#: The base patterns and how long a match (of assign: its value) must be.
BASE = {
    "assign": (
        re.compile(
            r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII | re.IGNORECASE,
        ),
        2,
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
KINDS = list(BASE)
#: Without one of these in a text (small letters), ``assign`` cannot match.
ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: Words of a name and what each adds to the score of its literal.
NAME_WORDS = {
    "password": 4, "passwd": 4, "passphrase": 4, "pwd": 4, "secret": 4, "token": 3, "credential": 3,
    "credentials": 3, "apikey": 4, "api": 1, "key": 2, "private": 2, "access": 2, "auth": 2, "signing": 2,
    "encryption": 2, "bearer": 3, "salt": 2, "pin": 1, "client": 1, "connection": 1, "cert": 1,
}
#: Words that say a value is public or a stand-in.
HARMLESS = {"public": -3, "example": -3, "path": -3, "file": -3, "url": -2, "name": -3, "id": -1, "type": -3, "length": -4, "count": -4}
STAND_INS = re.compile(r"(?i)^(?:x+|\*+|<.*>|\$\{.*\}|\{\{.*\}\}|your[-_ ].*|changeme|example|none|null|true|false|todo|password|secret)$")
THRESHOLD = 6.0
MIN_LITERAL = 8

SIGN = re.compile(r"(?::=|=>|[:=])(?!=)[ \t]*")
VALUE = re.compile(
    r"""(?:"(?P<double>[^"\n]*)"|'(?P<single>[^'\n]*)'|`(?P<tick>[^`\n]*)`|(?P<bare>[^\s"'`,;(){}\[\]]+))"""
)
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
#: Arguments of a type, in angle brackets up to four deep. What a part has read it never gives back,
#: and none reads past the next bracket, so that reading a line takes time in proportion to it.
ANGLES = r"<[^<>\n=;\"]*+>"
for _ in range(3):
    ANGLES = rf"<[^<>\n=;\"]*+(?:{ANGLES}[^<>\n=;\"]*+)*+>"
TYPE = (
    r"(?:(?:[&*]|'[a-z_]+[ ])*+(?:(?:mut|dyn|const|final|readonly)[ ])?[A-Za-z_][\w.]*+(?:::\w++)*+|\[[^\n=\[\]]*+\])"
    rf"(?:{ANGLES}|\[[^\n=;\"\[\]]*+\])*+[?!*]*+"
)
#: A type between a colon and the sign of a declaration.
ANNOTATED = re.compile(rf"(?P<type>{TYPE}(?:[ \t]*\|[ \t]*{TYPE})*+)[ \t]*=(?![=>])", re.ASCII)
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    small = text.lower() if ("=" in text or ":" in text) else ""
    spans = []
    for kind, (pattern, group, least) in BASE.items():
        if kind == "assign" and not any(w in small for w in ASSIGN_WORDS):
            continue
        if kind == "access" and "AKIA" not in text:
            continue
        spans += [(*m.span(), kind) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def name_score(name: str) -> float:
    words = [w.lower() for w in NAME_PART.findall(name)]
    pairs = {a + b for a, b in zip(words, words[1:], strict=False)}
    return sum(NAME_WORDS.get(w, 0) + HARMLESS.get(w, 0) for w in [*words, *(pairs & NAME_WORDS.keys())])


#: A longer literal is no stand-in.
STAND_IN_CHARS = 200


def literal_score(literal: str) -> float:
    if len(literal) < MIN_LITERAL or " " in literal:
        return -math.inf
    return score_of_counts(Counter(literal), literal[:STAND_IN_CHARS + 1])


def score_of_counts(counts: Counter, start: str) -> float:
    """The score of a literal with these characters that begins (or is, if short) like this."""
    if len(start) <= STAND_IN_CHARS and STAND_INS.match(start):
        return -math.inf
    n = counts.total()
    kinds = sum(any(f(c) for c in counts) for f in (str.islower, str.isupper, str.isdigit))
    kinds += any(not c.isalnum() for c in counts)
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    return min(n, 32) / 16 + (kinds - 1) + max(0.0, bits - 2.5)


def literal_scores(text: str, places: list[tuple[int, int]]) -> dict[int, float]:
    """Scores of literals by their start; those that end together count their characters once, from the last on."""
    by_end: dict[int, list[int]] = {}
    for start, end in places:
        by_end.setdefault(end, []).append(start)
    out: dict[int, float] = {}
    for end, starts in by_end.items():
        if len(starts) == 1:
            out[starts[0]] = literal_score(text[starts[0] : end])
            continue
        counts, at = Counter(), end
        for start in sorted(set(starts), reverse=True):
            counts.update(text[start:at])
            at = start
            short = end - start < MIN_LITERAL or " " in counts
            out[start] = -math.inf if short else score_of_counts(counts, text[start : min(end, start + STAND_IN_CHARS + 1)])
    return out


def name_before(text: str, sign: int, floor: int) -> str:
    """The name that ends before a sign, perhaps in quotes or brackets or marked optional; empty if there is none."""
    end = sign
    while end > floor and text[end - 1] in " \t":
        end -= 1
    for marks in ("?!", "]", "\"'"):
        if end > floor and text[end - 1] in marks:
            end -= 1
    start = end
    while start > floor and text[start - 1] in NAME_CHARS:
        start -= 1
    return text[start:end].lstrip("0123456789.-")


def lexed_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that a sensitive name is given, directly or through other names."""
    if "=" not in text and ":" not in text:
        return []
    pairs: list[tuple[str, str, str, int, int]] = []  # name, name it is the type of, word of a bare value, place of the value
    by_colon: dict[str, set[str]] = {}  # from a name to the names that take its value
    by_equals: dict[str, set[str]] = {}
    bare: list[tuple[str, str, str]] = []
    declared, declares, at, floor, run = "", -1, 0, 0, 0
    while m := SIGN.search(text, at):
        at = m.end()
        name = name_before(text, m.start(), floor)
        outer = declared if m.start() == declares else ""
        colon = m[0].rstrip() == ":"
        typed = ANNOTATED.match(text, at) if colon and name else None
        if typed:
            declared, declares = name, text.index("=", typed.end("type"))
        if at < run:  # inside a bare value, which ends where the outer one ends
            plain, start, end = True, at, run
        elif value := VALUE.match(text, at):
            plain = value.lastgroup == "bare"
            start, end = value.span(value.lastgroup)
            if plain:
                run = end
            else:
                at = floor = value.end()
        else:
            continue
        if not (name or outer) or (typed and start <= typed.start() and end <= declares):
            continue
        word = text[start:end] if plain and IDENTIFIER.match(text, start, end) else ""
        pairs.append((name, outer, word, start, end))
        if word:
            bare.append((":" if colon else "=", outer or name, word))
    assigned = {n for name, outer, *_ in pairs for n in (name, outer)}
    another = {w for w in {b[2] for b in bare} if w in assigned or not any(c.isdigit() for c in w)}
    for sign, name, word in bare:
        if word in another:
            (by_colon if sign == ":" else by_equals).setdefault(word, set()).add(name)
    reached = highest_reached(by_colon, by_equals)
    literals = literal_scores(text, [(start, end) for *_, word, start, end in pairs if word not in another])
    best_of: dict[tuple[str, str], float] = {}
    found: list[tuple[int, int, str]] = []
    for name, outer, word, start, end in pairs:
        if word in another or (found and found[-1][0] <= start and end <= found[-1][1]):
            continue
        # before a sign and after a colon may stand a type: what is declared to be of it does not take this value
        best = best_of.get((name, outer))
        if best is None:
            first = outer or name
            more = by_equals.get(name, set()) if outer and name else set()
            best = max(map(name_score, {n for n in (name, outer) if n}))
            best = max([best, reached.get(first, best), *(reached.get(n, name_score(n)) for n in more)])
            best_of[name, outer] = best
        if best > 0 and best + literals[start] >= THRESHOLD:
            found.append((start, end, "lexed"))
    return found


def highest_reached(*edges: dict[str, set[str]]) -> dict[str, float]:
    """Per name the highest score among it and the names that take its value, through chains.

    Names are taken from the highest score down, and each hands its score to those that lead
    to it and have none yet, so every step is made once.
    """
    before: dict[str, list[str]] = {}
    names = set()
    for side in edges:
        for name, others in side.items():
            names |= {name, *others}
            for other in others:
                before.setdefault(other, []).append(name)
    out: dict[str, float] = {}
    for name, score in sorted(((n, name_score(n)) for n in names), key=lambda s: -s[1]):
        waiting = [name]
        while waiting:
            now = waiting.pop()
            if now not in out:
                out[now] = score
                waiting += before.get(now, ())
    return out


def all_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and these with what the lexer adds."""
    base = base_spans(text)
    starts, reach = [b[0] for b in base], list(accumulate((b[1] for b in base), max))
    # a base span covers another if it begins no later and one of those that do reaches as far
    more = [s for s in lexed_spans(text) if not (at := bisect_right(starts, s[0])) or reach[at - 1] < s[1]]
    order = [*KINDS, "lexed"]
    return base, sorted(base + more, key=lambda s: (s[0], order.index(s[2]), s[1]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, base spans and all spans, as text, and counts of the base kinds."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)

    @F.pandas_udf(f"{counts}, base_sha256 string, spans string")
    def found(texts: pd.Series) -> pd.DataFrame:
        both = [all_spans(t) for t in texts]
        rows = {f"n_{k}": [sum(s[2] == k for s in base) for base, _ in both] for k in KINDS}
        base = [hashlib.sha256(outcome(b).encode()).hexdigest() for b, _ in both]
        return pd.DataFrame({**rows, "base_sha256": base, "spans": [outcome(every) for _, every in both]})

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), found(text).alias("found")).select("doc_id", "found.*")


MASK = "[SECRET]"


def masked(text: str | None) -> str | None:
    """The text with every span, overlaps joined, replaced by a mark."""
    spans = all_spans(text)[1] if text else []
    if not spans:
        return text
    out, at, end = [], 0, 0
    for start, stop, _ in spans:
        if start >= end:
            out += [text[at if at > end else end : start], MASK]
        end = max(end, stop)
        at = end
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, with secrets masked in the text; null texts stay null."""

    @F.pandas_udf("string")
    def hide(texts: pd.Series) -> pd.Series:
        return texts.map(masked, na_action="ignore")

    return docs.withColumn(text_col, hide(F.col(text_col)))
