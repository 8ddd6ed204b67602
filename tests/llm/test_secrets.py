"""Secrets: base spans against the patterns, and what reading assignments adds."""

import hashlib
import random
import re

from feedfold.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


PARTS = ["PassWord", "api_key", "APIKEY", "token", "=", ": ", '"', "'", " ", "hunter22", "abc", "AKIA", "Z" * 16, "0a1b" * 6, "f", "é🙂", "\n", "secret"]


def test_base_spans(spark):
    rng = random.Random(9)
    docs = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(20)))) for i in range(500)]
    docs += [(None, None), (600, ""), (601, None), (3, docs[3][1]), (602, "token=" + "a" * 100_000), (603, "=" * 50_000)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, found string")
    wanted = []
    for i, text in docs:
        spans = brute(text or "")
        counts = [sum(s.startswith(f"{k}:") for s in spans) for k in ("assign", "access", "hex")]
        wanted.append((i, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    rows = secrets.scan(frame).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(wanted, key=str)
    for row in rows:
        spans = row["spans"].split(",") if row["spans"] else []
        assert hashlib.sha256(",".join(s for s in spans if not s.startswith("lexed")).encode()).hexdigest() == row["base_sha256"]
    assert secrets.scan(frame.limit(0)).count() == 0


def lexed(text):
    return [text[a:b] for a, b, kind in secrets.all_spans(text)[1] if kind == "lexed"]


def test_constants_are_followed():
    assert lexed('raw = "Zx81-Qp72-Lm93-Tt"\nother = raw\nprivate_key = other\n') == ["Zx81-Qp72-Lm93-Tt"]
    assert lexed('raw = "Zx81-Qp72-Lm93-Tt"\ntitle = raw\n') == []
    assert lexed("dbPwd := 'R4nd0m!Value#9x'") == ["R4nd0m!Value#9x"]
    assert lexed("colour: aquamarine blue\npage = 12\nurl = https://example.org/a") == []


def test_masking(spark):
    text = 'a password="hunter2222" and AKIA' + "B" * 16 + " end"
    assert secrets.masked(text) == 'a [SECRET]" and [SECRET] end'
    frame = spark.createDataFrame([(1, text, 2), (2, None, 3), (3, "", 4), (4, "plain", 5)], "doc_id long, text string, hide int")
    rows = secrets.redact(frame)
    assert rows.columns == frame.columns
    assert {r["doc_id"]: r["text"] for r in rows.collect()} == {1: secrets.masked(text), 2: None, 3: "", 4: "plain"}


def test_declarations_and_inner_pairs():
    literal = "S3cr3tV4lue99"
    for declared in (
        'dbPwd: string = "%s"', 'val dbPwd: String = "%s"', "const DB_PWD: &'static str = \"%s\";", 'password: str = "%s"',
        'password?: string | null = "%s"', "let token: Option<&str> = '%s'", 'password: string="%s"', 'pwd: Optional[str] = "%s"',
        'auth_secret: Dict[str, str] = "%s"; apiKey: string = "%s"',
    ):
        text = declared.replace("%s", literal)
        assert literal in lexed(text), text
        assert literal not in secrets.masked(text), text
    assert lexed("INFO: auth_key=Zx81Qp72Lm93") == ["Zx81Qp72Lm93"]
    assert lexed("url=https://h.org/?a=1;log:auth_key=Zx81Qp72Lm93") == ["Zx81Qp72Lm93"]
    assert lexed('K2 = "Zx81-Qp72-Lm93-Tt"; SECRET_KEY = K2') == ["Zx81-Qp72-Lm93-Tt"]
    assert lexed('LOG: k2="Zx81-Qp72-Lm93-Tt"; SECRET_KEY = k2') == ["Zx81-Qp72-Lm93-Tt"]
    assert lexed("auth_key = Zx81Qp72Lm93") == ["Zx81Qp72Lm93"]
    # a type that a secret has is no name of other values of the type
    assert lexed('dbPwd: string;\ntitle: string = "PublicTitle-2024x"') == []
    assert lexed("a=" * 3_000) == []


def test_long_lines_take_time_in_proportion():
    import time

    for text in ("note: Foo" + "<b>" * 100_000 + " end", "x: T<a" * 50_000, "a:[" * 50_000, "key=" * 50_000, "a: x" + "|x" * 100_000):
        start = time.perf_counter()
        secrets.all_spans(text)
        assert time.perf_counter() - start < 5
    nested = 'cache: Map<String, List<Set<Pair<A, B>>>> = "x"\ndbPwd: Map<String, List<String>> = "S3cr3tV4lue99"'
    assert [nested[a:b] for a, b, kind in secrets.all_spans(nested)[1]] == ["S3cr3tV4lue99"]


def test_many_spans_are_merged_quickly():
    text = "password = 'Abcdef12345'\ndbPwd = \"S3cr3tV4lue99\"\n" * 5_000
    base, every = secrets.all_spans(text)
    assert len(base) == 5_000 and len(every) == 10_000
