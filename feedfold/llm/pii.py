"""Personal data: fixed patterns, wide generators, and boosted trees that choose among candidates.

Four fixed patterns, with their checks, give the base spans. Beyond them,
wide generators propose spans that may overlap: groups of digits as telephone,
card and identity numbers are written, mail addresses written with "at" and "dot",
and groups of hexadecimal digits with colons. Each candidate is described by
yes/no features of its form and of the words between it and the candidate before it.

What the trees learn comes from two places, and neither label is a feature. In the
corpus, checks that the features cannot see label a candidate: one that
holds a base span is personal; a number as long as a card's that fails its checksum, four parts
beyond 255, a book number whose checksum holds and a valid date are not; all others are
unlabelled and take no part. ``SEEDS`` are short texts with stated labels for forms that no check
decides. Both get the same total weight, so the fit does not depend on the size of the corpus.

Boosted trees of depth two are fitted to counts of labelled candidates by feature pattern
(2^F patterns at most, over the whole corpus): a round of boosting is one
aggregate over these counts, and only sums per two features reach the driver. Scores are
calibrated for each generator apart: its threshold lies above the highest bin of scores
in which less than ``PRECISION`` of the labelled weight is personal. Candidates that reach it and touch no
base span are added as spans of kind ``likely``.

Everything is built of DataFrame functions. Places come from the lengths of
matches and of the text between them; whether a candidate touches a base span is found
by bisection over the sorted spans.

Defined cases: a null or empty text has no spans. Repeated rows give repeated
results. Spans are in code points, ends exclusive, ordered by start, then kind.
Without labelled candidates in the corpus, the trees are fitted to the seeds alone. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import joined_spans, landed

#: The base patterns. A match begins where a run of its first characters does, or where the last match
#: ended, so that long runs are read once; nothing follows a repeated group, so it never has to give back.
LOCAL_START = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
EMAIL = LOCAL_START + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]
SMALL_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

#: What the wide generators propose; the last three words before a candidate are its context.
NUMBERS = r"(?<![0-9A-Za-z+(])[+(]?[0-9][0-9().\x20/-]{5,26}[0-9](?![0-9A-Za-z])"
SPELLED = LOCAL_START + (
    r"[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|@|\x20at\x20)\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\(dot\)|\[dot\]|\.|\x20dot\x20)\x20?[A-Za-z0-9-]++)++"
)
COLONS = r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){5,7}(?![0-9A-Fa-f:])"
CONTEXT = 24
CONTACT = r"(?i)\b(tel|phone|call|fax|mobile?|cell|contact|whatsapp|e-?mail|reach|write|address)\b"
IDENTITY = r"(?i)\b(account|iban|payment|ssn|passport|licen[cs]e|security|insurance)\b"
PLAIN = r"(?i)(\b(isbn|pages?|version|order|invoice|no|total|year|date|doi|item|number of)\b|#)"
DATE = r"^(?:(?:19|20)[0-9]{2}[-/.\x20][0-9]{1,2}[-/.\x20][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2})$"
QUAD = r"^[0-9]+(?:\.[0-9]+){3}$"

#: Texts with one candidate each whose label no check decides.
PERSONAL = [
    "tel 0171 2345678", "Tel. 030 901820", "phone: 555 867 5309", "call 555-867-5309 today", "fax (212) 555-0187",
    "mobile 07700 900123", "contact 0044 20 7946 0958", "whatsapp 0151 23456789", "reach us on 415.555.2671",
    "phone 2345678", "call 901 2345", "tel: 06221/542345", "the (415) 555-2671 line", "at (020) 7946 0958 daily",
    "that 555-867-5309 one", "+49 301 2345", "then +33 1 23 45", "ssn 123-45-6789", "his 078-05-1120 was",
    "passport 123456789", "account 12345678", "account no 0012345678", "license 99887766", "insurance 65 170839 01",
    "me (at) site (dot) org", "jane.doe [at] mail [dot] com", "john at example dot org", "ask a.b at mail dot net",
    "office(at)firm.de", "info [at] firm.co.uk", "email bob at home.org", "the 00:1b:44:11:3a:b7 card", "aa:bb:cc:dd:ee:ff",
]
HARMLESS = [
    "isbn 978-3-16-148410-0", "978-0-306-40615-7", "ISBN: 979 10 90636 07 1", "order 1234567", "order no. 4711-0815-22",
    "invoice 2023-00123", "invoice no. 0012345678", "invoice 555 867 5309", "order 0171 2345678", "page 123-4567",
    "pages 1200-1350", "version 1.20.300.4000", "total 1 234 567", "total 12.345.678", "year 1990-2020", "from 1990-2020",
    "on 2021-03-04", "the 04/05/2021 issue", "by 31.12.1999", "date 20210304", "doi 10.1000/182", "had 1234567 rows",
    "some 1 234 567 of", "and 12345678901 more", "is 0.123456789", "pi 3.14159265", "0001112223", "# 1234567890",
    "100 200 300 400", "1000-2000-3000", "item 4006381333931", "number of 12345678", "meet at example.com", "sold at shop.net",
    "look at this.thing", "1:2:3:4:5:6", "ran 1:20:3:40:5:6",
]

ROUNDS = 30
RATE = 0.5
PRECISION = 0.9
#: Scores (logits) are calibrated in bins of this width.
BIN = 0.5
BLOCK = 256


def sums_before(sizes: Column) -> Column:
    """For each element the sum of those before it; in blocks, so that long arrays stay linear in effect."""
    n = F.size(sizes)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(n, F.lit(1)) - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda a, x: a + x),
    )
    firsts = F.aggregate(
        blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )
    return F.transform(
        sizes,
        lambda x, i: F.get(firsts, F.floor(i / BLOCK).cast("int"))
        + F.aggregate(
            F.slice(sizes, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK), F.lit(0), lambda a, y: a + y
        ),
    )


def found(rows: DataFrame, name: str, pattern: str, hint: Column) -> DataFrame:
    """Adds ``name``: an array of (start, end, match, before) of the pattern; ``hint`` is false where there is none."""
    none = F.array().cast("array<string>")
    parts, hits, ends = f"{name}_parts", f"{name}_hits", f"{name}_starts"
    rows = rows.withColumns(
        {
            hits: F.when(hint, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
            parts: F.when(hint, F.split("text", pattern)).otherwise(none),
        }
    )
    rows = rows.withColumn(
        f"{name}_sizes", F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(F.col(parts), i)))
    )
    rows = rows.withColumn(ends, sums_before(F.col(f"{name}_sizes")))
    spans = F.transform(
        hits,
        lambda h, i: F.struct(
            (F.get(F.col(ends), i) + F.length(F.get(F.col(parts), i))).alias("start"),
            (F.get(F.col(ends), i) + F.get(F.col(f"{name}_sizes"), i)).alias("end"),
            h.alias("match"),
            F.right(F.get(F.col(parts), i), F.lit(CONTEXT)).alias("before"),
        ),
    )
    return rows.withColumn(name, spans).drop(parts, hits, ends, f"{name}_sizes")


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the checksum of a text of digits holds."""
    values = F.transform(
        F.split(F.reverse(number), ""),
        lambda c, i: F.when(c == "", 0)
        .when(i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int"))
        .otherwise(c.cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def book_number(number: Column) -> Column:
    """Whether a text of digits is a book number of 13 digits whose checksum holds."""
    values = F.transform(F.split(number, ""), lambda c, i: F.when(c == "", 0).otherwise(c.cast("int") * (1 + 2 * (i % 2))))
    return number.rlike("^97[89][0-9]{10}$") & (F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0)


def features(match: Column, before: Column) -> list[Column]:
    """Yes/no features of form and context; none tells a checksum or the value of a part."""
    number = digits(match)
    n = F.length(number)
    return [
        match.contains("@"),
        match.rlike(r"[(\[](?:at|dot)[)\]]"),
        match.rlike(r"\x20at\x20"),
        match.rlike(r"\x20dot\x20|[(\[]dot[)\]]"),
        match.startswith("+"),
        n.between(7, 9),
        n.between(10, 13),
        n >= 14,
        match.rlike("^97[89]") & (n == 13),
        match.rlike(r"^\(?0[1-9]|^00[1-9]"),
        match.contains("("),
        match.rlike(DATE),
        match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        match.rlike(QUAD),
        match.rlike("^(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}$"),
        match.rlike(r"[0-9][\x20./-]+[0-9]"),
        match.rlike(r"^\(?[2-9][0-9]{2}\)?[-.\x20]\x20?[0-9]{3}[-.\x20][0-9]{4}$"),
        before.rlike(CONTACT),
        before.rlike(IDENTITY),
        before.rlike(PLAIN),
    ]


N_FEATURES = 20


def weak_label(match: Column, held: Column) -> Column:
    """What checks say of a candidate: personal, not personal, or null."""
    number = digits(match)
    parts = F.regexp_replace(match, r"[/.\x20]", "-")
    day = F.try_to_timestamp(parts, F.lit("yyyy-M-d")).isNotNull() | F.try_to_timestamp(parts, F.lit("d-M-yyyy")).isNotNull()
    failed = F.length(number).between(14, 19) | match.rlike(QUAD) | book_number(number) | (match.rlike(DATE) & day)
    return F.when(held, True).when(failed, False)


def highest_before(values: Column) -> Column:
    """For each element the largest of it and those before it; in blocks, as ``sums_before``."""
    n = F.size(values)
    tops = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(n, F.lit(1)) - 1) / BLOCK).cast("int")),
        lambda b: F.coalesce(F.array_max(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))), F.lit(0)),
    )
    firsts = F.aggregate(
        tops, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.greatest(F.element_at(a, -1), x)))
    )
    return F.transform(
        values,
        lambda x, i: F.greatest(
            F.get(firsts, F.floor(i / BLOCK).cast("int")),
            F.array_max(F.slice(values, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1)),
        ),
    )


def touches(starts: Column, tops: Column, start: Column, end: Column) -> Column:
    """Whether (start, end) overlaps one of the spans with these sorted starts and highest ends so far."""
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(starts))))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        below = F.get(starts, middle) < end
        return F.when(at["low"] >= at["high"], at).otherwise(
            F.struct(
                F.when(below, middle + 1).otherwise(at["low"]).alias("low"),
                F.when(below, at["high"]).otherwise(middle).alias("high"),
            )
        )

    first = F.struct(F.lit(0).alias("low"), F.size(starts).alias("high"))
    earlier = F.aggregate(steps, first, halve, lambda at: at["low"])
    return (F.size(starts) > 0) & F.coalesce(F.get(tops, earlier - 1) > start, F.lit(False))


def numbered(kind: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("at"), s["end"].alias("end"))


def spans_of(rows: DataFrame) -> DataFrame:
    """(doc_id, given, base, candidates) of (doc_id, text, given): base spans, and candidates with features and labels."""
    rows = rows.withColumns(
        {
            "at": F.col("text").contains("@"),
            "digit": F.col("text").rlike("[0-9][0-9().\\x20/-]{5}"),
            "quad": F.col("text").rlike(r"[0-9]\.[0-9]"),
        }
    )
    rows = found(rows, "email", EMAIL, F.col("at"))
    rows = found(rows, "ip", IP, F.col("quad"))
    rows = found(rows, "card", CARD, F.col("digit"))
    rows = found(rows, "phone", PHONE, F.col("text").contains("+"))
    rows = found(rows, "numbers", NUMBERS, F.col("digit"))
    rows = found(rows, "spelled", SPELLED, F.col("at") | F.col("text").rlike(r"(?:\(at\)|\[at\]|\x20at\x20)"))
    rows = found(rows, "colons", COLONS, F.col("text").rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"))
    checks = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["match"].rlike(SMALL_PARTS),
        "card": lambda s: F.length(digits(s["match"])).between(14, 19) & luhn(digits(s["match"])),
        "phone": lambda s: F.length(digits(s["match"])).between(10, 15),
    }
    good = [F.transform(F.filter(kind, checks[kind]), numbered(at)) for at, kind in enumerate(KINDS)]
    rows = rows.withColumn("base", F.sort_array(F.concat(*good)))
    rows = rows.withColumn("starts", F.transform("base", lambda b: b["start"]))
    rows = rows.withColumn("tops", highest_before(F.transform("base", lambda b: b["end"])))

    def described(name: str, at: int) -> Column:
        held = F.transform(
            name, lambda s: F.struct(s.alias("span"), touches(F.col("starts"), F.col("tops"), s["start"], s["end"]).alias("held"))
        )
        return F.transform(
            held,
            lambda c: F.struct(
                c["span"]["start"].alias("start"),
                c["span"]["end"].alias("end"),
                F.lit(at).alias("made_by"),
                F.array(*features(c["span"]["match"], c["span"]["before"])).alias("x"),
                c["held"].alias("held"),
                weak_label(c["span"]["match"], c["held"]).alias("label"),
            ),
        )

    wide = [described(name, at) for name, at in (("numbers", 0), ("phone", 0), ("spelled", 1), ("colons", 2))]
    return rows.select("doc_id", "given", "base", F.concat(*wide).alias("candidates"))


#: Generators whose scores are calibrated apart: groups of digits, spelled addresses, groups with colons.
N_MADE_BY = 3


class Trees:
    """Boosted trees of depth two: (first feature, second where it is false, second where it is true, four leaves)."""

    def __init__(self):
        self.trees: list[tuple[int, int, int, list[float]]] = []
        self.bins: list[int | None] = [None] * N_MADE_BY  # lowest bin of scores that passes

    def score(self, x: Column) -> Column:
        total = F.lit(0.0)
        for first, low, high, leaves in self.trees:
            total += F.when(
                F.get(x, F.lit(first)), F.when(F.get(x, F.lit(high)), leaves[3]).otherwise(leaves[2])
            ).otherwise(F.when(F.get(x, F.lit(low)), leaves[1]).otherwise(leaves[0]))
        return total

    def bin(self, x: Column) -> Column:
        return F.floor(F.round(self.score(x), 9) / BIN).cast("int")

    def selects(self, made_by: Column, x: Column) -> Column:
        passes = F.lit(False)
        for at, lowest in enumerate(self.bins):
            if lowest is not None:
                passes |= (made_by == at) & (self.bin(x) >= lowest)
        return passes


def gain(g: float, h: float) -> float:
    return g * g / (h + 1.0)


def best_split(sums: dict[tuple[int, int], tuple[float, float]], inside: int, outside: bool) -> tuple[int, list[float]]:
    """The feature that splits best and its two leaf values, where feature ``inside`` is true (or false: ``outside``)."""

    def part(f: int) -> tuple[float, float]:
        g, h = sums.get((inside, f), (0.0, 0.0))
        if outside:
            whole = sums.get((ALL, f), (0.0, 0.0))
            g, h = whole[0] - g, whole[1] - h
        return g, h

    g, h = part(ALL)
    pairs = [part(f) for f in range(N_FEATURES)]
    at = max(range(N_FEATURES), key=lambda f: gain(*pairs[f]) + gain(g - pairs[f][0], h - pairs[f][1]))
    g1, h1 = pairs[at]
    return at, [RATE * (g - g1) / (h - h1 + 1.0), RATE * g1 / (h1 + 1.0)]


#: Stands for a feature that every candidate has.
ALL = -1


def fit(counted: DataFrame) -> Trees:
    """Trees over (made_by, x, label, n): weights of labelled candidates by features; at most 3 * 2^(F+1) rows.

    A round is one aggregate: sums of gradients for each two features that hold together,
    (F+1)^2 rows at most, give the first split and both second ones.
    """
    trees = Trees()
    true = F.filter(F.sequence(F.lit(0), F.lit(N_FEATURES - 1)), lambda f: F.get("x", f))
    held = counted.withColumn("fs", F.concat(F.array(F.lit(ALL)), true))
    pairs = landed(held.withColumn("f", F.explode("fs")).withColumn("k", F.explode("fs")).drop("fs"), "pii_pairs")
    for _ in range(ROUNDS):
        rows = pairs.withColumn("p", 1 / (1 + F.exp(-trees.score(F.col("x")))))
        found = rows.groupBy("f", "k").agg(
            F.sum(F.col("n") * (F.col("label").cast("int") - F.col("p"))).alias("g"),
            F.sum(F.col("n") * F.col("p") * (1 - F.col("p"))).alias("h"),
        )
        # sums of doubles differ in their last digits by the order of rows
        sums = {(r["f"], r["k"]): (round(r["g"], 9), round(r["h"], 9)) for r in found.collect()}
        first, _ = best_split(sums, ALL, False)
        low, below = best_split(sums, first, True)
        high, above = best_split(sums, first, False)
        trees.trees.append((first, low, high, [*below, *above]))
    # one row per generator: its lowest bin, or the one above the highest that is not precise enough
    bins = counted.groupBy("made_by", trees.bin(F.col("x")).alias("s")).agg(
        (F.sum(F.when(F.col("label"), F.col("n")).otherwise(0.0)) / F.sum("n")).alias("precision")
    )
    lowest = bins.groupBy("made_by").agg(
        F.coalesce(F.max(F.when(F.col("precision") < PRECISION, F.col("s"))) + 1, F.min("s")).alias("s")
    )
    for row in lowest.collect():
        trees.bins[row["made_by"]] = row["s"]
    return trees


def with_seeds(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, given): documents, whose label is null, and seeds with theirs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.lit(None).cast("boolean").alias("given"))
    texts = [F.struct(F.lit(t).alias("text"), F.lit(good).alias("given")) for good, ts in ((True, PERSONAL), (False, HARMLESS)) for t in ts]
    known = docs.sparkSession.range(1).select(F.explode(F.array(*texts)).alias("seed"))
    none = F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id")
    # a table of its own, as the optimizer is slow with this many constants
    return rows.unionByName(landed(known.select(none, "seed.*"), "pii_seeds"))


def patterns(rows: DataFrame) -> DataFrame:
    """(made_by, x, label, n): weights of labelled candidates; corpus and seeds weigh the same in total."""
    seed = F.col("given").isNotNull()
    found = rows.select(seed.alias("seed"), "given", F.explode("candidates").alias("c"))
    found = found.select("seed", "c.made_by", "c.x", F.when(F.col("seed"), F.col("given")).otherwise(F.col("c.label")).alias("label"))
    counted = found.where("label IS NOT NULL").groupBy("seed", "made_by", "x", "label").agg(F.count("*").cast("double").alias("n"))
    counted = landed(counted, "pii_patterns")
    total = counted.groupBy("seed").agg(F.sum("n").alias("total"))
    shared = counted.join(F.broadcast(total), "seed")  # two rows at most
    weight = (F.col("n") / F.col("total") * (len(PERSONAL) + len(HARMLESS))).alias("n")
    return shared.select("made_by", "x", "label", weight)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row (doc_id, base, every): base spans and all spans as (start, end, kind)."""
    rows = landed(spans_of(with_seeds(docs, id_col, text_col)), "pii_spans")
    trees = fit(landed(patterns(rows), "pii_weights"))
    rows = rows.where("given IS NULL")
    names = F.array(*[F.lit(k) for k in [*KINDS, "likely"]])
    base = F.col("base")
    likely = F.filter("candidates", lambda c: ~c["held"] & trees.selects(c["made_by"], c["x"]))
    # places as one integer each, which Spark tells apart by hashing
    places = F.array_distinct(F.transform(likely, lambda c: F.shiftleft(c["start"].cast("long"), 32) + c["end"]))
    more = F.transform(
        places,
        lambda p: F.struct(
            F.shiftright(p, 32).cast("int").alias("start"),
            F.lit(len(KINDS)).alias("at"),
            p.bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("end"),
        ),
    )
    every = F.sort_array(F.concat(base, more))

    def shown(spans: Column) -> Column:
        return F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["at"]).alias("kind"))
        )

    return rows.select("doc_id", shown(base).alias("base"), shown(every).alias("every"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base kinds, the digest of base spans, and all spans as text."""
    rows = scan(docs, id_col, text_col)
    kinds = F.col("base.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("every")).alias("spans"),
    )
