"""Repeated runs of lines, found by a suffix array over line ids, and deletion of later copies.

A document is its sequence of lines that hold a word. A run of consecutive
lines is repeated when the same lines stand, in order, at an earlier place
(documents in the order of their ids, lines in theirs). Every line that
lies in a repeated run of at least ``min_words`` words is deleted; the first
copy of a run stays.

The suffix array is built by prefix doubling. Rank 0 orders single lines;
rank k+1 orders the pairs (rank k here, rank k after 2^k lines). The distinct
pairs are range-sorted and numbered in that order, so a rank is an order of
suffixes by their first 2^(k+1) lines and equal ranks are intervals of the
suffix array whose longest common prefix is at least that long. An interval
of one suffix repeats nothing and leaves the rounds.

Only runs that just reach ``min_words`` matter: each line of a longer repeated
run lies in the shortest such run that starts at some line of it, or in the
shortest that ends at one. Those have at most ``min_words`` lines (each has a
word), which bounds the number of rounds. Runs of m lines
that share a prefix of m lines are told by the ranks of their first and last
2^k lines (2^k <= m < 2^(k+1)): this is the interval of the suffix array with a
common prefix of m lines, and all its members but the first are later copies.

Defined cases: a null text stays null and an empty one empty; neither has
lines. Lines without a word are never compared and stay. Rows that repeat a
document id and its text are one document and keep or lose the same lines; null ids
come first. Other columns pass through, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import landed, unused

SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: What names a document: its id and a hash of its text.
DOC = ["d", "t"]


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, t, p, h1, h2, w): the p-th line with a word of a document, by two hashes, and its words."""
    rows = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("x")).where(F.col("x").isNotNull())
    lines = F.filter(F.split("x", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    hashed = F.transform(
        lines,
        lambda x: F.struct(
            F.xxhash64(x).alias("h1"),
            F.xxhash64(F.lit("second"), x).alias("h2"),
            F.size(F.array_remove(F.split(x, r"[\x20\x09-\x0D]+"), "")).alias("w"),
        ),
    )
    return rows.select("d", F.xxhash64("x").alias("t"), F.posexplode(hashed).alias("p", "line")).select(
        "d", "t", "p", "line.*"
    )


def same_doc(a: DataFrame, b: DataFrame) -> Column:
    return a["d"].eqNullSafe(b["d"]) & (a["t"] == b["t"])


def ranked(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct keys that occur more than once, with their rank in sorted order.

    The ids that Spark gives to rows after a range sort rise with the order.
    They are written down at once, so that they stay what they are.
    """
    repeated = keys.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return landed(repeated.orderBy(*columns).withColumn("rank", F.monotonically_increasing_id()), name)


def first_ranks(lines: DataFrame) -> DataFrame:
    """(d, t, p, w, rank) of lines that occur more than once."""
    ranks = ranked(lines, ["h1", "h2"], "line_ranks")
    found = lines.join(ranks, ["h1", "h2"]).select(*DOC, "p", "w", "rank")
    # repeated rows are one document
    return landed(found.groupBy(*DOC, "p").agg(F.first("w").alias("w"), F.first("rank").alias("rank")), "line_starts")


def doubled(level: DataFrame, span: int) -> DataFrame:
    """Ranks of twice as many lines: of the repeated (rank, rank after ``span`` lines)."""
    ahead = level.select(*DOC, (F.col("p") - span).alias("p"), F.col("rank").alias("b"))
    here = level.select(*DOC, "p", F.col("rank").alias("a"))
    pairs = landed(
        here.join(ahead, same_doc(here, ahead) & (here["p"] == ahead["p"])).select(
            here["d"], here["t"], here["p"], "a", "b"
        ),
        "rank_pairs",
    )
    ranks = ranked(pairs, ["a", "b"], "pair_ranks")
    return landed(pairs.join(ranks, ["a", "b"]).select(*DOC, "p", "rank"), "double_ranks")


def shortest_runs(starts: DataFrame, min_words: int) -> DataFrame:
    """(d, t, p, m): the shortest runs of ``min_words`` words from each line and up to each line.

    Only stretches of consecutive repeated lines count. The places between
    lines carry the words before them, and a frame over these words finds the
    nearest place that is far enough. A window holds the lines of one document.
    """
    seg = "d, t, seg"
    places = (
        starts.selectExpr(*DOC, "p", "w", "p - row_number() OVER (PARTITION BY d, t ORDER BY p) AS seg")
        .selectExpr(
            *DOC,
            "seg",
            "p",
            f"cast(sum(w) OVER (PARTITION BY {seg} ORDER BY p) AS int) AS upto",
            "w",
            f"lead(p) OVER (PARTITION BY {seg} ORDER BY p) IS NULL AS last",
        )
        .selectExpr(
            *DOC,
            "seg",
            "explode(CASE WHEN last THEN array(struct(p, upto - w AS c), struct(p + 1 AS p, upto AS c))"
            " ELSE array(struct(p, upto - w AS c)) END) AS at",
        )
        .selectExpr(*DOC, "seg", "at.p", "at.c")
    )
    near = places.selectExpr(
        *DOC,
        "p",
        # from the last place on, so that the frame only grows
        f"min(p) OVER (PARTITION BY {seg} ORDER BY c DESC RANGE BETWEEN UNBOUNDED PRECEDING AND {min_words} PRECEDING) AS after",
        f"max(p) OVER (PARTITION BY {seg} ORDER BY c RANGE BETWEEN UNBOUNDED PRECEDING AND {min_words} PRECEDING) AS before",
    )
    runs = near.selectExpr(
        *DOC,
        "explode(array_compact(array("
        "CASE WHEN after IS NOT NULL THEN struct(p AS p, after - p AS m) END,"
        "CASE WHEN before IS NOT NULL THEN struct(before AS p, p - before AS m) END))) AS run",
    )
    return runs.selectExpr(*DOC, "run.p", "run.m").distinct()


def doomed_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(d, t, gone): places of the lines to delete, for documents that have some."""
    starts = first_ranks(landed(line_rows(docs, id_col, text_col), "lines"))
    levels, level, span = [starts.select(*DOC, "p", "rank", F.lit(0).alias("k"))], starts, 1
    while 2 * span <= min_words:
        level = doubled(level, span)
        span *= 2
        if level.isEmpty():
            break
        levels.append(level.select(*DOC, "p", "rank", F.lit(len(levels)).alias("k")))
    ranks = levels[0]
    for one in levels[1:]:
        ranks = ranks.unionByName(one)
    runs = shortest_runs(starts, min_words).withColumn("k", F.expr("length(bin(m)) - 1"))

    def beside(rows: DataFrame, place: Column, name: str) -> DataFrame:
        other = ranks.selectExpr("d AS hd", "t AS ht", "p AS hp", "k AS hk", f"rank AS {name}")
        same = F.col("d").eqNullSafe(F.col("hd")) & (F.col("t") == F.col("ht")) & (place == F.col("hp"))
        return rows.join(other, same & (F.col("k") == F.col("hk"))).drop("hd", "ht", "hp", "hk")

    named = beside(runs, F.col("p"), "a")
    named = beside(named, F.expr("p + m - cast(pow(2, k) AS int)"), "b")
    named = landed(named.select(*DOC, "p", "m", "a", "b"), "named_runs")
    first = named.groupBy("m", "a", "b").agg(F.min(F.struct("d", "t", "p")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").drop("n")
    later = named.join(first, ["m", "a", "b"]).where(
        ~F.struct("d", "t", "p").eqNullSafe(F.col("first"))
    )
    gone = later.select(*DOC, F.explode(F.sequence("p", F.expr("p + m - 1"))).alias("p")).distinct()
    return gone.groupBy(*DOC).agg(F.sort_array(F.collect_list("p")).alias("gone"))


def finished(rows: DataFrame) -> DataFrame:
    """The same rows, with their columns worked out here rather than inside later expressions, once per use."""
    return rows.withColumn("numbered", F.monotonically_increasing_id()).where("numbered >= 0").drop("numbered")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with later copies of repeated runs deleted from the text, and the number of lines deleted.

    The added column is called ``n_deleted`` unless the table has one of that name.
    """
    gone = landed(doomed_lines(docs, id_col, text_col, min_words), "doomed_lines")
    counted = unused(docs.columns, "n_deleted")
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row")[text_col]
    same = F.col("row")[id_col].eqNullSafe(F.col("d")) & (F.xxhash64(text) == F.col("t"))
    # one plan at every size: how much is to be deleted does not decide whether texts move
    rows = rows.join(gone.hint("merge"), same, "left")
    all_lines = F.when(F.col("gone").isNotNull(), F.split(text, "\n"))
    worded = F.filter(
        F.transform("all_lines", lambda x, i: F.when(F.translate(x, SPACES, "") != "", i)), lambda i: i.isNotNull()
    )
    rows = finished(finished(rows.withColumn("all_lines", all_lines)).withColumn("worded", worded))
    out = F.transform("gone", lambda p: F.get("worded", p))
    kept = F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), out)
    shorter = F.array_join(F.transform(kept, lambda i: F.get("all_lines", i)), "\n")
    text = F.when(F.col("gone").isNull(), text).otherwise(shorter)
    columns = [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return rows.select(*columns, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(counted))
