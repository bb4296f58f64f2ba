"""Filter interaction audit: what every order of a set of filters removes, without running any order.

A document is reduced to the mask of filters it fails, and documents to counts per part and mask: at most 2^n rows a
part. In lexicographic order, all permutations that begin with the same k letters have neighbouring ranks (their Lehmer
codes share k digits), so what a mask causes at step k holds on whole rank intervals of length (n - k)!. Each count is
added where such an interval begins and subtracted where it ends; a prefix sum over the ranks then gives the totals of
all orders at once. The table of intervals depends on the number of filters only (about 5,000 rows for five); counts
meet it by mask.

Counts are per part and step: ``removed`` (first filter in the order that a document fails), ``redundant`` (fails here,
gone before), and the removed documents that were good or toxic. ``kept`` is what is left after the step.

Texts are read once, whole, inside the scan; what travels is one narrow row per document: its id, a SHA-256 of its text,
its part and mask. The smallest id of each text is found by an aggregate with map-side combine and met by id *and* text,
so a text that a third of all documents share is no hot key. Equal narrow rows are counted before they travel.

Null and empty texts count as empty (and are equal), a null part as the empty string. Words are maximal runs of other
than ASCII white space. A document without id has no smaller id than another's, so it repeats nothing and nothing repeats
it; it has no label. Of several labels of one id the largest counts. Rows with the same id and text do not repeat each
other. Extra columns are ignored. An empty table gives no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.frames import stored

# The filters in the order of their bits, and their limits.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
WORD, SYMBOL, NOT_UPPER = r"[^\x20\x09-\x0D]+", r"[#$%&*|]", "[^A-Z]+"


def text_failures(text: Column) -> list[Column]:
    """A to D: too few words, too repetitive, too many capitals, odd symbols."""
    body = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        100 * F.length(F.regexp_replace(body, NOT_UPPER, "")) > MAX_UPPER_PERCENT * F.length(body),
        body.rlike(SYMBOL),
    ]


def mask_of(failures: list[Column]) -> Column:
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(failures)]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    return total


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Counts by (part, mask, good, toxic): ``documents`` rows that fail exactly the filters of a mask."""
    body = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        F.unhex(F.sha2(body, 256)).alias("body"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        mask_of(text_failures(F.col("text"))).alias("mask"),
    )
    narrow = stored(narrow.groupBy("doc_id", "body", "part", "mask").agg(F.count("*").alias("n")), "audit-documents")
    known = narrow.where("doc_id is not null")
    firsts = known.groupBy("body").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id")
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    repeats = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    judged = known.join(firsts, ["doc_id", "body"], "left").join(marks, "doc_id", "left").withColumn("mask", F.col("mask") + repeats)
    judged = judged.unionByName(narrow.where("doc_id is null"), allowMissingColumns=True)
    no = F.lit(False)
    judged = judged.select("part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n")
    return judged.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def intervals(n: int) -> list[tuple[int, int, int, int, bool]]:
    """(mask, step, low, high, first): from rank ``low`` to before ``high`` the filter at ``step`` is one of the mask's;
    ``first`` tells whether no earlier one is. Neighbouring intervals of a kind are one."""
    out: list[tuple[int, int, int, int, bool]] = []
    for mask in range(1, 1 << n):
        for step in range(1, n + 1):
            width = factorial(n - step)
            for k, prefix in enumerate(permutations(range(n), step)):  # in lexicographic order
                if mask >> prefix[-1] & 1:
                    first = not any(mask >> f & 1 for f in prefix[:-1])
                    if out and out[-1][:2] == (mask, step) and out[-1][3:] == (k * width, first):
                        out[-1] = (*out[-1][:3], (k + 1) * width, first)
                    else:
                        out.append((mask, step, k * width, (k + 1) * width, first))
    return out


def orders(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """Every (rank, filter_order, step, filter)."""
    n = len(filters)
    rows = [(rank, "".join(p), step + 1, p[step]) for rank, p in enumerate(permutations(filters)) for step in range(n)]
    return spark.createDataFrame(rows, "rank int, filter_order string, step int, filter string")


SUMS = ["removed", "redundant", "good_lost", "toxic_lost"]


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """From counts by (part, mask, good, toxic): a row per part, order and step, zeros included.

    ``unique_fails`` counts documents that fail this step's filter only; ``shapley`` is what the filter removes, summed
    over all orders at any step (the Shapley value times the number of orders).
    """
    spark, n = counts.sparkSession, len(filters)
    counts = stored(counts, "audit-masks")
    table = spark.createDataFrame(intervals(n), "mask int, step int, low int, high int, first boolean")
    first = F.col("first")
    amounts = [
        F.when(first, F.col("n")), F.when(~first, F.col("n")),
        F.when(first & F.col("good"), F.col("n")), F.when(first & F.col("toxic"), F.col("n")),
    ]
    spans = counts.join(F.broadcast(table), "mask").select(
        "part", "step", "low", "high", *(F.coalesce(a, F.lit(0)).alias(c) for a, c in zip(amounts, SUMS))
    )
    begins = spans.select("part", "step", F.col("low").alias("rank"), *SUMS)
    ends = spans.select("part", "step", F.col("high").alias("rank"), *((-F.col(c)).alias(c) for c in SUMS))
    alone = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(n)]
    alone = F.create_map(*(x for f, total in zip(filters, alone) for x in (F.lit(f), total)))
    parts = stored(counts.groupBy("part").agg(F.sum("n").alias("total"), alone.alias("alone")), "audit-parts")
    grid = parts.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))))
    grid = grid.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n)))).join(F.broadcast(orders(spark, filters)), ["rank", "step"])
    deltas = begins.unionByName(ends).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in SUMS))
    grid = grid.join(deltas, ["part", "step", "rank"], "left")
    along = Window.partitionBy("part", "step").orderBy("rank")
    grid = grid.withColumns({c: F.sum(F.coalesce(c, F.lit(0))).over(along) for c in SUMS})
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    grid = grid.withColumn("kept", F.col("total") - F.sum("removed").over(so_far))
    grid = grid.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))
    return grid.select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", F.col("alone")[F.col("filter")].alias("unique_fails"),
        "good_lost", "toxic_lost", "shapley",
    )
