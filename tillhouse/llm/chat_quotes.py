"""Quotation linking in conversations: DataFrame functions only.

A line's quote level is the number of ``>`` before its text. Neighbouring lines of one level are a passage; level 0 is
what the message itself says. Passages are normalised (lower case, white space as one space, trimmed) and hashed, and
so are their lines and sentences. A quoted passage comes from the first earlier turn of the conversation that says it
as a whole: as its own text, a passage, a line or a sentence; failing that, from the latest turn that first said one of
its lines or sentences. A message answers the source of its least nested quote, the latest if there are several.

Messages without quotes, or with quotes that nobody in the conversation said, start a thread. Threads follow each other
by their first turn; within one, answers follow by depth, then turn. ``position`` counts a conversation's messages in
that order from 0.

No conversation is gathered anywhere: what was said is aggregated to one row per conversation and hash with map-side
combine before it is joined, threads are found by doubling over links alone, and positions come from one global sort.

Null or empty texts say nothing; they are messages all the same. Messages without conversation or turn neither quote
nor are quoted, and are threads of their own. Rows repeated in all columns stay, with one result; of different rows
with one turn, each has links of its own, and who answers that turn follows the earliest thread among them. Very long
texts are taken apart line by line within their row. Extra columns are dropped, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.frames import stored

QUOTE = "^(?:[ ]{0,3}>)+[ ]?"
_BLANK = "[ \\t\\r\\n]+"


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, _BLANK, " ")))


def quoted_lines(text: Column) -> Column:
    """array<struct<level, body>>, one per line."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\\r\\n?", "\n"), "\n")

    def line(x: Column) -> Column:
        prefix = F.regexp_extract(x, QUOTE, 0)
        level = F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.substring(x, F.length(prefix) + 1, F.length(x)).alias("body"))

    return F.transform(lines, line)


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, msg (a digest of the row) and passages."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.withColumn("lines", quoted_lines(F.col("text")))
    first = "filter(sequence(1, size(lines)), i -> i = 1 or lines[i - 1].level <> lines[i - 2].level)"
    rows = rows.withColumn("firsts", F.expr(first))
    found = F.expr(
        "transform(firsts, (s, k) -> struct(lines[s - 1].level as level, "
        "array_join(transform(slice(lines, s, coalesce(get(firsts, k + 1), size(lines) + 1) - s), x -> x.body), '\\n') as body))"
    )
    msg = F.md5(F.to_json(F.struct("conv_id", "turn", "role", "text")))
    return rows.withColumn("passages", found).withColumn("msg", msg).drop("lines", "firsts")


def _parts(body: Column) -> Column:
    """Lines and sentences of a text."""
    marked = F.regexp_replace(body, "([.!?])[ \\t\\r]+", "$1\n")
    return F.concat(F.split(body, "\n"), F.split(marked, "\n"))


def _own(passages: str) -> Column:
    return F.transform(F.filter(passages, lambda p: p["level"] == 0), lambda p: p["body"])


def _hashes(texts: Column) -> Column:
    clean = F.filter(F.transform(texts, normalised), lambda t: t != "")
    return F.array_distinct(F.transform(clean, lambda t: F.md5(t)))


def links(said: DataFrame) -> DataFrame:
    """One row per message and linked passage: conv_id, turn, msg, number, level, source (an earlier turn)."""
    placed = said.where("conv_id is not null and turn is not null")
    quoted = placed.select("conv_id", "turn", "msg", F.posexplode("passages").alias("number", "p")).where("p.level > 0")
    quoted = quoted.select("conv_id", "turn", "msg", "number", "p.level", "p.body").distinct()
    whole = F.transform(_hashes(F.array("body")), lambda h: F.struct(F.lit(0).alias("rank"), h.alias("hash")))
    part = F.transform(_hashes(_parts(F.col("body"))), lambda h: F.struct(F.lit(1).alias("rank"), h.alias("hash")))
    wanted = stored(quoted.withColumn("key", F.explode(F.concat(whole, part))).select("conv_id", "turn", "msg", "number", "level", "key.*"), "chat-wanted")
    own = _own("passages")
    units = F.concat(F.array(F.array_join(own, "\n")), own, F.flatten(F.transform(own, _parts)))
    talking = placed.join(wanted.select("conv_id").distinct(), "conv_id", "left_semi")  # only where anything is quoted
    first = talking.select("conv_id", "turn", F.explode(_hashes(units)).alias("hash")).groupBy("conv_id", "hash").agg(F.min("turn").alias("source"))
    met = wanted.join(stored(first, "chat-first"), ["conv_id", "hash"]).where("source < turn")
    best = F.max(F.struct((-F.col("rank")).alias("rank"), F.col("source").alias("source")))["source"]
    return met.groupBy("conv_id", "turn", "msg", "number", "level").agg(best.alias("source"))


def threads(parents: DataFrame) -> DataFrame:
    """``parents (conv_id, turn, parent)``, one row per turn, to conv_id, turn, root, depth; by doubling."""
    rows = stored(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "chat-threads")
    while True:
        up = rows.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = rows.join(up, ["conv_id", "root"], "left")
        rows = stored(
            joined.select(
                "conv_id",
                "turn",
                F.coalesce("next", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "chat-threads",
        )
        if rows.where("moved").isEmpty():
            return rows.select("conv_id", "turn", "root", "depth")


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``position``: the place of each row in its group, from one range-partitioned sort.

    A group of any size is spread over tasks; only row counts of partitions and first places of groups are added up.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order, "_tie")
    placed = stored(placed.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "chat-sorted")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).count()  # a row per partition
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(sizes.select("_part", before.alias("_before")), "chat-offsets")
    ranked = placed.join(F.broadcast(offsets), part == F.col("_part"))
    ranked = ranked.withColumn("_place", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")
    start = ranked.groupBy(F.col(group).alias("_group")).agg(F.min("_place").alias("_start"))
    joined = ranked.join(stored(start, "chat-starts"), F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("position", F.col("_place") - F.col("_start")).drop("_place", "_start", "_group")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """One row per message: conv_id, position, turn, role, text without quotes, chat (with a role mark), parent_turn,
    root_turn, depth, n_quotes and n_linked (passages)."""
    said = stored(messages(conversations), "chat-messages")
    found = stored(links(said), "chat-links")
    nearest = F.max(F.struct((-F.col("level")).alias("level"), F.col("source").alias("source")))["source"]
    answers = found.groupBy("conv_id", "turn", "msg").agg(nearest.alias("parent"), F.count(F.lit(1)).alias("n_linked"))
    answers = stored(answers, "chat-answers")
    turns = answers.groupBy("conv_id", "turn").agg(F.min("parent").alias("parent"))
    rooted = threads(turns).withColumnsRenamed({"conv_id": "_conv", "turn": "_turn"})
    clean = F.regexp_replace(F.array_join(_own("passages"), "\n"), "^[ \\t\\r\\n]+|[ \\t\\r\\n]+$", "")
    rows = said.select(
        "conv_id", "turn", "role", clean.alias("text"), F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long").alias("n_quotes"), "msg"
    )
    rows = rows.join(answers.select("msg", "parent", "n_linked"), "msg", "left").drop("msg")
    own = (F.col("conv_id") == F.col("_conv")) & (F.col("parent") == F.col("_turn"))
    rows = rows.join(rooted, own, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "text").alias("chat"),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "parent", "turn").alias("root_turn"),
        F.when(F.col("parent").isNull(), 0).otherwise(F.coalesce("depth", F.lit(0)) + 1).cast("long").alias("depth"),
        "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
    return positions(rows, "conv_id", ["root_turn", "depth", "turn", "role", "text"])
