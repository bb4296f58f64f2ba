"""Exact dedup by progressive refinement: byte length, then a hash of the first bytes, then a hash of everything.

Only texts that share length *and* prefix with another text get their whole content hashed; which those are is sent to
all executors as a bitmap of fixed size, so the refinement is the same at every size. Null and the empty text are equal;
nothing is normalised. Rows without ``doc_id`` take part and count as smaller than any id. Rows that repeat an id *and*
its text are reported as often as they occur, each with the same decision; ``drop_copies`` leaves one of them. Very long
texts are hashed whole where they are read; texts do not travel. An empty table gives an empty result. Extra columns are
ignored (``exact_groups``) or kept (``drop_copies``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.frames import fresh_name, small_or_shuffled, stored

PREFIX_CHARS = 128
#: Bits of the broadcast bitmap of shared (length, prefix) pairs, as a power of two: at most 2^20 rows of 64 bits. A pair
#: that falls on another's bit costs its text a full hash that was not needed (14 % of them at ten million shared pairs).
BITMAP = 26


def _keys() -> tuple[Column, Column]:
    text = F.coalesce("text", F.lit(""))
    return F.octet_length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARS))


def _fingerprinted(docs: DataFrame, length: str = "_len", full: str = "_full") -> DataFrame:
    """``docs`` (with a column text) with ``length`` and ``full``: 32 bytes, null where no text shares length and prefix."""
    keys = docs.select(*(k.alias(n) for k, n in zip(_keys(), ("a", "b"))))
    sizes = keys.groupBy("a", "b").count()  # one scan: lengths split by prefixes, counted map-side
    bit = F.pmod(F.xxhash64("a", "b"), F.lit(1 << BITMAP))
    shared = sizes.where("count > 1").select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("bit"))
    word, bits = fresh_name([*docs.columns, length, full], "_word"), fresh_name([*docs.columns, length, full], "_bits")
    bitmap = stored(shared.groupBy("word").agg(F.bit_or("bit").alias("bits")), "exact-bitmap").toDF(word, bits)
    own = F.pmod(F.xxhash64(*_keys()), F.lit(1 << BITMAP))
    marked = docs.withColumns({length: _keys()[0], word: F.shiftright(own, 6)}).join(F.broadcast(bitmap), word, "left")
    single = F.call_function("shiftleft", F.lit(1).cast("long"), (own % 64).cast("int"))
    hit = F.col(bits).bitwiseAND(single) != 0
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return marked.withColumn(full, F.when(hit, digest)).drop(word, bits)


def exact_groups(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, n_same (rows with the id that stays), and ``keep``.

    Groups are counted by (text, id) first and by text then, so a text that a third of all rows share sends one row per
    task and id range. The groups are written and joined back to narrow rows; both join sides have exchanges of their
    own, so the skew rule splits a large group.
    """
    return _grouped(_fingerprinted(docs.select("doc_id", "text", *(keep or []))).drop("text"), keep)


def _grouped(narrow: DataFrame, keep: list[str] | None) -> DataFrame:
    """The same from rows with doc_id, ``_len`` and ``_full``."""
    counted = narrow.where("_full is not null").groupBy("_len", "_full", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = counted.groupBy("_len", "_full").agg(
        F.max("doc_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.max(F.struct(F.col("doc_id"), F.col("n")))["n"].alias("n_same"),
    )
    groups = stored(groups.where("group_size > 1"), "exact-groups")
    joined = narrow.join(groups, ["_len", "_full"], "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.coalesce("n_same", F.lit(1)).cast("long").alias("n_same"),
        *(keep or []),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose text another row with a larger id has; of repeated rows of one id, one stays.

    Only what goes is matched against the documents, by id, length and the full hash, which lone texts never get. That
    list is written and counted: up to ``frames.BROADCAST_ROWS`` rows it is broadcast and the documents stay where they
    are, beyond that they are shuffled to it once.
    """
    columns = docs.columns
    names = [fresh_name(columns, x) for x in ("_len", "_full")]
    listed = [fresh_name(columns, x) for x in ("_id", "_len_of", "_full_of")]
    hashed = _fingerprinted(docs, *names)
    rows = _grouped(hashed.select("doc_id", *(F.col(n).alias(x) for n, x in zip(names, ("_len", "_full")))), ["_len", "_full"])
    rows = rows.where("group_size > 1 and (not kept or n_same > 1)").select("doc_id", "_len", "_full", "kept").distinct()
    rows = stored(rows.toDF(*listed, "kept"), "exact-listed")
    match = F.col("doc_id").eqNullSafe(F.col(listed[0])) & (F.col(names[0]) == F.col(listed[1])) & (F.col(names[1]) == F.col(listed[2]))
    rest = hashed.join(small_or_shuffled(stored(rows.where("not kept").drop("kept"), "exact-gone")), match, "left_anti")
    twice = stored(rows.where("kept").drop("kept"), "exact-twice")
    if twice.isEmpty():
        return rest.select(*columns)
    again = small_or_shuffled(twice)
    repeated = rest.join(again, match, "left_semi").dropDuplicates(["doc_id", *names]).select(*columns)
    return rest.join(again, match, "left_anti").select(*columns).unionByName(repeated)
