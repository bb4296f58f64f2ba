"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked by bit-sliced comparison, grouped by components.

A fingerprint bit is set if it is set in more than half of the XXH64 values (seed 42) of the text's shingles, repeats
included. Words are runs of bytes other than white space, A-Z as a-z. A text of fewer words is one shingle; a text
without words, null among them, has fingerprint zero and is linked like any other.

Equal fingerprints are one row before anything is compared, so copies cost nothing. Two fingerprints at distance 2 or
less agree in at least two of four 16-bit blocks, so rows meet by the six pairs of blocks; nothing is missed. A pair of
blocks that more than ``SPLIT`` fingerprints share is split by the same rule over its other 32 bits, which leaves groups
of at most 65,536 values. Within a group no pairs are listed: the task joins what it links and emits one edge per row.

Rows repeating an id are linked like others. An empty table gives an empty result. Null ids take part; a group's id is
the smallest id that is not null. Very long texts are hashed whole where they are read. Extra columns are ignored,
or kept by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import text as T
from tillhouse.llm.frames import appended, components, fresh_name, small_or_shuffled, stored

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints under one key beyond which the key is split.
SPLIT = 4096

_LOWER_SPACE = np.array([32 if b in (9, 10, 11, 12, 13) else T.LOWER[b] for b in range(256)], dtype=np.uint8)


def shingle_bits(texts: T.Texts, size: int) -> np.ndarray:
    """Fingerprints of some texts."""
    starts, ends, first = T.words(texts, T.NOT_SPACE)
    flat, low, high = T.joined(texts, starts, ends, _LOWER_SPACE)
    counts = np.diff(first)
    n = np.maximum(counts - size + 1, np.minimum(counts, 1))
    begin = np.repeat(first[:-1], n) + _ramp(n)
    last = np.minimum(begin + size, np.repeat(first[1:], n)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[a:b], SEED) for a, b in zip(low[begin].tolist(), high[last].tolist())), np.uint64, len(begin))
    out = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = np.concatenate([[0], np.cumsum(n)])[:-1][some]
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > n[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _ramp(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ..."""
    total = int(n.sum())
    return np.arange(total) - np.repeat(np.cumsum(n) - n, n)


def fingerprints(docs: DataFrame, size: int = SHINGLE, text: str = "text", carry: list[str] | None = None, name: str = "fp") -> DataFrame:
    """``carry`` columns (all by default) with the fingerprint as a signed 64-bit number in column ``name``."""
    carry = docs.columns if carry is None else carry

    def start():
        def work(batch: pa.RecordBatch) -> list:
            parts = [shingle_bits(texts, size) for texts in T.chunks(batch.column(text), T.CHUNK_BYTES // 2)]
            return [pa.array(np.concatenate(parts).view(np.int64))]

        return work

    return appended(docs, carry, [(name, "bigint")], start)


def _counted(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Words whose bits say which lanes differ in at most 2 of the planes, by carry-save counters.

    Eight planes a step; words in which every lane has passed the radius leave the comparison.
    """
    n = planes.shape[1]
    within = np.zeros(n, dtype=np.uint64)
    live = np.arange(n)
    ones = np.zeros(n, dtype=np.uint64)
    twos, over = ones.copy(), ones.copy()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for at in range(0, 64, 8):
        block = planes[at : at + 8, live] ^ other[at : at + 8, live]
        for x in block:
            carry = ones & x
            ones ^= x
            over |= twos & carry
            twos ^= carry
        over |= ones & twos
        open_ = over != full
        if not open_.all():
            live, ones, twos, over = live[open_], ones[open_], twos[open_], over[open_]
            if not len(live):
                return within
    within[live] = ~over
    return within


def linked(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """For rows sorted by ``key``: a row of the same key that each row is joined to, the first of its set or itself.

    All groups are compared at once: bit plane b holds bit b of 64 rows a word; shifted by d lanes it meets the rows d
    places further on. Words in which no row has a partner at that distance are left out.
    """
    n = len(key)
    label = np.arange(n)
    if n < 2:
        return label
    words = -(-n // 64)
    bits = np.zeros((words * 64, 8), dtype=np.uint8)
    bits[:n] = fp.astype("<u8").view(np.uint8).reshape(-1, 8)
    lanes = np.unpackbits(bits, axis=1, bitorder="little").reshape(words, 64, 64).transpose(2, 0, 1)
    planes = np.packbits(np.ascontiguousarray(lanes), axis=2, bitorder="little").view("<u8").reshape(64, words)
    planes = np.concatenate([planes, np.zeros((64, 2), dtype=np.uint64)], axis=1)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    stop = np.repeat(edge[1:], np.diff(edge))  # end of each row's group
    room = stop - np.arange(n) - 1  # rows of the group that follow
    left, right = [], []
    reach = np.zeros(words * 64, dtype=np.int64)
    reach[:n] = room
    longest = reach.reshape(words, 64).max(axis=1)
    for d in range(1, int(room.max()) + 1):
        at = np.flatnonzero(longest >= d)
        jump, shift = divmod(d, 64)
        far = np.minimum(at + jump, words + 1)
        next_ = np.minimum(far + 1, words + 1)
        moved = planes[:, far] >> np.uint64(shift)
        if shift:
            moved |= planes[:, next_] << np.uint64(64 - shift)
        near = _counted(planes[:, at], moved)
        some = np.flatnonzero(near)
        if not len(some):
            continue
        lane = np.unpackbits(near[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        word, bit = np.nonzero(lane)
        row = at[some[word]] * 64 + bit
        row = row[(row < n)]
        row = row[room[row] >= d]
        left.append(row)
        right.append(row + d)
    if not left:
        return label
    a, b = np.concatenate(left), np.concatenate(right)
    while len(a):
        one, two = label[a], label[b]  # roots, as all labels are
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, fp) sorted by key to edges (a, b); a group is never larger than its bound."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush(key, fp):
        to = linked(key, fp.view(np.uint64))
        own = np.flatnonzero(to != np.arange(len(to)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[to[own]])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
        last = int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
        if last:
            held.append((key[:last], fp[:last]))
            yield flush(*(np.concatenate(x) for x in zip(*held)))
            held = []
        elif held and held[-1][0][-1] != key[0]:
            yield flush(*(np.concatenate(x) for x in zip(*held)))
            held = []
        held.append((key[last:], fp[last:]))
    if held:
        yield flush(*(np.concatenate(x) for x in zip(*held)))


def _block(value, k: int, width: int):
    return F.shiftrightunsigned(value, k * width).bitwiseAND((1 << width) - 1)


def links(prints: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``) at distance 2 or less: enough to connect them."""
    fp = F.col("fp")
    keys = []
    for tag, (i, j) in enumerate(combinations(range(4), 2)):
        keys.append(F.shiftleft(F.shiftleft(F.lit(tag).cast("long"), 16).bitwiseOR(_block(fp, i, 16)), 16).bitwiseOR(_block(fp, j, 16)))
    rows = stored(prints.select("fp", F.explode(F.array(*keys)).alias("key")), "simhash-keys")
    shared = stored(rows.groupBy("key").count().where("count > 1"), "simhash-shared")
    met = stored(rows.join(shared, "key"), "simhash-met")
    cold = met.where(F.col("count") <= SPLIT).select("key", "fp")
    hot = met.where(F.col("count") > SPLIT)
    # The other two blocks of a hot key as four bytes, any two of which must agree.
    tag = F.shiftrightunsigned("key", 32)
    rest = F.lit(None).cast("long")
    for number, pair in enumerate(combinations(range(4), 2)):
        x, y = (k for k in range(4) if k not in pair)
        rest = F.when(tag == number, F.shiftleft(_block(fp, x, 16), 16).bitwiseOR(_block(fp, y, 16))).otherwise(rest)
    finer = []
    for number, (i, j) in enumerate(combinations(range(4), 2)):
        sub = F.shiftleft(F.shiftleft(F.lit(number + 1).cast("long"), 8).bitwiseOR(_block(F.col("rest"), i, 8)), 8).bitwiseOR(_block(F.col("rest"), j, 8))
        finer.append(F.shiftleft(sub, 35).bitwiseOR(F.col("key")))
    split = hot.withColumn("rest", rest).select("fp", F.explode(F.array(*finer)).alias("key")).select("key", "fp")
    grouped = cold.unionByName(split).repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(_edges, "a bigint, b bigint")


def groups(prints: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row per distinct ``fp`` with ``component_id``: the smallest id of all rows whose fingerprints are connected."""
    distinct = stored(prints.groupBy("fp").agg(F.min(doc).alias("least")), "simhash-prints")
    found = components(links(distinct), "simhash")
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(rooted.join(least, "root").select("fp", "component_id"), "simhash-groups")


def near_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per row: doc_id, fp, component_id."""
    prints = stored(fingerprints(docs.select("doc_id", "text"), size, carry=["doc_id"]), "simhash-docs")
    return prints.join(groups(prints), "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; repeats of one id and fingerprint leave one.

    Only what goes is matched against the documents; that list is written and counted, and broadcast if it is small.
    """
    columns = docs.columns
    fp, row, its = fresh_name(columns, "fp_"), fresh_name(columns, "row_"), fresh_name(columns, "its_")
    found = near_groups(docs, size)
    ids = found.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id"))
    # Of the stay-id's rows with different fingerprints in one component, the smallest fingerprint stays.
    stay = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = ids.where(stay).groupBy("component_id").agg(F.min("fp").alias("chosen"), F.count(F.lit(1)).alias("prints"))
    listed = ids.where(~stay | (F.col("n") > 1)).select("doc_id", "fp", (~stay).alias("gone"), "n")
    listed = stored(listed, "simhash-listed")
    extra = first.where("prints > 1").select(F.col("component_id").alias("doc_id"), "chosen")
    extra = ids.where(stay).join(extra, F.col("component_id").eqNullSafe(extra["doc_id"])).where("fp <> chosen")
    extra = extra.select(ids["doc_id"], "fp", F.lit(True).alias("gone"), "n")
    listed = stored(listed.unionByName(extra), "simhash-gone")
    marked = fingerprints(docs, size, name=fp)
    match = F.col("doc_id").eqNullSafe(F.col(row)) & (F.col(fp) == F.col(its))
    names = [F.col("doc_id").alias(row), F.col("fp").alias(its)]
    rest = marked.join(small_or_shuffled(stored(listed.where("gone").select(*names), "simhash-drop")), match, "left_anti")
    twice = stored(listed.where("not gone and n > 1").select(*names).distinct(), "simhash-twice")
    if twice.isEmpty():
        return rest.select(*columns)
    twice = small_or_shuffled(twice)
    repeated = rest.join(twice, match, "left_semi").dropDuplicates(["doc_id", fp]).select(*columns)
    return rest.join(twice, match, "left_anti").select(*columns).unionByName(repeated)
