"""Substring dedup: suffix trees over prefix partitions find word windows that smaller documents also hold.

Words are runs of bytes other than white space, unchanged. A window is ``WINDOW`` neighbouring words of one document.
A word goes if a window over it also starts in a document with a smaller doc_id, judged on the input.

Not all suffixes are needed, since every window holds a ``PREFIX``-word gram that is smallest by hash, at the same place
in every copy of the window. Suffixes start at these grams only, about one word in twenty:

1. One scan lists each document's grams. Documents with equal words keep one row, so copies cost nothing further.
2. Grams that one document alone has as the smallest of a window are counted out, and with them most of the corpus.
3. Each remaining suffix carries the words of all windows in which its gram is smallest. Suffixes are partitioned by
   prefixes of different length: the gram alone; where ``SPLIT`` or more suffixes share it, its windows part into those
   that hold the next 30 words, under a prefix so much longer, and those that hold the 21 words before, under these;
   where ``SPLIT`` suffixes share even that, the prefix is divided by number.
4. A task takes complete prefixes, memory-sized runs at a time, sorts their suffixes, and reads the tree off the longest
   common prefixes of neighbours: suffixes below one node of depth r share r words. The same is done for the words
   before the gram, read backwards. Suffixes that share a node of depth WINDOW - k on the right and one of depth k on
   the left share the window that starts k words before the gram. The smallest id below decides.
5. Of a divided prefix, each part's smallest document hands its rows per window on, joined by an aggregate with map-side
   combine.

So no group of documents meets in one task, however many share a passage, and no pairs are made. Words compare by 64-bit
hash, word by word; a false match needs two different words of one hash in otherwise equal windows.

Null texts have no words. Rows without doc_id lose and remove nothing. Rows repeating an id are judged alike and do not
remove each other's words. Very long texts are read whole, one at a time; what they may share travels as
suffixes of bounded length. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import text as T
from tillhouse.llm.frames import appended, small_or_shuffled, stored

WINDOW = 50
PREFIX = 10
#: Suffixes of one prefix from which the prefix grows or is divided; also about how many a task holds at a time.
SPLIT = 8192
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_positions(hashes: np.ndarray, first: np.ndarray, window: int, size: int):
    """All grams that are smallest in a window (equal ones are all taken): word number, hash, and the least and the
    greatest number of words from the start of such a window to the gram. These windows are neighbours."""
    grams = T.window_hashes(hashes, size)
    wide = window - size + 1
    if len(grams) < wide:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing.astype(np.uint64), nothing, nothing
    of = T.owner(first)
    least = _sliding(np.minimum, grams, wide)
    whole = of[: len(least)] == of[window - 1 : window - 1 + len(least)]
    # A gram is taken if it equals the least value of a window over it: the largest of these least values.
    most = np.zeros(len(grams) + wide - 1, dtype=np.uint64)
    most[wide - 1 : wide - 1 + len(least)] = np.where(whole, least, 0)
    top = _sliding(np.maximum, most, wide)
    at = np.flatnonzero((grams == top) & (top > 0))
    near, far = np.full(len(at), wide), np.full(len(at), -1)
    least = np.concatenate([np.where(whole, least, 0), np.zeros(wide, dtype=np.uint64)])
    for k in range(wide):
        own = (at >= k) & (least[np.maximum(at - k, 0)] == grams[at])
        near[own & (near == wide)] = k
        far[own] = k
    return at, grams[at], near, far


def _sliding(of, values: np.ndarray, n: int) -> np.ndarray:
    """``of`` (minimum or maximum) over every ``n`` neighbours."""
    out, reach = values, 1
    while reach * 2 <= n:
        out = of(out[: len(out) - reach], out[reach:])
        reach *= 2
    total = len(values) - n + 1
    return of(out[:total], out[n - reach : n - reach + total])


def _listed(docs: DataFrame, window: int, size: int) -> DataFrame:
    """doc_id, row_md5, n_words, words_sha256 (of the joined words) and grams: array<struct<pos, gram, near, far>>."""
    kind = pa.struct([("pos", pa.int32()), ("gram", pa.int64()), ("near", pa.int16()), ("far", pa.int16())])

    def start():
        def work(batch: pa.RecordBatch) -> list:
            counts, digests, offsets, held = [], [], [0], []
            for texts in T.chunks(batch.column("text")):
                starts, ends, first = T.words(texts, T.NOT_SPACE)
                flat, low, high = T.joined(texts, starts, ends)
                at, grams, near, far = gram_positions(T.word_hashes(texts.data, starts, ends), first, window, size)
                edge = np.searchsorted(at, first)
                counts.append(np.diff(first))
                held.append((at - np.repeat(first[:-1], np.diff(edge)), grams.view(np.int64), near, far))
                offsets.extend((offsets[-1] + edge[1:]).tolist())
                for a, b in zip(first.tolist(), first[1:].tolist()):
                    digests.append(hashlib.sha256(flat[low[a] : high[b - 1]] if b > a else b"").hexdigest())
            columns = [pa.array(np.concatenate(x).astype(f.type.to_pandas_dtype())) for x, f in zip(zip(*held), kind)]
            values = pa.StructArray.from_arrays(columns, fields=list(kind))
            return [
                pa.array(np.concatenate(counts).astype(np.int64)),
                pa.array(digests),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
            ]

        return work

    added = [("n_words", "bigint"), ("words_sha256", "string"), ("grams", "array<struct<pos:int,gram:bigint,near:smallint,far:smallint>>")]
    return appended(docs, ["doc_id", "row_md5"], added, start)


_SUFFIX = "key bigint, row bigint, doc bigint, left int, places array<int>, words binary"


def _suffixes(window: int, size: int, hot: bool):
    """A row per different suffix of a document, with the words around it and all places where it starts; either those
    of grams with fewer than ``SPLIT`` suffixes, or the others, under longer prefixes."""
    split = SPLIT  # the driver's value; executors import the module anew

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _suffix_rows(batch, window, size, hot, split)

    return run


def _longer(gram: int, words: list[bytes], tag: bytes) -> int:
    return int.from_bytes(hashlib.md5(tag + b"%d " % gram + b" ".join(words)).digest()[:8], "little", signed=True)


def _suffix_rows(batch: pa.RecordBatch, window: int, size: int, hot: bool, split: int) -> Iterator[pa.RecordBatch]:
    rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
    texts, lists = batch.column("text"), batch.column("suffixes")
    middle = (window - size) // 2
    held = [[] for _ in range(6)]
    bytes_held = 0
    for k, (row, doc) in enumerate(zip(rows, ids)):
        words = (texts[k].as_py() or "").encode().split()
        own: dict[tuple, list[int]] = {}
        for s in lists[k].as_py():
            if (s["n"] >= split) != hot:
                continue
            pos, near, far, gram = s["pos"], s["near"], s["far"], s["gram"]
            if not hot:
                parts = [(gram, near, far)]
            else:
                parts = []
                if near <= middle:
                    parts.append((_longer(gram, words[pos : pos + window - middle], b">"), near, min(far, middle)))
                if far > middle:
                    parts.append((_longer(gram, words[pos - middle - 1 : pos], b"<"), max(near, middle + 1), far))
            for key, low, high in parts:
                around = b" ".join(words[pos - high : pos - low + window])
                own.setdefault((key, high, around), []).append(pos)
        for (key, left, around), places in own.items():
            for column, value in zip(held, (key, row, doc, left, places, around)):
                column.append(value)
            bytes_held += len(around)
        if bytes_held > 8 << 20:
            yield _suffix_batch(held)
            held, bytes_held = [[] for _ in range(6)], 0
    if held[0]:
        yield _suffix_batch(held)


def _suffix_batch(held: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()]
    names = ["key", "row", "doc", "left", "places", "words"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(held, kinds)], names=names)


def _partitioned(parts: DataFrame, window: int, size: int) -> DataFrame:
    """Suffixes with ``part`` and ``parts`` of their prefix, complete prefixes together and sorted."""
    cold = parts.mapInArrow(_suffixes(window, size, False), _SUFFIX)
    cold = cold.withColumns({"part": F.lit(0), "parts": F.lit(1)})
    hot = stored(parts.mapInArrow(_suffixes(window, size, True), _SUFFIX), "repeats-hot")
    crowded = stored(hot.groupBy("key").count().where(F.col("count") >= SPLIT), "repeats-crowded")
    number = (F.lit(1) + F.coalesce(F.col("count"), F.lit(0)) / SPLIT).cast("int")
    hot = hot.join(crowded, "key", "left").withColumn("parts", number).drop("count")
    hot = hot.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    return cold.unionByName(hot).repartition("key", "part").sortWithinPartitions("key", "part")


def _tree(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words`` within their groups, and how many leading words each shares with the one before.

    That is a suffix tree: a node of depth r is a run of neighbours that share r words or more.
    """
    order = np.lexsort((*words.T[::-1], group))
    same = words[order[1:]] == words[order[:-1]]
    depth = np.where(same.all(axis=1), words.shape[1], same.argmin(axis=1))
    depth[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate([[-1], depth])


def _nodes(tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """For each row the node of this depth that it is below; rows alone below theirs included."""
    order, common = tree
    node = np.empty(len(order), dtype=np.int64)
    node[order] = np.cumsum(common < depth)
    return node


def shared_windows(group: np.ndarray, doc: np.ndarray, left: np.ndarray, words: list[np.ndarray], window: int = WINDOW, size: int = PREFIX):
    """For suffixes with ``left`` words before their start: bit k of the first result is set if the window starting k
    words before is also in a smaller document of the group; of the second, if the row stands for its window, i.e. is
    of the smallest document: each of its rows, since all go if another part has a smaller one."""
    n, deep = len(doc), window - size
    flat, counts = np.concatenate(words), np.array([len(w) for w in words])
    first = np.cumsum(counts) - counts
    own = T.mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)  # equals no other row's filler, nor a likely word

    def matrix(width: int, base: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
        out = np.empty((n, width), dtype=np.uint64)
        for j in range(width):
            out[:, j] = np.where(room > j, flat[np.clip(base + step * j, 0, len(flat) - 1)], own + np.uint64(j))
        return out

    right = _tree(group, matrix(window, first + left, 1, counts - left))
    before = _tree(group, matrix(deep, first + left - 1, -1, left))
    gone, stands = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for k in range(deep + 1):
        some = np.flatnonzero((left >= k) & (counts - left >= window - k))
        if not len(some):
            continue
        a, b = _nodes(right, window - k)[some], _nodes(before, k)[some]
        order = np.lexsort((some, doc[some], b, a))
        a, b, at = a[order], b[order], some[order]
        head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        least = doc[at[head]][np.cumsum(head) - 1]
        gone[at[least < doc[at]]] |= 1 << k
        stands[at[least == doc[at]]] |= 1 << k
    return gone, stands


_FOUND = "row bigint, places array<int>, gone bigint, doc bigint, window binary, k int"


def _searched(window: int, size: int):
    split = SPLIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < split:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key, part = whole.column("key").to_numpy(), whole.column("part").to_numpy()
            last = int(np.flatnonzero((key != key[-1]) | (part != part[-1]))[-1]) + 1 if (key[0], part[0]) != (key[-1], part[-1]) else 0
            if last:
                yield from _found(whole.slice(0, last), window, size, split)
            held, rows = [whole.slice(last)], whole.num_rows - last
        if rows:
            yield from _found(pa.Table.from_batches(held).combine_chunks().to_batches()[0], window, size, split)

    return run


def _found(batch: pa.RecordBatch, window: int, size: int, split: int) -> Iterator[pa.RecordBatch]:
    for low, high in _memory_sized(batch, split):
        part = batch.slice(low, high - low)
        key, number = part.column("key").to_numpy(), part.column("part").to_numpy()
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (number[1:] != number[:-1]))])
        words = []
        for texts in T.chunks(part.column("words")):
            starts, ends, first = T.words(texts, T.NOT_SPACE)
            hashes = T.word_hashes(texts.data, starts, ends)
            words += [hashes[a:b] for a, b in zip(first, first[1:])]
        doc, left = part.column("doc").to_numpy(), part.column("left").to_numpy().astype(np.int64)
        gone, stands = shared_windows(group, doc, left, words, window, size)
        some = np.flatnonzero(gone)
        out = part.take(pa.array(some))
        nothing = pa.nulls(len(some), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [out.column("row"), out.column("places"), pa.array(gone[some]), out.column("doc"), nothing, pa.nulls(len(some), pa.int32())],
            names=["row", "places", "gone", "doc", "window", "k"],
        )
        divided = np.flatnonzero((part.column("parts").to_numpy() > 1) & (stands > 0))
        held: list[tuple] = []
        for i in divided.tolist():
            body = part.column("words")[i].as_py().split()
            for k in range(window - size + 1):
                if stands[i] >> k & 1:
                    at = int(left[i]) - k
                    digest = hashlib.md5(b" ".join(body[at : at + window])).digest()
                    held.append((part.column("row")[i].as_py(), part.column("places")[i].as_py(), 0, int(doc[i]), digest, k))
        if held:
            kinds = [pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*held), kinds)], names=["row", "places", "gone", "doc", "window", "k"])


def _memory_sized(batch: pa.RecordBatch, split: int) -> Iterator[tuple[int, int]]:
    """Runs of complete prefixes of about ``split`` rows."""
    key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
    ends = np.concatenate([np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1, [len(key)]])
    low = 0
    while low < len(key):
        high = int(ends[max(np.searchsorted(ends, low + split, side="right") - 1, np.searchsorted(ends, low, side="right"))])
        yield low, high
        low = high


def _cut(window: int):
    """n_removed and kept text of documents with removed windows (array of structs: places of a gram, bits ``gone``)."""

    def start():
        def work(batch: pa.RecordBatch) -> list:
            removed, kept = [], []
            for text, found in zip(batch.column("text"), batch.column("found")):
                words = (text.as_py() or "").encode().split()
                cover = np.zeros(len(words) + window + 1, dtype=np.int32)
                for places, gone in zip(found.values.field("places").to_pylist(), found.values.field("gone").to_pylist()):
                    ks = np.flatnonzero(np.array([gone], dtype="<i8").view(np.uint8).reshape(1, 8).repeat(8, axis=1)[0] >> np.tile(np.arange(8), 8) & 1)
                    begin = (np.array(places)[:, None] - ks[None, :]).ravel()
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, begin + window, -1)
                stay = np.cumsum(cover)[: len(words)] == 0
                removed.append(int(len(words) - stay.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(stay)]).decode())
            return [pa.array(removed, pa.int64()), pa.array(kept, pa.string())]

        return work

    return start


def repeats(docs: DataFrame, window: int = WINDOW, size: int = PREFIX, texts: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, if ``texts``, ``kept``: the words that
    stay, one space apart (null where nothing was removed: the text stays as it is)."""
    source = docs.select("doc_id", "text").withColumn("row_md5", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    listed = stored(_listed(source, window, size).withColumn("row", F.monotonically_increasing_id()), "repeats-listed")
    able = listed.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    copies = able.groupBy("words_sha256").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.count(F.lit(1)).alias("n"))
    copies = stored(copies.where("n > 1").select("words_sha256", F.col("rep.doc_id").alias("rep"), F.col("rep.row").alias("rep_row")), "repeats-copies")
    again = stored(able.select("words_sha256", "row").join(copies, "words_sha256").where("row <> rep_row").select("row"), "repeats-again")
    single = able.select("row", "doc_id", "grams").join(small_or_shuffled(again), "row", "left_anti")
    grams = stored(single.select("row", "doc_id", F.explode("grams").alias("g")).select("row", "doc_id", "g.*"), "repeats-grams")
    shared = grams.groupBy("gram").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    shared = stored(shared.where("lo < hi").select("gram", "n"), "repeats-shared")
    own = F.collect_list(F.struct("pos", "gram", "near", "far", "n"))  # the grams of one document
    picked = stored(grams.drop("doc_id").join(shared, "gram").groupBy("row").agg(own.alias("suffixes")), "repeats-picked")
    # Only texts that have such grams travel; which ones is told by a counted broadcast, or beyond its bound by a shuffle.
    wanted = stored(listed.select("row", "doc_id", "row_md5", "words_sha256").join(picked.select("row"), "row"), "repeats-wanted")
    texts_of = source.join(small_or_shuffled(wanted), ["doc_id", "row_md5"])  # repeated rows come twice, alike
    parts = stored(texts_of.select("row", "doc_id", "words_sha256", "text").join(picked, "row"), "repeats-texts")
    grouped = _partitioned(parts.select("row", "doc_id", "text", "suffixes"), window, size)
    found = stored(grouped.mapInArrow(_searched(window, size), _FOUND), "repeats-found")
    divided = found.where("window is not null")
    least = stored(divided.groupBy("window").agg(F.min("doc").alias("least")), "repeats-least")
    late = divided.join(least, "window").where("least < doc").select("row", "places", F.expr("shiftleft(1L, k) as gone"))
    gone = found.where("window is null").select("row", "places", "gone").unionByName(late)
    gone = gone.groupBy("row").agg(F.collect_list(F.struct("places", "gone")).alias("found"))  # one document's windows
    cut = appended(parts.select("row", "doc_id", "words_sha256", "text").join(gone, "row"), ["doc_id", "words_sha256"], [("n_removed", "bigint"), ("kept", "string")], _cut(window))
    cut = cut.withColumn("kept_sha256", F.sha2("kept", 256))
    cut = stored(cut.select("doc_id", "words_sha256", "n_removed", "kept_sha256", *(["kept"] if texts else [])), "repeats-cut").dropDuplicates(["doc_id", "words_sha256"])
    rows = listed.select("doc_id", "n_words", "words_sha256").join(copies.select("words_sha256", "rep"), "words_sha256", "left")
    rows = rows.join(cut, ["doc_id", "words_sha256"], "left")
    copy = F.coalesce((F.col("doc_id") > F.col("rep")) & (F.col("n_words") >= window), F.lit(False))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if texts else []),
    )
