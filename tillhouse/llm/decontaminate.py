"""Benchmark decontamination: a broadcast hash set of test windows, scanned against every training token window.

Words are runs of 0-9, letters and all non-ASCII characters after A-Z became a-z. An item's windows are its runs of
``n`` neighbouring words; a shorter item, unless it has no words, is one window. Hashes of document windows are looked
up in a bitmap, then in the sorted set; every candidate is verified word by word on the bytes. A document word inside
an occurrence of a window is hit.

Null texts have no words. Items without id can hit but are not listed. Items with equal texts are all listed. Empty
tables give no hits or no rows. Rows of ``docs`` are judged one by one, so repeated rows come out repeated. Very long
texts are judged whole, in time linear in their length. Extra columns are carried along; new ones get names that none
of them has.

The set is broadcast in blocks of at most about ``BLOCK_WORDS`` benchmark words (some 40 MB each); a larger benchmark
takes one narrow pass over the documents per block. Equal items count once, and long items are cut into pieces of
``PIECE_WORDS`` windows, so neither many copies of an item nor a huge one makes a block larger. Documents are not
shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import text as T
from tillhouse.llm.frames import appended, fresh_name, stored

WINDOW = 10
BLOCK_WORDS, PIECE_WORDS = 1_000_000, 10_000
WORD = T.byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BITS = 22
_SPACED = bytes(b if WORD[b] else 32 for b in range(256))
_SPANS = "array<struct<start:bigint,end:bigint>>"


def _lowered(texts: T.Texts) -> T.Texts:
    return T.Texts(T.LOWER[texts.data], texts.bounds, texts.first)


class WindowSet:
    """Windows of the items by length: sorted hashes, the window's bytes, and the items that have it."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        found: dict[int, dict[bytes, set]] = {}
        for item, text in items:
            words = text.encode().lower().translate(_SPACED).split()
            size = min(n, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(b" ".join(words[i : i + size]), set()).add(item)
        self.by_length = {}
        for size, windows in found.items():
            texts = list(windows)
            hashes = np.concatenate([_hashes_of(t, size) for t in texts])
            order = np.argsort(hashes, kind="stable")
            bitmap = np.zeros(1 << _BITS, dtype=bool)
            bitmap[hashes & np.uint64((1 << _BITS) - 1)] = True
            listed = [[x for x in windows[texts[k]] if x is not None] for k in order]
            self.by_length[size] = (hashes[order], bitmap, [texts[k] for k in order], listed)


def _hashes_of(window: bytes, size: int) -> np.ndarray:
    texts = next(T.chunks(pa.array([window], pa.binary())))
    starts, ends, _ = T.words(texts, WORD)
    return T.window_hashes(T.word_hashes(texts.data, starts, ends), size)


def _scan(texts: T.Texts, windows: WindowSet, hit: np.ndarray, starts, ends, first) -> dict[int, set]:
    """Marks hit words and returns the items found, by text."""
    data = texts.data
    hashes = T.word_hashes(data, starts, ends)
    of = T.owner(first)
    items: dict[int, set] = {}
    for size, (known, bitmap, bodies, listed) in windows.by_length.items():
        seen = T.window_hashes(hashes, size)
        at = np.flatnonzero(bitmap[seen & np.uint64((1 << _BITS) - 1)] & (of[: len(seen)] == of[size - 1 :]))
        low = np.searchsorted(known, seen[at])
        at, low = at[low < len(known)], low[low < len(known)]
        good = known[low] == seen[at]
        for word, k in zip(at[good].tolist(), low[good].tolist()):
            body = b" ".join(data[a:b].tobytes() for a, b in zip(starts[word : word + size], ends[word : word + size]))
            while k < len(known) and known[k] == seen[word]:
                if bodies[k] == body:
                    hit[word : word + size] = True
                    items.setdefault(int(of[word]), set()).update(listed[k])
                k += 1
    return items


def _marker(windows, text: str, names: list[str] | None) -> Callable[[], Callable[[pa.RecordBatch], list]]:
    """``names``: columns with spans and items of earlier blocks, or None in the first block."""

    def start():
        index = windows.value

        def work(batch: pa.RecordBatch) -> list:
            n_words, n_hit, spans, items = [], [], [], []
            for texts in T.chunks(batch.column(text)):
                texts = _lowered(texts)
                starts, ends, first = T.words(texts, WORD)
                hit = np.zeros(len(starts), dtype=bool)
                found: dict[int, set] = {}
                if names:
                    for k in range(len(texts)):
                        found[k] = set(batch.column(names[1])[texts.first + k].as_py())
                        for span in batch.column(names[0])[texts.first + k].as_py():
                            lo, hi = np.searchsorted(starts, [texts.bounds[k] + span["start"], texts.bounds[k] + span["end"]])
                            hit[lo:hi] = True
                for k, more in _scan(texts, index, hit, starts, ends, first).items():
                    found.setdefault(k, set()).update(more)
                total = np.concatenate([[0], np.cumsum(hit)])
                counts = total[first[1:]] - total[first[:-1]]
                n_words.append(np.diff(first))
                n_hit.append(counts)
                for k in range(len(texts)):
                    items.append(sorted(found.get(k, ())))
                    spans.append(_runs(hit, starts, ends, first[k], first[k + 1], texts.bounds[k]) if counts[k] else [])
            longs = lambda parts: pa.array(np.concatenate(parts).astype(np.int64))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return [longs(n_words), longs(n_hit), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))]

        return work

    return start


def _runs(hit, starts, ends, low: int, high: int, base: int) -> list[dict]:
    """Byte spans of the maximal runs of hit words of one text."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[low:high], [False]])))
    return [{"start": int(starts[low + a] - base), "end": int(ends[low + b - 1] - base)} for a, b in edge.reshape(-1, 2)]


def _pieces(items: DataFrame, n: int) -> DataFrame:
    """``items`` cut so that every window of ``n`` words lies in one piece; items with fewer words stay whole."""
    lowered = F.translate("body", _UPPER, _UPPER.lower())
    words = F.regexp_extract_all(lowered, F.lit("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), F.lit(0))
    listed = items.select("item", words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1)), F.lit(PIECE_WORDS))
    cut = listed.select("item", "words", F.explode(starts).alias("start"))
    return cut.select("item", F.array_join(F.slice("words", F.col("start"), PIECE_WORDS + n - 1), " ").alias("body")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns of ``docs`` (all by default) with a struct ``leak``: n_words, n_hit, spans (byte offsets of hit
    runs in the UTF-8 text), items (ids as strings, sorted)."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("body")).distinct()
    words = items.agg(F.sum(F.size(F.split("body", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = 1 if words <= BLOCK_WORDS else -(-2 * words // BLOCK_WORDS)
    if blocks > 1:
        items = stored(_pieces(items, n), "benchmark-pieces")
    taken = docs.columns
    names = [fresh_name(taken, x) for x in ("leak_words", "leak_hit", "leak_spans", "leak_items")]
    kinds = ["bigint", "bigint", _SPANS, "array<string>"]
    need = list(dict.fromkeys([*carry, text]))
    rows = docs.select(*need)
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block)
        listed = [(r["item"], r["body"]) for r in part.collect()]  # at most a block of a benchmark
        windows = spark.sparkContext.broadcast(WindowSet(listed, n))
        last = block == blocks - 1
        earlier = names[2:] if block else None
        rows = appended(rows, carry if last else need, list(zip(names, kinds)), _marker(windows, text, earlier))
    leak = F.struct(*(F.col(x).alias(y) for x, y in zip(names, ("n_words", "n_hit", "spans", "items"))))
    return rows.select(*carry, leak.alias(fresh_name(carry, "leak")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without documents in which a window of the benchmark occurs."""
    leak = fresh_name(docs.columns, "leak")
    return contamination(docs, benchmark, n).where(F.col(leak)["n_hit"] == 0).drop(leak)


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` with the hit spans taken out of ``text``; documents without hits come out unchanged."""
    leak = fresh_name(docs.columns, "leak")
    raw = F.encode("text", "UTF-8")
    spans = F.col(leak)["spans"]
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    stops = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length("text").cast("long")))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    joined = F.decode(F.aggregate(pieces, F.lit(b""), lambda acc, p: F.concat(acc, p)), "UTF-8")
    cut = F.when(F.col(leak)["n_hit"] > 0, joined).otherwise(F.col("text"))
    return contamination(docs, benchmark, n).withColumn("text", cut).drop(leak)
