"""Byte-level BPE: a minimal perfect hash for pre-tokens that are vocabulary entries, a heap over linked bytes otherwise.

The vocabulary has a fixed size, so its tables are broadcast. Texts are encoded where they are read; nothing is
shuffled. A memo per Python worker, bounded in bytes, holds what short words have been encoded to; long ones, such as
texts without spaces, are encoded where they stand. Null counts as empty; the empty text has no tokens; special tokens
are ordinary text; very long texts take n log n steps per pre-token. Rows are independent, so repeated rows come out
repeated; an empty table gives no rows. Extra columns are carried along, new ones get names that none of them has.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm.frames import appended, fresh_name

#: Bytes of each of a worker's two memos before it is emptied, and the longest text that gets an entry.
MEMO_BYTES, MEMO_CHARS = 64 << 20, 64
_ENTRY = 200  # bytes of an entry besides its contents

#: Shifts tried for a bucket, per key of the table, before all keys are hashed anew.
MAX_SHIFTS = 8


class PerfectHash:
    """Keys 0..n-1 in n slots without collision: hash to a bucket, shift the bucket's keys until all fall on free slots.

    Buckets with one key name their slot outright. If a bucket finds no shift, all keys are hashed anew under the next
    seed. A key outside the set also gets a slot, so the caller compares.
    """

    def __init__(self, keys: list[bytes]):
        if len(set(keys)) < len(keys):
            raise ValueError("a key occurs twice")
        self.seed = 0
        while not self._filled(keys):
            self.seed += 1

    def _filled(self, keys: list[bytes]) -> bool:
        n = max(1, len(keys))
        self.shift = np.zeros(n, dtype=np.int64)
        self.slot = np.full(n, -1, dtype=np.int64)
        buckets: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k, self.seed) for k in keys]
        for i, h in enumerate(hashes):
            buckets.setdefault(h % n, []).append(i)
        free = 0
        for bucket in sorted(buckets, key=lambda b: -len(buckets[b])):
            own = buckets[bucket]
            if len(own) == 1:
                while self.slot[free] >= 0:
                    free += 1
                self.slot[free] = own[0]
                self.shift[bucket] = -1 - free
                continue
            for shift in range(MAX_SHIFTS * n + 64):
                at = [_place(hashes[i], shift, n) for i in own]
                if len(set(at)) == len(at) and all(self.slot[a] < 0 for a in at):
                    break
            else:
                return False
            for i, a in zip(own, at):
                self.slot[a] = i
            self.shift[bucket] = shift
        return True

    def frozen(self) -> tuple[list[int], list[int]]:
        return self.shift.tolist(), self.slot.tolist()


def _place(h: int, shift: int, n: int) -> int:
    return ((h >> 17) + shift * ((h >> 40) | 1)) % n


class _Memo(dict):
    """Results by short text, at most ``MEMO_BYTES`` of them."""

    def __init__(self, make):
        super().__init__()
        self.make, self.held = make, 0

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= MEMO_CHARS:
            size = _ENTRY + 4 * len(key) + len(value)
            if self.held + size > MEMO_BYTES:
                self.clear()
                self.held = 0
            self[key] = value
            self.held += size
        return value


class Encoder:
    """Token ids of texts as packed little-endian unsigned 32-bit integers."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens  # by id
        table = PerfectHash(tokens)
        self.seed, (self.shift, self.slot) = table.seed, table.frozen()
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.find = regex.compile(pattern).findall
        self.wide = re.compile(r"\s\s").search if pattern == public_tokenizers.PATTERN else None
        self.pieces = _Memo(self.piece)
        self.chunks = _Memo(lambda chunk: self.split(" " + chunk))

    def whole(self, piece: bytes) -> int:
        """Id of a pre-token that is a vocabulary entry, or -1."""
        h = xxhash.xxh3_64_intdigest(piece, self.seed)
        n = len(self.shift)
        shift = self.shift[h % n]
        at = self.slot[-1 - shift if shift < 0 else _place(h, shift, n)]
        return at if at >= 0 and self.tokens[at] == piece else -1

    def piece(self, piece: str) -> bytes:
        raw = piece.encode()
        known = self.whole(raw)
        ids = [known] if known >= 0 else self.merged(raw)
        return np.array(ids, dtype="<u4").tobytes()

    def merged(self, raw: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals; parts are linked by their first byte."""
        n = len(raw)
        ranks = self.ranks.get
        after = list(range(1, n + 1))  # where the part that starts here ends, and so the next one starts
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of this part with the next
        heap = []
        for i in range(n - 1):
            rank = ranks(raw[i : i + 2])
            if rank is not None:
                pair[i] = rank
                heap.append((rank, i))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if pair[i] != rank:
                continue  # a part of this pair has been merged since
            j = after[i]
            end = after[i] = after[j]
            pair[j] = pair[i] = -1
            if end < n:
                before[end] = i
                rank = ranks(raw[i : after[end]])
                if rank is not None:
                    pair[i] = rank
                    heapq.heappush(heap, (rank, i))
            h = before[i]
            if h >= 0:
                rank = ranks(raw[h:end])
                pair[h] = -1
                if rank is not None:
                    pair[h] = rank
                    heapq.heappush(heap, (rank, h))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i : after[i]]])
            i = after[i]
        return out

    def split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Where no two white-space characters meet, every space starts a pre-token, so words are encoded one by one.

        That holds for the public pattern; texts under another are split by it as they are.
        """
        if self.wide is None or self.wide(text):
            return self.split(text)
        head, *rest = text.split(" ")
        return self.split(head) + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens by id from a rank file: base64 token, space, id per line."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ids must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


_WORKER: dict[tuple, Encoder] = {}


def _of_worker(key: tuple, tokens) -> Encoder:
    """One encoder per Python worker, so its memos outlive a task."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(tokens.value, key[1])
    return _WORKER[key]


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", carry: list[str] | None = None, ids: bool = True) -> DataFrame:
    """``carry`` columns (all by default) with n_tokens, ids_sha256, decoded_sha256 and, if ``ids``, token_ids.

    The rank file is read on the driver and broadcast. The decoded bytes come from the ids, not from the text.
    """
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    listed = read_ranks(spark, ranks_path)
    key = (hashlib.sha256(b"\n".join(map(base64.b64encode, listed))).hexdigest(), pattern)
    tokens = spark.sparkContext.broadcast(listed)
    added = [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    added += [("token_ids", "array<int>")] if ids else []
    added = [(fresh_name(carry, name), kind) for name, kind in added]

    def start():
        encoder = _of_worker(key, tokens)

        def work(batch: pa.RecordBatch) -> list:
            packed = [encoder.encode(x.as_py() or "") for x in batch.column(text)]
            numbers = [np.frombuffer(p, dtype="<u4") for p in packed]
            out = [
                pa.array([len(x) for x in numbers], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in numbers]),
            ]
            if ids:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(ends, np.concatenate(numbers).astype(np.int32)))
            return out

        return work

    return appended(docs, carry, added, start)


def decoded(rows: DataFrame, ranks_path: str, ids: str = "token_ids", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns with ``decoded``, the bytes of the token ids (null ids: null)."""
    spark = rows.sparkSession
    carry = rows.columns if carry is None else carry
    tokens = spark.sparkContext.broadcast(read_ranks(spark, ranks_path))

    def start():
        table = tokens.value
        return lambda batch: [
            pa.array([None if x.as_py() is None else b"".join(table[i] for i in x.as_py()) for x in batch.column(ids)], pa.binary())
        ]

    return appended(rows, carry, [(fresh_name(carry, "decoded"), "binary")], start)
