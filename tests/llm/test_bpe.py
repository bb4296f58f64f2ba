from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import tiktoken
from llm.helpers import EDGE_TEXTS, frame, with_clashes

from tillhouse.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    odd = list("abcXYZ  \n\t'.,;0123é漢😀  ß") + ["'s", " the", "'LL", "<|endoftext|>", " \n", "  "]
    return EDGE_TEXTS + ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(1500)] + ["z" * 3000, "ab" * 2000]


def test_ids_equal_the_library_and_decode_back(spark, sf_dir):
    own = library()
    docs = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = list(enumerate(texts() + docs))
    out = bpe.encoded(with_clashes(frame(spark, rows, "doc_id long, text string")), RANKS, P.PATTERN)
    got = {r["doc_id"]: r for r in bpe.decoded(out, RANKS).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = own.encode_ordinary(text or "")
        assert got[i]["token_ids"] == want, (i, text)
        assert bytes(got[i]["decoded"]) == (text or "").encode()
        assert got[i]["n_tokens_"] == len(want) and got[i]["n_tokens"] == "own"
        assert got[i]["ids_sha256"] == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in want)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_perfect_hash_finds_every_key_and_nothing_else():
    keys = [f"k{i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.slot.tolist()) == list(range(5000))  # minimal and perfect
    encoder = bpe.Encoder([bytes([b]) for b in range(256)] + keys, r"\S+")
    assert all(encoder.whole(k) == 256 + i for i, k in enumerate(keys))
    assert encoder.whole(b"absent") == encoder.whole(b"") == -1


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 10 * bpe._ENTRY)
    encoder = bpe.Encoder([bytes([b]) for b in range(256)], P.PATTERN)
    text = " ".join(f"w{i}" for i in range(500))
    assert encoder.decode(bpe.np.frombuffer(encoder.encode(text), "<u4")) == text.encode()
    assert len(encoder.chunks) <= 10 and len(encoder.pieces) <= 10


def test_empty_table(spark):
    assert bpe.encoded(frame(spark, [], "doc_id long, text string"), RANKS, P.PATTERN).count() == 0


def test_perfect_hash_of_small_sets_ends():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 5, 300):
        for _ in range(40):
            keys = list({rng.randbytes(4) for _ in range(n)})
            table = bpe.PerfectHash(keys)
            assert sorted(x for x in table.slot.tolist() if x >= 0) == list(range(len(keys)))


def test_memo_holds_its_byte_bound(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000)
    encoder = bpe.Encoder(bpe.read_ranks(None, RANKS), P.PATTERN)
    own, rng = library(), random.Random(2)
    for _ in range(300):
        text = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(400)) + " " + "Z" * rng.randrange(500) + f" word{rng.random()}"
        assert list(bpe.np.frombuffer(encoder.encode(text), "<u4")) == own.encode_ordinary(text)
        for memo in (encoder.pieces, encoder.chunks):
            assert memo.held <= 20_000 and all(len(k) <= bpe.MEMO_CHARS for k in memo)
            assert sum(bpe._ENTRY + 4 * len(k) + len(v) for k, v in memo.items()) == memo.held


def test_another_pattern_is_followed():
    """Under it a space begins no pre-token, so words are not encoded one by one."""
    pattern = r"\S+\s*|\s+"
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(None, RANKS))}
    own = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(list(ranks), pattern)
    for text in ("one two three", " a b ", "no"):
        assert list(bpe.np.frombuffer(encoder.encode(text), "<u4")) == own.encode_ordinary(text)
