"""Secret scan: fixed patterns, and zstandard novelty of strings in a sensitive context.

Patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost without overlap over whole texts. Beyond them,
runs of at least ``MIN_RUN`` key-like characters that stand near a sensitive word are measured: how many bytes does the
run add to the compressed size of its surroundings, when the compressor is primed with a dictionary of code and
identifiers and with the text around it? What is a word, a path or a repetition costs little; what stays incompressible
is a span of kind ``novel``. Only runs with both a letter and a digit are measured: a rare word or a plain number is as
new to the compressor as a key. Shorter runs are not measured either, a few bytes of compressed size say nothing. So a
password of letters alone, or of less than 16 characters, is found by the patterns or not at all. Spans are code points,
end exclusive; novel spans never overlap those of the patterns. Time is linear in a text's length, also for long ones.

Null and empty texts have no spans. Rows are scanned one by one: repeated rows come out repeated, an empty table gives
no rows, extra columns are carried along if asked for. Nothing is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import text as T
from tillhouse.llm.frames import appended, fresh_name

# Kinds in report order, their patterns, and how long a match or its value must be.
KINDS = ["assign", "access", "hex", "novel"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Novelty: length of a run, characters around it that count as its surroundings, bits that each character must add.
MIN_RUN, AROUND, MIN_BITS = 16, 160, 7.0
_NEEDLES = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
_HEX_BYTES = T.byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 102)
_KEY_BYTES = T.byte_class(lambda b: chr(b).isalnum() and b < 128 or b in b"+/_=-")
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
_SENSITIVE = re.compile(r"passw|secret|token|api.?key|auth|credential|bearer|private|signature|access|akia|login|\bkey\b|\bpwd\b", re.I | re.A)
_DICTIONARY = (
    "import from return class def self public private static void const let var function if else for while try except "
    "raise throw new this null None true false True False string int float bool list dict array map json yaml xml http https "
    "www com org net example localhost host port user username password passwd secret token api_key apikey access_key "
    "client_id client_secret authorization bearer basic auth login session cookie csrf private_key public_key BEGIN END RSA "
    "AWS_ACCESS_KEY_ID AWS_SECRET_ACCESS_KEY DATABASE_URL config settings environment export value default name type id uuid "
    "sha256 sha1 md5 hash digest signature base64 encode decode utf-8 ascii license copyright released under the MIT License "
    "/usr/local/lib/ /usr/lib/python3/ dist-packages/ site-packages/ node_modules/ /usr/bin/ /home/ /var/log/ /etc/ /opt/ /tmp/ "
    "src/main/java/ src/test/ modules/ module_ packages/ package_ utils/ helpers/ resources/ static/ assets/ images/ index.html "
    ".min.js .json .yaml .py .txt .tar.gz version_ build_ release_ feature_ service_ request_ response_ handler_ controller_ "
    "the of and to in is that for it with as was on be at by this are or from not "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
).encode()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]


class Novelty:
    """Bits that a string adds per character to its surroundings, given the dictionary."""

    def __init__(self, level: int = 6):
        self.level = level

    def bits(self, before: str, run: str, after: str) -> float:
        primer = _DICTIONARY + after.encode() + b" " + before.encode()
        prior = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=self.level, dict_data=prior, write_content_size=False, write_checksum=False, write_dict_id=False)
        tail = before.encode()[-32:]
        alone, added = packer.compress(tail), packer.compress(tail + run.encode())
        return 8 * (len(added) - len(alone)) / len(run)


def novel_spans(text: str, taken: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    """Runs that touch no span of ``taken``; both are walked from left to right together."""
    out, at, reached = [], 0, 0  # ``reached``: the end of the spans that begin before the run's end
    ordered = sorted((s, e) for _, s, e in taken)
    for m in _RUN.finditer(text):
        run, low, high = m[0], m.start(), m.end()
        while at < len(ordered) and ordered[at][0] < high:
            reached = max(reached, ordered[at][1])
            at += 1
        if reached > low or not re.search("[0-9]", run) or not re.search("[A-Za-z]", run):
            continue
        before, after = text[max(0, low - AROUND) : low], text[high : high + AROUND]
        if (_SENSITIVE.search(before) or _SENSITIVE.search(after)) and novelty.bits(before, run, after) >= MIN_BITS:
            out.append(("novel", low, high))
    return out


def secret_spans(docs: DataFrame, text: str = "text", carry: list[str] | None = None, name: str = "spans") -> DataFrame:
    """``carry`` columns (all by default) with ``name``: array<struct<kind, start, end>> by start, then kind as listed.

    Whole-array passes over the bytes find the texts that can match at all; only those are given to the patterns.
    """
    carry = docs.columns if carry is None else carry
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def start():
        novelty = Novelty()

        def work(batch: pa.RecordBatch) -> list:
            column, out = batch.column(text), []
            for texts in T.chunks(column):
                maybe = np.zeros(len(texts), dtype=bool)
                for inside, least in ((_HEX_BYTES, MIN_HEX), (_KEY_BYTES, MIN_RUN)):
                    starts, ends, first = T.words(texts, inside)
                    long = np.concatenate([[0], np.cumsum(ends - starts >= least)])
                    maybe |= long[first[1:]] > long[first[:-1]]
                raw = texts.data.tobytes()
                low = raw.lower()
                for k, (a, b) in enumerate(zip(texts.bounds.tolist(), texts.bounds[1:].tolist())):
                    if not (maybe[k] or any(low.find(x, a, b) >= 0 for x in _NEEDLES) or raw.find(b"AKIA", a, b) >= 0):
                        out.append([])
                        continue
                    body = column[texts.first + k].as_py()
                    spans = base_spans(body)
                    spans += novel_spans(body, spans, novelty)
                    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                    out.append([{"kind": x, "start": s, "end": e} for x, s, e in spans])
            return [pa.array(out, kind)]

        return work

    return appended(docs, carry, [(name, "array<struct<kind:string,start:bigint,end:bigint>>")], start)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans make one."""
    spans = fresh_name(docs.columns, "spans")

    def start():
        def work(batch: pa.RecordBatch) -> list:
            out = []
            for body, found in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
                merged: list[list[int]] = []
                for s in found:
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                for a, b in reversed(merged):
                    body = body[:a] + mark + body[b:]
                out.append(body)
            return [pa.array(out, pa.string())]

        return work

    clean = fresh_name(docs.columns, "clean")
    found = appended(secret_spans(docs, text, name=spans), docs.columns, [(clean, "string")], start)
    return found.withColumn(text, F.col(clean)).select(*docs.columns)
