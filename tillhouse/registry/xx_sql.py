"""The published 64-bit xxHash, spelled as SQL projections, so that hash ids can be checked by another engine.

Every step is one projection over the previous one, in unsigned 128-bit arithmetic cut to 64 bits.
"""

from __future__ import annotations

# Primes of the published algorithm, and the seed Spark's xxhash64() starts from.
P1 = 11400714785074694791
P2 = 14029467366897019727
P3 = 1609587929392839161
P4 = 9650029242287828579
P5 = 2870177450012600261
SEED = 42

_WORD = "18446744073709551616::UHUGEINT"


def _cut(expr: str) -> str:
    return f"(({expr}) % {_WORD})"


def _times(a: str, prime: int) -> str:
    return _cut(f"{a} * {prime}::UHUGEINT")


def _plus(a: str, number: int) -> str:
    return _cut(f"{a} + {number}::UHUGEINT")


def _rotate(a: str, bits: int) -> str:
    return f"({_cut(f'{a} << {bits}')} | ({a} >> {64 - bits}))"


def _bytes(column: str, start: int | str, count: int) -> str:
    """Little-endian number from ``count`` bytes of a hex text column."""
    pairs = " || ".join(f"substr({column}, 2 * ({start} + {i}) + 1, 2)" for i in reversed(range(count)))
    return f"(('0x' || {pairs})::UHUGEINT)"


class Projections:
    """A growing chain of projections over a relation; ``h`` is the running hash."""

    def __init__(self, relation: str) -> None:
        self.sql = f"select *, {SEED}::UHUGEINT as h from {relation}"

    def step(self, **columns: str) -> None:
        new = ", ".join(f"{expr} as {name}" for name, expr in columns.items() if name != "h")
        parts = ["* replace (" + columns["h"] + " as h)" if "h" in columns else "*"] + ([new] if new else [])
        self.sql = f"select {', '.join(parts)} from ({self.sql})"

    def drop(self, *names: str) -> None:
        self.sql = f"select * exclude ({', '.join(names)}) from ({self.sql})"

    def _finish(self, present: str) -> None:
        self.step(u="xor(u0, u0 >> 33)")
        self.step(v=_times("u", P2))
        self.step(w="xor(v, v >> 29)")
        self.step(x=_times("w", P3))
        self.step(h=f"case when {present} then xor(x, x >> 32) else h end")
        self.drop("u0", "u", "v", "w", "x")

    def digest_text(self, column: str) -> None:
        """A text of exactly 32 bytes, such as an md5."""
        self.step(t=f"hex(encode({column}))")
        self.step(**{f"l{i}": f"coalesce({_bytes('t', 8 * i, 8)}, 0::UHUGEINT)" for i in range(4)})
        # the seed's last addend is P1 taken away, that is 2^64 - P1 added
        starts = [f"h + {P1}::UHUGEINT + {P2}::UHUGEINT", f"h + {P2}::UHUGEINT", "h", f"h + {2**64 - P1}::UHUGEINT"]
        self.step(**{f"a{i}": _cut(f"{s} + {_times(f'l{i}', P2)}") for i, s in enumerate(starts)})
        self.step(**{f"r{i}": _times(_rotate(f"a{i}", 31), P1) for i in range(4)})
        turned = " + ".join(_rotate(f"r{i}", bits) for i, bits in enumerate((1, 7, 12, 18)))
        self.step(g0=_cut(turned))
        self.step(**{f"m{i}": _times(f"r{i}", P2) for i in range(4)})
        self.step(**{f"k{i}": _times(_rotate(f"m{i}", 31), P1) for i in range(4)})
        for i in range(4):
            self.step(**{f"g{i + 1}": _plus(_times(f"xor(g{i}, k{i})", P1), P4)})
        self.step(u0=_plus("g4", 32))
        self._finish(f"{column} is not null")
        lanes = [f"{p}{i}" for p in "larmk" for i in range(4)]
        self.drop("t", *lanes, *[f"g{i}" for i in range(5)])

    def short_text(self, column: str) -> None:
        """A text below 32 bytes."""
        self.step(t=f"coalesce(hex(encode({column})), '')")
        self.step(n="length(t) // 2", e0=_cut(f"h + {P5}::UHUGEINT + (length(t) // 2)::UHUGEINT"))
        last = "e0"
        for i in range(3):
            whole = f"n >= {8 * (i + 1)}"
            self.step(**{f"b{i}": f"case when {whole} then {_times(_bytes('t', 8 * i, 8), P2)} end"})
            self.step(**{f"c{i}": _times(_rotate(f"b{i}", 31), P1)})
            self.step(**{f"d{i}": f"xor({last}, c{i})"})
            self.step(**{f"e{i + 1}": f"case when {whole} then {_plus(_times(_rotate(f'd{i}', 27), P1), P4)} else {last} end"})
            last = f"e{i + 1}"
        self.step(f0=f"case when n % 8 >= 4 then xor({last}, {_times(_bytes('t', '(n - n % 8)', 4), P1)}) end")
        self.step(f1=f"case when n % 8 >= 4 then {_plus(_times(_rotate('f0', 23), P2), P3)} else {last} end")
        last = "f1"
        for i in range(3):
            self.step(**{f"y{i}": f"case when n % 4 > {i} then xor({last}, {_times(_bytes('t', f'(n - n % 4 + {i})', 1), P5)}) end"})
            self.step(**{f"z{i}": f"case when n % 4 > {i} then {_times(_rotate(f'y{i}', 11), P1)} else {last} end"})
            last = f"z{i}"
        self.step(u0=last)
        self._finish(f"{column} is not null")
        self.drop("t", "n", "e0", "f0", "f1", *[f"{p}{i}" for p in "bcdyz" for i in range(3)], "e1", "e2", "e3")

    def long_number(self, expr: str) -> None:
        """A BIGINT, or the unscaled value of a short decimal."""
        self.step(t=f"(case when ({expr}) < 0 then {_WORD} - (-({expr}))::UHUGEINT else ({expr})::UHUGEINT end)")
        self.step(a=_times("t", P2))
        self.step(b=_times(_rotate("a", 31), P1))
        self.step(c=f"xor({_plus('h', P5 + 8)}, b)")
        self.step(u0=_plus(_times(_rotate("c", 27), P1), P4))
        self._finish(f"({expr}) is not null")
        self.drop("t", "a", "b", "c")

    def int_number(self, expr: str) -> None:
        self.step(t=f"(case when ({expr}) < 0 then 4294967296::UHUGEINT - (-({expr}))::UHUGEINT else ({expr})::UHUGEINT end)")
        self.step(c=f"xor({_plus('h', P5 + 4)}, {_times('t', P1)})")
        self.step(u0=_plus(_times(_rotate("c", 23), P2), P3))
        self._finish(f"({expr}) is not null")
        self.drop("t", "c")

    def done(self, name: str) -> str:
        """The chain as a query; the hash becomes a signed BIGINT column."""
        half, top = "9223372036854775808::UHUGEINT", "18446744073709551615::UHUGEINT"
        signed = f"case when h >= {half} then -(({top} - h)::BIGINT) - 1 else h::BIGINT end"
        return f"select * exclude (h), {signed} as {name} from ({self.sql})"
