"""Keys that are pure functions of the row: same value in batch, stream and any partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PART_SEPARATOR = chr(31)
NULL_PART = chr(30)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_key(*cols: Column | str) -> Column:
    """Contract hash of a natural key. Parts are glued without separator; any NULL part gives NULL."""
    parts = [_col(c).cast("string") for c in cols]
    return F.md5(parts[0] if len(parts) == 1 else F.concat(*parts))


def xx_key(*cols: Column | str) -> Column:
    """64-bit hash key of the streamed facts."""
    return F.xxhash64(*[_col(c) for c in cols])


#: Hexadecimal digits of a digest that make a surrogate: 60 bits.
SK_DIGITS = 15

_exceptions: ContextVar[dict[str, int]] = ContextVar("key exceptions", default={})


@contextmanager
def key_exceptions(known: dict[str, int]) -> Iterator[None]:
    """Inside, ``sk60`` gives the natural keys with these digests the surrogates named here.

    For the few keys whose hash another key of the same table has; see :mod:`tillhouse.plans.clashes`. Plans take the
    exceptions in when they are built, batches and streams alike.
    """
    token = _exceptions.set(dict(known))
    try:
        yield
    finally:
        _exceptions.reset(token)


def natural_digest(*cols: Column | str) -> Column:
    """md5 over separated, null-marked parts: names a natural key."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.md5(F.concat_ws(PART_SEPARATOR, *parts))


def hashed_sk(digest: Column) -> Column:
    """The surrogate of a digest, but for exceptions."""
    return F.conv(F.substring(digest, 1, SK_DIGITS), 16, 10).cast("bigint")


def sk60(*cols: Column | str) -> Column:
    """Surrogate BIGINT: the first 60 bits of an md5 over separated, null-marked parts."""
    digest, known = natural_digest(*cols), _exceptions.get()
    if not known:
        return hashed_sk(digest)
    named = F.create_map(*(F.lit(x) for pair in sorted(known.items()) for x in pair))
    return F.coalesce(F.element_at(named, digest), hashed_sk(digest))


def fk60(*path: Column | str, required: int = 1) -> Column:
    """``sk60`` of a parent's path as seen from the child: NULL when one of the last ``required`` parts is NULL.

    The parent row has the same path and therefore the same id, so no join is needed to find it.
    """
    present = reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in path[-required:]])
    return F.when(present, sk60(*path))
