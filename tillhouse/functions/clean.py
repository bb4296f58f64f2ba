"""Value cleaning: trimming, spelling harmonization, safe casts, header names, audit columns."""

from __future__ import annotations

from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def harmonize(value: Column | str, spellings: dict[str, str]) -> Column:
    """Trim, then replace a known spelling by its standard one."""
    trimmed = F.trim(value)
    if not spellings:
        return trimmed
    standard = F.create_map(*[F.lit(x) for x in chain.from_iterable(spellings.items())])
    return F.coalesce(F.try_element_at(standard, trimmed), trimmed)


def trim_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({name: F.trim(name) for name in names})


def tag(df: DataFrame, system: str, entity: str | None = None) -> DataFrame:
    """Constant columns telling where a row came from."""
    constants = {"source_system": F.lit(system)}
    if entity is not None:
        constants["source_entity"] = F.lit(entity)
    return df.withColumns(constants)


def align(df: DataFrame, columns: dict[str, tuple[str | None, str]]) -> DataFrame:
    """Exactly these columns as ``{name: (source column or None, type)}``.

    Casts are safe: a value that does not fit becomes NULL. No source column gives a typed NULL.
    """
    return df.selectExpr(
        *[
            f"CAST(NULL AS {type_}) AS `{name}`" if source is None else f"try_cast(`{source}` AS {type_}) AS `{name}`"
            for name, (source, type_) in columns.items()
        ]
    )


def normalized_names(names: list[str]) -> dict[str, str]:
    """Old to new header names, blanks and hyphens as underscores; refuses names that would collide."""
    mapping = {name: name.translate(str.maketrans(" -", "__")) for name in names}
    clashes = [name for name, n in Counter(v.lower() for v in mapping.values()).items() if n > 1]
    if clashes:
        raise ValueError(f"header names collide after normalization: {sorted(clashes)}")
    return mapping


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(normalized_names(df.columns))


def with_audit(df: DataFrame) -> DataFrame:
    """``insert_dt`` and ``update_dt``: when the row was built."""
    return df.withColumns({"insert_dt": F.current_timestamp(), "update_dt": F.current_timestamp()})
