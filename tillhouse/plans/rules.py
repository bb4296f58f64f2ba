"""Which reading of the warehouse rules to build."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """``path``: parents are found by their full path, and every natural-key text is trimmed and harmonized once.
    ``leaf``: parents are found by their own name only, with trimming and harmonizing per table; a name that
    occurs under two grandparents then multiplies rows, as the literal rules have it."""

    lookup: str = "path"

    def __post_init__(self) -> None:
        if self.lookup not in ("path", "leaf"):
            raise ValueError(f"unknown lookup rule: {self.lookup}")

    @property
    def by_path(self) -> bool:
        return self.lookup == "path"


PATH = Rules("path")
LEAF = Rules("leaf")
